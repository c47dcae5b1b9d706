"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.llm import (bpe, chunk_dedup, embed_index, language, lexical_search, line_dedup, packing, pii, quality, secret_scan, simhash,
                            vector_codes, warc)
from tablewatch.llm.common import read


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_index.near_duplicates(read(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), "n_links", "component_id", "kept")


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    base = secret_scan.joined(F.col("base"))
    return found.select(
        F.col("id").alias("doc_id"), *[secret_scan.counted("base", k).alias(f"n_{k}") for k in secret_scan.KINDS],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        secret_scan.joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_markov"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.deduplicate(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.resolve(read(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.deduplicate(read(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_removed", "text")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.apply_policy(quality.ledger(read(spark, sf_dir, "documents")), quality.FULL)
    return book.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       quality.rejected_by(quality.BASE).alias("base_failed"), "kept",
                       F.col("failed").alias("failed_rules"), "policy")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")) \
        .withColumnRenamed("id", "doc_id")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "pages"), read(spark, sf_dir, "documents")) \
        .withColumnRenamed("id", "page_id")


def op9_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")) \
        .withColumnRenamed("id", "doc_id")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select(F.col("id").alias("doc_id"), simhash.hex16("fp").alias("fingerprint"), "component_id")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")) \
        .withColumnsRenamed({"item": "item_id", "id": "doc_id"})


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes.compress(read(spark, sf_dir, "embeddings"))
    return codes.select(F.col("id").alias("vec_id"), "code", "error", "label_error",
                        F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = pii.scan(docs, pii.train(docs))
    base = secret_scan.joined(F.col("base"))
    return found.select(
        F.col("id").alias("doc_id"), *[secret_scan.counted("base", k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size("base")).cast("long").alias("n_added"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_embedding_near_dedup, op2_secret_scans, op3_substring_dedup, op4_warc_revisits, op5_line_dedup, op6_quality_rules,
    op7_best_fit_packing, op8_language_id, op9_bpe_encode_decode, op10_simhash_near_dedup, op11_lexical_search,
    op12_vector_codes, op13_pii, pipeline)}
