"""A training-data pipeline over ``documents``: quality, line dedup, near-dedup, secrets, packing.

Each stage takes what its predecessor kept and, but for the last, returns the columns
of its input; its decisions are in the rows and texts it returns.  Results are
written as Parquet below the session's shared checkpoint folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.llm import line_dedup, packing, quality, secret_scan, simhash
from tablewatch.llm.common import read, shared_path


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the input, n_chars (where there is one) brought up to date."""
    return docs.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" and "text" in columns
                         else docs[f"`{c}`"] for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the full policy."""
    return quality.accepted(docs, quality.FULL)


def line_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines are deleted from the texts."""
    return _counted(line_dedup.deduplicate(docs), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.one_of_each(docs, shingle=3, radius=3)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts."""
    boxed = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    found = secret_scan.scan(boxed, secret_scan.train(docs), id_col=None, keep=("row",))
    spans = F.array_sort(F.concat("base", "added"))
    masked = F.when(F.col("row.text").isNull(), F.col("row.text")).otherwise(secret_scan.redacted(F.col("text"), spans))
    done = found.select("row", masked.alias("masked")).select(
        *[F.col("masked").alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
    return _counted(done, docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_repeats), ("simhash_near_dedup", near_duplicates),
          ("secret_scans", secrets), ("best_fit_packing", best_fit_packing)]

#: SQL has no tokenizer; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
