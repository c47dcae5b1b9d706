"""Ranked lexical search by norm buckets.

A document is a vector of impacts, one coordinate for each term that a query of the block
holds; a query is the 0/1 vector of its terms, so that a score is their inner product.
Impacts are whole numbers and so are scores.

One pass over the texts counts terms.  Document frequencies and the totals are sums over all
documents.  Vectors are then range-partitioned by falling length (their norm), ties by id, so
that a task holds buckets of neighbouring lengths.  The longest bucket of every task is ranked
first; the last score of a query's list there is its threshold everywhere else, where a bucket
is skipped for a query by Cauchy-Schwarz or by the bucket's largest value of each coordinate.
Inside a bucket a vector is left by its coordinates in focus (the query's heaviest terms) and
Cauchy-Schwarz on the rest.  What survives is scored exactly.  Bounds only ever leave vectors
that lie strictly below a score that ``k`` others reach.

Queries are taken in blocks of a bounded number of terms; what a task holds is a block's
terms and lists and one bucket.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm.common import cut, pick, shared_path, slices, text_bytes

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")            # in UTF-8: all that is not ASCII belongs to terms
BLOCK_TERMS = 1 << 17           # terms of a block of queries, at most (but for a single longer query)
CELLS = 1 << 21                 # rows times coordinates of a bucket, at most
ROWS = 512                      # rows of a bucket, at most
FOCUS = 6                       # coordinates in focus
SLACK = 1 + 1e-9                # norms are doubles; bounds are widened by this


def terms_of(text: bytes) -> list[bytes]:
    return TERM.findall(text.lower())                   # bytes.lower() changes A-Z alone


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def damping(n: int, n_docs: int, n_terms: int) -> int:
    """What a document of ``n`` terms adds to the divisor of its term counts (in eighths)."""
    return 100 - 90 + (90 * n * n_docs) // n_terms


def impacts(tf: np.ndarray, w: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Coordinates of terms of weight ``w`` that occur ``tf`` times in documents of damping ``m``."""
    return w * ((1000000000 * tf) // (1000 * tf + 8 * m))


# ------------------------------------------------------------------- one bucket

class Ranks:
    """The best ``k`` (score, id) of every query: higher scores first, then smaller ids (null ids last)."""

    def __init__(self, k: int, floors: np.ndarray):
        self.k, self.floor = k, floors.copy()           # no row below a query's floor can be among its best
        self.best: list[list] = [[] for _ in floors]

    def add(self, q: int, scores: np.ndarray, ids: list) -> None:
        rows = self.best[q] + [(-int(s), i is None, i if i is not None else 0, i) for s, i in zip(scores, ids)]
        rows.sort(key=lambda r: r[:3])
        self.best[q] = rows[:self.k]
        if len(rows) >= self.k:
            self.floor[q] = max(self.floor[q], -self.best[q][-1][0])


def search_bucket(ids: list, at: np.ndarray, terms: np.ndarray, values: np.ndarray, norms: np.ndarray, queries: list[np.ndarray],
                  ranks: Ranks, seen: dict) -> None:
    """Rank one bucket: row ``r`` has coordinates ``terms[at[r]:at[r + 1]]``; queries list their terms, heaviest first."""
    local, column = np.unique(terms, return_inverse=True)
    grid = np.zeros((len(ids), len(local)), np.int64)
    grid[np.repeat(np.arange(len(ids)), np.diff(at)), column] = values
    top, longest, squares = grid.max(0), float(norms.max()), norms ** 2
    for q, wanted in enumerate(queries):
        floor = ranks.floor[q]
        seen["pairs"] += len(ids)
        if math.sqrt(len(wanted)) * longest * SLACK < floor:                # Cauchy-Schwarz on the bucket
            seen["by_length"] += len(ids)
            continue
        place = np.searchsorted(local, wanted)
        place[place == len(local)] = 0
        cols = place[local[place] == wanted] if len(local) else place[:0]
        if not len(cols) or top[cols].sum() < floor:                        # largest coordinates of the bucket
            seen["by_coordinates"] += len(ids)
            continue
        rows = np.arange(len(ids))
        if len(cols) > FOCUS:
            focus = grid[:, cols[:FOCUS]]
            rest = np.maximum(squares - (focus.astype(np.float64) ** 2).sum(1), 0.0) + squares * 1e-12
            bound = focus.sum(1) + math.sqrt(len(cols) - FOCUS) * np.sqrt(rest)
            rows = np.flatnonzero(bound * SLACK >= floor)
            seen["by_focus"] += len(ids) - len(rows)
            if not len(rows):
                continue
        scores = grid[np.ix_(rows, cols)].sum(1)
        seen["scored"] += len(rows)
        good = np.flatnonzero((scores > 0) & (scores >= floor))
        if len(good) > ranks.k:                                             # among equals the smaller ids
            last = np.partition(scores[good], len(good) - ranks.k)[len(good) - ranks.k]
            good = good[scores[good] >= last]
        if len(good):
            ranks.add(q, scores[good], [ids[i] for i in rows[good]])


def _search(queries: list[np.ndarray], k: int, floors: np.ndarray, rows_of_bucket: int):
    """Arrow pass over (id, terms, impacts, norm) by falling norm: the best k rows of each query in this task."""
    def run(batches):
        import pyarrow as pa
        ranks, seen, kind = Ranks(k, floors), Counter(), None
        for b in slices(batches, rows_of_bucket):
            if b.num_rows:
                kind, lists = b.column(0).type, b.column(1)
                at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
                search_bucket(b.column(0).to_pylist(), at, lists.flatten().to_numpy(), b.column(2).flatten().to_numpy(),
                              b.column(3).to_numpy(), queries, ranks, seen)
        out = [(q, r[3], -r[0]) for q, best in enumerate(ranks.best) for r in best]
        if out:
            q, i, s = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(i, kind), pa.array(s, pa.int64())], ["query", "id", "score"])
    return run


# --------------------------------------------------------------------- the search

def vectors(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tf) per document with a term: number of its terms, and those of the vocabulary with their counts."""
    index = {t: i for i, t in enumerate(vocabulary)}

    def run(batches):
        import pyarrow as pa
        for b in slices(batches, 64):
            keep, ns, ts, fs = [], [], [], []
            for row, text in enumerate(b.column(1)):
                words = terms_of(text.as_py())
                if words:
                    found = sorted((index[t], c) for t, c in Counter(words).items() if t in index)
                    keep.append(row)
                    ns.append(len(words))
                    ts.append([t for t, _ in found])
                    fs.append([c for _, c in found])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), pa.array(ns, pa.int64()),
                                              pa.array(ts, pa.list_(pa.int32())), pa.array(fs, pa.list_(pa.int64()))],
                                             ["id", "n", "terms", "tf"])
    src = pick(docs, id=id_col, text=text_col).select("id", text_bytes().alias("text"))
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, n long, terms array<int>, tf array<long>")


def _blocks(items: DataFrame, item_col: str, text_col: str):
    """Lists of (item, distinct terms), of at most BLOCK_TERMS terms; items without a term have no result."""
    block, size = [], 0
    for r in pick(items, item=item_col, text=text_col).orderBy("item", "text").toLocalIterator():
        terms = sorted(set(terms_of((r["text"] or "").encode())))
        if terms and block and size + len(terms) > BLOCK_TERMS:
            yield block
            block, size = [], 0
        if terms:
            block.append((r["item"], terms))
            size += len(terms)
    if block:
        yield block


def _measured(w: np.ndarray, n_docs: int, n_terms: int):
    """Arrow pass over (id, n, terms, tf): their impacts and norms."""
    def run(batches):
        import pyarrow as pa
        for b in slices(batches, 4096):
            lists = b.column(2)
            size = np.diff(lists.offsets.to_numpy())
            m = np.repeat(np.array([damping(n, n_docs, n_terms) for n in b.column(1).to_pylist()], np.int64), size)
            values = impacts(b.column(3).flatten().to_numpy(), w[lists.flatten().to_numpy()], m)
            norm = np.sqrt(np.bincount(np.repeat(np.arange(len(size)), size), values.astype(np.float64) ** 2, len(size)))
            at = pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(at, lists.flatten()),
                                              pa.ListArray.from_arrays(at, pa.array(values)), pa.array(norm)], ["id", "terms", "impacts", "norm"])
    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(docs: DataFrame, block: list, k: int, id_col: str, text_col: str) -> DataFrame:
    """(query, id, score, rank): the best rows of each query of a block, numbered as in the block."""
    spark = docs.sparkSession
    vocabulary = sorted({t for _, terms in block for t in terms})
    place = {t: i for i, t in enumerate(vocabulary)}
    path = shared_path(spark, "term-counts")
    vectors(docs, vocabulary, id_col, text_col).write.parquet(path)
    found = spark.read.parquet(path)
    totals = found.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = totals["docs"], totals["terms"] or 1
    counts = dict(found.select(F.explode("terms").alias("t")).groupBy("t").count().collect())        # the block's terms at most
    w = np.array([weight(n_docs, counts[i]) if i in counts else 0 for i in range(len(vocabulary))], np.int64)
    queries = []
    for _, terms in block:
        q = np.array([i for i in (place[t] for t in terms) if w[i] > 0], np.int64)
        queries.append(q[np.argsort(-w[q], kind="stable")])
    kind = found.schema["id"].dataType.simpleString()
    scored = found.where(F.size("terms") > 0).mapInArrow(
        _measured(w, n_docs, n_terms), f"id {kind}, terms array<int>, impacts array<long>, norm double").where("norm > 0")
    by_length = [F.col("norm").desc(), F.col("id").asc_nulls_last()]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    turn = F.expr("monotonically_increasing_id() & 8589934591")             # place in its task
    ordered = cut(scored.repartitionByRange(tasks, *by_length).sortWithinPartitions(*by_length).withColumn("turn", turn))
    bucket = max(16, min(ROWS, CELLS // len(vocabulary)))
    schema = f"query int, id {kind}, score long"
    rows = ordered.select("id", "terms", "impacts", "norm")
    floors = np.ones(len(queries), np.int64)
    first = ordered.where(F.col("turn") < bucket).select("id", "terms", "impacts", "norm")
    seeds = _ranked(first.mapInArrow(_search(queries, k, floors, bucket), schema), k)
    for r in seeds.where(F.col("rank") == k).select("query", "score").collect():                    # one row a query at most
        floors[r["query"]] = r["score"]
    return _ranked(rows.mapInArrow(_search(queries, k, floors, bucket), schema), k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item, rank, id, score): for every item its ``k`` highest-scoring documents with a score above 0.

    Null texts have no terms; items and documents without terms have no rows.  Equal scores go by ascending id, null ids
    last; repeated documents are ranked each, repeated items get lists of their own.  Other columns are not read; an
    empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    kind = pick(items, item=item_col).schema["item"].dataType.simpleString()
    found = spark.createDataFrame([], f"item {kind}, rank int, id {pick(docs, id=id_col).schema['id'].dataType.simpleString()}, score long")
    for block in _blocks(items, item_col, item_text_col):
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"query int, item {kind}")
        best = _block(docs, block, k, id_col, text_col)
        found = found.unionByName(best.join(F.broadcast(names), "query").select("item", "rank", "id", "score"))
    return found
