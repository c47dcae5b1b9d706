"""Exact cuts of an order, found by counting: no range shuffle, no ranking, no row moves.

:func:`nth_key` finds the key of the n-th row of a table.  While more rows than one task
sorts with ease are in question, a bounded sample of their keys brackets the place sought,
one aggregate counts the rows below and inside the bracket, and the search goes on inside.

:func:`group_cuts` does the same for every group of a table ordered by a 64-bit hash, by
radix: counts per (group, leading 16 bits) tell in which bucket a group's cut falls, whole
hashes are counted only in there (a 65,536th of the group).  Counting combines map-side, so
a group, a bucket or a hash holding a third of the rows sends one row per task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FEW = 100_000                   # rows whose order is settled by one top-n
SAMPLE = 2_000                  # keys sampled to bracket the place sought
GROUPS_SENT = 100_000           # groups whose cuts are sent to every task; more of them are joined by a shuffle
LEADING = 48                    # bits below the leading ones, which the first count goes by


def sort_key(ascending: dict[str, bool], nulls_first: dict[str, bool]) -> Column:
    """A struct without NULLs whose order is that of the columns; descending ones must be whole numbers."""
    parts = []
    for i, (c, up) in enumerate(ascending.items()):
        col = F.col(c)
        absent = col.isNull() if not nulls_first[c] else col.isNotNull()
        value = F.coalesce(col, F.lit("")) if up else F.coalesce(-col.cast("long"), F.lit(0).cast("long"))
        parts += [absent.cast("int").alias(f"n{i}"), value.alias(f"v{i}")]
    return F.struct(*parts)


def _literal(row) -> Column:
    return F.struct(*[F.lit(v).cast("long" if n[0] == "v" else "int").alias(n) if isinstance(v, int) else F.lit(v).alias(n)
                      for n, v in row.asDict().items()])


def nth_key(df: DataFrame, key: Column, n: int, total: int) -> Column | None:
    """The key of the ``n``-th of ``total`` rows as a literal (equal keys count each); None where there is none."""
    if not 1 <= n <= total:
        return None
    rows = df.select(key.alias("_k"))
    while total > FEW:
        sample = rows.distinct().orderBy(F.xxhash64("_k")).limit(SAMPLE).orderBy("_k").collect()
        at, slack = n / total * len(sample), 4 * math.sqrt(len(sample))
        low = _literal(sample[max(0, int(at - slack))]["_k"])
        high = _literal(sample[min(len(sample) - 1, int(at + slack))]["_k"])
        k = F.col("_k")
        below, inside, at_low, at_high = rows.agg(F.count_if(k < low), F.count_if((k > low) & (k < high)),
                                                  F.count_if(k == low), F.count_if((k == high) & (high > low))).first()
        if n <= below:
            rows, total = rows.where(k < low), below
        elif n <= below + at_low:
            return low
        elif n <= below + at_low + inside:
            rows, n, total = rows.where((k > low) & (k < high)), n - below - at_low, inside
        elif n <= below + at_low + inside + at_high:
            return high
        else:
            done = below + at_low + inside + at_high
            rows, n, total = rows.where(k > high), n - done, total - done
    return _literal(rows.orderBy("_k").limit(n).agg(F.max("_k").alias("k")).first()["k"])


def _levels(hash_col) -> tuple[Column, Column]:
    return F.shiftright(hash_col, LEADING), F.col(hash_col).bitwiseAND((1 << LEADING) - 1)


def _cut(counts: DataFrame, bucket: str, wanted: Column, level: int) -> DataFrame:
    """The bucket where each group's running count passes the rows wanted, and how many of its rows are needed."""
    before = F.sum("_c").over(Window.partitionBy("_g").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn("_need", wanted - F.coalesce(before, F.lit(0))).where((F.col("_need") > 0) & (F.col("_need") <= F.col("_c"))) \
        .select("_g", bucket, F.col("_need").alias(f"_need{level}"), F.col("_c").alias(f"_c{level}"))


def group_cuts(hashed: DataFrame, group: str, hash_col: str, quota) -> tuple[DataFrame, bool]:
    """One row per group with a quota above 0, and whether a cut divides rows of one hash.

    Columns: ``_g`` and, for both levels, the bucket of the cut (``_b1``, ``_b2``), its rows (``_c1``, ``_c2``) and how many of
    them are needed (``_need1``, ``_need2``); the second is NULL where the first is exact.  ``quota`` maps a group's row
    count to the rows wanted of it.  Up to ``GROUPS_SENT`` groups carry a broadcast hint.
    """
    high, low = _levels(hash_col)
    rows = hashed.select(F.col(f"`{group}`").alias("_g"), high.alias("_b1"), low.alias("_b2"))
    counts = rows.groupBy("_g", "_b1").agg(F.count("*").alias("_c"))
    first = _cut(counts, "_b1", quota(F.sum("_c").over(Window.partitionBy("_g"))), 1).checkpoint()
    groups, open_ = first.agg(F.count("*"), F.count_if(F.col("_need1") < F.col("_c1"))).first()

    def sent(plan: DataFrame) -> DataFrame:
        return F.broadcast(plan) if groups <= GROUPS_SENT else plan
    second, divided = None, False
    if open_:
        partial = first.where("_need1 < _c1").select(F.col("_g").alias("_pg"), F.col("_b1").alias("_pb"), F.col("_need1").alias("_wanted"))
        inside = rows.join(sent(partial), F.col("_g").eqNullSafe(F.col("_pg")) & (F.col("_b1") == F.col("_pb")))
        counts = inside.groupBy("_g", "_b2").agg(F.count("*").alias("_c"), F.first("_wanted").alias("_wanted"))
        second = _cut(counts, "_b2", F.col("_wanted"), 2).checkpoint()
        divided = not second.where("_need2 < _c2").isEmpty()
        second = second.withColumnRenamed("_g", "_g2")
        plan = first.join(sent(second), F.col("_g").eqNullSafe(F.col("_g2")), "left").drop("_g2")
    else:
        plan = first.select("*", *[F.lit(None).cast("long").alias(c) for c in ("_b2", "_need2", "_c2")])
    return sent(plan), divided


def inside_cut(hash_col: str) -> Column:
    """Whether a row joined with its group's cuts lies inside; NULL for rows of one hash that a cut divides."""
    high, low = _levels(hash_col)
    return F.when(F.col("_b1").isNull() | (high > F.col("_b1")), False) \
        .when((high < F.col("_b1")) | (F.col("_need1") == F.col("_c1")) | (low < F.col("_b2")), True) \
        .when(low > F.col("_b2"), False).when(F.col("_need2") == F.col("_c2"), True)
