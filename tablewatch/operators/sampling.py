"""Sampling by label (X1) and an exact stratified train/test split."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .ranking import global_row_number
from .selection import group_cuts, inside_cut


def sample_by_label(df: DataFrame, label: str = "label", fraction: float = 1.0, seed: int = 42,
                    key_cols: Sequence[str] | None = None) -> DataFrame:
    """The same fraction of every label (NULL too); no-op when fraction >= 1.

    A row is drawn by a seeded digest of ``key_cols`` (default: all columns), so the sample
    depends neither on the partitioning nor on the order of rows; rows of equal keys are
    drawn together.
    """
    if fraction >= 1.0:
        return df
    keys = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in key_cols or df.columns]
    place = F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *keys).cast("binary")), 1, 8)
    return df.where(place < f"{int(fraction * (1 << 32)):08x}")


def stratified_split(df: DataFrame, label: str = "label", test_fraction: float = 0.2, seed: int = 42,
                     key_cols: Sequence[str] | None = None, out: str = "is_test", place: Column | None = None) -> DataFrame:
    """Exactly ``floor(n_label * test_fraction + 0.5)`` test rows per label (NULL is one), those with the smallest
    seeded hashes of ``key_cols`` (default: all columns but the label), or the smallest values of ``place``, a long
    without NULLs, where one is given.

    The cut of each label is found by counting (:mod:`selection`) and then compared with each row's hash: one row per
    label is sent to the tasks, the table is not moved.  Rows of one hash that a cut divides are ranked by all their columns.
    """
    keys = list(key_cols or [c for c in df.columns if c != label])
    h = F.xxhash64(*[F.col(f"`{c}`") for c in keys], F.lit(seed)) if place is None else place
    hashed = df.withColumn("_h", h)
    ensure_checkpoint_dir(df.sparkSession)
    plan, divided = group_cuts(hashed, label, "_h", lambda n: F.floor(n * F.lit(float(test_fraction)) + 0.5))
    tagged = hashed.join(plan, F.col(f"`{label}`").eqNullSafe(F.col("_g")), "left").withColumn(out, inside_cut("_h"))
    spare = ["_g", "_h", *[c for c in plan.columns if c != "_g"]]
    if not divided:
        return tagged.drop(*spare)
    whole = tagged.where(F.col(out).isNotNull())
    order = [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.lit(seed + 1)).asc()]
    ranked = global_row_number(tagged.where(F.col(out).isNull()), order, "_r", partition_by=[label])
    return whole.unionByName(ranked.withColumn(out, F.col("_r") <= F.col("_need2")).drop("_r")).drop(*spare)
