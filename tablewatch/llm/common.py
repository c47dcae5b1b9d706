"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, renamed: whatever else a table carries cannot clash."""
    return df.select(*[df[f"`{old}`"].alias(new) for new, old in columns.items()])


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows go to the session's shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def text_bytes(column: str = "text"):
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def slices(batches, rows: int = 256):
    """Arrow batches in pieces of a few rows, so that Python holds few texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def worker_state() -> dict:
    """State that lives as long as a Python worker: compiled models and word caches."""
    return sys.modules.setdefault("_tablewatch_worker", types.ModuleType("_tablewatch_worker")).__dict__
