"""Sinks: lake appends (K1), metric-history appends (K2/K3), JSON documents (K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import format_ts


def append_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """K1: append rows to a lake table by path."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def append_metrics(metrics: DataFrame, path: str, partition_by: tuple[str, ...] = ("date",)) -> None:
    """K2 / K3: append metric rows with a formatted time and a date partition, so
    history queries prune by date."""
    out = metrics
    if "ts" in metrics.columns:
        out = out.withColumn("timestamp_str", format_ts(F.col("ts")))
        if "date" in partition_by and "date" not in out.columns:
            out = out.withColumn("date", F.to_date("ts"))
    out.write.mode("append").partitionBy(*[p for p in partition_by if p in out.columns]).parquet(path)


def replace_run(metrics: DataFrame, path: str, run: str) -> None:
    """K2: the metric rows of one run as partitions (date, run); a rerun takes the place of its earlier rows."""
    (metrics.withColumn("timestamp_str", format_ts(F.col("ts"))).withColumn("date", F.to_date("ts"))
     .withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date", "run").parquet(path))


def replace_batch(metrics: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent per micro-batch: the rows of ``batch_id`` are (re)written as one
    partition, so a replayed batch overwrites instead of duplicating."""
    (metrics.withColumn("batch_id", F.lit(int(batch_id)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def write_json_documents(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: one JSON document per row as text."""
    df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value")).write.mode(mode).text(path)


def write_exposition(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: the labelled text exposition (one ``name{labels} value`` line per row) as text files."""
    lines.select("line").write.mode(mode).text(path)


def push_gauges(lines: DataFrame, path: str, job: str, table: str) -> None:
    """K5: push exposition lines of one (job, table) group.  A push replaces what the group had, so a rerun leaves one
    value per gauge; other groups stay.  Read back with ``read_gauges``."""
    from urllib.parse import quote
    write_exposition(lines, f"{path.rstrip('/')}/job={quote(job, safe='')}/table={quote(table, safe='')}")


def read_gauges(spark: SparkSession, path: str) -> DataFrame:
    """(line, job, table) of every group pushed below ``path``."""
    return spark.read.schema("value string, job string, table string").text(path).withColumnRenamed("value", "line")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder inside the shared checkpoint folder (never a machine-local temp dir)."""
    import uuid
    from ..session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tablewatch-{name}-{uuid.uuid4().hex[:12]}"
