"""S8 + A20 + A21: write statistics of a table write, as metric rows.

Re-aimed from a lake commit timeline: after a write, every data file of the
table reports (partition, file, size, rows) through Spark's hidden
``_metadata`` columns.  The statistics are aggregated per partition (A21)
and in total (A20) with ordinary ``groupBy`` aggregations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Write-statistic metric names and metric row types.
WRITE_STAT_METRICS = ("numInserts", "numWrites", "numDeletes", "fileSizeInBytes")
SUMMARY_METRICS = ("totalInserts", "totalUpdates", "totalRecordsWritten", "totalBytesWritten")
WRITE_STAT_TYPE, SUMMARY_TYPE, EXTRA_TYPE = "WriteStat", "CommitSummary", "Commit"

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

WRITE_STATS_SCHEMA = ("partition_path string, file_path string, num_inserts long, num_writes long, "
                      "num_deletes long, file_size long")


def file_write_stats(spark: SparkSession, path: str, fmt: str = "parquet",
                     partition_cols: tuple[str, ...] = (), where=None, schema=None) -> DataFrame:
    """Per data file: partition path, file, rows written, size (inserts only: append writes).
    ``where`` selects the files of one commit, e.g. ``processing_time = <run time>``; ``schema``
    keeps folder values from being guessed from their text.  A NULL partition value has its folder's name."""
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.format(fmt).load(path)
    except Exception as e:                 # nothing written yet: no commit, no statistics
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return spark.createDataFrame([], WRITE_STATS_SCHEMA)
        raise
    if where is not None:
        df = df.where(where)
    part = (F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(NULL_FOLDER)))
                               for c in partition_cols])
            if partition_cols else F.lit(""))
    return (df.select(part.alias("partition_path"), F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_size").alias("file_size"))
            .groupBy("partition_path", "file_path")
            .agg(F.count(F.lit(1)).alias("num_writes"), F.first("file_size").alias("file_size"))
            .select("partition_path", "file_path", F.col("num_writes").alias("num_inserts"), "num_writes",
                    F.lit(0).cast("long").alias("num_deletes"), "file_size"))


def write_stat_metrics(stats: DataFrame) -> DataFrame:
    """Four metric rows per partition: (type, column=partition, metric, value, value_str)."""
    per = stats.groupBy("partition_path").agg(
        F.sum("num_inserts").alias("numInserts"), F.sum("num_writes").alias("numWrites"),
        F.sum("num_deletes").alias("numDeletes"), F.sum("file_size").alias("fileSizeInBytes"))
    items = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                      for m in WRITE_STAT_METRICS])
    return per.select(F.lit(WRITE_STAT_TYPE).alias("type"), F.col("partition_path").alias("column"),
                      F.inline(items)).withColumn("value_str", F.col("value").cast("long").cast("string"))


def commit_summary_metrics(stats: DataFrame, operation: str = "insert", updates_col: str | None = None,
                           extra: dict[str, str] | None = None) -> DataFrame:
    """Commit totals + operation type + extra key/values, as metric rows."""
    spark = stats.sparkSession
    upd = F.sum(F.col(updates_col)) if updates_col else F.lit(0).cast("long")
    tot = stats.agg(F.sum("num_inserts").alias("totalInserts"), upd.alias("totalUpdates"),
                    F.sum("num_writes").alias("totalRecordsWritten"), F.sum("file_size").alias("totalBytesWritten"))
    items = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                      for m in SUMMARY_METRICS])
    nums = tot.select(F.lit(SUMMARY_TYPE).alias("type"), F.lit(None).cast("string").alias("column"),
                      F.inline(items)).withColumn("value_str", F.col("value").cast("long").cast("string"))
    texts = [(SUMMARY_TYPE, None, "operationType", None, operation)]
    texts += [(EXTRA_TYPE, None, k, None, v) for k, v in (extra or {}).items()]
    text_df = spark.createDataFrame(texts, "type string, column string, metric string, value double, "
                                           "value_str string")
    return nums.unionByName(text_df)
