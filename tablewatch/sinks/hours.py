"""T4: rows of a stream in hour folders.

``rows/hour=<yyyyMMddHH>`` is the hour in which a micro-batch was handled; every row carries its
``batch_id`` and the ``attempt`` (milliseconds of its start).  A replayed batch is written again
with a later attempt, and the latest attempt of a batch is the one that is read, whatever hour it
fell into.  ``compact`` rewrites closed hours with few files and without overtaken rows, so the
number of folders grows with the hours and not with the batches.

Compaction writes an hour below ``compacted`` first and only then takes its place in ``rows``;
a run that dies between the two is finished by the next one.  One compaction at a time.
"""

from __future__ import annotations

import datetime
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OWN = [T.StructField("batch_id", T.LongType()), T.StructField("attempt", T.LongType()), T.StructField("hour", T.StringType())]
FILE_BYTES = 64 << 20           # stored bytes of an hour for which compaction writes one file


def hour_of(at: datetime.datetime) -> str:
    return "h" + at.strftime("%Y%m%d%H")


def append_batch(batch: DataFrame, path: str, batch_id: int, at: datetime.datetime | None = None, attempt: int | None = None) -> None:
    """One attempt of a micro-batch; ``at`` and ``attempt`` are now, if not given."""
    at = at or datetime.datetime.now(datetime.timezone.utc)
    clash = {c.lower() for c in batch.columns} & {f.name for f in OWN}
    if clash:
        raise ValueError(f"columns {sorted(clash)} belong to the sink")
    batch.select("*", F.lit(int(batch_id)).cast("long").alias("batch_id"),
                 F.lit(int(time.time() * 1000) if attempt is None else attempt).cast("long").alias("attempt"),
                 F.lit(hour_of(at)).alias("hour")) \
        .write.mode("append").partitionBy("hour").parquet(f"{path.rstrip('/')}/rows")


def _stored(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(T.StructType(schema.fields + OWN)).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _latest(rows: DataFrame) -> DataFrame:
    """The rows of the latest attempt of each batch: the overtaken attempts, a row for each replay, are sent to the
    rows.  Joined on the batch instead, all rows of a batch would be sorted in one task."""
    attempts = rows.select("batch_id", "attempt").distinct().groupBy("batch_id").agg(
        F.max("attempt").alias("last"), F.collect_list("attempt").alias("every"))
    overtaken = attempts.select("batch_id", "last", F.explode("every").alias("attempt")).where("attempt < last").select("batch_id", "attempt")
    return rows.join(F.broadcast(overtaken), ["batch_id", "attempt"], "left_anti").select(rows.columns)


def read(spark: SparkSession, path: str, schema: T.StructType, stored: bool = False) -> DataFrame:
    """The stream's rows, each batch once; with ``stored`` its batch, attempt and hour as well."""
    rows = _stored(spark, f"{path.rstrip('/')}/rows", schema)
    if rows is None:
        rows = spark.createDataFrame([], T.StructType(schema.fields + OWN))
    return _latest(rows).select([f.name for f in schema.fields + (OWN if stored else [])])


def compact(spark: SparkSession, path: str, schema: T.StructType, before: datetime.datetime, files_per_hour: int = 1,
            file_bytes: int = FILE_BYTES) -> None:
    """Rewrite the hours that closed before ``before`` as at most ``files_per_hour`` files each, or one for every
    ``file_bytes`` that the hour holds, if these are more: a task gets a file's rows, however many an hour has.

    An hour's rows are overtaken where a later attempt lies in any hour, so batches are compared
    over the whole sink and only the closed hours are rewritten."""
    root = path.rstrip("/")
    _finish(spark, root, schema)
    rows = _stored(spark, f"{root}/rows", schema)
    if rows is None:
        return
    closed = _latest(rows).where(F.col("hour") < hour_of(before))
    files = rows.where(F.col("hour") < hour_of(before)).select("hour", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).distinct()
    sizes = files.groupBy("hour").agg(F.greatest(F.ceil(F.sum("size") / file_bytes), F.lit(files_per_hour)).alias("_files"))
    # an hour is cut at random places of its batches, so that one hour may be spread over several tasks
    cut = F.pmod(F.xxhash64("batch_id", F.monotonically_increasing_id()), F.col("_files"))
    closed.join(F.broadcast(sizes), "hour").withColumn("_cut", cut).repartition("hour", "_cut").select(rows.columns) \
        .write.mode("overwrite").partitionBy("hour").parquet(f"{root}/compacted")
    _ready(spark, root, True)
    _finish(spark, root, schema)


def _ready(spark: SparkSession, root: str, value: bool) -> None:
    spark.range(0, 1, 1, 1).select(F.lit(value).alias("ready")).write.mode("overwrite").parquet(f"{root}/ready")


def _finish(spark: SparkSession, root: str, schema: T.StructType) -> None:
    """Put the hours below ``compacted`` in place of those in ``rows``, if they were written to the end.
    Repeating it changes nothing: closed hours get no new rows."""
    try:
        ready = spark.read.schema("ready boolean").parquet(f"{root}/ready").where("ready").count() == 1
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        ready = False
    if ready:
        _stored(spark, f"{root}/compacted", schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("hour").parquet(f"{root}/rows")
        _ready(spark, root, False)
