"""Per-micro-batch quality monitoring.

The stream is parsed with ``from_json`` (T1).  ``foreachBatch`` (T2) caches
the batch once, computes its metrics with the same fused-aggregate operator
as batch jobs, writes them keyed by ``batch_id`` (a replayed batch overwrites
its own partition, so the metric table is exactly-once with the checkpoint),
optionally appends the batch itself (T4), then unpersists.  A checkpoint
location is always required, so a restart resumes where it stopped.
"""

from __future__ import annotations

import datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import metrics as M
from ..operators import states as ST
from ..sinks import replace_batch
from ..sinks.hours import append_batch


# The smart-home event stream's schema, correlation pairs and compliance
# rules (rule name, SQL predicate) measured on every micro-batch.
SMART_HOME_SCHEMA = (
    "timestamp timestamp, home_id int, device_id string, device_type string, room string, status string, "
    "power_watt double, user_present int, activity string, indoor_temp double, outdoor_temp double, "
    "humidity double, light_level double, day_of_week int, hour_of_day int, price_kWh int")
SMART_HOME_CORRELATIONS = [("indoor_temp", "outdoor_temp"), ("indoor_temp", "humidity"), ("outdoor_temp", "humidity")]
SMART_HOME_RULES = [
    ("valid_status", "status IN ('on', 'off')"),
    ("power_watt_positive", "power_watt >= 0"),
    ("indoor_temp_range", "indoor_temp >= -10 AND indoor_temp <= 50"),
    ("outdoor_temp_range", "outdoor_temp >= -30 AND outdoor_temp <= 60"),
    ("humidity_percentage", "humidity >= 0 AND humidity <= 50"),
    ("day_of_week_range", "day_of_week >= 0 AND day_of_week <= 6"),
    ("hour_of_day_range", "hour_of_day >= 0 AND hour_of_day <= 23"),
    ("device_type_not_null", "device_type IS NOT NULL AND device_type != ''"),
    ("activity_valid", "activity IS NOT NULL AND length(activity) > 0"),
    ("price_kWh_positive", "price_kWh >= 0"),
]


def stream_analyzers(batch: DataFrame, correlations=(), rules=()) -> list:
    """The per-micro-batch metric set: Size; per column Completeness,
    ApproxCountDistinct and Entropy; numeric Minimum, Maximum, Mean, Sum,
    StandardDeviation; text MaxLength, MinLength; plus correlations of the given
    pairs and compliance of the given rules whose columns exist in the batch."""
    cols = set(batch.columns)
    out = M.default_analyzers(batch, std_dev=True, entropy=True)
    out += [M.Correlation(a, b) for a, b in correlations if a in cols and b in cols]
    out += [M.Compliance(n, p) for n, p in rules if _resolves(batch, p)]
    return out


def _resolves(batch: DataFrame, predicate: str) -> bool:
    """Does the predicate analyse against the batch's columns?  (Analysis only, no job.)"""
    try:
        batch.select(F.expr(predicate)).schema
        return True
    except Exception:
        return False


def smart_home_analyzers(batch: DataFrame) -> list:
    """The metric set of the smart-home event stream."""
    return stream_analyzers(batch, SMART_HOME_CORRELATIONS, SMART_HOME_RULES)


def read_json_stream(spark: SparkSession, path: str, schema: T.StructType | str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """S5 (file form): JSON text lines from a folder, parsed with a fixed schema."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(path)
    return parse_stream(lines, schema)


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, schema: T.StructType | str,
                      starting_offsets: str = "latest") -> DataFrame:
    """Kafka source (needs the Kafka connector on the classpath)."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("startingOffsets", starting_offsets).load())
    return parse_stream(raw, schema)


def parse_stream(raw: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Value bytes -> text -> struct -> columns; malformed text -> all-NULL row."""
    return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("data")).select("data.*")


def batch_metrics_fn(metrics_path: str | None, analyzers: Callable[[DataFrame], list] | None = None,
                     data_path: str | None = None, table: str = "stream",
                     states_path: str | None = None, hours_path: str | None = None) -> Callable[[DataFrame, int], None]:
    """T2 body: metrics of one micro-batch and, with ``states_path``, the mergeable states they
    come from; both idempotent on ``batch_id``.  The rows themselves go to a folder per batch
    (``data_path``) or to hour folders (``hours_path``, see ``sinks.hours``)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        # kept only if it is read more than once
        again = bool(metrics_path or states_path or (data_path and hours_path))
        if again:
            batch.persist()
        try:
            chosen = analyzers(batch) if analyzers else stream_analyzers(batch)
            # the batch's processing time makes the rows queryable with the history operators
            # (latest value, freshness, alerts); a replayed batch rewrites its own rows
            batch_ts = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
            def stamped(rows):
                return rows.withColumn("table", F.lit(table)) \
                    .withColumn("ts", F.lit(batch_ts.isoformat(sep=" ")).cast("timestamp_ntz"))
            if metrics_path:
                replace_batch(stamped(M.run_analyzers(batch, chosen)), metrics_path, batch_id)
            if states_path:
                replace_batch(stamped(ST.metric_states(batch, chosen)), states_path, batch_id)
            if data_path:
                replace_batch(batch, data_path, batch_id)      # T4, replay-safe
            if hours_path:
                append_batch(batch, hours_path, batch_id, batch_ts)
        finally:
            if again:
                batch.unpersist()
    return run


def start_monitor(stream: DataFrame, checkpoint: str, metrics_path: str | None, *, query_name: str = "quality_monitor",
                  analyzers=None, data_path: str | None = None, table: str = "stream",
                  processing_time: str | None = "2 seconds", available_now: bool = False, states_path: str | None = None,
                  hours_path: str | None = None):
    """T2 + T3 + T7: start the monitoring query (processing-time trigger, or
    ``availableNow`` to drain what is there and stop)."""
    w = (stream.writeStream.queryName(query_name).option("checkpointLocation", checkpoint)
         .foreachBatch(batch_metrics_fn(metrics_path, analyzers, data_path, table, states_path, hours_path)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()


def whole_stream(states: DataFrame, analyzers: list) -> DataFrame:
    """Metric rows over all batches (whatever part of the states is given: an hour, a day, everything)."""
    return ST.finish(states, analyzers)


def combine_batches(metrics: DataFrame) -> DataFrame:
    """Whole-stream values of the additive / extremal metrics from per-batch rows:
    Size and Sum add, Minimum / MinLength take the min, Maximum / MaxLength the max.
    Every other metric needs the states of :func:`whole_stream`."""
    v = F.col("value")
    n = F.col("name")
    return (metrics.where(n.isin("Size", "Sum", "Minimum", "Maximum", "MinLength", "MaxLength"))
            .groupBy("entity", "instance", "name")
            .agg(F.when(F.first(n).isin("Size", "Sum"), F.sum(v))
                 .when(F.first(n).isin("Minimum", "MinLength"), F.min(v))
                 .otherwise(F.max(v)).alias("value")))
