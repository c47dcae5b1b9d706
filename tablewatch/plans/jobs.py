"""End-to-end jobs: the reference's programs as compositions of the operators.

Every job takes DataFrames / names and an explicit run time (``at``, ``now``),
performs no ``count``/``show`` passes for logging, and writes results as
tables (metric history, rule tables) instead of pushing to a gateway.

* :func:`profiling_job`    previous-hour slice -> metrics -> metric history      (3.1)
* :func:`suggestion_job`   trailing days -> profile -> suggestions -> merge ->
                           activation, published through the rule tables      (3.2)
* :func:`verification_job` previous-hour slice + active rules -> check rows      (3.2)
* :func:`drift_job`        same hour over N days + target day -> AUC + attributions (3.4)
* :func:`ingest_job`       CSV drop -> conform -> commit -> metrics + write stats  (3.4)
* :func:`daily_profile_job` one-day slice -> profile rows + suggestion / profile JSON
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.conform import conform_to_schema, drop_bookkeeping, stamp_processing_time
from ..functions.text import table_from_path
from ..operators import drift as DR
from ..operators import history as H
from ..operators import metrics as M
from ..operators.metrics import ts_lit
from ..operators import profile as PR
from ..operators import rules as RL
from ..operators import slices as S
from ..operators import suggest as SG
from ..operators import verify as V
from ..sinks import append_metrics, push_gauges, replace_run, write_json_documents
from ..sinks import lake as LK
from ..sources import commits as CM
from ..sources import csv as CSV


INGEST_SCHEMA = ("type string, column string, metric string, value double, value_str string, ts timestamp, path string, "
                 "table string")
# The label sets of the gauges each job pushes.
PROFILE_LABELS = ("table", "entity", "instance", "name")
VERIFY_LABELS = ("table", "check_level", "constraint_name", "constraint_message")
DRIFT_LABELS = ("table", "metric_type", "instance", "metric")


def push(metrics: DataFrame, labels: tuple[str, ...], job: str, table: str, path: str | None, value: str = "value") -> None:
    """The gauge ``job`` with the given labels, pushed to the (job, table) group below ``path``."""
    if path:
        push_gauges(H.exposition(metrics, F.lit(job), labels, value, None), path, job, table)


def profiling_job(df: DataFrame, table: str, ts_col: str, at, metrics_path: str | None = None,
                  separate_sketches: bool = False, gauges_path: str | None = None, job: str = "data_profiling") -> DataFrame:
    """Hourly profiling: metrics of the hour before ``at``; appended to the history and
    pushed as gauges if paths are given."""
    sl = S.slice_previous_hour(df, ts_col, at)
    lo, _ = S.previous_hour_bounds(at)
    m = M.as_history_rows(M.profile_metrics(sl, separate_sketches), sl, ts=at, table=table, slice_start=lo)
    if metrics_path:
        append_metrics(m, metrics_path)
    push(m.withColumnRenamed("metric", "name"), PROFILE_LABELS, job, table, gauges_path)
    return m


@dataclass
class SuggestionRun:
    suggestions: DataFrame
    activated: DataFrame


def suggestion_job(spark: SparkSession, df: DataFrame, table: str, ts_col: str, at, read_days: int = 2,
                   top_low_ratio: float = RL.TOP_LOW_RATIO, database: str = "constraints",
                   rules=SG.DEFAULT_RULES) -> SuggestionRun:
    """Suggest on the trailing days, merge into the activated table, re-activate, publish."""
    sl = S.slice_trailing_days(df, ts_col, at, read_days)
    sugg = SG.suggest_constraints(PR.profile_columns(sl), rules)
    suggested, activated = RL.table_names(table, database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    RL.save_suggestions(spark, sugg, suggested)
    RL.create_rule_table(spark, activated)
    merged = RL.merge_rules(RL.new_rules(spark.table(suggested), at), spark.table(activated), at)
    # merge and activation are published together: one tmp write, one swap
    act = RL.activate_rules(merged, top_low_ratio, now=at)
    RL.swap_publish(spark, act, activated)
    return SuggestionRun(spark.table(suggested), spark.table(activated))


def verification_job(spark: SparkSession, df: DataFrame, table: str, ts_col: str, at,
                     database: str = "constraints", check: str = "tablewatch_verification",
                     gauges_path: str | None = None, job: str = "constraints_verification") -> DataFrame:
    """Verify the active rules of ``table`` on the hour before ``at``; gauges are 1 for success and 0 for failure."""
    _, activated = RL.table_names(table, database)
    rules = V.read_active_rules(spark.table(activated))
    res = V.verify_frame(S.slice_previous_hour(df, ts_col, at), rules, check=check)
    res = res.withColumn("table", F.lit(table)).withColumn("ts", ts_lit(at))
    push(res.withColumnRenamed("constraint", "constraint_name"), VERIFY_LABELS, job, table, gauges_path, "status_value")
    return res


def drift_job(df: DataFrame, table: str, ts_col: str, at, read_days: int = 3, sample_fraction: float = 1.0,
              seed: int = 42, exclude=(), test_fraction: float = 0.2, max_iter: int = 500,
              max_depth: int = 10, early_stopping_rounds: int = 20, gauges_path: str | None = None,
              job: str = "anomaly_detection") -> DataFrame:
    """Same hour on the previous ``read_days`` days and the run day, target day labelled 1."""
    from ..operators.sampling import sample_by_label
    if isinstance(exclude, str):           # "a, b" as given in a job configuration
        exclude = tuple(x.strip() for x in exclude.split(",") if x.strip())
    sl = S.slice_same_hour_labelled(df, ts_col, at, read_days)
    sl = sample_by_label(sl, "label", sample_fraction, seed)
    res = DR.detect_drift(sl, table, exclude=("label", ts_col, *DR.DEFAULT_EXCLUDE, *exclude),
                          test_fraction=test_fraction, seed=seed, max_iter=max_iter, max_depth=max_depth,
                          early_stopping_rounds=early_stopping_rounds)
    push(res.metrics.withColumnRenamed("type", "metric_type"), DRIFT_LABELS, job, table, gauges_path)
    return res.metrics


def ingest_job(spark: SparkSession, csv_path: str, schema_path: str, lake_path: str, ts,
               metrics_path: str | None = None, partition_by: tuple[str, ...] = (), register_as: str | None = None,
               extra: dict[str, str] | None = None) -> DataFrame:
    """CSV drop -> conform to the schema document -> commit to the lake -> data metrics + write stats.

    The conformed frame is written once and the metrics are computed from the commit as
    written, so the CSV text is parsed only once; the sketches have an aggregate of their own
    over the commit, which leaves the other metrics code-generated.  A rerun for the same ``ts``
    replaces the rows and the metrics of the earlier run.  With ``register_as`` the lake becomes a
    view of the catalog; ``extra`` goes into the commit and its metric rows.  An empty drop commits
    nothing and gives no rows."""
    raw = CSV.read_csv_text(spark, csv_path)
    if CSV.is_empty(raw):
        return spark.createDataFrame([], INGEST_SCHEMA)
    conformed = stamp_processing_time(drop_bookkeeping(conform_to_schema(raw, CSV.load_schema(spark, schema_path))),
                                      ts)
    table = spark.range(0, 1, 1, 1).select(table_from_path(F.lit(csv_path))).first()[0]
    commit_id = LK.commit_name(ts)
    written = LK.commit(conformed, lake_path, commit_id, partition_by, extra=extra)
    if register_as:
        LK.register(spark, lake_path, register_as, conformed.schema, partition_by)
    data_metrics = M.with_entity_type(M.profile_metrics(written, separate_sketches=True)).select(
        F.col("type"), F.col("instance").alias("column"), F.col("name").alias("metric"), "value",
        F.col("value").cast("string").alias("value_str"))
    stats = LK.commit_files(spark, lake_path, commit_id)
    commit = CM.write_stat_metrics(stats).unionByName(CM.commit_summary_metrics(stats, extra=extra))
    out = (data_metrics.unionByName(commit)
           .withColumn("ts", ts_lit(ts)).withColumn("path", F.lit(csv_path))
           .withColumn("table", F.lit(table)))
    if metrics_path:
        replace_run(out, metrics_path, f"{table}-{commit_id}")
    return out


def daily_profile_job(df: DataFrame, ts_col: str, day, profiling_ts, out_dir: str | None = None,
                      profile_path: str | None = None) -> DataFrame:
    """One-day slice -> column profile rows, appended to ``profile_path`` (K3); with
    ``out_dir`` also the profile and the suggestions as JSON documents (K4)."""
    sl = S.slice_day(df, ts_col, day)
    prof = PR.profile_columns(sl)
    rows = PR.profile_rows(prof, profiling_ts, f"{day} 00:00:00")
    if profile_path:
        rows.write.mode("append").parquet(profile_path)
    if out_dir:
        write_json_documents(prof.frame, f"{out_dir}/profiling_{day}")
        write_json_documents(SG.suggest_constraints(prof), f"{out_dir}/suggestions_{day}")
    return rows


def stream_job(spark: SparkSession, schema, checkpoint: str, metrics_path: str, *, json_dir: str | None = None,
               kafka_servers: str | None = None, topic: str | None = None, data_path: str | None = None,
               table: str = "stream", query_name: str = "quality_monitor", processing_time: str = "2 seconds",
               available_now: bool = False, max_files_per_trigger: int | None = None,
               progress_path: str | None = None, states_path: str | None = None, hours_path: str | None = None,
               events_path: str | None = None):
    """The streaming monitor: JSON events from a folder or a Kafka topic -> per-micro-batch
    metrics (entropy, correlations and compliance rules included; the smart-home
    rule set when the schema has its columns) -> metric rows keyed by batch id,
    optionally the events themselves.  With ``states_path`` the mergeable states of every
    micro-batch are kept, from which ``monitor.whole_stream`` gives exact metrics of any
    stretch of the stream; with ``hours_path`` the events in hour folders.  With ``events_path``
    progress and lifecycle rows are written while the query runs (``listener.EventSink``, which goes
    when the query ends).  With ``progress_path`` the progress of every
    micro-batch is recorded and, after the query stops, flattened to numeric rows."""
    from ..streaming import listener as SL
    from ..streaming import monitor as SMON
    if kafka_servers:
        stream = SMON.read_kafka_stream(spark, kafka_servers, topic, schema)
    else:
        stream = SMON.read_json_stream(spark, json_dir, schema, max_files_per_trigger)
    recorder = None
    if progress_path:
        recorder = SL.ProgressRecorder()
        spark.streams.addListener(recorder)
    if events_path:
        SL.EventSink(spark, events_path, query_name, close_after_end=True).open()
    query = SMON.start_monitor(stream, checkpoint, metrics_path, query_name=query_name,
                               analyzers=SMON.smart_home_analyzers, data_path=data_path, table=table,
                               processing_time=processing_time, available_now=available_now, states_path=states_path,
                               hours_path=hours_path)
    if recorder is not None and available_now:
        import time
        query.awaitTermination()
        expected = (query.lastProgress or {}).get("batchId", -1) + 1
        deadline = time.time() + 30            # listener events arrive asynchronously
        while len(recorder.progress) < expected and time.time() < deadline:
            time.sleep(0.2)
        spark.streams.removeListener(recorder)
        progress, _ = recorder.drain()
        if progress:
            SL.progress_metrics(SL.progress_frame(spark, progress)).write.mode("append").parquet(progress_path)
    return query
