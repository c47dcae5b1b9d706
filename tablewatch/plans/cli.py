"""Command-line front end for the jobs, for use with ``spark-submit``.

    spark-submit tablewatch/plans/cli.py profile --table db.t --ts-col date_hour \\
        --at "2024-01-02 04:00:00" --out hdfs:///quality/metrics
    python -m tablewatch.plans.cli suggest --path /data/t --ts-col ts --at "2024-01-10 05:00:00"

Sub-commands: ``profile``, ``suggest``, ``verify``, ``drift``, ``ingest``,
``stream``, ``daily-profile``.  The input table is a catalog name (``--table``) or a path
(``--path`` with ``--format``).  Results are appended to ``--out`` as Parquet;
rule tables live in ``--database``.  The session comes from ``spark-submit``
(``getOrCreate``), so cluster settings, including ``spark.checkpoint.dir``,
are the caller's.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):          # run as a file (spark-submit): make the package importable
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tablewatch.plans import jobs as J  # noqa: E402
from tablewatch.sources.tables import read_catalog, read_path  # noqa: E402


def _source(spark: SparkSession, a) -> DataFrame:
    if a.table:
        return read_catalog(spark, a.table)
    return read_path(spark, a.path, a.format)


def _name(a) -> str:
    return a.table or a.name or a.path.rstrip("/").split("/")[-1]


def _append(df: DataFrame, out: str | None) -> None:
    if out:
        df.write.mode("append").parquet(out)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tablewatch")
    sub = p.add_subparsers(dest="cmd", required=True)

    def table_args(sp, ts=True):
        sp.add_argument("--table", help="catalog table name")
        sp.add_argument("--path", help="table path (with --format)")
        sp.add_argument("--format", default="parquet")
        sp.add_argument("--name", help="table label for results (default: table or last path part)")
        if ts:
            sp.add_argument("--ts-col", default="date_hour")
            sp.add_argument("--at", required=True, help="run time, 'yyyy-MM-dd HH:mm:ss'")

    sp = sub.add_parser("profile", help="metrics of the hour before --at")
    table_args(sp)
    sp.add_argument("--gauges", help="folder of pushed gauge groups (text exposition)")
    sp.add_argument("--out", help="metric history path (appended)")
    sp.add_argument("--separate-sketches", action="store_true",
                    help="distinct-count sketches in their own aggregate (second scan)")

    sp = sub.add_parser("suggest", help="suggest on trailing days, merge, activate, publish")
    table_args(sp)
    sp.add_argument("--read-days", type=int, default=2)
    sp.add_argument("--top-low-ratio", type=float, default=0.8)
    sp.add_argument("--database", default="constraints")

    sp = sub.add_parser("verify", help="verify active rules on the hour before --at")
    table_args(sp)
    sp.add_argument("--gauges", help="folder of pushed gauge groups (text exposition)")
    sp.add_argument("--database", default="constraints")
    sp.add_argument("--out")

    sp = sub.add_parser("drift", help="same-hour drift model: AUC + SHAP attributions")
    table_args(sp)
    sp.add_argument("--gauges", help="folder of pushed gauge groups (text exposition)")
    sp.add_argument("--read-days", type=int, default=3)
    sp.add_argument("--sample-frac", type=float, default=1.0)
    sp.add_argument("--random-state", type=int, default=42)
    sp.add_argument("--test-frac", type=float, default=0.2)
    sp.add_argument("--n-estimators", type=int, default=500)
    sp.add_argument("--max-depth", type=int, default=10)
    sp.add_argument("--early-stopping-rounds", type=int, default=20)
    sp.add_argument("--exclude-cols", default="", help="comma-separated")
    sp.add_argument("--out")

    sp = sub.add_parser("ingest", help="CSV drop -> conformed append -> metrics + write stats")
    sp.add_argument("--csv", required=True)
    sp.add_argument("--schema", required=True, help="StructType JSON document")
    sp.add_argument("--lake", required=True)
    sp.add_argument("--ts", required=True, help="processing time")
    sp.add_argument("--partition-by", default="")
    sp.add_argument("--out", help="metric table path (a rerun for the same time replaces its rows)")
    sp.add_argument("--register-as", help="name of the catalog view of the lake")
    sp.add_argument("--extra", action="append", default=[], metavar="KEY=VALUE", help="kept with the commit")

    sp = sub.add_parser("stream", help="per-micro-batch metrics of a JSON event stream")
    sp.add_argument("--json-dir", help="folder of JSON text files (file source)")
    sp.add_argument("--kafka-servers")
    sp.add_argument("--topic")
    sp.add_argument("--schema-ddl", required=True, help="event schema, e.g. 'ts timestamp, v double'")
    sp.add_argument("--checkpoint", required=True)
    sp.add_argument("--out", required=True, help="metric rows path")
    sp.add_argument("--data-out", help="append the events themselves here")
    sp.add_argument("--hours-out", help="the events themselves, in hour folders")
    sp.add_argument("--events-out", help="progress and lifecycle rows, written while the query runs")
    sp.add_argument("--progress-out", help="flattened progress rows (with --available-now)")
    sp.add_argument("--states-out", help="mergeable metric states per micro-batch")
    sp.add_argument("--trigger", default="2 seconds")
    sp.add_argument("--available-now", action="store_true")

    sp = sub.add_parser("daily-profile", help="one-day profile rows + JSON documents")
    table_args(sp, ts=False)
    sp.add_argument("--ts-col", required=True)
    sp.add_argument("--day", required=True)
    sp.add_argument("--profiling-ts", required=True)
    sp.add_argument("--out-dir")
    sp.add_argument("--profile-path")
    return p


def main(argv=None, spark: SparkSession | None = None) -> DataFrame:
    a = build_parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"tablewatch-{a.cmd}").getOrCreate()
    if a.cmd == "profile":
        out = J.profiling_job(_source(spark, a), _name(a), a.ts_col, a.at, a.out, a.separate_sketches, a.gauges)
    elif a.cmd == "suggest":
        out = J.suggestion_job(spark, _source(spark, a), _name(a), a.ts_col, a.at, a.read_days,
                               a.top_low_ratio, a.database).activated
    elif a.cmd == "verify":
        out = J.verification_job(spark, _source(spark, a), _name(a), a.ts_col, a.at, a.database, gauges_path=a.gauges)
        _append(out, a.out)
    elif a.cmd == "drift":
        out = J.drift_job(_source(spark, a), _name(a), a.ts_col, a.at, a.read_days, a.sample_frac,
                          a.random_state, a.exclude_cols, a.test_frac, a.n_estimators, a.max_depth,
                          a.early_stopping_rounds, a.gauges)
        _append(out, a.out)
    elif a.cmd == "ingest":
        parts = tuple(x.strip() for x in a.partition_by.split(",") if x.strip())
        out = J.ingest_job(spark, a.csv, a.schema, a.lake, a.ts, a.out, parts, a.register_as,
                           dict(x.partition("=")[::2] for x in a.extra))
    elif a.cmd == "stream":
        query = J.stream_job(spark, a.schema_ddl, a.checkpoint, a.out, json_dir=a.json_dir,
                             kafka_servers=a.kafka_servers, topic=a.topic, data_path=a.data_out,
                             processing_time=a.trigger, available_now=a.available_now,
                             progress_path=a.progress_out, states_path=a.states_out,
                             hours_path=a.hours_out, events_path=a.events_out)
        query.awaitTermination()
        out = spark.read.parquet(a.out)
    else:
        out = J.daily_profile_job(_source(spark, a), a.ts_col, a.day, a.profiling_ts, a.out_dir, a.profile_path)
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
