"""Per-query plan statistics: median warm time, table scans, shuffles, broadcasts and
reads of checkpointed data (the materialised Arrow pass of the running sums), read
from the executed physical plans.  With ``--event-log DIR`` Spark's event log is
written to DIR and summarised per query: jobs, stages, tasks and summed task time.

usage: python tools/plan_stats.py [sf_dir] [runs] [--event-log DIR]  -> markdown on stdout
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from tablewatch.plans.queries import QUERIES  # noqa: E402


def plan_counts(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]          # AQE prints the final plan first
    return {
        "scans": len(re.findall(r"FileScan parquet", plan)),
        "checkpoint_reads": len(re.findall(r"Scan ExistingRDD|LogicalRDD", plan)),
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
    }


def _lines(path: str):
    """Lines of an event-log file (Spark 4 writes zstd-compressed rolling files)."""
    if path.endswith(".zstd"):
        import io
        import zstandard
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path) as fh:
            yield from fh


def event_log_summary(log_dir: str) -> dict:
    """Per job group: jobs, stages, tasks, summed task run time (ms)."""
    out: dict = {}
    stage_group: dict = {}
    for path in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True):
        for line in _lines(path):
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if not group:
                        continue
                    g = out.setdefault(group, {"jobs": 0, "stages": 0, "tasks": 0, "task_ms": 0})
                    g["jobs"] += 1
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    group = stage_group.get(info["Stage ID"])
                    if group:
                        out[group]["stages"] += 1
                        out[group]["tasks"] += info.get("Number of Tasks", 0)
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    if group:
                        out[group]["task_ms"] += (ev.get("Task Metrics") or {}).get("Executor Run Time", 0)
    return out


def main():
    args = [a for a in sys.argv[1:]]
    log_dir = None
    if "--event-log" in args:
        i = args.index("--event-log")
        log_dir = args[i + 1]
        del args[i:i + 2]
    sf = args[0] if args else "/root/testdata/sf0.1"
    runs = int(args[1]) if len(args) > 1 else 5
    from pyspark.sql import SparkSession
    from tablewatch.session import local_session
    if log_dir:
        os.makedirs(log_dir, exist_ok=True)
        SparkSession.builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
    spark = local_session(8, shuffle_partitions=8) if not log_dir else (
        SparkSession.builder.master("local[8]").config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir).config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    sc = spark.sparkContext
    rows = []
    for name in HEADLINE:
        fn = QUERIES[name]
        sc.setJobGroup(f"warmup-{name}", "warm-up")
        fn(spark, sf).write.format("noop").mode("overwrite").save()
        samples, df = [], None
        for r in range(runs):
            sc.setJobGroup(name if r == runs - 1 else f"run-{name}", name)
            t0 = time.perf_counter()
            df = fn(spark, sf)
            df.write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        rows.append((name, statistics.median(samples), plan_counts(df)))
    summary = {}
    if log_dir:
        spark.stop()
        summary = event_log_summary(log_dir)
    extra = " | jobs | stages | tasks | task time s" if log_dir else ""
    print(f"| query | median s ({runs} warm runs) | parquet scans | shuffles | broadcasts | checkpoint reads{extra} |")
    print("|---|---|---|---|---|---|" + ("---|---|---|---|" if log_dir else ""))
    for name, med, c in rows:
        cells = f"| {name} | {med:.3f} | {c['scans']} | {c['shuffles']} | {c['broadcasts']} | {c['checkpoint_reads']}"
        if log_dir:
            g = summary.get(name, {})
            cells += (f" | {g.get('jobs', 0)} | {g.get('stages', 0)} | {g.get('tasks', 0)} "
                      f"| {g.get('task_ms', 0) / 1000:.2f}")
        print(cells + " |")


if __name__ == "__main__":
    main()
