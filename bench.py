"""Benchmark the headline queries and print ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (timed runs per query, default 5; the median is reported).

Each run forces the full plan with the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["profile_lineitem", "profile_events_hour", "entropy_columns", "suggest_rules", "verify_rules",
            "merge_rules", "activate_rules", "auc_exact", "history_latest", "stratified_split"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    from tablewatch.plans.queries import QUERIES
    from tablewatch.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="tablewatch-bench")
    lineitem_rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    times, errors = {}, {}
    for name in HEADLINE:
        fn = QUERIES[name]
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()   # warm-up
            samples = []
            for _ in range(runs):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(samples), 4)
        except Exception as e:          # report, keep measuring the others
            errors[name] = str(e).splitlines()[0][:200]
    total = round(sum(times.values()), 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total_median_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "lineitem_rows": lineitem_rows,
        "profile_lineitem_rows_per_sec": round(lineitem_rows / times["profile_lineitem"], 1)
        if times.get("profile_lineitem") else None,
    }
    if errors:
        out["errors"] = errors
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
