"""Queries over the metric history (the dashboard panels as Spark queries, D1-D12,
J2, J3, O2, O3) and the labelled text exposition (K5).

The history holds one row per (series labels, ts).  Every "latest value"
panel is a ``max_by`` aggregation (partial aggregation, so a series with a
third of the rows costs one row per task before the shuffle); windows are
avoided.  Orderings inside a series (islands, rates) cut the ordered rows into ranges:
windows run per (range, series), and one row per range carries over to the next.
"""

from __future__ import annotations

from datetime import timedelta
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .slices import _as_datetime, _bound

SERIES = ["job", "table", "entity", "instance", "name"]


def normalize(history: DataFrame) -> DataFrame:
    """Accept the unified history layout (``metric`` column) as well as gauge-style
    rows (``name`` column)."""
    if "name" not in history.columns and "metric" in history.columns:
        return history.withColumnRenamed("metric", "name")
    return history


def latest(history: DataFrame, keys: Sequence[str] | None = None, ts: str = "ts",
           value: str = "value") -> DataFrame:
    """Last value per series (ties on ts broken by the larger value); default series
    keys are the label columns of :data:`SERIES` present in ``history``."""
    history = normalize(history)
    keys = [k for k in SERIES if k in history.columns] if keys is None else list(keys)
    last = F.max_by(F.struct(F.col(ts).alias("ts"), F.col(value).alias("value")),
                    F.struct(F.col(ts), F.col(value)))
    return history.groupBy(*keys).agg(last.alias("_l")).select(*keys, "_l.ts", "_l.value")


def time_range(history: DataFrame, now, hours: float, ts: str = "ts") -> DataFrame:
    """Rows with ``now - hours < ts <= now``."""
    now = _as_datetime(now)
    c = F.col(ts)
    return history.where((c > _bound(history, ts, now - timedelta(hours=hours))) & (c <= _bound(history, ts, now)))


def _push_keys(df: DataFrame, keys) -> list[str]:
    if keys is not None:
        return list(keys)
    return ["job"] if "job" in df.columns else ["table"]


def fresh(history: DataFrame, pushes: DataFrame, now, max_age_hours: float,
          keys: Sequence[str] | None = None, ts: str = "ts") -> DataFrame:
    """Keep rows whose push group (default: job, or table when rows carry no job)
    pushed within ``max_age_hours`` of ``now``."""
    keys = _push_keys(history, keys)
    now = _as_datetime(now)
    recent = pushes.where(F.col(ts) >= _bound(pushes, ts, now - timedelta(hours=max_age_hours))).select(*keys)
    return history.join(*_null_safe(history, recent, keys), "left_semi")


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``right`` with its keys renamed, and the condition that they equal those of ``left`` (NULL equals NULL)."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return renamed, cond


def push_times(history: DataFrame, keys: Sequence[str] | None = None, ts: str = "ts") -> DataFrame:
    """Last push time per group (default: job, or table when rows carry no job)."""
    return history.groupBy(*_push_keys(history, keys)).agg(F.max(ts).alias(ts))


def select_series(history: DataFrame, **labels) -> DataFrame:
    """Equality selectors; a value starting with ``~`` is a full-match regex."""
    out = history
    for k, v in labels.items():
        if isinstance(v, str) and v.startswith("~"):
            out = out.where(F.col(k).rlike(f"^(?:{v[1:]})$"))
        else:
            out = out.where(F.col(k) == v)
    return out


def null_percent(history: DataFrame, keys: Sequence[str] = ("table", "instance")) -> DataFrame:
    """D6 + P25: latest ``1 - Completeness`` per column."""
    history = normalize(history)
    comp = latest(history.where(F.col("name") == "Completeness"), keys)
    return comp.select(*keys, (F.lit(1.0) - F.col("value")).alias("null_pct"))


def max_null_percent(history: DataFrame) -> DataFrame:
    """D4 + A23: worst null share per table."""
    return null_percent(history).groupBy("table").agg(F.max("null_pct").alias("max_null_pct"))


def column_counts(history: DataFrame) -> DataFrame:
    """D3 + A22: columns, numeric columns and string columns per table, witnessed by
    Completeness, Maximum and MaxLength rows of columns."""
    inst = F.col("instance")
    return normalize(history).where(F.col("entity") == "Column").groupBy("table").agg(
        F.count_distinct(F.when(F.col("name") == "Completeness", inst)).alias("n_columns"),
        F.count_distinct(F.when(F.col("name") == "Maximum", inst)).alias("n_numeric"),
        F.count_distinct(F.when(F.col("name") == "MaxLength", inst)).alias("n_string"))


def wide(history: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ("table", "instance")) -> DataFrame:
    """Latest value of each metric as its own column (pivot with a fixed value list)."""
    history = normalize(history)
    last = latest(history.where(F.col("name").isin(list(metrics))), [*keys, "name"])
    return last.groupBy(*keys).pivot("name", list(metrics)).agg(F.first("value"))


def tables(history: DataFrame) -> DataFrame:
    """The table picker."""
    return history.select("table").distinct()


def latest_status(results: DataFrame, keys: Sequence[str] = ("constraint",), ts: str = "ts") -> DataFrame:
    """Latest verification row per constraint (newest first when ordered by ts desc)."""
    cols = [c for c in results.columns if c not in keys]
    last = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(ts), *[F.col(c) for c in cols]))
    return results.groupBy(*keys).agg(last.alias("_l")).select(*keys, "_l.*")


def share_of_total(df: DataFrame, value: str = "value", group: Sequence[str] = ("table",),
                   out: str = "share") -> DataFrame:
    """O3: ``value / sum(value)`` within each group; the group totals (one row per
    group) are joined back on the group key instead of a window over the group."""
    totals = df.groupBy(*group).agg(F.sum(value).alias("_total"))
    right, same = _null_safe(df, totals, group)
    return df.join(right, same).withColumn(out, F.col(value) / F.col("_total")) \
        .drop("_total", *[f"_r_{k}" for k in group])


def drift_verdict(metric: Column, threshold: float = 0.6) -> Column:
    """M6: AUC at or above the threshold means the slice drifted."""
    return F.when(metric >= threshold, F.lit("drift")).otherwise(F.lit("ok"))


def _series(history: DataFrame, series) -> list[str]:
    return [k for k in SERIES if k in history.columns] if series is None else list(series)


def _in_ranges(history: DataFrame, series: Sequence[str], order: Sequence[str], num_ranges: int | None = None) -> DataFrame:
    """The rows of every series in order, cut into ranges: distinct rows with their number ``_n``, their range ``_pid``
    and the row before them in their series, ``_before`` (NULL at its start).

    Equal rows are counted first, so no number of them is one range.  Ranges are written before they are numbered.
    Inside a range a window per (range, series) finds the row before; what a range's first rows lack is the last row of
    the range before it, one row per range for all of them.
    """
    spark = history.sparkSession
    ensure_checkpoint_dir(spark)
    tasks = int(num_ranges or spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(f"`{c}`") for c in (*series, *order)]
    rows = history.groupBy(*series, *order).agg(F.count("*").alias("_n"))
    ranged = rows.repartitionByRange(tasks, *keys).withColumn("_pid", F.spark_partition_id()).checkpoint()
    last = ranged.groupBy("_pid").agg(F.max(F.struct(F.struct(*keys[:len(series)]).alias("s"), F.struct(*keys[len(series):]).alias("r"))).alias("_last"))
    carried = last.select("_pid", F.lag("_last").over(Window.orderBy("_pid")).alias("_carried"))          # a row per range
    within = Window.partitionBy("_pid", *series).orderBy(*order)
    mine = F.struct(*keys[:len(series)])
    out = ranged.withColumn("_lag", F.lag(F.struct(*keys[len(series):])).over(within)).join(F.broadcast(carried), "_pid", "left")
    carry = F.when(F.col("_carried.s").eqNullSafe(mine), F.col("_carried.r"))
    return out.withColumn("_before", F.coalesce("_lag", carry)).drop("_lag", "_carried")


def breach_islands(history: DataFrame, breach: Column, series: Sequence[str] | None = None,
                   ts: str = "ts", num_ranges: int | None = None) -> DataFrame:
    """Runs of consecutive breaching rows per series (gaps-and-islands); rows of one time are taken by rising value,
    then those that don't breach first.  A NULL breach is none.

    Runs are numbered inside each range; a run that a range begins with without starting it belongs to the run that an
    earlier range ends with, which one row per range tells.
    """
    history = normalize(history)
    series = _series(history, series)
    flagged = history.withColumn("_b", F.coalesce(breach, F.lit(False)).cast("int"))
    rows = _in_ranges(flagged, series, [ts, "value", "_b"], num_ranges)
    starts = ((F.col("_b") == 1) & (F.coalesce(F.col("_before._b"), F.lit(0)) == 0)).cast("int")
    within = Window.partitionBy("_pid", *series).orderBy(ts, "value", "_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = rows.withColumn("_run", F.sum(starts).over(within)).checkpoint()       # read for the runs and for the ends
    pieces = numbered.where("_b = 1").groupBy("_pid", *series, "_run").agg(
        F.min(ts).alias("start"), F.max(ts).alias("end"), F.sum("_n").alias("n"))
    order = F.struct(F.struct(*[F.col(f"`{c}`") for c in series]), F.col(ts), F.col("value"), F.col("_b"))
    ends = numbered.groupBy("_pid").agg(F.max_by(F.struct("_b", "_run"), order).alias("_end"))
    begun = F.when((F.col("_end._b") == 1) & (F.col("_end._run") > 0), F.struct(F.col("_pid").alias("p"), F.col("_end._run").alias("r")))
    origin = ends.select("_pid", F.last(begun, ignorenulls=True).over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)).alias("_origin"))
    whole = pieces.join(F.broadcast(origin), "_pid", "left").withColumn(
        "_key", F.when(F.col("_run") > 0, F.struct(F.col("_pid").alias("p"), F.col("_run").alias("r"))).otherwise(F.col("_origin")))
    return whole.groupBy(*series, "_key").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("n")).drop("_key")


def alert_hold(history: DataFrame, breach: Column, hold_seconds: float, series: Sequence[str] | None = None,
               ts: str = "ts") -> DataFrame:
    """Alerts firing: a breach run lasting at least ``hold_seconds``."""
    isl = breach_islands(history, breach, series, ts)
    dur = F.expr("timestampdiff(MICROSECOND, `start`, `end`)") / 1e6
    return isl.where(dur >= hold_seconds).withColumn("held_seconds", dur)


def absent(expected: DataFrame, present: DataFrame, series: Sequence[str] | None = None) -> DataFrame:
    """D12 ``absent``: expected series with no row in ``present``."""
    expected, present = normalize(expected), normalize(present)
    series = _series(expected, series)
    wanted = expected.select(*series).distinct()
    return wanted.join(*_null_safe(wanted, present.select(*series), series), "left_anti")


def rate(history: DataFrame, series: Sequence[str] | None = None, ts: str = "ts",
         value: str = "value", num_ranges: int | None = None) -> DataFrame:
    """D12 ``rate``: change per second between consecutive rows of a series (rows of one time by rising value; between
    rows of one time the rate is NULL).  One window per range, no join of the history with itself."""
    history = normalize(history)
    series = _series(history, series)
    rows = _in_ranges(history, series, [ts, value], num_ranges).withColumnsRenamed({ts: "_ts", value: "_value"})
    secs = F.expr("timestampdiff(MICROSECOND, _pts, _ts)") / 1e6
    first = rows.withColumn("_pts", F.col("_before")[ts]).withColumn("_pv", F.col("_before")[value])
    change = F.when(F.col("_before").isNotNull(), F.struct(F.try_divide(F.col("_value") - F.col("_pv"), secs).alias("rate")))
    # equal rows: the first follows the row before them, the others follow an equal one
    equal = F.array_repeat(F.struct(F.lit(None).cast("double").alias("rate")), (F.col("_n") - 1).cast("int"))
    each = F.when(F.col("_before").isNotNull(), F.concat(F.array(change), equal)).otherwise(equal)
    return first.select(*series, F.col("_ts").alias(ts), F.col("_value").alias(value), F.inline(each))


# ------------------------------------------------------------------ K5

def _esc(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    c = F.replace(c, F.lit('"'), F.lit('\\"'))
    return F.replace(c, F.lit("\n"), F.lit("\\n"))


def exposition(metrics: DataFrame, metric_name: Column, labels: Sequence[str], value: str = "value",
               value_format: str | None = "%.6f") -> DataFrame:
    """K5: one text line per metric row, ``name{l1="v1",...} value``, label values escaped.
    Without a ``value_format`` the value is the shortest text that reads as the same double."""
    from .. functions.text import sanitize_key
    parts = []
    for i, l in enumerate(labels):
        parts.append(F.concat(F.lit(("," if i else "") + f'{l}="'), F.coalesce(_esc(F.col(l)), F.lit("")),
                              F.lit('"')))
    number = F.col(value).cast("double")
    text = number.cast("string") if value_format is None else F.format_string(value_format, number)
    line = F.concat(sanitize_key(metric_name), F.lit("{"), *parts, F.lit("} "),
                    F.coalesce(F.when(F.col(value).isNotNull(), text), F.lit("NaN")))
    return metrics.select(line.alias("line"))
