"""Row selection by event time (F1-F4), written as half-open ranges so the
bounds reach the Parquet scan as pushed filters.

Bounds are cast to the column's own type, so ``timestamp`` and
``timestamp_ntz`` columns are both handled without a per-row cast of the data;
only text times and hours of day columns need one.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _as_datetime(at) -> datetime:
    if isinstance(at, datetime):
        return at
    if isinstance(at, date):
        return datetime.combine(at, time())
    return datetime.fromisoformat(str(at).replace("T", " "))


def _bound(df: DataFrame, ts_col: str, value: datetime) -> Column:
    dtype = df.schema[ts_col].dataType
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast(dtype)


def between_times(df: DataFrame, ts_col: str, lo, hi) -> DataFrame:
    """Rows with ``lo <= ts < hi``."""
    lo, hi = _as_datetime(lo), _as_datetime(hi)
    c, kind = F.col(ts_col), df.schema[ts_col].dataType.typeName()
    if kind == "string" or (kind == "date" and (lo.time() != time() or hi.time() != time())):
        # text is read as a time (what is none is in no slice), a day as its midnight
        c = F.expr(f"try_cast(`{ts_col}` as timestamp_ntz)")
        return df.where((c >= F.lit(str(lo)).cast("timestamp_ntz")) & (c < F.lit(str(hi)).cast("timestamp_ntz")))
    return df.where((c >= _bound(df, ts_col, lo)) & (c < _bound(df, ts_col, hi)))


def previous_hour_bounds(at) -> tuple[datetime, datetime]:
    at = _as_datetime(at)
    start = (at - timedelta(hours=1)).replace(minute=0, second=0, microsecond=0)
    return start, start + timedelta(hours=1)


def slice_previous_hour(df: DataFrame, ts_col: str, at) -> DataFrame:
    """the whole hour before ``at`` (crosses midnight: 00:xx -> yesterday 23:00)."""
    lo, hi = previous_hour_bounds(at)
    return between_times(df, ts_col, lo, hi)


def slice_day(df: DataFrame, ts_col: str, day) -> DataFrame:
    """``[day 00:00, day+1 00:00)``."""
    d = _as_datetime(day).replace(hour=0, minute=0, second=0, microsecond=0)
    return between_times(df, ts_col, d, d + timedelta(days=1))


def slice_trailing_days(df: DataFrame, ts_col: str, at, read_days: int = 2) -> DataFrame:
    """the ``read_days`` whole days before the day of ``at``; that day itself is excluded."""
    today = _as_datetime(at).replace(hour=0, minute=0, second=0, microsecond=0)
    return between_times(df, ts_col, today - timedelta(days=read_days), today)


def slice_same_hour_labelled(df: DataFrame, ts_col: str, at, read_days: int = 3,
                             label_col: str = "label") -> DataFrame:
    """the previous hour's hour-of-day on each of the ``read_days`` days before
    ``at`` and on the day of ``at`` itself (``read_days + 1`` dates); ``label`` is 1 on
    the previous hour's date and 0 elsewhere.

    The day range is pushed to the scan; ``hour(ts) = h`` stays a row filter.
    """
    at = _as_datetime(at)
    prev_lo, _ = previous_hour_bounds(at)
    today = at.replace(hour=0, minute=0, second=0, microsecond=0)
    ranged = between_times(df, ts_col, today - timedelta(days=read_days), today + timedelta(days=1))
    target_day = prev_lo.date().isoformat()
    return (ranged
            .where(F.hour(F.col(ts_col)) == prev_lo.hour)
            .withColumn(label_col, F.when(F.to_date(F.col(ts_col)) == F.lit(target_day).cast("date"), 1)
                        .otherwise(0)))
