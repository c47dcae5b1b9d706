"""Names from paths, key sanitising, timestamp formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File-name suffix of a time-sliced drop, the formatted-time pattern
# and the zone of the zoned variant.
SLICE_SUFFIX = r"_\d{8}_\d{4}-\d{4}$"
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
DISPLAY_ZONE = "Asia/Ho_Chi_Minh"


def table_from_path(path: Column) -> Column:
    """Last path part, cut at the first '.', time-slice suffix removed."""
    last = F.element_at(F.split(path, "/"), -1)
    stem = F.element_at(F.split(last, r"\."), 1)
    return F.regexp_replace(stem, SLICE_SUFFIX, "")


def sanitize_key(c: Column) -> Column:
    """Every character outside ``[a-zA-Z0-9_]`` becomes ``_``."""
    return F.regexp_replace(c, r"[^a-zA-Z0-9_]", "_")


def format_ts(ts: Column, zone: str | None = None) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; with ``zone`` the UTC value is shown in that zone first."""
    if zone:
        ts = F.from_utc_timestamp(ts.cast("timestamp"), zone)
    return F.date_format(ts, TS_FORMAT)
