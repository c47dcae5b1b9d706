"""Islands and rates over ranges, against one walk through every series."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from tablewatch.operators import history as H

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "job string, name string, ts timestamp_ntz, value double"


def walk(rows):
    """(islands of value > 5, rates) of every series by walking it."""
    islands, rates = [], []
    for key, group in itertools.groupby(sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2], r[3])), key=lambda r: r[:2]):
        group, run = list(group), []
        for i, r in enumerate(group):
            if i:
                secs = (r[2] - group[i - 1][2]).total_seconds()
                rates.append((*r, round((r[3] - group[i - 1][3]) / secs, 9) if secs else None))
            if r[3] > 5:
                run.append(r)
            if run and (r[3] <= 5 or i + 1 == len(group)):
                islands.append((*key, run[0][2], run[-1][2], len(run)))
                run = []
    return sorted(islands, key=repr), sorted(rates, key=repr)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_every_number_of_ranges_gives_the_walk(spark, ranges):
    """A hot series with a run over many ranges, series of one row, NULL labels, equal rows (one copied 500 times)."""
    rng = random.Random(7)
    rows = [("hot", "m", T0 + dt.timedelta(seconds=i), 9.0 if 100 < i < 900 else rng.choice([1.0, 7.0])) for i in range(1000)]
    rows += [(f"j{i % 9}" if i % 4 else None, "m", T0 + dt.timedelta(seconds=rng.randrange(60)), float(rng.randrange(10))) for i in range(600)]
    rows += [(f"single{i}", "m", T0, float(i)) for i in range(20)] + [("copies", "m", T0, 8.0)] * 500 + [("copies", "m", T0 + dt.timedelta(seconds=2), 8.5)]
    df = spark.createDataFrame(rows, SCHEMA)
    islands, rates = walk(rows)
    got = H.breach_islands(df, F.col("value") > 5, num_ranges=ranges)
    assert sorted(map(tuple, got.select("job", "name", "start", "end", "n").collect()), key=repr) == islands
    got = H.rate(df, num_ranges=ranges).select("job", "name", "ts", "value", F.round("rate", 9))
    assert sorted(map(tuple, got.collect()), key=repr) == rates


def test_empty_history_and_null_breach(spark):
    df = spark.createDataFrame([("a", "m", T0, None), ("a", "m", T0 + dt.timedelta(seconds=1), 9.0), ("a", "m", T0 + dt.timedelta(seconds=3), None)], SCHEMA)
    assert [tuple(r)[2:] for r in H.breach_islands(df, F.col("value") > 5).collect()] == [(T0 + dt.timedelta(seconds=1), T0 + dt.timedelta(seconds=1), 1)]
    assert [r["rate"] for r in H.rate(df).collect()] == [None, None]
    none = df.limit(0)
    assert H.breach_islands(none, F.col("value") > 5).count() == 0 and H.rate(none).count() == 0


def test_no_join_of_the_history_and_no_python(spark):
    df = spark.createDataFrame([("a", "m", T0, 1.0)], SCHEMA)
    for out in (H.rate(df), H.alert_hold(df, F.col("value") > 5, 10)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan and "Python" not in plan and "InPandas" not in plan
