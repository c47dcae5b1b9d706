"""Mergeable metric states against the metrics of all rows together."""

import random

import pytest
from pyspark.sql import functions as F

from tablewatch.operators import metrics as M
from tablewatch.operators import states as ST
from tablewatch.streaming import monitor as SM


def rows_of(df):
    return {(r["entity"], r["instance"], r["name"]): r["value"] for r in df.collect()}


def analyzers(df):
    return SM.stream_analyzers(df, [("a", "b")], [("positive", "a > 0"), ("short", "length(t) < 3")]) + [M.Uniqueness("t"), M.NullCount("a")]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    rows = [(i, None if rng.random() < 0.2 else 1e6 + rng.random(), None if rng.random() < 0.1 else rng.gauss(i % 5, 2),
             rng.choice(["x", "yy", "zzz", None, "", "hot", "hot", "hot"]), rng.random() < 0.5) for i in range(900)]
    return spark.createDataFrame(rows, "id long, a double, b double, t string, f boolean").cache()


def test_states_of_parts_merge_to_the_whole(spark, table):
    """Uneven parts (one empty, one of a single row, one without values), merged in two steps, equal one pass over all rows;
    the second moment of values near a million keeps its digits."""
    chosen = analyzers(table)
    parts = [table.where("id < 1"), table.where("id between 1 and 99"), table.where("id > 99 and t = 'hot'"), table.limit(0),
             table.where("id > 99 and (t <> 'hot' or t is null)")]
    states = [ST.metric_states(p, chosen) for p in parts]
    early = ST.merge_states(states[0].unionByName(states[1]).unionByName(states[3]))
    got = rows_of(ST.finish(early.unionByName(states[2]).unionByName(states[4]), chosen))
    want = rows_of(M.run_analyzers(table, chosen))
    assert got.keys() == want.keys() and len(want) > 30
    for key, value in want.items():
        if key[2] == "ApproxCountDistinct":
            exact = table.agg(F.count_distinct(key[1])).first()[0]
            assert abs(got[key] - exact) <= max(1, 0.05 * exact)
        else:
            assert got[key] == pytest.approx(value, rel=1e-6, abs=1e-9), key


def test_states_by_group(spark, table):
    """States that carry a group (an hour, say) give the metrics of each group."""
    chosen = [M.Size(), M.StandardDeviation("b"), M.Entropy("t"), M.Correlation("a", "b")]
    parts = [ST.metric_states(table.where(f"id % 3 = {h} and id % 2 = {k}"), chosen).withColumn("hour", F.lit(h)) for h in (0, 1, 2) for k in (0, 1)]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    got = ST.finish(every, chosen, by=["hour"])
    for h in (0, 1, 2):
        want = rows_of(M.run_analyzers(table.where(f"id % 3 = {h}"), chosen))
        assert rows_of(got.where(f"hour = {h}")) == pytest.approx(want)


def test_empty_and_null_states(spark, table):
    """No rows: Size 0 and nothing else.  Columns without values: completeness 0, no moments."""
    chosen = analyzers(table)
    assert rows_of(ST.finish(ST.metric_states(table.limit(0), chosen), chosen)) == {("Dataset", "*", "Size"): 0.0}
    void = table.select("id", *[F.lit(None).cast(table.schema[c].dataType).alias(c) for c in ("a", "b", "t", "f")])
    got, want = rows_of(ST.finish(ST.metric_states(void, chosen), chosen)), rows_of(M.run_analyzers(void, chosen))
    assert {k: v for k, v in got.items() if k[2] != "ApproxCountDistinct"} == {k: v for k, v in want.items() if k[2] != "ApproxCountDistinct"}


def test_a_replayed_batch_changes_nothing(spark, table, tmp_path):
    chosen = analyzers(table)
    write = SM.batch_metrics_fn(None, lambda b: chosen, states_path=str(tmp_path / "s"))
    for batch, part in enumerate([table.where("id < 300"), table.where("id >= 300")]):
        write(part, batch)
    write(table.where("id >= 300"), 1)
    got = rows_of(SM.whole_stream(spark.read.parquet(str(tmp_path / "s")), chosen))
    want = rows_of(M.run_analyzers(table, chosen))
    plain = [k for k in want if k[2] != "ApproxCountDistinct"]
    assert [got[k] for k in plain] == pytest.approx([want[k] for k in plain])


def test_an_unknown_analyzer_is_an_error(spark, table):
    class Other(M.Analyzer):
        column = "a"
    with pytest.raises(ValueError):
        ST.metric_states(table, [Other()])
