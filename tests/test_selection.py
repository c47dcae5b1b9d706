"""Exact cuts found by counting, against sorting."""

import random

import pytest
from pyspark.sql import functions as F

from tablewatch.operators import selection as SE
from tablewatch.operators.rules import activate_rules
from tablewatch.operators.sampling import stratified_split


def test_nth_key_is_that_of_the_sorted_rows(spark, monkeypatch):
    """Brackets of a sample, hot values, NULLs and every kind of place: ends, inside a tie, none."""
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 5, 5, 5, 5, rng.randint(0, 40)]), rng.choice([None, "", "é", "a", f"k{rng.randint(0, 30)}"]), i % 3) for i in range(4000)]
    df = spark.createDataFrame(rows, "f int, k string, x int").cache()
    key = SE.sort_key({"f": False, "k": True}, {"f": False, "k": True})
    want = sorted(((f is None, -(f or 0), k is not None, (k or "").encode()) for f, k, _ in rows))
    monkeypatch.setattr(SE, "FEW", 300)
    monkeypatch.setattr(SE, "SAMPLE", 60)
    for n in (1, 2, 777, 2000, 3999, 4000):
        last = SE.nth_key(df, key, n, 4000)
        got = df.where(key <= last).count(), df.where(key < last).count()
        assert got == (sum(w <= want[n - 1] for w in want), sum(w < want[n - 1] for w in want)), n
    assert SE.nth_key(df, key, 0, 4000) is None and SE.nth_key(df, key, 1, 0) is None


def test_activation_by_the_found_key(spark, monkeypatch):
    rows = [(f"r{i}", None if i % 7 == 0 else f"c{i % 5}", f"code{i}", "high" if i % 11 == 0 else None if i % 13 == 0 else "low", None if i % 17 == 0 else i % 6)
            for i in range(1500)]
    df = spark.createDataFrame(rows, "constraint_name string, column_name string, code_for_constraint string, level string, frequency int")
    others = [r for r in rows if r[3] != "high"]
    others.sort(key=lambda r: (r[4] is None, -(r[4] or 0), r[0], r[1] is not None, r[1] or "", r[2]))
    for few, share in ((100_000, 0.8), (200, 0.8), (200, 0.0), (200, 1.0), (200, 0.31)):
        monkeypatch.setattr(SE, "FEW", few)
        on = {r[0] for r in others[:int(len(others) * share)]} | {r[0] for r in rows if r[3] == "high"}
        got = activate_rules(df, share)
        assert {r[0] for r in got.where("active = 1").collect()} == on and got.count() == len(rows)
    assert activate_rules(df.limit(0)).count() == 0


def brute_split(rows, share):
    out = set()
    for label in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == label), key=lambda r: r[2])
        out |= {r[0] for r in mine[:int(len(mine) * share + 0.5)]}
    return out


def test_split_takes_the_smallest_places(spark):
    """Places that agree in their leading bits, negative ones, a hot label, NULL and single-row labels."""
    rng = random.Random(2)
    rows = [(i, rng.choice(["hot"] * 6 + [None, "b", f"l{i % 40}"]), (rng.choice([5, -5, rng.getrandbits(15) - 2**14]) << 48) + (rng.choice([3, rng.getrandbits(24)]) << 24) + i)
            for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, label string, h long")
    for share in (0.0, 0.2, 0.5, 1.0):
        got = stratified_split(df, "label", share, place=F.col("h"))
        assert {r["id"] for r in got.where("is_test").collect()} == brute_split(rows, share)
        assert got.count() == 3000 and got.columns == ["id", "label", "h", "is_test"] and got.where("is_test is null").count() == 0


def test_split_of_many_labels_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(SE, "GROUPS_SENT", 3)
    rows = [(i, None if i % 50 == 0 else f"l{i % 50}", (i * 7919) % 100_003) for i in range(2000)]
    got = stratified_split(spark.createDataFrame(rows, "id long, label string, h long"), "label", 0.3, place=F.col("h"))
    assert {r["id"] for r in got.where("is_test").collect()} == brute_split(rows, 0.3)


@pytest.mark.parametrize("share", [0.2, 0.35])
def test_rows_of_one_key_are_divided(spark, share):
    """A third of the rows share their key: the counts per label are still exact."""
    df = spark.range(3000).select("id", (F.col("id") % 2).alias("label"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("key"))
    got = {(r["label"], r["is_test"]): r["count"] for r in stratified_split(df, "label", share, 3, ["key"]).groupBy("label", "is_test").count().collect()}
    assert all(got[label, True] == int(1500 * share + 0.5) and got[label, False] == 1500 - int(1500 * share + 0.5) for label in (0, 1))


def test_no_shuffle_of_the_table(spark):
    split = stratified_split(spark.range(1000).withColumn("label", F.col("id") % 2), "label", 0.2)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "rangepartitioning" not in plan and "MapIn" not in plan
