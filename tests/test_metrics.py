import math
from decimal import Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import metric_map
from tablewatch.operators import metrics as M


def test_empty_slice_has_only_size(spark):
    df = spark.createDataFrame([], "a int, s string")
    m = metric_map(M.profile_metrics(df))
    assert m == {("Dataset", "*", "Size"): 0.0}


def test_all_null_column_metrics_absent(spark):
    df = spark.createDataFrame([(None, "x"), (None, "yy")], "a int, s string")
    m = metric_map(M.profile_metrics(df, approx_distinct=False))
    assert m[("Column", "a", "Completeness")] == 0.0
    assert ("Column", "a", "Minimum") not in m and ("Column", "a", "Mean") not in m
    assert m[("Column", "s", "MinLength")] == 1.0 and m[("Column", "s", "MaxLength")] == 2.0


def test_single_row(spark):
    df = spark.createDataFrame([(5, "abc")], "a long, s string")
    m = metric_map(M.profile_metrics(df, std_dev=True))
    assert m[("Dataset", "*", "Size")] == 1.0
    assert m[("Column", "a", "StandardDeviation")] == 0.0
    assert m[("Column", "a", "ApproxCountDistinct")] == 1.0


def test_other_types_get_only_base_metrics(spark):
    df = spark.createDataFrame([(Decimal("1.50"), True, [1, 2], {"k": 1})],
                               "d decimal(10,2), b boolean, arr array<int>, mp map<string,int>")
    m = metric_map(M.profile_metrics(df))
    names = {(i, n) for (_, i, n) in m}
    assert ("d", "Sum") in names and m[("Column", "d", "Sum")] == 1.5        # decimal is numeric
    assert {n for (i, n) in names if i == "b"} == {"Completeness", "ApproxCountDistinct"}
    assert {n for (i, n) in names if i == "arr"} == {"Completeness", "ApproxCountDistinct"}
    assert {n for (i, n) in names if i == "mp"} == {"Completeness", "ApproxCountDistinct"}


def test_compliance_null_is_not_compliant(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,), (3,)], "x int")
    m = metric_map(M.run_analyzers(df, [M.Compliance("pos", "x >= 0")]))
    assert m[("Column", "pos", "Compliance")] == 0.5


def test_entropy_and_uniqueness_match_brute_force(spark):
    vals = ["a", "a", "b", "c", "c", "c", None, "d"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    m = metric_map(M.run_analyzers(df, [M.Entropy("v"), M.Uniqueness("v")]))
    nn = [v for v in vals if v is not None]
    counts = {v: nn.count(v) for v in set(nn)}
    ent = -sum(c / len(nn) * math.log(c / len(nn)) for c in counts.values())
    assert abs(m[("Column", "v", "Entropy")] - ent) < 1e-12
    assert m[("Column", "v", "Uniqueness")] == 2 / 7


def test_correlation_pairwise_non_null(spark):
    rows = [(1.0, 2.0), (2.0, 4.1), (3.0, None), (4.0, 8.2), (None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    m = metric_map(M.run_analyzers(df, [M.Correlation("a", "b")]))
    assert abs(m[("Multicolumn", "a,b", "Correlation")] - 1.0) < 1e-3


def test_one_scan_aggregate_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = M.scan_metrics(df, M.default_analyzers(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), max_size=30))
def test_completeness_properties(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    m = metric_map(M.run_analyzers(df, [M.Size(), M.Completeness("x"), M.NullCount("x")]))
    size = m[("Dataset", "*", "Size")]
    assert size == len(values)
    if values:
        c = m[("Column", "x", "Completeness")]
        assert 0.0 <= c <= 1.0
        assert m[("Column", "x", "NullCount")] + round(c * size) == size


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(-1e3, 1e3, allow_nan=False)),
                          st.one_of(st.none(), st.sampled_from(["a", "bb", "", "c'd", "e\\\\f"]))),
                min_size=1, max_size=40))
def test_metrics_match_pandas(spark, rows):
    import numpy as np
    import pandas as pd
    df = spark.createDataFrame(rows, "x double, s string")
    m = metric_map(M.profile_metrics(df, approx_distinct=False, std_dev=True, entropy=True))
    pdf = pd.DataFrame(rows, columns=["x", "s"])
    x = pdf["x"].dropna()
    assert m[("Column", "x", "Completeness")] == len(x) / len(pdf)
    if len(x):
        assert abs(m[("Column", "x", "Mean")] - x.mean()) < 1e-9
        assert abs(m[("Column", "x", "Sum")] - x.sum()) < 1e-6
        assert abs(m[("Column", "x", "StandardDeviation")] - x.std(ddof=0)) < 1e-6
        assert m[("Column", "x", "Minimum")] == x.min() and m[("Column", "x", "Maximum")] == x.max()
    else:
        assert ("Column", "x", "Mean") not in m
    s = pdf["s"].dropna()
    if len(s):
        assert m[("Column", "s", "MaxLength")] == s.str.len().max()
        p = s.value_counts(normalize=True).to_numpy()
        assert abs(m[("Column", "s", "Entropy")] - float(-(p * np.log(p)).sum())) < 1e-9


def test_separate_sketches_same_metrics(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    an = M.default_analyzers(df)
    a = metric_map(M.run_analyzers(df, an))
    b = metric_map(M.run_analyzers(df, an, separate_sketches=True))
    assert a == b
    plan = M.scan_metrics(df, an, separate_sketches=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2


def test_distinct_counts_one_column_at_a_time(spark):
    """exact counts as count_distinct gives them, without an Expand of every row for every column."""
    rows = [(1, 0.0, "a"), (1, -0.0, None), (2, float("nan"), "a"), (None, float("nan"), ""), (None, None, "b")]
    df = spark.createDataFrame(rows, "`a.b` int, d double, s string")
    out = M.distinct_counts(df, df.columns)
    assert {r["column"]: r["distinct"] for r in out.collect()} == {"a.b": 2, "d": 2, "s": 3}
    exact = df.agg(*[F.count_distinct(F.col(f"`{c}`")) for c in df.columns]).first()
    assert list(exact) == [2, 2, 3]
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    empty = M.distinct_counts(df.where("s = 'none'"), df.columns).collect()
    assert sorted((r["column"], r["distinct"]) for r in empty) == [("a.b", 0), ("d", 0), ("s", 0)]
