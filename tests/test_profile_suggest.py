from pyspark.sql import functions as F

from tablewatch.operators import profile as PR
from tablewatch.operators import suggest as SG
from tablewatch.operators import verify as V


def test_text_type_inference(spark):
    rows = [("1", "1.5", "true", "1", "x"), ("-2", "2", "false", "true", None), ("+ 3", ".5", None, "2", "y")]
    df = spark.createDataFrame(rows, "i string, f string, b string, m string, s string")
    got = {r.column: r.inferred for r in PR.infer_text_types(df).collect()}
    assert got == {"i": "Integral", "f": "Fractional", "b": "Boolean", "m": "String", "s": "String"}
    nulls = spark.createDataFrame([(None,)], "n string")
    assert PR.infer_text_types(nulls).first().inferred == "Unknown"


def test_profile_numeric_text_gets_numeric_stats(spark):
    df = spark.createDataFrame([("1",), ("3",), (None,)], "t string")
    p = PR.profile_columns(df)
    r = p.rows[0]
    assert r["data_type"] == "Integral" and r["profile_kind"] == "numeric"
    assert r["minimum"] == 1.0 and r["maximum"] == 3.0 and r["null_count"] == 1


def test_suggestions_and_lower_bound(spark):
    rows = [(i, "a" if i % 2 else 'q"b\\', None if i % 4 == 0 else "v") for i in range(40)]
    df = spark.createDataFrame(rows, "id int, cat string, sparse string")
    s = {(r.suggesting_rule, r.column_name): r for r in SG.suggest(df).collect()}
    assert ("CompleteIfCompleteRule()", "id") in s
    assert ("NonNegativeNumbersRule()", "id") in s
    r2 = s[("RetainCompletenessRule()", "sparse")]
    # p = 0.75, n = 40: floor(100 * (0.75 - 1.96 * sqrt(0.75 * 0.25 / 40))) / 100 = 0.61
    assert r2.threshold == 0.61
    cat = s[("CategoricalRangeRule()", "cat")]
    assert cat.code_for_constraint == '.isContainedIn("cat", ["a", "q\\"b\\\\"])'
    assert list(cat["values"]) == ["a", 'q"b\\']


def test_suggested_exact_rules_pass_on_their_data(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    sugg = SG.suggest(ev)
    res = V.verify(ev, V.rules_from_frame(sugg))
    exact = {r.constraint_name for r in sugg.where(F.col("threshold") == 1.0).collect()}
    bad = [r for r in res.collect() if r.constraint in exact and r.constraint_status != "Success"]
    assert not bad


def test_profile_rows_nan_and_size(spark):
    df = spark.createDataFrame([(1, "a", None)], "n int, s string, t timestamp")
    rows = PR.profile_rows(PR.profile_columns(df), "2024-01-01 00:00:00", "2024-01-01 00:00:00").collect()
    by = {(r.column, r.metric): r.value for r in rows}
    assert by[("", "Size")] == 1.0
    assert by[("t", "completeness")] == 0.0 and ("t", "mean") not in by
    assert by[("n", "stdDev")] == 0.0
    assert rows[0].profilingTimestamp_Formatted == "2024-01-01 07:00:00"


def test_unique_rule_extended_set(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(300)], "k int, g int")
    s = {(r.suggesting_rule, r.column_name) for r in SG.suggest(df, SG.EXTENDED_RULES).collect()}
    assert ("UniqueIfApproximatelyUniqueRule()", "k") in s
    assert ("UniqueIfApproximatelyUniqueRule()", "g") not in s
    assert not any(r == "UniqueIfApproximatelyUniqueRule()" for r, _ in
                   {(r.suggesting_rule, r.column_name) for r in SG.suggest(df).collect()})


def test_no_rules_selected_gives_empty_frame(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert SG.suggest(df, rules=()).count() == 0


def test_odd_column_names_end_to_end(spark):
    from tablewatch.operators import metrics as M
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x")], "`a.b c` int, `it's` string")
    m = {(r.instance, r.name): r.value for r in
         M.run_analyzers(df, M.default_analyzers(df, entropy=True)).collect()}
    assert m[("a.b c", "Sum")] == 6.0 and ("it's", "Entropy") in m
    sugg = SG.suggest(df)
    assert sugg.where(F.col("column_name") == "it's").count() > 0
    res = V.verify(df, V.rules_from_frame(sugg)).collect()
    assert res and all(r.constraint_status == "Success" for r in res if r.constraint.startswith("Completeness"))
