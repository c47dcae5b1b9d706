"""Rules as data give what compiled rules give, whatever their number."""

import pytest
from pyspark.sql import functions as F

from tablewatch.operators import verify as V

SCHEMA = "constraint_name string, column_name string, kind string, values array<string>, threshold double, dtype string"
RULES = [
    ("a_complete", "a", "is_complete", None, None, None), ("t_mostly", "t", "has_completeness", None, 0.5, None),
    ("a_sign", "a", "is_non_negative", None, 0.9, None), ("t_in", "t", "is_contained_in", ["x", "y", "y", "it's \\ odd"], 0.75, None),
    ("n_in", "n", "is_contained_in", ["1", "2"], 0.2, None), ("t_none_in", "t", "is_contained_in", [], 0.1, None), ("t_null_in", "t", "is_contained_in", None, 0.1, None),
    ("id_unique", "id", "is_unique", None, None, None), ("t_unique", "t", "is_unique", None, 0.1, None), ("void_unique", "void", "is_unique", None, 0.1, None),
    ("s_type", "s", "has_data_type", None, 0.5, "Integral"), ("s_numeric", "s", "has_data_type", None, 0.7, "Numeric"), ("s_text", "s", "has_data_type", None, 0.1, "String"),
    ("s_odd", "s", "has_data_type", None, 0.1, "Strange"), ("gone", "nowhere", "is_complete", None, 1.0, None), ("id_unique", "id", "is_unique", None, None, None),
]


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, float(i - 5) if i % 4 else None, ["x", "y", "z", None, "it's \\ odd"][i % 5], i % 7, None, ["1", "2.5", "true", "word", None][i % 5]) for i in range(200)]
    return spark.createDataFrame(rows, "id long, a double, t string, n int, void string, s string")


def results(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_equals_the_compiled_rules(spark, table):
    book = spark.createDataFrame(RULES, SCHEMA)
    for df in (table, table.limit(0), table.where("id = 7")):
        assert results(V.verify_frame(df, book)) == results(V.verify(df, V.rules_from_frame(book)))
    fine = book.where("constraint_name in ('t_mostly', 'id_unique')")
    assert {r["check_status"] for r in V.verify_frame(table, fine).collect()} == {V.SUCCESS}
    assert V.verify_frame(table, book.limit(0)).count() == 0


def test_predicates_and_what_cannot_be_evaluated(spark, table):
    book = spark.createDataFrame([("long", None, "satisfies", None, 0.5, None), ("other", None, "satisfies", None, 0.5, None), ("odd", "a", "is_pretty", None, 0.5, None),
                                  (None, None, "is_complete", None, 0.5, None), ("none", "a", None, None, 0.5, None)], SCHEMA)
    got = {r["constraint"]: r for r in V.verify_frame(table, book, predicates={"long": "length(s) > 1"}).collect()}
    assert got["long"]["value"] == pytest.approx(0.6) and got["long"]["constraint_status"] == V.SUCCESS
    assert all(got[n]["constraint_status"] == V.FAILURE and got[n]["constraint_message"] for n in ("other", "odd", "none", None))
    assert "does not include column" in got[None]["constraint_message"]


def test_the_plan_does_not_grow_with_the_rules(spark, table):
    def book(n):
        i = F.col("id")
        return spark.range(n).select(F.concat(F.lit("r"), i.cast("string")).alias("constraint_name"), F.element_at(F.array(*map(F.lit, "atn")), (i % 3 + 1).cast("int")).alias("column_name"),
                                     F.when(i % 2 == 0, "is_contained_in").otherwise("is_complete").alias("kind"),
                                     F.array((i % 9).cast("string"), F.lit("x")).alias("values"), (i % 11 / 11).alias("threshold"))
    small, large = V.verify_frame(table, book(10)), V.verify_frame(table, book(6000))
    size = [len(d._jdf.queryExecution().optimizedPlan().toString()) for d in (small, large)]
    assert size[0] == size[1] and large.count() == 6000
    for r in large.where("constraint in ('r17', 'r18', 'r1000')").collect():
        i = int(r["constraint"][1:])
        rule = V.Rule(r["constraint"], "atn"[i % 3], "is_contained_in" if i % 2 == 0 else "is_complete", (str(i % 9), "x"), i % 11 / 11)
        assert r["value"] == V.verify(table, [rule]).first()["value"]
