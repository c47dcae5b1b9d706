from pyspark.sql import functions as F

from tablewatch.operators import rules as RL
from tablewatch.operators import verify as V
from tablewatch.operators.suggest import SUGGESTION_FIELDS

NOW = "2024-02-01 00:00:00"


def _sugg(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in SUGGESTION_FIELDS))


def test_null_column_name_merges_to_one_row(spark):
    s = _sugg(spark, [("c1", None, "v", "d", "r", "rd", ".isComplete(x)")])
    t1 = RL.merge_rules(RL.new_rules(s, NOW), spark.createDataFrame([], RL.ACTIVATED_SCHEMA), NOW)
    t2 = RL.merge_rules(RL.new_rules(s, NOW), t1, NOW)
    t3 = RL.merge_rules(RL.new_rules(s, NOW), t2, NOW)
    rows = t3.collect()
    assert len(rows) == 1 and rows[0].frequency == 3


def test_old_only_keeps_frequency_and_level(spark):
    old = RL.new_rules(_sugg(spark, [("c1", "a", "v", "d", "r", "rd", "x")]), "2024-01-01 00:00:00") \
        .withColumn("level", F.lit("high")).withColumn("frequency", F.lit(5))
    new = RL.new_rules(_sugg(spark, [("c2", "a", "v", "d", "r", "rd", "y")]), NOW)
    got = {r.constraint_name: r for r in RL.merge_rules(new, old, NOW).collect()}
    assert got["c1"].frequency == 5 and got["c1"].level == "high"
    assert got["c2"].frequency == 1 and got["c2"].level == "low"


def test_activation_share_and_ties(spark):
    rows = [(f"r{i:02d}", "c", "x", None if i == 3 else ("high" if i < 2 else "low"), 7 if i % 2 else 3)
            for i in range(12)]
    df = spark.createDataFrame(rows, "constraint_name string, column_name string, code_for_constraint string, "
                                     "level string, frequency int")
    act = {r.constraint_name: r.active for r in RL.activate_rules(df, 0.8).collect()}
    assert act["r00"] == 1 and act["r01"] == 1                     # high always active
    non_high = [f"r{i:02d}" for i in range(2, 12)]
    assert sum(act[k] for k in non_high) == int(10 * 0.8)
    # frequency 7 first (r03 r05 r07 r09 r11), then frequency 3 by key (r02 r04 r06 ...)
    assert [k for k in non_high if act[k] == 0] == ["r08", "r10"]


def test_verify_empty_slice_fails_with_no_rows(spark):
    df = spark.createDataFrame([], "a int")
    res = V.verify(df, [V.Rule("c", "a", "is_complete")]).collect()
    assert res[0].constraint_status == "Failure" and res[0].constraint_message == "no rows"
    assert res[0].check_status == "Warning"


def test_verify_kinds(spark):
    df = spark.createDataFrame([(1, "a", "1"), (2, "b", "x"), (2, None, "3")], "n int, s string, t string")
    rules = [V.Rule("u", "n", "is_unique"), V.Rule("in", "s", "is_contained_in", ("a", "b")),
             V.Rule("nn", "n", "is_non_negative"), V.Rule("dt", "t", "has_data_type", dtype="Integral"),
             V.Rule("cp", "s", "has_completeness", threshold=0.6)]
    got = {r.constraint: r for r in V.verify(df, rules).collect()}
    assert abs(got["u"].value - 1 / 3) < 1e-12 and got["u"].constraint_status == "Failure"
    assert got["in"].value == 1.0 and got["nn"].value == 1.0
    assert abs(got["dt"].value - 2 / 3) < 1e-12
    assert got["cp"].constraint_status == "Success" and got["cp"].status_value == 1
    assert got["u"].check_status == "Warning"


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["low", "high", None]), st.integers(0, 4)), min_size=1, max_size=25),
       st.sampled_from([0.5, 0.8, 1.0]))
def test_activation_share_property(spark, rules, ratio):
    rows = [(f"r{i:03d}", "c", "x", lvl, f) for i, (lvl, f) in enumerate(rules)]
    df = spark.createDataFrame(rows, "constraint_name string, column_name string, code_for_constraint string, "
                                     "level string, frequency int")
    got = RL.activate_rules(df, ratio).collect()
    non_high = [r for r in got if r.level != "high"]
    assert all(r.active == 1 for r in got if r.level == "high")
    assert sum(r.active for r in non_high) == int(len(non_high) * ratio)
    if non_high:
        cut = min((r.frequency for r in non_high if r.active), default=None)
        assert all(r.frequency <= cut for r in non_high if not r.active) if cut is not None else True


def test_verify_rule_on_missing_column_fails_cleanly(spark):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    res = {r.constraint: r for r in V.verify(df, [V.Rule("ok", "a", "is_complete"),
                                                   V.Rule("gone", "b", "is_complete"),
                                                   V.Rule("gone_u", "c", "is_unique")]).collect()}
    assert res["ok"].constraint_status == "Success"
    assert res["gone"].constraint_status == "Failure" and "column b" in res["gone"].constraint_message
    assert res["gone_u"].value is None and res["ok"].check_status == "Warning"


def test_verify_long_rule_list_takes_several_passes(spark, monkeypatch):
    monkeypatch.setattr(V, "RULES_A_PASS", 2)
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    rules = [V.Rule(f"c{i}", "n", "is_complete") for i in range(3)] + [V.Rule("u", "n", "is_unique"),
                                                                        V.Rule("s", "s", "is_complete")]
    got = {r.constraint: r for r in V.verify(df, rules).collect()}
    assert len(got) == 5 and all(r.check_status == "Warning" for r in got.values())
    assert [got[c].constraint_status for c in ("c0", "c1", "c2", "u", "s")] == ["Success"] * 4 + ["Failure"]
    assert all(r.check_status == "Success" for r in V.verify(df, rules[:4]).collect())
