"""Verification of structured rules against a slice.

Rules are compiled (V1) into aggregate expressions: every scan-type rule
lands in ONE ``agg`` over the slice (one per :data:`RULES_A_PASS` rules of a longer
list); uniqueness rules share one grouping pass.  The check status (V10) is computed
from the same one-row aggregates, so the result needs no window.  Only the rule list
(as long as the active rule table, whatever the data) is read on the driver to build
the plan.  :func:`verify_frame` leaves the rules in their table instead: any number of
them is evaluated as data, by joins on what was measured of the columns.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import types as TY
from ..session import ensure_checkpoint_dir
from .metrics import frequency_summary, lit_sql, q, value_frequencies
from .suggest import f4

# Check level, statuses and the failure message format.
CHECK_LEVEL = "Warning"
SUCCESS, FAILURE = "Success", "Failure"
NO_ROWS_MESSAGE = "no rows"
# rules compiled into one aggregate; longer lists take several aggregates
RULES_A_PASS = 1_000

RESULT_FIELDS = ["check", "check_level", "check_status", "constraint", "constraint_status",
                 "constraint_message", "value"]


@dataclass(frozen=True)
class Rule:
    constraint_name: str
    column_name: str | None
    kind: str
    values: tuple | None = None
    threshold: float | None = 1.0
    dtype: str | None = None
    predicate: str | None = None

    @staticmethod
    def from_row(r) -> "Rule":
        d = r.asDict() if hasattr(r, "asDict") else dict(r)
        vals = d.get("values")
        return Rule(d["constraint_name"], d.get("column_name"), d["kind"],
                    tuple(vals) if vals is not None else None,
                    d.get("threshold") if d.get("threshold") is not None else 1.0,
                    d.get("dtype"), d.get("predicate"))


def _rule_value(rule: Rule) -> Column:
    n = F.count(F.lit(1))
    c = F.col(f"`{rule.column_name}`") if rule.column_name else None
    k = rule.kind
    if k in ("is_complete", "has_completeness"):
        return F.try_divide(F.count(c).cast("double"), n.cast("double"))
    if k == "is_contained_in":
        ok = c.isNull() | c.cast("string").isin(list(rule.values or ()))
        return F.try_divide(F.sum(ok.cast("int")).cast("double"), n.cast("double"))
    if k == "is_non_negative":
        ok = F.coalesce(c.cast("double"), F.lit(0.0)) >= 0
        return F.try_divide(F.sum(ok.cast("int")).cast("double"), n.cast("double"))
    if k == "has_data_type":
        cls = TY.value_class(c.cast("string"))
        wanted = {"Numeric": [TY.INTEGRAL, TY.FRACTIONAL]}.get(rule.dtype, [rule.dtype])
        hit = F.sum(F.when(cls.isin(wanted), 1).otherwise(0)).cast("double")
        return F.when(n > 0, F.try_divide(hit, F.count(c).cast("double")))
    if k == "satisfies":
        ok = F.coalesce(F.expr(rule.predicate), F.lit(False))
        return F.try_divide(F.sum(ok.cast("int")).cast("double"), n.cast("double"))
    raise ValueError(f"unknown rule kind {k!r}")


def verify(df: DataFrame, rules: Sequence[Rule], check: str = "tablewatch_check",
           level: str = CHECK_LEVEL) -> DataFrame:
    """V2 + V7 + V9 + V10: one row per rule: check, check_level, check_status, constraint,
    constraint_status, constraint_message, value, status_value."""
    spark = df.sparkSession
    rules = list(rules)
    if not rules:
        return spark.createDataFrame(
            [], "check string, check_level string, check_status string, constraint string, "
                "constraint_status string, constraint_message string, value double, status_value int")
    parts = [_results(df, rules[at:at + RULES_A_PASS]) for at in range(0, len(rules), RULES_A_PASS)]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    every = rows.agg(F.flatten(F.collect_list("results")).alias("results"))
    fine = F.forall("results", lambda r: r["constraint_status"] == SUCCESS)
    out = every.select(F.when(fine, F.lit(SUCCESS)).otherwise(F.lit(level)).alias("check_status"), F.inline("results"))
    return out.select(F.lit(check).alias("check"), F.lit(level).alias("check_level"), "check_status",
                      "constraint", "constraint_status", "constraint_message", "value",
                      F.when(F.col("constraint_status") == FAILURE, 0).otherwise(1).alias("status_value"))


def _results(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: ``results``, the array of (constraint, constraint_status, constraint_message, value) of some rules."""
    # a rule whose column is gone (schema drift since the suggestion) fails with a
    # message instead of failing the whole verification
    present = set(df.columns)
    missing = {i for i, r in enumerate(rules) if r.column_name is not None and r.column_name not in present}
    scan = [(i, r) for i, r in enumerate(rules) if r.kind != "is_unique" and i not in missing]
    uniq = [(i, r) for i, r in enumerate(rules) if r.kind == "is_unique" and i not in missing]
    exprs = [F.count(F.lit(1)).alias("_n")] + [_rule_value(r).alias(f"_v{i}") for i, r in scan]
    row = df.agg(*exprs)
    if uniq:
        cols = sorted({r.column_name for _, r in uniq})
        summ = frequency_summary(df, cols).select(
            "column", F.try_divide(F.col("singles").cast("double"), F.col("n")).alias("u"))
        # one row per distinct uniqueness column: pivot it onto the aggregate row
        piv = summ.groupBy().pivot("column", cols).agg(F.first("u"))
        row = _attach(row, piv, cols, uniq)
    structs = []
    for i, r in enumerate(rules):
        if i in missing:
            structs.append(F.struct(F.lit(r.constraint_name).alias("constraint"),
                                    F.lit(FAILURE).alias("constraint_status"),
                                    F.lit(f"Input data does not include column {r.column_name}!")
                                    .alias("constraint_message"),
                                    F.lit(None).cast("double").alias("value")))
            continue
        v = F.col(f"_v{i}")
        ok = F.coalesce(v >= F.lit(float(r.threshold if r.threshold is not None else 1.0)), F.lit(False))
        msg = (F.when(F.col("_n") == 0, F.lit(NO_ROWS_MESSAGE))
               .when(ok, F.lit(""))
               .otherwise(F.concat(F.lit("Value: "), F.coalesce(f4(v), F.lit("NULL")),
                                   F.lit(" does not meet the constraint requirement!"))))
        structs.append(F.struct(F.lit(r.constraint_name).alias("constraint"),
                                F.when(ok, F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("constraint_status"),
                                msg.alias("constraint_message"), v.cast("double").alias("value")))
    return row.select(F.array(*structs).alias("results"))


def _attach(row: DataFrame, piv: DataFrame, cols, uniq) -> DataFrame:
    """Put the uniqueness values (one small pivoted row) next to the aggregate row
    without a join: both one-row frames are unioned and collapsed with ``max``."""
    piv = piv.select(*[F.col(f"`{c}`").alias(f"_u_{i}") for i, c in enumerate(cols)])
    both = row.unionByName(piv, allowMissingColumns=True)
    one = both.agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in both.columns])
    return one.withColumns({f"_v{i}": F.when(F.col("_n") > 0, F.col(f"_u_{cols.index(r.column_name)}"))
                            for i, r in uniq})


def rules_from_frame(rules_df: DataFrame) -> list[Rule]:
    """V1 input: the active rule rows, read on the driver to build the plan."""
    wanted = ["constraint_name", "column_name", "kind", "values", "threshold", "dtype"]
    cols = [c for c in wanted if c in rules_df.columns]
    if "predicate" in rules_df.columns:
        cols.append("predicate")
    rows = rules_df.select(*cols).collect()
    return [Rule.from_row(r) for r in rows]


def read_active_rules(rules_df: DataFrame) -> DataFrame:
    """Rules with ``active == 1``."""
    return rules_df.where(F.col("active") == 1)


# ------------------------------------------------------------------ rules as data

RULE_FIELDS = {"constraint_name": "string", "column_name": "string", "kind": "string", "values": "array<string>",
               "threshold": "double", "dtype": "string"}
_MEASURE = {"is_complete": "complete", "has_completeness": "complete", "is_non_negative": "non_negative",
            "is_contained_in": "member", "is_unique": "unique"}
_CLASSES = {TY.INTEGRAL: [TY.INTEGRAL], TY.FRACTIONAL: [TY.FRACTIONAL], TY.BOOLEAN: [TY.BOOLEAN], TY.STRING: [TY.STRING],
            "Numeric": [TY.INTEGRAL, TY.FRACTIONAL]}


def _measure_sql(df: DataFrame, column: str, measure: str, predicates: dict[str, str]) -> tuple[str, str] | None:
    """(hits, base) of a measure as aggregate SQL; None for one that no column can give."""
    c = q(column)
    if measure == "complete":
        return f"count({c})", "count(1)"
    if measure in ("member", "unique"):             # hits come from the value counts; NULLs count as members
        return f"count(1) - count({c})", "count(1)"
    if measure == "non_negative":
        kind = df.schema[column].dataType.typeName()
        fits = kind in ("byte", "short", "integer", "long", "float", "double", "string", "boolean") or kind.startswith("decimal")
        return (f"count_if(coalesce(try_cast({c} as double), 0D) >= 0)", "count(1)") if fits else None
    if measure.startswith("type:"):
        classes = _CLASSES.get(measure[5:], [])
        tests = [f"count_if(_class = {lit_sql(x)})" for x in classes] or ["0"]
        return " + ".join(t.replace("_class", q(f"_class_{column}")) for t in tests), f"count({c})"
    if measure.startswith("satisfies:") and measure[10:] in predicates:
        return f"count_if(coalesce(({predicates[measure[10:]]}), false))", "count(1)"
    return None


def measures(df: DataFrame, wanted: Sequence[tuple[str, str]], predicates: dict[str, str] | None = None) -> DataFrame:
    """``(column, measure, hits, base, n)`` of the wanted (column, measure) pairs, by one aggregate over ``df``."""
    predicates = predicates or {}
    typed = sorted({c for c, m in wanted if m.startswith("type:")})
    src = df.select("*", *[TY.value_class(F.col(q(c)).cast("string")).alias(f"_class_{c}") for c in typed])
    rows = []
    for column, measure in sorted(wanted):
        pair = _measure_sql(df, column, measure, predicates) if column in df.columns or not column else None
        if pair:
            rows.append(f"named_struct('column', {lit_sql(column)}, 'measure', {lit_sql(measure)}, 'hits', CAST({pair[0]} AS BIGINT), "
                        f"'base', CAST({pair[1]} AS BIGINT), 'n', count(1))")
    if not rows:
        return df.sparkSession.createDataFrame([], "column string, measure string, hits long, base long, n long")
    one = src.selectExpr(*[f"{r} AS m{i}" for i, r in enumerate(rows)])
    return one.selectExpr(f"inline(array({', '.join(f'm{i}' for i in range(len(rows)))}))")


def verify_frame(df: DataFrame, rules: DataFrame, check: str = "tablewatch_check", level: str = CHECK_LEVEL,
                 predicates: dict[str, str] | None = None) -> DataFrame:
    """V1 + V2 with the rules as data: the result rows of :func:`verify`, one per row of ``rules``.

    What reaches the driver is which (column, measure) pairs the rules ask for, bounded by the
    schema's width.  Those pairs are measured by one aggregate over the slice; membership and
    uniqueness come from the value counts of the columns concerned (one grouping pass),
    membership by a join with the exploded rule values.  The plan's size does not depend on
    the number of rules, and results are never gathered in one row.

    A rule of kind ``satisfies`` names one of ``predicates`` (name -> SQL).  Rules on absent
    columns, of unknown kinds, of unnamed predicates or of measures that a column's type
    cannot give fail with a message.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    have = set(rules.columns)
    book = rules.select(*[(F.col(q(c)) if c in have else F.lit(None)).cast(t).alias(c) for c, t in RULE_FIELDS.items()])
    names = F.create_map(*[F.lit(x) for kv in _MEASURE.items() for x in kv])
    dtype = F.when(F.col("dtype").isin(list(_CLASSES)), F.col("dtype")).otherwise("")
    measure = F.when(F.col("kind") == "has_data_type", F.concat(F.lit("type:"), dtype)) \
        .when(F.col("kind") == "satisfies", F.concat(F.lit("satisfies:"), F.col("constraint_name"))).otherwise(F.try_element_at(names, F.col("kind")))
    known = F.col("column_name").isin(list(df.columns)) if df.columns else F.lit(False)
    named = F.col("constraint_name").isin(list(predicates or {})) if predicates else F.lit(False)
    book = book.select("*", F.when(F.col("kind") == "satisfies", F.lit("")).otherwise(F.coalesce("column_name", F.lit(""))).alias("_column"),
                       measure.alias("_measure"), F.array_sort(F.array_distinct(F.coalesce("values", F.array().cast("array<string>")))).alias("_set"),
                       F.when(F.col("kind") == "satisfies", named).otherwise(F.coalesce(known, F.lit(False))).alias("_known"))
    pairs = book.where("_known and _measure is not null").select("_column", "_measure").distinct().collect()
    wanted = [(r[0], r[1]) for r in pairs]
    found = measures(df, wanted + [("", "size")], {**(predicates or {})})
    out = book.join(F.broadcast(found.withColumnsRenamed({"column": "_c", "measure": "_m"})),
                    (F.col("_column") == F.col("_c")) & (F.col("_measure") == F.col("_m")), "left").drop("_c", "_m")
    counted = sorted({c for c, m in wanted if m in ("member", "unique")})
    value = F.try_divide(F.col("hits").cast("double"), F.col("base").cast("double"))
    if counted:
        freq = value_frequencies(df, counted)
        once = freq.groupBy("column").agg(F.try_divide(F.count_if(F.col("cnt") == 1).cast("double"), F.sum("cnt").cast("double")).alias("_unique"))
        sets = book.where("_known and _measure = 'member'").select(F.col("_column").alias("column"), F.col("_set").alias("set")).distinct()
        members = sets.withColumn("value", F.explode("set")).join(freq, ["column", "value"]).groupBy("column", "set").agg(F.sum("cnt").alias("_in"))
        out = out.join(F.broadcast(once.withColumnRenamed("column", "_uc")), (F.col("_column") == F.col("_uc")) & (F.col("_measure") == "unique"), "left") \
            .join(members.withColumnsRenamed({"column": "_mc", "set": "_ms"}),
                  (F.col("_column") == F.col("_mc")) & (F.col("_set") == F.col("_ms")) & (F.col("_measure") == "member"), "left")
        inside = F.try_divide((F.col("hits") + F.coalesce("_in", F.lit(0))).cast("double"), F.col("base").cast("double"))
        value = F.when(F.col("_measure") == "member", inside).when(F.col("_measure") == "unique", F.when(F.col("n") > 0, F.col("_unique"))).otherwise(value)
    out = out.withColumn("value", value)
    ok = F.coalesce(F.col("value") >= F.coalesce("threshold", F.lit(1.0)), F.lit(False))
    message = F.when((F.col("kind") != "satisfies") & F.col("_measure").isNotNull() & ~F.col("_known"),
                     F.concat(F.lit("Input data does not include column "), F.coalesce("column_name", F.lit("NULL")), F.lit("!"))) \
        .when(F.col("_measure").isNull() | ~F.col("_known") | F.col("n").isNull(), F.concat(F.lit("Cannot evaluate kind "), F.coalesce("kind", F.lit("NULL")), F.lit("!"))) \
        .when(F.col("n") == 0, F.lit(NO_ROWS_MESSAGE)).when(ok, F.lit("")) \
        .otherwise(F.concat(F.lit("Value: "), F.coalesce(f4(F.col("value")), F.lit("NULL")), F.lit(" does not meet the constraint requirement!")))
    rows = out.select(F.lit(check).alias("check"), F.lit(level).alias("check_level"), F.col("constraint_name").alias("constraint"),
                      F.when(ok, F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("constraint_status"), message.alias("constraint_message"),
                      "value", F.when(ok, 1).otherwise(0).alias("status_value")).checkpoint()
    status = rows.groupBy("check").agg(F.when(F.min("status_value") == 1, F.lit(SUCCESS)).otherwise(F.lit(level)).alias("check_status"))
    return rows.join(F.broadcast(status), "check").select(
        "check", "check_level", "check_status", "constraint", "constraint_status", "constraint_message", "value", "status_value")
