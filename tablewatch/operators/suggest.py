"""Constraint suggestion (R1-R9): rules evaluated over the column profiles.

Every rule is a filter + projection over the small profile frame (one row
per column) or the histogram rows (at most ~120 per low-cardinality
column), so suggestion costs nothing beyond the profile passes.

Each suggestion carries the seven descriptive text fields plus a structured
twin (``kind``, ``values``, ``threshold``, ``dtype``) that verification
dispatches on; the code text is never evaluated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import types as TY
from ..functions.stats import Z_95
from .metrics import lit_sql
from .profile import ColumnProfiles

SUGGESTION_FIELDS = ["constraint_name", "column_name", "current_value", "description",
                     "suggesting_rule", "rule_description", "code_for_constraint"]
STRUCTURED_FIELDS = ["kind", "values", "threshold", "dtype"]

SUGGESTION_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in SUGGESTION_FIELDS]
    + [T.StructField("kind", T.StringType()), T.StructField("values", T.ArrayType(T.StringType())),
       T.StructField("threshold", T.DoubleType()), T.StructField("dtype", T.StringType())])

# Rule names and rule descriptions.
RULE_TEXT = {
    "complete": ("CompleteIfCompleteRule()",
                 "If a column is complete in the sample, we suggest a NOT NULL constraint"),
    "retain_completeness": ("RetainCompletenessRule()",
                            "If a column is incomplete in the sample, we model its completeness as a binomial "
                            "variable, estimate a confidence interval and use this to define a lower bound for "
                            "the completeness"),
    "retain_type": ("RetainTypeRule()", "If we detect a non-string type, we suggest a type constraint"),
    "categorical": ("CategoricalRangeRule()",
                    "If we see a categorical range for a column, we suggest an IS IN (...) constraint"),
    "fractional_categorical": ("FractionalCategoricalRangeRule(0.9)",
                               "If we see a categorical range for most values in a column, we suggest an "
                               "IS IN (...) constraint that should hold for most values"),
    "non_negative": ("NonNegativeNumbersRule()",
                     "If we see only non-negative numbers in a column, we suggest a corresponding constraint"),
    "unique": ("UniqueIfApproximatelyUniqueRule()",
               "If the ratio of approximate num distinct values in a column is close to the number of "
               "records (within the error of the HLL sketch), we suggest a UNIQUE constraint"),
}
# Rule thresholds.
MIN_COMPLETENESS = 0.2
CATEGORICAL_MAX_SINGLES = 0.1
FRACTIONAL_MAX_SINGLES = 0.4
FRACTIONAL_COVERAGE = 0.9
UNIQUE_TOLERANCE = 0.08

DEFAULT_RULES = ("complete", "retain_completeness", "retain_type", "categorical",
                 "fractional_categorical", "non_negative")
EXTENDED_RULES = DEFAULT_RULES + ("unique",)


# Numbers in rule texts are rounded arithmetically (half up, IEEE double) before
# formatting, so the text does not depend on how an engine formats an exact tie.

def f4(c: Column) -> Column:
    return F.format_string("%.4f", F.floor(c.cast("double") * 10000 + 0.5) / 10000)


def f2(c: Column) -> Column:
    return F.format_string("%.2f", F.floor(c.cast("double") * 100 + 0.5) / 100)


# Rule rows are rendered as SQL text and submitted with one ``selectExpr`` per rule.

def _f4(x: str) -> str:
    return f"format_string('%.4f', floor(CAST({x} AS DOUBLE) * 10000 + 0.5) / 10000)"


def _f2(x: str) -> str:
    return f"format_string('%.2f', floor(CAST({x} AS DOUBLE) * 100 + 0.5) / 100)"


def _cat(*parts: str) -> str:
    return "concat(" + ", ".join(parts) + ")"


def _lower_sql(p: str, n: str) -> str:
    """SQL twin of :func:`functions.stats.binomial_lower_bound`."""
    return (f"(floor(100.0 * (CAST({p} AS DOUBLE) - {Z_95} * sqrt(CAST({p} AS DOUBLE) * (1.0 - CAST({p} AS DOUBLE)) "
            f"/ CAST({n} AS DOUBLE)))) / 100.0)")


def _row_sql(rule: str, constraint_name: str, current_value: str, description: str, code: str, kind: str,
             values: str | None = None, threshold: str | None = None, dtype: str | None = None) -> list[str]:
    name, text = RULE_TEXT[rule]
    return [f"{constraint_name} AS constraint_name", "column AS column_name",
            f"{current_value} AS current_value", f"{description} AS description",
            f"{lit_sql(name)} AS suggesting_rule", f"{lit_sql(text)} AS rule_description",
            f"{code} AS code_for_constraint", f"{lit_sql(kind)} AS kind",
            f"{values or 'CAST(NULL AS ARRAY<STRING>)'} AS values",
            f"CAST({threshold or '1.0'} AS DOUBLE) AS threshold",
            f"{dtype or 'CAST(NULL AS STRING)'} AS dtype"]


_Q = lit_sql("'")
_DQ = lit_sql('"')


def _dq_list(arr: str) -> str:
    esc = f"replace(replace(v, {lit_sql(chr(92))}, {lit_sql(chr(92) * 2)}), {_DQ}, {lit_sql(chr(92) + chr(34))})"
    return f"array_join(transform({arr}, v -> concat({_DQ}, {esc}, {_DQ})), ', ')"


def _sq_list(arr: str) -> str:
    return f"array_join(transform({arr}, v -> concat({_Q}, v, {_Q})), ', ')"


def _categorical(profiles: ColumnProfiles, rules) -> list[DataFrame]:
    # the qualifying columns and the row count are known from pass 1 (driver-side
    # profile rows), so they enter the plan as literals instead of a join
    cat_cols = [r["column"] for r in profiles.rows if r["data_type"] == TY.STRING and r["has_histogram"]]
    if not cat_cols:
        return []
    hist = (profiles.histograms.where(F.col("column").isin(cat_cols))
            .withColumn("n_rows", F.lit(int(profiles.n_rows)).cast("long")))
    # one group per column (at most ~HISTOGRAM_THRESHOLD values): the values are collected
    # sorted (most frequent first, ties by value) and the running coverage is computed on
    # that bounded array, so no window / extra shuffle is needed
    per_col = hist.groupBy("column").agg(
        F.expr("count(1)").alias("bins"),
        F.expr("sum(CASE WHEN cnt = 1 THEN 1 ELSE 0 END)").alias("singles"),
        F.expr("first(n_rows)").alias("n_rows"),
        F.expr("sort_array(collect_list(named_struct('k', -cnt, 'v', value)))").alias("all"))
    per_col = per_col.selectExpr(
        "*", "transform(all, s -> s.v) AS all_values",
        f"filter(transform(all, (s, i) -> named_struct('v', s.v, 'c', -s.k, 'before', "
        f"aggregate(slice(all, 1, i), 0L, (acc, y) -> acc - y.k))), "
        f"e -> e.before < {FRACTIONAL_COVERAGE} * n_rows) AS top",
        "singles / bins AS singles_ratio")
    per_col = per_col.selectExpr("*", "transform(top, e -> e.v) AS top_values",
                                 "aggregate(top, 0L, (acc, e) -> acc + e.c) AS top_cnt")
    # R4 and R5 come out of ONE pass over the histogram rows: each column yields an
    # array of (at most two) conditional rule structs, inlined and filtered.
    items = []
    name = _cat(lit_sql("ContainedInConstraint("), "column", lit_sql(")"))
    if "categorical" in rules:
        row = _row_sql(
            "categorical", name, lit_sql("Compliance: 1"),
            _cat(_Q, "column", lit_sql("' has value range "), _sq_list("all_values")),
            _cat(lit_sql('.isContainedIn("'), "column", lit_sql('", ['), _dq_list("all_values"), lit_sql("])")),
            "is_contained_in", values="all_values")
        items.append((f"singles_ratio <= {CATEGORICAL_MAX_SINGLES}", row))
    if "fractional_categorical" in rules:
        p = "(top_cnt / n_rows)"
        target = _lower_sql(p, "n_rows")
        cond = (f"singles_ratio <= {FRACTIONAL_MAX_SINGLES} AND top_cnt >= {FRACTIONAL_COVERAGE} * n_rows "
                f"AND size(top_values) < bins")
        row = _row_sql(
            "fractional_categorical", name, _cat(lit_sql("Compliance: "), _f4(p)),
            _cat(_Q, "column", lit_sql("' has value range "), _sq_list("top_values"), lit_sql(" for at least "),
                 _f2(target), lit_sql(" of values")),
            _cat(lit_sql('.isContainedIn("'), "column", lit_sql('", ['), _dq_list("top_values"),
                 lit_sql("], lambda x: x >= "), _f2(target), lit_sql(', hint="It should be above '), _f2(target),
                 lit_sql('!")')),
            "is_contained_in", values="top_values", threshold=target)
        items.append((cond, row))
    if not items:
        return []
    structs = ", ".join(
        f"CASE WHEN {cond} THEN named_struct("
        + ", ".join(f"'{e.rsplit(' AS ', 1)[1]}', {e.rsplit(' AS ', 1)[0]}" for e in row) + ") END"
        for cond, row in items)
    out = per_col.selectExpr(f"inline(filter(array({structs}), x -> x IS NOT NULL))")
    return [out.select(*SUGGESTION_SCHEMA.fieldNames())]


def suggest_constraints(profiles: ColumnProfiles, rules=DEFAULT_RULES) -> DataFrame:
    """All suggestions as rows (SUGGESTION_SCHEMA)."""
    fr = profiles.frame
    completeness_name = _cat(lit_sql("CompletenessConstraint(Completeness("), "column", lit_sql("))"))
    parts: list[DataFrame] = []
    if "complete" in rules:
        parts.append(fr.where("completeness = 1.0").selectExpr(*_row_sql(
            "complete", completeness_name, _cat(lit_sql("Completeness: "), _f4("completeness")),
            _cat(_Q, "column", lit_sql("' is not null")),
            _cat(lit_sql('.isComplete("'), "column", lit_sql('")')), "is_complete")))
    if "retain_completeness" in rules:
        target = _lower_sql("completeness", "n_rows")
        parts.append(fr.where(f"completeness > {MIN_COMPLETENESS} AND completeness < 1.0").selectExpr(*_row_sql(
            "retain_completeness", completeness_name, _cat(lit_sql("Completeness: "), _f4("completeness")),
            _cat(_Q, "column", lit_sql("' has completeness of at least "), _f2(target)),
            _cat(lit_sql('.hasCompleteness("'), "column", lit_sql('", lambda x: x >= '), _f2(target),
                 lit_sql(', hint="It should be above '), _f2(target), lit_sql('!")')),
            "has_completeness", threshold=target)))
    if "retain_type" in rules:
        parts.append(fr.where("is_inferred AND data_type IN ('Integral', 'Fractional', 'Boolean')").selectExpr(
            *_row_sql("retain_type", _cat(lit_sql("DataTypeConstraint("), "column", lit_sql(","), "data_type",
                                          lit_sql(")")),
                      _cat(lit_sql("DataType: "), "data_type"),
                      _cat(_Q, "column", lit_sql("' has type "), "data_type"),
                      _cat(lit_sql('.hasDataType("'), "column", lit_sql('", ConstrainableDataTypes.'), "data_type",
                           lit_sql(")")),
                      "has_data_type", dtype="data_type")))
    parts += _categorical(profiles, rules)
    if "non_negative" in rules:
        parts.append(fr.where("profile_kind = 'numeric' AND minimum >= 0").selectExpr(*_row_sql(
            "non_negative", _cat(lit_sql("NonNegativeConstraint("), "column", lit_sql(")")),
            _cat(lit_sql("Minimum: "), _f4("minimum")), _cat(_Q, "column", lit_sql("' has no negative values")),
            _cat(lit_sql('.isNonNegative("'), "column", lit_sql('")')), "is_non_negative")))
    if "unique" in rules:
        ratio = "(approx_distinct / n_rows)"
        parts.append(fr.where(f"completeness = 1.0 AND abs(1 - {ratio}) <= {UNIQUE_TOLERANCE}").selectExpr(*_row_sql(
            "unique", _cat(lit_sql("UniquenessConstraint("), "column", lit_sql(")")),
            _cat(lit_sql("ApproxDistinctness: "), _f4(ratio)), _cat(_Q, "column", lit_sql("' is unique")),
            _cat(lit_sql('.isUnique("'), "column", lit_sql('")')), "is_unique")))
    if not parts:
        return fr.sparkSession.createDataFrame([], SUGGESTION_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def suggest(df: DataFrame, rules=DEFAULT_RULES) -> DataFrame:
    from .profile import profile_columns
    return suggest_constraints(profile_columns(df), rules)
