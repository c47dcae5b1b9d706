"""DuckDB twins of the registered queries (the correctness oracle).

Written independently of the Spark operators: plain SQL over the driver's
views (region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations).
"""

from __future__ import annotations

from .fixtures import EVENT_TEXTS_SQL, EVENTS_WITH_HOLES_SQL, ORDER_RULES_SQL
from .queries import (CORRELATION_PAIRS, EVENT_RULES)

ORACLE: dict[str, str] = {}

EVENTS_COLS = [("event_id", "num"), ("ts", "other"), ("user_id", "num"), ("event_type", "str"),
               ("value", "num"), ("props", "str")]
LINEITEM_COLS = [("l_orderkey", "num"), ("l_partkey", "num"), ("l_suppkey", "num"), ("l_linenumber", "num"),
                 ("l_quantity", "num"), ("l_extendedprice", "num"), ("l_discount", "num"), ("l_tax", "num"),
                 ("l_returnflag", "str"), ("l_linestatus", "str"), ("l_shipdate", "other")]
ORDERS_COLS = [("o_orderkey", "num"), ("o_custkey", "num"), ("o_orderstatus", "str"), ("o_totalprice", "num"),
               ("o_orderdate", "other"), ("o_orderpriority", "str")]


def _m(entity, instance, name, expr, src):
    return (f"SELECT '{entity}' AS entity, '{instance}' AS instance, '{name}' AS name, "
            f"CAST({expr} AS DOUBLE) AS value FROM {src}")


def _profile_sql(src: str, cols, std=False, nulls=False) -> str:
    parts = [_m("Dataset", "*", "Size", "count(*)", src)]
    for c, kind in cols:
        parts.append(_m("Column", c, "Completeness", f"CAST(count({c}) AS DOUBLE) / count(*)", src))
        if nulls:
            parts.append(_m("Column", c, "NullCount", f"count(*) - count({c})", src))
        if kind == "num":
            parts += [_m("Column", c, "Minimum", f"min(CAST({c} AS DOUBLE))", src),
                      _m("Column", c, "Maximum", f"max(CAST({c} AS DOUBLE))", src),
                      _m("Column", c, "Mean", f"avg(CAST({c} AS DOUBLE))", src),
                      _m("Column", c, "Sum", f"sum(CAST({c} AS DOUBLE))", src)]
            if std:
                parts.append(_m("Column", c, "StandardDeviation", f"stddev_pop(CAST({c} AS DOUBLE))", src))
        elif kind == "str":
            parts += [_m("Column", c, "MaxLength", f"max(length({c}))", src),
                      _m("Column", c, "MinLength", f"min(length({c}))", src)]
    body = "\nUNION ALL\n".join(parts)
    return (f"SELECT entity, instance, name, round(value, 6) AS value, "
            f"CASE WHEN entity = 'Dataset' THEN 'Dataset' WHEN entity = 'Column' THEN 'Column' "
            f"ELSE 'unknown' END AS type FROM (\n{body}\n) m WHERE value IS NOT NULL")


HOLES = f"(\n{EVENTS_WITH_HOLES_SQL}\n)"
HOUR = f"(SELECT * FROM {HOLES} h WHERE ts >= TIMESTAMP '2024-01-02 03:00:00' AND ts < TIMESTAMP '2024-01-02 04:00:00')"
DAY = f"(SELECT * FROM {HOLES} h WHERE ts >= TIMESTAMP '2024-01-02 00:00:00' AND ts < TIMESTAMP '2024-01-03 00:00:00')"

ORACLE["profile_events_hour"] = _profile_sql(f"{HOUR} s", EVENTS_COLS)
ORACLE["profile_events_day"] = _profile_sql(f"{DAY} s", EVENTS_COLS, std=True)
ORACLE["profile_lineitem"] = _profile_sql("lineitem", LINEITEM_COLS, std=True, nulls=True)


def _approx_bound(tbl, cols):
    return "\nUNION ALL\n".join(
        f"SELECT '{tbl}' AS tbl, '{c}' AS instance, count(DISTINCT {c}) AS exact_distinct, TRUE AS within_bound "
        f"FROM {tbl}" for c, _ in cols)


ORACLE["approx_distinct_bound"] = _approx_bound("orders", ORDERS_COLS) + "\nUNION ALL\n" + \
    _approx_bound("lineitem", LINEITEM_COLS)


def _entropy(tbl, cols):
    return "\nUNION ALL\n".join(
        f"SELECT '{tbl}' AS tbl, '{c}' AS instance, 'Entropy' AS name, "
        f"round(ln(sum(cnt)) - sum(cnt * ln(cnt)) / sum(cnt), 6) AS value "
        f"FROM (SELECT {c}, CAST(count(*) AS DOUBLE) AS cnt FROM {tbl} WHERE {c} IS NOT NULL GROUP BY {c}) f"
        for c, _ in cols)


ORACLE["entropy_columns"] = _entropy("events", EVENTS_COLS) + "\nUNION ALL\n" + _entropy("orders", ORDERS_COLS)

ORACLE["correlation_pairs"] = "\nUNION ALL\n".join(
    f"SELECT 'Multicolumn' AS entity, '{a},{b}' AS instance, 'Correlation' AS name, "
    f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS value FROM lineitem"
    for a, b in CORRELATION_PAIRS)

ORACLE["compliance_rules"] = "\nUNION ALL\n".join(
    f"SELECT 'Column' AS entity, '{n}' AS instance, 'Compliance' AS name, "
    f"round(avg(CASE WHEN ({p}) THEN 1.0 ELSE 0.0 END), 6) AS value FROM {HOLES} h"
    for n, p in EVENT_RULES)

ORACLE["null_counts"] = "\nUNION ALL\n".join(
    f"SELECT 'Column' AS entity, '{c}' AS instance, 'NullCount' AS name, "
    f"round(CAST(count(*) - count({c}) AS DOUBLE), 6) AS value FROM {HOLES} h\nUNION ALL\n"
    f"SELECT 'Column' AS entity, '{c}' AS instance, 'NullShare' AS name, "
    f"round(1.0 - CAST(count({c}) AS DOUBLE) / count(*), 6) AS value FROM {HOLES} h"
    for c, _ in EVENTS_COLS)

ORACLE["slice_day"] = ("SELECT event_id, ts, event_type FROM events "
                       "WHERE ts >= TIMESTAMP '2024-01-02 00:00:00' AND ts < TIMESTAMP '2024-01-03 00:00:00'")
ORACLE["slice_trailing_days"] = ("SELECT event_id, ts FROM events "
                                 "WHERE CAST(ts AS DATE) IN (DATE '2024-01-08', DATE '2024-01-09')")
ORACLE["slice_same_hour_label"] = (
    "SELECT event_id, ts, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN 1 ELSE 0 END AS label "
    "FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-07' AND DATE '2024-01-10' AND hour(ts) = 4")

ORACLE["value_histogram"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS cnt, "
    f"round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM orders), 6) AS ratio "
    f"FROM orders WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in ("o_orderstatus", "o_orderpriority"))

_INT, _FRAC, _BOOL = r"^[+-]? ?\d+$", r"^[+-]? ?\d*\.\d*$", r"^(true|false)$"


def _class(c):
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN regexp_matches({c}, '{_INT}') THEN 'Integral' "
            f"WHEN regexp_matches({c}, '{_FRAC}') THEN 'Fractional' "
            f"WHEN regexp_matches({c}, '{_BOOL}') THEN 'Boolean' ELSE 'String' END")


def _infer(ni, nf, nb, ns):
    return (f"CASE WHEN {ns} > 0 THEN 'String' WHEN {nb} > 0 AND ({ni} > 0 OR {nf} > 0) THEN 'String' "
            f"WHEN {nb} > 0 THEN 'Boolean' WHEN {nf} > 0 THEN 'Fractional' WHEN {ni} > 0 THEN 'Integral' "
            f"ELSE 'Unknown' END")


TEXTS = f"(\n{EVENT_TEXTS_SQL}\n)"
TEXT_COLS = ["user_text", "price_text", "flag_text", "mixed_text", "type_text", "props_text"]
ORACLE["inferred_types"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", ni AS n_integral, nf AS n_fractional, nb AS n_boolean, ns AS n_string, "
    f"{_infer('ni', 'nf', 'nb', 'ns')} AS inferred FROM ("
    f"SELECT count(*) FILTER (WHERE k = 'Integral') AS ni, count(*) FILTER (WHERE k = 'Fractional') AS nf, "
    f"count(*) FILTER (WHERE k = 'Boolean') AS nb, count(*) FILTER (WHERE k = 'String') AS ns "
    f"FROM (SELECT {_class(c)} AS k FROM {TEXTS} t) x) y"
    for c in TEXT_COLS)


def _profile_rows_sql():
    n = "(SELECT CAST(count(*) AS DOUBLE) FROM orders)"
    parts = []
    for c, kind in ORDERS_COLS:
        dtype = {"num": "Integral" if c in ("o_orderkey", "o_custkey") else "Fractional",
                 "str": "String", "other": "Unknown"}[kind]
        sel = f"SELECT '{c}' AS \"column\", '{dtype}' AS data_type, "
        parts.append(sel + f"'completeness' AS metric, CAST(count({c}) AS DOUBLE) / count(*) AS value FROM orders")
        parts.append(sel + f"'nullCount' AS metric, CAST(count(*) - count({c}) AS DOUBLE) AS value FROM orders")
        if kind == "num":
            for m, e in (("mean", "avg"), ("maximum", "max"), ("minimum", "min"), ("stdDev", "stddev_pop"),
                         ("sum", "sum")):
                parts.append(sel + f"'{m}' AS metric, {e}(CAST({c} AS DOUBLE)) AS value FROM orders")
        elif kind == "str":
            parts.append(sel + f"'minLength' AS metric, CAST(min(length({c})) AS DOUBLE) AS value FROM orders")
            parts.append(sel + f"'maxLength' AS metric, CAST(max(length({c})) AS DOUBLE) AS value FROM orders")
    parts.append(f"SELECT '' AS \"column\", '' AS data_type, 'Size' AS metric, {n} AS value")
    body = "\nUNION ALL\n".join(parts)
    return ("SELECT '2024-01-01 07:00:00' AS dataTimestamp_Formatted, \"column\", data_type, metric, "
            f"round(value, 6) AS value FROM (\n{body}\n) p")


ORACLE["profile_orders_columns"] = _profile_rows_sql()


# ------------------------------------------------------------------ suggestions

_RULE_TEXT = {
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
}


def _lower(p, n):
    return f"(floor(100.0 * ({p} - 1.96 * sqrt({p} * (1.0 - {p}) / {n}))) / 100.0)"


def _suggest_sql(src: str, tbl: str, cols, with_values: bool = False) -> str:
    """cols: (name, kind) with kind in int / frac / str / other."""
    prof = []
    hist = []
    for c, kind in cols:
        if kind in ("int", "frac"):
            dt = "'Integral'" if kind == "int" else "'Fractional'"
            prof.append(f"SELECT '{c}' AS col, {dt} AS data_type, FALSE AS is_inferred, count(*) AS n_rows, "
                        f"CAST(count({c}) AS DOUBLE) / count(*) AS completeness, 'numeric' AS profile_kind, "
                        f"min(CAST({c} AS DOUBLE)) AS minimum, count(DISTINCT {c}) AS nd FROM {src}")
        elif kind == "str":
            k = _class(c)
            dt = _infer("ni", "nf", "nb", "ns")
            prof.append(
                f"SELECT '{c}' AS col, {dt} AS data_type, TRUE AS is_inferred, n_rows, completeness, "
                f"CASE WHEN {dt} IN ('Integral', 'Fractional') THEN 'numeric' WHEN {dt} = 'String' THEN 'string' "
                f"ELSE 'standard' END AS profile_kind, "
                f"CASE WHEN {dt} IN ('Integral', 'Fractional') THEN mn END AS minimum, nd FROM ("
                f"SELECT count(*) AS n_rows, CAST(count({c}) AS DOUBLE) / count(*) AS completeness, "
                f"min(TRY_CAST({c} AS DOUBLE)) AS mn, count(DISTINCT {c}) AS nd, "
                f"count(*) FILTER (WHERE {k} = 'Integral') AS ni, count(*) FILTER (WHERE {k} = 'Fractional') AS nf, "
                f"count(*) FILTER (WHERE {k} = 'Boolean') AS nb, count(*) FILTER (WHERE {k} = 'String') AS ns "
                f"FROM {src}) x")
            hist.append(f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value, count(*) AS cnt FROM {src} "
                        f"WHERE {c} IS NOT NULL GROUP BY {c}")
        else:
            prof.append(f"SELECT '{c}' AS col, 'Unknown' AS data_type, FALSE AS is_inferred, count(*) AS n_rows, "
                        f"CAST(count({c}) AS DOUBLE) / count(*) AS completeness, 'standard' AS profile_kind, "
                        f"CAST(NULL AS DOUBLE) AS minimum, count(DISTINCT {c}) AS nd FROM {src}")
    prof_sql = "\nUNION ALL\n".join(prof)
    hist_sql = "\nUNION ALL\n".join(hist) if hist else \
        "SELECT CAST(NULL AS VARCHAR) AS col, CAST(NULL AS VARCHAR) AS value, 0 AS cnt WHERE FALSE"
    dq = "'\"' || replace(replace(value, '\\', '\\\\'), '\"', '\\\"') || '\"'"
    sq = "'''' || value || ''''"
    t = lambda r: (f"'{_RULE_TEXT[r][0]}' AS suggesting_rule, '{_RULE_TEXT[r][1]}' AS rule_description")  # noqa
    r2 = _lower("completeness", "n_rows")
    p5 = "(CAST(top_cnt AS DOUBLE) / n_rows)"
    r5 = _lower(p5, "n_rows")
    extra = ", vals, dt, CAST(threshold AS DOUBLE) AS raw_threshold" if with_values else ""
    return f"""
WITH prof AS (
{prof_sql}
), hist AS (
SELECT h.col, h.value, h.cnt, p.n_rows FROM ({hist_sql}) h JOIN prof p ON h.col = p.col
WHERE p.data_type = 'String' AND p.nd <= 120
), ranked AS (
SELECT *, coalesce(sum(cnt) OVER (PARTITION BY col ORDER BY cnt DESC, value ASC
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cum_before
FROM hist
), cat AS (
SELECT col, count(*) AS bins, sum(CASE WHEN cnt = 1 THEN 1 ELSE 0 END) AS singles, any_value(n_rows) AS n_rows,
       string_agg({dq}, ', ' ORDER BY cnt DESC, value ASC) AS all_dq,
       string_agg({sq}, ', ' ORDER BY cnt DESC, value ASC) AS all_sq,
       string_agg({dq}, ', ' ORDER BY cnt DESC, value ASC) FILTER (WHERE cum_before < 0.9 * n_rows) AS top_dq,
       string_agg({sq}, ', ' ORDER BY cnt DESC, value ASC) FILTER (WHERE cum_before < 0.9 * n_rows) AS top_sq,
       list(value ORDER BY cnt DESC, value ASC) AS all_vals,
       list(value ORDER BY cnt DESC, value ASC) FILTER (WHERE cum_before < 0.9 * n_rows) AS top_vals,
       sum(cnt) FILTER (WHERE cum_before < 0.9 * n_rows) AS top_cnt,
       count(*) FILTER (WHERE cum_before < 0.9 * n_rows) AS top_size
FROM ranked GROUP BY col
), s AS (
SELECT 'CompletenessConstraint(Completeness(' || col || '))' AS constraint_name, col AS column_name,
       'Completeness: ' || printf('%.4f', floor((completeness) * 10000 + 0.5) / 10000) AS current_value, '''' || col || ''' is not null' AS description,
       {t('complete')}, '.isComplete("' || col || '")' AS code_for_constraint, 'is_complete' AS kind, 1.0 AS threshold,
       CAST(NULL AS VARCHAR[]) AS vals, CAST(NULL AS VARCHAR) AS dt
FROM prof WHERE completeness = 1.0
UNION ALL
SELECT 'CompletenessConstraint(Completeness(' || col || '))', col,
       'Completeness: ' || printf('%.4f', floor((completeness) * 10000 + 0.5) / 10000),
       '''' || col || ''' has completeness of at least ' || printf('%.2f', floor(({r2}) * 100 + 0.5) / 100),
       {t('retain_completeness')},
       '.hasCompleteness("' || col || '", lambda x: x >= ' || printf('%.2f', floor(({r2}) * 100 + 0.5) / 100) || ', hint="It should be above '
         || printf('%.2f', floor(({r2}) * 100 + 0.5) / 100) || '!")', 'has_completeness', {r2}, CAST(NULL AS VARCHAR[]), NULL
FROM prof WHERE completeness > 0.2 AND completeness < 1.0
UNION ALL
SELECT 'DataTypeConstraint(' || col || ',' || data_type || ')', col, 'DataType: ' || data_type,
       '''' || col || ''' has type ' || data_type, {t('retain_type')},
       '.hasDataType("' || col || '", ConstrainableDataTypes.' || data_type || ')', 'has_data_type', 1.0, CAST(NULL AS VARCHAR[]), data_type
FROM prof WHERE is_inferred AND data_type IN ('Integral', 'Fractional', 'Boolean')
UNION ALL
SELECT 'ContainedInConstraint(' || col || ')', col, 'Compliance: 1', '''' || col || ''' has value range ' || all_sq,
       {t('categorical')}, '.isContainedIn("' || col || '", [' || all_dq || '])', 'is_contained_in', 1.0, all_vals, NULL
FROM cat WHERE CAST(singles AS DOUBLE) / bins <= 0.1
UNION ALL
SELECT 'ContainedInConstraint(' || col || ')', col, 'Compliance: ' || printf('%.4f', floor(({p5}) * 10000 + 0.5) / 10000),
       '''' || col || ''' has value range ' || top_sq || ' for at least ' || printf('%.2f', floor(({r5}) * 100 + 0.5) / 100) || ' of values',
       {t('fractional_categorical')},
       '.isContainedIn("' || col || '", [' || top_dq || '], lambda x: x >= ' || printf('%.2f', floor(({r5}) * 100 + 0.5) / 100)
         || ', hint="It should be above ' || printf('%.2f', floor(({r5}) * 100 + 0.5) / 100) || '!")', 'is_contained_in', {r5}, top_vals, NULL
FROM cat WHERE CAST(singles AS DOUBLE) / bins <= 0.4 AND top_cnt >= 0.9 * n_rows AND top_size < bins
UNION ALL
SELECT 'NonNegativeConstraint(' || col || ')', col, 'Minimum: ' || printf('%.4f', floor((minimum) * 10000 + 0.5) / 10000),
       '''' || col || ''' has no negative values', {t('non_negative')}, '.isNonNegative("' || col || '")',
       'is_non_negative', 1.0, CAST(NULL AS VARCHAR[]), NULL
FROM prof WHERE profile_kind = 'numeric' AND minimum >= 0
)
SELECT '{tbl}' AS tbl, constraint_name, column_name, current_value, description, suggesting_rule,
       rule_description, code_for_constraint, kind, round(CAST(threshold AS DOUBLE), 6) AS threshold{extra} FROM s
"""


_ORDERS_S = [("o_orderkey", "int"), ("o_custkey", "int"), ("o_orderstatus", "str"), ("o_totalprice", "frac"),
             ("o_orderdate", "other"), ("o_orderpriority", "str")]
_EVENTS_S = [("event_id", "int"), ("ts", "other"), ("user_id", "int"), ("event_type", "str"),
             ("value", "frac"), ("props", "str")]
ORACLE["suggest_rules"] = ("SELECT * FROM (" + _suggest_sql("orders", "orders", _ORDERS_S) + ") a\nUNION ALL\n"
                           + "SELECT * FROM (" + _suggest_sql(f"{HOLES} h", "events", _EVENTS_S) + ") b")
_CATEGORY = ("(SELECT CASE WHEN event_id % 20 = 0 THEN 'rare_' || CAST(user_id % 10 AS VARCHAR) "
             "ELSE event_type END AS category FROM events) c")
ORACLE["suggest_fractional_categories"] = (
    "SELECT * FROM (" + _suggest_sql(_CATEGORY, "events_category", [("category", "str")])
    + ") q WHERE suggesting_rule LIKE 'Fractional%'")


# ------------------------------------------------------------------ verification

def _rule_value_sql(rule, src):
    c = rule.column_name
    k = rule.kind
    if k in ("is_complete", "has_completeness"):
        return f"CAST(count({c}) AS DOUBLE) / count(*)"
    if k == "is_contained_in":
        vals = ", ".join("'" + v.replace("'", "''") + "'" for v in rule.values)
        return f"avg(CASE WHEN {c} IS NULL OR CAST({c} AS VARCHAR) IN ({vals}) THEN 1.0 ELSE 0.0 END)"
    if k == "is_non_negative":
        return f"avg(CASE WHEN coalesce(CAST({c} AS DOUBLE), 0.0) >= 0 THEN 1.0 ELSE 0.0 END)"
    if k == "satisfies":
        return f"avg(CASE WHEN ({rule.predicate}) THEN 1.0 ELSE 0.0 END)"
    if k == "has_data_type":
        want = {"Numeric": "('Integral', 'Fractional')"}.get(rule.dtype, f"('{rule.dtype}')")
        return (f"CAST(sum(CASE WHEN ({_class(f'CAST({c} AS VARCHAR)')}) IN {want} THEN 1 ELSE 0 END) AS DOUBLE) "
                f"/ count({c})")
    if k == "is_unique":
        return (f"(SELECT CAST(count(*) FILTER (WHERE cnt = 1) AS DOUBLE) / sum(cnt) FROM "
                f"(SELECT {c}, count(*) AS cnt FROM {src} WHERE {c} IS NOT NULL GROUP BY {c}) g)")
    raise ValueError(k)


def _verify_sql(check, src, rules, cols=("check", "check_level", "check_status", "constraint", "constraint_status",
                                          "constraint_message", "value", "status_value")):
    parts = [f"SELECT '{check}' AS chk, '{r.constraint_name}' AS cons, {_rule_value_sql(r, src)} AS v, "
             f"{float(r.threshold if r.threshold is not None else 1.0)} AS thr, count(*) AS n FROM {src}"
             for r in rules]
    body = "\nUNION ALL\n".join(parts)
    ok = "coalesce(v >= thr, FALSE)"
    exprs = {
        "check": "chk AS \"check\"",
        "check_level": "'Warning' AS check_level",
        "check_status": f"CASE WHEN bool_and({ok}) OVER (PARTITION BY chk) THEN 'Success' ELSE 'Warning' END "
                        f"AS check_status",
        "constraint": "cons AS \"constraint\"",
        "constraint_status": f"CASE WHEN {ok} THEN 'Success' ELSE 'Failure' END AS constraint_status",
        "constraint_message": f"CASE WHEN n = 0 THEN 'no rows' WHEN {ok} THEN '' ELSE 'Value: ' || "
                              f"coalesce(printf('%.4f', floor((v) * 10000 + 0.5) / 10000), 'NULL') || ' does not meet the constraint requirement!' "
                              f"END AS constraint_message",
        "value": "round(v, 6) AS value",
        "status_value": f"CASE WHEN {ok} THEN 1 ELSE 0 END AS status_value",
    }
    return f"SELECT {', '.join(exprs[c] for c in cols)} FROM (\n{body}\n) r"


def _verify_oracles():
    from .queries import EVENT_CHECK_RULES, ORDER_CHECK_RULES
    from ..operators.verify import Rule
    ORACLE["verify_rules"] = (_verify_sql("events_check", f"{HOLES} h", EVENT_CHECK_RULES) + "\nUNION ALL\n"
                              + _verify_sql("orders_check", "orders", ORDER_CHECK_RULES))
    short = ("check", "check_status", "constraint", "constraint_status", "constraint_message", "value")
    ORACLE["verify_unique"] = _verify_sql("orders_unique", "orders", [
        Rule("orderkey_unique", "o_orderkey", "is_unique"), Rule("custkey_unique", "o_custkey", "is_unique"),
        Rule("status_unique", "o_orderstatus", "is_unique")], short)
    ORACLE["verify_datatype"] = _verify_sql("text_types", f"{TEXTS} t", [
        Rule("user_text_integral", "user_text", "has_data_type", dtype="Integral"),
        Rule("price_text_fractional", "price_text", "has_data_type", dtype="Fractional"),
        Rule("user_text_fractional", "user_text", "has_data_type", dtype="Fractional"),
        Rule("user_text_numeric", "user_text", "has_data_type", dtype="Numeric"),
        Rule("flag_text_boolean", "flag_text", "has_data_type", dtype="Boolean"),
        Rule("mixed_text_integral", "mixed_text", "has_data_type", dtype="Integral"),
        Rule("props_text_integral", "props_text", "has_data_type", dtype="Integral")], short)


def _many_rules_sql():
    """Rules as rows against measures as rows."""
    parts, counts = [], []
    for c, kind in EVENTS_COLS:
        k = _class(f"CAST({c} AS VARCHAR)")
        sign = f"coalesce({c}, 0) >= 0" if kind == "num" else f"coalesce(TRY_CAST({c} AS DOUBLE), 0) >= 0" if kind == "str" else "NULL"
        parts.append(f"SELECT '{c}' AS c, count(*) AS n, count({c}) AS nn, count(*) FILTER ({sign}) AS pos, "
                     + ", ".join(f"count(*) FILTER (({k}) = '{x}') AS n_{x.lower()}" for x in ("Integral", "Fractional", "Boolean", "String"))
                     + f" FROM {HOLES} h")
        counts.append(f"SELECT '{c}' AS c, CAST({c} AS VARCHAR) AS v, count(*) AS cnt FROM {HOLES} h WHERE {c} IS NOT NULL GROUP BY {c}")
    return f"""
WITH r AS ({ORDER_RULES_SQL}), m AS ({" UNION ALL ".join(parts)}), vc AS MATERIALIZED ({" UNION ALL ".join(counts)}),
u AS (SELECT c, CAST(count(*) FILTER (cnt = 1) AS DOUBLE) / sum(cnt) AS u FROM vc GROUP BY c),
inside AS (SELECT x.column_name, x.vals, sum(vc.cnt) AS hits FROM (SELECT column_name, vals, unnest(list_distinct(vals)) AS v FROM (SELECT DISTINCT column_name, vals FROM r)) x
           JOIN vc ON vc.c = x.column_name AND vc.v = x.v GROUP BY x.column_name, x.vals),
v AS (SELECT r.*, m.n, CASE
        WHEN kind IN ('is_complete', 'has_completeness') THEN CAST(nn AS DOUBLE) / n
        WHEN kind = 'is_non_negative' AND r.column_name <> 'ts' THEN CAST(pos AS DOUBLE) / n
        WHEN kind = 'has_data_type' THEN CAST(CASE dtype WHEN 'Integral' THEN n_integral WHEN 'Fractional' THEN n_fractional WHEN 'Boolean' THEN n_boolean
             WHEN 'String' THEN n_string ELSE n_integral + n_fractional END AS DOUBLE) / nn
        WHEN kind = 'is_contained_in' THEN CAST(n - nn + coalesce(hits, 0) AS DOUBLE) / n
        WHEN kind = 'is_unique' THEN u.u END AS value
      FROM r LEFT JOIN m ON m.c = r.column_name LEFT JOIN u ON u.c = r.column_name
      LEFT JOIN inside i ON i.column_name = r.column_name AND i.vals = r.vals),
o AS (SELECT *, coalesce(value >= threshold, FALSE) AS ok FROM v)
SELECT 'events_rules' AS "check", CASE WHEN bool_and(ok) OVER () THEN 'Success' ELSE 'Warning' END AS check_status, constraint_name AS "constraint",
       CASE WHEN ok THEN 'Success' ELSE 'Failure' END AS constraint_status,
       CASE WHEN column_name = 'gone' THEN 'Input data does not include column gone!'
            WHEN column_name = 'ts' AND kind = 'is_non_negative' THEN 'Cannot evaluate kind is_non_negative!' WHEN ok THEN ''
            ELSE 'Value: ' || coalesce(printf('%.4f', floor(value * 10000 + 0.5) / 10000), 'NULL') || ' does not meet the constraint requirement!' END AS constraint_message,
       round(value, 6) AS value, CASE WHEN ok THEN 1 ELSE 0 END AS status_value
FROM o
"""


_verify_oracles()
ORACLE["verify_many_rules"] = _many_rules_sql()


# ------------------------------------------------------------------ rule lifecycle

from .fixtures import (METRIC_HISTORY_SQL, PART_NEW_SQL, PART_OLD_SQL, PART_RANKED_SQL,  # noqa: E402
                       VERIFICATION_HISTORY_SQL)

_KEYS = ("constraint_name", "column_name", "code_for_constraint")
_ON = " AND ".join(f"n.{k} IS NOT DISTINCT FROM o.{k}" for k in _KEYS)
_PICK = ", ".join(f"CASE WHEN n.constraint_name IS NOT NULL THEN n.{k} ELSE o.{k} END AS {k}" for k in _KEYS)

ORACLE["merge_rules"] = f"""
WITH n AS (SELECT *, 'low' AS level, 1 AS frequency, 0 AS active, TIMESTAMP '2024-02-01 00:00:00' AS created_at
           FROM ({PART_NEW_SQL}) x),
     o AS ({PART_OLD_SQL})
SELECT {_PICK},
       coalesce(n.current_value, o.current_value) AS current_value,
       coalesce(n.description, o.description) AS description,
       coalesce(n.suggesting_rule, o.suggesting_rule) AS suggesting_rule,
       coalesce(n.rule_description, o.rule_description) AS rule_description,
       coalesce(o.level, n.level) AS level,
       CAST(CASE WHEN o.constraint_name IS NOT NULL AND n.constraint_name IS NOT NULL THEN o.frequency + 1
                 WHEN o.constraint_name IS NOT NULL THEN o.frequency ELSE 1 END AS INTEGER) AS frequency,
       CAST(coalesce(o.active, 0) AS INTEGER) AS active,
       CASE WHEN o.created_at IS NOT NULL THEN o.created_at ELSE n.created_at END AS created_at,
       TIMESTAMP '2024-02-01 00:00:00' AS updated_at
FROM n FULL OUTER JOIN o ON {_ON}
"""

ORACLE["activate_rules"] = f"""
WITH r AS ({PART_RANKED_SQL}),
nh AS (SELECT *, row_number() OVER (ORDER BY frequency DESC NULLS LAST, constraint_name ASC NULLS FIRST,
                                             column_name ASC NULLS FIRST, code_for_constraint ASC NULLS FIRST) AS rn,
              count(*) OVER () AS cnt
       FROM r WHERE level IS DISTINCT FROM 'high')
SELECT constraint_name, level, frequency, 1 AS active FROM r WHERE level = 'high'
UNION ALL
SELECT constraint_name, level, frequency, CASE WHEN rn <= floor(cnt * 0.8) THEN 1 ELSE 0 END AS active FROM nh
"""

ORACLE["top_rules"] = f"""
SELECT constraint_name, frequency FROM ({PART_RANKED_SQL}) r
ORDER BY frequency DESC, constraint_name, column_name, code_for_constraint LIMIT 50
"""

ORACLE["rest_except_all"] = """
SELECT o_orderstatus, o_orderpriority FROM orders
EXCEPT ALL
SELECT o_orderstatus, o_orderpriority FROM orders WHERE o_totalprice > 200000
"""

ORACLE["publish_rules"] = f"""
WITH n AS ({PART_NEW_SQL}), o AS ({PART_OLD_SQL})
SELECT {_PICK},
       CAST(CASE WHEN n.constraint_name IS NOT NULL AND o.constraint_name IS NOT NULL THEN 2 ELSE 1 END AS INTEGER)
         AS frequency,
       'low' AS level, CAST(0 AS INTEGER) AS active
FROM n FULL OUTER JOIN o ON {_ON}
"""


# ------------------------------------------------------------------ metric history

HIST = f"(\n{METRIC_HISTORY_SQL}\n)"
_FRESH = (f"(SELECT * FROM {HIST} x WHERE job IN (SELECT job FROM {HIST} y GROUP BY job "
          f"HAVING max(ts) >= TIMESTAMP '2024-01-30 00:00:00'))")
_SER = 'job, "table", entity, instance, name'

ORACLE["history_latest"] = (f"SELECT {_SER}, max(ts) AS ts, round(arg_max(value, ts), 6) AS value "
                            f"FROM {HIST} h GROUP BY {_SER}")

ORACLE["history_fresh"] = f"""
WITH h AS (SELECT * FROM {HIST} x WHERE ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 200 HOUR
                                    AND ts <= TIMESTAMP '2024-01-30 12:00:00'),
p AS (SELECT job, "table", max(ts) AS ts FROM h GROUP BY job, "table"),
f AS (SELECT job, "table" FROM p WHERE ts >= TIMESTAMP '2024-01-30 00:00:00'),
s AS (SELECT * FROM h WHERE name = 'Size' AND regexp_full_match(entity, 'Data.*')
        AND EXISTS (SELECT 1 FROM f WHERE f.job = h.job AND f."table" = h."table"))
SELECT job, "table", round(arg_max(value, ts), 6) AS value FROM s GROUP BY job, "table"
"""

ORACLE["history_null_pct"] = (f"SELECT \"table\", instance, round(1.0 - arg_max(value, ts), 6) AS null_pct "
                              f"FROM {_FRESH} h WHERE name = 'Completeness' GROUP BY \"table\", instance")
ORACLE["history_max_null"] = (f"SELECT \"table\", round(max(null_pct), 6) AS max_null_pct FROM ("
                              f"SELECT \"table\", instance, 1.0 - arg_max(value, ts) AS null_pct "
                              f"FROM {_FRESH} h WHERE name = 'Completeness' GROUP BY \"table\", instance) x "
                              f"GROUP BY \"table\"")
ORACLE["history_column_counts"] = f"""
SELECT "table",
       count(DISTINCT CASE WHEN name = 'Completeness' THEN instance END) AS n_columns,
       count(DISTINCT CASE WHEN name = 'Maximum' THEN instance END) AS n_numeric,
       count(DISTINCT CASE WHEN name = 'MaxLength' THEN instance END) AS n_string
FROM {_FRESH} h WHERE entity = 'Column' GROUP BY "table"
"""
_WIDE = ["Completeness", "Maximum", "MaxLength", "ApproxCountDistinct", "MinLength", "Minimum", "Mean", "Sum"]
ORACLE["history_wide"] = (
    "SELECT \"table\", instance, "
    + ", ".join(f"round(max(CASE WHEN name = '{m}' THEN v END), 6) AS {m}" for m in _WIDE)
    + f" FROM (SELECT \"table\", instance, name, arg_max(value, ts) AS v FROM {_FRESH} h "
    + "WHERE name IN (" + ", ".join(f"'{m}'" for m in _WIDE) + ") GROUP BY \"table\", instance, name) x "
    + "GROUP BY \"table\", instance")
ORACLE["history_tables"] = f"SELECT DISTINCT \"table\" FROM {HIST} h"

ORACLE["verification_latest"] = (
    f"SELECT \"constraint\", arg_max(constraint_status, ts) AS constraint_status, max(ts) AS ts, "
    f"round(arg_max(value, ts), 6) AS value FROM ({VERIFICATION_HISTORY_SQL}) v GROUP BY \"constraint\"")

ORACLE["attribution_share"] = """
WITH a AS (SELECT 'model_' || CAST(user_id % 4 AS VARCHAR) AS "table", event_type AS instance,
                  avg(abs(value)) AS value FROM events GROUP BY 1, 2)
SELECT "table", instance, round(value / sum(value) OVER (PARTITION BY "table"), 6) AS share FROM a
"""

ORACLE["alert_hold"] = f"""
WITH r AS (
  SELECT {_SER}, ts, value > 60 AS b,
         row_number() OVER (PARTITION BY {_SER} ORDER BY ts, value) AS rn,
         sum(CASE WHEN value > 60 THEN 1 ELSE 0 END) OVER (PARTITION BY {_SER} ORDER BY ts, value
                                                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rb
  FROM {HIST} h),
i AS (SELECT {_SER}, min(ts) AS start, max(ts) AS "end", count(*) AS n
      FROM r WHERE b GROUP BY {_SER}, rn - rb)
SELECT {_SER}, start, "end", n, round((epoch_us("end") - epoch_us(start)) / 1e6, 6) AS held_seconds
FROM i WHERE (epoch_us("end") - epoch_us(start)) / 1e6 >= 21600
"""

ORACLE["alert_absent"] = f"""
SELECT DISTINCT job, "table", instance, name FROM {HIST} h
WHERE ts >= TIMESTAMP '2024-01-29 00:00:00' AND ts < TIMESTAMP '2024-01-30 00:00:00'
EXCEPT
SELECT job, "table", instance, name FROM {HIST} h
WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00'
"""

ORACLE["metric_rate"] = f"""
SELECT {_SER}, ts, round(rate, 9) AS rate FROM (
  SELECT {_SER}, ts, lag(ts) OVER w AS pts,
         (value - lag(value) OVER w) / nullif((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6, 0) AS rate
  FROM {HIST} h WINDOW w AS (PARTITION BY {_SER} ORDER BY ts, value)) x
WHERE pts IS NOT NULL
"""


def _esc(c):
    return f"replace(replace(replace(coalesce({c}, ''), '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n')"


ORACLE["exposition_text"] = f"""
WITH l AS (SELECT job, "table" || '"\\' AS "table", entity, instance, name, arg_max(value, ts) AS value
           FROM {HIST} h GROUP BY job, "table", entity, instance, name)
SELECT regexp_replace('dq.' || job, '[^a-zA-Z0-9_]', '_', 'g') || '{{table="' || {_esc('"table"')}
       || '",entity="' || {_esc('entity')} || '",instance="' || {_esc('instance')}
       || '",name="' || {_esc('name')} || '"}} ' || printf('%.6f', value) AS line
FROM l
"""


# ------------------------------------------------------------------ ingestion / conformance

ORACLE["conform_cast"] = r"""
SELECT l_orderkey,
       TRY_CAST(CASE WHEN l_linenumber = 7 THEN 'bad' ELSE CAST(l_quantity AS VARCHAR) END AS DOUBLE) AS l_quantity,
       string_split(regexp_replace('[' || l_returnflag || ',' || l_linestatus || ']', '[\[\]]', '', 'g'), ',') AS tags,
       CAST(2 AS INTEGER) AS n_tags, CAST(NULL AS INTEGER) AS l_missing, CAST(l_linenumber AS VARCHAR) AS extra,
       TIMESTAMP '2024-02-01 00:00:00' AS processing_time
FROM lineitem
"""
ORACLE["csv_round_trip"] = "SELECT * FROM lineitem"
ORACLE["parse_json_props"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"
ORACLE["flatten_json"] = """
SELECT event_id, 'a_b_k' AS name, CAST(json_extract(props, '$.k') AS DOUBLE) AS value FROM events
UNION ALL SELECT event_id, 's_0__n', CAST(user_id AS DOUBLE) FROM events
UNION ALL SELECT event_id, 's_1_', CAST(event_id % 10 AS DOUBLE) FROM events
"""
ORACLE["table_from_path"] = r"""
SELECT event_id,
       regexp_replace(split_part(regexp_extract(p, '[^/]*$'), '.', 1), '_\d{8}_\d{4}-\d{4}$', '') AS tbl
FROM (SELECT event_id, '/data/in/' || event_type || '_' || strftime(ts, '%Y%m%d') || '_0000-0100.csv' AS p
      FROM events) x
"""
ORACLE["format_ts"] = ("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_str, "
                       "strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS ts_local FROM events")
ORACLE["write_stats"] = """
WITH s AS (SELECT l_returnflag AS partition_path, CAST(l_linenumber AS BIGINT) AS num_inserts,
                  CAST(trunc(l_quantity) AS BIGINT) AS num_writes,
                  CAST(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS BIGINT) AS num_deletes,
                  CAST(trunc(l_extendedprice) AS BIGINT) AS file_size FROM lineitem),
p AS (SELECT partition_path, sum(num_inserts) AS a, sum(num_writes) AS b, sum(num_deletes) AS c,
             sum(file_size) AS d FROM s GROUP BY partition_path),
t AS (SELECT sum(num_inserts) AS a, sum(num_writes) AS b, sum(file_size) AS d FROM s),
m AS (
  SELECT 'WriteStat' AS type, partition_path AS "column", 'numInserts' AS metric, CAST(a AS DOUBLE) AS value FROM p
  UNION ALL SELECT 'WriteStat', partition_path, 'numWrites', CAST(b AS DOUBLE) FROM p
  UNION ALL SELECT 'WriteStat', partition_path, 'numDeletes', CAST(c AS DOUBLE) FROM p
  UNION ALL SELECT 'WriteStat', partition_path, 'fileSizeInBytes', CAST(d AS DOUBLE) FROM p
  UNION ALL SELECT 'CommitSummary', NULL, 'totalInserts', CAST(a AS DOUBLE) FROM t
  UNION ALL SELECT 'CommitSummary', NULL, 'totalUpdates', 0.0 FROM t
  UNION ALL SELECT 'CommitSummary', NULL, 'totalRecordsWritten', CAST(b AS DOUBLE) FROM t
  UNION ALL SELECT 'CommitSummary', NULL, 'totalBytesWritten', CAST(d AS DOUBLE) FROM t)
SELECT type, "column", metric, value, CAST(CAST(value AS BIGINT) AS VARCHAR) AS value_str FROM m
UNION ALL SELECT 'CommitSummary', NULL, 'operationType', NULL, 'insert'
"""


def _metric_tables_sql():
    base = _profile_sql(f"{DAY} s", EVENTS_COLS)
    return (f"SELECT entity, instance, name, CAST(2 AS BIGINT) AS n, value, '2024-02-01 00:00:00' AS timestamp_str "
            f"FROM ({base}) q")


ORACLE["metric_tables"] = _metric_tables_sql()


# ------------------------------------------------------------------ drift / streaming

ORACLE["auc_exact"] = """
WITH s AS (SELECT value AS score, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label FROM events),
r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS mid FROM s),
a AS (SELECT (sum(mid) FILTER (WHERE label = 1) - count(*) FILTER (WHERE label = 1)
              * (count(*) FILTER (WHERE label = 1) + 1) / 2.0)
             / (CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) * count(*) FILTER (WHERE label = 0)) AS auc FROM r)
SELECT 'roc_auc' AS metric, round(auc, 6) AS value, CASE WHEN auc >= 0.6 THEN 'drift' ELSE 'ok' END AS verdict FROM a
"""

ORACLE["sample_by_label"] = (
    "SELECT *, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-30' THEN 1 ELSE 0 END AS label FROM events "
    "WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' AND hour(ts) = 4 "
    "AND substr(md5('42|' || CAST(event_id AS VARCHAR)), 1, 8) < '80000000'")

ORACLE["stratified_split"] = """
WITH c AS (SELECT CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label, count(*) AS n FROM events GROUP BY 1)
SELECT label, TRUE AS is_test, CAST(floor(n * 0.2 + 0.5) AS BIGINT) AS n FROM c
UNION ALL
SELECT label, FALSE AS is_test, CAST(n - floor(n * 0.2 + 0.5) AS BIGINT) AS n FROM c
"""


ORACLE["flatten_json_deep"] = """
SELECT event_id, repeat('k_0__', CAST(event_id % 7 AS BIGINT)) || 'v' AS name, CAST(user_id AS DOUBLE) AS value FROM events WHERE event_id % 11 <> 0
"""

ORACLE["job_gauges"] = "\nUNION ALL\n".join(
    f"SELECT 'data_profiling{{table=\"{t}\",entity=\"' || entity || '\",instance=\"' || instance || '\",name=\"' || name || '\"}}' AS gauge, value "
    f"FROM ({_profile_sql(f'{HOUR} s', EVENTS_COLS)}) p" for t in ("events", "shop/events"))

ORACLE["split_test_rows"] = f"""
SELECT event_id, event_type FROM (
  SELECT event_id, event_type, count(*) OVER (PARTITION BY event_type) AS n, row_number() OVER (
           PARTITION BY event_type ORDER BY ('0x' || substr(md5('42|' || CAST(event_id AS VARCHAR)), 1, 15))::BIGINT) AS r
  FROM {HOLES} h) x
WHERE r <= floor(n * 0.2 + 0.5)
"""


def _stream_profile_sql():
    parts = ["SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name, CAST(count(*) AS DOUBLE) AS value "
             "FROM events"]
    for c, kind in EVENTS_COLS:
        if kind == "num":
            parts += [f"SELECT 'Column', '{c}', 'Minimum', min(CAST({c} AS DOUBLE)) FROM events",
                      f"SELECT 'Column', '{c}', 'Maximum', max(CAST({c} AS DOUBLE)) FROM events",
                      f"SELECT 'Column', '{c}', 'Sum', sum(CAST({c} AS DOUBLE)) FROM events"]
        elif kind == "str":
            parts += [f"SELECT 'Column', '{c}', 'MinLength', CAST(min(length({c})) AS DOUBLE) FROM events",
                      f"SELECT 'Column', '{c}', 'MaxLength', CAST(max(length({c})) AS DOUBLE) FROM events"]
    return "SELECT entity, instance, name, round(value, 4) AS value FROM (" + "\nUNION ALL\n".join(parts) + ") s"


ORACLE["stream_profile"] = _stream_profile_sql()


def _stream_quality_sql():
    """The batch metrics of all rows, from the table and not from a stream."""
    from .queries import STREAM_PAIRS
    src = f"{HOLES} h"
    parts = [_m("Dataset", "*", "Size", "count(*)", src)]
    for c, kind in EVENTS_COLS:
        parts.append(_m("Column", c, "Completeness", f"CAST(count({c}) AS DOUBLE) / count(*)", src))
        parts.append(_m("Column", c, "ApproxCountDistinct within bound", "max(1)", src))
        parts.append(f"SELECT 'Column' AS entity, '{c}' AS instance, 'Entropy' AS name, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS value "
                     f"FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM {src} WHERE {c} IS NOT NULL GROUP BY {c}) f")
        if kind == "num":
            parts += [_m("Column", c, name, f"{fn}(CAST({c} AS DOUBLE))", src) for name, fn in (
                ("Minimum", "min"), ("Maximum", "max"), ("Mean", "avg"), ("Sum", "sum"), ("StandardDeviation", "stddev_pop"))]
        elif kind == "str":
            parts += [_m("Column", c, "MaxLength", f"max(length({c}))", src), _m("Column", c, "MinLength", f"min(length({c}))", src)]
    parts += [_m("Multicolumn", f"{a},{b}", "Correlation", f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))", src) for a, b in STREAM_PAIRS]
    parts += [_m("Column", n, "Compliance", f"avg(CASE WHEN ({p}) THEN 1.0 ELSE 0.0 END)", src) for n, p in EVENT_RULES]
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT entity, instance, name, round(value, 6) AS value FROM (\n{body}\n) m"


ORACLE["stream_quality"] = _stream_quality_sql()

ORACLE["history_distinct"] = (f"SELECT \"table\", instance, round(arg_max(value, ts), 6) AS value FROM {_FRESH} h "
                              f"WHERE name = 'ApproxCountDistinct' GROUP BY \"table\", instance")


def _job_profiling_sql():
    types = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
             "value": "double", "props": "string"}
    base = _profile_sql(f"{HOUR} s", EVENTS_COLS)
    dt = "CASE instance " + " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in types.items()) + " END"
    return (f"SELECT TIMESTAMP '2024-01-02 04:00:00' AS ts, 'events' AS \"table\", "
            f"TIMESTAMP '2024-01-02 03:00:00' AS slice_start, entity, instance, "
            f"CASE WHEN entity = 'Column' THEN {dt} END AS data_type, name AS metric, value, "
            f"CAST(NULL AS VARCHAR) AS value_str FROM ({base}) q")


ORACLE["job_profiling"] = _job_profiling_sql()


def _quality_loop_sql():
    trail = (f"(SELECT * FROM {HOLES} h WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' "
             f"AND ts < TIMESTAMP '2024-01-10 00:00:00')")
    hour = (f"(SELECT * FROM {HOLES} h WHERE ts >= TIMESTAMP '2024-01-10 04:00:00' "
            f"AND ts < TIMESTAMP '2024-01-10 05:00:00')")
    texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c, _ in EVENTS_COLS)
    names = ", ".join(c for c, _ in EVENTS_COLS)
    cls = _class("l.val")
    return f"""
WITH sugg AS (SELECT * FROM ({_suggest_sql(trail + " t", "events", _EVENTS_S, with_values=True)}) x),
ranked AS (SELECT *, row_number() OVER (ORDER BY constraint_name ASC NULLS FIRST, column_name ASC NULLS FIRST,
                                                 code_for_constraint ASC NULLS FIRST) AS rn,
                  count(*) OVER () AS total FROM sugg),
active AS (SELECT * FROM ranked WHERE rn <= floor(total * 0.8)),
long AS (SELECT col, val FROM (SELECT {texts} FROM {hour} h) UNPIVOT INCLUDE NULLS (val FOR col IN ({names}))),
res AS (
  SELECT a.constraint_name AS cons, a.raw_threshold AS thr, count(*) AS n,
         CASE a.kind
           WHEN 'is_complete' THEN CAST(count(l.val) AS DOUBLE) / count(*)
           WHEN 'has_completeness' THEN CAST(count(l.val) AS DOUBLE) / count(*)
           WHEN 'is_contained_in' THEN avg(CASE WHEN l.val IS NULL OR list_contains(a.vals, l.val) THEN 1.0 ELSE 0.0 END)
           WHEN 'is_non_negative' THEN avg(CASE WHEN coalesce(TRY_CAST(l.val AS DOUBLE), 0.0) >= 0 THEN 1.0 ELSE 0.0 END)
           WHEN 'has_data_type' THEN CAST(sum(CASE WHEN ({cls}) = a.dt THEN 1 ELSE 0 END) AS DOUBLE) / count(l.val)
         END AS v
  FROM active a JOIN long l ON l.col = a.column_name
  GROUP BY a.constraint_name, a.column_name, a.code_for_constraint, a.kind, a.raw_threshold, a.vals, a.dt)
SELECT 'tablewatch_verification' AS "check", 'Warning' AS check_level,
       CASE WHEN bool_and(coalesce(v >= thr, FALSE)) OVER () THEN 'Success' ELSE 'Warning' END AS check_status,
       cons AS "constraint",
       CASE WHEN coalesce(v >= thr, FALSE) THEN 'Success' ELSE 'Failure' END AS constraint_status,
       CASE WHEN n = 0 THEN 'no rows' WHEN coalesce(v >= thr, FALSE) THEN ''
            ELSE 'Value: ' || coalesce(printf('%.4f', floor((v) * 10000 + 0.5) / 10000), 'NULL') || ' does not meet the constraint requirement!'
       END AS constraint_message,
       round(v, 6) AS value, CASE WHEN coalesce(v >= thr, FALSE) THEN 1 ELSE 0 END AS status_value,
       'events' AS "table", TIMESTAMP '2024-01-10 05:00:00' AS ts
FROM res
"""


ORACLE["job_quality_loop"] = _quality_loop_sql()


def _ingest_sql():
    """Both commits of the ingestion program, from the table itself."""
    cols = LINEITEM_COLS + [("processing_time", "other")]
    src = "(SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS processing_time FROM lineitem) l"
    data = (f"SELECT entity AS type, instance AS \"column\", name AS metric, "
            f"CASE WHEN name = 'Sum' THEN round(value, 2) ELSE round(value, 6) END AS value, CAST(NULL AS VARCHAR) AS value_str "
            f"FROM ({_profile_sql(src, cols)}) p")
    parts = [data]
    parts += [f"SELECT 'Column', '{c}', 'ApproxCountDistinct', CAST(1 AS DOUBLE), NULL" for c, _ in cols]
    per = "(SELECT 'l_returnflag=' || l_returnflag AS part, count(*) AS n FROM lineitem GROUP BY 1) f"
    for m, v in (("numInserts", "n"), ("numWrites", "n"), ("numDeletes", "0")):
        parts.append(f"SELECT 'WriteStat', part, '{m}', CAST({v} AS DOUBLE), CAST({v} AS VARCHAR) FROM {per}")
    parts.append(f"SELECT 'WriteStat', part, 'fileSizeInBytes', CAST(1 AS DOUBLE), NULL FROM {per}")
    for m, v in (("totalInserts", "count(*)"), ("totalUpdates", "0"), ("totalRecordsWritten", "count(*)")):
        parts.append(f"SELECT 'CommitSummary', NULL, '{m}', CAST({v} AS DOUBLE), CAST({v} AS VARCHAR) FROM lineitem"
                     + (" LIMIT 1" if v == "0" else ""))
    parts[-2] = f"SELECT * FROM ({parts[-2]})"
    parts.append("SELECT 'CommitSummary', NULL, 'totalBytesWritten', CAST(1 AS DOUBLE), NULL")
    parts.append("SELECT 'CommitSummary', NULL, 'operationType', CAST(NULL AS DOUBLE), 'insert'")
    parts.append("SELECT 'Commit', NULL, 'source', CAST(NULL AS DOUBLE), 'drop'")
    return (f"SELECT ts, 'lineitem' AS \"table\", m.* FROM ({' UNION ALL '.join(parts)}) m "
            f"CROSS JOIN (VALUES ('2024-02-01 00:00:00'), ('2024-01-02 04:00:00')) t(ts)")


ORACLE["job_ingest"] = _ingest_sql()
ORACLE["lake_rows"] = """
SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN 'c1' ELSE 'c2' END AS commit_id,
       CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS attempt FROM orders
"""

ORACLE["stream_events"] = """
SELECT 'progress' AS event, 'events_probe' AS query_name, event_id % 4 AS batch_id, CAST(count(*) AS DOUBLE) AS rows FROM events GROUP BY 3
UNION ALL SELECT 'started', 'events_probe', NULL, NULL
UNION ALL SELECT 'terminated', 'events_probe', NULL, NULL
"""
ORACLE["stream_hours"] = "SELECT * FROM events"

ORACLE["drift_shifts"] = """
SELECT feature, feature <> 'steady' AS shifted, n FROM (VALUES ('text'), ('list'), ('datetime'), ('steady')) f(feature),
  (SELECT count(*) AS n FROM events WHERE event_type = 'purchase') p
"""
