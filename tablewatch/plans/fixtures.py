"""Derived inputs for the registered queries: deterministic NULL holes and text
columns computed from the driver's tables (the tables themselves hold no NULLs).

Each Spark projection has an SQL twin used by the DuckDB oracle; both must stay
textually equivalent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def events_with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` NULL on every 7th event id, ``event_type`` NULL on every 11th."""
    ev = events(spark, sf_dir)
    return ev.select(
        "event_id", "ts", "user_id",
        F.when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"),
        "props")


EVENTS_WITH_HOLES_SQL = """
SELECT event_id, ts, user_id,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
       props
FROM events
"""


def event_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns of known shape: integral, fractional, boolean, mixed, JSON."""
    ev = events(spark, sf_dir)
    return ev.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_text"),
        F.concat(F.col("user_id").cast("string"), F.lit("."), (F.col("event_id") % 100).cast("string"))
        .alias("price_text"),
        F.when(F.col("event_id") % 2 == 0, F.lit("true")).otherwise(F.lit("false")).alias("flag_text"),
        F.when(F.col("event_id") % 13 == 0, F.lit("true")).otherwise(F.col("user_id").cast("string"))
        .alias("mixed_text"),
        F.col("event_type").alias("type_text"),
        F.col("props").alias("props_text"))


EVENT_TEXTS_SQL = """
SELECT event_id,
       CAST(user_id AS VARCHAR) AS user_text,
       CAST(user_id AS VARCHAR) || '.' || CAST(event_id % 100 AS VARCHAR) AS price_text,
       CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS flag_text,
       CASE WHEN event_id % 13 = 0 THEN 'true' ELSE CAST(user_id AS VARCHAR) END AS mixed_text,
       event_type AS type_text,
       props AS props_text
FROM events
"""


# ------------------------------------------------------------------ rules from part

def part_rules(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """Rule rows derived from the whole ``part`` table: ``new`` are fresh suggestions,
    ``old`` the existing rule table (its code differs for p_size > 30, so those parts
    give one new-only and one old-only rule, the rest match), ``ranked`` the whole
    table with frequency = p_size.  column_name is NULL on every 5th part key."""
    p = read_table(spark, sf_dir, "part")
    name = F.concat(F.lit("rule_"), F.col("p_partkey").cast("string"))
    colname = F.when(F.col("p_partkey") % 5 == 0, F.lit(None)).otherwise(F.col("p_type"))
    code = F.concat(F.lit('.isComplete("'), F.col("p_name"), F.lit('")'))
    old_code = F.when(F.col("p_size") > 30, F.concat(F.lit('.isUnique("'), F.col("p_name"), F.lit('")'))) \
        .otherwise(code)
    if kind == "new":
        return p.select(
            name.alias("constraint_name"), colname.alias("column_name"),
            F.concat(F.lit("Size: "), F.col("p_size").cast("string")).alias("current_value"),
            F.col("p_name").alias("description"),
            F.concat(F.lit("R"), (F.col("p_size") % 6).cast("string")).alias("suggesting_rule"),
            F.col("p_brand").alias("rule_description"), code.alias("code_for_constraint"))
    if kind == "old":
        return p.select(
            name.alias("constraint_name"), colname.alias("column_name"), F.lit("old").alias("current_value"),
            F.concat(F.lit("old "), F.col("p_name")).alias("description"), F.lit("old").alias("suggesting_rule"),
            F.lit("old").alias("rule_description"), old_code.alias("code_for_constraint"),
            F.when(F.col("p_size") % 7 == 0, F.lit("high")).otherwise(F.lit("low")).alias("level"),
            (F.col("p_size") % 5 + 1).cast("int").alias("frequency"), (F.col("p_size") % 2).cast("int").alias("active"),
            F.lit("2024-01-01 00:00:00").cast("timestamp").alias("created_at"),
            F.lit("2024-01-15 00:00:00").cast("timestamp").alias("updated_at"),
            F.lit(None).cast("string").alias("kind"), F.lit(None).cast("array<string>").alias("values"),
            F.lit(None).cast("double").alias("threshold"), F.lit(None).cast("string").alias("dtype"))
    return p.select(
        name.alias("constraint_name"), F.col("p_type").alias("column_name"), code.alias("code_for_constraint"),
        F.when(F.col("p_partkey") % 13 == 0, F.lit("high")).when(F.col("p_partkey") % 17 == 0, F.lit(None))
        .otherwise(F.lit("low")).alias("level"),
        F.col("p_size").cast("int").alias("frequency"))


def order_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule per order: kind and column from the order key, threshold, type and values from the customer."""
    o = read_table(spark, sf_dir, "orders")
    def pick(names, by):
        return F.element_at(F.array(*[F.lit(x) for x in names]), (by % len(names) + 1).cast("int"))
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    pool = F.array(*[F.lit(x) for x in ("click", "view", "purchase", "signup", "error")], (customer % 100).cast("string"), (customer * 7 % 100).cast("string"))
    return o.select(
        F.concat(F.lit("rule_"), key.cast("string")).alias("constraint_name"),
        pick(["event_id", "ts", "user_id", "event_type", "value", "props", "gone"], key).alias("column_name"),
        pick(["is_complete", "has_completeness", "is_non_negative", "has_data_type", "is_contained_in", "is_unique"], customer).alias("kind"),
        F.filter(pool, lambda x, i: customer % F.pow(F.lit(2.0), i + 1) >= F.pow(F.lit(2.0), i)).alias("values"),
        (customer % 101 / 100).alias("threshold"),
        pick(["Integral", "Fractional", "Boolean", "String", "Numeric"], key + customer).alias("dtype"))


ORDER_RULES_SQL = """
SELECT 'rule_' || CAST(o_orderkey AS VARCHAR) AS constraint_name,
       (['event_id', 'ts', 'user_id', 'event_type', 'value', 'props', 'gone'])[o_orderkey % 7 + 1] AS column_name,
       (['is_complete', 'has_completeness', 'is_non_negative', 'has_data_type', 'is_contained_in', 'is_unique'])[o_custkey % 6 + 1] AS kind,
       list_filter(['click', 'view', 'purchase', 'signup', 'error', CAST(o_custkey % 100 AS VARCHAR), CAST(o_custkey * 7 % 100 AS VARCHAR)],
                   lambda x, i: o_custkey % (1 << i) >= (1 << (i - 1))) AS vals,
       o_custkey % 101 / 100.0 AS threshold,
       (['Integral', 'Fractional', 'Boolean', 'String', 'Numeric'])[(o_orderkey + o_custkey) % 5 + 1] AS dtype
FROM orders
"""

PART_NEW_SQL = """
SELECT 'rule_' || CAST(p_partkey AS VARCHAR) AS constraint_name,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS column_name,
       'Size: ' || CAST(p_size AS VARCHAR) AS current_value, p_name AS description,
       'R' || CAST(p_size % 6 AS VARCHAR) AS suggesting_rule, p_brand AS rule_description,
       '.isComplete("' || p_name || '")' AS code_for_constraint
FROM part
"""
PART_OLD_SQL = """
SELECT 'rule_' || CAST(p_partkey AS VARCHAR) AS constraint_name,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_type END AS column_name,
       'old' AS current_value, 'old ' || p_name AS description, 'old' AS suggesting_rule, 'old' AS rule_description,
       CASE WHEN p_size > 30 THEN '.isUnique("' || p_name || '")' ELSE '.isComplete("' || p_name || '")' END
         AS code_for_constraint,
       CASE WHEN p_size % 7 = 0 THEN 'high' ELSE 'low' END AS level,
       CAST(p_size % 5 + 1 AS INTEGER) AS frequency, CAST(p_size % 2 AS INTEGER) AS active,
       TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-15 00:00:00' AS updated_at
FROM part
"""
PART_RANKED_SQL = """
SELECT 'rule_' || CAST(p_partkey AS VARCHAR) AS constraint_name, p_type AS column_name,
       '.isComplete("' || p_name || '")' AS code_for_constraint,
       CASE WHEN p_partkey % 13 = 0 THEN 'high' WHEN p_partkey % 17 = 0 THEN NULL ELSE 'low' END AS level,
       CAST(p_size AS INTEGER) AS frequency
FROM part
"""


# ------------------------------------------------------------------ metric history from events

def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as pushed metric rows: job from user_id, table from event_type,
    metric name from event_id, value from value (Completeness scaled into [0, 1]).  A
    third of the table-level rows have a NULL instance, as the drift rows do, and job_2
    pushes nothing from 2024-01-20 on."""
    ev = events(spark, sf_dir)
    ev = ev.where((F.col("user_id") % 3 != 2) | (F.col("ts") < F.lit("2024-01-20 00:00:00").cast(ev.schema["ts"].dataType)))
    k = F.col("event_id") % 5
    other = F.col("user_id") % 7
    name = (F.when(k == 0, "Completeness")
            .when(k == 1, F.when(other == 0, "Minimum").when(other == 1, "Mean").when(other == 2, "Sum").otherwise("Maximum"))
            .when(k == 2, F.when(other == 0, "MinLength").otherwise("MaxLength"))
            .when(k == 3, "ApproxCountDistinct").otherwise("Size"))
    return ev.select(
        F.concat(F.lit("job_"), (F.col("user_id") % 3).cast("string")).alias("job"),
        F.col("event_type").alias("table"),
        F.when(k == 4, F.lit("Dataset")).otherwise(F.lit("Column")).alias("entity"),
        F.when((k == 4) & (F.col("event_id") % 3 == 0), F.lit(None)).when(k == 4, F.lit("*")).otherwise(F.concat(F.lit("col_"), (F.col("user_id") % 10).cast("string")))
        .alias("instance"),
        name.alias("name"), "ts",
        F.when(k == 0, F.col("value") / 500).otherwise(F.col("value")).alias("value"))


METRIC_HISTORY_SQL = """
SELECT 'job_' || CAST(user_id % 3 AS VARCHAR) AS job, event_type AS "table",
       CASE WHEN event_id % 5 = 4 THEN 'Dataset' ELSE 'Column' END AS entity,
       CASE WHEN event_id % 5 = 4 AND event_id % 3 = 0 THEN NULL WHEN event_id % 5 = 4 THEN '*' ELSE 'col_' || CAST(user_id % 10 AS VARCHAR) END AS instance,
       CASE event_id % 5 WHEN 0 THEN 'Completeness'
                         WHEN 1 THEN CASE user_id % 7 WHEN 0 THEN 'Minimum' WHEN 1 THEN 'Mean' WHEN 2 THEN 'Sum' ELSE 'Maximum' END
                         WHEN 2 THEN CASE user_id % 7 WHEN 0 THEN 'MinLength' ELSE 'MaxLength' END
                         WHEN 3 THEN 'ApproxCountDistinct' ELSE 'Size' END AS name,
       ts,
       CASE WHEN event_id % 5 = 0 THEN value / 500 ELSE value END AS value
FROM events
WHERE user_id % 3 <> 2 OR ts < TIMESTAMP '2024-01-20 00:00:00'
"""


def verification_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as verification results over time."""
    ev = events(spark, sf_dir)
    return ev.select(F.concat(F.lit("c_"), (F.col("user_id") % 20).cast("string")).alias("constraint"),
                     F.when(F.col("value") > 100, F.lit("Failure")).otherwise(F.lit("Success"))
                     .alias("constraint_status"), "ts", "value")


VERIFICATION_HISTORY_SQL = """
SELECT 'c_' || CAST(user_id % 20 AS VARCHAR) AS "constraint",
       CASE WHEN value > 100 THEN 'Failure' ELSE 'Success' END AS constraint_status, ts, value
FROM events
"""
