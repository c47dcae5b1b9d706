"""Registered queries against their DuckDB oracles at sf0.001 (values and declared types)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import canon  # noqa: E402
from tablewatch.sources.tables import TEST_TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
FAST = ["profile_events_hour", "profile_lineitem", "entropy_columns", "compliance_rules", "value_histogram",
        "inferred_types", "suggest_rules", "verify_rules", "verify_unique", "merge_rules", "activate_rules",
        "history_latest", "alert_hold", "metric_rate", "auc_exact", "stratified_split", "flatten_json",
        "write_stats", "job_profiling", "job_quality_loop"]
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TEST_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in sdf.schema.fields:
        assert TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) == duck[f.name], f.name
    assert canon(sdf.columns, sdf.collect()) == canon(rel.columns, rel.fetchall())
