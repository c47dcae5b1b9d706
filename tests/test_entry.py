import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["entity", "instance", "name", "value", "type"]
    assert df.count() >= 0


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def test_some_queries_run_at_smoke_scale(spark):
    q = E.queries()
    for name in ["profile_lineitem", "suggest_rules", "verify_rules", "activate_rules", "history_latest",
                 "auc_exact", "write_stats"]:
        assert q[name](spark, "/root/testdata/sf0.001").count() >= 0


def test_runs_outside_the_repo_in_a_default_session(tmp_path):
    """Python tasks must not need the package importable on the workers."""
    import subprocess
    import sys
    import os
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as E\n"
        "print('ROWS', E.queries()['auc_exact'](spark, '/root/testdata/sf0.001').count())\n" % repo)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), env=env, capture_output=True,
                         text=True, timeout=300)
    assert "ROWS 1" in out.stdout, out.stderr[-2000:]
