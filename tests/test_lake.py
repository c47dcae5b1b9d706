import pytest
from pyspark.sql import functions as F

from tablewatch.plans import jobs as J
from tablewatch.sinks import lake as LK
from tablewatch.sinks import scratch_path

SF = "/root/testdata/sf0.001"


def rows(spark, lake, df):
    return sorted((r.k, r.v, r.commit_id, r.attempt) for r in LK.read(spark, lake, df.schema).collect())


def test_a_rerun_takes_the_place_of_the_earlier_attempt(spark):
    lake = scratch_path(spark, "lake")
    df = spark.createDataFrame([("01", 1), ("01", 2), (None, 3)], "k string, v long")
    assert LK.read(spark, lake, df.schema).count() == 0 and LK.commits(spark, lake).count() == 0
    LK.commit(df.where("k is not null"), lake, "c1", ("k",), extra={"source": "a"})
    LK.commit(df.where("v = 1"), lake, "c1", ("k",), "upsert", {"source": "b"})
    LK.commit(df.where("v = 2"), lake, "c2", ("k",))
    assert rows(spark, lake, df) == [("01", 1, "c1", 1), ("01", 2, "c2", 0)]     # "01" stays text
    assert {(r.commit_id, r.attempt, r.operation, tuple(r.extra.items())) for r in LK.commits(spark, lake).collect()} == {
        ("c1", 1, "upsert", (("source", "b"),)), ("c2", 0, "insert", ())}
    assert [(r.partition_path, r.num_writes) for r in LK.commit_files(spark, lake, "c1").collect()] == [("k=01", 1)]


def test_an_attempt_that_died_is_not_seen_and_its_folder_is_used_again(spark):
    lake = scratch_path(spark, "lake-dead")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    LK.commit(df.where("v = 1"), lake, "c1")
    df.write.parquet(f"{lake}/data/commit_id=c1/attempt=1")                     # data, but no commit row
    assert rows(spark, lake, df) == [("a", 1, "c1", 0)]
    LK.commit(df.where("v = 2"), lake, "c1")
    assert rows(spark, lake, df) == [("b", 2, "c1", 1)]


def test_null_partitions_empty_commits_and_clashing_names(spark):
    lake = scratch_path(spark, "lake-odd")
    df = spark.createDataFrame([(None, 3), ("x", 3), ("x", 3)], "k string, v long").coalesce(1)
    LK.commit(df, lake, "c1", ("k",))
    got = {r.partition_path: r.num_writes for r in LK.commit_files(spark, lake, "c1").collect()}
    assert got == {"k=__HIVE_DEFAULT_PARTITION__": 1, "k=x": 2}
    LK.commit(df.limit(0), lake, "c1", ("k",))                                  # the rerun had no rows
    assert rows(spark, lake, df) == [] and LK.commit_files(spark, lake, "c1").agg(F.sum("num_writes")).first()[0] is None
    with pytest.raises(ValueError):
        LK.commit(df.withColumn("Attempt", F.lit(1)), lake, "c2")
    with pytest.raises(ValueError):
        LK.commit(df, lake, "2024-01-01")


def test_reading_one_commit_of_many_prunes_the_others(spark):
    lake = scratch_path(spark, "lake-prune")
    df = spark.range(10).select(F.col("id").alias("v"))
    for i in range(3):
        LK.commit(df, lake, f"c{i}")
    plan = LK.read(spark, lake, df.schema).where("commit_id = 'c1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "commit_id" in plan.split("PartitionFilters", 1)[1][:200]


def test_ingest_twice_for_the_same_time(spark):
    base = scratch_path(spark, "ingest-twice")
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    li.write.option("header", True).csv(f"{base}/drop/lineitem_20240101_0000-0100.csv")
    spark.createDataFrame([(li.schema.json(),)], "v string").coalesce(1).write.text(f"{base}/schema")
    for _ in range(2):
        out = J.ingest_job(spark, f"{base}/drop/lineitem_20240101_0000-0100.csv", f"{base}/schema", f"{base}/lake",
                           "2024-02-01 00:00:00", f"{base}/metrics", ("l_returnflag",), "ingest_twice_view", {"source": "drop"})
    assert spark.table("ingest_twice_view").count() == li.count()
    assert spark.read.parquet(f"{base}/metrics").count() == out.count()
    assert out.where("metric = 'source' and type = 'Commit' and value_str = 'drop'").count() == 1
    assert out.where("metric = 'Size'").first().value == li.count()


def test_an_empty_drop_commits_nothing(spark):
    base = scratch_path(spark, "ingest-empty")
    li = spark.read.parquet(f"{SF}/lineitem.parquet").limit(0)
    li.coalesce(1).write.option("header", True).csv(f"{base}/drop/lineitem_20240101_0000-0100.csv")
    spark.createDataFrame([(li.schema.json(),)], "v string").coalesce(1).write.text(f"{base}/schema")
    out = J.ingest_job(spark, f"{base}/drop/lineitem_20240101_0000-0100.csv", f"{base}/schema", f"{base}/lake", "2024-02-01 00:00:00")
    assert out.count() == 0 and LK.commits(spark, f"{base}/lake").count() == 0


def test_ingest_keeps_the_sketches_out_of_the_other_metrics(spark, monkeypatch):
    """the metrics of a commit are the same rows with the sketches in an aggregate of their own."""
    from tablewatch.operators import metrics as M
    seen = []
    scan = M.scan_metrics

    def noted(df, analyzers, separate_sketches=False):
        if not separate_sketches:
            seen.append({isinstance(a, M.ApproxCountDistinct) for a in analyzers})
        return scan(df, analyzers, separate_sketches)

    monkeypatch.setattr(M, "scan_metrics", noted)
    base = scratch_path(spark, "ingest-sketches")
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "k int, s string")
    df.write.option("header", True).csv(f"{base}/in.csv")
    spark.createDataFrame([(df.schema.json(),)], "v string").coalesce(1).write.text(f"{base}/schema")
    got = J.ingest_job(spark, f"{base}/in.csv", f"{base}/schema", f"{base}/lake", "2024-02-01 00:00:00").collect()
    assert seen == [{False}, {True}]
    value = {(r["column"], r["metric"]): r["value"] for r in got if r["type"] in ("Dataset", "Column")}
    assert value["*", "Size"] == 3 and value["k", "ApproxCountDistinct"] == 1 and value["s", "ApproxCountDistinct"] == 2
    assert value["k", "Sum"] == 2 and abs(value["s", "Completeness"] - 2 / 3) < 1e-12
    assert len(value) == len([r for r in got if r["type"] in ("Dataset", "Column")])
