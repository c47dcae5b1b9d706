import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tablewatch.operators.ranking import global_row_number, running_sums
from tablewatch.operators.sampling import stratified_split


def test_running_sums_hot_key_matches_window(spark):
    random.seed(7)
    rows = [(i, "hot" if random.random() < 0.34 else random.choice(["a", "b", None]), random.randint(0, 9),
             random.random()) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, k string, o int, v double")
    got = running_sums(df, [F.col("o").desc(), "id"], {"cv": F.col("v")}, ["k"], num_ranges=6)
    w = Window.partitionBy("k").orderBy(F.col("o").desc(), "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("id", F.sum("v").over(w).alias("rv"))
    assert got.join(ref, "id").where(F.abs(F.col("cv") - F.col("rv")) > 1e-9).count() == 0


def test_global_row_number_dense(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 3)
    rn = global_row_number(df, [F.col("id").desc()], num_ranges=4)
    assert sorted(r.rn for r in rn.collect()) == list(range(1, 501))


def test_stratified_split_exact_counts(spark):
    df = spark.range(2003).withColumn("label", (F.col("id") % 5 == 0).cast("int"))
    s = stratified_split(df, "label", 0.2, 42, ["id"])
    counts = {(r.label, r.is_test): r["count"] for r in s.groupBy("label", "is_test").count().collect()}
    n1 = 401
    assert counts[(1, True)] == int(n1 * 0.2 + 0.5)
    assert counts[(0, True)] == int((2003 - n1) * 0.2 + 0.5)
    s2 = stratified_split(df, "label", 0.2, 42, ["id"]).where("is_test").select("id")
    assert s2.exceptAll(s.where("is_test").select("id")).count() == 0        # repeatable


def test_stratified_split_single_class(spark):
    df = spark.range(10).withColumn("label", F.lit(0))
    s = stratified_split(df, "label", 0.2, 1, ["id"])
    assert s.where("is_test").count() == 2


def test_running_sums_equal_a_window(spark):
    random.seed(3)
    rows = [(i, random.choice(["a", "b", None]), random.randint(0, 5), random.choice([1.0, None, 2.5]))
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k string, o int, v double")
    dist = running_sums(df, [F.col("o").asc(), "id"], {"c": F.col("v")}, ["k"], num_ranges=4)
    w = Window.partitionBy("k").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = df.withColumn("c", F.sum(F.coalesce("v", F.lit(0.0))).over(w))
    j = dist.select("id", F.col("c").alias("a")).join(local.select("id", F.col("c").alias("b")), "id")
    assert j.where(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0


def test_tied_rows_are_spread_over_ranges(spark):
    n = 80_000
    df = spark.range(n).select("id", F.lit("k").alias("k"), F.lit(1).alias("o"))
    out = running_sums(df, [F.col("o").asc()], {"c": F.lit(1)}, ["k"], num_ranges=8)
    assert out.agg(F.count_distinct("c")).first()[0] == n and out.agg(F.max("c")).first()[0] == n
    most = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    assert most < n / 3


def test_hot_key_is_spread_over_ranges(spark):
    n = 120_000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot"))
                               .otherwise((F.col("id") % 100).cast("string")).alias("k"),
                               (F.col("id") * 7919 % 101).alias("o"))
    out = running_sums(df, [F.col("o").asc(), "id"], {"c": F.lit(1)}, ["k"], num_ranges=8)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) <= 2 * n / 8            # the key holding a third of the rows is not one task
    hot = out.where("k = 'hot'").agg(F.max("c").alias("m"), F.count("*").alias("cnt")).collect()[0]
    assert hot.m == hot.cnt == n // 3


def test_running_sums_across_small_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        random.seed(9)
        rows = [(i, random.choice(["a", "a", "a", "b", None]), random.randint(0, 30), random.random())
                for i in range(2000)]
        df = spark.createDataFrame(rows, "id long, k string, o int, v double")
        got = running_sums(df, [F.col("o").asc(), "id"], {"cv": F.col("v")}, ["k"], num_ranges=5)
        w = Window.partitionBy("k").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)
        ref = df.select("id", F.sum("v").over(w).alias("rv"))
        assert got.count() == 2000
        assert got.join(ref, "id").where(F.abs(F.col("cv") - F.col("rv")) > 1e-9).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_running_sums_carries_complex_columns(spark):
    import datetime as dt
    from decimal import Decimal
    rows = [(i, "k" if i % 2 else None, [f"v{i}", "x"], {"a": i}, dt.datetime(2024, 1, 1, 0, i % 60),
             Decimal(f"{i}.25"), i % 7) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k string, arr array<string>, mp map<string,int>, "
                                     "ts timestamp_ntz, d decimal(10,2), o int")
    got = running_sums(df, [F.col("o").desc(), "id"], {"c": F.lit(1)}, ["k"], num_ranges=5)
    assert got.count() == 300
    r = got.where("id = 17").first()
    assert r.arr == ["v17", "x"] and r.mp == {"a": 17} and str(r.d) == "17.25"
    w = Window.partitionBy("k").orderBy(F.col("o").desc(), "id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.select("id", F.count("*").over(w).alias("rc"))
    assert got.join(ref, "id").where(F.col("c") != F.col("rc")).count() == 0


def test_stratified_split_takes_any_number_of_labels(spark):
    df = spark.range(6000).select("id", (F.col("id") % 1500).alias("label"))
    out = stratified_split(df, "label", 0.5, 1, ["id"])
    per = out.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t"))
    assert out.count() == 6000 and per.where("n <> 4 or t <> 2").count() == 0
