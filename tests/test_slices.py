from datetime import datetime


from pyspark.sql import functions as F

from tablewatch.operators import slices as S


def _df(spark, times):
    return spark.createDataFrame([(i, datetime.fromisoformat(t)) for i, t in enumerate(times)],
                                 "id int, ts timestamp_ntz")


def test_previous_hour_crosses_midnight(spark):
    df = _df(spark, ["2024-01-01 22:59:59", "2024-01-01 23:00:00", "2024-01-01 23:59:59", "2024-01-02 00:00:00"])
    got = sorted(r.id for r in S.slice_previous_hour(df, "ts", "2024-01-02 00:30:00").collect())
    assert got == [1, 2]


def test_previous_hour_pushed_to_scan(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = S.slice_previous_hour(ev, "ts", "2024-01-02 04:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_trailing_days_exclude_today(spark):
    df = _df(spark, ["2024-01-07 23:59:59", "2024-01-08 00:00:00", "2024-01-09 12:00:00", "2024-01-10 00:00:00"])
    got = sorted(r.id for r in S.slice_trailing_days(df, "ts", "2024-01-10 05:00:00", 2).collect())
    assert got == [1, 2]


def test_same_hour_labelled_includes_today(spark):
    df = _df(spark, ["2024-01-07 04:10:00", "2024-01-09 04:59:00", "2024-01-10 04:00:00", "2024-01-10 05:00:00",
                     "2024-01-06 04:00:00"])
    got = {r.id: r.label for r in S.slice_same_hour_labelled(df, "ts", "2024-01-10 05:20:00", 3).collect()}
    assert got == {0: 0, 1: 0, 2: 1}


def test_timestamp_with_zone_column(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 2, 3, 30))], "id int, ts timestamp")
    assert S.slice_day(df, "ts", "2024-01-02").count() == 1


def test_text_and_day_columns_are_read_as_times(spark):
    rows = [("2024-01-02 03:30:00", "2024-01-02"), ("2024-01-02T03:59:59", "2024-01-02"), ("2024-01-02 4:00:00", "2024-01-01"), ("no time", None), (None, "2024-01-03")]
    df = spark.createDataFrame(rows, "t string, d string").withColumn("d", F.col("d").cast("date"))
    assert S.slice_previous_hour(df, "t", "2024-01-02 04:10:00").count() == 2
    assert S.slice_previous_hour(df, "d", "2024-01-02 01:00:00").count() == 2 and S.slice_previous_hour(df, "d", "2024-01-02 04:00:00").count() == 0
    assert S.slice_day(df, "d", "2024-01-02").count() == 2 and S.slice_day(df, "t", "2024-01-02").count() == 3
