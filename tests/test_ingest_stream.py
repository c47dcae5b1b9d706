import json
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.functions.conform import conform_to_schema, parse_bracket_list
from tablewatch.functions.json import flatten_json, parse_json_columns
from tablewatch.functions.text import table_from_path
from tablewatch.operators import metrics as M
from tablewatch.sinks import scratch_path
from tablewatch.sources import commits as CM
from tablewatch.sources import csv as CSV
from tablewatch.streaming import listener as SL
from tablewatch.streaming import monitor as SMON


def test_csv_missing_and_extra_columns(spark):
    base = scratch_path(spark, "t-csv")
    spark.createDataFrame([("1", "abc", "[a, b]", "zz")], "id string, n string, tags string, extra string") \
        .write.option("header", True).csv(f"{base}/in")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.IntegerType()),
                           T.StructField("tags", T.ArrayType(T.StringType())),
                           T.StructField("absent", T.DoubleType())])
    spark.createDataFrame([(schema.json(),)], "v string").coalesce(1).write.text(f"{base}/schema")
    raw = CSV.read_csv_text(spark, f"{base}/in")
    assert not CSV.is_empty(raw)
    out = conform_to_schema(raw, CSV.load_schema(spark, f"{base}/schema")).first()
    assert out.id == 1 and out.n is None and out.tags == ["a", " b"] and out.absent is None and out.extra == "zz"


def test_bracket_list_edge_cases(spark):
    df = spark.createDataFrame([("",), ("[x]",)], "s string")
    assert [r.l for r in df.select(parse_bracket_list(F.col("s")).alias("l")).collect()] == [[""], ["x"]]


def test_malformed_json_gives_null_row(spark):
    df = spark.createDataFrame([(1, '{"k": 3}'), (2, "{oops")], "id int, j string")
    got = {r.id: r.k for r in parse_json_columns(df, "j", "k INT", ["id"]).collect()}
    assert got == {1: 3, 2: None}


def test_flatten_nested(spark):
    doc = json.dumps({"a": {"b": 1, "c": "2.5", "d": "x", "t": True}, "s": [{"n": 4}, 5]})
    df = spark.createDataFrame([(1, doc)], "id int, j string")
    got = {r.name: r.value for r in flatten_json(df, "j", ["id"]).collect()}
    assert got == {"a_b": 1.0, "a_c": 2.5, "s_0__n": 4.0, "s_1_": 5.0}


def test_table_from_path(spark):
    df = spark.createDataFrame([("hdfs://x/in/cdr_20240101_0000-0100.csv",)], "p string")
    assert df.select(table_from_path(F.col("p"))).first()[0] == "cdr"


def test_file_write_stats(spark):
    path = scratch_path(spark, "t-lake")
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    li.write.partitionBy("l_returnflag").parquet(path)
    stats = CM.file_write_stats(spark, path, partition_cols=("l_returnflag",))
    per = {(r.column, r.metric): r.value for r in CM.write_stat_metrics(stats).collect()}
    by_flag = {r.l_returnflag: r["count"] for r in li.groupBy("l_returnflag").count().collect()}
    for flag, n in by_flag.items():
        assert per[(f"l_returnflag={flag}", "numWrites")] == n
    summ = {r.metric: (r.value, r.value_str) for r in CM.commit_summary_metrics(stats).collect()}
    assert summ["totalRecordsWritten"][0] == li.count() and summ["operationType"][1] == "insert"


def test_stream_batches_sum_and_restart_adds_nothing(spark):
    base = scratch_path(spark, "t-stream")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.select(F.to_json(F.struct(*ev.columns)).alias("value")).repartition(3).write.text(f"{base}/in")
    an = lambda b: [M.Size(), M.Sum("value")]

    def run():
        s = SMON.read_json_stream(spark, f"{base}/in", ev.schema, max_files_per_trigger=1)
        q = SMON.start_monitor(s, f"{base}/ckpt", f"{base}/m", available_now=True, analyzers=an)
        q.awaitTermination()
    rec = SL.ProgressRecorder()
    spark.streams.addListener(rec)
    run()
    m1 = spark.read.parquet(f"{base}/m")
    batches = m1.select("batch_id").distinct().count()
    size = m1.where("name = 'Size'").agg(F.sum("value")).first()[0]
    assert batches == 3 and size == ev.count()
    run()                                   # restart on the same checkpoint: no new batch
    assert spark.read.parquet(f"{base}/m").count() == m1.count()
    time.sleep(1)
    spark.streams.removeListener(rec)
    progress, events = rec.drain()
    assert len(progress) >= 3 and any(e[0] == "started" for e in events)
    assert SL.events_frame(spark, events).where("event = 'terminated'").count() >= 1
    flat = SL.progress_metrics(SL.progress_frame(spark, progress))
    assert flat.where("instance = 'numInputRows'").agg(F.sum("value")).first()[0] == ev.count()


def test_stream_data_append_is_replay_safe(spark):
    base = scratch_path(spark, "t-stream-data")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.select(F.to_json(F.struct(*ev.columns)).alias("value")).repartition(2).write.text(f"{base}/in")
    s = SMON.read_json_stream(spark, f"{base}/in", ev.schema, max_files_per_trigger=1)
    run = SMON.batch_metrics_fn(f"{base}/m", lambda b: [M.Size()], data_path=f"{base}/data")
    batch = spark.read.schema(ev.schema).json(f"{base}/in")
    run(batch, 0)
    run(batch, 0)                                   # the same batch replayed
    assert spark.read.parquet(f"{base}/data").count() == ev.count()
    assert spark.read.parquet(f"{base}/m").where("name = 'Size'").count() == 1
    del s


def test_smart_home_batch_metrics(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 1, 0, i), 1, f"d{i}", "lamp" if i % 2 else "", "kitchen",
             "on" if i % 3 else "broken", float(i * 10 - 5), 1, "cook" if i else None, 20.0 + i, 5.0 - i,
             30.0 + 10 * i, 100.0, i + 2, i, 3) for i in range(6)]
    batch = spark.createDataFrame(rows, SMON.SMART_HOME_SCHEMA)
    got = {(r.instance, r.name): r.value for r in M.run_analyzers(batch, SMON.smart_home_analyzers(batch)).collect()}
    assert got[("valid_status", "Compliance")] == 4 / 6
    assert got[("power_watt_positive", "Compliance")] == 5 / 6
    assert got[("humidity_percentage", "Compliance")] == 3 / 6
    assert got[("day_of_week_range", "Compliance")] == 5 / 6
    assert got[("device_type_not_null", "Compliance")] == 3 / 6
    assert got[("activity_valid", "Compliance")] == 5 / 6
    assert abs(got[("indoor_temp,outdoor_temp", "Correlation")] + 1.0) < 1e-12
    assert abs(got[("room", "Entropy")]) < 1e-12 and ("power_watt", "StandardDeviation") in got


def test_write_stats_of_missing_table_are_empty(spark):
    stats = CM.file_write_stats(spark, scratch_path(spark, "never-written"))
    assert stats.count() == 0 and CM.write_stat_metrics(stats).count() == 0


def test_stream_metrics_are_history_rows(spark):
    from tablewatch.operators import history as H
    base = scratch_path(spark, "t-stream-hist")
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.select(F.to_json(F.struct(*ev.columns)).alias("value")).repartition(2).write.text(f"{base}/in")
    s = SMON.read_json_stream(spark, f"{base}/in", ev.schema, max_files_per_trigger=1)
    SMON.start_monitor(s, f"{base}/ckpt", f"{base}/m", available_now=True,
                       analyzers=lambda b: [M.Size(), M.Maximum("value")]).awaitTermination()
    rows = spark.read.parquet(f"{base}/m")
    last = H.latest(rows, ["table", "entity", "instance", "name"]).collect()
    assert {r.name for r in last} == {"Size", "Maximum"} and all(r.ts is not None for r in last)


def test_conform_nested_types_from_json_text(spark):
    df = spark.createDataFrame([('{"a": 1}', '[1, 2]', '{"k": "v"}', "oops")], "s string, arr string, m string, bad string")
    schema = T.StructType([T.StructField("s", T.StructType([T.StructField("a", T.IntegerType())])),
                           T.StructField("arr", T.ArrayType(T.IntegerType())),
                           T.StructField("m", T.MapType(T.StringType(), T.StringType())),
                           T.StructField("bad", T.StructType([T.StructField("a", T.IntegerType())]))])
    r = conform_to_schema(df, schema).first()
    assert r.s.a == 1 and r.arr == [1, 2] and r.m == {"k": "v"} and (r.bad is None or r.bad.a is None)


def test_flatten_json_has_no_depth_limit(spark):
    deep = "1.5"
    for i in range(14):
        deep = '{"k%d": %s}' % (i, deep) if i % 3 else "[%s, 2]" % deep
    df = spark.createDataFrame([(1, deep), (2, '{"a": "}}]]{{{\\" [", "b": {"c": 3}}'), (3, None), (4, "not json {")], "id int, j string")
    got = flatten_json(df, "j", ["id"])
    assert sorted(r.value for r in got.where("id = 1").collect()) == [1.5] + [2.0] * 5
    assert [(r.name, r.value) for r in got.where("id = 2").collect()] == [("b_c", 3.0)]
