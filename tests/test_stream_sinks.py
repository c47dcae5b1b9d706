import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tablewatch.sinks import hours as HR
from tablewatch.sinks import scratch_path
from tablewatch.streaming import listener as SL

NOON = dt.datetime(2024, 1, 1, 12, 30)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v long")


def files(spark, path, hour):
    return spark.read.parquet(f"{path}/rows/hour={hour}").select("_metadata.file_path").distinct().count()


def test_the_latest_attempt_of_a_batch_is_read(spark):
    path, schema = scratch_path(spark, "hours"), frame(spark, ("a", 1)).schema
    assert HR.read(spark, path, schema).count() == 0
    HR.append_batch(frame(spark, ("a", 1), ("a", 1)), path, 0, NOON, attempt=1)
    HR.append_batch(frame(spark, ("b", 2)), path, 1, NOON, attempt=1)
    HR.append_batch(frame(spark, ("a", 3), (None, None)), path, 0, NOON + dt.timedelta(hours=1), attempt=2)
    assert sorted(HR.read(spark, path, schema).collect(), key=str) == sorted(frame(spark, ("a", 3), (None, None), ("b", 2)).collect(), key=str)
    with pytest.raises(ValueError):
        HR.append_batch(frame(spark, ("a", 1)).withColumn("Hour", F.lit(1)), path, 3)


def test_compaction_bounds_the_files_of_closed_hours(spark):
    path, schema = scratch_path(spark, "hours-compact"), frame(spark, ("a", 1)).schema
    for i in range(6):
        HR.append_batch(frame(spark, (f"b{i}", i), (f"b{i}", i)).coalesce(1), path, i, NOON, attempt=1)
    HR.append_batch(frame(spark, ("new", 0)), path, 0, NOON + dt.timedelta(hours=1), attempt=2)
    before = sorted(map(tuple, HR.read(spark, path, schema).collect()))
    assert files(spark, path, "h2024010112") == 6
    HR.compact(spark, path, schema, NOON + dt.timedelta(hours=1))
    assert files(spark, path, "h2024010112") == 1 and files(spark, path, "h2024010113") == 1
    assert sorted(map(tuple, HR.read(spark, path, schema).collect())) == before
    assert spark.read.parquet(f"{path}/rows/hour=h2024010112").where("batch_id = 0").count() == 0    # overtaken
    HR.compact(spark, path, schema, NOON + dt.timedelta(hours=2), files_per_hour=2)
    assert sorted(map(tuple, HR.read(spark, path, schema).collect())) == before


def test_a_large_hour_is_compacted_in_several_files(spark):
    """A file for every ``file_bytes`` of an hour, the rows as before."""
    path, schema = scratch_path(spark, "hours-large"), frame(spark, ("a", 1)).schema
    for i in range(3):
        HR.append_batch(spark.range(4000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v")), path, i, NOON, attempt=1)
    HR.append_batch(frame(spark, ("new", 0)), path, 0, NOON, attempt=2)
    before = sorted(map(tuple, HR.read(spark, path, schema).collect()))
    assert len(before) == 8001
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")       # else tasks this small are joined again
    try:
        HR.compact(spark, path, schema, NOON + dt.timedelta(hours=1), file_bytes=5_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert files(spark, path, "h2024010112") > 1
    assert sorted(map(tuple, HR.read(spark, path, schema).collect())) == before


def test_a_compaction_that_died_is_finished_or_forgotten(spark):
    path, schema = scratch_path(spark, "hours-died"), frame(spark, ("a", 1)).schema
    HR.append_batch(frame(spark, ("a", 1)), path, 0, NOON, attempt=1)
    staged = frame(spark, ("half", 9)).select("*", F.lit(0).cast("long").alias("batch_id"), F.lit(1).cast("long").alias("attempt"),
                                              F.lit("h2024010112").alias("hour"))
    staged.write.partitionBy("hour").parquet(f"{path}/compacted")          # died before it was ready
    HR.compact(spark, path, schema, NOON)
    assert [tuple(r) for r in HR.read(spark, path, schema).collect()] == [("a", 1)]
    frame(spark, ("a", 1)).select("*", F.lit(0).cast("long").alias("batch_id"), F.lit(1).cast("long").alias("attempt"),
                                  F.lit("h2024010112").alias("hour")).write.mode("overwrite").partitionBy("hour").parquet(f"{path}/compacted")
    HR._ready(spark, path, True)                                           # died between compacted and rows
    HR.compact(spark, path, schema, NOON)
    assert [tuple(r) for r in HR.read(spark, path, schema).collect()] == [("a", 1)]


def test_events_of_a_failing_query_and_other_queries(spark):
    base = scratch_path(spark, "event-sink")
    frame(spark, ("a", 1)).select(F.to_json(F.struct("k", "v")).alias("value")).write.text(f"{base}/in")
    sink = SL.EventSink(spark, f"{base}/events", "failing", bound=2, flush_seconds=0.2, close_after_end=True).open()

    def run(name, body):
        return spark.readStream.format("text").load(f"{base}/in").writeStream.queryName(name) \
            .option("checkpointLocation", f"{base}/ckpt-{name}").foreachBatch(body).trigger(availableNow=True).start()
    run("other", lambda b, i: b.count()).awaitTermination()
    q = run("failing", lambda b, i: b.select(F.raise_error(F.lit("no good"))).collect())
    with pytest.raises(Exception):
        q.awaitTermination()
    sink.wait()
    rows = SL.read_events(spark, f"{base}/events").collect()
    assert {r.query_name for r in rows} == {"failing"} and {r.event for r in rows} == {"started", "terminated"}
    assert "no good" in [r.json for r in rows if r.event == "terminated"][0]


def test_a_full_hand_over_waits_and_keeps_every_event(spark):
    path = scratch_path(spark, "event-bound")
    sink = SL.EventSink(spark, path, bound=3, flush_seconds=0.1)
    sink._thread.start()
    for i in range(10):
        sink._rows.put((SL.PROGRESS, "q", "r", "n", i, str(i), "{}"))
    deadline = time.time() + 60
    while sink._rows.qsize() and time.time() < deadline:
        time.sleep(0.1)
    sink.close()
    assert sorted(r.batch_id for r in SL.read_events(spark, path).collect()) == list(range(10))
