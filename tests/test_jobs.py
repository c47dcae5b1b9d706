import uuid

from pyspark.sql import functions as F

from tablewatch.plans import jobs as J
from tablewatch.sinks import scratch_path

SF = "/root/testdata/sf0.001"


def test_suggest_activate_verify_loop(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    db = f"twt_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'db')}'")
    run1 = J.suggestion_job(spark, ev, "events", "ts", "2024-01-10 05:00:00", 2, database=db)
    n = run1.suggestions.count()
    act = run1.activated.collect()
    assert n > 0 and len(act) == n
    assert sum(r.active for r in act) == int(n * 0.8)
    run2 = J.suggestion_job(spark, ev, "events", "ts", "2024-01-11 05:00:00", 2, database=db)
    freq = [r.frequency for r in run2.activated.collect()]
    assert max(freq) == 2
    res = J.verification_job(spark, ev, "events", "ts", "2024-01-11 05:00:00", database=db).collect()
    assert len(res) == sum(r.active for r in run2.activated.collect())
    assert {r.constraint_status for r in res} <= {"Success", "Failure"}


def test_profiling_job_appends_history(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    path = scratch_path(spark, "hist")
    J.profiling_job(ev, "events", "ts", "2024-01-02 04:00:00", path)
    J.profiling_job(ev, "events", "ts", "2024-01-02 05:00:00", path)
    h = spark.read.parquet(path)
    assert h.select("slice_start").distinct().count() == 2
    assert h.where("metric = 'Size'").count() == 2


def test_drift_job_rows(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    rows = J.drift_job(ev, "events", "ts", "2024-01-30 05:00:00", read_days=29, exclude=("event_id",),
                       max_iter=3, max_depth=3).collect()
    assert rows[0].type == "ML_Metric" or any(r.type == "ML_Metric" for r in rows)


def test_ingest_job(spark):
    base = scratch_path(spark, "ingest")
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    li.write.option("header", True).csv(f"{base}/drop/lineitem_20240101_0000-0100.csv")
    spark.createDataFrame([(li.schema.json(),)], "v string").coalesce(1).write.text(f"{base}/schema")
    out = J.ingest_job(spark, f"{base}/drop/lineitem_20240101_0000-0100.csv", f"{base}/schema", f"{base}/lake", "2024-02-01 00:00:00",
                       metrics_path=f"{base}/metrics", partition_by=("l_returnflag",))
    got = {(r.type, r.metric, r.column): r.value for r in out.collect()}
    assert got[("Dataset", "Size", "*")] == li.count()
    assert got[("CommitSummary", "totalRecordsWritten", None)] == li.count()
    assert out.first().table == "lineitem"
    daily = J.daily_profile_job(li, "l_shipdate", "1995-03-15", "2024-02-01 00:00:00", f"{base}/docs")
    assert daily.where(F.col("metric") == "Size").count() == 1
    assert spark.read.text(f"{base}/docs/suggestions_1995-03-15").count() > 0


def test_history_rows_unified_layout(spark):
    from tablewatch.operators import metrics as M
    ev = spark.read.parquet(f"{SF}/events.parquet")
    rows = J.profiling_job(ev, "events", "ts", "2024-01-02 04:00:00")
    assert rows.columns == M.HISTORY_FIELDS
    got = {(r.instance, r.metric): r.data_type for r in rows.collect()}
    assert got[("value", "Mean")] == "double" and got[("*", "Size")] is None


def test_cli_profile_suggest_verify(spark):
    from tablewatch.plans import cli
    out = scratch_path(spark, "cli")
    db = f"twc_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'cli-db')}'")
    src = ["--path", f"{SF}/events.parquet", "--name", "events", "--ts-col", "ts"]
    cli.main(["profile", *src, "--at", "2024-01-02 04:00:00", "--out", f"{out}/metrics"], spark)
    assert spark.read.parquet(f"{out}/metrics").where("metric = 'Size'").count() == 1
    act = cli.main(["suggest", *src, "--at", "2024-01-10 05:00:00", "--database", db], spark)
    assert act.count() > 0
    cli.main(["verify", *src, "--at", "2024-01-10 05:00:00", "--database", db, "--out", f"{out}/checks"], spark)
    assert spark.read.parquet(f"{out}/checks").count() == act.where("active = 1").count()


def test_cli_stream_available_now(spark):
    from pyspark.sql import functions as F
    from tablewatch.plans import cli
    base = scratch_path(spark, "cli-stream")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.select(F.to_json(F.struct(*ev.columns)).alias("value")).repartition(2).write.text(f"{base}/in")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ev.schema.fields)
    out = cli.main(["stream", "--json-dir", f"{base}/in", "--schema-ddl", ddl, "--checkpoint", f"{base}/ckpt",
                    "--out", f"{base}/m", "--data-out", f"{base}/data", "--progress-out", f"{base}/progress",
                    "--available-now"], spark)
    assert out.where("name = 'Size'").agg(F.sum("value")).collect()[0][0] == ev.count()
    assert out.where("name = 'Entropy'").count() > 0
    assert spark.read.parquet(f"{base}/data").count() == ev.count()
    assert spark.read.parquet(f"{base}/progress").where("instance = 'numInputRows'").count() >= 1


def test_cli_ingest_daily_profile_drift(spark):
    from tablewatch.plans import cli
    base = scratch_path(spark, "cli-more")
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    li.write.option("header", True).csv(f"{base}/drop/lineitem_20240101_0000-0100.csv")
    spark.createDataFrame([(li.schema.json(),)], "v string").coalesce(1).write.text(f"{base}/schema")
    ing = cli.main(["ingest", "--csv", f"{base}/drop/lineitem_20240101_0000-0100.csv", "--schema", f"{base}/schema",
                    "--lake", f"{base}/lake", "--ts", "2024-02-01 00:00:00", "--out", f"{base}/metrics"], spark)
    assert ing.where("metric = 'Size'").first().value == li.count()
    rows = cli.main(["daily-profile", "--path", f"{SF}/lineitem.parquet", "--ts-col", "l_shipdate",
                     "--day", "1995-03-15", "--profiling-ts", "2024-02-01 00:00:00",
                     "--profile-path", f"{base}/profiles"], spark)
    assert spark.read.parquet(f"{base}/profiles").count() == rows.count() > 0
    drift = cli.main(["drift", "--path", f"{SF}/events.parquet", "--name", "events", "--ts-col", "ts",
                      "--at", "2024-01-30 05:00:00", "--read-days", "29", "--n-estimators", "3", "--max-depth", "3",
                      "--exclude-cols", "event_id", "--out", f"{base}/drift"], spark)
    assert spark.read.parquet(f"{base}/drift").where("type = 'ML_Metric'").count() == 1
    assert drift.count() >= 1


def test_jobs_on_an_empty_hour(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    rows = J.profiling_job(ev, "events", "ts", "2030-01-01 04:00:00").collect()
    assert [(r.metric, r.value) for r in rows] == [("Size", 0.0)]
    from tablewatch.operators import verify as V
    res = V.verify(ev.where("ts > '2030-01-01'"), [V.Rule("c", "value", "is_complete")]).collect()
    assert res[0].constraint_message == "no rows" and res[0].check_status == "Warning"


def test_gauges_are_replaced_by_group(spark, tmp_path):
    from tablewatch.sinks import push_gauges, read_gauges
    from tablewatch.operators import history as H
    path = str(tmp_path / "gauges")
    def push(job, table, values):
        df = spark.createDataFrame([(table, n, v) for n, v in values], "table string, name string, value double")
        push_gauges(H.exposition(df, F.lit(job), ("table", "name"), value_format=None), path, job, table)
    push("a", "t one/x", [("m", 1.0), ("gone", 2.0)])
    push("b", "t one/x", [("m", 1e-7)])
    push("a", "t one/x", [("m", 0.1 + 0.2), ("none", None)])
    lines = sorted(r["line"] for r in read_gauges(spark, path).collect())
    assert lines == ['a{table="t one/x",name="m"} 0.30000000000000004', 'a{table="t one/x",name="none"} NaN', 'b{table="t one/x",name="m"} 1.0E-7']


def test_verification_and_drift_push_their_labels(spark, tmp_path):
    from tablewatch.plans import jobs as J
    from tablewatch.sinks import read_gauges
    path = str(tmp_path / "gauges")
    res = spark.createDataFrame([("t", "Warning", "c1", "", 1), ("t", "Warning", "c2", 'Value: "0.5"', 0)],
                                "table string, check_level string, constraint_name string, constraint_message string, status_value int")
    J.push(res, J.VERIFY_LABELS, "constraints_verification", "t", path, "status_value")
    J.push(spark.createDataFrame([("t", "AUC", "*", "auc", 0.75)], "table string, metric_type string, instance string, metric string, value double"),
           J.DRIFT_LABELS, "anomaly_detection", "t", path)
    lines = {r["line"] for r in read_gauges(spark, path).collect()}
    assert 'constraints_verification{table="t",check_level="Warning",constraint_name="c2",constraint_message="Value: \\"0.5\\""} 0.0' in lines
    assert 'anomaly_detection{table="t",metric_type="AUC",instance="*",metric="auc"} 0.75' in lines and len(lines) == 3
