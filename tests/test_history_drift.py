from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from tablewatch.operators import drift as DR
from tablewatch.operators import history as H


def _hist(spark):
    t0 = datetime(2024, 1, 1)
    rows = []
    vals = [1, 5, 6, 7, 2, 8, 9, 1]
    for i, v in enumerate(vals):
        rows.append(("j", "t", "Column", "c", "Maximum", t0 + timedelta(hours=i), float(v)))
    rows.append(("j", "t", "Column", "c2", "Completeness", t0, 0.9))
    rows.append(("j", "t", "Column", "c2", "Completeness", t0 + timedelta(hours=1), 0.7))
    return spark.createDataFrame(rows, "job string, table string, entity string, instance string, name string, "
                                       "ts timestamp_ntz, value double")


def test_latest_and_null_percent(spark):
    h = _hist(spark)
    last = {r.instance: r.value for r in H.latest(h).collect()}
    assert last == {"c": 1.0, "c2": 0.7}
    assert abs(H.null_percent(h).first().null_pct - 0.3) < 1e-12


def test_islands_hold_and_rate(spark):
    h = _hist(spark).where(F.col("instance") == "c")
    isl = sorted((r.n, r.start.hour) for r in H.breach_islands(h, F.col("value") > 4).collect())
    assert isl == [(2, 5), (3, 1)]
    held = H.alert_hold(h, F.col("value") > 4, 2 * 3600).collect()
    assert len(held) == 1 and held[0].n == 3
    rates = sorted((r.ts.hour, r.rate) for r in H.rate(h).collect())
    assert rates[0] == (1, 4 / 3600)


def test_exposition_escapes_labels(spark):
    df = spark.createDataFrame([('a"b\\c', 0.5)], "table string, value double")
    line = H.exposition(df, F.lit("dq-job"), ["table"]).first().line
    assert line == 'dq_job{table="a\\"b\\\\c"} 0.500000'


def test_auc_exact_matches_pairwise(spark):
    rng = np.random.default_rng(3)
    s = rng.integers(0, 20, 300).astype(float)
    y = (rng.random(300) < 0.3).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "score double, label int")
    got = DR.auc_exact(df).first().value
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 0)], "score double, label int")
    assert DR.auc_exact(df).first().value is None


def test_drift_detects_shifted_column(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(1200):
        label = 1 if i % 4 == 0 else 0
        rows.append((label, float(rng.normal()), float(rng.normal() + (4.0 if label else 0.0)),
                     "x" if rng.random() < .5 else "y"))
    df = spark.createDataFrame(rows, "label int, steady double, shifted double, cat string")
    res = DR.detect_drift(df, "t", max_iter=8, max_depth=3)
    m = {(r.type, r.instance): r.value for r in res.metrics.collect()}
    assert m[("ML_Metric", None)] > 0.95
    attr = {k[1]: v for k, v in m.items() if k[0] == DR.ATTRIBUTION}
    assert max(attr, key=attr.get) == "shifted"


def _random_tree(rng, depth, nfeat):
    feat, thr, cats, left, right, value, cover = [], [], [], [], [], [], []

    def build(d, cnt):
        i = len(feat)
        feat.append(-1); thr.append(0.0); cats.append(None); left.append(-1); right.append(-1)
        value.append(float(rng.normal())); cover.append(float(cnt))
        if d < depth and cnt >= 2:
            f = int(rng.integers(0, nfeat))
            feat[i] = f
            if f == nfeat - 1:
                cats[i] = {0.0, 2.0}
            else:
                thr[i] = float(rng.normal())
            c = int(rng.integers(1, cnt))
            left[i] = build(d + 1, c)
            right[i] = build(d + 1, cnt - c)
        return i
    build(0, 100)
    return {"feature": np.array(feat), "threshold": np.array(thr), "cats": cats, "left": np.array(left),
            "right": np.array(right), "value": np.array(value), "cover": np.array(cover)}


def test_tree_shap_matches_brute_force():
    import itertools
    import math
    rng = np.random.default_rng(11)
    nfeat = 4
    tree = _random_tree(rng, 4, nfeat)

    def cond_exp(x, S, node=0):
        f = tree["feature"][node]
        if f < 0:
            return tree["value"][node]
        l, r = tree["left"][node], tree["right"][node]
        if f in S:
            go = (x[f] in tree["cats"][node]) if tree["cats"][node] is not None else x[f] <= tree["threshold"][node]
            return cond_exp(x, S, l if go else r)
        return (tree["cover"][l] * cond_exp(x, S, l) + tree["cover"][r] * cond_exp(x, S, r)) / tree["cover"][node]

    X = np.column_stack([rng.normal(size=(6, nfeat - 1)), rng.integers(0, 3, 6).astype(float)])
    phi = np.zeros((6, nfeat))
    DR.tree_shap(tree, X, phi)
    for row, x in enumerate(X):
        for i in range(nfeat):
            others = [j for j in range(nfeat) if j != i]
            want = 0.0
            for r in range(nfeat):
                for S in itertools.combinations(others, r):
                    wgt = math.factorial(len(S)) * math.factorial(nfeat - len(S) - 1) / math.factorial(nfeat)
                    want += wgt * (cond_exp(x, set(S) | {i}) - cond_exp(x, set(S)))
            assert abs(phi[row, i] - want) < 1e-9


def test_shap_additivity_on_spark_gbt(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    rng = np.random.default_rng(5)
    rows = [(float(a), float(b), int(a + b > 0.3)) for a, b in rng.normal(size=(400, 2))]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        spark.createDataFrame(rows, "a double, b double, label int"))
    model = GBTClassifier(maxIter=4, maxDepth=3, seed=1).fit(df)
    trees, weights = DR.model_trees(model, spark)
    pdf = model.transform(df).select("a", "b", vector_to_array("rawPrediction")[1].alias("m")).toPandas()
    X = pdf[["a", "b"]].to_numpy()
    phi = np.zeros((len(X), 2))
    base = 0.0
    for t, w in zip(trees, weights):
        DR.tree_shap(t, X, phi, w)
        base += w * DR.expected_value(t)
    assert np.allclose(phi.sum(axis=1) + base, pdf["m"].to_numpy(), atol=1e-9)


def test_drift_single_class_is_insufficient(spark):
    df = spark.createDataFrame([(0, float(i)) for i in range(50)], "label int, x double")
    rows = DR.detect_drift(df, "t", max_iter=2, max_depth=2).metrics.collect()
    assert len(rows) == 1 and rows[0].verdict == DR.INSUFFICIENT and rows[0].value is None


def test_history_functions_accept_unified_layout(spark):
    from tablewatch.plans import jobs as J
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = J.profiling_job(ev, "events", "ts", "2024-01-02 04:00:00").unionByName(
        J.profiling_job(ev, "events", "ts", "2024-01-02 05:00:00"))
    last = {(r.instance, r.name): r.ts.hour for r in H.latest(rows).collect()}
    assert last[("*", "Size")] == 5
    assert H.null_percent(rows).count() == len(ev.columns)


def test_exposition_written_as_text(spark):
    from tablewatch.sinks import scratch_path, write_exposition
    df = spark.createDataFrame([("t1", 0.25), ("t2", 1.0)], "table string, value double")
    path = scratch_path(spark, "expo")
    write_exposition(H.exposition(df, F.lit("dq"), ["table"]), path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ['dq{table="t1"} 0.250000',
                                                                      'dq{table="t2"} 1.000000']


def test_freshness_on_unified_rows(spark):
    from tablewatch.plans import jobs as J
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = J.profiling_job(ev, "events", "ts", "2024-01-02 04:00:00")
    pushes = H.push_times(rows)
    assert pushes.columns == ["table", "ts"]
    assert H.fresh(rows, pushes, "2024-01-02 05:00:00", 2).count() == rows.count()
    assert H.fresh(rows, pushes, "2024-01-03 05:00:00", 2).count() == 0


def test_alerts_and_rate_on_unified_rows(spark):
    from tablewatch.plans import jobs as J
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows = J.profiling_job(ev, "events", "ts", "2024-01-02 04:00:00").unionByName(
        J.profiling_job(ev, "events", "ts", "2024-01-02 06:00:00"))
    assert H.alert_hold(rows, F.col("value") >= 0, 3600).where("name = 'Size'").count() == 1
    assert H.rate(rows).where("name = 'Size'").count() == 1
    assert H.absent(rows, rows.where("metric != 'Size'")).count() == 1


def test_series_with_null_labels(spark):
    import datetime as dt
    from tablewatch.operators import history as HI
    from tablewatch.operators import sampling as SA
    t = [dt.datetime(2024, 1, 1, h) for h in range(3)]
    rows = [("j", "t", "model", None, "roc_auc", t[0], 1.0), ("j", "t", "model", None, "roc_auc", t[1], 3.0)]
    h = spark.createDataFrame(rows, "job string, table string, entity string, instance string, name string, ts timestamp, value double")
    assert HI.absent(h, h).count() == 0
    assert [r.rate for r in HI.rate(h).collect()] == [2.0 / 3600]
    assert HI.share_of_total(h, "value", ["instance"]).count() == 2
    assert "NaN" in HI.exposition(h.withColumn("value", h.value * None), h.name, ["instance"]).first().line
    split = SA.stratified_split(spark.range(100).selectExpr("id", "if(id < 20, null, 1) as label"))
    assert split.count() == 100 and split.where("is_test").count() == 20
