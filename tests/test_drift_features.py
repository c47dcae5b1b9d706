import datetime as dt

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablewatch.operators import drift as DR


def test_the_encoding_leaves_out_a_rows_own_part(spark):
    rows = [(f"v{i % 7}" if i % 11 else None, float(i % 3 == 0), i % 5 == 0, i) for i in range(300)]
    split = spark.createDataFrame(rows, "c string, label double, is_test boolean, i long")
    fold = F.pmod(F.xxhash64("c", "label", "is_test", "i", F.lit(42)), F.lit(DR.FOLDS)).alias("fold")
    before = split.select("*", fold).collect()
    train = [r for r in before if not r.is_test]
    share = sum(r.label for r in train) / len(train)
    want = {}
    for r in before:
        same = [t.label for t in train if t.c == r.c and (r.is_test or t.fold != r.fold)]
        want[r.i] = (sum(same) + DR.PRIOR * share) / (len(same) + DR.PRIOR)
    got = {r.i: r.c for r in DR.encode_text(split, ["c"]).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-12 for i in want)


def test_values_without_training_rows_have_the_common_share(spark):
    split = spark.createDataFrame([(f"only {i}", float(i % 2), i >= 40) for i in range(50)], "c string, label double, is_test boolean")
    # every value occurs once, so no row can be told by its value
    assert {round(r.c, 9) for r in DR.encode_text(split, ["c"]).collect()} == {0.5}


def test_features_of_every_kind(spark):
    df = spark.createDataFrame([(1, "a", [1, 2], {"k": 1}, dt.datetime(1970, 1, 1, 0, 1), dt.date(1970, 1, 2), True, b"x"),
                                (0, None, None, None, None, None, None, None)],
                               "label int, t string, l array<int>, m map<string,int>, ts timestamp, d date, b boolean, raw binary")
    ff = DR.feature_frame(df)
    assert ff.features == ["t", "l", "m", "ts", "d", "b"] and ff.text == ["t"]
    r = ff.frame.where("label = 1").first()
    assert (r.t, r.l, r.m, r.ts, r.d, r.b) == ("a", 2.0, 1.0, 60.0, 86400.0, 1.0)
    assert ff.frame.where("label = 0").first().ts is None
    with pytest.raises(ValueError):
        DR.detect_drift(spark.createDataFrame([(i % 2, b"x") for i in range(20)], "label int, raw binary"), "t")


def test_fitting_stops_at_the_best_round(spark):
    rows = [(float(i % 2), float((i * 37) % 101), i % 5 == 0) for i in range(400)]      # nothing to learn
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame(rows, "label double, x double, is_test boolean")).cache()
    train, valid = df.where("not is_test"), df.where("is_test")
    gbt = GBTClassifier(labelCol="label", featuresCol="features", maxDepth=2, seed=1)
    model = DR.fit_rounds(gbt, train, valid, max_iter=40, rounds=3)
    whole = gbt.copy({gbt.maxIter: model.getNumTrees + 3}).fit(train).evaluateEachIteration(valid)
    assert min(range(len(whole)), key=whole.__getitem__) == model.getNumTrees - 1
    df.unpersist()
