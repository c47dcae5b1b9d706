"""Drift detection (M1-M6, A24, A25): "does this slice look different from the
same slice on earlier days?"

Everything stays distributed: features are assembled with MLlib
transformers, the classifier is MLlib's gradient-boosted trees, the AUC is
computed exactly with the skew-safe running sum, and per-feature attribution
walks the (broadcast) trees over Arrow batches in ``mapInPandas``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import local_frame
from ..sinks import scratch_path
from .history import drift_verdict
from .metrics import is_numeric, is_string
from .ranking import running_sums
from .sampling import stratified_split

# Metric row types / names, default exclusions.
ML_METRIC, ATTRIBUTION = "ML_Metric", "SHAP"
INSUFFICIENT = "insufficient_data"
DEFAULT_EXCLUDE = ("label", "date_hour")
FOLDS = 5                        # parts of the training rows for the encoding of text
PRIOR = 10.0                     # rows that the common share weighs in the encoding


def auc_exact(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Rank-sum ROC AUC with ties averaged, exact, one row ``(metric, value)``.

    Rows are first aggregated per distinct score (partial aggregation), then a
    skew-safe running sum of negatives over ascending scores gives each score
    the negatives strictly below it.  NULL when one class is missing."""
    per = scored.groupBy(F.col(score).alias("_s")).agg(
        F.sum(F.col(label).cast("double")).alias("_pos"),
        F.sum((F.lit(1) - F.col(label)).cast("double")).alias("_neg"))
    cum = running_sums(per, [F.col("_s").asc()], {"_cneg": F.col("_neg")})
    wins = F.col("_pos") * (F.col("_cneg") - F.col("_neg") + F.lit(0.5) * F.col("_neg"))
    return cum.agg(F.try_divide(F.sum(wins), F.sum("_pos") * F.sum("_neg")).alias("value")) \
        .select(F.lit("roc_auc").alias("metric"), "value")


@dataclass
class FeatureFrame:
    frame: DataFrame
    features: list[str]          # names in vector order
    text: list[str]              # those that are text still


def feature_frame(df: DataFrame, label: str = "label", exclude: Sequence[str] = DEFAULT_EXCLUDE,
                  keep: Sequence[str] = ()) -> FeatureFrame:
    """M1 (P21-P23): numeric columns as doubles, arrays and maps as their size, datetimes as their
    second (the zone dropped; their formatted text has the same order), text as it is, to be
    encoded by :func:`encode_text`; other types dropped.  ``keep`` names columns that go along as they
    are and are no features."""
    excluded = {*exclude, label, *keep}
    cols, text = [], []
    for f in df.schema.fields:
        if f.name in excluded:
            continue
        c = F.col(f"`{f.name}`")
        if is_numeric(f.dataType) or isinstance(f.dataType, T.BooleanType):
            cols.append(c.cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            cols.append(F.size(c).cast("double").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            wall = F.to_timestamp_ntz(F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
            cols.append(F.timestamp_diff("SECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), wall)
                        .cast("double").alias(f.name))
        elif is_string(f.dataType):
            cols.append(c.cast("string").alias(f.name))
            text.append(f.name)
    out = df.select(*cols, F.col(label).cast("double").alias("label"), *keep)
    return FeatureFrame(out, [c for c in out.columns if c not in ("label", *keep)], text)


def encode_text(split: DataFrame, columns: Sequence[str], is_test: str = "is_test", seed: int = 42,
                key_cols: Sequence[str] | None = None) -> DataFrame:
    """Text columns as the smoothed share of label 1 among the training rows of the same value (NULL is a value).

    A training row is encoded from the other ``FOLDS - 1`` parts of the training rows, so its own label is
    not in its features; a test row from all of them; a value that they lack has the common share.  Any
    number of values will do: per column one grouping to a row per value, joined by that unique value.
    Parts are drawn by a hash of ``key_cols`` (default: all columns), so rows of equal keys are in one.
    """
    rows = split.withColumn("_fold", F.when(~F.col(is_test), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in key_cols or split.columns], F.lit(seed)),
                                                                  F.lit(FOLDS)).cast("int")))
    share = rows.where(~F.col(is_test)).agg(F.coalesce(F.avg("label"), F.lit(0.5))).first()[0]
    for c in columns:
        train = rows.where(~F.col(is_test)).groupBy(F.col(f"`{c}`").alias("_v"))
        parts = train.agg(F.array(*[F.struct(F.count_if(F.col("_fold") == k).alias("n"),
                                             F.sum(F.when(F.col("_fold") == k, F.col("label")).otherwise(0.0)).alias("ones"))
                                    for k in range(FOLDS)]).alias("_parts"))
        def total(field):
            whole = F.aggregate("_parts", F.lit(0.0), lambda a, x: a + x[field])
            own = F.coalesce(F.get(F.col("_parts"), F.col("_fold"))[field].cast("double"), F.lit(0.0))
            return F.coalesce(whole - own, F.lit(0.0))
        code = (total("ones") + F.lit(PRIOR * share)) / (total("n") + F.lit(PRIOR))
        rows = rows.join(parts, F.col(f"`{c}`").eqNullSafe(F.col("_v")), "left").withColumn(c, code).drop("_v", "_parts")
    return rows.drop("_fold")


def fit_rounds(gbt: GBTClassifier, train: DataFrame, valid: DataFrame, max_iter: int, rounds: int):
    """M2: the model up to the iteration with the smallest validation loss, stopping once ``rounds`` further
    iterations brought nothing better.

    Boosting is tried to 2 x ``rounds`` iterations, then to twice as many and so on up to ``max_iter``;
    the model of the best iteration is fitted again, with the same seed and so the same trees.
    """
    tried = min(max_iter, 2 * rounds)
    while True:
        model = gbt.copy({gbt.maxIter: tried}).fit(train)
        loss = model.evaluateEachIteration(valid)
        best = min(range(len(loss)), key=lambda i: (loss[i], i))
        if tried >= max_iter or best + rounds < tried:
            break
        tried = min(max_iter, 2 * tried)
    return model if best + 1 == tried else gbt.copy({gbt.maxIter: best + 1}).fit(train)


@dataclass
class DriftResult:
    metrics: DataFrame     # table, type, instance, metric, value, verdict
    scored: DataFrame      # test rows with score
    model: object
    features: list[str]


def detect_drift(labelled: DataFrame, table: str, label: str = "label", exclude: Sequence[str] = DEFAULT_EXCLUDE,
                 test_fraction: float = 0.2, seed: int = 42, max_iter: int = 500, max_depth: int = 10,
                 early_stopping_rounds: int = 20, attribution_sample: float | None = None) -> DriftResult:
    """M2-M6: fit GBT on the train split (the loss on test rows drives early stopping), score the
    test split, exact AUC, per-feature attribution rows.

    Split and encoding go by a hash of the whole row, columns that are no features included: rows equal
    in every column (maps apart) are on one side of the split."""
    spark = labelled.sparkSession
    # one tiny aggregate (at most two rows): a slice without both classes cannot be split
    # or fitted, so it yields an AUC row with status insufficient_data instead
    classes = {int(r[0]): int(r[1]) for r in labelled.groupBy(F.col(label).cast("int")).count().collect()
               if r[0] is not None}
    if classes.get(0, 0) < 2 or classes.get(1, 0) < 2:
        rows = local_frame(spark, [(table, ML_METRIC, None, "roc_auc", None, INSUFFICIENT)],
                           "table string, type string, instance string, metric string, value double, "
                           "verdict string")
        return DriftResult(rows, spark.createDataFrame([], "score double, label double"), None, [])
    whole = [F.col(f"`{f.name}`") for f in labelled.schema.fields if "map<" not in f.dataType.simpleString()]
    ff = feature_frame(labelled.withColumn("_key", F.xxhash64(*whole, F.lit(seed))), label, exclude, keep=("_key",))
    if not ff.features:
        raise ValueError("no column is left to compare")
    # written once: the fits, the scores and the attribution read it instead of slicing again
    path = scratch_path(spark, "drift-rows")
    parts = stratified_split(ff.frame, "label", test_fraction, seed, place=F.col("_key"))
    encode_text(parts, ff.text, seed=seed, key_cols=["_key"]).write.parquet(path)
    split = VectorAssembler(inputCols=ff.features, outputCol="features", handleInvalid="keep").transform(spark.read.parquet(path))
    gbt = GBTClassifier(labelCol="label", featuresCol="features", maxDepth=max_depth, seed=seed, maxBins=66)
    test = split.where(F.col("is_test"))
    gbt_model = fit_rounds(gbt, split.where(~F.col("is_test")), test, max_iter, early_stopping_rounds)
    scored = gbt_model.transform(test).select(
        *[F.col(f"`{c}`") for c in ff.features], "label", vector_to_array("probability")[1].alias("score"))
    auc = auc_exact(scored, "score", "label")
    auc_rows = auc.select(F.lit(table).alias("table"), F.lit(ML_METRIC).alias("type"),
                          F.lit(None).cast("string").alias("instance"), "metric", "value",
                          drift_verdict(F.col("value")).alias("verdict"))
    attr = attribution(gbt_model, scored if attribution_sample is None
                       else scored.sample(attribution_sample, seed), ff.features)
    attr_rows = attr.select(F.lit(table).alias("table"), F.lit(ATTRIBUTION).alias("type"),
                            F.col("feature").alias("instance"), F.lit("shap_mean_abs").alias("metric"),
                            F.col("mean_abs").alias("value"), F.lit(None).cast("string").alias("verdict"))
    return DriftResult(auc_rows.unionByName(attr_rows), scored, gbt_model, ff.features)


# ----------------------------------------------------------------- attribution

def model_trees(gbt_model, spark) -> tuple[list[dict], list[float]]:
    """The trees of a fitted GBT as arrays (feature, threshold, left-category set, left,
    right, value, cover), read from the model's saved node table in the shared
    scratch folder.  Size is bounded by maxIter x 2^(maxDepth+1) nodes."""
    path = scratch_path(spark, "gbt-model")
    gbt_model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount", "nodeData.leftChild",
        "nodeData.rightChild", "nodeData.split.featureIndex", "nodeData.split.leftCategoriesOrThreshold",
        "nodeData.split.numCategories").toPandas()
    weights = [float(w) for w in gbt_model.treeWeights]
    trees = []
    for tid in range(len(weights)):
        t = nodes[nodes["treeID"] == tid].sort_values("id")
        size = int(t["id"].max()) + 1
        feat = np.full(size, -1, dtype=np.int64)
        thr = np.zeros(size)
        left = np.full(size, -1, dtype=np.int64)
        right = np.full(size, -1, dtype=np.int64)
        value = np.zeros(size)
        cover = np.zeros(size)
        cats = [None] * size
        for r in t.itertuples(index=False):   # model nodes, not data rows
            i = int(r.id)
            value[i] = r.prediction
            cover[i] = r.rawCount
            if r.leftChild >= 0:
                feat[i] = r.featureIndex
                left[i], right[i] = r.leftChild, r.rightChild
                vals = list(r.leftCategoriesOrThreshold)
                if r.numCategories >= 0:
                    cats[i] = set(float(v) for v in vals)
                else:
                    thr[i] = float(vals[0])
        trees.append({"feature": feat, "threshold": thr, "cats": cats, "left": left, "right": right,
                      "value": value, "cover": cover})
    return trees, weights


# ---- path-dependent TreeSHAP (Lundberg, Erion & Lee 2018, Algorithm 2), vectorised over rows.
# The recursion runs over the tree's nodes once per Arrow batch; feature index and zero
# fraction of a path element are shared by all rows, the one fraction (does the row follow
# this branch) and the path weights are per-row vectors.

def _extend(d, z, o, w, pz, po, pi):
    l = len(d)
    n = po.shape[0]
    d, z, o = d + [pi], z + [pz], o + [po]
    w = [x.copy() for x in w] + [np.ones(n) if l == 0 else np.zeros(n)]
    for i in range(l - 1, -1, -1):
        w[i + 1] = w[i + 1] + po * w[i] * (i + 1) / (l + 1)
        w[i] = pz * w[i] * (l - i) / (l + 1)
    return d, z, o, w


def _unwound_sum(z, o, w, k):
    ud = len(w) - 1
    ok, zk = o[k], z[k]
    nz = ok != 0
    safe_o = np.where(nz, ok, 1.0)
    nxt = w[ud].copy()
    total = np.zeros_like(nxt)
    for i in range(ud - 1, -1, -1):
        tmp = nxt * (ud + 1) / ((i + 1) * safe_o)
        zero_part = (w[i] / zk) / ((ud - i) / (ud + 1)) if zk != 0 else np.zeros_like(nxt)
        total += np.where(nz, tmp, zero_part)
        nxt = np.where(nz, w[i] - tmp * zk * ((ud - i) / (ud + 1)), nxt)
    return total


def _unwind(d, z, o, w, k):
    ud = len(w) - 1
    ok, zk = o[k], z[k]
    nz = ok != 0
    safe_o = np.where(nz, ok, 1.0)
    w = [x.copy() for x in w]
    nxt = w[ud].copy()
    for i in range(ud - 1, -1, -1):
        tmp = w[i]
        with_one = nxt * (ud + 1) / ((i + 1) * safe_o)
        with_zero = (w[i] * (ud + 1)) / (zk * (ud - i)) if zk != 0 else np.zeros_like(nxt)
        w[i] = np.where(nz, with_one, with_zero)
        nxt = np.where(nz, tmp - w[i] * zk * (ud - i) / (ud + 1), nxt)
    d = d[:k] + d[k + 1:]
    z = z[:k] + z[k + 1:]
    o = o[:k] + o[k + 1:]
    return d, z, o, w[:ud]


def tree_shap(tree: dict, X: np.ndarray, phi: np.ndarray, scale: float = 1.0) -> None:
    """Add ``scale`` x the exact SHAP values of one tree for the rows of ``X`` to ``phi``."""
    n = X.shape[0]
    feat, thr, cats = tree["feature"], tree["threshold"], tree["cats"]
    left, right, value, cover = tree["left"], tree["right"], tree["value"], tree["cover"]

    def recurse(node, d, z, o, w, pz, po, pi):
        d, z, o, w = _extend(d, z, o, w, pz, po, pi)
        if feat[node] < 0:
            for i in range(1, len(d)):
                wi = _unwound_sum(z, o, w, i)
                phi[:, d[i]] += scale * wi * (o[i] - z[i]) * value[node]
            return
        f = int(feat[node])
        x = X[:, f]
        if cats[node] is not None:
            go_left = np.isin(x, list(cats[node]))
        else:
            go_left = x <= thr[node]          # Spark trees: NaN goes right
        iz, io = 1.0, np.ones(n)
        for k in range(1, len(d)):
            if d[k] == f:
                iz, io = z[k], o[k]
                d, z, o, w = _unwind(d, z, o, w, k)
                break
        lc, rc = int(left[node]), int(right[node])
        recurse(lc, d, z, o, w, iz * cover[lc] / cover[node], io * go_left, f)
        recurse(rc, d, z, o, w, iz * cover[rc] / cover[node], io * (~go_left), f)

    recurse(0, [], [], [], [], 1.0, np.ones(n), -1)


def expected_value(tree: dict) -> float:
    """Cover-weighted mean of the leaf values (the base value of TreeSHAP)."""
    leaves = tree["feature"] < 0
    return float((tree["value"][leaves] * tree["cover"][leaves]).sum() / tree["cover"][leaves].sum())


def attribution(gbt, scored: DataFrame, features: list[str]) -> DataFrame:
    """Mean absolute SHAP value per feature (exact path-dependent TreeSHAP of
    the GBT margin) over the scored rows.  Arrow batches are processed in
    ``mapInPandas``; each batch is reduced to one row per feature before it leaves
    Python.  Trees (bounded by maxIter x 2^(maxDepth+1) nodes) are shipped once as
    a broadcast."""
    spark = scored.sparkSession
    trees, weights = model_trees(gbt, spark)
    try:
        bc = spark.sparkContext.broadcast((trees, weights))
    except Exception:                      # remote session: ship the (bounded) trees with the function
        class _Local:
            value = (trees, weights)
        bc = _Local()
    nfeat = len(features)
    frame = scored.select(*[F.col(f"`{v}`").cast("double").alias(f"f{i}") for i, v in enumerate(features)])

    def contrib(batches):
        trees_, weights_ = bc.value
        for pdf in batches:
            X = pdf.to_numpy(dtype="float64")
            n = len(X)
            phi = np.zeros((n, nfeat))
            for tr, w in zip(trees_, weights_):
                tree_shap(tr, X, phi, w)
            # one row per feature per batch: the batch is summed before it leaves Python
            yield pd.DataFrame({"feature_idx": np.arange(nfeat, dtype=np.int64),
                                "sum_abs": np.abs(phi).sum(axis=0), "n": np.full(nfeat, n, dtype=np.int64)})

    contrib_df = frame.mapInPandas(contrib, "feature_idx long, sum_abs double, n long")
    names = spark.createDataFrame([(i, f) for i, f in enumerate(features)], "feature_idx long, feature string")
    return (contrib_df.groupBy("feature_idx").agg((F.sum("sum_abs") / F.sum("n")).alias("mean_abs"))
            .join(F.broadcast(names), "feature_idx").select("feature", "mean_abs"))
