"""Column profiles (A18), profile rows (A19) and profile documents (K4).

Pass 1 is ONE fused aggregate over the slice: completeness, approximate
distinct count, numeric statistics, string lengths and text-type class
counts for every column.  String columns also get numeric statistics of
``try_cast(c as double)`` in the same pass, so a text column inferred as
numeric needs no second scan.  The aggregate row (a few numbers per column)
is the only thing brought to the driver: it decides which columns are
low-cardinality.  Pass 2 counts the values of just those columns in one
shuffle (histograms).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import types as TY
from ..functions.text import DISPLAY_ZONE, format_ts
from ..session import local_frame
from .metrics import is_numeric, is_string, lit_sql, q, ts_lit, value_frequencies

# Fixed value: a column gets a histogram when its approximate distinct count is at most this.
HISTOGRAM_THRESHOLD = 120

PROFILE_SCHEMA = T.StructType([
    T.StructField("column", T.StringType(), False),
    T.StructField("data_type", T.StringType(), False),
    T.StructField("is_inferred", T.BooleanType(), False),
    T.StructField("n_rows", T.LongType(), False),
    T.StructField("completeness", T.DoubleType(), True),
    T.StructField("approx_distinct", T.LongType(), True),
    T.StructField("null_count", T.LongType(), True),
    T.StructField("profile_kind", T.StringType(), False),   # numeric | string | standard
    T.StructField("minimum", T.DoubleType(), True),
    T.StructField("maximum", T.DoubleType(), True),
    T.StructField("mean", T.DoubleType(), True),
    T.StructField("std_dev", T.DoubleType(), True),
    T.StructField("sum", T.DoubleType(), True),
    T.StructField("min_length", T.DoubleType(), True),
    T.StructField("max_length", T.DoubleType(), True),
    T.StructField("has_histogram", T.BooleanType(), False),
])


@dataclass
class ColumnProfiles:
    n_rows: int
    frame: DataFrame          # one row per column, PROFILE_SCHEMA
    histograms: DataFrame     # column, value, cnt, ratio (low-cardinality columns only)
    rows: list = field(default_factory=list)


def _stats(c, prefix):
    return [F.min(c).alias(f"{prefix}min"), F.max(c).alias(f"{prefix}max"), F.avg(c).alias(f"{prefix}mean"),
            F.stddev_pop(c).alias(f"{prefix}std"), F.sum(c).alias(f"{prefix}sum")]


def _class_sql(c: str) -> str:
    """SQL twin of :func:`functions.types.value_class` (same prefilter and patterns)."""
    lead = ", ".join(lit_sql(x) for x in TY._LEADING)
    return (f"CASE WHEN {c} IS NULL THEN CAST(NULL AS STRING) "
            f"WHEN NOT substring({c}, 1, 1) IN ({lead}) THEN 'String' "
            f"WHEN {c} RLIKE {lit_sql(TY.INTEGRAL_PATTERN)} THEN 'Integral' "
            f"WHEN {c} RLIKE {lit_sql(TY.FRACTIONAL_PATTERN)} THEN 'Fractional' "
            f"WHEN {c} RLIKE {lit_sql(TY.BOOLEAN_PATTERN)} THEN 'Boolean' ELSE 'String' END")


def _stats_sql(v: str, p: str) -> list[str]:
    return [f"min({v}) AS {p}min", f"max({v}) AS {p}max", f"avg({v}) AS {p}mean",
            f"stddev_pop({v}) AS {p}std", f"sum({v}) AS {p}sum"]


def profile_aggregate(df: DataFrame, fields) -> DataFrame:
    """Pass 1 as a lazy one-row aggregate (see :func:`profile_columns`), built as SQL
    text in two calls whatever the width of the table."""
    # text values are classified once per row in a projection below the aggregate;
    # only values classified as numbers are cast (a failed cast is the slow path)
    cls_cols = {f.name: f"__cls{i}" for i, f in enumerate(fields) if is_string(f.dataType)}
    src = df.selectExpr(*[q(f.name) for f in fields],
                        *[f"{_class_sql(q(n))} AS {a}" for n, a in cls_cols.items()])
    exprs = ["count(1) AS n"]
    for i, f in enumerate(fields):
        c = q(f.name)
        p = f"c{i}_"
        exprs += [f"count({c}) AS {p}nn", f"approx_count_distinct({c}) AS {p}ad"]
        if is_numeric(f.dataType):
            exprs += _stats_sql(f"CAST({c} AS DOUBLE)", p)
        elif is_string(f.dataType):
            k = cls_cols[f.name]
            exprs += [f"min(length({c})) AS {p}minlen", f"max(length({c})) AS {p}maxlen"]
            exprs += [f"CAST(sum(CASE WHEN {k} = '{name}' THEN 1 ELSE 0 END) AS BIGINT) AS {p}{name}"
                      for name in (TY.INTEGRAL, TY.FRACTIONAL, TY.BOOLEAN, TY.STRING)]
            exprs += _stats_sql(f"CASE WHEN {k} IN ('Integral', 'Fractional') THEN try_cast({c} AS DOUBLE) END", p)
    return src.selectExpr(*exprs)


def profile_columns(df: DataFrame, histogram_threshold: int = HISTOGRAM_THRESHOLD,
                    columns: list[str] | None = None) -> ColumnProfiles:
    """Per-column profile of ``df``."""
    spark = df.sparkSession
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    agg = profile_aggregate(df, fields).collect()[0].asDict()   # one row: a few numbers per column
    n = int(agg["n"])
    rows = []
    for i, f in enumerate(fields):
        p = f"c{i}_"
        nn = int(agg[p + "nn"])
        completeness = nn / n if n else None
        declared = TY.declared_type_name(f.dataType)
        inferred = False
        dtype = declared
        if is_string(f.dataType):
            counts = [int(agg[p + k] or 0) for k in (TY.INTEGRAL, TY.FRACTIONAL, TY.BOOLEAN, TY.STRING)]
            dtype = _infer(*counts)
            inferred = True
        numeric = dtype in (TY.INTEGRAL, TY.FRACTIONAL) and (is_numeric(f.dataType) or is_string(f.dataType))
        kind = "numeric" if numeric else ("string" if dtype == TY.STRING and is_string(f.dataType) else "standard")
        ad = int(agg[p + "ad"]) if n else None
        rows.append({
            "column": f.name, "data_type": dtype, "is_inferred": inferred, "n_rows": n,
            "completeness": completeness, "approx_distinct": ad,
            "null_count": (n - nn) if n else None, "profile_kind": kind,
            "minimum": _f(agg.get(p + "min")) if numeric else None,
            "maximum": _f(agg.get(p + "max")) if numeric else None,
            "mean": _f(agg.get(p + "mean")) if numeric else None,
            "std_dev": _f(agg.get(p + "std")) if numeric else None,
            "sum": _f(agg.get(p + "sum")) if numeric else None,
            "min_length": _f(agg.get(p + "minlen")) if kind == "string" else None,
            "max_length": _f(agg.get(p + "maxlen")) if kind == "string" else None,
            "has_histogram": bool(n and ad is not None and ad <= histogram_threshold),
        })
    frame = local_frame(spark, rows, PROFILE_SCHEMA)
    hist_cols = [r["column"] for r in rows if r["has_histogram"]]
    if hist_cols:
        freq = value_frequencies(df, hist_cols)
        histograms = freq.select("column", "value", "cnt",
                                 (F.col("cnt") / F.lit(float(n))).alias("ratio"))
    else:
        histograms = spark.createDataFrame([], "column string, value string, cnt long, ratio double")
    return ColumnProfiles(n, frame, histograms, rows)


def _f(x):
    return None if x is None else float(x)


def _infer(n_int, n_frac, n_bool, n_str) -> str:
    # same decision as functions.types.inferred_type, on driver-side counts
    if n_str > 0:
        return TY.STRING
    if n_bool > 0 and (n_int > 0 or n_frac > 0):
        return TY.STRING
    if n_bool > 0:
        return TY.BOOLEAN
    if n_frac > 0:
        return TY.FRACTIONAL
    if n_int > 0:
        return TY.INTEGRAL
    return TY.UNKNOWN


# Metric names of profile rows.
BASE_PROFILE_METRICS = ("completeness", "approximateNumDistinctValues", "nullCount")
NUMERIC_PROFILE_METRICS = ("mean", "maximum", "minimum", "stdDev", "sum")
STRING_PROFILE_METRICS = ("minLength", "maxLength")


def profile_rows(profiles: ColumnProfiles, profiling_ts, data_ts, zone: str = DISPLAY_ZONE) -> DataFrame:
    """Long profile rows; a metric the profile lacks is NaN; plus one Size row."""
    fr = profiles.frame
    nan = F.lit(float("nan"))

    def v(c):
        return F.coalesce(F.col(c).cast("double"), nan)

    def item(name, value):
        return F.struct(F.lit(name).alias("metric"), value.alias("value"))

    base = [item("completeness", v("completeness")),
            item("approximateNumDistinctValues", v("approx_distinct")),
            item("nullCount", F.coalesce(F.col("null_count").cast("double"), nan))]
    numeric = [item("mean", v("mean")), item("maximum", v("maximum")), item("minimum", v("minimum")),
               item("stdDev", v("std_dev")), item("sum", v("sum"))]
    string = [item("minLength", v("min_length")), item("maxLength", v("max_length"))]
    items = (F.when(F.col("profile_kind") == "numeric", F.array(*base, *numeric))
             .when(F.col("profile_kind") == "string", F.array(*base, *string))
             .otherwise(F.array(*base)))
    per_col = fr.select("column", "data_type", F.explode(items).alias("m")).select(
        "column", "data_type", "m.metric", "m.value")
    size = local_frame(fr.sparkSession, [("", "", "Size", float(profiles.n_rows))],
                       "column string, data_type string, metric string, value double")
    rows = per_col.unionByName(size)
    return rows.select(
        ts_lit(profiling_ts).alias("profilingTimestamp"),
        ts_lit(data_ts).alias("dataTimestamp"),
        format_ts(ts_lit(profiling_ts), zone).alias("profilingTimestamp_Formatted"),
        format_ts(ts_lit(data_ts), zone).alias("dataTimestamp_Formatted"),
        "column", "data_type", "metric", "value")


def write_json_documents(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K4: one JSON document per row, as text."""
    df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value")) \
        .write.mode(mode).text(path)


def infer_text_types(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """T-rule per text column, all columns in one aggregate:
    ``column, n_integral, n_fractional, n_boolean, n_string, inferred``."""
    cols = columns or [f.name for f in df.schema.fields if is_string(f.dataType)]
    exprs = []
    for i, c in enumerate(cols):
        exprs += TY.class_counts(F.col(f"`{c}`"), f"c{i}_")
    row = df.agg(*exprs)
    structs = []
    for i, c in enumerate(cols):
        p = f"c{i}_"
        n_int, n_frac, n_bool, n_str = (F.col(p + k) for k in (TY.INTEGRAL, TY.FRACTIONAL, TY.BOOLEAN, TY.STRING))
        structs.append(F.struct(F.lit(c).alias("column"), n_int.alias("n_integral"), n_frac.alias("n_fractional"),
                                n_bool.alias("n_boolean"), n_str.alias("n_string"),
                                TY.inferred_type(n_int, n_frac, n_bool, n_str).alias("inferred")))
    return row.select(F.inline(F.array(*structs)))
