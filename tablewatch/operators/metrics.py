"""Column metrics (A1-A17) computed in as few passes as possible.

Every analyzer is either

* a *scan* analyzer: one aggregate expression (rendered as SQL text).  All
  scan analyzers of a run go into a single global aggregate, so the table is
  read once and Spark plans a partial (map-side) + final HashAggregate; or
* a *grouping* analyzer (Entropy, Uniqueness): it needs value frequencies.
  All such columns are unpivoted with one ``stack`` into typed value slots
  (no per-value text conversion) and counted with ONE ``groupBy``; map-side
  partial aggregation collapses a hot value to one row per task before the
  shuffle, so a value holding a third of the rows costs nothing extra.

The result is a long metric table ``entity, instance, name, value`` with one
row per metric.  A metric that cannot be computed (min of an all-null
column, anything but Size on an empty slice) is absent, not NULL.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


METRIC_SCHEMA = "entity string, instance string, name string, value double"

# Entity labels of metric rows (fixed values).
DATASET = "Dataset"
COLUMN = "Column"
MULTICOLUMN = "Multicolumn"




def q(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def lit_sql(v: str) -> str:
    """A Python string as an SQL string literal."""
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Analyzer:
    """Base class; subclasses set ``name`` and build one aggregate expression."""

    @property
    def name(self) -> str:
        return type(self).__name__

    entity = COLUMN
    grouping = False

    @property
    def instance(self) -> str:
        return getattr(self, "column", "*")

    def sql(self) -> str:  # pragma: no cover - abstract
        """The aggregate as SQL text (plans are built with one call for all analyzers)."""
        raise NotImplementedError

    def agg(self) -> Column:
        return F.expr(self.sql())


@dataclass(frozen=True)
class Size(Analyzer):
    entity = DATASET

    @property
    def instance(self) -> str:
        return "*"

    def sql(self) -> str:
        return "CAST(count(1) AS DOUBLE)"


@dataclass(frozen=True)
class Completeness(Analyzer):
    column: str

    def sql(self) -> str:
        return f"try_divide(CAST(count({q(self.column)}) AS DOUBLE), CAST(count(1) AS DOUBLE))"


@dataclass(frozen=True)
class NullCount(Analyzer):
    """Rows where the column is NULL."""
    column: str

    def sql(self) -> str:
        return f"CASE WHEN count(1) > 0 THEN CAST(count(1) - count({q(self.column)}) AS DOUBLE) END"


@dataclass(frozen=True)
class ApproxCountDistinct(Analyzer):
    column: str
    rsd: float = 0.05

    def sql(self) -> str:
        return (f"CASE WHEN count(1) > 0 THEN CAST(approx_count_distinct({q(self.column)}, {float(self.rsd)}) "
                f"AS DOUBLE) END")


@dataclass(frozen=True)
class Minimum(Analyzer):
    column: str

    def sql(self) -> str:
        return f"min(CAST({q(self.column)} AS DOUBLE))"


@dataclass(frozen=True)
class Maximum(Analyzer):
    column: str

    def sql(self) -> str:
        return f"max(CAST({q(self.column)} AS DOUBLE))"


@dataclass(frozen=True)
class Mean(Analyzer):
    column: str

    def sql(self) -> str:
        return f"avg(CAST({q(self.column)} AS DOUBLE))"


@dataclass(frozen=True)
class Sum(Analyzer):
    column: str

    def sql(self) -> str:
        # summed as double: an ANSI long overflow must not fail a quality job
        return f"sum(CAST({q(self.column)} AS DOUBLE))"


@dataclass(frozen=True)
class StandardDeviation(Analyzer):
    """Population standard deviation."""
    column: str

    def sql(self) -> str:
        return f"stddev_pop(CAST({q(self.column)} AS DOUBLE))"


@dataclass(frozen=True)
class MinLength(Analyzer):
    column: str

    def sql(self) -> str:
        return f"CAST(min(length({q(self.column)})) AS DOUBLE)"


@dataclass(frozen=True)
class MaxLength(Analyzer):
    column: str

    def sql(self) -> str:
        return f"CAST(max(length({q(self.column)})) AS DOUBLE)"


@dataclass(frozen=True)
class Correlation(Analyzer):
    """Pearson correlation over rows where both columns are non-null."""
    first: str
    second: str
    entity = MULTICOLUMN

    @property
    def instance(self) -> str:
        return f"{self.first},{self.second}"

    def sql(self) -> str:
        return f"corr(CAST({q(self.first)} AS DOUBLE), CAST({q(self.second)} AS DOUBLE))"


@dataclass(frozen=True)
class Compliance(Analyzer):
    """Share of rows for which a SQL predicate is true; NULL counts as false."""
    rule: str
    predicate: str

    @property
    def instance(self) -> str:
        return self.rule

    def sql(self) -> str:
        return (f"try_divide(CAST(sum(CAST(coalesce(({self.predicate}), false) AS INT)) AS DOUBLE), "
                f"CAST(count(1) AS DOUBLE))")


@dataclass(frozen=True)
class Entropy(Analyzer):
    """-sum(p ln p) over value frequencies, p = count / non-null rows."""
    column: str
    grouping = True


@dataclass(frozen=True)
class Uniqueness(Analyzer):
    """Values seen exactly once / non-null rows."""
    column: str
    grouping = True


# --------------------------------------------------------------------------- run

def _long_rows(one_row: DataFrame, specs: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Unpivot a one-row aggregate (columns named by ``specs[i][3]``) into metric rows."""
    structs = ", ".join(
        f"named_struct('entity', {lit_sql(e)}, 'instance', {lit_sql(i)}, 'name', {lit_sql(n)}, "
        f"'value', CAST({q(a)} AS DOUBLE))" for e, i, n, a in specs)
    return one_row.selectExpr(f"inline(array({structs}))").where("value IS NOT NULL")


def scan_metrics(df: DataFrame, analyzers: Sequence[Analyzer], separate_sketches: bool = False) -> DataFrame:
    """All scan analyzers in one aggregate over ``df`` -> metric rows.  The
    aggregate is submitted as SQL text in one call (a global aggregate via
    ``selectExpr``), whatever the number of analyzers.

    ``approx_count_distinct`` is an imperative aggregate: with it in the same
    aggregate, Spark runs the whole aggregate without whole-stage codegen.
    ``separate_sketches=True`` computes the HLL sketches in a second aggregate
    instead (two scans of ``df``, the main one code-generated); the default
    keeps one scan."""
    scan = [a for a in analyzers if not a.grouping]
    if not scan:
        return df.sparkSession.createDataFrame([], METRIC_SCHEMA)
    sketches = [a for a in scan if isinstance(a, ApproxCountDistinct)]
    if separate_sketches and sketches and len(sketches) < len(scan):
        rest = [a for a in scan if not isinstance(a, ApproxCountDistinct)]
        return scan_metrics(df, rest).unionByName(scan_metrics(df, sketches))
    one_row = df.selectExpr(*[f"{a.sql()} AS _m{i}" for i, a in enumerate(scan)])
    return _long_rows(one_row, [(a.entity, a.instance, a.name, f"_m{i}") for i, a in enumerate(scan)])


# Grouping metrics unpivot values into typed slots (no per-value text conversion);
# text is rendered only for the distinct values that come out of the aggregation.
_SLOTS = (("_vl", "bigint"), ("_vd", "double"), ("_vs", "string"), ("_vn", "timestamp_ntz"), ("_vt", "timestamp"))


def _slot(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "_vl"
    if isinstance(dtype, T.DoubleType):
        return "_vd"
    if isinstance(dtype, T.TimestampNTZType):
        return "_vn"
    if isinstance(dtype, T.TimestampType):
        return "_vt"
    return "_vs"


def _typed_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, _vl, _vd, _vs, _vn, _vt, cnt)``: one stack + one partial/final aggregation."""
    types = {f.name: f.dataType for f in df.schema.fields}
    stack = []
    for c in columns:
        slot = _slot(types[c])
        vals = []
        for name, t in _SLOTS:
            if name == slot:
                vals.append(f"CAST({q(c)} AS {t})")
            else:
                vals.append(f"CAST(NULL AS {t})")
        stack.append(f"{lit_sql(c)}, " + ", ".join(vals))
    names = ", ".join(["column"] + [n for n, _ in _SLOTS])
    long = df.selectExpr(f"stack({len(columns)}, {', '.join(stack)}) AS ({names})")
    present = " OR ".join(f"{n} IS NOT NULL" for n, _ in _SLOTS)
    return long.where(present).groupBy("column", *[n for n, _ in _SLOTS]).agg(F.count(F.lit(1)).alias("cnt"))


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, cnt)`` for the non-null values of ``columns``, in one shuffle.

    Values are grouped in their own type and rendered as text after the
    aggregation, so only distinct values are converted."""
    counts = _typed_counts(df, columns)
    text = "coalesce(" + ", ".join(f"CAST({n} AS STRING)" for n, _ in _SLOTS) + ")"
    return counts.selectExpr("column", f"{text} AS value", "cnt")


def frequency_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: non-null rows, distinct values, values seen once, entropy."""
    freq = _typed_counts(df, columns)
    cnt = F.col("cnt").cast("double")
    return (freq.groupBy("column")
            .agg(F.sum(cnt).alias("n"),
                 F.count(F.lit(1)).alias("distinct"),
                 F.sum(F.when(F.col("cnt") == 1, 1).otherwise(0)).alias("singles"),
                 F.sum(cnt * F.ln(cnt)).alias("n_ln_n"))
            .select("column", "n", "distinct", "singles",
                    (F.ln(F.col("n")) - F.col("n_ln_n") / F.col("n")).alias("entropy")))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, distinct)``: exact count of the non-null values, each column on its own.  Every branch reads
    and shuffles one column only, where one aggregate for all repeats every row once per column at full width."""
    out = None
    for c in columns:
        part = df.select(F.col(q(c)).alias("v")).distinct().agg(F.count("v").alias("distinct")) \
            .select(F.lit(c).alias("column"), "distinct")
        out = part if out is None else out.unionByName(part)
    return out


def grouping_metrics(df: DataFrame, analyzers: Sequence[Analyzer]) -> DataFrame:
    grouped = [a for a in analyzers if a.grouping]
    if not grouped:
        return df.sparkSession.createDataFrame([], METRIC_SCHEMA)
    columns = sorted({a.column for a in grouped})
    summary = frequency_summary(df, columns)
    # both grouping metrics per column, then only the requested (column, metric) pairs,
    # selected with literals (no join)
    both = summary.select(
        "column", F.inline(F.array(
            F.struct(F.lit("Entropy").alias("name"), F.col("entropy").alias("value")),
            F.struct(F.lit("Uniqueness").alias("name"),
                     F.try_divide(F.col("singles").cast("double"), F.col("n")).alias("value")))))
    wanted = [f"{a.column}\u0000{a.name}" for a in grouped]
    return (both.where(F.concat(F.col("column"), F.lit("\u0000"), F.col("name")).isin(wanted))
            .select(F.lit(COLUMN).alias("entity"), F.col("column").alias("instance"),
                    F.col("name"), F.col("value").cast("double").alias("value"))
            .where(F.col("value").isNotNull()))


def run_analyzers(df: DataFrame, analyzers: Sequence[Analyzer], separate_sketches: bool = False) -> DataFrame:
    """Every analyzer over ``df``; one scan aggregate + (if needed) one grouping pass."""
    analyzers = list(dict.fromkeys(analyzers))  # dedupe, keep order
    has_scan = any(not a.grouping for a in analyzers)
    has_grouping = any(a.grouping for a in analyzers)
    if has_scan and has_grouping:
        return scan_metrics(df, analyzers, separate_sketches).unionByName(grouping_metrics(df, analyzers))
    return grouping_metrics(df, analyzers) if has_grouping else scan_metrics(df, analyzers, separate_sketches)


# ----------------------------------------------------------------- dispatch

def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_string(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.VarcharType, T.CharType))


def default_analyzers(df: DataFrame, *, approx_distinct: bool = True, std_dev: bool = False,
                      entropy: bool = False, columns: Iterable[str] | None = None) -> list[Analyzer]:
    """Size, then per column Completeness (+ApproxCountDistinct, +Entropy);
    numeric: Minimum, Maximum, Mean, Sum (+StandardDeviation); string: MaxLength, MinLength."""
    wanted = set(columns) if columns is not None else None
    out: list[Analyzer] = [Size()]
    for field in df.schema.fields:
        c = field.name
        if wanted is not None and c not in wanted:
            continue
        out.append(Completeness(c))
        if approx_distinct:
            out.append(ApproxCountDistinct(c))
        if entropy:
            out.append(Entropy(c))
        if is_numeric(field.dataType):
            out += [Minimum(c), Maximum(c), Mean(c), Sum(c)]
            if std_dev:
                out.append(StandardDeviation(c))
        elif is_string(field.dataType):
            out += [MaxLength(c), MinLength(c)]
    return out


def profile_metrics(df: DataFrame, separate_sketches: bool = False, **kw) -> DataFrame:
    """A14 + A15 + A16: the schema-driven metric set as long rows."""
    return run_analyzers(df, default_analyzers(df, **kw), separate_sketches)


def with_entity_type(metrics: DataFrame) -> DataFrame:
    """``type`` = Dataset / Column / unknown."""
    return metrics.withColumn(
        "type", F.when(F.col("entity") == DATASET, DATASET)
        .when(F.col("entity") == COLUMN, COLUMN).otherwise("unknown"))


def ts_lit(v) -> Column:
    """A run time as a timestamp literal.  Python datetimes go in as text, so the
    value keeps its wall clock under any session time zone."""
    import datetime as _dt
    if isinstance(v, _dt.datetime):
        v = v.isoformat(sep=" ")
    return F.lit(v).cast("timestamp")


def with_context(metrics: DataFrame, *, ts, table: str, path: str | None = None,
                 slice_start=None) -> DataFrame:
    """Stamp run time, table and (optionally) source path and slice start."""
    out = (metrics
           .withColumn("ts", ts_lit(ts))
           .withColumn("table", F.lit(table))
           .withColumn("path", F.lit(path).cast("string"))
           .withColumn("slice_start", ts_lit(slice_start)))
    return out


HISTORY_FIELDS = ["ts", "table", "slice_start", "entity", "instance", "data_type", "metric", "value", "value_str"]


def as_history_rows(metrics: DataFrame, source: DataFrame, *, ts, table: str, slice_start=None) -> DataFrame:
    """Metric rows in the unified history layout
    ``ts, table, slice_start, entity, instance, data_type, metric, value, value_str``;
    ``data_type`` is the source column's type (NULL for dataset / multi-column rows)."""
    # column -> type as a literal map (schema width), looked up per row: no join
    pairs = [x for f in source.schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))]
    type_of = F.try_element_at(F.create_map(*pairs), F.col("instance")) if pairs else F.lit(None)
    out = metrics.withColumn("data_type", type_of.cast("string"))
    return out.select(ts_lit(ts).alias("ts"), F.lit(table).alias("table"),
                      ts_lit(slice_start).alias("slice_start"), "entity", "instance",
                      F.when(F.col("entity") == COLUMN, F.col("data_type")).alias("data_type"),
                      F.col("name").alias("metric"), "value", F.lit(None).cast("string").alias("value_str"))
