"""Mergeable metric states: what a batch must keep so that whole-stream metrics are exact.

A finished metric of two batches cannot be combined (an entropy, a correlation, a distinct
count); its state can.  :func:`metric_states` turns a DataFrame and a list of analyzers into
state rows, :func:`merge_states` combines any number of them into one row per state (so hours
merge into days in any grouping), :func:`finish` turns states into the metric rows that
``run_analyzers`` gives over all their rows together:

* rows and non-null rows, extremes and sums of a column or its text lengths, hits of a rule;
* mean and second moment (StandardDeviation), both means, second moments and the
  co-moment of a pair (Correlation), merged around the common mean;
* a HyperLogLog sketch (ApproxCountDistinct), merged by union;
* value counts (Entropy, Uniqueness), one row per column and distinct value.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import metrics as M

# kind: size, column, number, text, pair, rule, sketch or value
STATE_SCHEMA = ("kind string, instance string, item string, n long, hits long, low double, high double, total double, "
                "mean double, m2 double, mean_b double, m2_b double, co double, sketch binary")
FIELDS = [f.split()[0] for f in STATE_SCHEMA.split(", ")]
KEYS = ["kind", "instance", "item"]
SKETCH_BITS = 12                # log2 of a sketch's registers

_NUMBER = (M.Minimum, M.Maximum, M.Mean, M.Sum, M.StandardDeviation)
_TEXT = (M.MinLength, M.MaxLength)
_VALUE = (M.Entropy, M.Uniqueness)


def _struct(kind: str, instance: str, **values: str) -> str:
    """One state as SQL; fields not given are NULL of the schema's type."""
    given = {"kind": M.lit_sql(kind), "instance": M.lit_sql(instance)} | values
    fields = (f.split() for f in STATE_SCHEMA.split(", "))
    return "named_struct(" + ", ".join(f"'{n}', CAST({given.get(n, 'NULL')} AS {'bigint' if t == 'long' else t})" for n, t in fields) + ")"


def _needed(analyzers: Iterable[M.Analyzer]) -> list[str]:
    """The aggregate expressions of the analyzers' states, each once."""
    out: dict[tuple, str] = {}
    for a in analyzers:
        if isinstance(a, M.Size):
            out["size"] = _struct("size", "*", n="count(1)")
        elif isinstance(a, (M.Completeness, M.NullCount)):
            out["column", a.column] = _struct("column", a.column, n="count(1)", hits=f"count({M.q(a.column)})")
        elif isinstance(a, _NUMBER):
            c = f"CAST({M.q(a.column)} AS DOUBLE)"
            out["number", a.column] = _struct("number", a.column, n=f"count({c})", low=f"min({c})", high=f"max({c})", total=f"sum({c})",
                                              mean=f"avg({c})", m2=f"var_pop({c}) * count({c})")
        elif isinstance(a, _TEXT):
            c = f"length({M.q(a.column)})"
            out["text", a.column] = _struct("text", a.column, n=f"count({c})", low=f"min({c})", high=f"max({c})")
        elif isinstance(a, M.Correlation):
            x, y = (f"CAST({M.q(c)} AS DOUBLE)" for c in (a.first, a.second))
            out["pair", a.instance] = _struct("pair", a.instance, n=f"regr_count({y}, {x})", mean=f"regr_avgx({y}, {x})", m2=f"regr_sxx({y}, {x})",
                                              mean_b=f"regr_avgy({y}, {x})", m2_b=f"regr_syy({y}, {x})", co=f"regr_sxy({y}, {x})")
        elif isinstance(a, M.Compliance):
            out["rule", a.rule] = _struct("rule", a.rule, n="count(1)", hits=f"count_if(coalesce(({a.predicate}), false))")
        elif isinstance(a, M.ApproxCountDistinct):
            out["sketch", a.column] = _struct("sketch", a.column, n="count(1)", sketch=f"hll_sketch_agg(CAST({M.q(a.column)} AS STRING), {SKETCH_BITS})")
        elif not isinstance(a, _VALUE):
            raise ValueError(f"no mergeable state for {a.name}")
    return list(out.values())


def metric_states(df: DataFrame, analyzers: Sequence[M.Analyzer]) -> DataFrame:
    """State rows (``STATE_SCHEMA``) of a batch: one scan aggregate and, for value counts, one grouping pass.

    An empty batch gives states of zero rows, which change nothing when merged.
    """
    structs = _needed(analyzers)
    columns = sorted({a.column for a in analyzers if isinstance(a, _VALUE)})
    parts = []
    if structs:
        named = df.selectExpr(*[f"{s} AS s{i}" for i, s in enumerate(structs)])
        parts.append(named.selectExpr(f"inline(array({', '.join(f's{i}' for i in range(len(structs)))}))"))
    if columns:
        counts = M.value_frequencies(df, columns)
        rest = [F.lit(None).cast("bigint" if t == "long" else t).alias(n) for n, t in (f.split() for f in STATE_SCHEMA.split(", "))
                if n not in ("kind", "instance", "item", "n")]
        parts.append(counts.select(F.lit("value").alias("kind"), F.col("column").alias("instance"), F.col("value").alias("item"),
                                   F.col("cnt").alias("n"), *rest).select(*FIELDS))
    if not parts:
        return df.sparkSession.createDataFrame([], STATE_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per state (and group ``by``).  Moments are moved to the common mean: with means ``m_i`` of ``n_i`` rows and
    their mean ``m``, the second moment is the sum of ``M2_i + n_i (m_i - m)^2``, a co-moment likewise."""
    keys = [*by, *KEYS]
    sketches = states.where("kind = 'sketch'").groupBy(*keys).agg(F.hll_union_agg("sketch", F.lit(True)).alias("sketch"), F.sum("n").alias("n"))
    plain = states.where("kind <> 'sketch'")
    n = F.col("n").cast("double")
    size = F.sum(F.when(F.col("mean").isNotNull(), n))
    first = plain.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("hits").alias("hits"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("total").alias("total"),
        F.try_divide(F.sum(n * F.col("mean")), size).alias("mean"), F.try_divide(F.sum(n * F.col("mean_b")), size).alias("mean_b"))
    moments = plain.where("kind in ('number', 'pair') and mean is not null")
    centre = first.where("kind in ('number', 'pair')").select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("mean").alias("_m"), F.col("mean_b").alias("_mb"))
    same = F.lit(True)
    for k in keys:
        same = same & moments[k].eqNullSafe(centre[f"_{k}"])
    da, db = F.col("mean") - F.col("_m"), F.col("mean_b") - F.col("_mb")
    second = moments.join(centre, same).groupBy(*keys).agg(
        F.sum(F.col("m2") + n * da * da).alias("m2"), F.sum(F.col("m2_b") + n * db * db).alias("m2_b"), F.sum(F.col("co") + n * da * db).alias("co"))
    every = first.unionByName(second, allowMissingColumns=True).unionByName(sketches, allowMissingColumns=True)
    return every.groupBy(*keys).agg(*[F.max(c).alias(c) for c in FIELDS if c not in KEYS])


def finish(states: DataFrame, analyzers: Sequence[M.Analyzer], by: Sequence[str] = ()) -> DataFrame:
    """Metric rows ``(by..., entity, instance, name, value)`` of the analyzers from state rows, merged first."""
    merged = merge_states(states, by)
    n, hits, low, high = (F.col(c).cast("double") for c in ("n", "hits", "low", "high"))
    deviation = F.sqrt(F.try_divide(F.col("m2"), n))
    of_kind = {
        "size": [("Size", n)], "column": [("Completeness", F.try_divide(hits, n)), ("NullCount", F.when(n > 0, n - hits))],
        "number": [("Minimum", low), ("Maximum", high), ("Sum", F.col("total")), ("Mean", F.col("mean")), ("StandardDeviation", deviation)],
        "text": [("MinLength", low), ("MaxLength", high)],
        "pair": [("Correlation", F.try_divide(F.col("co"), F.sqrt(F.col("m2") * F.col("m2_b"))))],
        "rule": [("Compliance", F.try_divide(hits, n))],
        "sketch": [("ApproxCountDistinct", F.when(n > 0, F.hll_sketch_estimate("sketch").cast("double")))],
    }
    rows = None
    for kind, values in of_kind.items():
        items = F.array(*[F.struct(F.lit(name).alias("name"), v.cast("double").alias("value")) for name, v in values])
        rows = F.when(F.col("kind") == kind, items) if rows is None else rows.when(F.col("kind") == kind, items)
    plain = merged.where("kind <> 'value'").select(*by, "instance", "kind", F.inline(rows))
    values = merged.where("kind = 'value'").groupBy(*by, "instance").agg(
        F.sum(n).alias("n"), F.sum(n * F.ln(n)).alias("nl"), F.count_if(F.col("n") == 1).alias("ones"))
    counted = values.select(*by, "instance", F.lit("value").alias("kind"), F.inline(F.array(
        F.struct(F.lit("Entropy").alias("name"), (F.ln("n") - F.col("nl") / F.col("n")).alias("value")),
        F.struct(F.lit("Uniqueness").alias("name"), F.try_divide(F.col("ones").cast("double"), F.col("n")).alias("value")))))
    entity = F.when(F.col("kind") == "size", M.DATASET).when(F.col("kind") == "pair", M.MULTICOLUMN).otherwise(M.COLUMN)
    wanted = sorted({f"{a.instance}\u0000{a.name}" for a in analyzers})
    every = plain.unionByName(counted).where(F.concat("instance", F.lit("\u0000"), "name").isin(wanted) & F.col("value").isNotNull())
    return every.select(*by, entity.alias("entity"), "instance", "name", "value")
