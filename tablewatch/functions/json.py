"""JSON text to columns, and nested JSON to a flat ``name -> double`` list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .text import sanitize_key


LEVELS_A_ROUND = 8              # levels taken apart in one plan; deeper documents take several, written in between


def json_depth(df: DataFrame, text_col: str) -> int:
    """Deepest nesting of any document that parses: brackets outside of string literals, counted in one pass."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bare = F.regexp_replace(F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"', ""), r"[^\[\]{}]", "")
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
    step = F.aggregate(F.split(bare, ""), zero, lambda a, c: F.struct(
        (a["now"] + F.when(c.isin("{", "["), 1).when(c.isin("}", "]"), -1).otherwise(0)).alias("now"),
        F.greatest(a["most"], a["now"] + F.when(c.isin("{", "["), 1).otherwise(0)).alias("most")), lambda a: a["most"])
    parses = F.try_parse_json(F.col(text_col).cast("string")).isNotNull()
    return df.select(F.max(F.when(parses, step))).first()[0] or 0


def parse_json_columns(df: DataFrame, text_col: str, schema: T.StructType | str,
                       keep: list[str] | None = None) -> DataFrame:
    """``from_json`` + flatten one struct.  Malformed text gives an all-NULL row."""
    parsed = df.select(*(keep or []), F.from_json(F.col(text_col).cast("string"), schema).alias("_data"))
    return parsed.select(*(keep or []), "_data.*")


def _numeric_leaf(v: Column) -> Column:
    # numbers and numeric text convert; booleans and other text do not
    return F.when(F.schema_of_variant(v) != F.lit("BOOLEAN"), F.try_variant_get(v, "$", "double"))


def flatten_json(df: DataFrame, text_col: str, keep: list[str] | None = None,
                 max_depth: int | None = None, sanitize: bool = True) -> DataFrame:
    """Every numeric leaf of a JSON document as ``(*keep, name, value)``.

    Object members extend the name with ``.key`` (no dot at the root), array
    elements with ``[i]``.  Leaves that do not read as a double are dropped.
    Each level is one lateral ``variant_explode_outer``: a scalar (or empty
    container) explodes to a row with NULL ``pos``, which marks it as a leaf.
    With ``sanitize`` the name has every character outside ``[a-zA-Z0-9_]``
    replaced by ``_`` (P9).  The number of levels is that of the deepest document
    (``json_depth``; texts that don't parse have none) unless ``max_depth`` gives it.  After
    every ``LEVELS_A_ROUND`` levels the nodes are written to the checkpoint folder, so no
    plan holds more joins than that.
    """
    levels = json_depth(df, text_col) + 1 if max_depth is None else max_depth
    spark = df.sparkSession
    keep = list(keep or [])
    # One linear chain, one scan: finished leaves ride along (their explode input
    # is NULL, which yields a single NULL-pos row that keeps them as they are).
    nodes = df.select(*keep, F.lit("").alias("_path"),
                      F.try_parse_json(F.col(text_col).cast("string")).alias("_v"),
                      F.lit(False).alias("_done"))
    for level in range(levels):
        if level and level % LEVELS_A_ROUND == 0:
            ensure_checkpoint_dir(spark)
            nodes = nodes.checkpoint()
        pending = F.when(~F.col("_done"), F.col("_v")).outer()
        ex = nodes.lateralJoin(spark.tvf.variant_explode_outer(pending), how="left")
        child = F.col("pos").isNotNull()
        step = F.when(F.col("key").isNotNull(),
                      F.when(F.col("_path") == "", F.col("key"))
                      .otherwise(F.concat(F.col("_path"), F.lit("."), F.col("key"))))\
            .otherwise(F.concat(F.col("_path"), F.lit("["), F.col("pos").cast("string"), F.lit("]")))
        nodes = ex.select(*keep,
                          F.when(child, step).otherwise(F.col("_path")).alias("_path"),
                          F.when(child, F.col("value")).otherwise(F.col("_v")).alias("_v"),
                          (~child).alias("_done"))
    out = nodes.where(F.col("_done"))
    name = sanitize_key(F.col("_path")) if sanitize else F.col("_path")
    return (out.select(*keep, name.alias("name"), _numeric_leaf(F.col("_v")).alias("value"))
            .where((F.col("value").isNotNull()) & (F.col("name") != "")))
