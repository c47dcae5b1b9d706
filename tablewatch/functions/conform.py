"""Make a text frame conform to a target schema."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bookkeeping columns of copy-on-write lake tables.
LAKE_BOOKKEEPING_COLUMNS = (
    "_hoodie_commit_time", "_hoodie_commit_seqno", "_hoodie_record_key",
    "_hoodie_partition_path", "_hoodie_file_name",
)


def parse_bracket_list(c: Column) -> Column:
    """``[a,b]`` -> ``["a", "b"]``: brackets stripped, split on ',', no trimming."""
    return F.split(F.regexp_replace(c, r"[\[\]]", ""), ",")


def conform_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """One projection.  Present fields are cast with ``try_cast`` (bad text -> NULL),
    array-of-string fields are parsed from bracketed text, other nested fields
    from JSON text, absent fields become typed NULLs; source columns outside the
    schema are kept after the target fields."""
    present = set(df.columns)
    cols: list[Column] = []
    for field in target.fields:
        if field.name in present:
            src = F.col(f"`{field.name}`")
            if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
                cols.append(parse_bracket_list(src.cast("string")).alias(field.name))
            elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
                # other nested types cannot come from a cast; their text is read as JSON
                cols.append(F.from_json(src.cast("string"), field.dataType).alias(field.name))
            elif isinstance(field.dataType, T.StringType):
                cols.append(src.cast("string").alias(field.name))
            else:
                cols.append(src.try_cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    extra = [F.col(f"`{c}`") for c in df.columns if c not in {f.name for f in target.fields}]
    return df.select(*cols, *extra)


def stamp_processing_time(df: DataFrame, ts, name: str = "processing_time") -> DataFrame:
    """Constant run timestamp (passed in, so runs are repeatable)."""
    import datetime as _dt
    if isinstance(ts, _dt.datetime):       # as text: keeps its wall clock under any session zone
        ts = ts.isoformat(sep=" ")
    return df.withColumn(name, F.lit(ts).cast("timestamp"))


def drop_bookkeeping(df: DataFrame, names: Iterable[str] = LAKE_BOOKKEEPING_COLUMNS) -> DataFrame:
    """P5: drop named columns; absent names are ignored."""
    return df.drop(*names)
