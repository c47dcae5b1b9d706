"""Type inference for text columns (the T-rule) as aggregate-friendly Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Per-value classification patterns and type names.
INTEGRAL_PATTERN = r"^[+-]? ?\d+$"
FRACTIONAL_PATTERN = r"^[+-]? ?\d*\.\d*$"
BOOLEAN_PATTERN = r"^(true|false)$"
UNKNOWN, FRACTIONAL, INTEGRAL, BOOLEAN, STRING = "Unknown", "Fractional", "Integral", "Boolean", "String"


# Every non-string pattern above starts with one of these characters, so a value whose
# first character is not among them is String without running any regex.
_LEADING = ["+", "-", ".", " ", "t", "f"] + [str(d) for d in range(10)]


def value_class(c: Column) -> Column:
    """Class of one text value: Integral, Fractional, Boolean, String; NULL stays NULL."""
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(~F.substring(c, 1, 1).isin(_LEADING), F.lit(STRING))
            .when(c.rlike(INTEGRAL_PATTERN), F.lit(INTEGRAL))
            .when(c.rlike(FRACTIONAL_PATTERN), F.lit(FRACTIONAL))
            .when(c.rlike(BOOLEAN_PATTERN), F.lit(BOOLEAN))
            .otherwise(F.lit(STRING)))


def class_counts(c: Column, prefix: str, cls: Column | None = None) -> list[Column]:
    """Four aggregate expressions counting the classes of ``c`` (as text); pass a
    precomputed class column as ``cls`` to classify each value only once."""
    cls = value_class(c.cast("string")) if cls is None else cls
    return [F.sum(F.when(cls == name, 1).otherwise(0)).cast("long").alias(f"{prefix}{name}")
            for name in (INTEGRAL, FRACTIONAL, BOOLEAN, STRING)]


def inferred_type(n_int: Column, n_frac: Column, n_bool: Column, n_str: Column) -> Column:
    """Any string -> String; booleans mixed with numbers -> String; then Boolean,
    Fractional, Integral; nothing seen -> Unknown."""
    return (F.when(n_str > 0, F.lit(STRING))
            .when((n_bool > 0) & ((n_int > 0) | (n_frac > 0)), F.lit(STRING))
            .when(n_bool > 0, F.lit(BOOLEAN))
            .when(n_frac > 0, F.lit(FRACTIONAL))
            .when(n_int > 0, F.lit(INTEGRAL))
            .otherwise(F.lit(UNKNOWN)))


def declared_type_name(dtype) -> str:
    """Spark type -> profile type name."""
    from pyspark.sql import types as T
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return INTEGRAL
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return FRACTIONAL
    if isinstance(dtype, T.BooleanType):
        return BOOLEAN
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return STRING
    return UNKNOWN
