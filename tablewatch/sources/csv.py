"""Text CSV drops with an external schema document."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_text(spark: SparkSession, path: str, delimiter: str = ",") -> DataFrame:
    """Header row, no type inference: every column is a string."""
    return (spark.read.option("header", True).option("delimiter", delimiter)
            .option("inferSchema", False).csv(path))


def read_csv_with_source(spark: SparkSession, path: str) -> DataFrame:
    """S4 + the source file of every row (``_metadata.file_path``), for P8."""
    return read_csv_text(spark, path).withColumn("_source_path", F.col("_metadata.file_path"))


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    """A StructType from its JSON document (one small file read as whole text)."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return T.StructType.fromJson(json.loads(text))


def is_empty(df: DataFrame) -> bool:
    """Emptiness probe (stops at the first row)."""
    return df.isEmpty()
