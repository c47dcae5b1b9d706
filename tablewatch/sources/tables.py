"""Tables by name or by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables (``{sf_dir}/{name}.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name."""
    return spark.table(name)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """S3: a lake table by path; ``fmt`` may name any installed format."""
    reader = spark.read.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)
