"""A lake folder written commit by commit.

    data/commit_id=../attempt=../<partitions>    rows
    files/commit_id=../attempt=../               one row per data file: partition, rows, bytes
    commits/                                     one row per finished attempt: operation, extras

The ``commits`` row is written last, and only the latest attempt of a commit that has one is
read.  So a job that dies half-way leaves rows that nobody sees, a rerun of a commit takes the
place of its earlier attempt, and the statistics of a commit read that commit's manifest
alone, however long the history is.  One writer at a time per commit.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMITS = "commit_id string, attempt long, operation string, extra map<string, string>"
FILES = ("partition_path string, file_path string, num_inserts long, num_writes long, num_deletes long, "
         "file_size long, commit_id string, attempt long")
KEYS = ["commit_id", "attempt"]


def commit_name(ts) -> str:
    """The commit of a run time: a rerun for the same time is another attempt of the same commit."""
    return "c" + re.sub(r"[^0-9A-Za-z]", "", str(ts))


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows below ``path``; none where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def commits(spark: SparkSession, lake: str) -> DataFrame:
    """The attempt that counts of every finished commit, with its operation and extras."""
    every = _read(spark, f"{lake.rstrip('/')}/commits", COMMITS)
    return every.groupBy("commit_id").agg(F.max_by(F.struct("attempt", "operation", "extra"), "attempt").alias("c")) \
        .select("commit_id", "c.*")


def commit_files(spark: SparkSession, lake: str, commit_id: str) -> DataFrame:
    """The file rows of one commit, from its own manifest folder."""
    found = commits(spark, lake).where(F.col("commit_id") == commit_id).first()
    schema = T._parse_datatype_string(FILES)
    if found is None:
        return spark.createDataFrame([], schema)
    folder = f"{lake.rstrip('/')}/files/commit_id={commit_id}/attempt={found['attempt']}"
    return _read(spark, folder, T.StructType(schema.fields[:-2])).select(
        "*", F.lit(commit_id).alias("commit_id"), F.lit(found["attempt"]).cast("long").alias("attempt"))


def commit(df: DataFrame, lake: str, commit_id: str, partition_by: tuple[str, ...] = (), operation: str = "insert",
           extra: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as the next attempt of ``commit_id``; returns the rows as written.

    A frame without rows is a commit without files.  ``commit_id`` and ``attempt`` are columns of
    the lake; input columns of those names are an error.
    """
    from ..sources.commits import file_write_stats
    spark, root = df.sparkSession, lake.rstrip("/")
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_-]*", commit_id):
        raise ValueError(f"not a commit id: {commit_id!r}")
    clash = {c.lower() for c in df.columns} & set(KEYS)
    if clash:
        raise ValueError(f"columns {sorted(clash)} belong to the lake")
    last = commits(spark, root).where(F.col("commit_id") == commit_id).first()
    attempt = 0 if last is None else last["attempt"] + 1
    place = f"commit_id={commit_id}/attempt={attempt}"
    # a folder of this number can only be left by an attempt that died, so it is written anew
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{root}/data/{place}")
    file_write_stats(spark, f"{root}/data/{place}", partition_cols=tuple(partition_by), schema=df.schema) \
        .write.mode("overwrite").parquet(f"{root}/files/{place}")
    texts = F.create_map(*[F.lit(x) for item in (extra or {}).items() for x in item]).cast("map<string,string>")
    spark.range(0, 1, 1, 1).select(F.lit(commit_id).alias("commit_id"), F.lit(attempt).cast("long").alias("attempt"),
                                   F.lit(operation).alias("operation"), texts.alias("extra")) \
        .write.mode("append").parquet(f"{root}/commits")
    return spark.read.schema(df.schema).parquet(f"{root}/data/{place}")


def read(spark: SparkSession, lake: str, schema: T.StructType) -> DataFrame:
    """The rows of all finished commits: ``schema`` and the lake's two columns.  The folders of
    dead and replaced attempts are pruned by the join."""
    own = T.StructType(schema.fields + [T.StructField("commit_id", T.StringType()), T.StructField("attempt", T.LongType())])
    rows = _read(spark, f"{lake.rstrip('/')}/data", own)
    return rows.join(commits(spark, lake).select(*KEYS), KEYS, "left_semi").select(*own.names)


def register(spark: SparkSession, lake: str, name: str, schema: T.StructType, partition_by: tuple[str, ...] = ()) -> None:
    """Make the lake known to the catalog: tables ``<name>_files`` (rows of every attempt) and
    ``<name>_commits``, and the view ``name`` with the rows that count.  Called after every commit;
    new folders become partitions of the table."""
    root = lake.rstrip("/")
    plain = [f for f in schema.fields if f.name not in partition_by]
    folders = [("commit_id", "string"), ("attempt", "bigint"), *[(p, schema[p].dataType.simpleString()) for p in partition_by]]
    columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in plain] + [f"`{n}` {t}" for n, t in folders])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name}_files ({columns}) USING parquet "
              f"PARTITIONED BY ({', '.join(f'`{n}`' for n, _ in folders)}) LOCATION '{root}/data'")
    spark.sql(f"MSCK REPAIR TABLE {name}_files")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name}_commits ({COMMITS}) USING parquet LOCATION '{root}/commits'")
    spark.sql(f"REFRESH TABLE {name}_commits")
    shown = ", ".join(f"`{c}`" for c in schema.names)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {shown}, commit_id, attempt FROM {name}_files LEFT SEMI JOIN "
              f"(SELECT commit_id, max(attempt) AS attempt FROM {name}_commits GROUP BY commit_id) c USING (commit_id, attempt)")
