"""Session helpers.

Library functions never create a session themselves; they take the caller's
DataFrames.  These helpers exist for tests, bench and the driver entry.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for correctness of the library, not for performance:
# UTC session time (timestamps are compared with an external oracle) and AQE on.
_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tablewatch") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in _DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TABLEWATCH_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder; it is read from
    the session and never overridden.  Only when it is unset (local tests) a
    scratch folder is made; on any other master an unset folder is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:                      # a remote (Connect) session: the server owns the folder
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tablewatch-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def _sql_literal(v, dtype) -> str:
    import datetime as _dt
    import math
    t = dtype.simpleString()
    if v is None:
        return f"CAST(NULL AS {t})"
    if isinstance(v, bool):
        return f"CAST({'true' if v else 'false'} AS {t})"
    if isinstance(v, float) and (math.isnan(v) or math.isinf(v)):
        return f"CAST('{v}' AS {t})"
    if isinstance(v, (int, float)):
        return f"CAST({v!r} AS {t})"
    if isinstance(v, (_dt.datetime, _dt.date)):
        return f"CAST('{v.isoformat(sep=' ') if isinstance(v, _dt.datetime) else v.isoformat()}' AS {t})"
    text = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"CAST('{text}' AS {t})"


def local_frame(spark: SparkSession, rows, schema):
    """A small frame built from driver-side values (bounded metadata: profile rows,
    analyzer lists) as literals in the plan: one partition, no RDD of Python rows,
    one call to build whatever the number of cells."""
    from pyspark.sql import types as T
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if not rows:
        return spark.createDataFrame([], schema)
    structs = []
    for r in rows:
        vals = [r[f.name] for f in schema.fields] if isinstance(r, dict) else list(r)
        parts = ", ".join(f"'{f.name}', {_sql_literal(v, f.dataType)}" for v, f in zip(vals, schema.fields))
        structs.append(f"named_struct({parts})")
    return spark.range(0, 1, 1, 1).selectExpr(f"inline(array({', '.join(structs)}))")
