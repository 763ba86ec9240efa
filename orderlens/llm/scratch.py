"""Intermediate tables in the folder that the cluster shares.

``materialise`` writes a DataFrame once as Parquet and returns the table
read back: later steps neither recompute it nor depend on an executor that
may be lost.  The folder is ``spark.checkpoint.dir``; only a local master,
as in tests, gets a temporary folder of its own where that is unset.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    conf = spark.sparkContext.getConf()
    shared = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not shared:
        if not (spark.sparkContext.master or "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _local_root:
            _local_root[app] = tempfile.mkdtemp(prefix="orderlens-llm-")
        shared = _local_root[app]
    return f"{shared.rstrip('/')}/orderlens-llm-{app}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


#: Shuffle files go when the write that needed them has ended, not when the driver collects garbage.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write(df: DataFrame, path: str, **options: object) -> None:
    """Write ``df`` as Parquet; options by name, dots as two underscores."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.options(**{k.replace("__", "."): v for k, v in options.items()}).parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the table."""
    path = new_path(df.sparkSession, name)
    write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
