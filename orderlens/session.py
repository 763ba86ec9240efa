"""Session construction and shared-storage helpers.

Library code never invents a machine-local folder on a cluster: the
checkpoint folder is read from the session (``spark.checkpoint.dir`` or
``SparkContext.setCheckpointDir``).  Only a ``local[...]`` session with no
folder configured gets a fresh temporary one, which is what tests use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Defaults for what the submitted configuration leaves open; all are standard Spark options.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
LOCAL_CONF = {"spark.driver.memory": "16g", "spark.sql.shuffle.partitions": "8"}


def build_session(master: str | None = None, app_name: str = "orderlens",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or get) a session.  A submitted master and submitted settings are kept; the
    defaults fill what is not set, and ``extra`` is what the caller insists on.  Without any
    master the session is ``local[8]``."""
    submitted = SparkConf()
    chosen = master or submitted.get("spark.master", None)
    if chosen is None and "PYSPARK_GATEWAY_PORT" not in os.environ:
        chosen = "local[8]"
    conf = dict(DEFAULT_CONF)
    if chosen and chosen.split("[")[0] == "local":
        conf.update(LOCAL_CONF)
    conf = {k: v for k, v in conf.items() if not submitted.contains(k)} | (extra or {})
    builder = SparkSession.builder.appName(app_name)
    if chosen:
        builder = builder.master(chosen)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    Reads the context's checkpoint dir / ``spark.checkpoint.dir``.  When neither is set
    a ``local[...]`` session gets a fresh temp folder (tests); on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if sc.master.split("[")[0] != "local":
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "(the engine cuts lineage there and never uses local temp dirs)")
        conf_dir = tempfile.mkdtemp(prefix="orderlens-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the session's file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


class Scratch:
    """The intermediate tables of one run, in one shared folder that goes when the run ends::

        with Scratch(spark) as scratch:
            rows = scratch.pin(df, "rows")
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = scratch_path(spark, "run")

    def pin(self, df: DataFrame, name: str = "pinned") -> DataFrame:
        """Cut lineage: write the rows once as Parquet and read them back, so that a lost
        executor cannot change values that depend on partition positions."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        delete_path(self.spark, self.folder)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc: object) -> None:
        self.close()
