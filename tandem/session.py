"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "tandem", **conf: str) -> SparkSession:
    """A session with the settings the jobs count on: UTC, adaptive execution with skew handling.

    Master, memory and shuffle partitions are left to the cluster (``spark-submit``).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # The landing writes two folders per task; both stay open, so its rows need no sort.
        .config("spark.sql.maxConcurrentOutputFileWriters", "8")
        # Call sites in error messages cost several round trips per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, which all executors can read and write.

    Where it is unset, a local session gets a folder of its own; on a cluster that would be one machine's,
    so there it is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tandem-"))
    return context.getCheckpointDir()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark)}/tandem-{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, in a folder for each value of ``by`` if given, and read it back.

    Used where several jobs read one result: it cuts the lineage, and a lost executor costs no recompute.
    """
    path = work_folder(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
