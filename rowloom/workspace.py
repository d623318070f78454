"""The folder all executors share, for checkpoints and written intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_CLEARED_AT_EXIT: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for a local session that names none."""
    configured = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]  # Spark adds a unique folder below the one that was set
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="rowloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_root(spark: SparkSession) -> str:
    """The folder below the shared one that belongs to this application alone."""
    return f"{shared_dir(spark)}/rowloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder. It lasts as long as the application's process."""
    root = scratch_root(spark)
    if root not in _CLEARED_AT_EXIT:
        _CLEARED_AT_EXIT.add(root)
        atexit.register(_delete, spark._jvm, root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote to the shared folder; results that still read it are lost."""
    _delete(spark._jvm, scratch_root(spark))


def _delete(jvm, folder: str) -> None:
    path = jvm.org.apache.hadoop.fs.Path(folder)
    try:
        path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except (Py4JError, OSError):  # the JVM may be gone at exit
        pass


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, so that several uses do not recompute it.

    This runs a job. The files belong to the application and go when its process ends, or with
    ``clear_scratch``.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
