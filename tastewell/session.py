"""Session settings the jobs depend on: the shared folder and tables written to it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session that names none gets a folder made here; on a cluster each machine would
    write to its own disk and later reads would see part of the rows.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        if not is_local(spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="tastewell-")
        spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder.rstrip("/")


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def enable_checkpoints(spark: SparkSession) -> None:
    """Let iterative training cut its lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tastewell-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, grouped by application and removed when that ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def discard_scratch(spark: SparkSession) -> None:
    """Remove what this application wrote to the shared folder.

    For the end of a job: frames made by ``written`` cannot be read any more.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Used where several consumers need one result: it is computed once, survives the loss
    of executors, and Spark then knows its size when it picks a join strategy.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
