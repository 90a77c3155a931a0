"""Tables written once and read back, in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application below ``spark.checkpoint.dir``.

    Only a local session may leave that unset: there all tasks share the machine, and a temporary
    folder will do. On a cluster each executor would write to its own disk.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="tallyframe-")
        base = _local_folders[app]
    return f"{base.rstrip('/')}/tallyframe-{app}"


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for the data of one call."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write the frame and read it back: later passes scan pruned columns of a durable table
    instead of repeating its parse or join, whatever executors are lost meanwhile."""
    df.write.mode("overwrite").parquet(path)
    # A given schema saves the footer read of inference.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def release(spark: SparkSession, path: str) -> None:
    """Delete a staged folder; frames that read it can no longer be used."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
