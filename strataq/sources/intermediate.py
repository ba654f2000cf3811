"""Folders that all executors share, and tables written there on the way."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder where all executors write, gone when the driver ends; of this machine only where a local session names none."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not hasattr(shared_folder, "own"):
            shared_folder.own = tempfile.mkdtemp(prefix="strataq-")
            atexit.register(shutil.rmtree, shared_folder.own, True)
        base = shared_folder.own
    path = f"{base.rstrip('/')}/strataq/{uuid.uuid4().hex}"
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(jvm_path)
    fs.deleteOnExit(jvm_path)
    return path


def written(df: DataFrame) -> DataFrame:
    """`df` as a table in a shared folder, read again: what comes after doesn't make it anew, and lineage ends there."""
    path = f"{shared_folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
