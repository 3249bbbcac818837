"""Intermediate tables in the folder that driver and executors share.

The folder is the one the session names in ``spark.checkpoint.dir``.  Only a
local session may do without: it gets a temporary folder.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="revlens-shared-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder there and read it back: later passes read
    the same rows, whatever becomes of the executors that made them."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def freed(*frames: DataFrame) -> None:
    """Delete written tables that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settled(spark: SparkSession) -> None:
    """Let go of the shuffle files and broadcasts of finished steps.  Spark frees
    them when the driver collects its garbage, which a long job of small plans
    rarely does by itself."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
