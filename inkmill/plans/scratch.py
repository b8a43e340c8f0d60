"""Scratch tables that cut a plan's lineage, in the folder every executor sees."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where a local session names none, a private folder. Any other session has to name one."""
    known = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = getattr(spark.sparkContext, "_inkmill_scratch", None)
    if own is None:
        own = spark.sparkContext._inkmill_scratch = tempfile.mkdtemp(prefix="inkmill-")
    return own


def _delete(spark: SparkSession, path: str) -> None:
    try:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001  the session may be gone at exit
        return


def on_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder when Python ends."""
    atexit.register(_delete, spark, path)


def saved(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the shared folder: written once, survives lost executors, dropped when Python ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/inkmill-{uuid.uuid4().hex}"
    df.write.parquet(path)
    on_exit(spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._inkmill_path = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Delete saved tables that nothing reads any more."""
    for df in frames:
        if path := getattr(df, "_inkmill_path", None):
            _delete(df.sparkSession, path)
