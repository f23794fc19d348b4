"""Tables written on the way, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, deleted when the session's JVM ends. Only where that is unset and Spark runs in
    one process does a temporary folder stand in for it."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        app, master = spark.sparkContext.applicationId, spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _local.get(app) or _local.setdefault(app, tempfile.mkdtemp(prefix="loomtext-"))
    path = f"{root.rstrip('/')}/loomtext/{label}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` written and read again: what follows doesn't compute it anew, and a lost executor costs a re-read."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
