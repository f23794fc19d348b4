"""Tables written once to the folder all executors share, and joins that survive hot keys.

A staged table cuts lineage: what follows reads Parquet from the shared folder, so a lost
executor costs a re-read and not a recomputation. The folder is the session's
``spark.checkpoint.dir``. Only where that is unset *and* Spark runs in one process does a
temporary folder stand in for it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}
_open_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local one only for one-process Spark."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _local_dirs[app] = tempfile.mkdtemp(prefix="loomtext-")
    return _local_dirs[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_dir(spark)}/loomtext/{label}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    for scope in _open_scopes:
        scope.append(path)
    return path


def stage(df: DataFrame, label: str, file_rows: int = 0) -> DataFrame:
    """Writes ``df`` to the shared folder and returns the written table. ``file_rows`` is for rows of many megabytes: writers hold a
    hundred rows, and readers a file's, so a file gets no more than these."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", "zstd").option("maxRecordsPerFile", file_rows).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Deletes staged tables that nothing will read again."""
    for path in paths:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, with as many underscores after it as it takes to be none of ``taken`` (case aside)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def smallest_hashes(df: DataFrame, rows: int, h: str = "h") -> DataFrame:
    """About ``rows`` rows of ``df``, those with the smallest values of the hash column (all where there are no more): by a
    threshold, so that no task ranks anything and no more rows than these leave the tasks."""
    n = df.count()
    return df if n <= rows else df.filter(F.col(h) / F.lit(float(1 << 64)) + 0.5 <= rows / n)


class scope:
    """Collects in ``paths`` what is staged inside the ``with`` block."""

    def __enter__(self) -> "scope":
        self.paths: list[str] = []
        _open_scopes.append(self.paths)
        return self

    def __exit__(self, *exc) -> None:
        _open_scopes[:] = [s for s in _open_scopes if s is not self.paths]


#: At most this many keys can each hold at least 1/HOT_KEYS of all rows, so a table of them is safe to broadcast.
HOT_KEYS = 512


def join_counted(left: DataFrame, right: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of ``left`` with ``right`` (one row per key, ``count`` = its rows in ``left``).

    Keys that hold at least 1/512 of all rows are at most 512 in number: they are broadcast, so
    no task gathers a hot key. The rest is an ordinary shuffle join. Both inputs should be staged.
    Null keys match nothing.
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    least = max(2, -(-total // HOT_KEYS))
    hot, cold = right.filter(F.col(count) >= least), right.filter(F.col(count) < least)
    if hot.isEmpty():
        return left.join(cold, key)
    hot = F.broadcast(hot)
    return left.join(hot, key).unionByName(left.join(hot.select(key), key, "left_anti").join(cold, key))
