"""Structured Streaming over arriving documents: words are matched against static lookups, counted in windows.

Matching joins the stream with static tables and keeps no state. Windows close a ``delay`` after the latest
time seen; later rows are dropped, as the watermark says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.operators import match, tokens


def arriving(spark: SparkSession, path: str, schema: str, per_trigger: int = 100) -> DataFrame:
    """A stream of the Parquet files that appear below ``path``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def matched(docs: DataFrame, keys: list[str], stopwords: DataFrame, authority: DataFrame, primary: DataFrame, master: DataFrame, normalise=F.lower) -> DataFrame:
    """Every word of every document with its match."""
    words = tokens.words_of(docs, keys).withColumn("norm", normalise(F.col("surface")))
    return match.match_types(words, stopwords, authority, primary, master, each=True)


def tier_windows(found: DataFrame, time: str, width: str, delay: str, slide: str | None = None) -> DataFrame:
    """(start, end, match_tier, n): words per tier in windows of ``width`` (moved by ``slide``) of column ``time``."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    counts = found.withWatermark(time, delay).groupBy(window.alias("w"), "match_tier").agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "match_tier", "n")


def write(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Starts writing a stream as Parquet, exactly once by its checkpoint; all that is there is taken, then it stops."""
    return df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").start(path)
