"""Lines that many documents share, by levelled sorted runs of line hashes.

A run is a bucketed table in the shared folder: one row per line key (two 64-bit hashes) with the number of documents
that hold it, dealt out and sorted by the hashes, so that runs meet each other bucket by bucket without a shuffle. The
corpus comes in batches. A batch's keys, counted within it, are merge-anti-joined with the settled runs (keys already
known to be common need no more counting), and the rest is added as a new run of level 0. Whenever a level has
``fan_in`` runs they are merged into one of the next level, counts summed; keys that reach the threshold there leave
for a settled run. At the end all levels are merged, and the settled keys are the common lines.

A line counts once a document (its first place in it), before anything is shuffled; the most frequent keys meet their
lines by a broadcast of at most 512 of them, so a line that a third of all documents hold is never gathered in a task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm.digest_merge import ascii_lower
from loomtext.llm.staging import delete, join_counted, new_path, stage

#: What is stripped from both ends of a line.
BLANKS = " \t\n\v\f\r"
KEY = ["h", "h2"]


def line_keys(text: Column) -> Column:
    """The lines of a text, stripped and with A-Z lower-cased."""
    return F.transform(F.split(text, "\n"), lambda line: ascii_lower(F.btrim(line, F.lit(BLANKS))))


def _hashed(keys: Column, min_chars: int) -> Column:
    """array<struct<h, h2, pos, first>> of the keys long enough, in the order of their hashes; first: the key's first place in the array."""
    spots = F.transform(keys, lambda k, i: F.struct(F.xxhash64(k).alias("h"), F.xxhash64(F.lit(1), k).alias("h2"), i.alias("pos"), (F.char_length(k) >= min_chars).alias("long")))
    spots = F.sort_array(F.filter(spots, lambda x: x["long"]))

    def mark(s: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            before = F.get(s, i - 1)
            return F.struct(x["h"].alias("h"), x["h2"].alias("h2"), x["pos"].alias("pos"), ((i == 0) | (before["h"] != x["h"]) | (before["h2"] != x["h2"])).alias("first"))

        return F.transform(s, one)

    return F.transform(F.array(spots), mark)[0]  # bound once: nothing is sorted again for each of its places


class LineRuns:
    """Levels of sorted runs (h, h2, n): how many documents hold a line, for all lines of the batches added so far."""

    def __init__(self, spark: SparkSession, min_docs: int, fan_in: int = 2) -> None:
        self.spark, self.min_docs, self.fan_in = spark, min_docs, fan_in
        # as many as a shuffle has partitions, so that what is counted is dealt out as the buckets are
        self.buckets = min(int(spark.conf.get(f"spark.sql.{name}")) for name in ("shuffle.partitions", "sources.bucketing.maxBuckets"))
        self.levels: list[list[str]] = [[]]
        self.settled: list[str] = []
        self.paths: dict[str, str] = {}

    def _write(self, rows: DataFrame) -> str:
        name, path = f"loomtext_run_{uuid.uuid4().hex}", new_path(self.spark, "line-run")
        rows.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).option("compression", "zstd").saveAsTable(name)
        self.paths[name] = path
        return name

    def _drop(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete(self.spark, [self.paths.pop(name)])

    def _merged(self, names: list[str]) -> DataFrame:
        """The rows of several runs, counts of a key summed: full joins of buckets that lie side by side."""
        out = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).select(*KEY, F.col("n").alias("more"))
            out = out.hint("merge").join(other, KEY, "full").select(*KEY, (F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n"))
        return out

    def add(self, lines: DataFrame) -> None:
        """Adds a batch: (h, h2) of each line of its documents, a key at most once a document."""
        rows = lines.groupBy(*KEY).agg(F.count("*").alias("n"))
        for name in self.settled:  # spelt as outer joins: Spark moves an anti join below the counting, where a hot line's rows are still apart
            rows = rows.join(self.spark.table(name).select(*KEY, F.lit(True).alias("settled")).hint("merge"), KEY, "left").filter("settled IS NULL").drop("settled")
        self.levels[0].append(self._write(rows))
        self._compact()

    def _compact(self) -> None:
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fan_in:
                self._merge_level(level)

    def _merge_level(self, level: int) -> None:
        names = self.levels[level]
        merged = stage(self._merged(names), "merged-runs")
        self.settled.append(self._write(merged.filter(F.col("n") >= self.min_docs)))
        if len(self.levels) == level + 1:
            self.levels.append([])
        self.levels[level + 1].append(self._write(merged.filter(F.col("n") < self.min_docs)))
        self.levels[level] = []
        self._drop(names)

    def common(self) -> DataFrame:
        """(h, h2, n) of the keys in ``min_docs`` documents or more, n as counted when the key was settled; reads all runs."""
        left = [name for names in self.levels for name in names]
        out = self._merged(left).filter(F.col("n") >= self.min_docs) if left else self.spark.createDataFrame([], "h long, h2 long, n long")
        for name in self.settled:
            out = out.unionByName(self.spark.table(name))
        return out

    def close(self) -> None:
        self._drop(list(self.paths))


def without_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fan_in: int = 2) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) per row of ``docs`` (doc_id, text).

    A line's key is the line stripped of blanks at both ends, A-Z lower-cased. Keys of at least ``min_chars`` code
    points that ``min_docs`` documents or more hold lose all their lines in every document; the others stay as they are,
    joined by line ends. Every row is a document of its own, also where ids or texts repeat or an id is null. A null or empty text is
    one empty line, which always stays. Texts of any length are read whole. A text that loses every line is empty. An
    empty table gives an empty one; columns other than doc_id and text, whatever their names, are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    rows = stage(docs.select("doc_id", text.alias("text"), F.monotonically_increasing_id().alias("row")), "line-texts")
    batch = F.shiftright("row", 33) % batches  # the number of the row's partition is above these bits
    lines = rows.select("row", batch.cast("int").alias("batch"), F.inline(_hashed(line_keys(F.col("text")), min_chars)))
    path = new_path(spark, "line-keys")
    lines.write.partitionBy("batch").option("compression", "zstd").parquet(path)
    lines = spark.read.schema(lines.schema).parquet(path)
    runs = LineRuns(spark, min_docs, fan_in)
    try:
        for b in range(batches):
            runs.add(lines.filter((F.col("batch") == b) & F.col("first")).select(*KEY))
        common = stage(runs.common(), "common-lines")
    finally:
        runs.close()
    hits = join_counted(lines.select("row", "pos", *KEY), common, KEY, "n")
    cuts = stage(hits.groupBy("row").agg(F.sort_array(F.collect_list("pos")).alias("cuts")), "line-cuts")

    def spared(lines: Column) -> Column:
        """The lines between the cuts."""
        ends = F.concat("cuts", F.array(F.size(lines)))
        return F.array_join(F.flatten(F.zip_with(F.concat(F.array(F.lit(-1)), "cuts"), ends, lambda a, b: F.slice(lines, a + 2, b - a - 1))), "\n")

    # a merge join at every size: the texts are shuffled once, whether the cuts would fit a broadcast or not
    out = rows.join(cuts.hint("merge"), "row", "left")
    kept = F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.transform(F.array(F.split("text", "\n")), spared)[0])
    return out.select(
        "doc_id",
        F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.size("cuts"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept_text"),
    )
