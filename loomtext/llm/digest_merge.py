"""Exact duplicates by a tree merge of digest runs, as aggregation in stages.

Every partition's rows form a run: one entry per digest with its size and the identifier to
retain, folded on the map side first. Runs then meet in rounds: in each, ``fan_in``
neighbouring runs become one, entries of one digest folded and the better identifier kept, until one run is left. A run's number is
a key beside the digest, and Spark's aggregation sorts or hashes inside its exchange: nothing but that orders or merges a run.
Runs are dealt out by digest, so no round gathers a run, or a hot group, in one task: a group is never more than one entry per run.

An entry counts as the same text only if SHA-256, length and a second hash all agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.llm.staging import free_name, join_counted, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SAME = ["digest", "check", "size"]


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def digest_rows(docs: DataFrame) -> DataFrame:
    """One light row per row of ``docs``: doc_id, the row's own number, its run, and what identifies its text."""
    rows = docs.select("doc_id", ascii_lower(F.col("text")).alias("t"))
    return rows.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("run"),
        F.unhex(F.sha2("t", 256)).alias("digest"),
        F.xxhash64("t").alias("check"),
        F.octet_length("t").alias("size"),
    )


def merge_runs(rows: DataFrame, fan_in: int = 16, keep: str = "largest") -> DataFrame:
    """(digest, check, size, best struct(doc_id, row), n long): the one run left after all rounds."""
    best = {"largest": F.max, "smallest": F.min}[keep]
    runs = rows.groupBy("run", *SAME).agg(best(F.struct("doc_id", "row")).alias("best"), F.count("*").alias("n"))
    left = (rows.agg(F.max("run")).first()[0] or 0) + 1
    while True:
        left = -(-left // fan_in)
        runs = runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        runs = runs.groupBy("run", *SAME).agg(best("best").alias("best"), F.sum("n").alias("n"))
        if left <= 1:
            return runs.drop("run")


def exact_duplicates(docs: DataFrame, fan_in: int = 16, keep: str = "largest") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs`` (doc_id, text).

    Texts are equal when identical after lower-casing A-Z; null counts as empty, an empty text is a
    text. Of equal texts the largest (or smallest) doc_id is kept; among rows that repeat that id,
    exactly one is. A null id is smaller than any other. An empty table gives an empty one. Texts of any length are
    read whole; columns other than doc_id and text, whatever their names, are not read.
    """
    rows = stage(digest_rows(docs), "digests")
    groups = stage(merge_runs(rows, fan_in, keep), "merged-run")
    return join_counted(rows, groups, SAME, "n").select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def distinct_documents(docs: DataFrame, fan_in: int = 16, keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, all columns as they are.

    Texts move only where the list of dropped ids is too long to broadcast. Ids that repeat with
    kept and dropped rows, and null ids, take a second path that looks at single rows. Null and empty texts
    are equal, long ones are read whole; names that are used inside are chosen free of clashes. An empty table gives an empty one.
    """
    id_, sha_, nth_, keep_ = (free_name(n, docs.columns) for n in ("__id", "__sha", "__nth", "__keep"))
    marks = stage(exact_duplicates(docs, fan_in, keep), "exact-marks")
    ids = marks.groupBy(F.col("doc_id").alias(id_)).agg(F.count_if("kept").alias("__kept"), F.count("*").alias("__all"))
    ids = stage(ids.filter("__kept < __all"), "ids-with-dropped-rows")
    mixed = ids.filter((F.col("__kept") > 0) | F.col(id_).isNull())
    kept = docs.join(ids.select(id_), F.col("doc_id").eqNullSafe(F.col(id_)), "left_anti")
    if mixed.isEmpty():
        return kept
    rows = docs.join(mixed.select(id_), F.col("doc_id").eqNullSafe(F.col(id_)), "left_semi")
    rows = rows.withColumn(sha_, F.sha2(ascii_lower(F.col("text")), 256))
    rows = rows.withColumn(nth_, F.row_number().over(Window.partitionBy("doc_id", sha_).orderBy("text")))
    stay = marks.filter("kept").select(F.col("doc_id").alias(id_), F.col("text_sha256").alias(keep_)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(sha_) == F.col(keep_))
    rows = rows.filter(f"{nth_} = 1").join(stay, same, "left_semi").drop(sha_, nth_)
    return kept.unionByName(rows)
