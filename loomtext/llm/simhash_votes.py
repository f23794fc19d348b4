"""Document fingerprints: SimHash by signed votes of weighted term hashes, and block-table search.

Terms are pairs of neighbouring words. A term's hash votes on 64 bits with the term's weight (its
length, at most 63, a stand-in for rarity that needs no corpus pass). Votes are
counted two bits to a long, so one aggregation of 32 sums counts all; a text may hold 2^25 terms.
Everything is DataFrame expressions.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.llm.staging import join_counted, stage

LANES = 32
LANE_MASK = (1 << 32) | 1


def term_votes(text: str) -> Column:
    """Array of longs, one per distinct term of string column ``text``: the term's hash with its weight in the
    lowest six bits. A single word is a term of its own. Repeated lines so cannot outvote the rest."""
    words = f"filter(split({text}, '\\\\s+'), x -> x <> '')"
    pairs = "zip_with(if(size(ws) > 1, slice(ws, 1, size(ws) - 1), ws), slice(ws, 2, greatest(size(ws) - 1, 0)), (x, y) -> (xxhash64(x, y) & -64L) | least(length(x) + coalesce(length(y), 0), 63))"
    return F.expr(f"array_distinct(transform(array({words}), ws -> {pairs})[0])")


def vote_sums() -> list[Column]:
    return [
        F.sum(F.expr(f"(shiftrightunsigned(h, {k}) & {LANE_MASK}L) * w")).alias(f"s{k}") for k in range(LANES)
    ] + [F.sum("w").alias("w")]


def bits_of_sums() -> Column:
    """The fingerprint: a bit is 1 if more than half of the weight voted for it; no term gives 0."""
    low = [f"if((s{k} & 4294967295L) * 2 > w, {1 << k}L, 0L)" for k in range(LANES)]
    high = [f"if(shiftrightunsigned(s{k}, 32) * 2 > w, shiftleft(1L, {k + 32}), 0L)" for k in range(LANES)]
    return F.coalesce(F.expr(" | ".join(low + high)), F.lit(0).cast("long"))


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` and fp (64 bits as a long) for each distinct value of ``keys``; null texts count as empty."""
    votes = texts.select(*keys, F.explode_outer(term_votes(f"coalesce({text}, '')")).alias("v"))
    votes = votes.select(*keys, F.xxhash64("v").alias("h"), F.expr("v & 63").alias("w"))
    return votes.groupBy(*keys).agg(*vote_sums()).select(*keys, bits_of_sums().alias("fp"))


def likeness(a: str, b: str) -> Column:
    """Cosine that the share of differing bits stands for, 0 where it would be negative."""
    return F.expr(f"if({a} is null or {b} is null, null, greatest(0D, cos(pi() * bit_count({a} ^ {b}) / 64)))")


def _tables(radius: int, blocks: int) -> list[list[tuple[int, int]]]:
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    spans = [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [list(c) for c in combinations(spans, blocks - radius)]


def _met(queries: DataFrame, index: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(q, the columns of ``index``): every pair of distinct q of ``queries`` (fp) and row of ``index`` (fp, distinct, …) at most ``radius`` bits apart, once.

    One table per choice of ``blocks - radius`` blocks, keyed by their bits moved to the front: two fingerprints so near agree on all bits
    of at least one table's key, so none is missed; a pair counts in the first table where it agrees, so none has to be told from its
    repeats and no list of pairs is kept.
    """
    if not 0 <= radius < blocks <= 64:
        raise ValueError("0 <= radius < blocks <= 64 is needed")
    keys, masks = [], []
    for k, spans in enumerate(_tables(radius, blocks)):
        key, used, mask = F.lit(0).cast("long"), 0, 0
        for off, width in spans:
            part = F.shiftrightunsigned("fp", off).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))
            key = F.shiftleft(key, width).bitwiseOR(part) if used else part
            used += width
            mask |= ((1 << width) - 1) << off
        keys.append(F.struct(F.lit(k).alias("t"), key.alias("k")))
        masks.append(F.lit(mask - (1 << 64) if mask >> 63 else mask))
    keyed = lambda df: df.select("*", F.explode(F.array(*keys)).alias("x")).select("x.t", "x.k", *df.columns)
    asked = queries.select("fp").na.drop().distinct()
    near = keyed(asked).withColumnRenamed("fp", "q").join(keyed(index.filter("fp is not null")).hint("merge"), ["t", "k"])  # at every size: neither side is broadcast
    differ = F.col("q").bitwiseXOR(F.col("fp"))
    first = F.array_position(F.transform(F.array(*masks), lambda m: differ.bitwiseAND(m) == 0), True) - 1
    return near.filter((F.bit_count(differ) <= radius) & (first == F.col("t"))).select("q", *index.columns)


def within_radius(queries: DataFrame, index: DataFrame, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(q, fp): every pair of distinct fingerprints q of ``queries`` and fp of ``index`` (column fp
    each) at most ``radius`` bits apart, q itself included if it is in the index.

    Repeats and nulls are dropped first; copies therefore never multiply. The pairs of a dense cluster grow with its square: whoever
    needs their number only takes ``counted_within``.
    """
    return _met(queries, index.select("fp").distinct(), radius, blocks)


def counted_within(prints: DataFrame, asked: Column, radius: int = 3, blocks: int = 6) -> DataFrame:
    """``prints`` (doc_id, fp, …; staged) with near_docs, the number of its rows whose fingerprint is at most ``radius`` bits
    from the row's own (itself included), and near_low, their smallest doc_id; both null where not ``asked``.

    Searched by the block tables, over distinct fingerprints: copies count by their number and never meet in pairs, and pairs are summed
    where they are met.
    """
    groups = prints.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n"), F.count_if(asked).alias("asked"))
    groups = stage(groups, "distinct-fingerprints")
    hits = _met(groups.filter("asked > 0"), groups.select("fp", "low", "n"), radius, blocks)
    found = hits.groupBy("q").agg(F.sum("n").alias("near_docs"), F.min("low").alias("near_low"))  # summed where the pairs are met
    found = found.withColumnRenamed("q", "fp").join(groups.select("fp", "asked").hint("merge"), "fp")
    found = stage(found, "within-radius")
    rest = prints.filter(~F.coalesce(asked, F.lit(False)))
    told = join_counted(prints.filter(asked), found, "fp", "asked").select(*prints.columns, "near_docs", "near_low")
    return told.unionByName(rest.withColumns({"near_docs": F.lit(None).cast("long"), "near_low": F.lit(None).cast(prints.schema["doc_id"].dataType)}))


def neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, next_id, prev_id, prev_n) for each distinct non-null doc_id: the next larger id (after the
    last: the first), the next smaller one, and the longest text length of the latter."""
    sizes = docs.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.char_length(F.coalesce("text", F.lit("")))).alias("n"))
    ranged = stage(sizes, "sizes").repartitionByRange("doc_id").withColumn("part", F.spark_partition_id())
    ranged = stage(ranged, "ranged-ids")
    ends = ranged.groupBy("part").agg(F.min("doc_id").alias("first"), F.max(F.struct("doc_id", "n")).alias("last"))
    ends = sorted(ends.collect())  # one row per range partition
    links = [
        (e.part, ends[(i + 1) % len(ends)].first, ends[i - 1].last.doc_id, ends[i - 1].last.n) for i, e in enumerate(ends)
    ]
    kind = docs.schema["doc_id"].dataType.simpleString()
    ring = docs.sparkSession.createDataFrame(links, f"part int, after {kind}, before {kind}, before_n int")
    w = Window.partitionBy("part").orderBy("doc_id")
    return ranged.join(F.broadcast(ring), "part").select(
        "doc_id",
        F.coalesce(F.lead("doc_id").over(w), "after").alias("next_id"),
        F.coalesce(F.lag("doc_id").over(w), "before").alias("prev_id"),
        F.coalesce(F.lag("n").over(w), "before_n").alias("prev_n"),
    )


def _both_prints(rows: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fp, edited_fp) per row of (doc_id, text, head)."""
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    rows = rows.select(
        "doc_id", "n_chars", "text",
        F.expr("concat(left(text, cast(n_chars - n_chars div 4 as int)), left(coalesce(head, ''), cast(n_chars div 4 as int)))").alias("edited"),
    )
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("edited_sha256", F.sha2("edited", 256))
    sides = rows.select(
        "doc_id", "row", "n_chars", "edited_sha256",
        F.explode(F.expr("array(struct(0 as side, text as t), struct(1 as side, edited as t))")).alias("x"),
    ).select("doc_id", "row", "n_chars", "edited_sha256", "x.side", "x.t")
    # doc_id leads the grouping keys, so the join's partitioning serves the votes too
    prints = fingerprints(sides, ["doc_id", "row", "n_chars", "edited_sha256", "side"], "t")
    prints = prints.groupBy("doc_id", "row", "n_chars", "edited_sha256").agg(
        F.max(F.when(F.col("side") == 0, F.col("fp"))).alias("fp"), F.max(F.when(F.col("side") == 1, F.col("fp"))).alias("edited_fp")
    )
    return prints.drop("row")


def edited_likeness(docs: DataFrame, asked: Column | None = None, radius: int = 3) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_chars, edited_sha256, fp, edited_fp, near_edited, near_next, and near_docs and
    near_low as in ``counted_within`` for the rows that are ``asked`` (a condition on doc_id; by default none).

    The edited text is the text with its last quarter (floor) of code points replaced by the first
    as many of the next document, in order of doc_id, the first following the last. Null texts
    count as empty. Of rows that repeat an id, edits use the smallest head and near_next compares with
    the smallest fingerprint. A row without id has no next: its tail is cut off, near_next is null. Texts without
    white space are one term. Long texts are read whole; equal texts have equal fingerprints; an empty table gives an
    empty one; columns other than doc_id and text, whatever their names, are not read.
    """
    order = stage(neighbours(docs), "id-ring")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # both joins are merge joins at every size and shuffle the same rows, so the texts' exchange is made once and reused
    known = docs.filter("doc_id is not null")
    heads = known.join(order.hint("merge"), "doc_id").select(F.col("prev_id").alias("head_of"), F.expr("left(text, prev_n div 4)").alias("head"))
    heads = heads.groupBy("head_of").agg(F.min("head").alias("head"))
    rows = known.join(heads.hint("merge"), F.col("doc_id") == F.col("head_of"), "left").drop("head_of")
    lost = docs.filter("doc_id is null").withColumn("head", F.lit(None).cast("string"))
    prints = stage(_both_prints(rows).unionByName(_both_prints(lost)), "fingerprints")
    near = counted_within(prints, F.lit(False) if asked is None else asked, radius)
    after = prints.groupBy("doc_id").agg(F.min("fp").alias("next_fp")).join(order.select(F.col("doc_id"), "prev_id"), "doc_id")
    after = after.select(F.col("prev_id").alias("before_id"), "next_fp")
    out = near.join(after, F.col("doc_id") == F.col("before_id"), "left")
    return out.select(
        "doc_id", "n_chars", "edited_sha256", "fp", "edited_fp",
        likeness("fp", "edited_fp").alias("near_edited"), likeness("fp", "next_fp").alias("near_next"),
        "near_docs", "near_low",
    )
