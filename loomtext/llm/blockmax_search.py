"""Ranked lexical search: postings in blocks of variable length with their maxima, searched exactly.

Queries come in blocks of a bounded number of terms, each against all documents. A document's terms are counted inside
its task; those that the block of queries asks for become its postings. Corpus counts (documents, term occurrences,
documents of a term) are sums over all documents. A shard is what one task reads, cut after a number of postings. In it, dynamic programming
sets the block boundaries of every posting list so that the sum of (block maximum - score) over the documents from a block's
first to its last, plus a price a block, is least. The ends of a query's blocks cut the shard's documents into stretches on which
the sum of the maxima is constant: the bound of the weak AND. Stretches are opened by falling bound, and only postings inside them are
read; the search ends when no bound reaches the k-th best score. Shards give at most k rows a query, ranked after one
shuffle that ranks within tasks first.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomtext.llm.held import lean
from loomtext.llm.staging import new_path, stage

#: Terms are runs of digits, A-Z, a-z (lower-cased) and everything beyond ASCII; other bytes part them.
_PARTS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

#: The longest block, in postings, and the price of a block in mean scores of its list.
LONGEST, PRICE = 32, 4
#: Lists whose boundaries are set side by side; stretches that are opened at first, then four times as many each time.
SIDE_BY_SIDE, FIRST_OPEN = 4096, 16


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, in order."""
    return text.translate(_PARTS).split()


def block_ends(docs: np.ndarray, scores: np.ndarray, starts: np.ndarray, longest: int = LONGEST, price: float = PRICE) -> np.ndarray:
    """Positions after each block's last posting, for lists that begin at ``starts`` (the last entry is the end of all).

    The best boundaries for the first j postings of a list are the best for j - l plus one block of l, over all l up to
    ``longest``; all lists advance together, the longer ones first. A document between a block's first and last posting that the
    list doesn't have scores 0 there, so sparse stretches are cut finer.
    """
    sizes = np.diff(starts)
    by_size = np.argsort(-sizes, kind="stable")
    by_size = by_size[sizes[by_size] > 0]
    ends: list[np.ndarray] = []
    for at in range(0, len(by_size), SIDE_BY_SIDE):
        lists = by_size[at : at + SIDE_BY_SIDE]
        n, first = sizes[lists], starts[lists]
        mean = np.array([scores[f : f + m].mean() for f, m in zip(first.tolist(), n.tolist(), strict=True)])
        cost = np.maximum(1.0, price * mean)
        steps = int(n[0])
        alive = np.searchsorted(-n, -np.arange(steps), "left")  # how many lists have a posting at each step
        most = np.zeros((len(lists), longest))  # of the last l scores
        total = np.full((len(lists), longest), 0.0)  # their sum
        head = np.zeros((len(lists), longest))  # the document of the first of them
        best = np.full((len(lists), longest), np.inf)  # the least cost of all before them
        best[:, 0] = 0.0
        took = np.zeros(int(n.sum()), np.int32)
        base = np.concatenate([[0], np.cumsum(n)[:-1]])
        for j in range(steps):
            k = int(alive[j])
            s = scores[first[:k] + j].astype(np.float64)[:, None]
            d = docs[first[:k] + j].astype(np.float64)
            if j:
                for each in (most, total, head):
                    each[:k, 1:] = each[:k, :-1].copy()
                most[:k, 0] = total[:k, 0] = 0
            head[:k, 0] = d
            np.maximum(most[:k], s, out=most[:k])
            total[:k] += s
            all_cost = best[:k] + most[:k] * (d[:, None] + 1 - head[:k]) - total[:k]
            pick = all_cost.argmin(1)
            took[base[:k] + j] = pick + 1
            least = all_cost[np.arange(k), pick] + cost[:k]
            best[:k, 1:] = best[:k, :-1].copy()
            best[:k, 0] = least
        for f, m, b in zip(first.tolist(), n.tolist(), base.tolist(), strict=True):
            mine, cuts, j = took[b : b + m].tolist(), [], m
            while j > 0:
                cuts.append(f + j)
                j -= mine[j - 1]
            ends.append(np.array(cuts[::-1], np.int64))
    return np.sort(np.concatenate(ends)) if ends else np.zeros(0, np.int64)


class Shard:
    """Postings of some documents, by term, with blocks; documents are numbered by ascending id."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, score: np.ndarray, n_terms: int) -> None:
        order = np.lexsort((doc, term))
        self.doc, self.score = doc[order], score[order]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=n_terms))])
        ends = block_ends(self.doc, self.score, self.starts)
        begins = np.concatenate([[0], ends[:-1]])[: len(ends)]
        self.top = np.maximum.reduceat(self.score, begins) if len(ends) else self.score[:0]
        self.first, self.last = self.doc[begins], self.doc[ends - 1]
        self.blocks = np.searchsorted(ends, self.starts, "right")
        self.read = 0  # postings that searches have read

    def search(self, terms: np.ndarray, times: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, documents) of the k best with a score of ``least`` or more, equal scores by document."""
        here = self.starts[terms + 1] > self.starts[terms]
        terms, times = terms[here], times[here]
        found_s, found_d = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(terms):
            return found_s, found_d
        spans = [(self.blocks[t], self.blocks[t + 1]) for t in terms.tolist()]
        first = np.concatenate([self.first[a:b] for a, b in spans])
        past = np.concatenate([self.last[a:b] for a, b in spans]) + 1
        top = np.concatenate([self.top[a:b] * q for (a, b), q in zip(spans, times.tolist(), strict=True)])
        points = np.unique(np.concatenate([first, past]))
        change = np.zeros(len(points), np.int64)
        np.add.at(change, np.searchsorted(points, first), top)
        np.add.at(change, np.searchsorted(points, past), -top)
        bound, since, to = np.cumsum(change)[:-1], points[:-1], points[1:] - 1
        scored = np.zeros(int(to[-1]) + 1, np.int64)
        order, at, some = np.argsort(-bound, kind="stable"), 0, FIRST_OPEN
        while at < len(order) and bound[order[at]] >= max(1, least):
            open_ = order[at : at + some]
            open_ = np.sort(open_[bound[open_] >= max(1, least)])
            gaps = np.flatnonzero(np.diff(open_) != 1)  # neighbours are read as one
            since_, to_ = since[open_[np.concatenate([[0], gaps + 1])]], to[open_[np.concatenate([gaps, [len(open_) - 1]])]]
            docs = []
            for t, q in zip(terms.tolist(), times.tolist(), strict=True):
                a, b = self.starts[t], self.starts[t + 1]
                lo, hi = np.searchsorted(self.doc[a:b], since_), np.searchsorted(self.doc[a:b], to_, "right")
                size = hi - lo
                n = int(size.sum())
                if n:
                    spot = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(n) + a
                    d = self.doc[spot]
                    scored[d] += self.score[spot] * q  # a list has a document once
                    docs.append(d)
                    self.read += n
            if docs:
                d = np.concatenate(docs)
                d = np.unique(d[scored[d] >= max(1, least)])
                found_s, found_d = np.concatenate([found_s, scored[d]]), np.concatenate([found_d, d])
                keep = np.lexsort((found_d, -found_s))[:k]
                found_s, found_d = found_s[keep], found_d[keep]
                if len(found_s) == k:
                    least = max(least, int(found_s[-1]))
            at, some = at + some, some * 4
        return found_s, found_d


def _vectors(docs: DataFrame, wanted) -> DataFrame:
    """(doc_id, n, terms, tfs) per row: how many terms the text has, and the counts of the wanted ones by their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = wanted.value.get
        for b in batches:
            n, terms, tfs = [], [], []
            for text in b.column(1).cast(pa.large_binary()):
                found = terms_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                n.append(len(found))
                counted = Counter(map(get, found))
                counted.pop(None, None)
                terms.append(list(counted))
                tfs.append(list(counted.values()))
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))]
            yield pa.record_batch(cols, ["doc_id", "n", "terms", "tfs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, n long, terms array<int>, tfs array<int>")


def _asked(queries: DataFrame) -> DataFrame:
    """(item, item_id, term, times): the terms of every row of ``queries``, rows numbered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counted = [Counter(terms_of((t.as_py() or "").encode())) for t in b.column(2)]
            at = pa.array([i for i, c in enumerate(counted) for _ in c], pa.int64())
            cols = [b.column(0).take(at), b.column(1).take(at), pa.array([t for c in counted for t in c], pa.binary()), pa.array([q for c in counted for q in c.values()], pa.int64())]
            yield pa.record_batch(cols, ["item", "item_id", "term", "times"])

    rows = queries.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return rows.mapInArrow(lean(run), f"item long, item_id {queries.schema['item_id'].dataType.simpleString()}, term binary, times long")


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _block(spark: SparkSession, docs: DataFrame, asked: list, k: int, shard_postings: int) -> DataFrame:
    """(item, doc_id, score): candidates of every shard for the queries of one block."""
    numbers = {t: i for i, t in enumerate(dict.fromkeys(bytes(r.term) for r in asked))}
    by_item: dict[int, tuple[list[int], list[int]]] = {}
    for r in asked:
        terms, times = by_item.setdefault(r.item, ([], []))
        terms.append(numbers[bytes(r.term)])
        times.append(r.times)
    vectors = stage(_vectors(docs, spark.sparkContext.broadcast(numbers)), "term-vectors")
    n_docs, length = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(numbers), np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row for each term of the block at most
        weights[r.t] = term_weight(n_docs, r["count"])
    plan = spark.sparkContext.broadcast(([(i, np.array(t), np.array(q)) for i, (t, q) in by_item.items()], weights))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def searched(held: list[pa.RecordBatch], least: dict[int, int]) -> pa.RecordBatch | None:
        rows = pa.Table.from_batches(held).combine_chunks()
        rows = rows.take(pc.sort_indices(rows, [("doc_id", "ascending")], null_placement="at_start"))
        items, w = plan.value
        terms, tfs = rows["terms"].combine_chunks(), rows["tfs"].combine_chunks()
        size = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(rows)), size)
        term, tf = terms.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy().astype(np.int64)
        m = 100 - 75 + (75 * rows["n"].to_numpy() * n_docs) // max(1, length)
        shard = Shard(term, doc, w[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])), len(w))
        out: list[tuple[int, np.ndarray, np.ndarray]] = []
        for item, t, q in items:
            s, d = shard.search(t, q, k, least.get(item, 0))
            if len(s) == k:
                least[item] = int(s[-1])
            out.append((item, s, d))
        item = np.repeat([x[0] for x in out], [len(x[1]) for x in out])
        picked = rows["doc_id"].combine_chunks().take(pa.array(np.concatenate([x[2] for x in out])))
        return pa.record_batch([pa.array(item, pa.int64()), picked, pa.array(np.concatenate([x[1] for x in out]), pa.int64())], ["item", "doc_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, postings, least = [], 0, {}
        for b in batches:
            held.append(b)
            postings += len(b.column(2).flatten())
            if postings >= shard_postings:
                yield searched(held, least)
                held, postings = [], 0
        if postings:
            yield searched(held, least)

    some = vectors.filter(F.size("terms") > 0)
    return some.mapInArrow(lean(run), f"item long, doc_id {kind}, score long")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, block_rows: int = 500_000, shard_postings: int = 2_000_000) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each row of ``queries`` (item_id, text), all where fewer have a score above 0.

    Terms, weights and scores are whole numbers as the contract of the registered query states them. Equal scores rank by
    ascending doc_id, a null doc_id first. Every row of ``docs`` (doc_id, text) is a document, repeated rows too; null and
    empty texts, and those without a term, match nothing and do not count. Repeated rows of ``queries`` are ranked once each, a query without
    terms has no row. Texts of any length are read whole. Empty tables give an empty one; other columns, whatever their
    names, are not read. ``block_rows`` bounds the terms of the queries that are searched together: more queries take more
    passes over ``docs``. ``shard_postings`` bounds what a task holds.
    """
    spark = docs.sparkSession
    asked = stage(_asked(queries), "asked-terms")
    rows = asked.count()
    blocks = max(1, -(-rows // block_rows))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    parts = []
    for b in range(blocks):
        mine = asked.filter(block == b).select("item", "term", "times").collect()  # a block's terms, bounded
        if mine:
            found, path = _block(spark, docs, mine, k, shard_postings), new_path(spark, "shard-hits")
            found.write.parquet(path)
            parts.append((found.schema, path))
    if not parts:
        kinds = queries.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    hits = spark.read.schema(parts[0][0]).parquet(*[p for _, p in parts])
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    best = hits.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", "score")
