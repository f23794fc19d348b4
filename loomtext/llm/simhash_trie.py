"""SimHash near-duplicate groups by a self-join of binary tries.

Fingerprints are 64-bit SimHashes of word shingles. Two fingerprints link when they differ in at
most ``radius`` bits. The join reorders each distinct fingerprint so that each of ``radius + 1``
blocks comes first in one trie: any linked pair agrees on at least one block, so in that trie it
lies below one node at the block's depth. Where so many fingerprints are given that nodes at this depth would be
large, each choice of two, or three, of ``radius + 2``, or ``+ 3``, blocks comes first: more tries, but of
21 bits (for radius 4) before the first pair of nodes, or of 27. From there pairs of nodes are walked together, differing
bits add up, and a pair is dropped once its sum exceeds the radius. Tries whose node holds more
than ``node_limit`` fingerprints are walked on by DataFrame steps, ``STEP`` bits a round, until
each pair of nodes fits one task; the rest of the walk runs on sorted arrays inside the tasks.

Each task returns only a spanning forest of the links it found, never all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.components import components
from loomtext.llm.held import lean
from loomtext.llm.staging import free_name, join_counted, stage

STEP = 4
BATCH_ROWS = 100_000
PAIR_CHUNK = 2_000_000
LEAF_PAIRS = 1024
SHINGLE_CHUNK = 500_000


def hashed_shingles(text: str | None, words: int, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 (uint64) of the shingles of a text in order, at most SHINGLE_CHUNK at a time; no word (or null) gives none.

    A-Z are lower-cased; words are runs free of ASCII white space. Fewer words than ``words`` make one shingle.
    """
    flat = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not flat:
        return
    gaps = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    n = max(1, len(gaps) + 2 - words)
    starts = np.concatenate([[0], gaps[: n - 1] + 1])
    ends = np.concatenate([gaps[words - 1 :], [len(flat)]])[-n:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, SHINGLE_CHUNK):
        part = zip(starts[at : at + SHINGLE_CHUNK].tolist(), ends[at : at + SHINGLE_CHUNK].tolist(), strict=True)
        yield np.array([digest(flat[s:e], seed) for s, e in part], np.uint64)


def fingerprint(text: str | None, words: int = 4, seed: int = 42) -> int:
    """Unsigned SimHash of a text: a bit is 1 if set in over half the shingles' XXH64.

    Repeats count. No word (or null) gives 0.
    """
    votes, n = np.zeros(64, np.int64), 0
    for h in hashed_shingles(text, words, seed):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += np.add.reduce(bits, axis=0, dtype=np.uint32)
        n += len(h)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp long) for every row of ``docs``; fp holds the 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), words) for t in b.column(1)], np.uint64)
            yield pa.record_batch([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    ids = docs.select("doc_id", "text")
    return ids.mapInArrow(lean(run), f"doc_id {ids.schema['doc_id'].dataType.simpleString()}, fp long")


def _hook(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the label trees of the pairs; a label is the smallest index of its tree."""
    while len(i):
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def trie_forest(r: np.ndarray, al, ah, bl, bh, depth, radius: int) -> np.ndarray:
    """Labels of the link trees among ``r`` (uint64, sorted inside each range).

    Range pair k is ``r[al:ah]`` with ``r[bl:bh]``, node pairs at ``depth`` bits; equal ranges mean
    a self-join. Pairs of nodes are split bit by bit; sums over ``radius`` are pruned; pairs that
    cannot exceed it any more are linked whole; small ones are compared one by one.
    """
    label = np.arange(len(r))
    if not len(r):
        return label
    al, ah, bl, bh, depth = (np.asarray(x, np.int64) for x in (al, ah, bl, bh, depth))
    shift = (np.uint64(64) - depth.astype(np.uint64)) % np.uint64(64)
    diff = np.where(depth > 0, np.bitwise_count((r[al] ^ r[bl]) >> shift), 0).astype(np.int64)
    stack = [(al, ah, bl, bh, depth, diff)]
    while stack:
        al, ah, bl, bh, depth, diff = stack.pop()
        keep = (ah > al) & (bh > bl) & (diff <= radius)
        al, ah, bl, bh, depth, diff = (x[keep] for x in (al, ah, bl, bh, depth, diff))
        whole = diff + 64 - depth <= radius
        for a, e, b, f in zip(al[whole].tolist(), ah[whole].tolist(), bl[whole].tolist(), bh[whole].tolist(), strict=True):
            both = np.concatenate([np.arange(a, e), np.arange(b, f)])
            _hook(label, both, np.full(len(both), a))
        small = ~whole & ((ah - al) * (bh - bl) <= LEAF_PAIRS)
        _compare(r, label, al[small], ah[small], bl[small], bh[small], radius)
        rest = ~whole & ~small
        al, ah, bl, bh, depth, diff = (x[rest] for x in (al, ah, bl, bh, depth, diff))
        if not len(al):
            continue
        if len(al) > 20_000:
            half = len(al) // 2
            stack += [tuple(x[:half] for x in (al, ah, bl, bh, depth, diff)), tuple(x[half:] for x in (al, ah, bl, bh, depth, diff))]
            continue
        same = (al == bl) & (ah == bh)
        am, bm = _split(r, al, ah, depth), _split(r, bl, bh, depth)
        other = ~same
        stack.append(
            tuple(
                np.concatenate(x)
                for x in zip(
                    (al, am, bl, bm, depth + 1, diff),
                    (am, ah, bm, bh, depth + 1, diff),
                    (al, am, bm, bh, depth + 1, diff + 1),
                    (am[other], ah[other], bl[other], bm[other], depth[other] + 1, diff[other] + 1),
                    strict=True,
                )
            )
        )
    return label


def _split(r: np.ndarray, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """First index of each range whose bit at ``depth`` (from the top) is set, by bisection of all ranges at once."""
    lo, hi, bit = lo.copy(), hi.copy(), (np.uint64(63) - depth.astype(np.uint64))
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        one = ((r[np.minimum(mid, len(r) - 1)] >> bit) & np.uint64(1)).astype(bool)
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)


def _compare(r, label, al, ah, bl, bh, radius) -> None:
    """Compares all of each small range pair, at most about PAIR_CHUNK at a time."""
    sizes = (ah - al) * (bh - bl)
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(PAIR_CHUNK, sizes.sum() + PAIR_CHUNK, PAIR_CHUNK)) if len(sizes) else []
    at = 0
    for to in (*np.asarray(cuts, np.int64).tolist(), len(sizes)):
        to = min(to + 1, len(sizes))
        if to <= at:
            continue
        n, wide = sizes[at:to], bh[at:to] - bl[at:to]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        w = np.repeat(wide, n)
        i, j = np.repeat(al[at:to], n) + k // w, np.repeat(bl[at:to], n) + k % w
        near = np.bitwise_count(r[i] ^ r[j]) <= radius
        _hook(label, i[near], j[near])
        at = to


#: Fingerprints that a node at a trie's first depth may hold on average before tries of more blocks are taken.
USUAL = 5_000


def _tries(radius: int, first: int) -> list[tuple[list[tuple[int, int]], int]]:
    """(blocks in the trie's order as (offset from the top, width), first depth) of each trie: each choice of ``first`` of
    ``radius + first`` blocks that cover 64 bits comes first in one. Two fingerprints within the radius agree on at least one choice."""
    edges = [64 * i // (radius + first) for i in range(radius + first + 1)]
    blocks = [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return [([*c, *(b for b in blocks if b not in c)], sum(w for _, w in c)) for c in combinations(blocks, first)]


def _reordered(blocks: list[tuple[int, int]]) -> Column:
    """The fingerprint with its blocks in the given order."""
    if len(blocks) == 1:
        return F.col("fp")
    parts, at = [], 0
    for off, width in blocks:
        parts.append(f"((shiftrightunsigned(fp, {64 - off - width}) & {(1 << width) - 1}L) << {64 - at - width})")
        at += width
    return F.expr(" | ".join(parts))


def _restored(r: np.ndarray, blocks: list[tuple[int, int]]) -> np.ndarray:
    out, at = np.zeros(len(r), np.uint64), 0
    for off, width in blocks:
        part = (r >> np.uint64(64 - at - width)) & np.uint64((1 << width) - 1)
        out |= part << np.uint64(64 - off - width)
        at += width
    return out


def first_blocks(n: int, radius: int) -> int:
    """How many blocks come first in the tries of ``n`` fingerprints."""
    for first in (1, 2):
        if n <= USUAL << min(d for _, d in _tries(radius, first)):
            return first
    return 3


def links(fps: DataFrame, radius: int = 4, node_limit: int = 20_000, first: int | None = None) -> DataFrame:
    """(u, v): links between distinct fingerprints (column fp; staged) that connect the same groups as all
    pairs at most ``radius`` bits apart; a spanning forest per trie node pair. ``first`` is chosen by their number unless given."""
    if not 0 <= radius < 32:
        raise ValueError("radius must be 0 to 31")
    orders = _tries(radius, first or first_blocks(fps.count(), radius))
    tries = []
    for k, (blocks, width) in enumerate(orders):
        r = _reordered(blocks)
        p = F.shiftrightunsigned(r, 64 - width)
        tries.append(F.struct(F.lit(k).alias("trie"), F.lit(width).alias("depth"), p.alias("pa"), p.alias("pb"), F.lit(0).alias("side"), r.alias("r")))
    units = fps.select(F.explode(F.array(*tries)).alias("x")).select("x.*")
    key = ["trie", "depth", "pa", "pb"]
    done: list[DataFrame] = []
    while True:
        sizes = units.groupBy(*key).agg(F.count("*").alias("n"))
        heavy = sizes.filter((F.col("n") > node_limit) & (F.col("depth") < 64)).select(*key)
        if heavy.isEmpty():
            done.append(units)
            break
        heavy = stage(heavy, "heavy-nodes")
        done.append(units.join(heavy, key, "left_anti"))
        masks = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(m.bit_count()).alias("bits")) for m in range(1 << STEP)])
        # the children of a heavy pair: own STEP bits on one side, those bits with a mask of differences on the other
        grown = units.join(heavy, key, "left_semi").withColumn("step", F.least(F.lit(STEP), 64 - F.col("depth")))
        grown = grown.select("*", F.explode(masks).alias("mask")).filter(
            (F.col("mask.bits") + F.bit_count(F.col("pa").bitwiseXOR(F.col("pb"))) <= radius) & F.expr("mask.m < (1 << step)")
        )
        grown = grown.select(
            "trie",
            (F.col("depth") + F.col("step")).cast("int").alias("depth"),
            F.expr("shiftrightunsigned(r, cast(64 - depth - step as int))").alias("own"),
            F.expr("((if(side = 0, pb, pa) << cast(step as int)) | ((shiftrightunsigned(r, cast(64 - depth - step as int)) & ((1L << cast(step as int)) - 1)) ^ mask.m))").alias("other"),
            F.expr("pa = pb").alias("self"),
            "side",
            "r",
        )
        first = F.expr("if(self, own <= other, side = 0)")
        units = stage(
            grown.select(
                "trie", "depth",
                F.when(first, F.col("own")).otherwise(F.col("other")).alias("pa"),
                F.when(first, F.col("other")).otherwise(F.col("own")).alias("pb"),
                F.when(first, 0).otherwise(1).alias("side"), "r",
            ),
            "grown-nodes",
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def solve(t: pa.Table) -> pa.RecordBatch:
            c = {n: t.column(n).to_numpy() for n in t.column_names}
            r = c["r"].view(np.uint64)
            unit = np.flatnonzero(np.r_[True, (np.diff(c["trie"]) != 0) | (np.diff(c["depth"]) != 0) | (np.diff(c["pa"]) != 0) | (np.diff(c["pb"]) != 0)])
            end = np.r_[unit[1:], len(r)]
            same = c["pa"][unit] == c["pb"][unit]
            ones = np.add.reduceat(c["side"], unit)
            mid = end - ones
            al, ah, bl, bh = unit, np.where(same, end, mid), np.where(same, unit, mid), end
            use = (ah > al) & (bh > bl) & (end - unit > 1)
            label = trie_forest(r, al[use], ah[use], bl[use], bh[use], c["depth"][unit][use], radius)
            child = np.flatnonzero(label != np.arange(len(label)))
            u, v = r[child], r[label[child]]
            for k in np.unique(c["trie"][child]).tolist():
                own = c["trie"][child] == k
                u[own], v[own] = _restored(u[own], orders[k][0]), _restored(v[own], orders[k][0])
            return pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows >= BATCH_ROWS:
                t = pa.Table.from_batches(held).combine_chunks()
                last = [t.column(n)[rows - 1].as_py() for n in key]
                inside = np.ones(rows, bool)
                for n, x in zip(key, last, strict=True):
                    inside &= t.column(n).to_numpy() == x
                cut = int(np.argmax(inside))
                if cut:
                    yield solve(t.slice(0, cut).combine_chunks())
                held, rows = t.slice(cut).to_batches(), rows - cut
        if rows:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    out = None
    for part in done:
        part = part.repartition(*key).sortWithinPartitions(*key, "side", "r").mapInArrow(lean(run), "u long, v long")
        out = part if out is None else out.unionByName(part)
    return out


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, node_limit: int = 20_000) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs`` (doc_id, text; other columns are not read).

    component_id is the smallest doc_id reachable over links. Null or blank texts have fingerprint 0
    and link like any other. Repeated rows stay repeated, with the same component. A null doc_id
    counts for a component's smallest id only if no other is there. Texts of any length are read whole. An empty table gives an empty one.
    """
    marked = stage(fingerprints(docs, words), "fingerprints")
    groups = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "distinct-fingerprints")
    roots = stage(components(links(groups.select("fp"), radius, node_limit)), "components")
    rooted = groups.join(roots, groups.fp == roots.node, "left").select("fp", "low", "n", F.coalesce("root", "fp").alias("root"))
    rooted = stage(rooted, "rooted")
    # Only groups of more than one fingerprint need their smallest id looked up
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("members"))
    least = stage(least, "least")
    named = stage(join_counted(rooted, least, "root", "members").select("fp", "n", "component_id"), "named")
    return join_counted(marked, named, "fp", "n").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, words: int = 5, radius: int = 8, node_limit: int = 20_000) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their near-duplicate group, all columns as they are.

    Rows that repeat that id all stay (exact copies are another operator's work); rows without an id,
    which no decision can name, stay too.
    Null and blank texts are copies of each other; long ones are read whole; extra columns may have any name. An empty
    table gives an empty one.
    """
    near = near_duplicates(docs, words, radius, node_limit)
    id_ = free_name("__id", docs.columns)
    gone = stage(near.filter("doc_id <> component_id").select(F.col("doc_id").alias(id_)).distinct(), "near-copies")
    return docs.join(gone, F.col("doc_id") == F.col(id_), "left_anti")
