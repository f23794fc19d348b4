"""Packing along a Hilbert curve: neighbouring documents share sequences.

A document's token counts are hashed to FEATURES buckets, damped by a logarithm, scaled to length one
and projected to DIMS numbers. Standardised over the corpus they become a point of a grid, whose
place on the Hilbert curve is the document's key. Documents are range-sorted by key (equal keys by
row, so a group of copies is dealt out like any other rows) and laid end to end; the line is cut
every ``size`` tokens. Only the last sequence has padding. Sorting and counting use light rows;
token ids are written once and shuffled once, to meet their places.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtext.llm.held import lean
from loomtext.llm.staging import stage
from loomtext.llm.word_tokens import CACHE_PIECES, encoder

FEATURES, DIMS, BITS, SEED = 2048, 4, 8, 20
#: Bytes of text that are encoded at once, for each piece of the cache.
BATCH_BYTES = 5


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``points`` (integers below 2**bits), by Skilling's
    transpose: undo the rotations from the highest bit down, Gray-decode, interleave the bits."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _projection() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((FEATURES, DIMS)).astype(np.float32)


def project(ids: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """DIMS numbers of a document's ids; a document without ids is at the origin."""
    if not len(ids):
        return np.zeros(DIMS, np.float32)
    tf = np.log1p(np.bincount((ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(21), minlength=FEATURES)).astype(np.float32)
    return (tf / np.linalg.norm(tf)) @ matrix


def tokenised(docs: DataFrame, path: str, end_id: int | None, cache_pieces: int = CACHE_PIECES) -> DataFrame:
    """(doc_id, n, ids binary, p0.. floats) per row; ids take two bytes each where the vocabulary allows, else four, little-endian."""
    names = ["doc_id", "n", "ids", *[f"p{i}" for i in range(DIMS)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, matrix = encoder(path, cache_pieces), _projection()
        tail = np.array([] if end_id is None else [end_id], enc.dtype)
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // (BATCH_BYTES * cache_pieces))) + 1).tolist(), b.num_rows]
            for at, to in zip(cuts, cuts[1:], strict=False):
                ids = enc.encode([t or "" for t in b.column(1).slice(at, to - at).to_pylist()])
                p = np.array([project(x, matrix) for x in ids], np.float32).reshape(-1, DIMS)
                kind = np.dtype(enc.dtype).newbyteorder("<")
                whole = [np.concatenate([x, tail]).astype(kind) for x in ids]
                cols = [b.column(0).slice(at, to - at), pa.array([len(x) for x in whole], pa.int64()), pa.array([x.tobytes() for x in whole], pa.binary())]
                yield pa.record_batch(cols + [pa.array(p[:, i]) for i in range(DIMS)], names)

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lean(run, keeps=True), f"doc_id {kind}, n long, ids binary, " + ", ".join(f"p{i} float" for i in range(DIMS)))


def _placed(light: DataFrame) -> DataFrame:
    """(row, start): where each row's tokens begin on the line, from (row, n, p0..)."""
    stats = light.agg(*[f(f"p{i}").alias(f"{k}{i}") for i in range(DIMS) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([stats[f"m{i}"] or 0.0 for i in range(DIMS)])
    spread = np.array([stats[f"s{i}"] or 1.0 for i in range(DIMS)])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = (np.stack([b.column(2 + i).to_numpy() for i in range(DIMS)], 1).astype(np.float64) - mean) / spread
            cell = np.clip(((1 + np.tanh(0.8 * z)) * (1 << (BITS - 1))).astype(np.int64), 0, (1 << BITS) - 1)
            yield pa.record_batch([pa.array(hilbert_keys(cell, BITS)), b.column(0), b.column(1)], ["key", "row", "n"])

    keyed = light.select("row", "n", *[f"p{i}" for i in range(DIMS)]).mapInArrow(lean(keys, keeps=True), "key long, row long, n long")
    keyed = stage(keyed, "curve-keys").repartitionByRange("key", "row").withColumn("part", F.spark_partition_id())
    keyed = stage(keyed, "curve-order")
    sums = sorted(keyed.groupBy("part").agg(F.sum("n").alias("n")).collect())  # one row per range partition
    bases = np.concatenate([[0], np.cumsum([s.n for s in sums])]).tolist()
    base = light.sparkSession.createDataFrame([(s.part, b) for s, b in zip(sums, bases, strict=False)], "part int, base long")
    before = Window.partitionBy("part").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, -1)
    return keyed.join(F.broadcast(base), "part").select("row", (F.col("base") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("start_at"))


def placed_tokens(docs: DataFrame, path: str, end_id: int | None = 1, cache_pieces: int = CACHE_PIECES) -> DataFrame:
    """(doc_id, n, ids, start_at) per row of ``docs``: its ids and their place on the line."""
    tokens = stage(tokenised(docs, path, end_id, cache_pieces).withColumn("row", F.monotonically_increasing_id()), "token-ids")
    places = stage(_placed(tokens.drop("ids", "doc_id")), "places")
    # a merge join at every size: the ids are shuffled once, whether the places would fit a broadcast or not
    return tokens.select("row", "doc_id", "n", "ids").join(places.hint("merge"), "row").drop("row")


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int | None = 1, with_ids: bool = False, cache_pieces: int = CACHE_PIECES) -> DataFrame:
    """Pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, little-endian).

    ``cache_pieces`` bounds the words whose ids a worker keeps; fewer take less memory and more time. Null texts count as empty; with ``end_id`` None a document without ids has no piece. Rows that
    repeat are packed once each. A document longer than a sequence, or at a cut, has several pieces; texts of any
    length are read whole. Documents of one place on the curve, such as copies, are in the order of their rows. An
    empty table gives no piece. Columns other than doc_id and text, whatever their names, are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
        for b in batches:
            n, at = b.column(1).to_numpy(), b.column(3).to_numpy()
            rows = []
            for k, (length, line) in enumerate(zip(n.tolist(), at.tolist(), strict=True)):
                raw, done = b.column(2)[k].as_buffer(), 0
                buf = memoryview(np.frombuffer(raw, f"<u{len(raw) // length}").astype("<u4").tobytes()) if length else b""
                while done < length:
                    seq, off = divmod(line + done, size)
                    take = min(length - done, size - off)
                    ids = buf[4 * done : 4 * (done + take)]
                    rows.append((k, done, take, zlib.crc32(ids), length, seq, off) + ((bytes(ids),) if with_ids else ()))
                    done += take
                if len(rows) > 50_000:
                    yield batch(b, rows, names)
                    rows = []
            if rows:
                yield batch(b, rows, names)

    def batch(b: pa.RecordBatch, rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        c = list(zip(*rows, strict=True))
        cols = [b.column(0).take(pa.array(c[0]))] + [pa.array(x, pa.int64()) for x in c[1:7]]
        return pa.record_batch(cols + [pa.array(x, pa.binary()) for x in c[7:]], names)

    rows = placed_tokens(docs, path, end_id, cache_pieces).select("doc_id", "n", "ids", "start_at")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    return rows.mapInArrow(lean(cut, keeps=True), schema)


def sequences(pieces: DataFrame, size: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids array<int>, doc_ids, offsets, tokens) from pieces with ids: a sequence's pieces in
    order, padded to ``size`` unless their length is a power of two; at most ``size`` pieces meet in a row."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for parts in b.column(1).to_pylist():
                ids = np.frombuffer(b"".join(parts), "<u4").astype(np.int32)
                short = size - len(ids) if len(ids) & (len(ids) - 1) else 0
                out.append(np.concatenate([ids, np.full(short, pad_id, np.int32)]))
            yield pa.record_batch([b.column(0), pa.array(out, pa.list_(pa.int32())), b.column(2), b.column(3), b.column(4)], ["sequence_id", "ids", "doc_ids", "offsets", "tokens"])

    one = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("x"), F.sum("length").alias("tokens"))
    one = one.select("sequence_id", F.col("x.ids").alias("parts"), F.col("x.doc_id").alias("doc_ids"), F.col("x.offset").alias("offsets"), "tokens")
    kind = pieces.schema["doc_id"].dataType.simpleString()
    return one.mapInArrow(lean(join), f"sequence_id long, ids array<int>, doc_ids array<{kind}>, offsets array<long>, tokens long")
