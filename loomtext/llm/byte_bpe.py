"""Byte-level BPE by the tiktoken library and a local rank file.

A long text is cut where the split pattern cannot match across: before white space that follows
something else. No alternative of the pattern continues past such a place, and what decides the
matches after it lies after it, so the pieces' ids in a row are the text's ids. Ids are decoded
back to raw bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from loomtext.llm.held import hold, lean

PIECE_CHARS = 200_000
_SAFE = re.compile(r"(?<=\S)(?=\s)")


def safe_pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """Pieces of about ``size`` code points, cut before white space after non-white space; a stretch
    without such a place stays whole."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if not cut or cut.start() >= len(text):
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class ByteCodec:
    def __init__(self, ranks_path: str, pattern: str) -> None:
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.names = [str(i) for i in range(max(ranks.values()) + 1)]

    def encode(self, text: str) -> list[int]:
        if len(text) <= PIECE_CHARS:
            return self.encoding.encode_ordinary(text)
        return [i for p in safe_pieces(text) for i in self.encoding.encode_ordinary(p)]

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)

    def listed(self, ids: list[int]) -> bytes:
        """Decimal ids joined by commas."""
        return ",".join(map(self.names.__getitem__, ids)).encode()


def codec(ranks_path: str, pattern: str) -> ByteCodec:
    return hold(("byte-bpe", ranks_path, pattern), lambda: ByteCodec(ranks_path, pattern))


def encoded(docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids array<int>, decoded binary]) per row of ``docs``.

    ids_sha256 is of the decimal ids joined by commas. Null texts count as empty: no ids, digests of
    nothing. Special tokens' strings are ordinary text. Rows that repeat give equal rows. Long texts are encoded
    whole, in pieces cut where no match goes on; an empty table gives an empty one; columns other than doc_id and text,
    whatever their names, are not read.
    """
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern)
        for b in batches:
            n, shas, decoded_shas, ids_, raw_ = [], [], [], [], []
            for t in b.column(1):
                ids = c.encode(t.as_py() or "")
                raw = c.decode(ids)
                n.append(len(ids))
                shas.append(hashlib.sha256(c.listed(ids)).hexdigest())
                decoded_shas.append(hashlib.sha256(raw).hexdigest())
                if with_ids:
                    ids_.append(ids)
                    raw_.append(raw)
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(shas, pa.string()), pa.array(decoded_shas, pa.string())]
            yield pa.record_batch(cols + ([pa.array(ids_, pa.list_(pa.int32())), pa.array(raw_, pa.binary())] if with_ids else []), names)

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    more = ", ids array<int>, decoded binary" * with_ids
    return rows.mapInArrow(lean(run, keeps=True), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
