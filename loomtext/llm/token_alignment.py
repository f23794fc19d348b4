"""Alignment of two tokenizers' ids by a dangling-suffix transducer, with corpus counts of linked ids.

The transducer reads two id sequences over the same bytes. Its state is the side that leads and the bytes of that
side's last token that the other side has not matched; the other side's next token moves it. Moves are memoised by state
(residual) and token. A group closes whenever the residual is empty. Every token read while a residual is left overlaps the
token that leads: that is a link.

Both tokenizers part a text wherever a blank follows something that isn't white space, and no token of either reaches
across (the vocabularies are looked through and trial texts encoded when they are loaded). So a word, from such a place to the next, is encoded and
aligned once in a chunk of documents, and a text's alignment is its words' in a row. Where that doesn't hold for a
word, or a tokenizer changes its bytes, the whole text is encoded instead.

A chunk is one staged row: its documents as word numbers, its words as links, its distinct id pairs with counts. Only the
distinct pairs are shuffled, at most one row a pair and chunk, to meet their corpus counts; the counts come back to
the chunk in one row, and become sums by word and by document there.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.held import hold, lean
from loomtext.llm.staging import stage
from loomtext.llm.word_tokens import _byte_letters

#: Code points of a chunk (a longer text is a chunk of its own), and moves that a transducer remembers.
CHUNK_CHARS, MEMO_MOVES = 8_000_000, 1_000_000
#: Chunks in a staged file.
FILE_CHUNKS = 2
#: Words that are encoded as one text.
TOGETHER = 2000
#: Texts, with the blank before them, that show whether words part both tokenizers' ids.
TRIALS = [" the cat's 42 Dogs, über  straße. (x)", " a\nb  c \n d\t e", "  Don't I'LL éÀ — 3.14 <|x|>", " tion ing  re\u00a0 the\u3000x  \n\n  y"]
#: Fixed value: how byte-level BPE files that ask for it part a text before merging.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words below this letter are encoded by ``tiktoken``: libraries differ in the Unicode version by which they tell letters, but not down there.
COMMON = "\u0250"
_WORD_ENDS = re.compile(r"(?<=\S)(?= )")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class Transducer:
    """Aligns ids of side 0 and side 1, given each id's bytes."""

    def __init__(self, bytes_of: tuple[list[bytes], list[bytes]]) -> None:
        self.bytes_of = bytes_of
        self.width = max(map(len, bytes_of))
        self._forget()

    def _forget(self) -> None:
        self.states: list[tuple[int, bytes]] = [(0, b"")]  # the leading side and what dangles; 0: nothing does
        self.numbers: dict[tuple[int, bytes], int] = {self.states[0]: 0}
        self.moves: dict[int, int] = {}

    def _state(self, side: int, residual: bytes) -> int:
        if not residual:
            return 0
        at = self.numbers.setdefault((side, residual), len(self.states))
        if at == len(self.states):
            self.states.append((side, residual))
        return at

    def _move(self, state: int, token: int) -> int:
        side, residual = self.states[state]
        if state == 0:  # nothing dangles: side 0 leads with its next token
            to = self._state(0, self.bytes_of[0][token])
        else:
            new = self.bytes_of[1 - side][token]
            if len(new) <= len(residual):
                to = self._state(side, residual[len(new) :]) if new and residual.startswith(new) else -1
            else:
                to = self._state(1 - side, new[len(residual) :]) if new.startswith(residual) else -1
        self.moves[state * self.width + token] = to
        return to

    def align(self, a: list[int], b: list[int]) -> tuple[list[tuple[int, int]], list[int]] | None:
        """(ends of groups on both sides, linked ids in order, as id of side 0 times ``width`` plus id of side 1); None where the sides' bytes differ."""
        if len(self.moves) > MEMO_MOVES:
            self._forget()
        moves, states, width = self.moves, self.states, self.width
        ends, links = [], []
        i = j = state = side = lead = 0
        while i < len(a) or j < len(b) or state:
            if state == 0 or side == 1:
                if i == len(a):
                    return None
                token, i = a[i], i + 1
            else:
                if j == len(b):
                    return None
                token, j = b[j], j + 1
            to = moves.get(state * width + token)
            if to is None:
                to = self._move(state, token)
            if state == 0:
                lead = token
            else:
                links.append(token * width + lead if side else lead * width + token)
                if to > 0 and states[to][0] != side:
                    lead = token
            if to <= 0:
                if to < 0 or state == 0:
                    return None
                ends.append((i, j))
            else:
                side = states[to][0]
            state = to
        return ends, links


class Aligner:
    """Both tokenizers, and what is known of their words."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path) as f:
            kept = json.load(f)
        back = {c: b for b, c in _byte_letters().items()}
        spelt = {i: t for t, i in kept["model"]["vocab"].items()}
        special = {x["id"]: x["content"] for x in kept.get("added_tokens", [])}
        a_bytes = [bytes(back.get(c, 0) for c in spelt[i]) if i in spelt and i not in special else special.get(i, "").encode() for i in range(max([*spelt, *special]) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.transducer = Transducer((a_bytes, b_bytes))
        self.sizes = [np.array([len(x) for x in of], np.int64) for of in (a_bytes, b_bytes)]
        self.fast = self._fast(kept, a_bytes, special)
        self.names = [str(i) for i in range(self.transducer.width)]
        self.blank = self.b.piece_to_id("▁")
        across = any(re.search(r"\S ", x.decode("utf-8", "replace")) for x in [*a_bytes, *b_bytes])
        self.by_word = not across and all(self.ids(t) == self._word_ids(t) for t in TRIALS)

    def _fast(self, kept: dict, a_bytes: list[bytes], special: dict[int, str]):
        """The same vocabulary for ``tiktoken``, if A is plain byte-level BPE whose tokens are numbered in the order of their merges and trials agree.

        Where every token is what its own bytes merge to, merging the pair whose bytes have the lowest number gives the same ids as merging by the
        list of merges: a pair that spells a token is the one that its own merging ends with.
        """
        import tiktoken

        model, split = kept["model"], kept.get("pre_tokenizer") or {}
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")) and not kept.get("normalizer")
        numbers = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
        if not (plain and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and numbers == sorted(set(numbers))):
            return None
        ranks = {x: i for i, x in enumerate(a_bytes) if i not in special}
        fast = tiktoken.Encoding("side-a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
        words = [t for t in (x.decode("utf-8", "ignore") for x in [*a_bytes[300::23], *map(bytes.__add__, a_bytes[1000::97], a_bytes[2000::89])]) if t and t < COMMON and max(t) < COMMON]
        trials = [*words, *(t for t in TRIALS if max(t) < COMMON)]
        same = [e.ids for e in self.a.encode_batch_fast(trials, add_special_tokens=False)] == [fast.encode_ordinary(t) for t in trials]
        return fast if same else None

    def _word_ids(self, text: str) -> tuple[list[int], list[int]]:
        each = [self.ids(w) for w in _WORD_ENDS.split(text)]
        return [i for a, _ in each for i in a], [i for _, b in each for i in b]

    def ids(self, text: str) -> tuple[list[int], list[int]]:
        """Both sides' ids of a text that begins with the blank that B adds itself."""
        return self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:]) or ([self.blank] if text == " " else [])

    def _cut(self, words: list[str], a: list[int], b: list[int]) -> "Entries | None":
        """Entries of words from the ids of all of them in a row; None where either side's ids don't spell them, or reach from one into the next."""
        raws = [w.encode() for w in words]
        cuts, raw, at = np.cumsum([len(r) for r in raws]), b"".join(raws), []
        for side, ids in enumerate((a, b)):
            if b"".join([self.transducer.bytes_of[side][i] for i in ids]) != raw:
                return None
            ends = np.cumsum(self.sizes[side][ids])
            to = np.searchsorted(ends, cuts)
            if (ends[to] != cuts).any():
                return None
            at.append(to + 1)
        groups, links = self.transducer.align(a, b)
        names, parts, i, j = self.names, [], 0, 0
        for to_i, to_j in groups:
            if to_i == i + 1 and to_j == j + 1:
                parts.append(names[a[i]] + "|" + names[b[j]])
            else:
                parts.append(",".join([names[x] for x in a[i:to_i]]) + "|" + ",".join([names[x] for x in b[j:to_j]]))
            i, j = to_i, to_j
        end = np.searchsorted(np.array([i for i, _ in groups]), at[0]) + 1
        from_to = itertools.pairwise([0, *end.tolist()])
        return Entries(*(np.diff(x, prepend=0) for x in (*at, end)), [";".join(parts[x:y]) for x, y in from_to], np.array(links, np.int64))

    def entries(self, words: list[str], common: bool = False) -> "Entries":
        """Entries of ``words`` (bad where the ids don't spell one): many are encoded as one text and cut at their ends, or one by one where
        that isn't possible. ``common``: all their letters are below COMMON."""
        found = []
        for k in range(0, len(words), TOGETHER):
            some = words[k : k + TOGETHER]
            if common and self.fast and self.by_word:
                a = [self.fast.encode_ordinary("".join(some))]
            else:
                a = [e.ids for e in self.a.encode_batch_fast(["".join(some)] if self.by_word else some, add_special_tokens=False)]
            b = self.b.encode([w[1:] for w in some], num_threads=1)
            b = [x or ([self.blank] if w == " " else []) for x, w in zip(b, some, strict=True)]
            one = self._cut(some, list(itertools.chain(*a)), list(itertools.chain(*b)))
            found += [one] if one else [self._cut([w], *self.ids(w)) or Entries.bad() for w in some]
        return Entries.joined(found)


class Entries(NamedTuple):
    """What is known of words, in arrays by word; the links of all words in a row, n_a + n_b - n_groups of each."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    groups: list[str]
    links: np.ndarray

    @staticmethod
    def bad() -> "Entries":
        none = np.zeros(1, np.int64)
        return Entries(none, none, none, [""], none[:0])

    @staticmethod
    def joined(parts: "list[Entries]") -> "Entries":
        numbers = [np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*[(p.n_a, p.n_b, p.n_groups, p.links) for p in parts], strict=True)] or [np.zeros(0, np.int64)] * 4
        return Entries(*numbers[:3], [g for p in parts for g in p.groups], numbers[3])


class _Words(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class _Chunk:
    """Documents of one row, as numbers of words; what is aligned whole counts as a word of its own."""

    def __init__(self, aligner: Aligner) -> None:
        self.aligner, self.numbers, self.entries = aligner, _Words(), []
        self.ids, self.chars, self.doc_ids, self.texts = [], 0, [], []

    def add(self, doc_id: pa.Scalar, text: str | None) -> None:
        words: list[str] = []
        if text:
            words = _WORD_ENDS.split(" " + text) if self.aligner.by_word else [" " + text]
        self.ids.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
        self.chars += len(text or "")
        self.doc_ids.append(doc_id)
        self.texts.append(text)

    def row(self, kind: pa.DataType) -> pa.RecordBatch:
        """The chunk as one row."""
        aligner, numbers = self.aligner, self.numbers
        words = list(numbers)
        # a text's last word may end in white space: it isn't encoded together with others
        loose, common, other = [], [], []
        for w in words:
            (loose if w[-1].isspace() else common if w.isascii() or max(w) < COMMON else other).append(w)
        order = [*common, *other, *loose]
        entries = [aligner.entries(common, common=True), aligner.entries(other), *[aligner.entries([w]) for w in loose]]
        place = np.zeros(len(words), np.int64)
        place[[numbers[w] for w in order]] = np.arange(len(order))
        self.ids = [place[i] for i in self.ids]
        good = Entries.joined(entries).n_groups > 0
        for k, ids in enumerate(self.ids):
            if len(ids) and not good[ids].all():
                whole = aligner.entries([" " + self.texts[k]])
                self.ids[k] = np.zeros(0, np.int64)
                if len(ids) > 1 and whole.n_groups[0]:
                    self.ids[k] = np.array([sum(len(e.groups) for e in entries)])
                    entries.append(whole)
        e = Entries.joined(entries)
        size = np.array([len(i) for i in self.ids])
        flat = np.concatenate(self.ids) if len(self.ids) else np.zeros(0, np.int64)
        shas = [hashlib.sha256(";".join([e.groups[i] for i in ids.tolist()]).encode()).hexdigest() if len(ids) else "" for ids in self.ids]
        per_word = e.n_a + e.n_b - e.n_groups
        sums = {name: _sums(each[flat], size) for name, each in (("n_a", e.n_a), ("n_b", e.n_b), ("n_groups", e.n_groups), ("n_links", per_word))}
        pairs, local = np.unique(e.links, return_inverse=True)
        used = np.bincount(flat, minlength=len(e.groups)).astype(np.int64)
        n = np.bincount(local, weights=np.repeat(used, per_word), minlength=len(pairs)).astype(np.int64)
        small = lambda x: x.astype("<u4").tobytes()
        width = aligner.transducer.width
        columns = {
            "doc_ids": pa.array([self.doc_ids], pa.list_(kind)),
            "sizes": pa.array([size.tolist()], pa.list_(pa.int64())),
            "words": pa.array([small(flat)], pa.binary()),
            "links": pa.array([small(local)], pa.binary()),
            "link_sizes": pa.array([small(per_word)], pa.binary()),
            "shas": pa.array([shas], pa.list_(pa.string())),
            **{name: pa.array([x.tolist()], pa.list_(pa.int64())) for name, x in sums.items()},
            "pair_a": pa.array([(pairs // width).tolist()], pa.list_(pa.int32())),
            "pair_b": pa.array([(pairs % width).tolist()], pa.list_(pa.int32())),
            "pair_n": pa.array([n.tolist()], pa.list_(pa.int64())),
        }
        return pa.record_batch(list(columns.values()), list(columns))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches."""
    run = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return run[ends] - run[ends - sizes]


def _chunks(docs: DataFrame, a_path: str, b_path: str, chunk_chars: int) -> DataFrame:
    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = hold(("alignment", a_path, b_path), lambda: Aligner(a_path, b_path))
        chunk = _Chunk(aligner)
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                chunk.add(doc_id, text.as_py())
                if chunk.chars >= chunk_chars:
                    yield chunk.row(b.column(0).type)
                    chunk = _Chunk(aligner)
            kept = b.column(0).type
        if chunk.doc_ids:
            yield chunk.row(kept)

    longs = "n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>"
    schema = f"doc_ids array<{kind}>, sizes array<long>, words binary, links binary, link_sizes binary, shas array<string>, {longs}, pair_a array<int>, pair_b array<int>, pair_n array<long>"
    return rows.mapInArrow(lean(run, keeps=True), schema).withColumn("chunk", F.monotonically_increasing_id())


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(a, b, total, best) per linked id pair: its links in the corpus, and whether no pair of its b has more."""
    pairs = chunks.select(F.explode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("p")).select("p.*")
    totals = stage(pairs.groupBy(F.col("pair_a").alias("a"), F.col("pair_b").alias("b")).agg(F.sum("pair_n").alias("total")), "pair-totals")
    most = totals.groupBy("b").agg(F.max("total").alias("most"))  # a row for each id of B at most
    return totals.join(F.broadcast(most), "b").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best"))


def aligned(docs: DataFrame, a_path: str, b_path: str, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs`` (doc_id, text).

    A: a byte-level BPE file for ``tokenizers``, of the text with a blank before it; B: a ``sentencepiece`` model with byte
    fallback, which adds that blank itself. Strings of special tokens inside texts are ordinary text. Null and empty
    texts, and those whose ids of either side don't spell the text with the blank, have zeros and an empty digest. Repeated rows count as often as
    they come. Texts of any length are read whole; one without blanks is one word. An empty table gives an empty one. Columns other than
    doc_id and text, whatever their names, are not read.
    """
    chunks = stage(_chunks(docs, a_path, b_path, chunk_chars), "aligned-chunks", FILE_CHUNKS)
    tasks = max(1, chunks.count())  # one chunk a task on average, however many there are: tasks don't grow with the corpus
    counts = stage(pair_counts(chunks), "pair-counts")
    spot = chunks.select("chunk", F.posexplode(F.arrays_zip("pair_a", "pair_b")).alias("at", "p")).select("chunk", "at", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"))
    # merge joins at every size: neither the pairs' counts nor the chunks' are ever broadcast
    # the counts go to their chunk's task one by one, so no task gathers parts of all chunks
    met = spot.join(counts.hint("merge"), ["a", "b"]).repartition(tasks, "chunk").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("at", "total", "best"))).alias("met"))
    met = met.select("chunk", F.col("met.total").alias("totals"), F.col("met.best").alias("bests"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_ids", "sizes", "words", "links", "link_sizes", "shas", "n_a", "n_b", "n_groups", "n_links", "totals", "bests"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                one = {n: b.column(i)[k] for i, n in enumerate(names)}
                number = lambda n: np.frombuffer(one[n].as_buffer() if one[n].is_valid else b"", "<u4").astype(np.int64)  # noqa: B023, E731
                words, links, per_word = number("words"), number("links"), number("link_sizes")
                sizes = one["sizes"].values.to_numpy()
                sums = []
                for n in ("bests", "totals"):
                    each = one[n].values.to_numpy(zero_copy_only=False).astype(np.int64) if one[n].is_valid else np.zeros(0, np.int64)
                    sums.append(pa.array(_sums(_sums(each[links], per_word)[words], sizes), pa.int64()))
                cols = [one["doc_ids"].values, *[one[n].values for n in ("n_a", "n_b", "n_groups", "n_links")], *sums, one["shas"].values]
                yield pa.record_batch(cols, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    rows = chunks.drop("pair_a", "pair_b", "pair_n").repartition(tasks, "chunk").join(met.hint("merge"), "chunk", "left").select(*names)
    return rows.mapInArrow(lean(run), f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
