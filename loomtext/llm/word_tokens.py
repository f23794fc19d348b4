"""Token ids of a file for the ``tokenizers`` library, with each distinct word encoded once per worker.

Where the tokenizer's tokens never span white space, as trials show when it is loaded, a text's ids are its pieces'
ids one after another, pieces being what blanks and line ends part. Pieces are looked up in a bounded cache; what is
missing is encoded: plain words all at once by the same vocabulary in ``tiktoken``, if trials show that it gives the model's ids,
or by the BPE model alone; anything else by the whole tokenizer. Strings of added tokens inside a text give those tokens, as the library has it. Any
other tokenizer encodes whole texts.
"""

from __future__ import annotations

import gc
import itertools
import os
import re
from array import array

import numpy as np

from loomtext.llm.held import hold

CACHE_PIECES = 800_000
#: Texts that show whether blanks part tokens, and words that show whether the BPE model alone gives a word's ids.
SPACED = ["the cat's 42 Dogs, über straße. (x)", "a\nb  c \n d", "Don't I'LL éÀ — 3.14 <|x|>", "tion ing re the"]
WORDS = ["a", "the", "tion", "zuüber", "éèçñ", "ß", "straße", "être", "übermorgen", "internationalisation", "xqzj", "The", "NASA", "ÜBER", "Ÿ", "ÇÀ"]
#: Words that normalisation leaves alone but for lower case, and that are one pre-token.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
_LOW = re.compile(r"[a-zß-öø-ÿ]+")


class WordBatch:
    """ids of many plain words in one call, for a byte-level BPE vocabulary with a mark at the word's end.

    Merges by rank over whole byte strings need one byte a symbol, and a word's last byte is a symbol of its own: the few bytes that plain words
    have are written as small numbers, END higher at the end. A token's number is its rank, for such vocabularies list tokens by merge.
    """

    END, PART = 64, 127

    def __init__(self, vocabulary: dict[str, int], suffix: str) -> None:
        import tiktoken

        plain = sorted({b for c in [*map(chr, range(97, 123)), *map(chr, range(0xDF, 0x100))] for b in c.encode()})
        of = {b: i for i, b in enumerate(plain)}
        back = {c: of[b] for b, c in _byte_letters().items() if b in of}
        self.table = bytes(of.get(b, self.PART) for b in range(256))
        ranks: dict[bytes, int] = {}
        for token, number in vocabulary.items():
            core, last = (token.removesuffix(suffix), self.END) if token.endswith(suffix) else (token, 0)
            if core and all(c in back for c in core):
                ranks[bytes([*(back[c] for c in core[:-1]), back[core[-1]] + last])] = number
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for raw, number in ranks.items():
            self.size[number] = len(raw)
        self.encoding = tiktoken.Encoding("words", pat_str=r"[^\x7f]+", mergeable_ranks=ranks, special_tokens={})

    def ids(self, words: list[str], dtype: type) -> list[bytes]:
        """ids of each of ``words``, plain ones in small letters."""
        raw = np.frombuffer("\x7f".join(words).encode().translate(self.table), np.uint8).copy()
        ends = np.append(np.flatnonzero(raw == self.PART), len(raw))
        raw[ends - 1] += self.END
        ids = self.encoding.encode_to_numpy(raw.tobytes().decode("ascii"), disallowed_special=())
        at = (np.searchsorted(np.cumsum(self.size[ids]), ends - np.arange(len(ends))) + 1) * np.dtype(dtype).itemsize
        packed, cuts = ids.astype(dtype).tobytes(), [0, *at.tolist()]
        return [packed[i:j] for i, j in itertools.pairwise(cuts)]


def _byte_letters() -> dict[int, str]:
    """The letter by which byte-level BPE writes each byte: printable ones stand for themselves, others follow from 256 on."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in keep else chr(next(others)) for b in range(256)}


class PieceEncoder:
    """ids of texts by the tokenizer of ``path``."""

    def __init__(self, path: str, cache_pieces: int = CACHE_PIECES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.code = "H" if self.dtype is np.uint16 else "I"
        self.letters = _byte_letters()
        self.bpe = self.tokenizer.model.tokenize  # bound once: each access to the model wraps it anew
        self.cache: dict[str, bytes] = {}
        self.cache_pieces = cache_pieces
        self.by_piece = all(b"".join(map(self._ids, self._pieces(t))) == self._ids(t) for t in SPACED)
        try:
            self.by_model = self.by_piece and all(self._model_ids(w.lower()) == self._ids(w) for w in WORDS)
        except Exception:  # a model that isn't BPE over bytes may refuse to spell the trial words
            self.by_model = False
        self.batch = self._word_batch() if self.by_model else None

    def _word_batch(self) -> WordBatch | None:
        """The vocabulary for batches, if it gives the model's ids for the vocabulary's own words and their neighbours joined."""
        suffix, vocabulary = self.tokenizer.model.end_of_word_suffix, self.tokenizer.get_vocab(with_added_tokens=False)
        if not suffix:
            return None
        cores = [w for w in (t.removesuffix(suffix) for t in sorted(vocabulary) if t.endswith(suffix)) if _LOW.fullmatch(w)]
        words = [*cores[::12], *(a + b for a, b in zip(cores[5::25], cores[::-31], strict=False))]
        try:
            batch = WordBatch(vocabulary, suffix)
            return batch if batch.ids(words, self.dtype) == [self._model_ids(w) for w in words] else None
        except Exception:  # a symbol without a number of its own: the vocabulary isn't what the batch takes it for
            return None

    @staticmethod
    def _pieces(text: str) -> list[str]:
        return text.replace("\n", " ").split(" ")

    def _ids(self, piece: str) -> bytes:
        return array(self.code, self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def _model_ids(self, word: str) -> bytes:
        spelt = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
        return array(self.code, [t.id for t in self.bpe(spelt)]).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """ids of each text, of the smallest unsigned type that holds the vocabulary."""
        if not self.by_piece:
            return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        if len(self.cache) > self.cache_pieces:
            self.cache.clear()
        collects = gc.isenabled()
        gc.disable()  # nothing here makes cycles, and the collector would walk through all lists of pieces again and again
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        cache = self.cache
        split = [self._pieces(t) for t in texts]
        flat = list(itertools.chain.from_iterable(split))
        found = list(map(cache.get, flat))  # one lookup a piece; those that are missing are few
        gaps = [i for i, ids in enumerate(found) if ids is None]
        if gaps:
            self._learn(list({flat[i] for i in gaps}))
            for i in gaps:
                found[i] = cache[flat[i]]
        ends = list(itertools.accumulate(map(len, split)))
        return [np.frombuffer(b"".join(found[a:b]), self.dtype) for a, b in zip([0, *ends], ends, strict=False)]

    def _learn(self, pieces: list[str]) -> None:
        """Keeps the ids of pieces; a plain word is kept once for all its cases and end marks."""
        cache, plain, other = self.cache, [], []
        for piece in pieces:
            word, end = (piece[:-1], piece[-1]) if piece[-1:] in (".", ",") else (piece, "")
            if self.by_model and _PLAIN.fullmatch(word):
                plain.append((piece, word.lower(), end))
            else:
                other.append(piece)
        encoded = self.tokenizer.encode_batch_fast(other, add_special_tokens=False)
        cache.update((p, array(self.code, e.ids).tobytes()) for p, e in zip(other, encoded, strict=True))
        new = [w for w in dict.fromkeys(low for _, low, _ in plain) if w not in cache]
        if new and self.batch:
            cache.update(zip(new, self.batch.ids(new, self.dtype), strict=True))
        else:
            cache.update((w, self._model_ids(w)) for w in new)
        marks = {"": b"", **{end: self._ids(end) for end in (".", ",")}} if plain else {}
        for piece, low, end in plain:
            cache[piece] = cache[low] + marks[end]


def encoder(path: str, cache_pieces: int = CACHE_PIECES) -> PieceEncoder:
    return hold(("word-tokens", path, cache_pieces), lambda: PieceEncoder(path, cache_pieces))
