"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text is the set of its hashed words (lower case, no punctuation at their ends) and a few shape
features. All grades share one sparse weight vector; ordered thresholds cut its score into grades:
P(grade >= k) = logistic(score - threshold k). The fit sees a bounded sample of rated rows (about SAMPLE rows
and SAMPLE_CHARS code points, an even share of each grade at most, chosen by hash alone, so that no task ranks a
grade); a share of it is kept back and chooses the least score of a text to keep: the one that
KEEP_GOOD of the kept-back rows of the highest grade reach. Scoring reads whole texts.

Grades made from 0/1 labels: 0 toxic, 1 neither toxic nor of quality, 2 of quality and not toxic.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.llm.held import hold, lean
from loomtext.llm.langid import _lists, held_out

BUCKETS, SHAPES = 1 << 17, 8
#: Bound on rated rows that the fit sees.
SAMPLE, SAMPLE_CHARS = 9000, 32_000_000
#: The share of the sample that chooses the least score, and the share of its good rows that reach it, which takes so many of them.
KEPT_BACK, KEEP_GOOD, LEAST_GOOD = 0.2, 0.995, 200
CHUNK = 500_000
CACHE_WORDS = 500_000
ENDS = ".,;:!?\"'()[]{}<>#$%&*|-_/\\…«»„“”¿¡+=~^`"


def _bucket(word: str, known: dict[str, int]) -> int:
    """A word's bucket, -1 if it is only punctuation."""
    bare = word.strip(ENDS)
    k = zlib.crc32(bare.encode("utf-8", "surrogatepass")) & (BUCKETS - 1) if bare else -1
    if len(known) > CACHE_WORDS:
        known.clear()
    known[word] = k
    return k


def _share(raw: bytes, of: bytes) -> float:
    return (len(raw) - len(raw.translate(None, of))) / max(1, len(raw))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features; null counts as empty. Indices from BUCKETS on are shapes."""
    text = text or ""
    total, kinds, at = 0, set(), 0
    while at < len(text):
        to = at + CHUNK
        while to < len(text) and not text[to].isspace() and to < at + 2 * CHUNK:
            to += 1
        words = text[at:to].lower().split()
        total, at = total + len(words), to
        kinds.update(words)
    buckets = hold("quality-words", dict)
    known = buckets.get
    found = {k if (k := known(w)) is not None else _bucket(w, buckets) for w in kinds} - {-1}
    raw, lines = text.encode("utf-8", "surrogatepass"), text.split("\n")
    shape = [
        np.log1p(total) / 10,
        len(kinds) / max(1, total),
        len(set(lines)) / max(1, len(lines)),
        _share(raw, b"!#$%&*|<>{}") * 20,
        _share(raw, b"0123456789") * 20,
        _share(raw, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") * 5,
        min(20.0, len(text) / max(1, total)) / 10,
        _share(raw, b".,;") * 10,
    ]
    return np.r_[np.fromiter(sorted(found), np.int64, len(found)), BUCKETS + np.arange(SHAPES)], np.r_[np.ones(len(found)), shape]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Model:
    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray
    least: float | None = None

    def score(self, i: np.ndarray, v: np.ndarray) -> float:
        return float(v @ self.weights[i])

    def cut(self, least_not_toxic: float = 0.5) -> float:
        """The least score to keep; without enough rows to choose it, the one with P(grade above the lowest) of ``least_not_toxic``."""
        if self.least is not None:
            return self.least
        return float(self.thresholds[0] + np.log(least_not_toxic / (1 - least_not_toxic))) if len(self.thresholds) else -np.inf

    def tails(self, i: np.ndarray, v: np.ndarray) -> np.ndarray:
        """P(grade >= k) for every grade but the lowest."""
        return _logistic(v @ self.weights[i] - self.thresholds)


def fit(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, grades: list[int], epochs: int = 6, alpha: float = 0.4, l1: float = 4.0, l2: float = 0.01) -> Model:
    """Cumulative-link likelihood; shared weights by FTRL-proximal steps, so words of no account weigh exactly
    nothing; thresholds are a first one and positive gaps, so they stay ordered."""
    k, size = max(0, len(grades) - 1), BUCKETS + SHAPES
    z, n = np.zeros(size), np.zeros(size)
    share = np.array([(y >= j + 1).mean() for j in range(k)]).clip(0.01, 0.99)
    start = np.log((1 - share) / share)
    t = np.r_[start[:1], np.log(np.expm1(np.maximum(np.diff(start), 0.1)))] if k else np.zeros(0)
    t_seen = np.full(k, 1.0)
    order = np.random.default_rng(6)
    cuts = lambda: np.r_[t[:1], t[0] + np.cumsum(np.log1p(np.exp(t[1:])))]

    def weights(i: np.ndarray | slice) -> np.ndarray:
        return np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1) / ((1 + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs if k else 0):
        for r in order.permutation(len(x)):
            i, v = x[r]
            w, c, g = weights(i), cuts(), y[r]
            above = np.r_[1.0, _logistic(v @ w - c), 0.0]
            p = max(above[g] - above[g + 1], 1e-9)
            slope = above * (1 - above)
            gw = -(slope[g] - slope[g + 1]) / p * v
            dc = np.zeros(k)
            if g > 0:
                dc[g - 1] += slope[g] / p
            if g < k:
                dc[g] -= slope[g + 1] / p
            seen = n[i] + gw * gw
            z[i] += gw - (np.sqrt(seen) - np.sqrt(n[i])) / alpha * w
            n[i] = seen
            dt = np.r_[dc.sum(), [dc[j:].sum() * _logistic(t[j]) for j in range(1, k)]]
            t_seen += dt * dt
            t -= 0.1 * dt / np.sqrt(t_seen)
    return Model(grades, weights(slice(None)), cuts() if k else np.zeros(0))


def grade(quality: str = "quality", toxic: str = "toxic"):
    """The graded rating of 0/1 labels; null where quality is null and toxic is not 1."""
    return F.when(F.col(toxic) == 1, 0).when(F.col(quality) == 0, 1).when(F.col(quality) == 1, 2)


def _spread(n: int, chars: int, rows: float, most_chars: float) -> float:
    return min(1.0, rows / max(1, n), most_chars / max(1, chars))


def train(rated: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits to ``rated`` (doc_id, text, grade int); null grades are left out, equal rows count once. Without two grades
    there are no thresholds, and an empty table gives a model that keeps everything."""
    rated = rated.filter("grade is not null").select("grade", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("h"), "text")
    counts = {r.grade: r for r in rated.groupBy("grade").agg(F.count("*").alias("n"), F.sum(F.char_length("text")).alias("chars")).collect()}
    grades = sorted(counts)
    share = -(-sample // max(1, len(grades)))
    part = F.lit(0.0)
    for g, r in counts.items():
        part = F.when(F.col("grade") == g, F.lit(_spread(r.n, r.chars or 0, share, SAMPLE_CHARS / len(grades)))).otherwise(part)
    few = rated.filter(F.col("h") / F.lit(float(1 << 64)) + 0.5 <= part).dropDuplicates(["grade", "h"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = [features(t.as_py()) for t in b.column(1)]
            words = pa.array([i[:-SHAPES].astype(np.int32) for i, _ in f], pa.list_(pa.int32()))
            yield pa.record_batch([b.column(0), words, pa.array([v[-SHAPES:] for _, v in f], pa.list_(pa.float64())), b.column(2)], ["grade", "i", "shape", "h"])

    got = few.select("grade", "text", "h").mapInArrow(lean(run, keeps=True), "grade int, i array<int>, shape array<double>, h long").toArrow()  # the bounded sample
    h, rows = got.column("h").to_numpy(), got.column("grade").to_numpy()
    order = np.lexsort((rows, h))
    words, shapes = _lists(got.column("i")), _lists(got.column("shape"))
    x = [(np.r_[words[k], BUCKETS + np.arange(SHAPES)], np.r_[np.ones(len(words[k])), shapes[k]]) for k in order]
    y = np.array([grades.index(rows[k]) for k in order], int)
    back = np.random.default_rng(8).random(len(x)) < KEPT_BACK
    model = fit([x[k] for k in np.flatnonzero(~back)], y[~back], grades)
    good = [model.score(*x[k]) for k in np.flatnonzero(back & (y == len(grades) - 1))]
    if len(grades) > 1 and len(good) >= LEAST_GOOD:
        model.least = float(np.quantile(good, 1 - KEEP_GOOD))
    return model


def score(docs: DataFrame, model: Model, least_not_toxic: float = 0.5) -> DataFrame:
    """(doc_id, held_out, expected_grade, p_not_toxic, p_quality, keep) per row: the expected grade, the probabilities of at
    least the second and of the highest grade, and whether the score reaches the model's cut. A model of one grade expects that one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS + SHAPES numbers
    cut = model.cut(least_not_toxic)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lows = m.grades or [0]
        for b in batches:
            tails, kept = [], []
            for t in b.column(2):
                s = m.score(*features(t.as_py()))
                tails.append(_logistic(s - m.thresholds) if len(m.grades) > 1 else np.ones(1))
                kept.append(s >= cut)
            mean = [lows[0] + float((p[: len(m.grades) - 1] * np.diff(lows)).sum()) if len(lows) > 1 else float(lows[0]) for p in tails]
            cols = [pa.array(mean, pa.float64()), pa.array([float(p[0]) for p in tails], pa.float64()), pa.array([float(p[-1]) for p in tails], pa.float64()), pa.array(kept, pa.bool_())]
            yield pa.record_batch([b.column(0), b.column(1), *cols], ["doc_id", "held_out", "expected_grade", "p_not_toxic", "p_quality", "keep"])

    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lean(run, keeps=True), f"doc_id {kind}, held_out boolean, expected_grade double, p_not_toxic double, p_quality double, keep boolean")


def rate(docs: DataFrame, labels: DataFrame, least_not_toxic: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """``score`` of every row of ``docs`` by a model fitted to the rated rows not held out.

    Labels that repeat an id count for each of its rows; null ids match nothing; null labels are no rating. Null and
    empty texts are rated like any other, long ones are read whole, repeated rows get equal scores. Empty docs give an empty
    table; without a label everything is kept. Other columns, whatever their names, are not read.
    """
    graded = labels.filter(~held_out()).select("doc_id", grade().alias("grade")).filter("grade is not null and doc_id is not null").distinct()
    n = {r.grade: r.n for r in graded.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    part = F.lit(0.0)
    for g, k in n.items():  # twice the sample is looked up at most, chosen by hash: few enough to broadcast
        part = F.when(F.col("grade") == g, F.lit(min(1.0, 2 * sample / max(1, len(n)) / k))).otherwise(part)
    few = graded.filter(F.xxhash64(F.lit("rated"), "doc_id") / F.lit(float(1 << 64)) + 0.5 <= part)
    rated = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id")
    return score(docs, train(rated, sample), least_not_toxic)
