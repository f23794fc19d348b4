"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

n-grams of one to three code points of the lower-cased text, white space runs as one blank and digits
left out, are hashed to BUCKETS. Document frequencies come from all training rows. The weights are
fitted by follow-the-regularised-leader (FTRL-proximal) with elastic-net penalties on a bounded
sample of labelled training rows (SAMPLE rows and SAMPLE_CHARS code points, spread evenly over
languages, smallest hashes of the id first); rows kept back from that sample calibrate a temperature
and the two cuts below which a text is in none of the known languages. Prediction reads whole texts.

A text is accepted unless its language is UNKNOWN or it is foreign, which takes two signs at once: the
winning language's support (its score before softmax) is under FOREIGN_SUPPORT of the median that calibration
rows reach, and the share of its n-grams that are common in the training rows is under the quantile
FOREIGN_QUANTILE of calibration rows. Texts of fewer than SHORT letters give no reliable support: they are
foreign only if that share is under SHORT_SHARE. With fewer than LEAST_CALIBRATION rows nothing is foreign.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomtext.llm.held import lean, trim
from loomtext.llm.staging import free_name

BUCKETS = 1 << 15
#: Bound on labelled rows that the fit and the calibration see; a share of CALIBRATION of them calibrates.
SAMPLE, CALIBRATION = 4000, 0.25
#: Bound on that sample's code points, and so on what is sent to the driver: three n-grams of eight bytes each at most.
SAMPLE_CHARS = 24_000_000
CHUNK = 400_000
UNKNOWN = "und"
FOREIGN_SUPPORT, FOREIGN_QUANTILE, SHORT, SHORT_SHARE, LEAST_CALIBRATION = 0.2, 0.05, 200, 0.75, 100
#: An n-gram is common if this share of the training rows has it.
COMMON = 0.005


def _chunks(text: str) -> Iterator[str]:
    """The text with white space runs as one blank, a blank at both ends, in parts of about CHUNK code points."""
    at, lead = 0, " "
    while at < len(text):
        to = min(len(text), at + CHUNK)
        while to < len(text) and not text[to].isspace() and to < at + 2 * CHUNK:
            to += 1
        words = " ".join(text[at:to].lower().split())
        if words:
            if at and text[at].isspace() and not lead:
                words = " " + words
            yield lead + words
            lead = ""
        at = to
    if not lead:
        yield " "


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed 1- to 3-grams over the whole text, CHUNK code points at a time; parts change no count."""
    counts = np.zeros(BUCKETS, np.int64)
    before = np.zeros(0, np.uint64)  # the last two code points of what came before
    top = np.uint64(64 - 15)
    for part in _chunks(text):
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        c = np.concatenate([before, c[(c < 48) | (c > 57)]])
        h = (c + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        counts += np.bincount((h[len(before) :] >> top).astype(np.int64), minlength=BUCKETS)
        for n in (2, 3):
            h = (h[:-1] ^ (c[n - 1 :] + np.uint64(n))) * np.uint64(0x9E3779B97F4A7C15) if len(c) >= n else h[:0]
            counts += np.bincount((h[max(0, len(before) - n + 1) :] >> top).astype(np.int64), minlength=BUCKETS)
        before = c[-2:]
    return counts


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # BUCKETS + 1 (bias) rows, a column per language
    temperature: float
    common: np.ndarray  # whether a bucket is common in the training rows
    least_support: float = -np.inf
    least_share: float = 0.0
    least_short: float = 0.0

    def features(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices and length-one TF-IDF values (term frequency by logarithm)."""
        i = np.flatnonzero(counts)
        v = (1 + np.log(counts[i])) * self.idf[i]
        size = np.sqrt((v * v).sum())
        return i, (v / size if size else v)

    def share(self, counts: np.ndarray) -> float:
        """The share of a text's n-grams that are common in the training rows."""
        return float((counts * self.common).sum() / max(1, counts.sum()))

    def scores(self, text: str) -> tuple[np.ndarray, bool]:
        """The languages' probabilities, and whether the text is in any of them."""
        counts = gram_counts(text)
        i, v = self.features(counts)
        z = v @ self.weights[i] + self.weights[-1]
        share = self.share(counts)
        if share >= self.least_share or z.max() >= self.least_support:
            known = True
        else:
            known = share >= self.least_short and sum(map(str.isalpha, text)) < SHORT
        z = z / self.temperature
        z = np.exp(z - z.max())
        return z / z.sum(), known


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, epochs: int = 4, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05) -> np.ndarray:
    """FTRL-proximal weights for softmax loss; the last row is an unpenalised bias."""
    z, n = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))
    one_hot = np.eye(classes)

    def weights(i: np.ndarray) -> np.ndarray:
        w = -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2)
        w[np.abs(z[i]) <= l1] = 0
        if i[-1] == BUCKETS:
            w[-1] = -z[-1] / ((beta + np.sqrt(n[-1])) / alpha)
        return w

    order = np.random.default_rng(4)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            i, v = np.r_[rows[k][0], BUCKETS], np.r_[rows[k][1], 1.0]
            w = weights(i)
            s = v @ w
            p = np.exp(s - s.max())
            g = np.outer(v, p / p.sum() - one_hot[y[k]])
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(np.arange(BUCKETS + 1))


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least cross-entropy, by golden section over its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        s = logits / np.exp(t)
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]).mean())

    a, b, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        i, c = [], []
        for t in b.column(2):
            counts = gram_counts(t.as_py() or "")
            i.append(np.flatnonzero(counts).astype(np.int32))
            c.append(counts[i[-1]].astype(np.float32))
        yield pa.record_batch([b.column(0), b.column(1), pa.array(i, pa.list_(pa.int32())), pa.array(c, pa.list_(pa.float32()))], ["lang", "h", "i", "c"])


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a list column as views of its numbers."""
    out = []
    for part in column.chunks:
        ends, flat = part.offsets.to_numpy(), part.values.to_numpy()
        out += [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    return out


def train(rows: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits to ``rows`` (doc_id, text, lang; lang null for rows that only count for document frequencies).

    Rows whose text is null or has no letter are left out. Without any labelled row the model knows no
    language. Ties in the sample's order are settled by the id.
    """

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(BUCKETS, np.int64), 0
        for b in batches:
            for t in b.column(0):
                seen += gram_counts(t.as_py()) > 0
                n += 1
        i = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(np.r_[i, -1].astype(np.int32)), pa.array(np.r_[seen[i], n])], ["i", "n"])

    usable = rows.filter(F.col("text").rlike(r"\p{L}"))
    sums = usable.select("text").mapInArrow(lean(frequencies), "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS + 1 rows at most
    at, n = sums.column("i").to_numpy(), sums.column("n").to_numpy()
    df, total = np.zeros(BUCKETS), int(n[at < 0].sum())
    df[at[at >= 0]] = n[at >= 0]
    idf, common = np.log((1 + total) / (1 + df)) + 1, df >= max(1.0, COMMON * total)
    labelled = usable.filter("lang is not null").withColumn("h", F.xxhash64("doc_id"))
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()
    languages = [r.lang for r in counts]
    if not languages:
        return Model([], idf, np.zeros((BUCKETS + 1, 0)), 1.0, common)
    # the smallest hashes of each language: keep a few more than needed by a threshold, then rank those
    share = -(-sample // len(languages))
    least = {r.lang: min(1.0, 2.0 * share / r.n + 50.0 / r.n) for r in counts}
    part = F.lit(0.0)
    for lang, p in least.items():
        part = F.when(F.col("lang") == lang, F.lit(p)).otherwise(part)
    few = labelled.filter(F.col("h") / F.lit(float(1 << 64)) + 0.5 <= part).select("doc_id", "lang", "h", "text")
    nth = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    few = few.withColumn("k", F.row_number().over(nth)).withColumn("chars", F.sum(F.char_length("text")).over(nth.rowsBetween(Window.unboundedPreceding, 0)))
    few = few.filter((F.col("k") <= share) & ((F.col("k") == 1) | (F.col("chars") <= SAMPLE_CHARS // len(languages))))
    got = few.select("lang", "h", "text").mapInArrow(lean(_grams_of), "lang string, h long, i array<int>, c array<float>").toArrow()  # the bounded sample
    i, c, lang = _lists(got.column("i")), _lists(got.column("c")), got.column("lang").to_pylist()
    order = sorted(range(len(lang)), key=lambda k: (lang[k], got.column("h")[k].as_py(), len(i[k]), float(c[k].sum())))
    model = Model(languages, idf, np.zeros((BUCKETS + 1, len(languages))), 1.0, common)
    x, shares = [], []
    for k in order:
        counts_ = np.zeros(BUCKETS)
        counts_[i[k]] = c[k]
        at, v = model.features(counts_)
        x.append((at.astype(np.int32), v))
        shares.append(model.share(counts_))
    y = np.array([languages.index(lang[k]) for k in order])
    del got, i, c, sums  # the driver has the features now
    kept_back = np.random.default_rng(5).random(len(x)) < CALIBRATION
    fit = np.flatnonzero(~kept_back)
    model.weights = fit_ftrl([x[k] for k in fit], y[fit], len(languages))
    back = np.flatnonzero(kept_back)
    logits = np.array([x[k][1] @ model.weights[x[k][0]] + model.weights[-1] for k in back]).reshape(len(back), len(languages))
    model.temperature = fit_temperature(logits, y[back])
    if len(back) >= LEAST_CALIBRATION:
        model.least_support = FOREIGN_SUPPORT * float(np.median(logits.max(1)))
        model.least_share = float(np.quantile(np.array(shares)[back], FOREIGN_QUANTILE))
        model.least_short = SHORT_SHARE
    del x, shares
    trim()  # the driver's later stages need what the sample took
    return model


def predict(docs: DataFrame, model: Model, passed: list[str], lang: str = "lang_pred", score: str = "score", accepted: str = "accepted") -> DataFrame:
    """``passed`` columns of ``docs``, and columns ``lang``, ``score`` and ``accepted`` for every row, from the whole text.

    Null texts, texts without a letter, and every text if the model knows no language, are UNKNOWN with score 0
    and not accepted.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            names, scores, known = [], [], []
            for t in b.column(at):
                text = t.as_py()
                if m.languages and has_letter(text):
                    p, ok = m.scores(text)
                    k = int(p.argmax())
                    names.append(m.languages[k])
                    scores.append(float(p[k]))
                    known.append(ok)
                else:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    known.append(False)
            yield pa.record_batch([*b.columns[: len(passed)], pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(known, pa.bool_())], [*passed, lang, score, accepted])

    more = [] if "text" in passed else ["text"]
    at = [*passed, *more].index("text")
    given = docs.select(*[F.col(f"`{c}`") for c in [*passed, *more]])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[: len(passed)])
    return given.mapInArrow(lean(run), schema + f", `{lang}` string, `{score}` double, `{accepted}` boolean")


def held_out(id_column: str = "doc_id"):
    """Whether crc32 of the id as text leaves 2 when divided by 4; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, accepted) per row of ``docs`` (doc_id, text, lang): learnt from rows not held out.

    A null text, an empty one and one without a letter are UNKNOWN with score 0; a null lang is not learnt
    from but counts for document frequencies; a null doc_id is not held out. Texts of any length are read whole, in
    parts that change no count. Repeated rows give equal rows; ties in the sample's order are settled by id
    and text. An empty table gives an empty one, and so does a table without any lang but UNKNOWN. Other
    columns, whatever their names, are not read.
    """
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out())
    model = train(rows.filter("not held_out"), sample)
    return predict(rows, model, ["doc_id", "held_out"])


def in_known_language(docs: DataFrame, languages: list[str] | None = None, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose text is accepted (and predicted to be in one of ``languages``, where given), all columns
    as they are but ``lang``, which is the prediction where it was null.

    Rows without a letter and foreign ones go (see the module's docstring for what is foreign and for short
    texts). Nulls, long texts, repeats, empty tables and clashing names: as in ``identify``; the
    columns that the stage adds take free names and are dropped again.
    """
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out())
    model = train(rows.filter("not held_out"), sample)
    lang, score, accepted = free_name("lang_pred", docs.columns), free_name("score", docs.columns), free_name("accepted", docs.columns)
    marked = predict(docs, model, docs.columns, lang, score, accepted).filter(F.col(accepted))
    if languages is not None:
        marked = marked.filter(F.col(lang).isin(languages))
    return marked.withColumn("lang", F.coalesce(F.col("lang"), F.col(lang))).select(*[F.col(f"`{c}`") for c in docs.columns])
