"""Secret scan: pattern candidates, and a random forest that removes false positives.

Candidates are long runs of key-like characters, values assigned to names such as password or token,
and private-key blocks. The forest judges each by length, character transitions, coverage by a dictionary (a fixed
list and the corpus' own most frequent words), the path it was found under and the neighbouring words. It is trained
from labelled findings (text, start, end, path, is_secret): given ones, up to TRAIN_ROWS; or, where nobody has
labelled any, a seeded made-up set of real-looking keys and of look-alikes (digests of commits and files,
identifiers, placeholders, words) and the corpus' own candidates outside the held-out rows, up to CORPUS_ROWS, with
labels by rule where the context leaves no doubt (``plain_label``).
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomtext.llm.held import lean
from loomtext.llm.langid import held_out
from loomtext.llm.staging import smallest_hashes, stage

#: Bounds on labelled findings that the forest is trained on, and on those of them that the corpus gives.
TRAIN_ROWS, CORPUS_ROWS = 20_000, 4_000
#: Bound on the corpus' words in the dictionary, in how many documents each must be, and their letters.
CORPUS_WORDS, WORD_DOCS, WORD_LETTERS = 20_000, 5, (4, 20)
TREES, DEPTH, LEAF = 40, 9, 3

_RUN = re.compile(r"[A-Za-z0-9+/_\-=.]{16,}")
_ASSIGNED = re.compile(r"(?i:passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|credential)s?[\"']?\s{0,3}(?::=|=>|=|:)\s{0,3}[\"']?([^\s\"',;<>]{6,})")
_MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*?PRIVATE KEY(?: BLOCK)?)-----")
#: The body of a key block whose end is missing: header lines, then long lines of a key and a short last one.
_BODY = re.compile(r"(?:\s*+[A-Za-z][A-Za-z0-9\-]*+:[^\n]*+(?:\n|\Z))*+(?:\s*+[A-Za-z0-9+/=]{20,}+)++(?:\s++[A-Za-z0-9+/]{1,19}+={0,2}(?=\s*\Z))?")
#: Public formats of issued keys.
FORMATS = {
    "aws": r"(?:AKIA|ASIA)[0-9A-Z]{16}",
    "github": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "slack": r"xox[abeprs]-[A-Za-z0-9-]{10,}",
    "stripe": r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}",
    "google": r"AIza[0-9A-Za-z_\-]{35}",
    "jwt": r"eyJ[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}\.[A-Za-z0-9_\-]{8,}",
}
_FORMATS = {k: re.compile(p) for k, p in FORMATS.items()}
_ISSUED = re.compile(r"AKIA|ASIA|gh[pousr]_|xox[abeprs]-|[rs]k_(?:live|test)_|AIza|eyJ")  # how they begin
_NEAR_GOOD = re.compile(r"(?i)passw|passwd|pwd|secret|token|api.?key|access.?key|credential|auth|bearer|private|client")
_NEAR_BAD = re.compile(r"(?i)commit|sha\d*|md5|checksum|digest|integrity|hash|uuid|guid|revision|etag|example|sample|dummy|placeholder|build|version|font|image|base64,")
_PATH_BAD = re.compile(r"(?i)test|spec|mock|fixture|example|sample|doc|lock|vendor|node_modules|dist")
_PATH_GOOD = re.compile(r"(?i)\.env|config|secret|settings|credential|deploy|prod|\.ya?ml|\.ini|\.tf")
_FAKE = re.compile(r"(?i)example|your|changeme|placeholder|dummy|sample|insert|replace|redacted|xxxx|\*\*\*|1234567|abcdef|password|\$\{|%\(|<")
_UUID = re.compile(r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\Z")
#: Words that identifiers, paths and placeholders are made of.
WORDS = (
    "the and for with from this that user name data file list item page view model value index count total size type node test main base core util helper manager "
    "service controller factory builder handler request response client server config option setting default module package import export function class object string "
    "number array token secret password key public private static final return update delete create insert select where order group table column row field schema query "
    "image button style color width height margin padding border content container wrapper header footer menu link text label input form example sample dummy your here"
).split()


class Dictionary:
    """Words of four letters or more, in lower case, and how much of a string they cover."""

    def __init__(self, words: Iterable[str] = ()) -> None:
        self.words = sorted({w for w in (*WORDS, *words) if len(w) > 3})
        self._found = None

    def __getstate__(self) -> dict:
        return {"words": self.words, "_found": None}

    def share(self, low: str) -> float:
        """The share of the code points of a lower-case string that are in some word."""
        if self._found is None:
            self._found = ahocorasick.Automaton()
            for w in self.words:
                self._found.add_word(w, len(w))
            self._found.make_automaton()
        covered = till = 0
        # matches come by their ends; of those with one end the longest reaches furthest back
        ends: dict[int, int] = {}
        for end, n in self._found.iter(low):
            ends[end] = max(n, ends.get(end, 0))
        spans = sorted((end + 1 - n, end + 1) for end, n in ends.items())
        for a, b in spans:
            if b > till:
                covered += b - max(a, till)
                till = b
        return covered / max(1, len(low))


_PLAIN_WORDS = Dictionary()


def key_blocks(text: str) -> list[tuple[int, int, str]]:
    """Private-key blocks from BEGIN to END, whatever is between; without an END as far as the key goes on."""
    marks = list(_MARK.finditer(text)) if "-----BEGIN" in text else []
    out = []
    for m, after in zip(marks, [*marks, None][1:], strict=True):
        if m[1] != "BEGIN":
            continue
        if after and after[1] == "END" and after[2] == m[2]:
            if len(text[m.end() : after.start()].strip()) >= 20:
                out.append((m.start(), after.end(), "private-key"))
        elif body := _BODY.match(text, m.end(), after.start() if after else len(text)):
            out.append((m.start(), body.end(), "private-key"))
    return out


def issued(run: str) -> list[tuple[int, int, str]]:
    """Every key of a public format in a run. One joined to the next ends where that begins, if it is whole by then."""
    found = []
    for m in _ISSUED.finditer(run):
        rule = next((k for k, p in _FORMATS.items() if p.match(run, m.start())), None)
        if rule:
            found.append((m.start(), rule))
    out: list[tuple[int, int, str]] = []
    for (a, rule), after in zip(found, [*(f[0] for f in found), len(run)][1:], strict=True):
        if not out or a >= out[-1][1]:
            hit = _FORMATS[rule].match(run, a, after) or _FORMATS[rule].match(run, a)
            out.append((a, hit.end(), rule))
    return out


def _worth(run: str) -> bool:
    return len(run) >= 16 and ((any(map(str.isdigit, run)) and any(map(str.isalpha, run))) or len(run) >= 24 and len(set(run)) > 2)


def _rest(text: str, a: int, b: int, hits: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """What of text[a:b] is not in ``hits`` (in order), without signs at its ends."""
    out = []
    for at, to in zip([a, *(h[1] for h in hits)], [*(h[0] for h in hits), b], strict=True):
        part = text[at:to]
        at += len(part) - len(part.lstrip(".=-_/+"))
        out.append((at, at + len(part.strip(".=-_/+"))))
    return out


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, rule) of the candidates of a text in code points, longest first where they overlap.

    A run or an assigned value that holds issued keys gives each of them, and what is left of it.
    """
    found = key_blocks(text)
    runs = []
    for m in _RUN.finditer(text):
        a, b = m.span()
        hits = [(a + s, a + e, k) for s, e, k in issued(m[0])]
        runs += hits
        if hits:
            found += [(s, e, "run") for s, e in _rest(text, a, b, hits) if _worth(text[s:e])]
        else:
            run = m[0].rstrip(".=-_/") or m[0]
            if _worth(run):
                found.append((a, a + len(run), "run"))
    at = 0
    for m in _ASSIGNED.finditer(text):
        a, b = m.span(1)
        while at < len(runs) and runs[at][1] <= a:
            at += 1
        inside = []
        for h in runs[at:]:
            if h[0] >= b:
                break
            if a <= h[0] and h[1] <= b and (h[0], h[1]) != (a, b):
                inside.append(h)
        found += [(s, e, "assigned") for s, e in _rest(text, a, b, inside) if e - s >= 6] if inside else [(a, b, "assigned")]
    order = {"private-key": 0, "assigned": 1, "run": 3}
    found = sorted(found + runs, key=lambda f: (f[0], -f[1], order.get(f[2], 2)))
    out: list[tuple[int, int, str]] = []
    for f in found:
        if not out or f[0] >= out[-1][1]:
            out.append(f)
        elif out[-1][2] == "run" and f[2] != "run":
            head, end = out[-1][0], max(f[1], out[-1][1])
            (left,) = _rest(text, head, f[0], [])
            out[-1:] = [(*left, "run")] * _worth(text[slice(*left)]) + [(f[0], end, f[2])]
        else:
            out[-1] = (out[-1][0], max(f[1], out[-1][1]), out[-1][2])
    return out


def describe(text: str, start: int, end: int, path: str | None, words: Dictionary = _PLAIN_WORDS) -> list[float]:
    """The forest's features of a candidate."""
    s = text[start:end]
    n = len(s)
    kinds = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)
    cls = np.where((kinds >= 48) & (kinds <= 57), 0, np.where((kinds >= 97) & (kinds <= 122), 1, np.where((kinds >= 65) & (kinds <= 90), 2, 3)))
    turns = np.bincount(cls[:-1] * 4 + cls[1:], minlength=16) / max(1, n - 1) if n > 1 else np.zeros(16)
    share = np.bincount(cls, minlength=4) / max(1, n)
    _, counts = np.unique(kinds, return_counts=True)
    p = counts / max(1, n)
    low = s.lower()
    covered = words.share(low)
    vowels = sum(map(low.count, "aeiou")) / max(1, share[1] * n + share[2] * n)
    before, after = text[max(0, start - 48) : start], text[end : end + 32]
    path = path or ""
    return [
        n, *share, float((cls[:-1] != cls[1:]).mean()) if n > 1 else 0.0, turns[1], turns[4], turns[5], turns[6], turns[9],
        float(-(p * np.log2(p)).sum()), len(counts) / max(1, n), covered, vowels, float(all(c in "0123456789abcdef" for c in low)),
        float(n in (32, 40, 64, 128)), float(bool(_UUID.match(s))), float(bool(_FAKE.search(s))), float(any(f.search(s) for f in _FORMATS.values()) or s.startswith("-----BEGIN")),
        float(bool(_NEAR_GOOD.search(before))), float(bool(_NEAR_BAD.search(before)) or bool(_NEAR_BAD.search(after))), float(before.rstrip(" \"'")[-1:] in ("=", ":")),
        float(bool(_PATH_BAD.search(path))), float(bool(_PATH_GOOD.search(path))), s.count("/") + s.count("."),
    ]


def plain_label(text: str, start: int, end: int, rule: str) -> int | None:
    """1 for key blocks, issued keys and key-like values that are assigned to a secret's name; 0 for placeholders, for UUIDs,
    and for runs that nothing assigns and no secret's name precedes; None where the context leaves a doubt."""
    value, before = text[start:end], text[max(0, start - 48) : start]
    if _FAKE.search(value) or _UUID.match(value):
        return 0
    if rule not in ("run", "assigned"):
        return 1
    mixed = any(map(str.isdigit, value)) and any(map(str.isalpha, value))
    if rule == "assigned":
        return 1 if len(value) >= 16 and mixed and len(set(value)) >= 10 else None
    return None if _NEAR_GOOD.search(before) or before.rstrip(" \"'")[-1:] in ("=", ":") else 0


def frequent_words(docs: DataFrame, most: int = CORPUS_WORDS) -> list[str]:
    """The words of ``docs`` that are in the most documents (WORD_DOCS at least), ``most`` at most: counted over all of them.
    A histogram of the counts tells from which count on words are few enough, so no more than those leave the tasks."""
    low, high = WORD_LETTERS
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(rf"(?<!\p{{L}})\p{{L}}{{{low},{high}}}(?!\p{{L}})"), F.lit(0)))
    counts = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= WORD_DOCS)
    counts = stage(counts.withColumn("size", F.floor(16 * F.log2("n"))), "word-counts")
    total, least = 0, None
    for r in sorted(counts.groupBy("size").agg(F.count("*").alias("words")).collect(), reverse=True):  # 16 rows a doubling
        total += r.words
        if total > most:
            break
        least = r["size"]
    return sorted(r.word for r in counts.filter(F.col("size") >= least).collect()) if least is not None else []


def corpus_findings(docs: DataFrame, words: Dictionary, path: str = "source", rows: int = CORPUS_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of about ``rows`` of the candidates that have a plain label, those with the smallest hashes."""
    shared = docs.sparkSession.sparkContext.broadcast(words)  # CORPUS_WORDS words at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hs, ys, xs = [], [], []
            for t, p in zip(b.column(0), b.column(1), strict=True):
                text = t.as_py()
                for s, e, rule in candidates(text):
                    y = plain_label(text, s, e, rule)
                    if y is not None:
                        digest = hashlib.sha256(text[max(0, s - 48) : e + 32].encode("utf-8", "surrogatepass")).digest()
                        hs.append(int.from_bytes(digest[:8], "little", signed=True))
                        ys.append(y)
                        xs.append(describe(text, s, e, p.as_py(), shared.value))
            if hs:
                yield pa.record_batch([pa.array(hs, pa.int64()), pa.array(ys, pa.int32()), pa.array(xs, pa.list_(pa.float64()))], ["h", "y", "x"])

    given = docs.filter("text is not null").select("text", _path(docs, path))
    found = stage(given.mapInArrow(lean(run), "h long, y int, x array<double>").dropDuplicates(["h"]), "labelled-findings")
    found = smallest_hashes(found, rows).toArrow().sort_by("h")
    x = [r.as_py() for r in found.column("x")]
    return np.array(x).reshape(len(x), -1), found.column("y").to_numpy().astype(float)


def _path(docs: DataFrame, path: str):
    return (F.col(f"`{path}`").cast("string") if path in docs.columns else F.lit(None).cast("string")).alias("path")


def made_findings(rows: int = 3000, seed: int = 9) -> list[tuple[str, int, int, str, int]]:
    """Labelled findings from a seeded generator: (text, start, end, path, is_secret)."""
    r = random.Random(seed)
    hexa, alnum = "0123456789abcdef", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    some = lambda abc, n: "".join(r.choices(abc, k=n))
    word = lambda: r.choice(WORDS) if r.random() < 0.5 else some("aeinorstlmdu", r.randint(2, 9))
    paths = ["src/app.py", "config/settings.yml", ".env", "deploy/prod.tf", "tests/test_app.py", "docs/example.md", "package-lock.json", "src3", "", "web/main.js"]
    good_names = ["token", "secret", "password", "api_key", "API-KEY", "access_key", "client_secret", "auth_token", "Authorization: Bearer", "aws_secret_access_key"]
    bad_names = ["commit", "sha256", "md5", "checksum", "integrity", "digest", "etag", "uuid", "revision", "id", "image", "build"]
    good = [
        lambda: some(hexa, r.choice([32, 40, 40, 48, 64])), lambda: some(alnum, r.randint(20, 48)), lambda: "AKIA" + some(alnum[:10] + alnum[36:], 16),
        lambda: "ghp_" + some(alnum, 36), lambda: "sk_live_" + some(alnum, 24), lambda: "xoxb-" + some("0123456789", 12) + "-" + some(alnum, 24),
        lambda: "AIza" + some(alnum + "_-", 35), lambda: f"eyJ{some(alnum, 20)}.eyJ{some(alnum, 40)}.{some(alnum + '_-', 43)}", lambda: some(alnum + "!@#%^&*", r.randint(10, 20)),
    ]
    uuid = lambda: "-".join(some(hexa, k) for k in (8, 4, 4, 4, 12))
    bad = [
        lambda: some(hexa, r.choice([32, 40, 64])), uuid, lambda: "_".join(word() for _ in range(r.randint(3, 6))), lambda: "".join(word().title() for _ in range(r.randint(3, 6))),
        lambda: "/".join(word() for _ in range(r.randint(3, 6))) + ".html", lambda: "your_" + r.choice(["api_key", "token", "password"]) + "_here", lambda: "x" * r.randint(8, 32),
        lambda: some("0123456789", r.randint(16, 22)), lambda: "EXAMPLE" + some(alnum, 12), lambda: f"{word()}-{r.randint(1, 20)}.{r.randint(0, 20)}.{r.randint(0, 99)}-{word()}-{word()}",
        lambda: "-" * r.randint(16, 40), lambda: f"${{{word().upper()}_{word().upper()}}}",
    ]
    out = []
    for k in range(rows):
        secret = k % 2
        value = r.choice(good)() if secret else r.choice(bad)()
        looks_issued = any(f.search(value) for f in _FORMATS.values())
        if secret:
            name = r.choice(good_names) + r.choice([" = ", "=", ": ", ' = "', "='"]) if not looks_issued or r.random() < 0.6 else ""
        elif re.fullmatch("[0-9a-f]{32,}", value):
            name = r.choice(bad_names) + r.choice([" = ", "=", ": ", " ", '="'])
        else:
            name = r.choice(bad_names + good_names[:4] * ("EXAMPLE" in value or "your_" in value or "$" in value or "xx" in value) + ["", word()]) + r.choice([" = ", ": ", " ", "/"])
        lead = " ".join(word() for _ in range(r.randint(0, 6))) + " " + name
        out.append((lead + value + r.choice(['" ', " ", "\n", "' "]) + " ".join(word() for _ in range(r.randint(0, 5))), len(lead), len(lead) + len(value), r.choice(paths), secret))
    return out


class Forest:
    """Trees grown on bootstrap rows with a random subset of features at each split, Gini impurity."""

    def __init__(self, trees: list[list[tuple]]) -> None:
        self.trees = [tuple(map(np.array, zip(*t, strict=True))) for t in trees]
        self.words = _PLAIN_WORDS

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, left, right, value in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(DEPTH + 1):
                inner = feature[at] >= 0
                if not inner.any():
                    break
                step = np.where(x[rows, np.maximum(feature[at], 0)] <= cut[at], left[at], right[at])
                at = np.where(inner, step, at)
            total += value[at]
        return total / max(1, len(self.trees))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, seed: int = 7) -> Forest:
    rng = np.random.default_rng(seed)
    width = max(1, int(np.sqrt(x.shape[1])) + 1)

    def tree() -> list[tuple]:
        nodes: list[tuple] = []
        rows = rng.integers(0, len(x), len(x))

        def node(k: np.ndarray, depth: int) -> int:
            at, mean = len(nodes), float(y[k].mean())
            nodes.append((-1, 0.0, -1, -1, mean))
            if depth == DEPTH or len(k) < 2 * LEAF or mean in (0.0, 1.0):
                return at
            best = (1e-9, -1, 0.0)
            for f in rng.choice(x.shape[1], width, replace=False):
                v = x[k, f]
                for c in np.unique(np.quantile(v, np.linspace(0.05, 0.95, 12))):
                    side = v <= c
                    a = int(side.sum())
                    if a < LEAF or len(k) - a < LEAF:
                        continue
                    p, q = y[k[side]].mean(), y[k[~side]].mean()
                    gain = mean * (1 - mean) - (a * p * (1 - p) + (len(k) - a) * q * (1 - q)) / len(k)
                    if gain > best[0]:
                        best = (gain, int(f), float(c))
            if best[1] < 0:
                return at
            side = x[k, best[1]] <= best[2]
            left, right = node(k[side], depth + 1), node(k[~side], depth + 1)
            nodes[at] = (best[1], best[2], left, right, mean)
            return at

        node(rows, 0)
        return nodes

    return Forest([tree() for _ in range(trees)])


def train(spark: SparkSession | None = None, labelled: DataFrame | None = None, rows: int = TRAIN_ROWS, docs: DataFrame | None = None, path: str = "source") -> Forest:
    """A forest from ``labelled`` (text, start, end, path, is_secret), of which about the ``rows`` with the smallest hashes
    are used; where none are given or they are all of one kind, from ``made_findings`` and what ``docs`` (doc_id, text
    and a column of paths) gives outside its held-out rows. The dictionary has the frequent words of ``docs``."""
    words = Dictionary(frequent_words(docs)) if docs is not None else _PLAIN_WORDS
    given = []
    if labelled is not None:
        few = smallest_hashes(labelled.filter("text is not null and is_secret is not null").withColumn("h", F.xxhash64("text", "start", "end")), rows)
        given = sorted((r.text, r.start, r.end, r.path, int(r.is_secret)) for r in few.select("text", "start", "end", F.coalesce("path", F.lit("")).alias("path"), "is_secret").collect())
    found = given if len({g[4] for g in given}) == 2 else made_findings()
    x, y = np.array([describe(*f[:4], words) for f in found]), np.array([f[4] for f in found], float)
    if found is not given and docs is not None:
        more, labels = corpus_findings(docs.filter(~held_out()), words, path)
        if len(more):
            x, y = np.concatenate([x, more]), np.concatenate([y, labels])
    forest = grow(x, y)
    forest.words = words
    return forest


def scan(docs: DataFrame, forest: Forest, path: str = "source", least: float = 0.5) -> DataFrame:
    """One row per candidate of each row's whole text: doc_id, start, end (code points), rule, secret_sha256, probability, is_secret.

    The secret itself is not returned. Null and empty texts have no candidate; a null path counts as
    empty; rows that repeat give their findings each. Of overlapping candidates a rule's beats a plain run.
    Texts of any length are read whole; an empty table gives an empty one; columns other than doc_id, text and
    the path, whatever their names, are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(forest)  # TREES trees of at most 2**(DEPTH + 1) nodes, CORPUS_WORDS words
    names = ["doc_id", "start", "end", "rule", "secret_sha256", "probability", "is_secret"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, x = [], []
            for k, (t, p) in enumerate(zip(b.column(1), b.column(2), strict=True)):
                text = t.as_py() or ""
                for s, e, rule in candidates(text):
                    rows.append((k, s, e, rule, hashlib.sha256(text[s:e].encode("utf-8", "surrogatepass")).hexdigest()))
                    x.append(describe(text, s, e, p.as_py(), shared.value.words))
            if rows:
                c = list(zip(*rows, strict=True))
                q = shared.value.probability(np.array(x))
                yield pa.record_batch([b.column(0).take(pa.array(c[0])), pa.array(c[1], pa.int64()), pa.array(c[2], pa.int64()), pa.array(c[3], pa.string()), pa.array(c[4], pa.string()), pa.array(q, pa.float64()), pa.array(q >= least)], names)

    rows = docs.select("doc_id", "text", _path(docs, path))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"doc_id {kind}, start long, end long, rule string, secret_sha256 string, probability double, is_secret boolean")
