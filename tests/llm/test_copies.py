"""op2, op3, op7: near copies, exact copies, fingerprints, against brute force and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loomtext.llm import digest_merge, shingle_overlap, simhash_trie, simhash_votes
from loomtext.llm.components import components
from loomtext.llm.staging import join_counted

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog", "a", 1), (2, "the QUICK brown fox jumps over the lazy dog", "a", 2), (3, None, "b", 3), (4, "", "b", 4), (5, "  \n\t ", None, 5),
    (6, "Éa b", "c", 6), (7, "éa b", "c", 7), (8, "x", None, None), (8, "x", None, None), (9, "word " * 5000, "d", 9), (None, "x", "n", 0), (None, None, "n", 0), (10, "X", "e", 1),
]
SCHEMA = "doc_id long, text string, fp string, row long"  # names that operators use inside too


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def simhash(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, near):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("text", [r[1] for r in ROWS] + ["a b c", "a b c d", "A\x0bB\x1cc d e", "ünï çode a b c"])
@pytest.mark.parametrize("k", [4, 5])
def test_fingerprint_is_as_defined(text, k):
    assert simhash_trie.fingerprint(text, k) == simhash(text, k)


def test_long_texts_are_taken_in_chunks(monkeypatch):
    text = " ".join(f"w{i * 7919 % 997}" for i in range(3000))
    whole = simhash_trie.fingerprint(text)
    monkeypatch.setattr(simhash_trie, "SHINGLE_CHUNK", 101)
    assert simhash_trie.fingerprint(text) == whole == simhash(text, 4)


@pytest.mark.parametrize("radius", [0, 3, 4, 8])
def test_forest_finds_all_links(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 64, 150, np.uint64)
    near = np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)) for _ in range(4)] + [base[:9] ^ np.uint64(0x1F)])
    r = np.unique(near)
    label = simhash_trie.trie_forest(r, [0], [len(r)], [0], [len(r)], [0], radius)
    assert label.tolist() == groups(r.tolist(), lambda a, b: (a ^ b).bit_count() <= radius)


@pytest.mark.parametrize("node_limit", [20_000, 15])
def test_links_connect_what_all_pairs_connect(spark, node_limit):
    r = random.Random(2)
    base = [r.getrandbits(64) for _ in range(40)]
    fps = {b ^ sum(1 << r.randrange(64) for _ in range(r.randrange(3))) for b in base for _ in range(6)} | {base[0] ^ (1 << i) for i in range(64)}
    fps = sorted(x & (1 << 64) - 1 for x in fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {x: x for x in signed} | {c.node: c.root for c in components(simhash_trie.links(df, 4, node_limit)).collect()}
    same = groups(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    assert len({(got[s], g) for s, g in zip(signed, same, strict=True)}) == len(set(same)) == len(set(got.values()))


@pytest.mark.parametrize("radius,first,node_limit", [(4, 2, 20_000), (4, 3, 5), (0, 1, 20_000), (2, 2, 3)])
def test_tries_of_more_blocks_find_the_same(spark, radius, first, node_limit):
    r = random.Random(radius * 10 + first)
    base = [r.getrandbits(64) for _ in range(25)]
    fps = sorted({b ^ sum(1 << k for k in r.sample(range(64), r.randrange(radius + 1))) for b in base for _ in range(5)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = {x: x for x in signed} | {c.node: c.root for c in components(simhash_trie.links(spark.createDataFrame([(x,) for x in signed], "fp long"), radius, node_limit, first)).collect()}
    same = groups(fps, lambda a, b: (a ^ b).bit_count() <= radius)
    assert len({(got[s], g) for s, g in zip(signed, same, strict=True)}) == len(set(same)) == len(set(got.values()))


def test_blocks_grow_with_the_fingerprints():
    assert [simhash_trie.first_blocks(n, 4) for n in (0, 10**6, 10**8, 10**9, 10**11)] == [1, 1, 2, 2, 3]
    for first in (1, 2, 3):
        for blocks, depth in simhash_trie._tries(4, first):
            assert sorted(blocks) == sorted(set(blocks)) and sum(w for _, w in blocks) == 64 and depth >= 64 * first // (4 + first) - first


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (101, 100)]
    got = {c.node: c.root for c in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_on_awkward_rows(docs, spark):
    got = sorted(map(tuple, simhash_trie.near_duplicates(docs).collect()), key=str)
    ids = [r[0] for r in ROWS]
    fps = [simhash(r[1], 4) for r in ROWS]
    same = groups(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    low = {g: min((i for i, s in zip(ids, same, strict=True) if s == g and i is not None), default=None) for g in same}
    want = sorted(((i, f - (1 << 64) if f >> 63 else f, low[s]) for i, f, s in zip(ids, fps, same, strict=True)), key=str)
    assert got == want
    assert simhash_trie.near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    same = groups([simhash(t, 4) for _, t in rows], lambda a, b: (a ^ b).bit_count() <= 4)
    want = {i: min(j for (j, _), s in zip(rows, same, strict=True) if s == g) for (i, _), g in zip(rows, same, strict=True)}
    assert {r.doc_id: r.component_id for r in simhash_trie.near_duplicates(docs).collect()} == want


def test_one_of_each_keeps_whole_rows(docs):
    kept = simhash_trie.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 1 in ids and 2 not in ids and 4 not in ids and ids.count(None) == 2


def shingle_words(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def overlap(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("table", ["documents", "edits", "awkward"])
def test_near_copies_are_all_pairs_of_the_overlap(spark, sf_dir, docs, table):
    if table == "edits":  # copies of about 0.6 to 1, in sizes from 5 to 300 words, of a vocabulary that gives chance overlaps
        r, rows = random.Random(8), []
        for k in range(60):
            base = [f"w{r.randrange(400)}" for _ in range(r.choice([5, 9, 40, 120, 300]))]
            rows += [(len(rows) + j, " ".join(f"x{r.randrange(9)}" if j and r.random() < 0.03 * (j % 3) else w for w in base[: len(base) - r.randrange(1 + len(base) // 6)])) for j in range(5)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
    elif table == "documents":
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = [shingle_words(t) for _, t in rows]
    same = groups(sets, lambda a, b: overlap(a, b) >= 0.8)
    low = {g: min((i for (i, _), s in zip(rows, same, strict=True) if s == g and i is not None), default=None) for g in same}
    want = sorted(((i, low[s]) for (i, _), s in zip(rows, same, strict=True)), key=str)
    assert sorted(map(tuple, shingle_overlap.near_copies(docs).collect()), key=str) == want
    kept = shingle_overlap.one_of_each(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {low[s] for s in same} | ({None} if table == "awkward" else set())
    assert shingle_overlap.near_copies(docs.limit(0)).count() == 0


def test_pipeline_keeps_strangers_and_drops_copies(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("doc_id in (145, 6, 177, 1, 192, 155)")
    near = dict(corpus_pipeline.STAGES)["near copies"](spark, docs, sf_dir)
    # 145 and 6: overlap 0.833 at 11 bits; 177 and 1: 0.83 at 17 bits; 192 and 155: 0.76 at 4 bits
    assert {r.doc_id for r in near.collect()} == {1, 6, 155, 192}


def test_exact_duplicates(docs):
    got = digest_merge.exact_duplicates(docs, fan_in=2).collect()
    assert len(got) == len(ROWS)
    by = {}
    for i, t, *_ in ROWS:
        by.setdefault(lower(t), []).append(i)
    for g in got:
        same = next(v for k, v in by.items() if hashlib.sha256(k.encode()).hexdigest() == g.text_sha256)
        best = max((x for x in same if x is not None), default=None)
        assert (g.keep_id, g.group_size) == (best, len(same)) and (not g.kept or g.doc_id == best)
    assert sum(g.kept for g in got) == len(by)
    low = digest_merge.exact_duplicates(docs, keep="smallest").filter("kept").collect()
    assert {g.doc_id for g in low} >= {1, 6, 7, 9}
    assert digest_merge.exact_duplicates(docs.limit(0)).count() == 0


def test_distinct_documents_keeps_whole_rows(docs):
    kept = digest_merge.distinct_documents(docs)
    assert kept.columns == docs.columns
    texts = [lower(r.text) for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({lower(r[1]) for r in ROWS})
    assert digest_merge.distinct_documents(docs.filter("doc_id = 6")).collect() == docs.filter("doc_id = 6").collect()


@pytest.mark.parametrize("stage", [digest_merge.distinct_documents, simhash_trie.one_of_each, shingle_overlap.one_of_each])
def test_stages_with_clashing_names(docs, stage):
    names = ["__id", "__sha", "__nth", "__keep", "sid", "n", "low", "prefix", "digest", "kept", "component_id", "h"]
    more = docs.select("doc_id", "text", *[F.lit(n).alias(n) for n in names])
    got, want = stage(more).collect(), stage(docs.select("doc_id", "text")).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(r.doc_id), str(r.text)) for r in want) and all(r["__id"] == "__id" for r in got)


def test_hot_keys_are_joined_whole(spark):
    left = spark.range(5000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id")).alias("k"), "id")
    right = left.groupBy("k").agg(F.count("*").alias("n"))
    assert join_counted(left, right, "k", "n").count() == 5000


def test_fingerprints_tell_edits_from_strangers(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r for r in simhash_votes.edited_likeness(docs).collect()}
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        k = len(t) // 4
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256((t[: len(t) - k] + after[:k]).encode()).hexdigest())
        assert 0 <= got[i].near_next <= 1 and 0 <= got[i].near_edited <= 1
    long = [r for r in got.values() if r.n_chars > 500]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.98
    seen = {}
    for i, t in rows:
        assert seen.setdefault(t, got[i].fp) == got[i].fp


def voted(text):
    """The fingerprint by plain arithmetic: term pairs vote on every bit with their length."""
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text or "") if w]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    terms = set()
    for a, b in zip(words, words[1:], strict=False) if len(words) > 1 else [(w, None) for w in words]:
        h = xxhash.xxh64_intdigest(a.encode(), 42)
        h = xxhash.xxh64_intdigest(b.encode(), h) if b is not None else h
        terms.add(h & ~63 | min(63, len(a) + len(b or "")))
    votes, total = [0] * 64, sum(t & 63 for t in terms)
    for t in terms:
        h = xxhash.xxh64_intdigest(t.to_bytes(8, "little"), 42)
        for k in range(64):
            votes[k] += (h >> k & 1) * (t & 63)
    return signed(sum(1 << k for k in range(64) if 2 * votes[k] > total))


def test_votes_and_search_are_as_brute_force_has_them(spark, sf_dir, docs):
    for df in (spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), docs):
        df = df.unionByName(df.filter("doc_id = 8"), allowMissingColumns=True)
        got = simhash_votes.edited_likeness(df, asked=F.col("doc_id") % 2 == 0, radius=3).collect()
        want = sorted((str(r.doc_id), voted(r.text)) for r in df.collect())
        assert sorted((str(r.doc_id), r.fp) for r in got) == want
        for r in got:
            near = [o.doc_id for o in got if ((r.fp ^ o.fp) & (1 << 64) - 1).bit_count() <= 3]
            if r.doc_id is None or r.doc_id % 2:
                assert r.near_docs is None and r.near_low is None
            else:
                assert r.near_docs == len(near) and r.near_low == min(i for i in near if i is not None)


def test_fingerprints_on_awkward_rows(docs, spark):
    got = simhash_votes.edited_likeness(docs).collect()
    assert len(got) == len(ROWS)
    assert all(r.near_next is None for r in got if r.doc_id is None) and {r.n_chars for r in got if r.doc_id == 9} == {25000}
    assert next(r for r in got if r.doc_id == 3).fp == next(r for r in got if r.doc_id == 4).fp == 0
    assert simhash_votes.edited_likeness(docs.limit(0)).count() == 0


def test_block_tables_miss_nothing(spark):
    r = random.Random(5)
    base = [r.getrandbits(63) for _ in range(60)]
    index = base + [b ^ sum(1 << r.randrange(63) for _ in range(4)) for b in base for _ in range(3)]
    got = {(x.q, x.fp) for x in simhash_votes.within_radius(spark.createDataFrame([(b,) for b in base + base] + [(None,)], "fp long"), spark.createDataFrame([(b,) for b in index], "fp long"), 3, 6).collect()}
    assert got == {(a, b) for a in base for b in index if (a ^ b).bit_count() <= 3}
