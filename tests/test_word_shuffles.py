"""Counts, matches and texts of words on odd rows, and what their plans shuffle."""

from __future__ import annotations

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from loomtext.operators import lookup, match, oov, report
from loomtext.plans import base, corpus, orders, stored
from loomtext.sources import tables

DOCS = [(1, "a b a", "en"), (2, "b, C", "de"), (3, None, "en"), (4, "", "en"), (5, "a c", None), (None, "a a z", "en")]


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("more,want", [([], {"a": (5, 2), "b": (2, 2), "C": (1, 1), "c": (1, 1), "z": (1, 0)}), ([(1, "a q", "en")], {"a": (6, 2), "b": (2, 2), "C": (1, 1), "c": (1, 1), "z": (1, 0), "q": (1, 1)})])
def test_types_of_texts_count_ids_once(spark, more, want):
    docs = spark.createDataFrame(DOCS + more, "text_id long, text string, lang string")
    assert {r.surface: (r.freq, r.text_count) for r in oov.text_types(docs).collect()} == want
    words = docs.select("text_id", F.explode(F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1))).alias("surface")).withColumn("norm", F.lower("surface"))
    assert {r.surface: (r.freq, r.text_count) for r in oov.types(words).collect()} == want
    assert oov.text_types(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["oov_types", "oov_categories", "oov_rollup", "match_report", "name_candidates", "token_freq"])
def test_no_pair_of_word_and_text_is_shuffled(spark, sf_dir, name):
    text = plan(getattr(corpus, name)(spark, sf_dir))
    assert "hashpartitioning(surface" in text and "doc_id" not in "".join(x for x in text.splitlines() if "Exchange hashpartitioning(surface" in x)


def test_categories_are_summed_up_in_one_pass(spark):
    read = spark.sparkContext.accumulator(0)

    def touched(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    schema = "category string, freq long"
    found = spark.createDataFrame([("RARE", 1), ("RARE", 2), ("VERB", 7)], schema)
    got = {tuple(r) for r in oov.rollup(found.mapInArrow(touched, schema)).collect()}
    assert got == {("RARE", 2, 3, 30.0), ("VERB", 1, 7, 70.0)} and read.value == 3
    rows = sorted(tuple(r) for r in report.unmatched(found.mapInArrow(touched, schema)).collect())
    assert rows == [(0, "REVIEW", 0, 0, "0.0"), (1, "VERB", 1, 7, "70.0"), (2, "FUNCTION", 0, 0, "0.0"), (3, "RARE", 2, 3, "30.0")] and read.value == 6
    assert oov.rollup(found.limit(0)).count() == 0 and [r.share for r in report.unmatched(found.limit(0)).collect()] == [None] * 4


def test_words_without_own_norm_are_spread(spark):
    stop = spark.createDataFrame([("s",)], "word string")
    auth = spark.createDataFrame([("n", "p1", "t", "N", "person")], "key string, xml_id string, type string, main_ka string, entity string")
    keys = spark.createDataFrame([("k", "a1"), ("w7", "a2")], "key string, xml_id string")
    words = spark.range(4000).select(F.concat(F.lit("w"), "id").alias("surface"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("w"), "id")).alias("norm"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = match.match_types(words, stop, auth, keys, keys.limit(0)).withColumn("part", F.spark_partition_id())
        sizes = [r.n for r in out.groupBy("part").agg(F.count("match_id").alias("n"), F.max("match_tier")).collect()]
        assert max(sizes) < 2000 and sum(sizes) == 4000
        assert [(r.surface, r.match_id, r.confidence) for r in out.filter("match_tier <> 'none'").collect()] == [("w7", "a2", "exact")]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("most", [1, 3, 1_000_000])
def test_coverage_is_the_same_however_many_types_come_often(spark, most):
    words = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (1, "the"), (2, "q"), (None, "b"), (3, "a"), (3, "x")], "text_id long, surface string")
    tiers = {"a": ("primary", "1"), "b": ("master", "0"), "the": ("stopword", "0"), "q": ("none", "0"), "x": ("none", "0")}
    freq = {r.surface: r["count"] for r in words.groupBy("surface").count().collect()}
    types = spark.createDataFrame([(w, freq[w], *t) for w, t in tiers.items()], "surface string, freq long, match_tier string, in_lexicon string")
    got = match.words_coverage(words, types, most=most)
    assert {tuple(r) for r in got.collect()} == {(1, 4, 3, 2), (2, 1, 0, 0), (None, 1, 1, 0), (3, 2, 1, 1)}
    assert {tuple(r) for r in match.text_coverage(words.join(types, "surface")).collect()} == {tuple(r) for r in got.collect()}
    assert types.filter(match.often(types, most=most)).count() < most
    assert match.words_coverage(words.limit(0), types.limit(0)).count() == 0


@pytest.mark.parametrize("most", [1, 100])
def test_types_that_meet_keys(spark, most):
    words = spark.createDataFrame([("A", "a"), ("a", "a"), ("a", "a"), ("b", "b"), ("c", "c")], "surface string, norm string")
    keys = spark.createDataFrame([("a",), ("c",)], "norm string")
    assert sorted((r.surface, r.norm) for r in lookup.types_meeting(words, keys, "norm", most).collect()) == [("A", "a"), ("a", "a"), ("c", "c")]


def test_words_that_meet_no_definition_are_not_shuffled(spark, sf_dir):
    text = plan(stored.definitions_cut(spark, sf_dir))
    assert "BroadcastHashJoin [norm" in text and "LeftSemi" in text


def test_split_sink_is_read_back_compressed(spark, tmp_path):
    df = spark.createDataFrame([("x", "A"), ('a "b"', "B")], "word string, kind string")
    assert {tuple(r) for r in tables.split_sink(df, str(tmp_path / "s"), "kind", {"a": "A"}, "gzip").collect()} == {("all", 2), ("a", 1)}
    assert all(f.endswith(".gz") for _, _, fs in os.walk(tmp_path / "s") for f in fs if f.startswith("part-"))
    assert sorted((r.folder, r.word) for r in tables.read_split(spark, str(tmp_path / "s"), "word string, kind string").collect()) == [("a", "x"), ("all", 'a "b"'), ("all", "x")]


@pytest.mark.parametrize("name", ["oov_text_lists", "text_coverage"])
def test_documents_without_language_and_text(spark, sf_dir, tmp_path, name):
    for t in ("nation", "benchmark", "conversations"):
        os.symlink(f"{sf_dir}/{t}.parquet", tmp_path / f"{t}.parquet")
    docs = [(1, "zzqx the", "en"), (70, "zzqx Zzqy zzqx", "de"), (71, "zzqx zzqz", None), (72, None, "en"), (73, "", "en")]
    spark.createDataFrame([(i, t, c, "src1") for i, t, c in docs], "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    for t in ("nation", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet')")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    query = getattr(orders if name == "oov_text_lists" else corpus, name)
    got = query(spark, str(tmp_path))
    found = con.execute(base.REGISTRY[name][1])
    columns = [c[0] for c in found.description]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()) == sorted(map(repr, found.fetchall()))
