"""The cascade, categories of unmatched words, scoped matching, views, the stream."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from loomtext.functions import georgian
from loomtext.operators import catalogue, growth, lookup, match, oov
from loomtext.streaming import annotate


@pytest.fixture(scope="module")
def lookups(spark):
    stop = spark.createDataFrame([("და",), ("s",)], "word string")
    auth = spark.createDataFrame([("n", "p1", "king", "N", "person"), ("l", "l1", "", "L", "place")], "key string, xml_id string, type string, main_ka string, entity string")
    a = spark.createDataFrame([("s", "a1", "sa", "x" * 200, "A", True), ("k", "a2", "ka", "d", "A", False)], "key string, xml_id string, lemma string, def_ka string, source string, in_lexicon boolean")
    b = spark.createDataFrame([("K", "b1", "kb", "d", "B", False), ("m", "b2", "mb", "d", "B", False)], "key string, xml_id string, lemma string, def_ka string, source_id string, in_lexicon boolean")
    return stop, auth, a, b


def test_cascade(spark, lookups):
    words = spark.createDataFrame([("s", "s"), ("K", "k"), ("J", "k"), ("N", "n"), ("l", "l"), ("M", "m"), ("q", "q"), ("q", "q"), ("", "")], "surface string, norm string")
    got = {r.surface: (r.match_tier, r.match_id, r.confidence, r.match_source) for r in match.match_types(words, *lookups).collect()}
    assert got == {
        "s": ("stopword", "", "stopword", "stopwords"), "K": ("master", "b1", "exact", "B"), "J": ("primary", "a2", "norm", "A"), "N": ("authority", "p1", "exact", "authority/person"),
        "l": ("authority", "l1", "exact", "authority/place"), "M": ("master", "b2", "norm", "B"), "q": ("none", "", "none", ""), "": ("none", "", "none", ""),
    }
    every = match.match_tokens(words, *lookups)
    assert every.count() == 9
    assert tuple(match.text_coverage(every.withColumn("text_id", F.lit("t"))).first()) == ("t", 9, 5, 0)
    assert match.match_types(words.limit(0), *lookups).count() == 0


def test_authority_keys_last_wins(spark):
    people = spark.createDataFrame([("p1", "t", "A", ["ჳ", "x"], 1), ("p2", "t", "B", ["x"], 2)], "xml_id string, type string, main_ka string, variants array<string>, ord int")
    places = spark.createDataFrame([("l1", "t", "C", ["ვ"], 0)], "xml_id string, type string, main_ka string, variants array<string>, ord int")
    assert {r.key: r.xml_id for r in match.authority_keys(people, places).collect()} == {"ჳ": "p1", "ვ": "l1", "x": "p2"}


@pytest.mark.parametrize(
    "freq,df,surface,kind",
    [(10, 18, "q", "FUNCTION"), (10, 17, "q", "RARE"), (5, 15, "q", "REVIEW"), (3, 5, "q", "REVIEW"), (3, 6, "q", "RARE"), (2, 1, "q", "RARE"), (3, 6, "მიqებ", "VERB"), (5, 5, "თქუენგან", "FUNCTION")],
)
def test_categories(spark, freq, df, surface, kind):
    one = spark.createDataFrame([(surface, surface, freq, df)], "surface string, norm string, freq int, text_count int")
    assert oov.categorised(one, spark.createDataFrame([(54,)], "n_texts int")).first().category == kind


def test_types_and_order(spark):
    w = spark.createDataFrame([("a", "n1", "t1", 1), ("a", "n2", "t2", 2), ("b", "n", "t1", 3)], "surface string, norm string, text_id string, k int")
    got = {r.surface: r for r in oov.types(w, order="k", with_texts=True).collect()}
    assert (got["a"].freq, got["a"].text_count, got["a"].norm, got["a"].texts) == (2, 2, "n2", ["t1", "t2"])
    kinds = spark.createDataFrame([("a", 1, "RARE", 1), ("b", 9, "REVIEW", 2), ("c", 9, "REVIEW", 1), ("d", 5, "VERB", 1)], "surface string, freq int, category string, first_seen int")
    assert [r.surface for r in oov.ordered(kinds).collect()] == ["c", "b", "d", "a"]


def test_spans_need_no_shuffle(spark):
    from loomtext.operators import tokens

    text = "ab, c  " * 700 + "é𝄞x"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, " ... "), (5, "x")], "id int, text string")
    out = tokens.spans(df, ["id"])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    rows = [r for r in out.collect() if r.id == 1]
    assert [r.k for r in sorted(rows, key=lambda r: r.char_start)] == list(range(1402)) and all(text[r.char_start : r.char_end] == r.surface for r in rows)
    assert {r.id for r in out.collect()} == {1, 5}


def test_caps_count_all(spark):
    from loomtext.operators import attest

    df = spark.createDataFrame([("a", k) for k in range(12)] + [("b", 1)], "t string, k int")
    out = attest.capped(df, "t", ["k"], 5)
    assert {(r.t, r.k, r.nth, r.more) for r in out.collect()} == {("a", k, k + 1, 7) for k in range(5)} | {("b", 1, 1, 0)}
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_scoped_match(spark):
    ranges = spark.createDataFrame([("A", 3, 7, 0), ("B", 7, 9, 1), ("C", 20, None, 2)], "text_id string, from int, to int, ord int")
    pages = match.page_texts(ranges)
    assert {r.page: r.text_id for r in pages.collect()} == {3: "A", 4: "A", 5: "A", 6: "A", 7: "A", 8: "B", 9: "B", 20: "C"}
    entries = spark.createDataFrame([("e1", 1, ["დავით"], "დავით", [3, 4]), ("e2", 2, ["დავითს", "ჱლია"], "ჱლია", [8, 3])], "xml_id string, ord int, forms array<string>, base string, pages array<int>")
    scoped = match.scope(entries, pages)
    assert scoped.count() == 3
    words = spark.createDataFrame([("A", "დავითს"), ("A", "დავითისა"), ("A", "ელია"), ("B", "დავით"), ("B", "დავითს")], "text_id string, surface string")
    got = {(r.text_id, r.surface): (r.id, r.tier) for r in match.scoped_match(words, scoped, georgian.NAME_ENDINGS, 3).collect()}
    assert got == {("A", "დავითს"): ("e2", 0), ("A", "დავითისა"): ("e1", 2), ("A", "ელია"): ("e2", 1), ("B", "დავითს"): ("e2", 0)}
    carry = spark.createDataFrame([("დავით", "c")], "surface string, id string")
    m = match.scoped_match(words, scoped, georgian.NAME_ENDINGS, 3)
    assert {r.surface: r.id for r in match.carried_over(words, m, carry).filter("text_id = 'B'").collect()} == {"დავით": "c", "დავითს": "e2"}
    assert match.covered(m, carry).count() == 3


def test_views(spark):
    rows = spark.createDataFrame([("a", "noun", "d1", "Alpha", "x"), ("b", "verb", "d2", "Beta", "alpha")], "id string, pos string, source_group string, lemma string, body string")
    assert [r.id for r in catalogue.facets(rows, [], "all", "ALPHA").collect()] == ["a", "b"]
    assert [r.id for r in catalogue.facets(rows, ["verb"], "all", "").collect()] == ["b"] and catalogue.facets(rows, [], "d1", "beta").count() == 0
    shown, sections = catalogue.searched(rows.withColumnRenamed("pos", "genre").withColumnRenamed("lemma", "label"), ["noun"], "", "source_group")
    assert shown.count() == 1 and sections.collect() == [("d1",)]
    both, _ = catalogue.searched(rows.withColumnRenamed("pos", "genre").withColumnRenamed("lemma", "label"), ["noun"], "", "source_group", thematic=True)
    assert both.count() == 2
    s = catalogue.sections(spark.createDataFrame([("d1",), ("d3",)], "source_group string"), rows.withColumn("at", F.lit(1)), "source_group", F.col("id"), "at")
    assert [(r.source_group, r["items"]) for r in s.collect()] == [("d1", ["a"])]


def test_stream_equals_batch(spark, lookups, tmp_path):
    src = str(tmp_path / "in")
    spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS ts, 'K q s' AS text UNION ALL SELECT timestamp'2024-01-01 00:20:00', 'J q' UNION ALL SELECT timestamp'2024-01-01 09:00:00', 'q'").write.parquet(src)
    found = annotate.matched(annotate.arriving(spark, src, "ts timestamp, text string"), ["ts"], *lookups)
    q = annotate.write(annotate.tier_windows(found, "ts", "1 hour", "10 minutes"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = {(r.match_tier, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {("master", 1), ("none", 3), ("stopword", 1)}


def test_second_lookup_moves_keys_without_their_entries(spark):
    words = [f"w{i}" for i in range(300)]
    entries = spark.createDataFrame([("b1", "one", [*words, "Taken"], 1), ("b2", "two", ["w0", "Own"], 2)], "xml_id string, lemma string, forms array<string>, ord long")
    primary = spark.createDataFrame([("taken", "a1")], "key string, xml_id string")
    out = lookup.secondary_lookup(entries, primary, spark.createDataFrame([("b2",)], "xml_id string"), F.lower)
    got = {r.key: r for r in out.collect()}
    assert len(got) == 303 and "taken" not in got
    assert (got["w0"].xml_id, got["w0"].variants, got["w0"].in_primary, got["w0"].in_lexicon) == ("b2", ["w0", "Own"], False, True)
    assert (got["w1"].xml_id, len(got["w1"].variants), got["w1"].in_primary, got["w1"].in_lexicon) == ("b1", 301, True, False)
    # where the variants aren't asked for, no exchange carries them
    text = out.select("key", "xml_id", "in_primary")._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    moved = [line for block in text.split("\n\n") if re.match(r"\(\d+\) (Exchange|BroadcastExchange|Window|Sort)\b", block) for line in block.splitlines() if line.startswith("Input")]
    assert moved and not any("forms" in line or "variants" in line for line in moved)


@pytest.mark.parametrize("most", [1, 100])
def test_only_words_that_meet_a_key_are_shuffled(spark, most):
    words = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, None), (3, "c")], "doc_id long, surface string")
    keys = spark.createDataFrame([("a", "x"), ("c", "y"), ("d", "z")], "surface string, target_id string")
    out = lookup.meeting(words, keys, "surface", most)
    assert sorted((r.doc_id, r.surface, r.target_id) for r in out.collect()) == [(1, "a", "x"), (2, "a", "x"), (3, "c", "y")]
    hinted = out._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in hinted) == (most == 100)


def test_coverage_matches_its_types_once(spark, tmp_path):
    spark.createDataFrame([("none", 3), ("primary", 1), ("none", 4)], "match_tier string, n long").write.parquet(str(tmp_path / "t"))
    out = match.tier_coverage(spark.read.parquet(str(tmp_path / "t")))
    assert sorted((r.match_tier, r.tokens, r.share) for r in out.collect()) == [("none", 7, 87.5), ("primary", 1, 12.5)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_types_are_judged_before_they_meet_their_words(spark):
    one = lambda *x: ("primary", "exact", "0", *x)
    types = spark.createDataFrame([("a", *one("a1", "item")), ("b", *one("a2", "item")), ("c", *one("a3", "x")), ("d", "none", "none", "0", "", "")], "surface string, match_tier string, confidence string, in_lexicon string, match_id string, match_lemma string")
    out = growth.eligible(types, spark.createDataFrame([("a2",)], "xml_id string"))
    assert [r.surface for r in out.collect()] == ["a"]
