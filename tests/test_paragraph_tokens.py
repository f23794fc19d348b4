"""Tokens that stay in their paragraph's row, against those of the shuffled text nodes, and what the plans shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomtext.operators import inject, tokens
from loomtext.plans import stored, tei
from loomtext.sources import tables

TEI = '<TEI xmlns="http://www.tei-c.org/ns/1.0" xml:id="{}"><text><body>{}</body></text></TEI>'
DOCS = [
    ("a", TEI.format("t1", '<p xml:id="p1">აბა <hi rend="initial">Ⴀ</hi>ნა, <!-- c -->ბა<seg>გა <hi>და</hi>ე </seg>ვა<note>არა</note></p><p>no id</p><p xml:id="p2"/><p xml:id="p3">, .</p><p xml:id="p4">-ზა თა</p>')),
    ("b", "<p xml:id='q'>ერთი</p>"), ("c", "<p"), ("d", None), ("e", TEI.format("t2", '<p xml:id="p1">აბა<p xml:id="p2">ბა</p></p>')),
]


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("compat", [False, True])
def test_same_tokens_as_of_shuffled_nodes(spark, compat):
    docs = spark.createDataFrame(DOCS, "doc string, text string")
    want = sorted(map(repr, tokens.tokenise(tokens.text_nodes(docs), compat=compat).collect()))
    assert len(want) > 10 and sorted(map(repr, tokens.tokens_of(docs, compat=compat).collect())) == want
    assert tokens.tokens_of(docs.limit(0)).count() == 0 and tokens.tokens_of(docs.filter("doc = 'd'")).count() == 0


def test_batches_of_texts_are_cut_where_they_may(spark, monkeypatch):
    docs = spark.range(40).select(F.concat(F.lit("d"), "id").alias("doc"), F.concat(F.lit("<x><p xml:id='p'>აბა ბა "), F.repeat(F.lit("გა "), F.col("id").cast("int")), F.lit("</p></x>")).alias("text")).coalesce(1)
    monkeypatch.setattr(tokens, "BATCH_CHARS", 100)
    got = {r.text_id: [(t.k, t.surface, t.char_start) for t in r.tokens] for r in tokens.paragraph_tokens(docs).collect()}
    assert got == {f"d{n}": [(0, "აბა", 0), (1, "ბა", 4), *((2 + k, "გა", 7 + 3 * k) for k in range(n))] for n in range(40)}


def test_whole_documents_keep_their_texts(spark):
    docs = spark.createDataFrame(DOCS, "doc string, text string")
    got = {r.doc: (r.text, [n.text for n in r.nodes]) for r in tokens.node_lists(docs, whole=True).collect()}
    assert {k: v[0] for k, v in got.items()} == {d: t or "" for d, t in DOCS}
    assert got["b"][1] == ["ერთი"] and got["c"][1] == [] == got["d"][1]


def test_no_token_is_shuffled(spark, sf_dir):
    assert "Exchange" not in plan(tei.tei_tokens(spark, sf_dir)) and "Exchange" not in plan(tei.tei_words(spark, sf_dir))


def test_rows_that_share_an_id_are_one_paragraph(spark, tmp_path):
    rows = [(1, "ab cd\n\nx"), (1, "ab cd\n\nx"), (2, None), (3, "q")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.text_id, r.para_id, r.n) for r in tei.tei_tokens(spark, str(tmp_path)).collect())
    assert got == [("d1", "d1-0", 8), ("d1", "d1-2", 4), ("d3", "d3-0", 2)]


@pytest.mark.parametrize("every", [False, True])
def test_known_words_are_tagged_the_same_with_few_and_many_keys(spark, every):
    body = '<p xml:id="p1">ab <hi rend="initial">Ⴀ</hi>cd, <!-- c -->ab<seg>ef <hi>ab</hi>, </seg>ab<note>ab</note></p><p>ab</p><p xml:id="p2">cd &amp; ab</p><!-- z -->'
    docs = spark.createDataFrame([("t1", TEI.format("t1", body)), ("t2", "<p xml:id='q'>zz</p>"), ("t3", "<p"), ("t4", None)], "doc string, text string")
    keys = spark.createDataFrame([("ab", "a1", "primary", "exact"), ("cd", "", "primary", "exact"), ("ef", "e1", "authority", "exact"), (", ", "x", "primary", "exact"), ("zz", "z", "master", "norm")], "surface string, match_id string, match_tier string, confidence string").withColumn("match_source", F.lit("places"))
    few, many = (inject.inject_known(docs, keys, r"\p{L}+", r"[^\p{L}]+", every=every, most=n) for n in (100, 1))
    got = sorted(map(repr, few.collect()))
    assert got == sorted(map(repr, many.collect())) and len(got) == (4 if every else 1)
    made = {r.doc: r for r in few.collect()}["t1"]
    assert (made.tagged, made.skipped, made.written) == (6, 0, True) and made.text.count('<w lemmaRef="#a1">ab</w>') == 5 and '<placeName ref="#e1">ef</placeName>' in made.text
    assert "<p>ab</p>" in made.text and "<note>ab</note>" in made.text


def test_injection_shuffles_neither_words_nor_texts(spark, sf_dir):
    text = plan(tei.tei_inject(spark, sf_dir))
    assert "Exchange" not in text and "Join" not in text


def test_token_file_is_written_without_a_shuffle(spark, sf_dir, monkeypatch):
    written, write = [], tables.write_tsv
    monkeypatch.setattr(tables, "write_tsv", lambda df, *more: (written.append(df._jdf.queryExecution().executedPlan().toString()), write(df, *more)))
    assert stored.token_file(spark, sf_dir).count() == tei.tei_words(spark, sf_dir).count() > 0
    assert len(written) == 1 and "Exchange" not in written[0]
