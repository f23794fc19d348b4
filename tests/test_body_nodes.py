"""Text bodies from nodes that come with their texts, against those of the node table."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.operators import pages, render
from loomtext.plans import trees
from loomtext.sources import markup

BODY = """<x><front><note>f</note></front><text><body><p xml:id="out">o</p><div type="text"><head>H<lb/>h<note>n<lb/>m</note></head><p xml:id="p1" n="1">a<app><lem>l<hi>m</hi>&lt;</lem>t<lem>second</lem><rdg>r</rdg></app>
 <w lemma="#k">w<note>in <w>deep</w></note></w> 'b' &amp; "c"<app><rdg>none</rdg></app></p><ab>not named</ab><trailer>T<lb/></trailer></div></body></text></x>"""
DOCS = [("a", BODY), ("b", "<x><body><p xml:id='p'>no part</p></body></x>"), ("c", "<x"), ("d", None), ("e", "<x><body><div type='text'><pb n='1'/>t</div></body></x>")]


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_same_pages_as_from_the_node_table(spark):
    docs = spark.createDataFrame(DOCS, "doc string, text string")
    want = {r.doc: r.html for r in pages.text_bodies(markup.node_table(docs)).collect()}
    counts = {"ps": (F.col("tag") == "p") & (pages.attr("xml_id") != "")}
    got = {r.doc: (r.html, r.ps) for r in pages.text_bodies(pages.body_nodes(docs), counts=counts).collect()}
    assert {d: h for d, (h, _) in got.items()} == want == {r.doc: r.html for r in render.text_pages(docs).filter("html <> ''").collect()}
    assert got["a"][1] == 2 and got["e"][1] == 0 and set(got) == {"a", "e"}
    assert pages.text_bodies(pages.body_nodes(docs.limit(0)), counts=counts).count() == 0


def test_documents_are_parsed_once_and_not_laid_out(spark, sf_dir):
    text = plan(trees.tei_page_html(spark, sf_dir)).split("== Initial Plan ==")[0]
    assert text.count("MapInArrow") == 1 and "Join" not in text and text.count("collect_list") <= 2
