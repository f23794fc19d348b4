"""Enclosing elements, outlines and pages from node tables, against walks over the parsed trees."""

from __future__ import annotations

import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from loomtext.operators import pages, render, tree
from loomtext.sources import markup


def made(seed: int, tags: str = "abc", size: int = 40) -> str:
    r = random.Random(seed)
    root = ET.Element("a")
    every = [root]
    for k in range(r.randrange(size)):
        el = ET.SubElement(every[-1] if r.random() < 0.5 else r.choice(every), r.choice(tags), {"n": str(k)})
        el.text, el.tail = r.choice([None, "x<", "y & 'z'"]), r.choice([None, 't"', " "])
        every.append(el)
    return ET.tostring(root, encoding="unicode")


@pytest.fixture(scope="module")
def trees(spark):
    texts = [(f"d{k}", made(k)) for k in range(25)] + [("deep", "<a>" + "<b><a>" * 150 + "</a></b>" * 150 + "</a>"), ("broken", "<a>"), ("null", None)]
    return texts, markup.node_table(spark.createDataFrame(texts, "doc string, text string")).persist()


def walked(texts):
    """(doc, number, element, numbers of the elements above it) of every element."""
    for doc, text in texts:
        root = markup.parse_xml(text or "")
        if root is None:
            continue
        numbers = {el: k for k, (el, *_) in enumerate(markup.walk(root))}
        above = {root: []}
        for el in numbers:
            for c in el:
                above[c] = [*above[el], el]
        for el, k in numbers.items():
            yield doc, k, el, above[el], numbers


@pytest.mark.parametrize("inner,outer", [("c", "b"), ("b", "b"), ("a", "c"), ("b", "a")])
def test_nearest_enclosing_is_the_nearest_above(trees, inner, outer):
    texts, nodes = trees
    got = {(r.doc, r.node): r.held for r in tree.nearest_enclosing(nodes, F.col("tag") == inner, F.col("tag") == outer, "held").collect()}
    assert got == {(d, k): next((numbers[x] for x in reversed(above) if x.tag == outer), None) for d, k, el, above, numbers in walked(texts) if el.tag == inner}


def test_last_before_follows_document_order(trees):
    texts, nodes = trees
    got = {(r.doc, r.node): (r.seen, r.nth) for r in tree.running(tree.last_before(nodes, F.col("tag") == "b", F.col("node"), "seen"), F.col("tag") == "b", "nth").collect()}
    seen: dict[str, list[int]] = {}
    for d, k, el, _, _ in walked(texts):
        if el.tag == "b":
            seen.setdefault(d, []).append(k)
        assert got[d, k] == (seen.get(d, [None])[-1], len(seen.get(d, [])) if el.tag == "b" else None)


def test_outline_numbers_at_any_depth(trees):
    texts, nodes = trees
    got = {(r.doc, r.node): (r.level, r.number) for r in tree.outline(nodes, F.col("tag") == "b").collect()}
    places: dict[tuple, list[int]] = {}
    counts: dict[tuple, int] = {}
    for d, k, el, above, numbers in walked(texts):
        if el.tag == "b":
            up = next((numbers[x] for x in reversed(above) if x.tag == "b"), None)
            counts[d, up] = counts.get((d, up), 0) + 1
            places[d, k] = [*places.get((d, up), []), counts[d, up]]
    assert got == {key: (len(p), p) for key, p in places.items()} and max(map(len, places.values())) == 150


def test_serialised_nodes_are_the_document(trees):
    texts, nodes = trees
    tag = F.col("tag")
    attrs = F.when(pages.attr("n") != "", F.concat(F.lit(' n="'), pages.attr("n"), F.lit('"'))).otherwise("")
    out = tree.serialised(nodes, F.concat(F.lit("<"), tag, attrs, F.lit(">")), F.concat(F.lit("</"), tag, F.lit(">")), F.lit(True))
    got = {r.doc: ET.tostring(ET.fromstring(r.html), encoding="unicode") for r in out.collect()}
    assert got == {d: ET.tostring(ET.fromstring(t), encoding="unicode") for d, t in texts if t and d != "broken"}


BODIES = [
    '<TEI><text><body><pb n="0"/><div type="text"><pb n="1r" wit="#S" facs="f"/><head type="rubric">A<lb/>&amp;B</head><head>h</head><p xml:id="p1">x<lb/><hi rend="initial">I</hi><hi>e<app><lem>l<hi>!</hi></lem><rdg type="a">r</rdg></app></hi>t</p>'
    '<p xml:id="p2" n="two"><quote source="#q">a<note type="editorial" resp="#ed">n<w lemma="#z">w</w></note>b</quote><w lemmaRef="#l">wo<hi>r</hi>d</w><w>p</w><seg>s<app><lem/></app></seg></p><note>top<hi>x</hi></note>between<trailer>end<lb/></trailer><figure><p>no</p></figure></div>'
    '<div><p xml:id="n">no</p></div><div type="text"><p xml:id="p3">second</p></div></body></text></TEI>',
    "<TEI><text><body><div><p>no</p></div></body></text></TEI>", '<TEI><text><body><div type="text"><p xml:id="p">only</p></div></body></text></TEI>',
]


def test_bodies_are_those_of_the_renderer(spark):
    docs = spark.createDataFrame([(str(k), t) for k, t in enumerate(BODIES)], "doc string, text string")
    walked_ = {r.doc: r.html for r in render.text_pages(docs, editors={"ed": "Editor"}).collect() if r.html}
    got = {r.doc: r.html for r in pages.text_bodies(markup.node_table(docs), editors={"ed": "Editor"}).collect() if r.html}
    assert got == walked_ and len(got) == 2


def test_second_calls_find_the_first_of_equal_ids(spark):
    text = '<TEI><body><ref target="#a">1</ref><note xml:id="a">x<note xml:id="a">y</note></note><ref target="#none"/><ref target="a"/><note/></body></TEI>'
    nodes = markup.node_table(spark.createDataFrame([("d", text), ("e", "<TEI/>")], "doc string, text string"))
    notes = pages.footnotes(nodes)
    assert [(r.nth, r.note_id, r.text) for r in notes.orderBy("nth").collect()] == [(1, "a", "xy"), (2, "a", "y"), (3, None, "")]
    assert [(r.node, r.nth) for r in pages.second_calls(nodes, notes).collect()] == [(2, 1)]


def test_empty_tables(spark):
    nodes = markup.node_table(spark.createDataFrame([], "doc string, text string"))
    assert not tree.outline(nodes, F.col("tag") == "b").count() and not pages.text_bodies(nodes).count() and not pages.articles(nodes).count()
    assert not pages.apparatus_entries(nodes, {"orthographic": ("c", "l")}).count() and not pages.sense_rows(nodes).count()


def test_pages_take_one_parse_and_one_shuffle(spark):
    nodes = markup.node_table(spark.createDataFrame([("d", "<TEI/>")], "doc string, text string"))
    for made_ in (pages.text_bodies(nodes), pages.articles(nodes), pages.footnotes(nodes), pages.called_notes(nodes)):
        text = made_._jdf.queryExecution().executedPlan().toString()
        assert text.count("MapInArrow") == 1 and text.count("Exchange hashpartitioning") == 1


def test_articles_by_hand(spark):
    text = (
        '<TEI><text><body><div xml:id="a"><head>A</head><p>x<note xml:id="n">y<hi>z</hi><note>w</note></note></p><div><head>B</head></div><div><head>C</head><p><ref target="#n">r</ref><ref target="#no">s</ref></p></div></div>'
        "<div><head>D</head><div><head>E</head></div></div><head>F</head></body></text></TEI>"
    )
    nodes = markup.node_table(spark.createDataFrame([("d", text)], "doc string, text string"))
    call = '<sup><a href="#fn-1">1</a></sup>'
    want = (
        f'<section id="a"><h2>1 A</h2><p>x{call}</p><section id=""><h3>1.1 B</h3></section><section id=""><h3>1.2 C</h3><p>{call}s</p></section></section>'
        '<section id=""><h2>2 D</h2><section id=""><h3>2.1 E</h3></section></section>F<ol><li id="fn-1">yzw</li><li id="fn-2">w</li></ol>'
    )
    assert [r.html for r in pages.articles(nodes).collect()] == [want]
    assert [tuple(r) for r in pages.called_notes(nodes).orderBy("nth").collect()] == [("d", 1, "n", "yzw", 1), ("d", 2, None, "w", 0)]
