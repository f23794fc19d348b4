"""Marked-up documents: nodes, text nodes, tokens, rows, rendering, injection, constraints."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomtext.operators import attest, catalogue, growth, inject, lookup, render, tokens, validate
from loomtext.sources import markup, tables

TEI = 'xmlns="http://www.tei-c.org/ns/1.0"'
TEXT = f"""<TEI {TEI} xml:id="t1"><text><body><div type="text">
<pb n="1r" ed="#S" facs="u1"/><head type="rubric">თავი<lb/>ი</head>
<p xml:id="p1" n="1"><hi rend="initial">Ⴘ</hi>ეიმოსა და <w lemma="#lex-a">კაცი</w> <note>შენიშვნა</note> ბოლო</p>
<p xml:id="p2"><hi rend="initial">Ⴀ</hi>წ გევედრებით <persName ref="#pers-1">პეტრე</persName> &amp; <app><lem wit="#S">ერთი</lem><rdg wit="#N" type="lexical">ორი</rdg><rdg wit="#N" type="lacuna"/></app></p>
<p>უსახელო</p><p xml:id="p3"><hi rend="initial">Ⴕ</hi><persName>რისტე</persName> კაცი</p>
<trailer>ბოლო<lb/>სიტყუა</trailer></div></body></text></TEI>"""


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([("t1", TEXT), ("bad", "<a><b></a>"), ("none", None)], "doc string, text string")


def test_text_nodes_and_tokens(docs):
    nodes = tokens.text_nodes(docs)
    got = tokens.tokenise(nodes).orderBy("token_id").collect()
    by = {t.token_id: t for t in got}
    assert [by[f"t1_p1_t{k}"].surface for k in range(3)] == ["ეიმოსა", "და", "ბოლო"]  # w, note and initial are skipped, tails are not
    first = by["t1_p1_t0"]
    assert (first.norm, first.node_idx, first.is_tail, first.char_start, first.char_end, first.initial_char) == ("შეიმოსა", 1, True, 0, 6, "შ")
    assert by["t1_p2_t0"].norm == "აწ" and by["t1_p2_t1"].surface == "გევედრებით" and by["t1_p2_t1"].char_start == 2
    assert by["t1_p2_t1"].norm == "გევედრებით" and by["t1_p2_t1"].initial_char == "ა"
    bare = by["t1_p3_t0"]
    assert (bare.surface, bare.norm, bare.node_idx, bare.is_tail) == ("რისტე", "რისტე", 2, False)
    assert not any(t.surface in ("უსახელო", "კაცი") and t.para_id == "p1" for t in got)
    text = {(n.para_id, n.node_idx, n.is_tail): n.text for n in nodes.collect()}
    assert all(text[t.para_id, t.node_idx, t.is_tail][t.char_start : t.char_end] == t.surface for t in got)


def test_quirk_numbers_tails_by_last_descendant(spark):
    d = spark.createDataFrame([("q", f'<TEI {TEI} xml:id="q"><p xml:id="p1"><seg><hi>ა</hi></seg> ბ</p></TEI>')], "doc string, text string")
    assert [t.node_idx for t in tokens.tokenise(tokens.text_nodes(d)).filter("is_tail").collect()] == [1]
    assert [t.node_idx for t in tokens.tokenise(tokens.text_nodes(d), compat=True).filter("is_tail").collect()] == [2]


def test_node_table_and_subtrees(docs):
    nodes = markup.node_table(docs)
    rows = {r.node: r for r in nodes.collect()}
    assert rows[0].tag == "TEI" and rows[0].parent == -1 and rows[0].last == max(rows) and rows[0].root_id == "t1"
    assert all(rows[r.parent].node < r.node <= rows[r.parent].last for r in rows.values() if r.parent >= 0)
    full = {r.node: r.full for r in markup.subtree_text(nodes.filter("not array_contains(path, 'note')")).collect()}
    lem = next(r.node for r in rows.values() if r.tag == "lem")
    assert full[lem] == "ერთი"
    assert {r.doc: r.ok for r in markup.well_formed(docs).collect()} == {"t1": True, "bad": False, "none": False}


def test_html_pages(spark):
    page = spark.createDataFrame([("h", "<p>a<b>b<p>c<br>d</p><a href=/x>e</a>")], "doc string, text string")
    got = markup.node_table(page, html_pages=True).collect()
    assert [r.tag for r in got] == ["#document", "p", "b", "p", "br", "a"] and next(r for r in got if r.tag == "br").tail == "d"


def test_attestations(docs):
    refs = attest.references(docs)
    got = {(r.target_id, r.kind): r for r in attest.attestations(refs).collect()}
    assert set(got) == {("lex-a", "entry"), ("pers-1", "name")}
    assert got["lex-a", "entry"].para_n == "1" and "კაცი" in got["lex-a", "entry"].quote
    assert got["pers-1", "name"].para_n == "2"
    twice = refs.unionByName(refs.withColumn("ord", F.col("ord") + 100))
    assert attest.attestations(twice).count() == 2
    assert tuple(attest.totals(attest.attestations(refs)).first()) == (2, 2)


def test_context(spark):
    one = spark.createDataFrame([("x" * 100, 0, 4), ("a  b" + "y" * 90, 50, 4), ("ab", 0, 2)], "p string, s int, n int")
    q = [r.q for r in one.select(attest.context(F.col("p"), F.col("s"), F.col("n")).alias("q")).collect()]
    assert q[0] == "x" * 44 + "…" and q[1].startswith("…") and q[1].endswith("y") and q[2] == "ab"


def test_apparatus(docs):
    got = attest.apparatus(docs, {"lexical": ("rdg-lex", "lex.")}).orderBy("rdg_ord").collect()
    assert [(r.n, r.lemma, r.reading, r.type, r.type_class, r.type_label, r.entry_type, r.par_id) for r in got] == [
        (1, "ერთი", "ორი", "lexical", "rdg-lex", "lex.", "lacuna", "p2"), (1, "ერთი", None, "lacuna", "rdg-orth", "lacuna", "lacuna", "p2"),
    ]


def test_text_page(docs):
    r = render.text_pages(docs, {"1r": {"facs": "u0", "sp": 3}}).first()
    assert (r.first_facs, r.first_folio, r.first_sp, r.app_count) == ("u1", "1r", 3, 1)
    assert '<div class="ms-rubric">თავი<br>ი</div>' in r.html and '<span class="lex-word" data-lemma="lex-a">კაცი</span>' in r.html
    assert '<span class="geo-initial">Ⴘ</span>' in r.html and "&amp;" in r.html and '<p id="p1"><span class="par-num" title="¶1">' in r.html
    assert 'data-app="app-1"' in r.html and "<br>სიტყუა" in r.html


def test_page_breaks_and_popups(docs, spark):
    folios = tables.folio_map(spark, 2, 282, "s", "v")
    b = catalogue.page_breaks(docs, folios).collect()
    assert [(r.folio, r.witness, r.facs, r.sp) for r in b] == [("1r", "S", "u1", 3)]
    pop = spark.createDataFrame([("lex-a", "კაცი", "n.", "d", "k")], "xml_id string, lemma string, pos string, def string, slug string")
    got = {r.target_id: r.lemma for r in catalogue.with_popups(attest.references(docs), pop).collect()}
    assert got == {"lex-a": "კაცი", "pers-1": None}
    e = spark.createDataFrame([("i1", "lex-a"), ("i2", None)], "xml_id string, lex_id string")
    assert {r.xml_id: r.slug for r in catalogue.authority_pages(e, pop).collect()} == {"i1": "k", "i2": "a"}


def test_injection(docs):
    found = tokens.tokenise(tokens.text_nodes(docs)).filter("surface in ('და', 'ბოლო', 'გევედრებით', 'რისტე')")
    hit = found.select("*", F.lit("lex-x").alias("match_id"), F.lit("primary").alias("match_tier"), F.lit("d").alias("match_source"), F.lit("exact").alias("confidence"))
    assert inject.taggable(hit).count() == 4
    out = {r.doc: r for r in inject.inject(docs, inject.in_order(hit)).collect()}["t1"]
    assert (out.tagged, out.skipped, out.written, out.introduced) == (4, 0, True, [])
    import xml.etree.ElementTree as ET

    assert "".join(ET.fromstring(out.text).itertext()) == "".join(ET.fromstring(TEXT).itertext())
    assert out.text.count("lemmaRef=") == 4
    moved = hit.filter("surface = 'და'").withColumn("char_start", F.col("char_start") + 4)
    assert inject.inject(docs, inject.in_order(moved)).first().tagged == 1
    lost = hit.filter("surface = 'და'").withColumn("surface", F.lit("ჯჯჯ"))
    assert inject.inject(docs, inject.in_order(lost)).first().skipped == 1
    total = inject.summary(inject.inject(docs, inject.in_order(hit))).first()
    assert (total.documents, total.tagged, total.held_back) == (1, 4, 0)


def test_injection_keeps_comments_and_instructions(spark):
    text = f'<?xml version="1.0"?>\n<?xml-model href="a"?><!-- lead --><TEI {TEI} xml:id="c1"><p xml:id="p1">და<!-- x --> ბოლო <?y z?>და<seg/>კაცი და</p><p xml:id="p2"/></TEI><!-- end -->\n'
    d = spark.createDataFrame([("c1", text), ("c2", "<a><!-- b --></a>")], "doc string, text string")
    found = tokens.tokenise(tokens.text_nodes(d)).filter("surface in ('და', 'ბოლო')")
    hit = found.select("*", F.lit("l").alias("match_id"), F.lit("primary").alias("match_tier"), F.lit("d").alias("match_source"), F.lit("exact").alias("confidence"))
    out = {r.doc: r for r in inject.inject(d, inject.in_order(hit), every=True).collect()}
    w = lambda s: f'<w lemmaRef="#l">{s}</w>'
    assert out["c1"].text == text.replace("<p xml:id=\"p2\"/>", "<p xml:id=\"p2\" />").replace("<seg/>", "<seg />").replace("და", w("და")).replace("ბოლო", w("ბოლო"))
    assert (out["c1"].tagged, out["c1"].skipped) == (4, 0) and (out["c2"].text, out["c2"].written) == ("<a><!-- b --></a>", False)
    table = spark.createDataFrame([("c1", "და", "l")], "text_id string, surface string, id string")
    got = {r.doc: r for r in inject.tag_surfaces(d, table).collect()}
    assert got["c1"].tagged == 3 and got["c1"].text.startswith('<?xml version="1.0"?>\n<?xml-model href="a"?><!-- lead --><TEI') and got["c1"].text.endswith("</TEI><!-- end -->\n") and "<!-- x -->" in got["c1"].text


def test_a_long_paragraph_is_spliced_in_order(spark):
    words = [f"ა{'ბ' * (k % 5)}" for k in range(6000)]
    d = spark.createDataFrame([("l", f'<TEI {TEI} xml:id="l"><p xml:id="p">{" ".join(words)}</p></TEI>')], "doc string, text string")
    hit = tokens.tokenise(tokens.text_nodes(d)).select("*", F.lit("i").alias("match_id"), F.lit("primary").alias("match_tier"), F.lit("d").alias("match_source"), F.lit("exact").alias("confidence"))
    r = inject.inject(d, inject.in_order(hit)).first()
    assert r.tagged == 6000 and " ".join(f'<w lemmaRef="#i">{w}</w>' for w in words) in r.text


def test_surface_tagging(docs, spark):
    table = spark.createDataFrame([("t1", "კაცი", "lex-k"), ("t1", "ბოლო", "lex-b"), ("t1", "შენიშვნა", "lex-n")], "text_id string, surface string, id string")
    out = {r.doc: r for r in inject.tag_surfaces(docs, table).collect()}
    assert out["t1"].tagged == 4 and "lex-n" not in out["t1"].text and out["bad"].text == "<a><b></a>"


def test_spliced_text(spark):
    texts = spark.createDataFrame([(1, "abc def"), (2, "x")], "id int, text string")
    hits = spark.createDataFrame([(1, 0, 3, "a"), (1, 4, 7, "d")], "id int, char_start int, char_end int, id2 string").withColumnRenamed("id2", "idx")
    hits = hits.select(F.col("id").alias("k"), "char_start", "char_end", F.col("idx").alias("id"))
    got = {r.k: r.text for r in inject.spliced_text(texts.withColumnRenamed("id", "k"), hits, ["k"]).collect()}
    assert got == {1: '<w lemma="#a">abc</w> <w lemma="#d">def</w>', 2: "x"}


def test_constraints(docs, spark):
    bad = spark.createDataFrame([("b", f'<TEI {TEI}><rdg wit="#N" type="odd"><w>x</w></rdg><pb ed="#S"/><pb ed="#Z"/><lem resp="#z"><w><w/></w></lem></TEI>')], "doc string, text string")
    got = {r.rule: r.violations for r in validate.rules(markup.node_table(bad)).collect()}
    assert got == {"no w in rdg": 1, "rdg/@wit": 1, "rdg/@type": 1, "pb/@ed": 1, "pb/@facs": 1, "lem/@resp": 1}
    n = validate.nested(markup.node_table(bad)).first()
    assert (n.w_in_w, n.w_in_lem, n.w_in_rdg, n.w_in_head, n.w_in_note) == (1, 2, 1, 0, 0)
    root = markup.parse_xml(bad.first().text)
    assert validate.tag_violations(root) == {"w": 1, "lem": 2, "rdg": 1, "head": 0, "note": 0}
    b = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    assert validate.introduced(b, b.withColumn("n", F.col("n") + F.when(F.col("k") == "b", 1).otherwise(0)), ["k"], "n").collect() == [("b", 2, 3, 1)]


def test_bibliography(spark):
    xml = f"""<TEI {TEI}><listBibl type="edition"><biblStruct xml:id="b1"><monogr><author><surname>Zed</surname><forename>A</forename></author><author>Org</author><title level="m">T</title>
    <imprint><date notBefore="1900"/><pubPlace>P</pubPlace></imprint><biblScope unit="volume">2</biblScope><ref target="u"/></monogr></biblStruct><biblStruct><monogr/></biblStruct></listBibl>
    <biblStruct xml:id="b2"><analytic><title level="a">Art</title></analytic><monogr><title level="j">Jour</title><imprint><date>1999</date></imprint></monogr><idno type="DOI">d</idno></biblStruct></TEI>"""
    got = {r.xml_id: r for r in catalogue.bibliography(spark.createDataFrame([("b", xml)], "doc string, text string")).collect()}
    a, b = got["b1"], got["b2"]
    assert len(got) == 2 and (a.bib_type, a.title, a.authors, a.date, a.volume, a.url, a.sort_key) == ("edition", "T", "Zed, A; Org", "1900", "2", "u", "zed")
    assert (b.bib_type, b.title, b.journal, b.date, b.doi, b.sort_key) == ("other", "Art", "Jour", "", "d", "art")


def test_authority(spark):
    xml = f"""<TEI {TEI}><person xml:id="p1" type="king"><persName xml:lang="la">David</persName><persName type="main" xml:lang="ka">დავით</persName><persName type="variant">დავითისა</persName><persName type="variant">დავით</persName>
    <persName type="variant">ელია</persName></person><place xml:id="l1"><placeName>X</placeName></place><list type="fauna"><item xml:id="i1" corresp="#lex-1"><term type="variant">v</term><term>ლომი</term></item></list></TEI>"""
    got = {r.xml_id: r for r in catalogue.authority(spark.createDataFrame([("a", xml)], "doc string, text string")).collect()}
    assert (got["p1"].name, got["p1"].name_la, got["p1"].variants, got["p1"].section) == ("დავით", "David", ["ელია", "დავით"], "persons")
    assert got["l1"].name == "X" and (got["i1"].name, got["i1"].lex_id, got["i1"].section) == ("ლომი", "lex-1", "animals")


def test_lexicon(spark):
    xml = f"""<TEI {TEI}><entry xml:id="e1" source="d1"><form type="lemma"><orth>ბა</orth></form><gramGrp><pos>noun</pos><gen>m</gen></gramGrp><sense n="1"><def>აა <hi rend="bold">ბ</hi> <ref target="#e2">გ</ref><cit>no</cit></def>
    <cit type="example"><quote>ქ <hi>ც</hi></quote><bibl><citedRange unit="page">140</citedRange><citedRange unit="line">17</citedRange></bibl></cit><cit type="example"><bibl><citedRange unit="page">9</citedRange></bibl></cit>
    <sense><def>ღრმა</def></sense><sense/></sense><cit type="translation" xml:lang="grc"><quote>α</quote></cit><xr type="source"><ref target="#t1">T</ref><ref target="d1"/></xr></entry><entry xml:id="e2"/></TEI>"""
    d = spark.createDataFrame([("l", xml)], "doc string, text string")
    e = catalogue.lexicon(d, {"noun": "noun"}, {"noun": "n."}, {"m": "m."}, {"d1": ("g1", "D1")}, ("other", "Other")).collect()
    assert len(e) == 1 and (e[0].pos, e[0].pos_label, e[0].gender, e[0].greek, e[0].source_group, e[0].sources_more) == ("noun", "n.", "m.", "α", "g1", 0)
    assert [(x.text_id, x.label, x.is_dict_source) for x in e[0].sources] == [("t1", "T", False), ("d1", "d1", True)]
    s = catalogue.senses(d).orderBy("ord").collect()
    assert [x.def_ka for x in s] == ["აა ბ გno", "ღრმა"] and s[0].def_html == 'აა <strong>ბ</strong> <a class="xref" href="#e2">გ</a>'
    assert [(x.quote_html, x.ref) for x in s[0].examples] == [("ქ <em>ც</em>", "140, 17")] and s[0].refs == ["9"]
    assert catalogue.popup(catalogue.lexicon(d, {}, {}, {}, {}, ("o", "O")), catalogue.senses(d)).first()["def"] == "აა ბ გno"
    assert [r.xml_id for r in lookup.entry_ids(d).orderBy("xml_id").collect()] == ["e1", "e2"]


def test_catalogue(spark):
    xml = f"""<TEI {TEI}><listWit><witness xml:id="w"><abbr>S</abbr><msDesc><origDate notBefore="864" notAfter="865"/></msDesc></witness></listWit><listPerson type="authors"><person xml:id="a1"><persName xml:lang="ka">ერთი ორი სამი</persName>
    <birth when="0330"/><death when="0379"/><idno type="URI" subtype="L">u</idno><idno type="URI">x</idno></person></listPerson><taxonomy xml:id="feasts"><category xml:id="f1" n="--09-08"><catDesc xml:lang="ka">შობა</catDesc></category>
    <category xml:id="f2" n="moveable"/></taxonomy><listEvent><event xml:id="t1" corresp="#f1" type="#g1"><label xml:lang="en">E</label><label xml:lang="ka">ა ბ გ დ ე</label><note type="author" corresp="#a1"/><note type="status">done</note>
    <msDesc><msIdentifier><idno>N35</idno></msIdentifier><locus from="1r" to="2v"/></msDesc></event><event xml:id="t2" corresp="#zz" type="#q"><label>L</label></event></listEvent></TEI>"""
    d = spark.createDataFrame([("c", xml)], "doc string, text string")
    assert catalogue.witnesses(d).first().date == "864–865"
    a, f = catalogue.authors(d), catalogue.feasts(d, {"09": "Sept"}, "moving")
    row = a.first()
    assert (row.short_ka, row.dates, [tuple(x) for x in row.uri_links]) == ("ერთი ორი", "330–379", [("L", "u")])
    assert [(r.xml_id, r.date) for r in f.orderBy("rank").collect()] == [("f1", "8 Sept"), ("f2", "moving")]
    t = {r.xml_id: r for r in catalogue.texts(d, a, f, {"g1": ("hom", "H")}, {"done": ("done", "D")}, ("other", "O"), ("planned", "P")).collect()}
    assert (t["t1"].label_ka, t["t1"].short_label, t["t1"].author_ka, t["t1"].feast_ka, t["t1"].genre_class, t["t1"].status_label, t["t1"].loci) == ("ა ბ გ დ ე", "ა ბ გ დ…", "ერთი ორი სამი", "შობა", "hom", "D", {"N35": "ff. 1r-2v"})
    assert (t["t2"].author_ka, t["t2"].author_id, t["t2"].feast_ka, t["t2"].genre_class, t["t2"].status_class) == ("?", "aut-anon", "zz", "other", "planned")


def test_articles(spark):
    xml = f"""<TEI {TEI} xml:id="r1"><titleStmt><title xml:lang="en">E</title><title xml:lang="ka">ქ</title><author>A</author></titleStmt><text><body><div xml:id="s1" n="1"><head rend="run-in">H<note n="1" xml:id="n1">see <title>T</title></note></head>
    <pb n="3"/><p>x <hi rend="sup">2</hi> <ref target="https://u">l</ref><ref type="noteAnchor" target="#n1"/></p><list><item>i</item></list><div><head>Sub</head><p>y<lb/>z <supplied>q</supplied><gap reason="lost"/></p></div></div></body>
    <back><div type="errata"><p>e</p></div><div type="other"><p>no</p></div></back></text></TEI>"""
    d = spark.createDataFrame([("r", xml), ("bad", "<x")], "doc string, text string")
    m = catalogue.articles(d).collect()
    assert [(r.xml_id, r.title, r.author, r.abstract) for r in m] == [("r1", "ქ", "A", "x 2 l…")]
    sec = {r.ord: r for r in catalogue.article_sections(d).collect()}
    assert sorted(r.level for r in sec.values()) == [0, 0, 1] and {r.kind for r in sec.values()} == {None, "errata"}
    assert catalogue.contents(catalogue.article_sections(d)).count() == 3
    b = render.article_blocks(d).orderBy("ord").collect()
    assert b[0].kind == "p" and b[0].html.startswith('<strong class="run-in-head" id="s1">H<span class="note-ref-wrap" data-note-id="n1">') and "[p. 3]" in b[0].html and "<sup>2</sup>" in b[0].html
    assert b[0].html.endswith('<span class="note-ref-wrap" data-note-id="n1"><a href="#fn-n1" class="note-ref">1</a></span>')
    assert b[-1].kind == "note" and b[-1].html == 'see <cite class="title">T</cite>' and any("[…]" in x.html and "<br>" in x.html for x in b)
    assert not any("no" == x.html for x in b)


def test_article_lists_quotes_and_blocks(spark):
    xml = f"""<TEI {TEI} xml:id="r2"><text><body><div xml:id="s"><list><head>H</head>skip<label>L</label><item>a <hi rend="i">b</hi></item><item>t<p>x</p>u<list><item>in</item></list><label>l</label></item><pb n="2"/><ref target="#z">r</ref></list>
    <quote>open <hi rend="b">h</hi> on<p>q</p>loose<bibl>B</bibl><lg><l>v</l></lg></quote><quote><p>only</p></quote><quote>text</quote><lg><l>v</l></lg><milestone rend="asterism"/><milestone/><closer>c</closer><gap reason="g"/><p rend="label">lab</p><supplied>s</supplied></div></body></text></TEI>"""
    got = [(b.kind, b.html) for b in render.article_blocks(spark.createDataFrame([("r", xml)], "doc string, text string")).orderBy("ord").collect()]
    ref = '<a href="#z" class="bib-ref">r</a>'
    verse = '<div class="lg"><span class="l">v</span></div>'
    assert got == [
        ("list", '<div class="art-list-wrap"><p class="list-head">H</p><ul class="art-list"><li class="item-label">L</li><li>a <em>b</em></li><li>t<p class="item-p">x</p>u<div class="art-list-wrap"><ul class="art-list"><li>in</li></ul></div>'
                 f'<span class="item-label">l</span></li><li class="li-pb"><span class="pb-marker" title="p. 2">[p. 2]</span></li><li>{ref}</li></ul></div>'),
        ("quote", f'<blockquote class="block-quote"><p class="quote-p">open <strong>h</strong> on</p><p class="quote-p">q</p>loose<span class="quote-bibl">B</span>{verse}</blockquote>'),
        ("quote", '<blockquote class="block-quote"><p class="quote-p">only</p></blockquote>'), ("quote", '<blockquote class="block-quote"><p class="quote-p">text</p></blockquote>'),
        ("quote", f'<blockquote class="block-quote">{verse}</blockquote>'), ("milestone", '<p class="asterism" aria-hidden="true">*&#8195;*&#8195;*</p>'), ("closer", '<div class="closer">c</div>'),
        ("gap", '<p class="gap-block"><span class="gap" title="g">[…]</span></p>'), ("label", '<p class="label-p">lab</p>'), ("p", '<span class="supplied" title="">[s]</span>'),
    ]


def test_lookups(spark):
    existing = spark.createDataFrame([("x",)], "xml_id string")
    a = spark.createDataFrame([("x", ["კაცი"], 1, "l1"), ("y", ["კაცი", "ჳ"], 2, "l2"), ("x", ["კაცი"], 3, "l3")], "xml_id string, forms array<string>, ord int, lemma string")
    got = {r.key: r for r in lookup.primary_lookup(a, existing).collect()}
    assert (got["კაცი"].xml_id, got["კაცი"].lemma, got["კაცი"].in_lexicon) == ("x", "l3", True) and got["ვ"].xml_id == got["ჳ"].xml_id == "y"
    rows = spark.createDataFrame([("lex.a", "მა, ჳა", "d", "s", "g", "r|q", 1), ("", "მა", "e", "s", "g", None, 2), (None, " ", "e", "s", "g", None, 3), ("z", "კაცი", "f", "t", "g", None, 4)], tables.DICTIONARY + ", ord int")
    e = lookup.secondary_entries(rows)
    primary = lookup.primary_lookup(a, existing)
    b = {r.key: r for r in lookup.secondary_lookup(e, primary, existing).collect()}
    assert b["მა"].xml_id == "lex-ma" and b["ჳა"].xml_id == "lex-a" and b["ჳა"].cross_refs == ["r", "q"] and "კაცი" not in b
    sup = {r.key: r.tsv_supplements for r in lookup.supplements(primary, e).collect()}
    assert [x.source_id for x in sup["კაცი"]] == ["t"] and sup["ჳ"] is None
    grown = {r.key: r.xml_id for r in lookup.expanded(spark.createDataFrame([("ანგელოზი", "e1", "ანგელოზი", 1), ("ანგელოზს", "e2", "აბი", 2)], "key string, xml_id string, lemma string, ord int")).collect()}
    assert grown["ანგელოზს"] == "e2" and grown["ანგელოზისა"] == "e1" and grown["ანგელოზი"] == "e1" and "აბისა" not in grown


def test_carryover_files_and_copies(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"ა": "x", "ბ": "y"}', encoding="utf-8")
    assert {tuple(r) for r in tables.read_carryover(spark, str(tmp_path / "m.json")).collect()} == {("ა", "x"), ("ბ", "y")} and tables.read_carryover(spark, str(tmp_path / "no.json")).count() == 0
    src, dst = tmp_path / "a", tmp_path / "b"
    (src / "tei" / "texts").mkdir(parents=True)
    (src / "tei" / "texts" / "t1.xml").write_text("<a/>")
    dst.mkdir()
    (dst / "old").write_text("x")
    assert tables.replace_copy(spark, str(src), str(dst)) and not (dst / "old").exists() and (dst / "tei" / "texts" / "t1.xml").read_text() == "<a/>"
    assert not tables.replace_copy(spark, str(tmp_path / "none"), str(dst)) and (dst / "tei").exists()
    texts = spark.createDataFrame([("t1", "tei/texts/t1.xml"), ("t2", "tei/texts/gone.xml"), ("t3", None), ("t4", "")], "xml_id string, file_path string")
    got = tables.with_files(texts, markup.read_documents(spark, str(dst)), str(dst)).collect()
    assert [(r.xml_id, r.doc, r.text) for r in got] == [("t1", "t1", "<a/>")]


def test_growth(spark):
    m = spark.createDataFrame([("a", "ll", "d", "s+t", "master", "exact", "0", "t1", "k1"), ("a", "zz", "d", "s", "master", "exact", "0", "t2", "k2"), ("b", "l", "", "s", "primary", "exact", "0", "t1", "k3"), ("c", "ll", "", "s", "master", "norm", "0", "t1", "k4")],
                              "match_id string, match_lemma string, match_def_ka string, match_source string, match_tier string, confidence string, in_lexicon string, text_id string, token_id string")
    c = growth.candidates(m, spark.createDataFrame([("q",)], "xml_id string"))
    assert c.collect() == [("a", "ll", "d", "s+t", "master", 2, 2)]
    made = growth.entry_markup(growth.skeletons(c, {"s": "S & co"})).first().markup
    assert markup.parse_xml(made) is not None and "freq=2; texts=2" in made and "S &amp; co" in made and 'source="s"' in made


def test_tables_and_sinks(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("# c\n\nჳა \nდა\n", encoding="utf-8")
    assert {r.word for r in tables.read_stopwords(spark, str(tmp_path / "stop.txt")).collect()} == {"ჳა", "ვა", "და"}
    assert tables.read_stopwords(spark, str(tmp_path / "none")).count() == 0 and tables.read_dictionary(spark, str(tmp_path / "none")).count() == 0
    df = spark.createDataFrame([("a", ["x", "y"], True, None), ("b", [], False, "t")], "k string, l array<string>, f boolean, n string")
    tables.write_tsv(df, str(tmp_path / "tsv"))
    assert sorted(map(tuple, spark.read.csv(str(tmp_path / "tsv"), sep="\t", header=True).fillna("").collect())) == [("a", "x|y", "1", ""), ("b", "", "0", "t")]
    tables.write_split(df, str(tmp_path / "split"), "k", {"only_b": "b"})
    assert spark.read.csv(str(tmp_path / "split/all"), sep="\t", header=True).count() == 2 and spark.read.csv(str(tmp_path / "split/only_b"), sep="\t", header=True).count() == 1
    m = tables.folio_map(spark, 2, 282, "s", "v")
    rows = m.orderBy("sp").collect()
    assert len(rows) == 280 and (rows[0].folio, rows[0].sp, rows[-1].folio, rows[-1].sp, rows[0].facs) == ("1r", 3, "140v", 282, "s:0003")
    tables.write_json(m, str(tmp_path / "folios"))
    assert tables.read_folio_map(spark, str(tmp_path / "no"), str(tmp_path / "folios")).count() == 280 and tables.read_folio_map(spark, str(tmp_path / "no")).count() == 0
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "d1.xml").write_text(TEXT, encoding="utf-8")
    assert [(r.doc, r.text) for r in markup.read_documents(spark, str(tmp_path / "x")).collect()] == [("d1", TEXT)]


def test_empty_elements_stay_as_they_are_spelt(spark):
    text = '<TEI><p xml:id="a">one<rdg wit="#S"></rdg><pb /><!-- c --> two</p></TEI>'
    docs = spark.createDataFrame([("d", text)], "doc string, text string")
    hit = spark.createDataFrame([("d", 0, 0, 0, 3, "one", "a", "x", "primary", "s")], "text_id string, node_idx int, is_tail int, char_start int, char_end int, surface string, para_id string, match_id string, match_tier string, match_source string")
    got = inject.inject(docs, inject.in_order(hit)).first()
    assert got.text == text.replace("one", '<w lemmaRef="#x">one</w>') and got.tagged == 1


def test_tokens_are_numbered_without_shuffling_words(spark):
    docs = spark.createDataFrame([("d", '<TEI xml:id="t"><p xml:id="a">b c<note>no</note> d <seg>e f</seg>g</p><p xml:id="b">h</p></TEI>')], "doc string, text string")
    t = tokens.tokenise(tokens.text_nodes(docs), r"\p{L}+", r"[^\p{L}]+", F.lower)
    assert [(r.token_id, r.surface) for r in t.orderBy("token_id").collect()] == [*((f"t_a_t{k}", w) for k, w in enumerate("bcdefg")), ("t_b_t0", "h")]
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and "MapInArrow" in plan[: plan.index("Exchange")] and "surface" not in plan[plan.index("Exchange") :]


def test_rows_of_small_documents_come_in_few_batches():
    import pyarrow as pa

    docs = pa.record_batch([pa.array([f"d{i}" for i in range(3000)]), pa.array(["<a" if i % 3 == 0 else f"<a><b>{i}</b></a>" for i in range(3000)])], ["doc", "text"])
    out = list(markup.batched(docs, lambda doc, root: [(doc, b.text) for b in root.iter("b")], pa.schema([("doc", pa.string()), ("b", pa.string())])))
    assert len(out) == 1 and out[0].num_rows == 2000 and out[0].column(1)[0].as_py() == "1"


def test_rows_of_elements_named_by_entities(spark):
    docs = spark.createDataFrame([("e", '<!DOCTYPE a [<!ENTITY x "<&#98; k=\'1\'/>">]><a>&x;</a>'), ("p", '<t:a xmlns:t="u"><t:b k="2"/></t:a>'), ("n", "<a><c/></a>"), ("z", None)], "doc string, text string")
    assert {(r.doc, r.k) for r in markup.rows_of(docs, ".//b", {"k": ".@k"}).collect()} == {("e", "1"), ("p", "2")}


def test_sections_of_any_depth(spark):
    from loomtext.operators import catalogue

    text = "<TEI><text><body>" + "<div>" * 9 + "</div>" * 9 + '</body><back><div type="errata"/><div type="index"/></back></text></TEI>'
    found = catalogue.article_sections(spark.createDataFrame([("d", text)], "doc string, text string"))
    rows = sorted((r.ord, r.parent, r.level) for r in found.filter("kind is null").collect())
    assert [r[2] for r in rows] == [*range(9)] and [r[1] for r in rows] == [None, *(r[0] for r in rows[:-1])]
    assert found.filter("kind = 'errata' and level = 0 and parent is null").count() == 1 and found.count() == 10
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
