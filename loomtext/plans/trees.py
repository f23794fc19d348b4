"""Queries on nested markup made from ``documents``: enclosing elements, outlines, pages put together from nodes, notes and apparatus.

Lines become paragraphs and sections whose nesting follows their numbers, so the SQL can state the same trees by strings and recursion.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.operators import grammar, pages, tree
from loomtext.plans.base import query, table
from loomtext.plans.tei import NS
from loomtext.sources import markup

#: The levels of eight sections in a row; each lies at most one level below the one before it.
LEVELS = [1, 2, 3, 4, 3, 2, 3, 2]


def _joined(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _text(x):
    return tree.escaped(x)


def _lined(spark, d, one, begin: str = "<body>", end: str = "</body>"):
    """(doc, text): the non-empty lines of each text, each made into markup by ``one`` (line, its number from 0, the number as a string)."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x != "")
    body = F.array_join(F.transform(lines, lambda x, i: one(x, i, i.cast("string"))), "")
    docs = table(spark, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc"), F.size(lines).alias("n"), body.alias("body"))
    closing = end(F.col("n")) if callable(end) else F.lit(end)
    return docs.select("doc", F.concat(F.lit(f'<TEI xmlns="{NS}"><text>{begin}'), "body", closing, F.lit("</text></TEI>")).alias("text"))


LINED = r"""lines AS (SELECT 'd' || doc_id AS doc, i - 1 AS i, l[i] AS x, len(l) AS n FROM (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: x <> '') AS l FROM documents), unnest(generate_series(1, len(l))) AS g(i)),
lev AS (SELECT *, ([1, 2, 3, 4, 3, 2, 3, 2])[(i % 8) + 1] AS level FROM lines)"""
ESCAPED = "replace(replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


# --- Enclosing and preceding ----------------------------------------------------------------------


def _held(x, i, k):
    """A paragraph with a word, a block with a word in it, a word after the block in a segment, and sometimes a page break."""
    size = F.char_length(x)
    return _joined(
        F.when(i % 5 == 4, "<w n='loose'>o</w>").otherwise(""), F.when(size % 3 == 0, _joined('<pb n="', k, '"', F.when(size % 2 == 0, _joined(' facs="f', k, '"')).otherwise(""), "/>")).otherwise(""),
        '<p xml:id="p', k, '"><w n="a', k, '">x</w><ab xml:id="b', k, '"><seg><w n="b', k, '">y</w></seg>', F.when(i % 4 == 0, _joined('<ab xml:id="c', k, '"><w n="c', k, '">z</w></ab>')).otherwise(""), "</ab><seg><w n=\"d", k, "\">", _text(F.left(x, F.lit(3))), "</w></seg></p>",
    )


@query(f"""WITH {LINED}, w AS (SELECT doc, 'a' || i AS word, 'p' || i AS held FROM lines UNION ALL SELECT doc, 'b' || i, 'b' || i FROM lines UNION ALL SELECT doc, 'c' || i, 'c' || i FROM lines WHERE i % 4 = 0
  UNION ALL SELECT doc, 'd' || i, 'p' || i FROM lines UNION ALL SELECT doc, 'loose', NULL FROM lines WHERE i % 5 = 4)
SELECT * FROM w""")
def enclosing_paragraph(spark, d):
    nodes = markup.node_table(_lined(spark, d, _held))
    held = tree.nearest_enclosing(nodes, F.col("tag") == "w", F.col("tag").isin("p", "ab"), "holder")
    ids = nodes.select("doc", F.col("node").alias("holder"), F.element_at("attrs", "xml_id").alias("held"))
    words = nodes.select("doc", "node", F.element_at("attrs", "n").alias("word"))
    return held.join(words, ["doc", "node"]).join(ids, ["doc", "holder"], "left").select("doc", "word", "held")


@query(f"""WITH {LINED}, m AS (SELECT doc, i, max(CASE WHEN length(x) % 3 = 0 THEN i END) OVER (PARTITION BY doc ORDER BY i) AS page,
  min(CASE WHEN length(x) % 3 = 0 AND length(x) % 2 = 0 THEN i END) OVER (PARTITION BY doc) AS shown FROM lines)
SELECT doc, 'p' || i AS para, page::VARCHAR AS folio, CASE WHEN page IS NOT NULL THEN coalesce((SELECT 'f' || page FROM lines l WHERE l.doc = m.doc AND l.i = page AND length(x) % 2 = 0), n_name, '') END AS facs, 'f' || shown AS first_facs
FROM m LEFT JOIN nation ON n_nationkey = page""")
def last_page_break(spark, d):
    nodes = markup.node_table(_lined(spark, d, _held))
    folios = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("folio"), F.col("n_name").alias("facs"))
    return pages.page_of(nodes, F.col("tag") == "p", folios).select("doc", F.element_at("attrs", "xml_id").alias("para"), "folio", "facs", "first_facs")


# --- Nesting --------------------------------------------------------------------------------------

OUTLINE = LINED + """,
up AS (SELECT a.doc, a.i, a.level, a.x, (SELECT max(b.i) FROM lev b WHERE b.doc = a.doc AND b.i < a.i AND b.level = a.level - 1) AS up FROM lev a),
placed AS (SELECT *, row_number() OVER (PARTITION BY doc, up ORDER BY i) AS place FROM up)"""


def _nested(tag: str, content):
    """Elements nested by ``LEVELS``: before each, those of its level and below are closed."""

    def one(x, i, k):
        at = lambda j: F.element_at(F.array(*map(F.lit, LEVELS)), (j % len(LEVELS)).cast("int") + 1)
        closing = F.when(i == 0, "").otherwise(F.repeat(F.lit(f"</{tag}>"), (at(i + len(LEVELS) - 1) - at(i) + 1).cast("int")))
        return _joined(closing, f'<{tag} xml:id="s', k, '">', content(x, i, k))

    def end(n):
        last = F.element_at(F.array(*map(F.lit, LEVELS)), ((n + len(LEVELS) - 1) % len(LEVELS)).cast("int") + 1)
        return F.when(n == 0, "").otherwise(F.repeat(F.lit(f"</{tag}>"), last))

    return one, end


def _sections(spark, d):
    one, end = _nested("div", lambda x, i, k: _joined("<head>", _text(F.left(x, F.lit(12))), "</head><p>", _text(F.left(x, F.lit(5))), "</p>"))
    return markup.node_table(_lined(spark, d, one, "<body>", lambda n: F.concat(end(n), F.lit("</body>"))))


@query(f"""WITH RECURSIVE {OUTLINE}, r AS (SELECT doc, i, place::VARCHAR AS number FROM placed WHERE up IS NULL UNION ALL SELECT p.doc, p.i, r.number || '.' || p.place FROM placed p JOIN r ON r.doc = p.doc AND r.i = p.up)
SELECT p.doc, 's' || p.i AS section, number, level, 's' || up AS parent, trim(left(x, 12)) AS head, level <= 2 AS in_contents FROM placed p JOIN r ON r.doc = p.doc AND r.i = p.i""")
def contents_levels(spark, d):
    nodes = _sections(spark, d)
    rows = tree.outline(nodes, F.col("tag") == "div")
    ids = nodes.filter("tag = 'div'").select("doc", "node", F.element_at("attrs", "xml_id").alias("section"))
    heads = nodes.filter("tag = 'head'").select("doc", F.col("parent").alias("node"), F.trim("text").alias("head"))
    up = ids.select("doc", F.col("node").alias("parent"), F.col("section").alias("up"))
    out = rows.join(ids, ["doc", "node"]).join(heads, ["doc", "node"], "left").join(up, ["doc", "parent"], "left")
    return out.select("doc", "section", F.array_join("number", ".").alias("number"), "level", F.col("up").alias("parent"), "head", (F.col("level") <= 2).alias("in_contents"))


@query(f"""WITH RECURSIVE {OUTLINE}, r AS (SELECT doc, i, place::VARCHAR AS number FROM placed WHERE up IS NULL UNION ALL SELECT p.doc, p.i, r.number || '.' || p.place FROM placed p JOIN r ON r.doc = p.doc AND r.i = p.up)
SELECT p.doc, 's' || p.i AS sense, number, level, CASE WHEN length(x) % 3 <> 0 THEN trim(left(x, 9)) END AS def, CASE WHEN length(x) % 4 = 0 THEN 1 ELSE 0 END AS examples
FROM placed p JOIN r ON r.doc = p.doc AND r.i = p.i WHERE length(x) % 3 <> 0 OR length(x) % 4 = 0""")
def nested_senses(spark, d):
    cited = lambda x: F.when(F.char_length(x) % 4 == 0, _joined('<cit type="example"><quote>', _text(F.left(x, F.lit(4))), "</quote></cit>")).otherwise("")
    one, end = _nested("sense", lambda x, i, k: _joined(F.when(F.char_length(x) % 3 != 0, _joined("<def>", _text(F.left(x, F.lit(9))), "</def>")).otherwise("<def> </def>"), cited(x)))
    nodes = markup.node_table(_lined(spark, d, one, '<body><entry xml:id="e">', lambda n: F.concat(end(n), F.lit("</entry></body>"))))
    return pages.sense_rows(nodes).select("doc", "sense", F.array_join("number", ".").alias("number"), "level", "def", "examples")


# --- Pages ----------------------------------------------------------------------------------------


def _mixed(x, i, k):
    """Nested mixed content: initial, words, quotation with a highlight and a note in it, apparatus, breaks."""
    n, third = F.char_length(x), F.floor(F.char_length(x) / 3).cast("int")
    part = lambda a, size: _text(F.substring(x, a + 1, size))
    kind = F.element_at(F.array(F.lit("lexical"), F.lit("omission"), F.lit("odd")), (n % 3).cast("int") + 1)
    return F.when(i % 7 == 3, _joined('<head type="rubric">', part(F.lit(0), third), "<lb/>", part(third, n), "</head>")).when(i % 7 == 5, _joined('<pb n="', k, '" wit="#S" facs="f', k, '"/>')).when(
        i % 7 == 6, _joined("<note>", part(F.lit(0), third), "<hi>", part(third, third), "</hi></note>tail")
    ).otherwise(_joined(
        '<p xml:id="p', k, '" n="', k, '"><hi rend="initial">', part(F.lit(0), F.lit(1)), "</hi>", part(F.lit(1), third), '<quote source="#q', k, '">', part(third, F.lit(4)), '<hi>in <hi rend="rubric">', part(F.lit(0), F.lit(3)), "</hi></hi><note type=\"editorial\" resp=\"#ed\">see <w lemma=\"#z\">",
        part(F.lit(0), F.lit(6)), "</w></note>", part(third + 4, F.lit(5)), '</quote><app><lem resp="#shanidze">', part(F.lit(0), F.lit(5)), '<hi>!</hi></lem><rdg wit="#S" type="', kind, '">r</rdg>', F.when(n % 2 == 0, '<rdg wit="#N">s</rdg>').otherwise(""), "</app><lb/>",
        '<w lemma="#l', k, '">', part(F.lit(0), F.lit(4)), "<hi>x</hi></w><w>plain</w><seg>", part(2 * third, n), "</seg></p>",
    ))


def _mixed_docs(spark, d):
    return _lined(spark, d, _mixed, '<body><div type="text">', "</div><div><p>not shown</p></div></body>")


def _mixed_nodes(spark, d):
    return markup.node_table(_mixed_docs(spark, d))


def _e(sql: str) -> str:
    return ESCAPED.format(sql)


MIXED = LINED + f""",
c AS (SELECT *, length(x) // 3 AS t, i % 7 NOT IN (3, 5, 6) AS para FROM lines), a AS (SELECT *, sum(para::INT) OVER (PARTITION BY doc ORDER BY i) AS app FROM c),
html AS (SELECT doc, i, para, app, x, CASE i % 7
  WHEN 3 THEN '<div class="ms-rubric">' || {_e("left(x, t)")} || '<br>' || {_e("substr(x, t + 1)")} || '</div>'
  WHEN 5 THEN '<span class="folio-milestone" data-wit="S" data-folio="' || i || '" data-facs="f' || i || '" title=" S, f. ' || i || '">' || i || '</span>'
  WHEN 6 THEN '<div class="editorial-note-block"><span class="editorial-note" title="' || {_e("left(x, 2 * t)")} || '">[<span class="note-body">' || {_e("left(x, 2 * t)")} || '</span>]</span></div>'
  ELSE '<p id="p' || i || '"><span class="par-num" title="¶' || i || '">¶' || i || '</span><span class="geo-initial">' || {_e("left(x, 1)")} || '</span>' || {_e("substr(x, 2, t)")} || '<span class="geo-quote" data-source="q' || i || '">' || {_e("substr(x, t + 1, 4)")}
    || '<em>in <span class="geo-rubric">' || {_e("left(x, 3)")} || '</span></em><span class="editorial-note note-type-editorial" title="see ' || {_e("left(x, 6)")} || '">[<span class="note-body">see ' || {_e("left(x, 6)")} || ' <span class="note-resp">— Editor</span></span>]</span>'
    || {_e("substr(x, t + 5, 5)")} || '</span><span class="app-inline" data-app="app-' || app || '" title="var. ' || app || '">' || {_e("left(x, 5)")} || '!</span>'
    || '<span class="lex-word" data-lemma="l' || i || '">' || {_e("left(x, 4)")} || 'x</span>plain' || {_e("substr(x, 2 * t + 1)")} || '</p>' END AS s FROM a)"""


@query(f"WITH {MIXED} SELECT doc, md5(string_agg(s, chr(10) ORDER BY i)) AS digest, count(*) FILTER (para) AS paragraphs FROM html GROUP BY doc")
def tei_page_html(spark, d):
    paragraphs = (F.col("tag") == "p") & F.col("attrs").isNotNull() & (pages.attr("xml_id") != "")
    html = pages.text_bodies(pages.body_nodes(_mixed_docs(spark, d)), editors={"ed": "Editor"}, counts={"paragraphs": paragraphs}).filter("html <> ''")
    return html.select("doc", F.md5("html").alias("digest"), "paragraphs")


READINGS = {"orthographic": ("rdg-orth", "orth."), "lexical": ("rdg-lex", "lex."), "omission": ("rdg-om", "om.")}


@query(f"""WITH {MIXED} SELECT doc, app::BIGINT AS nth, left(x, 5) || '!' AS lemma, CASE WHEN length(x) % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS readings, k AS "type",
  CASE k WHEN 'lexical' THEN 'rdg-lex' WHEN 'omission' THEN 'rdg-om' ELSE 'rdg-orth' END AS css, CASE k WHEN 'lexical' THEN 'lex.' WHEN 'omission' THEN 'om.' ELSE 'orth.' END AS label
FROM (SELECT *, CASE WHEN length(x) % 2 = 0 THEN 'orthographic' ELSE (['lexical', 'omission', 'odd'])[(length(x) % 3) + 1] END AS k FROM html WHERE para)""")
def apparatus_entries(spark, d):
    return pages.apparatus_entries(_mixed_nodes(spark, d), READINGS)


def _noted(spark, d):
    """Nested sections with lists and notes; every third section calls the first note again, every fifth a note that isn't there."""

    def content(x, i, k):
        again = F.when(i % 3 == 2, '<ref target="#n0">again</ref>').when(i % 5 == 4, '<ref target="#none">lost</ref>').otherwise("")
        return _joined(
            "<head>", _text(F.left(x, F.lit(12))), "</head><p>", _text(F.left(x, F.lit(5))), '<note xml:id="n', k, '">', _text(F.substring(x, 3, 8)), " <hi>in<note>deep</note></hi></note>", again, "<hi>e</hi></p><list><item>", _text(F.left(x, F.lit(2))), "</item><item>two</item></list>",
        )

    one, end = _nested("div", content)
    return markup.node_table(_lined(spark, d, one, "<body>", lambda n: F.concat(end(n), F.lit("</body>"))))


@query(f"""WITH {LINED}, n AS (SELECT doc, 2 * i + 1 AS nth, 'n' || i AS note_id, substr(x, 3, 8) || ' indeep' AS text, i FROM lines UNION ALL SELECT doc, 2 * i + 2, NULL, 'deep', i FROM lines)
SELECT doc, nth::BIGINT AS nth, note_id, text, CASE WHEN note_id = 'n0' THEN (SELECT count(*) FROM lines l WHERE l.doc = n.doc AND l.i % 3 = 2) ELSE 0 END AS calls FROM n""")
def footnotes(spark, d):
    return pages.called_notes(_noted(spark, d))


@query(f"""WITH RECURSIVE {OUTLINE}, r AS (SELECT doc, i, place::VARCHAR AS number FROM placed WHERE up IS NULL UNION ALL SELECT p.doc, p.i, r.number || '.' || p.place FROM placed p JOIN r ON r.doc = p.doc AND r.i = p.up),
s AS (SELECT p.doc, p.i, p.level, lag(p.level) OVER (PARTITION BY p.doc ORDER BY p.i) AS before, row_number() OVER (PARTITION BY p.doc ORDER BY p.i DESC) = 1 AS at_end,
  '<section id="s' || p.i || '"><h' || (p.level + 1) || '>' || number || ' ' || {_e("left(x, 12)")} || '</h' || (p.level + 1) || '><p>' || {_e("left(x, 5)")} || '<sup><a href="#fn-' || (2 * p.i + 1) || '">' || (2 * p.i + 1) || '</a></sup>'
    || CASE WHEN p.i % 3 = 2 THEN '<sup><a href="#fn-1">1</a></sup>' WHEN p.i % 5 = 4 THEN 'lost' ELSE '' END || '<em>e</em></p><ul><li>' || {_e("left(x, 2)")} || '</li><li>two</li></ul>' AS s,
  '<li id="fn-' || (2 * p.i + 1) || '">' || {_e("substr(x, 3, 8)")} || ' indeep</li><li id="fn-' || (2 * p.i + 2) || '">deep</li>' AS f FROM placed p JOIN r ON r.doc = p.doc AND r.i = p.i)
SELECT doc, md5(string_agg(CASE WHEN before IS NULL THEN '' ELSE repeat('</section>', before - level + 1) END || s || CASE WHEN at_end THEN repeat('</section>', level) ELSE '' END, '' ORDER BY i) || '<ol>' || string_agg(f, '' ORDER BY i) || '</ol>') AS digest FROM s GROUP BY doc""")
def article_html(spark, d):
    return pages.articles(_noted(spark, d)).select("doc", F.md5("html").alias("digest"))


# --- Grammar --------------------------------------------------------------------------------------

RNG = """<grammar xmlns="http://relaxng.org/ns/structure/1.0"><start><ref name="tei"/></start>
<define name="tei"><element name="TEI"><element name="text"><element name="body"><zeroOrMore><choice><ref name="app"/><ref name="p"/></choice></zeroOrMore></element></element></element></define>
<define name="app"><element name="app"><attribute name="n"/><optional><attribute name="type"><choice><value>lexical</value><value>addition</value></choice></attribute></optional>
  <optional><ref name="lem"/></optional><oneOrMore><ref name="rdg"/></oneOrMore><zeroOrMore><ref name="note"/></zeroOrMore></element></define>
<define name="lem"><element name="lem"><text/></element></define><define name="rdg"><element name="rdg"><mixed><zeroOrMore><ref name="hi"/></zeroOrMore></mixed></element></define>
<define name="note"><element name="note"><text/></element></define><define name="hi"><element name="hi"><text/></element></define><define name="list"><element name="list"><empty/></element></define>
<define name="p"><element name="p"><interleave><optional><ref name="hi"/></optional><ref name="list"/></interleave></element></define></grammar>"""


def _modelled(x, i, k):
    """Entries and paragraphs whose children follow the lengths of the line's words."""
    size, words = F.char_length(x), F.regexp_extract_all(x, F.lit(r"(\p{L}+)"), F.lit(1))
    n = lambda w: F.char_length(w)
    in_app = lambda w: F.when(n(w) >= 11, "<gap/>").when(n(w) % 4 == 0, "<lem>l</lem>").when(n(w) % 4 == 3, "<note>n</note>").otherwise("<rdg>r<hi>h</hi></rdg>")
    in_p = lambda w: F.when(n(w) % 2 == 0, "<hi>h</hi>").otherwise("<list/>")
    app = _joined(
        "<app", F.when(size % 5 != 0, _joined(' n="', k, '"')).otherwise(""), F.when(size % 3 == 1, ' type="lexical"').when(size % 3 == 2, ' type="odd"').otherwise(""), F.when(size % 11 == 0, ' extra="1"').otherwise(""), ">",
        F.when(size % 7 == 0, "x").otherwise(" "), F.array_join(F.transform(F.slice(words, 1, 6), in_app), "\n"), "</app>",
    )
    return F.when(i % 2 == 0, app).otherwise(_joined("<p>", F.array_join(F.transform(F.slice(words, 1, 3), in_p), ""), "</p>"))


@query(rf"""WITH {LINED}, w AS (SELECT doc, i, length(x) AS n, regexp_extract_all(x, '\p{{L}}+') AS w FROM lines),
k AS (SELECT doc, i, n, i % 2 = 0 AS app, CASE WHEN i % 2 = 0 THEN array_to_string(list_transform(w[1:6], lambda y: CASE WHEN length(y) >= 11 THEN 'g' WHEN length(y) % 4 = 0 THEN 'l' WHEN length(y) % 4 = 3 THEN 'n' ELSE 'r' END), '')
  ELSE array_to_string(list_transform(w[1:3], lambda y: CASE WHEN length(y) % 2 = 0 THEN 'h' ELSE 't' END), '') END AS s FROM w),
p AS (SELECT *, CASE WHEN app THEN length(regexp_extract(s, '^l?(r+n*)?')) ELSE length(regexp_extract(s, '^(th?|ht?)?')) END AS good FROM k),
e AS (SELECT doc, i, 0 AS kind, 'app: attribute n missing' AS error FROM p WHERE app AND n % 5 = 0 UNION ALL SELECT doc, i, 1, 'app: attribute extra not allowed' FROM p WHERE app AND n % 11 = 0
  UNION ALL SELECT doc, i, 2, 'app: attribute type has a wrong value' FROM p WHERE app AND n % 3 = 2 UNION ALL SELECT doc, i, 3, 'app: text not allowed' FROM p WHERE app AND n % 7 = 0
  UNION ALL SELECT doc, i, 4, CASE WHEN app THEN 'app' ELSE 'p' END || ': content incomplete' FROM p WHERE good = length(s) AND NOT regexp_matches(s, CASE WHEN app THEN '^l?r+n*$' ELSE '^(t|th|ht)$' END)
  UNION ALL SELECT doc, i, 5, CASE WHEN app THEN 'app: ' ELSE 'p: ' END || CASE s[good + 1] WHEN 'g' THEN 'gap' WHEN 'l' THEN 'lem' WHEN 'n' THEN 'note' WHEN 'r' THEN 'rdg' WHEN 'h' THEN 'hi' ELSE 'list' END || ' not allowed here' FROM p WHERE good < length(s)),
o AS (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY i, kind) AS nth, error, count(*) OVER (PARTITION BY doc) AS errors FROM e)
SELECT doc, nth, error, errors FROM o WHERE nth <= 5""")
def tei_grammar(spark, d):
    return grammar.first_errors(markup.node_table(_lined(spark, d, _modelled)), grammar.read_grammar(RNG))
