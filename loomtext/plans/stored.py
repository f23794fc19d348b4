"""Queries that write tables in their stored forms and read them back, and those on columns, orders and page parts that joins add."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.functions import strings
from loomtext.operators import catalogue, growth, inject, lookup, match, oov, ordering, render, validate
from loomtext.plans import base, corpus, tei, trees
from loomtext.plans.base import MATCHED, PRIMARY, query, table
from loomtext.plans.corpus import OOV
from loomtext.plans.trees import LINED, MIXED
from loomtext.sources import markup, scratch, tables

# --- Written and read back ------------------------------------------------------------------------


@query("""SELECT 'c' || conv_id || '-' || turn AS xml_id, role AS lemma, replace(coalesce(text, ''), chr(10), ' / ') AS definition, 'talk' AS source_id, CASE WHEN turn % 2 = 0 THEN '"q" T' END AS source_siglum, conv_id || '|' || turn AS cross_refs FROM conversations""")
def dictionary_file(spark, d):
    c = table(spark, d, "conversations")
    ident = lambda sep: F.concat(F.col("conv_id").cast("string"), F.lit(sep), F.col("turn").cast("string"))
    rows = c.select(
        F.concat(F.lit("c"), ident("-")).alias("xml_id"), F.col("role").alias("lemma"), F.regexp_replace(F.coalesce("text", F.lit("")), "\n", " / ").alias("definition"), F.lit("talk").alias("source_id"),
        F.when(F.col("turn") % 2 == 0, '"q" T').otherwise("").alias("source_siglum"), F.array(F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("cross_refs"),
    )
    path = scratch.new_path(spark, "dictionary")
    tables.write_tsv(rows, path)
    back = tables.read_dictionary(spark, path).unionByName(tables.read_dictionary(spark, path + "-absent"))
    return back.withColumn("definition", F.coalesce("definition", F.lit("")))


@query(r"""WITH l AS (SELECT trim(unnest(string_split(text, chr(10)))) AS w FROM documents), k AS (SELECT CASE WHEN length(w) % 5 = 0 THEN '#' || w ELSE w END AS w FROM l), s AS (SELECT w FROM k WHERE w <> '' AND NOT starts_with(w, '#'))
SELECT w AS word FROM s UNION SELECT lower(w) FROM s""")
def stop_word_file(spark, d):
    lines = table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("l")).select(F.trim("l").alias("w"))
    path = scratch.new_path(spark, "stop-words")
    lines.select(F.concat(F.when(F.char_length("w") % 5 == 0, "#").otherwise(""), "w", F.lit("  ")).alias("value")).write.text(path)
    return tables.word_list(spark.read.text(path), F.lower).unionByName(tables.read_stopwords(spark, path + "-absent"))


@query(f"""WITH {tei.NODES} SELECT doc || '_' || para_id || '_t' || k AS token_id, span AS surface, lower(CASE WHEN is_first THEN initial_char || span ELSE span END) AS norm, doc AS text_id, para_id, node_idx::INT AS node_idx, is_tail = 1 AS is_tail,
  s::INT AS char_start, (s + length(span))::INT AS char_end, CASE WHEN initial_char = '' THEN NULL ELSE initial_char END AS initial_char FROM toks""")
def token_file(spark, d):
    path = scratch.new_path(spark, "tokens")
    tables.write_tsv(tei.tei_words(spark, d), path, "gzip")  # ids repeat from row to row
    return tables.read_tokens(spark, path)


@query(f"""WITH {PRIMARY} SELECT key, xml_id, 'benchmark' AS source, 'item' || item_id AS lemma, in_lexicon FROM primflag""")
def lookup_file(spark, d):
    path = scratch.new_path(spark, "lookup")
    tables.write_json(base.primary(spark, d), path)
    return tables.read_lookup(spark, path).select("key", "xml_id", "source", "lemma", "in_lexicon")


@query("""SELECT lower(n_name) AS surface, 'n' || n_nationkey AS id FROM nation""")
def carryover_file(spark, d):
    n = table(spark, d, "nation")
    one = n.agg(F.map_from_entries(F.collect_list(F.struct(F.lower("n_name"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))))).alias("m"))  # a corpus-wide map is one object
    path = scratch.new_path(spark, "carry-over")
    one.select(F.to_json("m").alias("value")).write.text(path)
    return tables.read_carryover(spark, path).unionByName(tables.read_carryover(spark, path + "-absent"))


@query("""WITH k AS (SELECT (SELECT count(*) FROM region) AS skip, unnest(generate_series(0, (SELECT count(*) FROM supplier)::BIGINT - 1)) AS k)
SELECT (k // 2 + 1) || CASE WHEN k % 2 = 0 THEN 'r' ELSE 'v' END AS folio, 'https://images.example/iiif:' || lpad((k + skip + 1)::VARCHAR, 4, '0') AS facs, (k + skip + 1)::INT AS sp,
  'https://images.example/iiif:' || lpad((k + skip + 1)::VARCHAR, 4, '0') || '/full/full/0/default.jpg' AS tile_url, 'https://viewer.example?sp=' || (k + skip + 1) AS viewer_url FROM k""")
def folio_file(spark, d):
    """As many folios as there are suppliers, behind as many images as regions, written and found at the second of two places."""
    skip, n = table(spark, d, "region").count(), table(spark, d, "supplier").count()
    path = scratch.new_path(spark, "folios")
    tables.write_json(tables.folio_map(spark, skip, skip + n, "https://images.example/iiif", "https://viewer.example"), path)
    return tables.read_folio_map(spark, path + "-absent", path).select("folio", "facs", "sp", "tile_url", "viewer_url")


@query(f"WITH {MIXED} SELECT doc, doc || '.html' AS path, md5(string_agg(s, chr(10) ORDER BY i)) AS digest FROM html GROUP BY doc")
def page_files(spark, d):
    """Pages of the walking renderer, written and read again."""
    made = render.text_pages(trees._lined(spark, d, trees._mixed, '<body><div type="text">', "</div><div><p>not shown</p></div></body>"), editors={"ed": "Editor"})
    path = scratch.new_path(spark, "pages")
    tables.write_pages(made.filter("html <> ''").select(F.concat("doc", F.lit(".html")).alias("path"), "html"), path)
    return spark.read.parquet(path).select(F.regexp_extract("path", r"^(.*)\.html$", 1).alias("doc"), "path", F.md5("html").alias("digest"))


@query("""SELECT 't' || s_suppkey AS xml_id, 'd' || doc_id AS doc, md5(coalesce(text, '')) AS digest FROM supplier JOIN documents ON doc_id = s_suppkey WHERE s_suppkey % 3 <> 0 AND s_suppkey % 2 = 0""")
def texts_with_files(spark, d):
    """Catalogue rows whose file is there: a third has no path, and only even ones have a file."""
    s, docs = table(spark, d, "supplier"), table(spark, d, "documents").filter("doc_id % 2 = 0")
    key = F.col("s_suppkey").cast("string")
    texts = s.select(F.concat(F.lit("t"), key).alias("xml_id"), F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit("texts//d"), key, F.lit(".xml"))).alias("file_path"))
    doc = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    files = docs.select(F.concat(F.lit("file:///data/texts/"), doc, F.lit(".xml")).alias("path"), doc.alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    return tables.with_files(texts, files, "/data").select("xml_id", "doc", F.md5("text").alias("digest"))


# --- Orders ---------------------------------------------------------------------------------------


@query(f"""WITH {OOV}, seen AS (SELECT surface, min(doc_id) AS first_seen FROM words GROUP BY surface)
SELECT surface, category, row_number() OVER (ORDER BY list_position(['REVIEW', 'VERB', 'FUNCTION', 'RARE'], category), freq DESC, first_seen, surface) AS place FROM oov JOIN seen USING (surface)""")
def oov_places(spark, d):
    """The place of each unmatched type: by category, falling frequency, first text and spelling."""
    first = base.words(spark, d).groupBy("surface").agg(F.min("doc_id").alias("first_seen"))
    found = corpus.unmatched(spark, d).select("surface", "category", "freq").join(first, "surface")
    return ordering.ranked(found, [oov.rank(), -F.col("freq"), "first_seen", "surface"], "place").select("surface", "category", "place")


@query("""SELECT c_mktsegment AS segment, r.n AS names, md5(array_to_string(r.l, '|')) AS digest FROM (SELECT c_mktsegment, count(*) AS n, list(c_name ORDER BY c_name) AS l FROM customer WHERE c_acctbal > 0 GROUP BY 1) r""")
def section_lists(spark, d):
    """Sections with their members in code-point order, empty ones dropped."""
    c = table(spark, d, "customer")
    groups = c.select(F.col("c_mktsegment").alias("segment")).distinct().union(spark.createDataFrame([("EMPTY",)], "segment string"))
    members = c.filter("c_acctbal > 0").select(F.col("c_mktsegment").alias("segment"), "c_name")
    return catalogue.sections(groups, members, "segment", F.col("c_name"), "c_name").select("segment", F.size("items").cast("long").alias("names"), F.md5(F.array_join("items", "|")).alias("digest"))


@query(r"""WITH f AS (SELECT part.*, p_size % 2 = 0 AS second FROM part)
SELECT 'p' || p_partkey AS xml_id, row_number() OVER (ORDER BY second, p_name, p_partkey) AS place, CASE WHEN second THEN 'unverified' END AS certainty FROM f""")
def skeleton_places(spark, d):
    """New entries in the order in which they are added: the first dictionary's before the second's, each by lemma."""
    p = table(spark, d, "part")
    found = p.select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("match_id"), F.col("p_name").alias("lemma"), F.lit("").alias("def_ka"), F.col("p_brand").alias("source"), F.when(F.col("p_size") % 2 == 0, "master").otherwise("primary").alias("tier"), F.lit(1).alias("freq"), F.lit(1).alias("text_count"))
    made = growth.skeletons(found, {}).withColumn("key", F.regexp_extract("xml_id", r"(\d+)", 1).cast("long"))
    return ordering.ranked(made, ["rank", "key"], "place").select("xml_id", "place", "certainty")


# --- Joined columns and strings -------------------------------------------------------------------


@query(f"""WITH {LINED} SELECT doc, i::VARCHAR AS folio, 'S' AS witness, CASE WHEN length(x) % 2 = 0 THEN 'f' || i ELSE n_name END AS facs, CASE WHEN n_nationkey IS NULL THEN 0 ELSE n_nationkey + 100 END::INT AS sp
FROM lines LEFT JOIN nation ON n_nationkey = i""")
def page_break_images(spark, d):
    made = trees._lined(spark, d, lambda x, i, k: F.concat(F.lit('<pb wit="#S" n="'), k, F.lit('"'), F.when(F.char_length(x) % 2 == 0, F.concat(F.lit(' facs="f'), k, F.lit('"'))).otherwise(""), F.lit("/>")))
    folios = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("folio"), F.col("n_name").alias("facs"), (F.col("n_nationkey") + 100).cast("int").alias("sp"))
    return catalogue.page_breaks(made, folios).select("doc", "folio", "witness", "facs", "sp")


@query("""WITH e AS (SELECT 's' || s_suppkey AS xml_id, 'n' || (s_nationkey * 2) AS lex_id FROM supplier), l AS (SELECT 'n' || n_nationkey AS xml_id, lower(n_name[1]) AS slug FROM nation)
SELECT e.xml_id, e.lex_id, coalesce(slug, 'a') AS slug FROM e LEFT JOIN l ON l.xml_id = lex_id""")
def authority_pages(spark, d):
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    named = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    entries = s.select(named("s", F.col("s_suppkey")).alias("xml_id"), named("n", F.col("s_nationkey") * 2).alias("lex_id"))
    lexicon = n.select(named("n", F.col("n_nationkey")).alias("xml_id"), F.lower(F.left("n_name", F.lit(1))).alias("slug"))
    return catalogue.authority_pages(entries, lexicon).select("xml_id", "lex_id", "slug")


@query(f"""WITH {tei.ATTESTED}, w AS (SELECT text_id, para_id, target_id FROM att WHERE kind = 'entry')
SELECT w.*, 'item' || item_id AS lemma, left(text, 20) AS def FROM w LEFT JOIN benchmark ON target_id = 'w-' || left(lower(text), 2) AND item_id = (SELECT min(b.item_id) FROM benchmark b WHERE 'w-' || left(lower(b.text), 2) = target_id)""")
def word_popups(spark, d):
    words = tei.attested(spark, d).filter("kind = 'entry'").select("text_id", "para_id", "target_id")
    b = table(spark, d, "benchmark")
    popups = lookup.first_wins(b.select(F.concat(F.lit("w-"), F.left(F.lower("text"), F.lit(2))).alias("xml_id"), F.concat(F.lit("item"), F.col("item_id").cast("string")).alias("lemma"), F.left("text", F.lit(20)).alias("def"), "item_id"), "xml_id", "item_id")
    return catalogue.with_popups(words, popups.drop("item_id")).select("text_id", "para_id", "target_id", "lemma", "def")


@query("""SELECT page_id, replace(url_encode(coalesce(url, '')), '%2F', '/') AS encoded, lower(coalesce(url, '')) AS low, '{"id":' || page_id || ',"url":"' || coalesce(url, '') || '"}' AS json FROM pages""")
def template_strings(spark, d):
    p, url = table(spark, d, "pages"), F.coalesce("url", F.lit(""))
    return p.select("page_id", strings.url_encoded(url).alias("encoded"), F.lower(url).alias("low"), F.to_json(F.struct(F.col("page_id").alias("id"), url.alias("url"))).alias("json"))


# --- Words tagged by a map ------------------------------------------------------------------------


@query(f"""WITH {LINED}, {PRIMARY}, r AS (SELECT doc, i, unnest(regexp_extract_all(x, '\\p{{L}}+|[^\\p{{L}}]+')) AS s, generate_subscripts(regexp_extract_all(x, '\\p{{L}}+|[^\\p{{L}}]+'), 1) AS k FROM lines),
t AS (SELECT doc, i, string_agg(CASE WHEN xml_id IS NULL THEN replace(replace(replace(s, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') ELSE '<w lemma="#' || xml_id || '">' || s || '</w>' END, '' ORDER BY k) AS t, count(xml_id) AS n FROM r LEFT JOIN prim ON key = s AND doc LIKE '%0' GROUP BY ALL),
p AS (SELECT doc, string_agg('<p>' || t || '<note>' || left(t.t, 0) || 'the</note><seg>the</seg></p>', '' ORDER BY i) AS body, sum(n + CASE WHEN doc LIKE '%0' AND EXISTS (SELECT 1 FROM prim WHERE key = 'the') THEN 1 ELSE 0 END)::INT AS tagged FROM t GROUP BY doc)
SELECT doc, tagged, md5('<TEI xmlns="{tei.NS}"><text><body>' || CASE WHEN doc LIKE '%0' AND EXISTS (SELECT 1 FROM prim WHERE key = 'the') THEN replace(body, '<seg>the</seg>', '<seg><w lemma="#' || (SELECT xml_id FROM prim WHERE key = 'the') || '">the</w></seg>') ELSE body END || '</body></text></TEI>') AS digest FROM p""")
def surfaces_tagged(spark, d):
    """Words of every tenth document tagged by the first dictionary's keys, outside notes."""
    made = trees._lined(spark, d, lambda x, i, k: F.concat(F.lit("<p>"), tei._escaped(x), F.lit("<note>the</note><seg>the</seg></p>"))).filter("not text like '%<body></body>%'")
    some = made.filter(F.endswith("doc", F.lit("0"))).select(F.col("doc").alias("text_id"))
    keys = base.primary(spark, d).select(F.col("key").alias("surface"), F.col("xml_id").alias("id"))
    words = made.select(F.col("doc").alias("text_id"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1)))).alias("surface"))
    known = words.join(some, "text_id", "left_semi").join(keys, "surface").select("text_id", "surface", "id")
    return inject.tag_surfaces(made, known, wide_word=r"[^\W\d_]+").select("doc", "tagged", F.md5("text").alias("digest"))


# --- Typed rows of made articles, dictionaries and catalogues ---------------------------------------


def _x(c):
    return tei._escaped(c)


@query("""SELECT item_id::VARCHAR AS doc, CASE WHEN item_id % 5 = 0 THEN item_id::VARCHAR ELSE 'a' || item_id END AS xml_id, CASE item_id % 3 WHEN 0 THEN 'ka ' || trim(left(text, 10)) WHEN 1 THEN trim(left(text, 10)) ELSE CASE WHEN item_id % 2 = 0 THEN 'sub' WHEN item_id % 5 = 0 THEN item_id::VARCHAR ELSE 'a' || item_id END END AS title,
  CASE WHEN item_id % 2 = 0 THEN 'sub' ELSE '' END AS title_en, CASE WHEN item_id % 4 = 0 THEN 'ka-name' WHEN item_id % 4 = 1 THEN 'plain' ELSE '' END AS author, CASE item_id % 3 WHEN 0 THEN '2020' WHEN 1 THEN 'spring' ELSE '' END AS "date",
  CASE WHEN item_id % 2 = 0 THEN 'short' ELSE left(regexp_replace(trim(left(text, 200) || ' [x]' || ' […]'), '\\s+', ' ', 'g'), 280) || '…' END AS abstract FROM benchmark""")
def tei_articles(spark, d):
    """Metadata of articles with every fall-back: title, author, date, abstract from the first paragraph."""
    b, k = table(spark, d, "benchmark"), F.col("item_id")
    some = lambda cases, default="": F.coalesce(*[F.when(c, v if not isinstance(v, str) else F.lit(v)) for c, v in cases], F.lit(default))
    head, whole = _x(F.left("text", F.lit(10))), _x(F.left("text", F.lit(200)))
    docs = tei._made(
        b, "item_id", F.when(k % 5 == 0, "<TEI2>").otherwise(F.concat(F.lit('<TEI2 xml:id="a'), k.cast("string"), F.lit('">'))), "<titleStmt>",
        some([(k % 3 == 0, F.concat(F.lit("<title>en</title><title xml:lang='ka'>ka "), head, F.lit("</title>"))), (k % 3 == 1, F.concat(F.lit("<title>"), head, F.lit("</title>")))]), some([(k % 2 == 0, "<title type='sub'>sub</title>")]),
        some([(k % 4 == 0, "<author>x<persName xml:lang='ka'>ka-name</persName></author>"), (k % 4 == 1, "<author>plain</author>")]), "</titleStmt><publicationStmt>", some([(k % 3 == 0, "<date when='2020'>twenty</date>"), (k % 3 == 1, "<date>spring</date>")]), "</publicationStmt>",
        some([(k % 2 == 0, "<abstract><p>short</p></abstract>")]), "<text><body><p>", whole, " <supplied>x</supplied><note>no</note> <gap/></p><p>more</p></body></text></TEI2>",
    )
    # the made document around the article is taken off
    docs = docs.withColumn("text", F.regexp_replace(F.replace("text", F.lit("TEI2"), F.lit("TEI")), f'(?s)^<TEI xmlns="{tei.NS}">(.*)</TEI>$', "$1"))
    broken = spark.createDataFrame([("broken", "<TEI><titleStmt>")], "doc string, text string")
    return catalogue.articles(docs.unionByName(broken)).select("doc", "xml_id", "title", "title_en", "author", "date", "abstract")


@query(f"""WITH RECURSIVE {trees.OUTLINE}, n AS (SELECT DISTINCT doc FROM lines)
SELECT doc, 's' || i AS xml_id, level - 1 AS level, NULL AS kind, trim(regexp_replace(left(x, 12) || ' [x]', '\\s+', ' ', 'g')) AS head, level <= 2 AS in_contents FROM lev
UNION ALL SELECT doc, 'e', 0, 'errata', 'Errata', true FROM n""")
def article_sections(spark, d):
    """Sections of articles by the walking reader, headings without notes; of the back matter the kinds that are shown."""
    content = lambda x, i, k: F.concat(F.lit("<head>"), _x(F.left(x, F.lit(12))), F.lit("<lb/><note>no</note><supplied>x</supplied></head><p>p</p>"))
    one, end = trees._nested("div", content)
    back = '</body><back><div type="errata" xml:id="e"><head>Errata</head></div><div type="index"><head>Index</head></div></back>'
    docs = trees._lined(spark, d, one, "<body>", lambda n: F.concat(end(n), F.lit(back))).filter("not text like '%<text><body></body>%'")
    return catalogue.article_sections(docs).select("doc", "xml_id", "level", "kind", "head", catalogue.in_contents().alias("in_contents"))


@query(f"""WITH {LINED}, e AS (SELECT *, {trees._e("left(x, 20)")} AS t, {trees._e("left(x, 6)")} AS h FROM lines)
SELECT doc, 's' || i AS section, 'head' AS kind, '' || h AS html FROM e WHERE i % 2 = 0
UNION ALL SELECT doc, 's' || i, 'pb', '<div class="pb-block"><span class="pb">[' || i || ']</span></div>' FROM e WHERE false
UNION ALL SELECT doc, 's' || i, 'p', CASE WHEN i % 2 = 1 THEN '<strong class="run-in-head" id="s' || i || '">' || h || '</strong> ' ELSE '' END || t FROM e
UNION ALL SELECT doc, 's' || i, 'list', '<div class="art-list-wrap"><ul class="art-list"><li>one</li><li><p class="item-p">two</p></li></ul></div>' FROM e
UNION ALL SELECT doc, 's' || i, 'table', '<div class="table-wrap"><table class="art-table"><caption>c</caption><tr><th colspan="2">' || h || '</th></tr><tr><td>1</td><td rowspan="3">2</td></tr></table></div>' FROM e
UNION ALL SELECT doc, 's' || i, 'quote', '<blockquote class="block-quote"><div class="lg"><span class="l">' || h || '</span><div class="lg"><span class="l">b</span></div><span class="l">c</span></div></blockquote>' FROM e""")
def article_blocks(spark, d):
    """Blocks of articles by the walking renderer: headings that run into the first paragraph, lists, tables, verses."""

    def one(x, i, k):
        head = F.concat(F.lit("<head"), F.when(i % 2 == 1, ' rend="run-in"').otherwise(""), F.lit(">"), _h(F.left(x, F.lit(6))), F.lit("</head>"))
        return F.concat(
            F.lit('<div xml:id="s'), k, F.lit('">'), head, F.lit("<p>"), _h(F.left(x, F.lit(20))), F.lit("</p><list><item>one</item><item><p>two</p></item></list><table><head>c</head><row role='label'><cell cols='2'>"), _h(F.left(x, F.lit(6))),
            F.lit("</cell></row><row><cell>1</cell><cell rows='3'>2</cell></row></table><lg><l>"), _h(F.left(x, F.lit(6))), F.lit("</l><lg><l>b</l></lg><seg>c</seg></lg></div>"),
        )

    return render.article_blocks(trees._lined(spark, d, one)).select("doc", "section", "kind", "html")


def _h(x):
    return trees._text(x)


@query(r"""WITH e AS (SELECT item_id, 'e' || (item_id // 2) AS xml_id, text FROM benchmark WHERE item_id % 7 <> 3)
SELECT xml_id, 'dict' AS source, CASE WHEN item_id % 2 = 0 THEN 'second' ELSE 'item' || item_id END AS lemma, trim(left(text, 15)) || ' / d2' AS def_ka, CASE WHEN item_id % 2 = 0 THEN 'item' || item_id || '|second|stem' ELSE 'item' || item_id || '|stem' END AS forms, CASE WHEN item_id % 3 = 0 THEN 'ex' ELSE '' END AS examples FROM e""")
def tei_dictionary(spark, d):
    """Entries of a dictionary in markup: the last lemma, inflected forms cut at their hyphen, definitions joined, entries without an id dropped."""
    b, k = table(spark, d, "benchmark"), F.col("item_id")
    ident = F.when(k % 7 == 3, "").otherwise(F.concat(F.lit(' xml:id="e'), F.floor(k / 2).cast("string"), F.lit('"')))
    docs = tei._made(
        b, "item_id", "<entry", ident, '><form type="lemma"><orth>item', k, "</orth>", F.when(k % 2 == 0, "<orth>second</orth>").otherwise(""), '</form><form type="inflected"><orth>stem-s</orth></form><sense><def>', _x(F.trim(F.left("text", F.lit(15)))),
        "</def><def>d2</def></sense>", F.when(k % 3 == 0, '<cit type="example"><quote>ex</quote></cit>').otherwise(""), "</entry>",
    )
    out = lookup.primary_entries(docs, "dict")
    return out.join(lookup.entry_ids(docs), "xml_id").select("xml_id", "source", "lemma", "def_ka", F.array_join("forms", "|").alias("forms"), F.array_join("examples", "|").alias("examples"))


@query("""WITH s AS (SELECT s_suppkey, unnest(generate_series(1, s_suppkey % 7)) AS k FROM supplier)
SELECT 'x' || s_suppkey AS xml_id, CASE WHEN k % 2 = 1 THEN 't' || k ELSE 'dict' || k END AS text_id, CASE WHEN k = 3 THEN 't3' ELSE 'label' || k END AS label, k % 2 = 0 AS is_dict_source, greatest(0, s_suppkey % 7 - 4) AS sources_more FROM s WHERE k <= 4""")
def lexicon_sources(spark, d):
    """The sources that an entry shows, four at most, corpus links told from dictionaries."""
    s, key = table(spark, d, "supplier"), F.col("s_suppkey")
    ref = lambda k: F.concat(F.lit('<xr type="source"><ref target="'), F.when(k % 2 == 1, "#t").otherwise("dict"), k.cast("string"), F.lit('">'), F.when(k == 3, "").otherwise(F.concat(F.lit("label"), k.cast("string"))), F.lit("</ref></xr>"))
    refs = F.when(key % 7 == 0, "").otherwise(F.array_join(F.transform(F.sequence(F.lit(1), (key % 7).cast("int")), ref), ""))
    docs = tei._made(s, "s_suppkey", '<entry xml:id="x', key, '"><form type="lemma"><orth>a', key, "</orth></form>", refs, "</entry>")
    e = catalogue.lexicon(docs, {}, {}, {}, {}, ("other", "Other"))
    return e.select("xml_id", F.explode("sources").alias("s"), "sources_more").select("xml_id", "s.text_id", "s.label", "s.is_dict_source", "sources_more")


@query("""SELECT 'n' || n_nationkey AS xml_id, lower(n_name) AS label, 'https://x.example/' || n_nationkey AS url FROM nation WHERE n_nationkey % 3 <> 0 AND n_nationkey % 4 <> 1""")
def author_links(spark, d):
    """Links of authors, kept if both their address and their label are given."""
    n, k = table(spark, d, "nation"), F.col("n_nationkey")
    link = F.concat(F.lit('<idno type="URI" subtype="'), F.when(k % 3 == 0, " ").otherwise(F.lower("n_name")), F.lit('">'), F.when(k % 4 == 1, "").otherwise(F.concat(F.lit("https://x.example/"), k.cast("string"))), F.lit("</idno>"))
    docs = tei._made(n, "n_nationkey", '<listPerson type="authors"><person xml:id="n', k, '"><persName xml:lang="ka">', F.col("n_name"), "</persName>", link, "</person></listPerson>")
    return catalogue.authors(docs).select("xml_id", F.explode("uri_links").alias("l")).select("xml_id", "l.label", "l.url")


# --- Branches that other tables never reach ---------------------------------------------------------


@query(f"""WITH {tei.ATTESTED}, k AS (SELECT DISTINCT 'w-' || left(lower(text), 2) AS id FROM benchmark) SELECT target_id, count(*) AS n FROM att WHERE kind = 'entry' AND target_id NOT IN (SELECT id FROM k) GROUP BY target_id""")
def dangling_lemmas(spark, d):
    """Lemmas of tagged words that no entry has."""
    words = tei.attested(spark, d).filter("kind = 'entry'").select("target_id")
    entries = table(spark, d, "benchmark").select(F.concat(F.lit("w-"), F.left(F.lower("text"), F.lit(2))).alias("id"))
    return validate.dangling(words, entries, "target_id", "id").groupBy("target_id").agg(F.count("*").alias("n"))


@query(f"""WITH {LINED}, h AS (SELECT doc, (['w', 'lem', 'rdg', 'head', 'note'])[(i % 5) + 1] AS a, (['w', 'lem', 'rdg', 'head', 'note'])[(length(x) % 5) + 1] AS b FROM lines)
SELECT doc, 'w in ' || k AS rule, sum(n)::BIGINT AS violations FROM (SELECT doc, a AS k, CASE WHEN a = 'w' THEN 1 + (b = 'w')::INT ELSE 1 + (b = 'w')::INT END AS n FROM h UNION ALL SELECT doc, b, 1 FROM h WHERE b <> a) GROUP BY ALL""")
def holder_violations(spark, d):
    """Words inside two nested holders of every kind."""
    kinds = F.array(*map(F.lit, validate.HOLDERS))

    def one(x, i, k):
        a, b = F.element_at(kinds, (i % 5).cast("int") + 1), F.element_at(kinds, (F.char_length(x) % 5).cast("int") + 1)
        return F.concat(F.lit("<"), a, F.lit("><seg><"), b, F.lit("><w>x</w></"), b, F.lit("></seg></"), a, F.lit(">"))

    return validate.violations(markup.node_table(trees._lined(spark, d, one)))


@query(f"""WITH {MATCHED} SELECT surface, match_id, left(text, 120) AS match_def_ka, length(text) > 120 AS was_cut FROM matched JOIN benchmark ON match_id = 'a' || item_id WHERE match_tier = 'primary'""")
def definitions_cut(spark, d):
    """What a first dictionary with long definitions says of each word, cut for display."""
    b = table(spark, d, "benchmark")
    said = b.select(F.concat(F.lit("a"), F.col("item_id").cast("string")).alias("xml_id"), F.col("text").alias("def_ka"))
    entries = base.primary_entries(spark, d).join(said, "xml_id")
    first = lookup.primary_lookup(entries, base.existing(spark, d), F.lower)
    # a key's lower case is a key too, so a word that meets the first dictionary in either form meets it by its norm
    types = lookup.types_meeting(base.words(spark, d).select("surface", "norm"), first.select(F.col("key").alias("norm")), "norm")
    m = match.match_types(types, base.stopwords(spark), base.authority(spark, d), first, base.secondary(spark, d), each=True).filter("match_tier = 'primary'")
    return m.join(said.select(F.col("xml_id").alias("match_id"), (F.char_length("def_ka") > 120).alias("was_cut")), "match_id").select("surface", "match_id", "match_def_ka", "was_cut")
