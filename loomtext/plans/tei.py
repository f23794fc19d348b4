"""Queries on marked-up documents made from ``documents``: every line is a paragraph, with an initial, notes, readings and references.

The markup is built by column functions, so the SQL can state the same documents, and the rows are what the operators
find in the parsed trees.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.operators import attest, catalogue, inject, tokens, validate
from loomtext.plans import base
from loomtext.plans.base import PRIMARY, query, table
from loomtext.sources import markup

NS = "http://www.tei-c.org/ns/1.0"
HEAD = f'<?xml-model href="m.rng"?><!-- made --><TEI xmlns="{NS}" xml:id="d'
END = "</body></text></TEI><!-- end -->"
WORD, OTHER = r"\p{L}+", r"[^\p{L}]+"


def _escaped(x):
    return F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _document(docs, paragraph):
    """(doc, text): a document of the non-empty lines of each text; ``paragraph`` makes the content of one from (line, its number)."""
    ident = F.col("doc_id").cast("string")
    one = lambda x, i: F.when(x == "", "").otherwise(F.concat(F.lit('<p xml:id="d'), ident, F.lit("-"), i.cast("string"), F.lit('">'), paragraph(x, i), F.lit("</p>")))
    body = F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), one), "")
    return docs.select(F.concat(F.lit("d"), ident).alias("doc"), F.concat(F.lit(HEAD), ident, F.lit('"><text><body><p>no id</p>'), body, F.lit(END)).alias("text"))


def _halves(x, _):
    """An initial and the first half after it, a note, the second half, and the first 30 characters once more in an element."""
    n = F.char_length(x)
    h = F.floor(n / 2).cast("int")
    return F.concat(
        F.lit('<hi rend="initial">Ⴀ</hi>'), _escaped(F.left(x, h)), F.lit("<note>a note</note><!-- c -->"), _escaped(F.substring(x, h + 1, n)), F.lit("<seg>"), _escaped(F.left(x, F.lit(30))), F.lit("</seg>"),
    )


def halved(spark, d):
    return _document(table(spark, d, "documents"), _halves)


def tei_words(spark, d):
    return tokens.tokens_of(halved(spark, d), word=WORD, other=OTHER, normalise=F.lower)


LINES = r"""lines AS (SELECT 'd' || doc_id AS doc, i - 1 AS nr, l[i] AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents), unnest(generate_series(1, len(l))) AS g(i) WHERE l[i] <> '')"""
NODES = (
    LINES
    + r""",
nodes AS (SELECT doc, doc || '-' || nr AS para_id, nr, 1 AS node_idx, 1 AS is_tail, 'ა' AS initial_char, line[:length(line) // 2] AS t FROM lines
  UNION ALL SELECT doc, doc || '-' || nr, nr, 2, 1, '', substr(line, length(line) // 2 + 1) FROM lines
  UNION ALL SELECT doc, doc || '-' || nr, nr, 3, 0, '', left(line, 30) FROM lines),
runs AS (SELECT * EXCLUDE (t, s), generate_subscripts(s, 1) AS i, unnest(s) AS span FROM (SELECT *, regexp_extract_all(t, '\p{L}+|[^\p{L}]+') AS s FROM nodes WHERE t <> '')),
placed AS (SELECT *, sum(length(span)) OVER (PARTITION BY para_id, node_idx ORDER BY i) - length(span) AS s, regexp_matches(span, '^\p{L}') AS is_word FROM runs),
toks AS (SELECT *, row_number() OVER (PARTITION BY para_id ORDER BY node_idx, i) - 1 AS k, row_number() OVER (PARTITION BY para_id, node_idx ORDER BY i) = 1 AS is_first FROM placed WHERE is_word)"""
)


@query(f"""WITH {NODES} SELECT doc AS text_id, para_id, count(*) AS n, md5(string_agg(doc || '_' || para_id || '_t' || k || '|' || span || '|' || lower(CASE WHEN is_first THEN initial_char || span ELSE span END) || '|' || node_idx || '|' || is_tail || '|'
  || s || '|' || (s + length(span)) || '|' || initial_char, chr(10) ORDER BY k)) AS digest FROM toks GROUP BY doc, para_id""")
def tei_tokens(spark, d):
    t = tokens.paragraph_tokens(halved(spark, d), word=WORD, other=OTHER)
    if not table(spark, d, "documents").groupBy("doc_id").count().filter("count > 1").isEmpty():
        t = t.groupBy("text_id", "para_id").agg(F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens"))  # paragraphs of rows that share an id
    said = lambda x: [x["node_idx"], x["is_tail"].cast("int"), x["char_start"], x["char_end"]]
    norm = lambda x: F.lower(F.when(x["first"], F.concat(x["initial_char"], x["surface"])).otherwise(x["surface"]))
    row = lambda x: F.concat_ws("|", F.concat_ws("_", "text_id", "para_id", F.concat(F.lit("t"), x["k"].cast("string"))), x["surface"], norm(x), *[c.cast("string") for c in said(x)], x["initial_char"])
    return t.select("text_id", "para_id", F.size("tokens").cast("long").alias("n"), F.md5(F.array_join(F.transform("tokens", row), "\n")).alias("digest"))


@query(f"""WITH {NODES}, {PRIMARY},
parts AS (SELECT r.doc, r.nr, r.node_idx, string_agg(CASE WHEN p.xml_id IS NULL THEN replace(replace(replace(span, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') ELSE '<w lemmaRef="#' || p.xml_id || '">' || span || '</w>' END, '' ORDER BY i) AS t, count(p.xml_id) AS n
  FROM runs r LEFT JOIN prim p ON p.key = span GROUP BY ALL),
paras AS (SELECT l.doc, l.nr, '<p xml:id="' || l.doc || '-' || l.nr || '"><hi rend="initial">Ⴀ</hi>' || coalesce(a.t, '') || '<note>a note</note><!-- c -->' || coalesce(b.t, '') || '<seg>' || c.t || '</seg></p>' AS p, coalesce(a.n, 0) + coalesce(b.n, 0) + c.n AS n
  FROM lines l LEFT JOIN parts a ON a.doc = l.doc AND a.nr = l.nr AND a.node_idx = 1 LEFT JOIN parts b ON b.doc = l.doc AND b.nr = l.nr AND b.node_idx = 2 LEFT JOIN parts c ON c.doc = l.doc AND c.nr = l.nr AND c.node_idx = 3),
texts AS (SELECT doc, string_agg(p, '' ORDER BY nr) AS body, sum(n) AS n FROM paras GROUP BY doc)
SELECT 'd' || doc_id AS doc, md5('{HEAD}' || doc_id || '"><text><body><p>no id</p>' || coalesce(body, '') || '{END}') AS digest, coalesce(n, 0)::INT AS tagged, 0 AS skipped, coalesce(n, 0) > 0 AS written
FROM documents LEFT JOIN texts ON doc = 'd' || doc_id""")
def tei_inject(spark, d):
    keys = base.primary(spark, d).select(F.col("key").alias("surface"), F.col("xml_id").alias("match_id"), F.lit("primary").alias("match_tier"), F.lit("benchmark").alias("match_source"), F.lit("exact").alias("confidence"))
    out = inject.inject_known(halved(spark, d), keys, WORD, OTHER, every=True)
    return out.select("doc", F.md5("text").alias("digest"), "tagged", "skipped", "written")


def _readings(x, i):
    """An apparatus entry and a page break whose attributes follow the line's number and length."""
    n = F.char_length(x)
    of = lambda values, k: F.element_at(F.array(*map(F.lit, values)), (k % len(values)).cast("int") + 1)
    return F.concat(
        F.lit('<pb ed="'), of(["#S", "#shanidze", "#other"], i), F.lit('" facs="'), of(["", "f"], n), F.lit('"/><app><lem resp="'), of(["#shanidze", "#x"], n), F.lit('">'), _escaped(F.left(x, F.lit(9))),
        F.lit('</lem><rdg wit="'), of(["#S", "#N"], n + i), F.lit('" type="'), of(["lexical", "odd", "", "lacuna"], n), F.lit('">'), F.when(i % 3 == 1, F.lit("<seg><w>x</w></seg>")).otherwise(""), F.lit("</rdg></app>"),
    )


@query(f"""WITH {LINES}, f AS (SELECT doc, nr, length(line) AS n FROM lines),
v AS (SELECT doc, unnest(list_filter([CASE WHEN nr % 3 = 1 THEN 'no w in rdg' END, CASE WHEN (n + nr) % 2 = 1 THEN 'rdg/@wit' END, CASE WHEN n % 4 = 1 THEN 'rdg/@type' END, CASE WHEN nr % 3 = 2 THEN 'pb/@ed' END,
  CASE WHEN nr % 3 = 0 AND n % 2 = 0 THEN 'pb/@facs' END, CASE WHEN n % 2 = 1 THEN 'lem/@resp' END], lambda x: x IS NOT NULL)) AS rule FROM f)
SELECT doc, rule, count(*) AS violations FROM v GROUP BY ALL""")
def tei_constraints(spark, d):
    return validate.rules(markup.node_table(_document(table(spark, d, "documents"), _readings)))


def _tagged(x, i):
    """A line whose first letters are a tagged word, and whose last ten characters a name."""
    n = F.char_length(x)
    first = F.regexp_extract(x, r"^\p{L}+", 0)
    rest = F.substring(x, F.char_length(first) + 1, F.greatest(n - F.char_length(first) - 10, F.lit(0)))
    name = F.substring(x, F.char_length(first) + 1 + F.char_length(rest), n)
    return F.concat(F.lit('<w lemmaRef="#w-'), F.lower(F.left(first, F.lit(2))), F.lit('">'), first, F.lit("</w>"), _escaped(rest), F.lit('<persName ref="#p-'), (n % 7).cast("string"), F.lit('">'), _escaped(name), F.lit("</persName>"))


def attested(spark, d):
    return attest.attestations(attest.references(_document(table(spark, d, "documents"), _tagged)))


ATTESTED = (
    LINES
    + r""",
cut AS (SELECT *, regexp_extract(line, '^\p{L}+') AS a FROM lines), cut2 AS (SELECT *, substr(line, length(a) + 1, greatest(length(line) - length(a) - 10, 0)) AS b FROM cut),
refs AS (SELECT doc, nr, line, 'entry' AS kind, 'w-' || lower(left(a, 2)) AS target_id, 0 AS s, length(a) AS n FROM cut2
  UNION ALL SELECT doc, nr, line, 'name', 'p-' || (length(line) % 7), CASE WHEN length(line) = length(a) + length(b) THEN 0 ELSE length(a) + length(b) END, length(line) - length(a) - length(b) FROM cut2),
att AS (SELECT target_id, kind, doc AS text_id, doc || '-' || nr AS para_id, (CASE WHEN s > 40 THEN '…' ELSE '' END)
  || trim(regexp_replace(substr(line, greatest(0, s - 40) + 1, least(length(line), s + n + 40) - greatest(0, s - 40)), '\s+', ' ', 'g')) || (CASE WHEN s + n + 40 < length(line) THEN '…' ELSE '' END) AS quote FROM refs)"""
)


@query(f"WITH {ATTESTED} SELECT * FROM att")
def tei_attestations(spark, d):
    return attested(spark, d).select("target_id", "kind", "text_id", "para_id", "quote")


@query(f"WITH {ATTESTED}, n AS (SELECT target_id, text_id, count(*) AS n FROM att GROUP BY ALL) SELECT target_id, text_id, n, count(*) OVER (PARTITION BY target_id) AS texts FROM n")
def tei_attested_texts(spark, d):
    return attest.per_text(attested(spark, d), "target_id")


@query(f"""WITH {LINES}, p AS (SELECT doc, nr, line, row_number() OVER (PARTITION BY doc ORDER BY nr) - 1 AS i FROM lines)
SELECT doc, (4 + 3 * i)::INT AS node, md5(line) AS digest FROM p UNION ALL SELECT 'd' || doc_id, 3, md5('no id') FROM documents""")
def tei_subtree_text(spark, d):
    nodes = markup.node_table(_document(table(spark, d, "documents"), _tagged))
    return markup.subtree_text(nodes, ["p"]).select("doc", "node", F.md5("full").alias("digest"))


@query("SELECT 'd' || doc_id AS doc, NOT regexp_matches(coalesce(text, ''), '[&<]') AS ok FROM documents")
def tei_wellformed(spark, d):
    raw = F.concat(F.lit("<a>"), F.coalesce("text", F.lit("")), F.lit("</a>"))
    return markup.well_formed(table(spark, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("doc"), raw.alias("text")))


# --- Rows of catalogue-like documents ---------------------------------------------------------------


def _made(rows, ident, *parts):
    """(doc, text): one small document a row. The rows are spread first: a few megabytes of them are one task's, but a long work when parsed."""
    rows = rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, ident)
    text = F.concat(F.lit(f'<TEI xmlns="{NS}">'), *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts], F.lit("</TEI>"))
    return rows.select(F.col(ident).cast("string").alias("doc"), text.alias("text"))


@query("""SELECT 'b' || p_partkey AS xml_id, CASE WHEN p_size % 2 = 0 THEN 'edition' ELSE 'study' END AS bib_type, p_name AS title, p_brand || ', ' || p_type || '; Org' AS authors,
  CASE WHEN p_size % 3 = 0 THEN (1900 + p_size)::VARCHAR WHEN p_size % 3 = 1 THEN (1800 + p_size) || '–' || (1900 + p_size) ELSE '' END AS "date", p_size::VARCHAR AS volume, 'u' || p_partkey AS url, lower(p_brand) AS sort_key FROM part""")
def tei_bibliography(spark, d):
    p, size = table(spark, d, "part"), F.col("p_size")
    dates = F.when(size % 3 == 0, F.concat(F.lit('<date when="'), (1900 + size).cast("string"), F.lit('"/>'))).when(size % 3 == 1, F.concat(F.lit('<date notBefore="'), (1800 + size).cast("string"), F.lit('" notAfter="'), (1900 + size).cast("string"), F.lit('"/>'))).otherwise("<date>x</date>")
    docs = _made(
        p, "p_partkey", '<listBibl type="study"><listBibl', F.when(size % 2 == 0, ' type="edition"').otherwise(""), '><biblStruct xml:id="b', F.col("p_partkey"), '"><monogr><author><surname>', F.col("p_brand"), "</surname><forename>", F.col("p_type"),
        '</forename></author><author>Org</author><title level="m">', F.col("p_name"), "</title><imprint>", dates, '</imprint><biblScope unit="volume">', size, '</biblScope><ref target="u', F.col("p_partkey"), '"/></monogr></biblStruct><biblStruct><monogr/></biblStruct></listBibl></listBibl>',
    )
    return catalogue.bibliography(docs).select("xml_id", "bib_type", "title", "authors", "date", "volume", "url", "sort_key")


@query("""SELECT 'c' || c_custkey AS xml_id, 'persons' AS section, CASE WHEN c_custkey % 2 = 0 THEN 'ka-' || c_name ELSE c_name END AS name, c_name AS name_la, CASE c_custkey % 3 WHEN 0 THEN ['ab', 'b'] WHEN 1 THEN ['abc'] END AS variants, c_mktsegment AS "type" FROM customer
UNION ALL SELECT 'n' || n_nationkey, 'places', n_name, NULL, NULL, '' FROM nation UNION ALL SELECT 'r' || r_regionkey, 'animals', r_name, NULL, ['v'], '' FROM region""")
def tei_authority(spark, d):
    c, key = table(spark, d, "customer"), F.col("c_custkey")
    variant = lambda v: f'<persName type="variant">{v}</persName>'
    more = F.when(key % 3 == 0, variant("abc") + variant("ab") + variant("b") + variant("ba")).when(key % 3 == 1, variant("abc") + variant("abcd")).otherwise("")
    people = _made(
        c, "c_custkey", '<person xml:id="c', key, '" type="', F.col("c_mktsegment"), '"><persName xml:lang="la">', F.col("c_name"), "</persName>", F.when(key % 2 == 0, F.concat(F.lit('<persName type="main" xml:lang="ka">ka-'), "c_name", F.lit("</persName>"))).otherwise(""), more, "</person>",
    )
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    places = _made(n, "n_nationkey", '<place xml:id="n', F.col("n_nationkey"), '"><placeName>', F.col("n_name"), "</placeName></place>")
    animals = _made(r, "r_regionkey", '<list type="fauna"><item xml:id="r', F.col("r_regionkey"), '"><term type="variant">v</term><term>', F.col("r_name"), "</term></item></list>")
    out = catalogue.authority(people.unionByName(places.withColumn("doc", F.concat(F.lit("n"), "doc"))).unionByName(animals.withColumn("doc", F.concat(F.lit("r"), "doc"))))
    return out.select("xml_id", "section", "name", "name_la", F.when(F.size("variants") > 0, F.array_sort("variants")).alias("variants"), "type")


@query("""SELECT 't' || s_suppkey AS xml_id, s_name AS label_ka, coalesce(n_name, '?') AS author_ka, CASE WHEN s_suppkey % 3 = 0 THEN 'Feast' ELSE 'f' || s_suppkey END AS feast_ka, CASE WHEN s_suppkey % 2 = 0 THEN 'hom' ELSE 'other' END AS genre_class,
  CASE s_suppkey % 4 WHEN 0 THEN 'Done' ELSE 'Planned' END AS status_label FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND s_nationkey % 2 = 0""")
def tei_catalogue(spark, d):
    s, n = table(spark, d, "supplier"), table(spark, d, "nation").filter("n_nationkey % 2 = 0")
    key = F.col("s_suppkey")
    events = _made(
        s, "s_suppkey", '<listEvent><event xml:id="t', key, '" corresp="#', F.when(key % 3 == 0, "feast").otherwise(F.concat(F.lit("f"), key.cast("string"))), '" type="#', F.when(key % 2 == 0, "g1").otherwise("zz"), '"><label xml:lang="en">x</label><label xml:lang="ka">', F.col("s_name"),
        '</label><note type="author" corresp="#a', F.col("s_nationkey"), '"/>', F.when(key % 4 == 0, '<note type="status">done</note>').otherwise(""), "</event></listEvent>",
    )
    people = _made(n, "n_nationkey", '<listPerson type="authors"><person xml:id="a', F.col("n_nationkey"), '"><persName xml:lang="ka">', F.col("n_name"), "</persName></person></listPerson>")
    feast = spark.createDataFrame([("f", f'<TEI xmlns="{NS}"><taxonomy xml:id="feasts"><category xml:id="feast" n="--09-08"><catDesc xml:lang="ka">Feast</catDesc></category></taxonomy></TEI>')], "doc string, text string")
    out = catalogue.texts(events, catalogue.authors(people), catalogue.feasts(feast, {"09": "Sept"}, "moving"), {"g1": ("hom", "H")}, {"done": ("done", "Done")}, ("other", "O"), ("planned", "Planned"))
    return out.select("xml_id", "label_ka", "author_ka", "feast_ka", "genre_class", "status_label")


@query("""SELECT 'e' || item_id AS xml_id, trim(left(text, 20)) AS lemma, CASE WHEN item_id % 2 = 0 THEN 'n.' ELSE 'other' END AS pos_label, CASE WHEN item_id % 3 = 0 THEN 'D0' ELSE 'Other' END AS source_label, left(text, 40) || 'bold' AS def FROM benchmark""")
def tei_lexicon(spark, d):
    b, key = table(spark, d, "benchmark"), F.col("item_id")
    docs = _made(
        b, "item_id", '<entry xml:id="e', key, '" source="', F.when(key % 3 == 0, "d0").otherwise("d9"), '"><form type="lemma"><orth>', _escaped(F.trim(F.left("text", F.lit(20)))), "</orth></form><gramGrp><pos>", F.when(key % 2 == 0, "noun").otherwise("verb"),
        "</pos></gramGrp><sense><def>", _escaped(F.left("text", F.lit(40))), '<hi rend="bold">bold</hi></def></sense></entry><entry xml:id="none"/>',
    )
    e = catalogue.lexicon(docs, {"noun": "noun"}, {"noun": "n."}, {}, {"d0": ("g0", "D0")}, ("other", "Other"))
    return e.join(catalogue.popup(e, catalogue.senses(docs)).select("xml_id", "def"), "xml_id").select("xml_id", "lemma", "pos_label", "source_label", "def")
