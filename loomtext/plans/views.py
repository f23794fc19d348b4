"""Queries on catalogue-like tables: orders, groups, defaults, figures, filters, references, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.functions import georgian, strings
from loomtext.operators import catalogue, growth, ordering, validate
from loomtext.plans.base import query, table
from loomtext.sources import markup, tables


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def dangling_refs(spark, d):
    return validate.dangling(table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders"), "c_custkey", "o_custkey")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def dangling_ids(spark, d):
    return validate.dangling(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id", "doc_id")


@query("""SELECT n_nationkey, n_regionkey, lag(n_nationkey) OVER w AS prev_id, lead(n_nationkey) OVER w AS next_id FROM nation WINDOW w AS (PARTITION BY n_regionkey ORDER BY n_name)""")
def prev_next(spark, d):
    return catalogue.neighbours(table(spark, d, "nation"), "n_name", "n_nationkey", "n_regionkey").select("n_nationkey", "n_regionkey", "prev_id", "next_id")


@query("""SELECT d.doc_id, coalesce(CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END, '?') AS quality FROM documents d LEFT JOIN labels l USING (doc_id)""")
def dim_defaults(spark, d):
    dim = table(spark, d, "labels").select(F.col("doc_id").alias("id"), strings.labelled(F.col("quality").cast("string"), {"1": "good", "0": "poor"}).alias("quality"))
    return catalogue.with_default(table(spark, d, "documents").select("doc_id"), dim, "doc_id", "id", {"quality": "?"})


MONTHS = {f"{k + 1:02d}": n for k, n in enumerate("January February March April May June July August September October November December".split())}
_MONTH = "[" + ", ".join(f"'{m}'" for m in MONTHS.values()) + "]"


@query(f"""WITH days AS (SELECT DISTINCT strftime(o_orderdate, '--%m-%d') AS day FROM orders UNION SELECT 'moveable' UNION SELECT 'none')
SELECT day, CASE WHEN day LIKE '--%' THEN CAST(substr(day, 6, 2) AS INT) || ' ' || {_MONTH}[CAST(substr(day, 3, 2) AS INT)] WHEN day = 'moveable' THEN 'moveable feast' ELSE '' END AS shown,
  CASE WHEN day LIKE '--%' THEN 0 WHEN day = 'moveable' THEN 1 ELSE 2 END AS kind, CASE WHEN day LIKE '--%' THEN (CAST(substr(day, 3, 2) AS INT) + 3) % 12 ELSE 0 END AS "at" FROM days""")
def seasonal_order(spark, d):
    days = table(spark, d, "orders").select(F.concat(F.lit("--"), F.date_format("o_orderdate", "MM-dd")).alias("day")).union(spark.createDataFrame([("moveable",), ("none",)], "day string")).distinct()
    rank = strings.season_rank(strings.recurring_month(F.col("day")), F.col("day") == "moveable")
    return days.withColumn("r", rank).select("day", strings.recurring_day(F.col("day"), MONTHS, "moveable feast").alias("shown"), "r.kind", "r.at")


ABC = "abcdefghijklmnopqrstuvwxyz"


@query(f"""WITH w AS (SELECT DISTINCT lower(w) AS w FROM (SELECT unnest(regexp_extract_all(text, '\\p{{L}}+')) AS w FROM benchmark)), c AS (SELECT w[1] AS letter, count(*) AS n FROM w GROUP BY 1),
a AS (SELECT unnest(string_split('{ABC}', '')) AS letter, unnest(range(26)) AS "at") SELECT letter, "at"::INT AS "at", coalesce(n, 0) AS n FROM a LEFT JOIN c USING (letter)""")
def alphabet_tiles(spark, d):
    words = table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))).alias("lemma")).distinct()
    return catalogue.letter_tiles(words, "lemma", ABC).drop("slug")


_COLLATE = "ZYXWVUTSRQPONMLKJIHGFEDCBA"


@query(f"""WITH k AS (SELECT n_name, list_transform(string_split(n_name, ''), lambda c: CASE WHEN strpos('{_COLLATE}', c) > 0 THEN strpos('{_COLLATE}', c) - 1 ELSE 999 END) AS key FROM nation)
SELECT n_name, row_number() OVER (ORDER BY key, n_name) AS place FROM k""")
def custom_collation_rank(spark, d):
    return ordering.ranked(table(spark, d, "nation").select("n_name"), [georgian.collation_key(F.col("n_name"), _COLLATE), "n_name"], "place").select("n_name", "place")


@query("""WITH g AS (SELECT event_type, count(*) AS n, min(event_id) AS first, list_position(['purchase', 'view', 'absent'], event_type) AS p FROM events GROUP BY event_type)
SELECT event_type, n, CASE WHEN p > 0 THEN 0 ELSE 1 END AS late, CASE WHEN p > 0 THEN p ELSE first END AS "at" FROM g""")
def group_order_unknown_last(spark, d):
    out = catalogue.grouped_in_order(table(spark, d, "events"), "event_type", ["purchase", "view", "absent"], "event_id")
    return out.select("event_type", "n", "rank.late", "rank.at")


@query("""WITH t AS (SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'done' WHEN l.quality = 0 THEN 'progress' ELSE 'planned' END AS s FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT count(*) AS texts, round(count(*) FILTER (s = 'done') * 100.0 / count(*), 1) AS done, min(doc_id) FILTER (s <> 'planned') AS featured, (SELECT count(DISTINCT source) FROM documents) AS authors, (SELECT count(DISTINCT lang) FROM documents) AS feasts FROM t""")
def site_kpis(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels").select("doc_id", "quality")
    state = F.when(F.col("quality") == 1, "done").when(F.col("quality") == 0, "progress").otherwise("planned")
    texts = docs.join(labels, "doc_id", "left").select(F.col("doc_id").alias("xml_id"), F.col("doc_id").alias("ord"), state.alias("status_class"))
    return catalogue.key_figures(texts, docs.select("source").distinct().na.drop(), docs.select("lang").distinct().na.drop())


@query("SELECT doc_id FROM documents WHERE lang IN ('en', 'fr') AND source = 'src3' AND (contains(lower(text), 'tion') OR contains(lower(lang), 'tion'))")
def facet_filter(spark, d):
    return catalogue.facets(table(spark, d, "documents"), ["en", "fr"], "src3", "TION", "lang", "source", ["text", "lang"]).select("doc_id")


@query("SELECT DISTINCT source FROM documents WHERE contains(lower(text), 'ción') AND lang IN ('es')")
def genre_search(spark, d):
    return catalogue.searched(table(spark, d, "documents"), ["es"], "ción", "source", "lang", "text")[1]


@query(r"""WITH w AS (SELECT DISTINCT item_id, v FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS v FROM benchmark))
SELECT item_id, v AS root FROM w WHERE NOT EXISTS (SELECT 1 FROM w u WHERE u.item_id = w.item_id AND length(u.v) < length(w.v) AND starts_with(w.v, u.v))""")
def prefix_root_variants(spark, d):
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))
    return table(spark, d, "benchmark").select("item_id", F.explode(catalogue.prefix_roots(words)).alias("root"))


@query("""SELECT (k // 2 + 1) || CASE WHEN k % 2 = 0 THEN 'r' ELSE 'v' END AS folio, (k + 3)::INT AS sp, 'https://images.example:' || lpad((k + 3)::VARCHAR, 4, '0') || '/full/pct:12.5/0/default.jpg' AS thumb_url, 'https://viewer.example/?sp=' || (k + 3) AS viewer_url FROM range(280) t(k)""")
def folio_sequence(spark, d):
    return tables.folio_map(spark, 2, 282, "https://images.example", "https://viewer.example/").select("folio", "sp", "thumb_url", "viewer_url")


@query("""SELECT o_orderkey, ltrim(lpad(o_custkey::VARCHAR, 6, '0'), '0') || '–' || ltrim(lpad(o_orderkey::VARCHAR, 8, '0'), '0') AS life, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%Y') || '–' || o_custkey END AS witness,
  CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y') ELSE o_custkey::VARCHAR END AS imprint, 'ff. ' || o_custkey || '-' || o_orderkey AS leaves FROM orders""")
def date_displays(spark, d):
    year, cust, key = F.date_format("o_orderdate", "yyyy"), F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")
    done = F.col("o_orderstatus") == "F"
    return table(spark, d, "orders").select(
        "o_orderkey", strings.life_dates(F.lpad(cust, 6, "0"), F.lpad(key, 8, "0"), F.lit(True), F.lit(""), F.lit("")).alias("life"), strings.witness_date(F.when(done, year), year, cust).alias("witness"),
        strings.imprint_date(F.when(done, year), cust, F.lit(None).cast("string")).alias("imprint"), strings.leaf_span(cust, key, F.lit("")).alias("leaves"),
    )


@query("""SELECT page_id, md5(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS escaped FROM pages""")
def html_escaped(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(strings.html_escaped(F.col("html"))).alias("escaped"))


@query("""SELECT page_id, CASE WHEN url IS NULL THEN '' ELSE '<a href="' || replace(url, '&', '&amp;') || '" class="ext-link" target="_blank" rel="noopener noreferrer">p' || page_id || '</a>' END AS link FROM pages""")
def reference_anchors(spark, d):
    return table(spark, d, "pages").select("page_id", F.when(F.col("url").isNull(), "").otherwise(strings.anchor(F.col("url"), F.concat(F.lit("p"), F.col("page_id").cast("string")))).alias("link"))


@query("""WITH p AS (SELECT file, root_id, lang || '-' || doc_id AS para_id FROM (SELECT source AS file, lang AS root_id, lang, doc_id FROM documents)), c AS (SELECT 'src' || n_nationkey AS file, n_name AS xml_id FROM nation)
SELECT file, coalesce(xml_id, root_id) AS root_id, CASE WHEN xml_id IS NOT NULL AND xml_id <> root_id THEN xml_id || substr(para_id, length(root_id) + 1) ELSE para_id END AS para_id, coalesce(xml_id <> root_id, false) AS changed FROM p LEFT JOIN c USING (file)""")
def rename_prefix_ids(spark, d):
    p = table(spark, d, "documents").select(F.col("source").alias("file"), F.col("lang").alias("root_id"), F.concat("lang", F.lit("-"), F.col("doc_id").cast("string")).alias("para_id"))
    c = table(spark, d, "nation").select(F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("file"), F.col("n_name").alias("xml_id"))
    return growth.renamed_ids(p, c)


@query("""WITH b AS (SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1), a AS (SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1)
SELECT l_returnflag, coalesce(b.n, 0) AS "before", coalesce(a.n, 0) AS "after", coalesce(a.n, 0) - coalesce(b.n, 0) AS added FROM b FULL JOIN a USING (l_returnflag) WHERE coalesce(a.n, 0) > coalesce(b.n, 0)""")
def violation_delta(spark, d):
    counts = lambda s: table(spark, d, "lineitem").filter(F.col("l_linestatus") == s).groupBy("l_returnflag").agg(F.count("*").alias("n"))
    return validate.introduced(counts("F"), counts("O"), ["l_returnflag"], "n")


@query("""SELECT c_mktsegment AS section, count(*) AS n FROM customer GROUP BY ROLLUP (c_mktsegment)""")
def section_counts(spark, d):
    return catalogue.section_counts(table(spark, d, "customer").withColumnRenamed("c_mktsegment", "section"), "section")


@query("""SELECT CASE p_brand WHEN 'Brand#11' THEN 'Brand-eleven' ELSE p_brand END AS xml_id, CASE WHEN contains(p_type, 'PROMO') THEN NULL ELSE p_type END AS pos, p_brand AS source, [p_name, 'a; b'] AS labels FROM part""")
def lexicon_cleanup(spark, d):
    p = table(spark, d, "part").select(F.col("p_brand").alias("xml_id"), F.col("p_type").alias("pos"), F.concat("p_brand", F.lit("|"), "p_brand").alias("source"), F.array(F.col("p_name"), F.lit("a; b; a")).alias("labels"))
    return growth.cleaned(p, "PROMO", {"Brand#11": "Brand-eleven"})


@query("""WITH own AS (SELECT 's' || s_suppkey AS xml_id FROM supplier WHERE s_acctbal > 0)
SELECT 's' || s_suppkey AS xml_id, s_name AS lemma, CASE WHEN s_acctbal > 0 THEN 'corpus' ELSE '' END AS noted FROM supplier UNION ALL SELECT 'n' || n_nationkey, n_name, '' FROM nation""")
def append_entries(spark, d):
    s, n = table(spark, d, "supplier"), table(spark, d, "nation")
    ident = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    entries = s.select(ident.alias("xml_id"), F.lit("corpus").alias("source"), F.col("s_name").alias("lemma"), F.lit("").alias("def_ka"), F.array().cast("array<string>").alias("sources"))
    new = n.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("xml_id"), F.lit("x").alias("source"), F.col("n_name").alias("lemma"), F.lit("").alias("def_ka"))
    out = growth.appended(entries, new, s.filter("s_acctbal > 0").select(ident.alias("xml_id")), "corpus")
    return out.select("xml_id", "lemma", F.array_join("sources", "").alias("noted"))


# --- Markup: one Arrow pass over pages, rows only ---------------------------------------------------


def _pages(spark, d):
    return table(spark, d, "pages").select(F.col("page_id").cast("string").alias("doc"), F.col("html").alias("text"))


@query()
def html_nodes(spark, d):
    return markup.node_table(_pages(spark, d), html_pages=True).drop("attrs", "path")


@query(r"""WITH t AS (SELECT page_id, regexp_replace(html, '<!--.*?-->', '', 'gs') AS h FROM pages), s AS (SELECT page_id, unnest(regexp_extract_all(h, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM t)
SELECT page_id::VARCHAR AS doc, tag, count(*) AS n FROM s GROUP BY ALL UNION ALL SELECT page_id::VARCHAR, '#document', 1 FROM pages""")
def html_tags(spark, d):
    return markup.node_table(_pages(spark, d), html_pages=True).groupBy("doc", "tag").agg(F.count("*").alias("n"))


#: The entities that the pages use, the ampersand last.
UNESCAPED = "replace(replace(replace(replace(replace(replace({0}, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"


@query(f"""WITH t AS (SELECT page_id, replace(regexp_replace(regexp_replace(replace(html, '"</p>"', '"' || chr(1) || '"'), '<!--.*?-->', '', 'gs'), '<[^>]*>', '', 'g'), chr(1), '</p>') AS t FROM pages)
SELECT page_id::VARCHAR AS doc, {UNESCAPED.format("t")} AS plain FROM t""")
def html_plaintext(spark, d):
    nodes = markup.node_table(_pages(spark, d), html_pages=True)
    return markup.subtree_text(nodes, ["#document"]).select("doc", F.col("full").alias("plain"))


@query(f"""WITH p AS (SELECT page_id, string_split(html, '<a ') AS l FROM pages), k AS (SELECT page_id, l, unnest(generate_series(1, len(l) - 1)) AS k FROM p)
SELECT page_id::VARCHAR AS doc, (len(regexp_extract_all(array_to_string(l[:k], '<a '), '<[a-zA-Z]')) + 1)::INT AS node, {UNESCAPED.format("regexp_extract(l[k + 1], '^href=\"([^\"]*)\"', 1)")} AS href, {UNESCAPED.format("regexp_extract(l[k + 1], '^[^>]*>([^<]*)', 1)")} AS "text" FROM k""")
def html_link_refs(spark, d):
    nodes = markup.node_table(_pages(spark, d), html_pages=True)
    return nodes.filter("tag = 'a'").select("doc", "node", F.element_at("attrs", "href").alias("href"), "text")


@query("""SELECT page_id::VARCHAR AS doc, 0::BIGINT AS a_in_p, (len(string_split(html, '<a ')) - 1)::BIGINT AS a_in_li, (len(string_split(html, '<a ')) - 1)::BIGINT AS a_in_nav, 0::BIGINT AS a_in_b, 0::BIGINT AS a_in_footer FROM pages""")
def constraint_violations(spark, d):
    return validate.nested(markup.node_table(_pages(spark, d), html_pages=True), "a", ["p", "li", "nav", "b", "footer"])


@query("SELECT page_id::VARCHAR AS doc, false AS ok FROM pages")  # every page leaves elements open
def wellformed_flag(spark, d):
    return markup.well_formed(_pages(spark, d))
