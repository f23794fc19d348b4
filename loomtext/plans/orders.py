"""Queries on whole-table order, text lists, stored tokens, split sinks and the gate before publishing."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomtext.functions import georgian
from loomtext.operators import inject, match, oov, ordering, tokens
from loomtext.plans import base, corpus, tei
from loomtext.plans.base import MATCHED, query, table
from loomtext.plans.corpus import OOV
from loomtext.sources import scratch, tables

#: So many texts are named one by one when their stored rows are read.
MOST_TEXTS = 10_000


@query("SELECT doc_id, row_number() OVER (ORDER BY n_chars, lang NULLS FIRST, doc_id) AS place FROM documents")
def document_ranks(spark, d):
    return ordering.ranked(table(spark, d, "documents").select("doc_id", "n_chars", "lang"), ["n_chars", "lang", "doc_id"], "place").select("doc_id", "place")


@query("SELECT doc_id, lag(doc_id) OVER w AS prev_id, lead(doc_id) OVER w AS next_id FROM documents WINDOW w AS (ORDER BY left(coalesce(text, ''), 40), doc_id)")
def document_neighbours(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.left(F.coalesce("text", F.lit("")), F.lit(40)).alias("head"))
    return ordering.neighbours(docs, ["head", "doc_id"], "doc_id").select("doc_id", "prev_id", "next_id")


_COLLATE = "zyxwvutsrqponmlkjihgfedcba"


@query(f"""WITH w AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '\\p{{L}}+'))) AS word FROM documents),
k AS (SELECT word, list_transform(string_split(word, ''), lambda c: CASE WHEN strpos('{_COLLATE}', c) > 0 THEN strpos('{_COLLATE}', c) - 1 ELSE 999 END) AS key FROM w)
SELECT word, row_number() OVER (ORDER BY key, word) AS place FROM k""")
def collated_words(spark, d):
    words = table(spark, d, "documents").select(F.explode(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1)), F.lower))).alias("word")).distinct()
    return ordering.ranked(words, [georgian.collation_key(F.col("word"), _COLLATE), "word"], "place").select("word", "place")


# --- Texts of unmatched words ---------------------------------------------------------------------


@query(f"""WITH {MATCHED}, v AS (SELECT surface, w.doc_id, lower(surface) || '.' || lang AS norm FROM words w WHERE surface IN (SELECT surface FROM matched WHERE match_tier = 'none')),
last AS (SELECT surface, arg_max(norm, doc_id) AS last_norm, count(*) AS freq FROM v GROUP BY surface)
SELECT surface, last_norm, freq, doc_id // 64 AS bucket, string_agg(DISTINCT doc_id::VARCHAR, '|' ORDER BY doc_id::VARCHAR) AS texts FROM v JOIN last USING (surface) GROUP BY ALL""")
def oov_text_lists(spark, d):
    types = scratch.settled(base.matched_types(spark, d, base.types(spark, d)).select("surface", "freq", "match_tier"), "types")
    known, none = match.often(types) & (F.col("match_tier") != "none"), types.filter("match_tier = 'none'").select("surface", "freq")
    each = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(f"({base.LETTER})"), F.lit(1)))).alias("surface")
    pairs = table(spark, d, "documents").select("doc_id", "lang", each).join(F.broadcast(types.filter(known).select("surface")), "surface", "left_anti").join(none, "surface")
    # the norm follows the text's language here, so that the last one seen differs from others; what follows keeps the join's order by word
    last = F.max(F.when(F.col("lang").isNotNull(), F.struct("doc_id", "lang"))).alias("last")
    lists = oov.texts_of(oov.text_bitmaps(pairs, "doc_id", 64, F.max("freq").alias("freq"), last))
    norm = F.concat(F.lower("surface"), F.lit("."), F.max("last").over(Window.partitionBy("surface"))["lang"])
    listed = F.array_join(F.array_sort(F.transform("texts", lambda t: t.cast("string"))), "|")
    return lists.select("surface", norm.alias("last_norm"), "freq", "bucket", listed.alias("texts"))


# --- Sinks and stores -----------------------------------------------------------------------------


@query(f"""WITH {OOV}, s AS (SELECT 'all' AS folder, * FROM oov UNION ALL SELECT lower(category), * FROM oov WHERE category IN ('REVIEW', 'FUNCTION'))
SELECT f.folder, count(s.surface) AS observed, count(s.surface) AS written, coalesce(sum(freq), 0)::BIGINT AS tokens, coalesce(max(surface), '') AS last_word FROM (VALUES ('all'), ('review'), ('function'), ('none')) f(folder) LEFT JOIN s ON s.folder = f.folder GROUP BY f.folder""")
def split_sink(spark, d):
    path = scratch.new_path(spark, "split")
    found = corpus.unmatched(spark, d).select("surface", "norm", "freq", "text_count", "category")
    seen = tables.split_sink(found, path, "category", {"review": "REVIEW", "function": "FUNCTION", "none": "NOTHING"}, "gzip")
    back = tables.read_split(spark, path, "surface string, norm string, freq long, text_count long, category string")
    got = back.groupBy("folder").agg(F.count("*").alias("written"), F.sum("freq").alias("tokens"), F.max("surface").alias("last_word"))
    return seen.join(got, "folder", "left").select("folder", "observed", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("written", "tokens")], F.coalesce("last_word", F.lit("")).alias("last_word"))


@query("""WITH w AS (SELECT doc_id, lower(unnest(regexp_extract_all(text, '\\p{L}+'))) AS norm FROM documents)
SELECT w.doc_id, count(*) AS tokens, count(DISTINCT norm) AS types, any_value(d.source) AS source FROM w JOIN documents d ON d.doc_id = w.doc_id GROUP BY w.doc_id""")
def stored_tokens(spark, d):
    """Tokens and texts in tables bucketed by text: counting a text's tokens and meeting its row need no shuffle."""
    docs = table(spark, d, "documents")
    n = tables.buckets_for(docs)
    words = tables.bucketed(base.words(spark, d, ["doc_id"]).select("doc_id", "norm"), scratch.new_path(spark, "stored-tokens"), "doc_id", n)
    texts = tables.bucketed(docs.select("doc_id", "source"), scratch.new_path(spark, "stored-texts"), "doc_id", n)
    per_text = spark.table(words).groupBy("doc_id").agg(F.count("*").alias("tokens"), F.size(F.collect_set("norm")).cast("long").alias("types"))  # a text's own types
    return per_text.join(spark.table(texts).hint("merge"), "doc_id").select("doc_id", "tokens", "types", "source")


@query("""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\p{L}+')) AS surface FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))
SELECT doc_id, surface, count(*) AS n FROM w GROUP BY ALL""")
def store_of_texts(spark, d):
    """The stored words of the texts that a list names, read from their folders alone."""
    path = scratch.new_path(spark, "store")
    tables.write_store(base.words(spark, d, ["doc_id"]).select("doc_id", "surface"), path, "doc_id", buckets=32)
    wanted = [r.doc_id for r in table(spark, d, "labels").filter("toxic = 1").select("doc_id").distinct().limit(MOST_TEXTS + 1).collect()]
    if len(wanted) <= MOST_TEXTS:
        rows = tables.read_store(spark, path, "doc_id long, surface string", wanted, "doc_id", buckets=32)
    else:  # too many to name one by one: all folders are read
        rows = tables.read_store(spark, path, "doc_id long, surface string").join(table(spark, d, "labels").filter("toxic = 1").select("doc_id").distinct(), "doc_id", "left_semi")
    return rows.groupBy("doc_id", "surface").agg(F.count("*").alias("n"))


# --- The gate -------------------------------------------------------------------------------------

FIRST = r"""lines AS (SELECT 'd' || doc_id AS doc, i - 1 AS i, l[i] AS x, regexp_extract(l[i], '^\p{L}+') AS f FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents), unnest(generate_series(1, len(l))) AS g(i) WHERE l[i] <> ''),
t AS (SELECT *, f <> '' AS hit, f <> '' AND length(f) % 7 <> 0 AS tagged, i % 6 = 1 AS held FROM lines),
w AS (SELECT *, CASE WHEN held THEN '<app><rdg wit="#S">' ELSE '' END AS a, CASE WHEN held THEN '</rdg></app>' ELSE '' END AS b, replace(replace(replace(substr(x, length(f) + 1), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS rest FROM t),
d AS (SELECT doc, count(*) FILTER (hit AND tagged) AS tagged, count(*) FILTER (hit AND NOT tagged) AS skipped, count(*) FILTER (tagged AND held) AS worse,
  string_agg('<p xml:id="' || doc || '-' || i || '">' || a || CASE WHEN tagged THEN '<w lemmaRef="#x' || length(f) || '">' || f || '</w>' ELSE f END || b || rest || '</p>', '' ORDER BY i) AS new,
  string_agg('<p xml:id="' || doc || '-' || i || '">' || a || f || b || rest || '</p>', '' ORDER BY i) AS old FROM w GROUP BY doc)"""


def _held(x, i):
    first = F.regexp_extract(x, r"^\p{L}+", 0)
    rest = tei._escaped(F.substring(x, F.char_length(first) + 1, F.char_length(x)))
    return F.concat(F.when(i % 6 == 1, F.concat(F.lit('<app><rdg wit="#S">'), first, F.lit("</rdg></app>"))).otherwise(first), rest)


def _hits(docs):
    """The first word of each paragraph, also inside readings; some at a place that is a little off, some far off."""
    words = tokens.tokenise(tokens.text_nodes(docs, ["w", "lem", "head", "note", "label", "pb", "lb", "cb"]), r"\p{L}+", r"[^\p{L}]+", F.lower)
    first = words.filter(F.endswith("token_id", F.lit("_t0")) & (F.col("char_start") == 0))
    n = F.char_length("surface")
    off = F.when(n % 7 == 0, 1_000_000).when(n % 5 == 0, 3).otherwise(0)
    named = {"match_id": F.concat(F.lit("x"), n.cast("string")), "match_tier": F.lit("primary"), "match_source": F.lit("benchmark"), "confidence": F.lit("exact")}
    return inject.in_order(inject.taggable(first.withColumns(named | {"char_start": F.col("char_start") + off, "char_end": F.col("char_end") + off})))


@query(f"""WITH {FIRST} SELECT doc, worse > 0 AS refused, CASE WHEN worse > 0 THEN 'w in rdg' END AS rule, CASE WHEN worse > 0 THEN 0 END AS before, CASE WHEN worse > 0 THEN worse END AS after,
  md5('{tei.HEAD}' || substr(doc, 2) || '"><text><body><p>no id</p>' || CASE WHEN worse > 0 THEN old ELSE new END || '{tei.END}') AS digest FROM d
UNION ALL SELECT 'd' || doc_id, false, NULL, NULL, NULL, md5('{tei.HEAD}' || doc_id || '"><text><body><p>no id</p>{tei.END}') FROM documents WHERE 'd' || doc_id NOT IN (SELECT doc FROM d)""")
def tei_gate(spark, d):
    old = scratch.settled(tei._document(table(spark, d, "documents"), _held), "old-version")
    new = scratch.settled(inject.inject(old, _hits(old), every=True, gate=False).select("doc", "text"), "new-version")
    accepted, refused = inject.gated(old, new)
    path = scratch.new_path(spark, "versions")
    tables.publish(accepted, path, "2")
    published = tables.read_version(spark, path, "2").select("doc", F.md5("text").alias("digest"))
    return published.join(refused, "doc", "left").select("doc", F.col("rule").isNotNull().alias("refused"), "rule", "before", "after", "digest")


@query(f"""WITH {FIRST}, s AS (SELECT count(*) AS documents, sum(tagged)::BIGINT AS tagged, sum(skipped)::BIGINT AS skipped, count(*) FILTER (worse > 0) AS held_back FROM d)
SELECT (SELECT count(*) FROM documents) AS documents, tagged, skipped, held_back, (SELECT count(*) FROM documents) AS published FROM s""")
def injection_summary(spark, d):
    docs = scratch.settled(tei._document(table(spark, d, "documents"), _held), "old-version")
    path = scratch.new_path(spark, "versions")
    seen = inject.observed_summary(inject.inject(docs, _hits(docs), every=True), path, "2")
    return seen.crossJoin(F.broadcast(tables.read_version(spark, path, "2").agg(F.count("*").alias("published"))))
