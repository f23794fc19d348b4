"""Queries on column functions: spelling, identifiers and stems of words, references, names and numbers of table rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomtext.functions import georgian, strings
from loomtext.plans.base import query, table

#: The words of ``documents`` in the later script, letter for letter, with the archaic letters among them.
LATIN, SPELT = "abcdefghijklmnopqrstuvwxyz", "აბგდევზჱთიკლმნჲოპჟრსტჳუფქჴ"


def _pick(table: dict[str, str], letter: str) -> str:
    """SQL: the entry of a letter, null if there is none."""
    return f"['{"', '".join(table.values())}'][nullif(list_position(['{"', '".join(table)}'], {letter}), 0)]"


@query(rf"""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents), g AS (SELECT word, translate(word, '{LATIN}', '{SPELT}') AS g FROM w),
c AS (SELECT *, CASE WHEN ends_with(g, 'ი') OR ends_with(g, 'ე') THEN left(g, length(g) - 1) ELSE g END AS stem, list_reduce(list_transform(string_split(g, ''), lambda c: coalesce({_pick(georgian.ROMAN, 'c')}, '')), lambda a, b: a || b) AS r FROM g)
SELECT word, translate(g, 'ჳჲჱჴ', 'ვიეხ') AS normal, translate(g, 'ჱჲჳ', 'ეივ') AS scoped, g AS cleaned, CASE WHEN length(stem) >= 3 THEN stem END AS stem,
  CASE WHEN length(stem) < 3 THEN NULL WHEN ends_with(g, 'ი') THEN 'consonant' WHEN ends_with(g, 'ა') THEN 'vowel_a' WHEN ends_with(g, 'ე') THEN 'vowel_e' WHEN ends_with(g, 'ო') THEN 'vowel_o' WHEN ends_with(g, 'უ') THEN 'vowel_u' ELSE 'consonant' END AS class,
  'lex-' || lower(r) AS ident, {_pick(georgian.SLUGS, 'g[1]')} AS slug, g AS later FROM c""")
def georgian_words(spark, d):
    words = table(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1))).alias("word")).distinct()
    g = words.withColumn("g", F.translate("word", LATIN, SPELT))
    marked = F.concat(F.left("g", F.lit(1)), F.lit("҃ -"), F.substring("g", 2, 1000))  # titlo, blank and hyphen, which cleaning takes out
    capital = F.translate("g", georgian.LETTERS, georgian.CAPITALS)
    s = georgian.stem_class(F.col("g"))
    return g.select(
        "word", georgian.normalise(F.col("g")).alias("normal"), georgian.scoped_norm(marked).alias("scoped"), georgian.cleaned(marked).alias("cleaned"), s["stem"].alias("stem"), s["class"].alias("class"),
        georgian.roman_id(F.col("g")).alias("ident"), georgian.letter_slug(F.col("g")).alias("slug"), georgian.later_script(capital).alias("later"),
    )


@query("""SELECT p_partkey, p_brand AS source, replace('lex-' || p_brand || '-a-b', '.', '-') AS dashed, trim(split_part(p_name || '-x', '-', 1)) AS uninflected, 'p_' || p_partkey AS bare, CASE WHEN p_size % 2 = 0 THEN p_brand END AS local, [p_size, p_partkey::INT] AS pages,
  CASE WHEN p_size % 2 = 0 THEN p_size::VARCHAR ELSE p_partkey::VARCHAR END AS number, CASE WHEN p_size % 3 = 0 THEN p_type ELSE p_brand END AS first,
  CASE WHEN p_size % 3 = 0 THEN p_name WHEN p_size % 3 = 1 THEN p_brand ELSE p_brand || ', ' || p_type END AS author,
  CASE WHEN p_size % 2 = 0 THEN p_size || ', ' || p_partkey || '; 9' ELSE 'p, q' END AS places,
  'a <i href="' || CASE WHEN p_size % 2 = 0 THEN 'p' || p_size || '.html#lex-' || p_size ELSE '#lex-' || p_size END || '"> and href="#x"' AS links, (p_size * 100.0 / 50)::DECIMAL(9, 1)::VARCHAR AS share FROM part""")
def reference_rules(spark, d):
    size, key = F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    even, third = F.col("p_size") % 2 == 0, F.col("p_size") % 3
    unit = lambda u, v: F.struct(F.lit(u).alias("unit"), v.alias("value"))
    ranges = F.when(even, F.array(unit("page", size), unit("line", key), unit("page", F.lit("9")))).otherwise(F.array(unit("line", F.lit("p")), unit("line", F.lit("q"))))
    known = F.map_from_arrays(F.array(F.concat(F.lit("lex-"), F.when(even, size).otherwise("none"))), F.array(F.concat(F.lit("p"), size)))
    return table(spark, d, "part").select(
        "p_partkey",
        strings.primary_source(F.concat(F.lit(" "), "p_brand", F.lit(" +"), "p_type", F.lit("|x"))).alias("source"),
        georgian.dashed_id(F.concat(F.lit(" lex."), "p_brand", F.lit(".a_b "))).alias("dashed"),
        georgian.cut_inflection(F.concat("p_name", F.lit("-x"))).alias("uninflected"),
        strings.without_hashes(F.concat(F.lit("##p_"), key)).alias("bare"),
        strings.local_target(F.concat(F.when(even, "#").otherwise("x#"), "p_brand")).alias("local"),
        strings.leading_numbers(F.concat(F.lit("p. "), size, F.lit(", 7; x; f"), key, F.lit("v; "))).alias("pages"),
        strings.shown_number(F.when(even, size), F.concat(F.lit("pp"), key)).alias("number"),
        strings.first_given(F.when(third == 0, "").otherwise(F.lit(None)), F.when(third != 0, F.col("p_brand")), F.col("p_type")).alias("first"),
        strings.author_shown(F.col("p_brand"), F.when(third == 1, "").otherwise(F.col("p_type")), F.when(third == 0, F.col("p_name"))).alias("author"),
        strings.page_line_refs(ranges).alias("places"),
        strings.qualified_hrefs(F.concat(F.lit('a <i href="#lex-'), size, F.lit('"> and href="#x"')), known).alias("links"),
        strings.percent(F.col("p_size"), F.lit(50)).alias("share"),
    )
