"""Catalogue, lexicon, authority index, bibliography and articles: typed rows of their documents, joins with
defaults, orders, groups and key figures. Dimension tables (labels of genres, states, types) are parameters."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.functions import georgian, strings
from loomtext.operators import ordering
from loomtext.operators.render import entry_html
from loomtext.sources.markup import rows_of

# --- Joins with defaults, orders, groups ---------------------------------------------------------


def with_default(rows: DataFrame, dim: DataFrame, key: str, dim_key: str, defaults: dict[str, Column | str]) -> DataFrame:
    """``rows`` with the columns ``defaults`` of ``dim`` (one row per ``dim_key``); where there is no counterpart, the defaults."""
    d = dim.select(F.col(dim_key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in defaults], F.lit(True).alias("__hit"))
    df = rows.join(d, F.col(key) == F.col("__key"), "left")
    for c, default in defaults.items():
        df = df.withColumn(c, F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.lit(default) if isinstance(default, str) else default))
    return df.drop("__key", "__hit", *[f"__{c}" for c in defaults])


def neighbours(rows: DataFrame, order: str, ident: str, within: str | None = None) -> DataFrame:
    """prev_id and next_id in ``order``, inside each group of ``within`` or over all rows (see ``ordering.neighbours``)."""
    if within is None:
        return ordering.neighbours(rows, [order, ident], ident)
    w = Window.partitionBy(within).orderBy(order)
    return rows.withColumn("prev_id", F.lag(ident).over(w)).withColumn("next_id", F.lead(ident).over(w))


def grouped_in_order(rows: DataFrame, kind: str, order: list[str], order_column: str) -> DataFrame:
    """(kind, n, rank): counts by kind in the given order; kinds it doesn't name follow by first appearance, empty ones drop out."""
    at = F.array_position(F.array(*map(F.lit, order)), F.col(kind)) if order else F.lit(0).cast("long")
    one = rows.groupBy(kind).agg(F.count("*").alias("n"), F.min(order_column).alias("first"))
    rank = F.when(at > 0, F.struct(F.lit(0).alias("late"), at.alias("at"))).otherwise(F.struct(F.lit(1).alias("late"), F.col("first").cast("long").alias("at")))
    return one.select(kind, "n", rank.alias("rank"))


def letter_tiles(lemmas: DataFrame, column: str = "lemma", alphabet: str = georgian.ALPHABET) -> DataFrame:
    """(letter, at, slug, n) for the whole alphabet, letters without entries too."""
    letters = lemmas.sparkSession.createDataFrame([(c, i) for i, c in enumerate(alphabet)], "letter string, at int")
    counts = lemmas.groupBy(F.left(column, F.lit(1)).alias("letter")).agg(F.count("*").alias("n"))
    return F.broadcast(letters).join(counts, "letter", "left").select("letter", "at", georgian.letter_slug(F.col("letter")).alias("slug"), F.coalesce("n", F.lit(0)).alias("n"))


def sections(groups: DataFrame, members: DataFrame, key: str, item: Column, order: str) -> DataFrame:
    """Groups with their members in order, empty groups dropped."""
    lists = members.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), item.alias("item")))).alias("x"))
    return groups.join(lists, key).withColumn("items", F.col("x.item")).drop("x")


def section_counts(rows: DataFrame, section: str) -> DataFrame:
    """(section, n) and the grand total in the row without a section."""
    return rows.rollup(section).agg(F.count("*").alias("n"))


def key_figures(texts: DataFrame, authors: DataFrame, feasts: DataFrame) -> DataFrame:
    """One row: texts, authors, feasts, per cent done (one decimal), and the first text that isn't only planned."""
    one = texts.agg(
        F.count("*").alias("texts"), F.round(F.try_divide(F.count_if(F.col("status_class") == "done") * 100.0, F.count("*")), 1).alias("done"),
        F.min_by("xml_id", F.when(F.col("status_class") != "planned", F.col("ord"))).alias("featured"),
    )
    return one.crossJoin(authors.agg(F.count("*").alias("authors"))).crossJoin(feasts.agg(F.count("*").alias("feasts")))


def prefix_roots(variants: Column) -> Column:
    """The variants of which no shorter one is a prefix, shortest first; equal lengths in order of appearance."""
    clean = F.array_distinct(F.filter(F.transform(variants, lambda x: F.trim(x)), lambda v: v != ""))
    keyed = F.array_sort(F.transform(clean, lambda v, i: F.struct(F.char_length(v).alias("n"), i.alias("i"), v.alias("v"))))
    return F.aggregate(keyed, F.array().cast("array<string>"), lambda kept, x: F.when(F.exists(kept, lambda k: F.startswith(x["v"], k)), kept).otherwise(F.array_append(kept, x["v"])))


def page_breaks(docs: DataFrame, folios: DataFrame) -> DataFrame:
    """(doc, ord, folio, witness, facs, sp) of each page break; its own image comes before the folio map's."""
    d = rows_of(docs, ".//pb", {"folio": ".@n", "witness": ".@wit | .@ed", "own": ".@facs"})
    f = folios.select("folio", F.col("facs").alias("mapped"), "sp").dropDuplicates(["folio"])
    return d.join(f, "folio", "left").select("doc", "ord", "folio", strings.without_hashes(F.col("witness")).alias("witness"), F.coalesce("own", "mapped").alias("facs"), F.coalesce("sp", F.lit(0)).alias("sp"))


def with_popups(words: DataFrame, popups: DataFrame, target: str = "target_id") -> DataFrame:
    """Tagged words with what their entry shows; words whose entry doesn't exist keep nulls."""
    return words.join(popups.withColumnRenamed("xml_id", target), target, "left")


def authority_pages(entries: DataFrame, lexicon_: DataFrame) -> DataFrame:
    """Authority entries with the page (letter slug, default ``a``) of the lexicon entry they link to."""
    return with_default(entries, lexicon_.select(F.col("xml_id").alias("linked"), "slug"), "lex_id", "linked", {"slug": "a"})


# --- Views ----------------------------------------------------------------------------------------


def facets(rows: DataFrame, kinds: list[str], source: str, query: str, kind_column: str = "pos", source_column: str = "source_group", fields: list[str] = ("lemma", "body")) -> DataFrame:
    """Rows of the chosen kinds (none chosen: all) and source (``all``: any) in which any of ``fields`` contains the query, without case."""
    keep = F.lit(True)
    if kinds:
        keep = keep & F.col(kind_column).isin(list(kinds))
    if source != "all":
        keep = keep & (F.col(source_column) == source)
    if query:
        hits = [F.contains(F.lower(f), F.lit(query.lower())) for f in fields]
        hit = hits[0]
        for h in hits[1:]:
            hit = hit | h
        keep = keep & F.coalesce(hit, F.lit(False))
    return rows.filter(keep)


def searched(rows: DataFrame, genres: list[str], query: str, section: str, genre: str = "genre", text: str = "label", thematic: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows shown, sections that still show any); the thematic panel leaves the genre choice out."""
    keep = F.contains(F.lower(text), F.lit(query.lower())) if query else F.lit(True)
    if genres and not thematic:
        keep = keep & F.col(genre).isin(list(genres))
    shown = rows.filter(keep)
    return shown, shown.select(section).distinct()


# --- Typed rows of documents ----------------------------------------------------------------------


def witnesses(docs: DataFrame) -> DataFrame:
    d = rows_of(docs, ".//listWit/witness", {
        "xml_id": ".@xml:id", "siglum": "abbr", "idno": "msDesc//idno", "when": "msDesc//origDate@when", "nb": "msDesc//origDate@notBefore", "na": "msDesc//origDate@notAfter",
        "leaves": "msDesc//measure", "script": "msDesc//handNote@script", "note": "msDesc//note",
    })
    return d.select("ord", "xml_id", "siglum", "idno", strings.witness_date(F.col("when"), F.col("nb"), F.col("na")).alias("date"), "leaves", "script", "note")


def authors(docs: DataFrame) -> DataFrame:
    d = rows_of(docs, ".//listPerson[@type='authors']/person", {
        "xml_id": ".@xml:id", "name_ka": "persName[@xml_lang='ka']", "name_la": "persName[@xml_lang='la']", "birth": "birth@when", "death": "death@when", "has_birth": "birth#", "has_death": "death#",
        "nb": "floruit@notBefore", "na": "floruit@notAfter", "viaf": "idno[@type='VIAF']", "cpg": "idno[@type='CPG']", "tm": "idno[@type='TM']",
    })
    links = rows_of(docs, ".//listPerson[@type='authors']/person/idno[@type='URI']", {"author": "^person@xml:id", "url": ".", "label": ".@subtype"})
    links = links.filter("url is not null and trim(label) <> ''").groupBy("doc", F.col("author").alias("xml_id")).agg(F.array_sort(F.collect_list(F.struct("ord", F.trim("label").alias("label"), "url"))).alias("l"))
    links = links.select("doc", "xml_id", F.transform("l", lambda x: F.struct(x["label"].alias("label"), x["url"].alias("url"))).alias("uri_links"))
    both = F.col("has_birth").isNotNull() & F.col("has_death").isNotNull()
    return d.join(links, ["doc", "xml_id"], "left").select(
        "ord", "xml_id", "name_ka", "name_la", strings.first_words(F.col("name_ka"), 2).alias("short_ka"), strings.life_dates(F.col("birth"), F.col("death"), both, F.col("nb"), F.col("na")).alias("dates"),
        "viaf", "cpg", "tm", "uri_links",
    )


def feasts(docs: DataFrame, months: dict[str, str], moveable: str) -> DataFrame:
    d = rows_of(docs, ".//taxonomy[@xml_id='feasts']/category", {"xml_id": ".@xml:id", "n": ".@n", "label_ka": "catDesc[@xml_lang='ka']", "label_la": "catDesc[@xml_lang='la']"})
    month = strings.recurring_month(F.col("n"))
    d = d.withColumn("n", F.coalesce("n", F.lit(""))).withColumn("month", month).withColumn("is_moveable", F.col("n") == "moveable")
    return d.select("ord", "xml_id", "label_ka", "label_la", strings.recurring_day(F.col("n"), months, moveable).alias("date"), "month", "is_moveable", F.struct(strings.season_rank(F.col("month"), F.col("is_moveable")).alias("season"), "ord").alias("rank"))


def texts(docs: DataFrame, authors_: DataFrame, feasts_: DataFrame, genres: dict[str, tuple[str, str]], states: dict[str, tuple[str, str]], other: tuple[str, str], planned: tuple[str, str]) -> DataFrame:
    """Catalogue texts with author and feast (defaults ``?`` and the id itself), genre and state labels, loci by witness."""
    d = rows_of(docs, ".//listEvent/event", {
        "xml_id": ".@xml:id", "feast": ".@corresp", "genre": ".@type", "label_ka": "label[@xml_lang='ka'] | label", "ms_heading": "desc[@xml_lang='ka'] | desc", "author": "note[@type='author']@corresp", "has_author": "note[@type='author']#",
        "cpg": "note[@type='CPG']", "file_path": "note[@type='file']", "status": "note[@type='status']", "from": "bibl[@type='edition']/citedRange@from", "to": "bibl[@type='edition']/citedRange@to",
    })
    bare = lambda c: strings.without_hashes(F.coalesce(F.col(c), F.lit("")))
    d = d.withColumn("feast_id", bare("feast")).withColumn("genre", bare("genre")).withColumn("author_id", F.when(F.col("has_author").isNotNull(), bare("author")).otherwise("aut-anon"))
    d = d.withColumn("status", F.coalesce("status", F.lit("planned")))
    table = lambda t, k: {a: b[k] for a, b in t.items()}
    for name, t, default in (("genre", genres, other), ("status", states, planned)):
        d = d.withColumn(f"{name}_class", strings.labelled(F.col(name), table(t, 0), default[0])).withColumn(f"{name}_label", strings.labelled(F.col(name), table(t, 1), default[1]))
    d = with_default(d, authors_.select(F.col("xml_id").alias("aid"), F.col("name_ka").alias("author_ka"), F.col("name_la").alias("author_la"), F.col("short_ka").alias("author_short")), "author_id", "aid", {"author_ka": "?", "author_la": "?", "author_short": "?"})
    d = with_default(d, feasts_.select(F.col("xml_id").alias("fid"), F.col("label_ka").alias("feast_ka"), F.col("label_la").alias("feast_la")), "feast_id", "fid", {"feast_ka": F.col("feast_id"), "feast_la": ""})
    loci = rows_of(docs, ".//listEvent/event/msDesc", {"event": "^event@xml:id", "witness": "msIdentifier/idno", "a": "locus@from", "b": "locus@to", "t": "locus"})
    loci = loci.select(F.col("event").alias("xml_id"), "witness", "ord", strings.leaf_span(F.col("a"), F.col("b"), F.col("t")).alias("locus"))
    loci = loci.filter("witness is not null").groupBy("xml_id", "witness").agg(F.max_by("locus", "ord").alias("locus")).groupBy("xml_id").agg(F.map_from_entries(F.collect_list(F.struct("witness", "locus"))).alias("loci"))
    return d.drop("doc", "feast", "author", "has_author").join(loci, "xml_id", "left").withColumn("short_label", strings.first_words(F.col("label_ka"), 4, "…"))


def lexicon(docs: DataFrame, pos: dict[str, str], pos_labels: dict[str, str], genders: dict[str, str], sources: dict[str, tuple[str, str]], other: tuple[str, str]) -> DataFrame:
    """Lexicon entries with lemma: labels, Greek equivalents, source references (four shown), slug, collation key. ``sources``: raw source -> (group, label)."""
    d = rows_of(docs, ".//entry", {
        "xml_id": ".@xml:id", "corresp": ".@corresp", "source": ".@source", "lemma": "form[@type='lemma']/orth", "variants": "form[@type='variant']/orth[]", "pos_raw": "gramGrp[pos]/pos", "gender": "gramGrp[pos]/gen",
        "greek": ".//cit[@type='translation'][@xml_lang='grc']/quote[]", "olia_uri": ".//xr[@type='lod']/ref@target",
    })
    d = d.filter("lemma is not null").withColumn("source", F.coalesce("source", F.lit("corpus")))
    refs = rows_of(docs, ".//entry/xr[@type='source']/ref", {"entry": "^entry#", "target": ".@target", "label": "."})
    refs = refs.withColumn("bare", strings.without_hashes(F.coalesce("target", F.lit(""))))
    one = F.struct("ord", F.col("bare").alias("text_id"), F.coalesce("label", "bare").alias("label"), (~F.startswith(F.coalesce("target", F.lit("")), F.lit("#"))).alias("is_dict_source"))
    refs = refs.groupBy("doc", F.col("entry").cast("int").alias("ord")).agg(F.array_sort(F.collect_list(one)).alias("refs"))
    table = lambda k: {a: b[k] for a, b in sources.items()}
    kind = F.when(F.col("pos_raw").isNull(), "other").otherwise(strings.labelled(F.lower("pos_raw"), pos, "other"))
    d = d.join(refs, ["doc", "ord"], "left").withColumn("pos", kind)
    return d.select(
        "doc", "ord", "xml_id", F.when(F.startswith("corresp", F.lit("bog:")), F.replace("corresp", F.lit("bog:"), F.lit(""))).otherwise("").alias("bog_id"), "lemma", "variants", "pos",
        F.when(F.col("pos_raw").isNull(), "").otherwise(strings.labelled(F.col("pos"), pos_labels)).alias("pos_label"), strings.labelled(F.col("gender"), genders).alias("gender"),
        F.try_element_at("greek", F.lit(1)).alias("greek"), F.try_element_at(F.filter(F.slice("greek", 2, 1 << 20), lambda g: g != ""), F.lit(1)).alias("greek_alt"), "olia_uri",
        F.slice(F.coalesce("refs", F.array().cast("array<struct<ord:int,text_id:string,label:string,is_dict_source:boolean>>")), 1, 4).alias("sources"),
        F.greatest(F.lit(0), F.coalesce(F.size("refs"), F.lit(0)) - 4).alias("sources_more"), "source", strings.labelled(F.trim("source"), table(0), other[0]).alias("source_group"),
        strings.labelled(F.trim("source"), table(1), other[1]).alias("source_label"), georgian.letter_slug(F.col("lemma")).alias("slug"), georgian.collation_key(F.col("lemma")).alias("collation"),
    )


def senses(docs: DataFrame) -> DataFrame:
    """Senses at any depth in document order (a parent before those nested in it), kept if they say anything: definition, construction,
    examples with reference and translation, and bare references."""
    d = rows_of(docs, ".//entry//sense", {"entry_id": "^entry@xml:id", "def_ka": "def*", "def_html": "def!", "note": "note", "construction": "gramGrp/gram"}, entry_html)
    cits = rows_of(docs, ".//sense/cit[@type='example']", {"sense": "^sense#", "quote_html": "quote!", "translation": "cit[@type='translation']/quote!", "has_quote": "quote#"}, entry_html)
    ranges = rows_of(docs, ".//sense/cit[@type='example']/bibl/citedRange", {"cit": "^cit#", "unit": ".@unit", "value": "."})
    ranges = ranges.groupBy("doc", F.col("cit").cast("int").alias("ord")).agg(F.array_sort(F.collect_list(F.struct("ord", F.coalesce("unit", F.lit("")).alias("unit"), F.coalesce("value", F.lit("")).alias("value")))).alias("r"))
    cits = cits.join(ranges, ["doc", "ord"], "left").withColumn("ref", F.when(F.col("r").isNull(), "").otherwise(strings.page_line_refs(F.col("r"))))
    example = F.when(F.col("has_quote").isNotNull(), F.struct("ord", F.coalesce("quote_html", F.lit("")).alias("quote_html"), "ref", F.coalesce("translation", F.lit("")).alias("translation")))
    cits = cits.groupBy("doc", F.col("sense").cast("int").alias("ord")).agg(
        F.array_sort(F.collect_list(example)).alias("examples"), F.array_sort(F.collect_list(F.when(F.col("has_quote").isNull() & (F.col("ref") != ""), F.struct("ord", "ref")))).alias("bare")
    )
    d = d.join(cits, ["doc", "ord"], "left").withColumn("refs", F.col("bare.ref")).drop("bare")
    says = strings.given(F.col("def_html")).isNotNull() | F.col("construction").isNotNull() | (F.coalesce(F.size("examples"), F.lit(0)) > 0) | (F.coalesce(F.size("refs"), F.lit(0)) > 0)
    return d.filter(says)


def popup(entries: DataFrame, senses_: DataFrame) -> DataFrame:
    """(xml_id, lemma, pos, def, slug): what a tagged word shows."""
    first = senses_.groupBy(F.col("entry_id").alias("xml_id")).agg(F.min_by("def_ka", "ord").alias("def"))
    return entries.join(first, "xml_id", "left").select("xml_id", "lemma", F.col("pos_label").alias("pos"), F.coalesce("def", F.lit("")).alias("def"), "slug")


def authority(docs: DataFrame) -> DataFrame:
    """Persons, places and the three listed kinds: name with fallback, display variants, notes, links."""
    common = {"desc": "note[@type='description']", "attestation": "bibl[@type='attestation']/citedRange", "seealso": "note[@type='seeAlso']", "viaf": "idno[@type='VIAF']", "xml_id": ".@xml:id", "type": ".@type"}

    def named(path: str, name: str, section: str) -> DataFrame:
        # a name without a type is a main one too
        parts = rows_of(docs, f"{path}/{name}", {"owner": f"^{path.rsplit('/', 1)[-1]}#", "type": ".@type", "lang": ".@xml:lang", "value": "."})
        main = F.col("type").isNull() | (F.col("type") == "main")
        pick = lambda lang: F.min_by("value", F.when(main & (F.col("lang") == lang) & F.col("value").isNotNull(), F.col("ord")))
        parts = parts.groupBy("doc", F.col("owner").cast("int").alias("ord")).agg(
            pick("ka").alias("ka"), pick("la").alias("name_la"), pick("en").alias("name_en"), F.min_by("value", F.when(main, F.col("ord"))).alias("first"),
            F.array_sort(F.collect_list(F.when(F.col("type") == "variant", F.struct("ord", "value")))).alias("v"),
        )
        d = rows_of(docs, path, common).join(parts, ["doc", "ord"], "left")
        return d.select("ord", F.lit(section).alias("section"), "xml_id", F.coalesce("ka", "first", F.lit("")).alias("name"), F.col("v.value").alias("all_variants"), prefix_roots(F.col("v.value")).alias("variants"), F.coalesce("type", F.lit("")).alias("type"), "desc", "attestation", "seealso", "viaf", "name_la", "name_en", F.lit(None).cast("string").alias("lex_id"))

    def listed(kind: str, section: str) -> DataFrame:
        d = rows_of(docs, f".//list[@type='{kind}']/item", common | {"corresp": ".@corresp", "variants": "term[@type='variant'][]", "first": "term"})
        plain = rows_of(docs, f".//list[@type='{kind}']/item/term", {"owner": "^item#", "type": ".@type", "value": "."}).filter("type is null and value is not null")
        plain = plain.groupBy("doc", F.col("owner").cast("int").alias("ord")).agg(F.min_by("value", "ord").alias("plain"))
        d = d.join(plain, ["doc", "ord"], "left")
        return d.select("ord", F.lit(section).alias("section"), "xml_id", F.coalesce("plain", "first", F.lit("")).alias("name"), F.col("variants").alias("all_variants"), prefix_roots(F.col("variants")).alias("variants"), F.lit("").alias("type"), "desc", "attestation", "seealso", F.lit(None).cast("string").alias("viaf"), F.lit(None).cast("string").alias("name_la"), F.lit(None).cast("string").alias("name_en"), strings.given(strings.without_hashes(F.col("corresp"))).alias("lex_id"))

    out = named(".//person", "persName", "persons").unionByName(named(".//place", "placeName", "places"))
    for kind, section in (("ethnonym", "ethnonyms"), ("fauna", "animals"), ("flora", "plants")):
        out = out.unionByName(listed(kind, section))
    return out


def bibliography(docs: DataFrame) -> DataFrame:
    """Every ``biblStruct`` with an id, at any depth: type (its own, else of the nearest list, else ``other``), titles, authors, imprint, scopes, identifiers."""
    d = rows_of(docs, ".//biblStruct", {
        "xml_id": ".@xml:id", "type": ".@type | ^listBibl@type", "has_analytic": "analytic#", "a_title": "analytic/title[@level='a']* | analytic/title*", "m_title": "monogr/title[@level='m']*", "j_title": "monogr/title[@level='j']*",
        "any_title": "monogr/title*", "title_short": "monogr/title[@type='short']*", "pub_place": "monogr/imprint/pubPlace*", "publisher": "monogr/imprint/publisher*", "when": "monogr/imprint/date@when", "nb": "monogr/imprint/date@notBefore",
        "na": "monogr/imprint/date@notAfter", "series": "monogr/biblScope[@unit='series']*[]", "volume": "monogr/biblScope[@unit='volume']*[]", "issue": "monogr/biblScope[@unit='issue']*[]", "pages": "monogr/biblScope[@unit='pp']*[]",
        "page": "monogr/biblScope[@unit='page']*[]", "extent": "monogr/extent*", "m_url": "monogr/ref@target", "url": "ref@target", "doi": ".//idno[@type='DOI']*[]", "iiif": ".//idno[@type='IIIF']*[]",
        "shelfmark": ".//idno[@type='shelfmark']*[]", "siglum": ".//idno[@type='siglum']*[]", "note": "note*",
    })

    def people(level: str) -> DataFrame:
        p = rows_of(docs, f".//biblStruct/{level}/author", {"owner": "^biblStruct#", "surname": "surname*", "forename": "forename*", "org": "orgName*", "all": ".*"})
        p = p.withColumn("org", F.coalesce("org", F.when(F.col("surname").isNull() & F.col("forename").isNull(), F.col("all"))))
        shown = strings.author_shown(F.col("surname"), F.col("forename"), F.col("org"))
        return p.groupBy("doc", F.col("owner").cast("int").alias("ord")).agg(F.array_sort(F.collect_list(F.struct("ord", shown.alias("shown"), F.lower(F.coalesce("surname", "org", F.lit(""))).alias("sort")))).alias(level))

    d = d.filter("xml_id is not null").join(people("analytic"), ["doc", "ord"], "left").join(people("monogr"), ["doc", "ord"], "left")
    who = F.coalesce("analytic", "monogr")
    last = lambda c: F.try_element_at(c, F.lit(-1))
    title = F.coalesce("a_title", "m_title", F.when(F.col("j_title").isNull(), F.col("any_title")))
    journal = F.when(F.col("has_analytic").isNotNull() | (F.col("m_title").isNull() & (F.col("a_title").isNull())), F.col("j_title"))
    return d.select(
        "ord", "xml_id", F.coalesce("type", F.lit("other")).alias("bib_type"), title.alias("title"), "title_short", F.array_join(F.transform(who, lambda a: a["shown"]), "; ").alias("authors"), journal.alias("journal"), "pub_place", "publisher",
        strings.imprint_date(F.col("when"), F.col("nb"), F.col("na")).alias("date"), last("series").alias("series"), last("volume").alias("volume"), last("issue").alias("issue"), F.coalesce(last("page"), last("pages")).alias("pages"),
        "extent", F.coalesce("m_url", "url").alias("url"), last("doi").alias("doi"), last("iiif").alias("iiif"), last("shelfmark").alias("shelfmark"), last("siglum").alias("siglum"), "note",
        F.coalesce(who[0]["sort"], F.lower(title), F.lit("")).alias("sort_key"),
    )


def articles(docs: DataFrame) -> DataFrame:
    """(xml_id, title, title_en, author, date, abstract) of each article; one that doesn't parse has no row."""
    d = rows_of(docs, ".", {
        "xml_id": ".@xml:id", "title": ".//titleStmt/title[@xml_lang='ka']* | .//titleStmt/title*", "title_en": ".//titleStmt/title[@type='sub']*", "author": ".//titleStmt/author/persName[@xml_lang='ka']* | .//titleStmt/author*",
        "when": ".//publicationStmt/date@when", "date": ".//publicationStmt/date*", "abstract": ".//abstract/p*", "first": ".//body//p!",
    }, plain_text)
    ident = F.coalesce("xml_id", "doc")
    abstract = F.coalesce("abstract", F.when(F.col("first").isNotNull(), strings.shortened(F.col("first"), 280, "…")), F.lit(""))
    return d.select("doc", ident.alias("xml_id"), F.coalesce("title", ident).alias("title"), F.coalesce("title_en", F.lit("")).alias("title_en"), F.coalesce("author", F.lit("")).alias("author"), F.coalesce("when", "date", F.lit("")).alias("date"), abstract.alias("abstract"))


def article_sections(docs: DataFrame, back: tuple[str, ...] = ("errata", "corrigenda", "appendix")) -> DataFrame:
    """Sections as an adjacency table: (doc, ord, parent, level, n, xml_id, head, kind), at any depth; of the back matter only the given kinds. A section's level
    is the number of sections around it, which are seen where it is read."""
    fields = {"n": ".@n", "xml_id": ".@xml:id", "head": "head!", "kind": ".@type", "around": "^div#[]"}
    body = rows_of(docs, ".//body//div", fields, plain_text)
    rest = rows_of(docs, ".//text/back/div", fields, plain_text).filter(F.col("kind").isin(*back))
    d = body.unionByName(rest).withColumns({"parent": F.get("around", F.lit(0)).cast("int"), "level": F.size("around")})
    return d.drop("around")


def in_contents() -> Column:
    """Is a section of the two upper levels, which a table of contents shows?"""
    return F.col("level") <= 1


def contents(sections_: DataFrame) -> DataFrame:
    """The two upper levels, for a table of contents."""
    return sections_.filter(in_contents()).select("doc", "ord", "parent", "level", "n", "xml_id", "head")


def plain_text(el: ET.Element) -> str | None:
    """Visible text: no notes and descriptions, line breaks as blanks, supplied text in brackets, gaps as ``[…]``."""
    out: list[str] = []
    work: list[ET.Element | str] = [el]
    while work:
        x = work.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        todo: list[ET.Element | str] = [x.text or ""]
        for c in x:
            todo += {"lb": [" "], "gap": ["[…]"], "note": [], "desc": []}.get(c.tag, ["[", c, "]"] if c.tag == "supplied" else [c])
            todo.append(c.tail or "")
        work += reversed(todo)
    return re.sub(r"\s+", " ", "".join(out)).strip() or None
