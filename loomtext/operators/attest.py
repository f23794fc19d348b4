"""Attestations: where entries and names occur, with their context; counts, caps and fallbacks."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.functions.strings import shown_number, squeezed
from loomtext.operators.tokens import slices
from loomtext.sources.markup import parse_xml, walk

ATTESTATIONS = "target_id string, kind string, text_id string, ord int, para_id string, para_n string, start int, length int, para string"


def context(para: Column, start: Column, length: Column, half: int = 40) -> Column:
    """The word with ``half`` characters on each side, white space squeezed after cutting, ellipses where something was cut."""
    low = F.greatest(F.lit(0), start - half)
    high = F.least(F.char_length(para), start + length + half)
    raw = squeezed(F.substring(para, low + 1, high - low))
    return F.concat(F.when(low > 0, "…").otherwise(""), raw, F.when(high < F.char_length(para), "…").otherwise(""))


def contexts(paras: DataFrame, hits: DataFrame, keys: list[str], more: list[str], text: str = "text", half: int = 40) -> DataFrame:
    """(keys, more, quote): ``context`` for hits (keys, more, char_start, char_end) in the paragraphs of ``paras`` (keys, text). A paragraph
    meets its hits once, and every quote is cut in time by its own length, however long the paragraph is."""
    one = hits.groupBy(*keys).agg(F.collect_list(F.struct(*more, "char_start", "char_end")).alias("__hits"))
    df = paras.join(one, keys).withColumn("__size", F.char_length(text).cast("int"))
    low = F.transform("__hits", lambda h: F.greatest(F.lit(0), h["char_start"] - half))
    high = F.transform("__hits", lambda h: F.least(F.col("__size"), h["char_end"] + half))
    df = slices(df, text, low, high, "__cut").select(*keys, "__size", F.inline(F.arrays_zip("__hits", "__cut")))
    quote = F.concat(F.when(F.col("__hits.char_start") > half, "…").otherwise(""), squeezed(F.col("__cut")), F.when(F.col("__hits.char_end") + half < F.col("__size"), "…").otherwise(""))
    return df.select(*keys, *[F.col(f"__hits.{m}").alias(m) for m in more], quote.alias("quote"))


def references(docs: DataFrame) -> DataFrame:
    """Tagged words (``w``) and names (``persName``, ``placeName``) inside paragraphs of ``docs`` (doc, text): the target of their
    ``#`` reference, the nearest paragraph's id, number and text, and the place of the element's own text in it."""
    wanted = {"w": ("entry", ("lemmaRef", "lemma")), "persName": ("name", ("ref",)), "placeName": ("name", ("ref",))}

    def of(root: ET.Element, text_id: str) -> Iterator[tuple]:
        # one walk: the text so far of every open paragraph, and the elements found with the offset of their text
        parts: dict[ET.Element, list[str]] = {}
        length: dict[ET.Element, int] = {}
        found: list[tuple] = []
        inside: list[ET.Element] = []

        def add(s: str | None) -> None:
            for p in inside:
                if s:
                    parts[p].append(s)
                    length[p] += len(s)

        ord_ = {el: k for k, (el, *_) in enumerate(walk(root))}
        work = [(root, "in")]
        while work:
            el, step = work.pop()
            if step == "out":
                if inside and inside[-1] is el:
                    inside.pop()
                add(el.tail if el is not root else None)
                continue
            if el.tag in wanted and inside:
                kind, attrs = wanted[el.tag]
                ref = next((el.get(a) for a in attrs if el.get(a)), "")
                if ref.startswith("#"):
                    found.append((ref[1:], kind, ord_[el], inside[-1], length[inside[-1]] if el.text else 0, len(el.text or "")))
            if el.tag in ("p", "ab"):
                inside.append(el)
                parts[el], length[el] = [], 0
            add(el.text)
            work.append((el, "out"))
            work += [(c, "in") for c in reversed(el)]
        for target, kind, k, p, start, n in found:
            yield target, kind, text_id, k, p.get("xml_id", ""), p.get("n"), start, n, "".join(parts[p])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["target_id", "kind", "text_id", "ord", "para_id", "para_n", "start", "length", "para"]
        kinds = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]
        for b in batches:
            for doc, text in zip(b.column(0), b.column(1), strict=True):
                root = parse_xml(text.as_py() or "")
                rows = list(of(root, doc.as_py())) if root is not None else []
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    found = docs.select(F.col("doc").cast("string"), "text").mapInArrow(run, ATTESTATIONS)
    return found.withColumn("para_n", shown_number(F.col("para_n"), F.col("para_id")))


def attestations(found: DataFrame, titles: DataFrame | None = None, half: int = 40) -> DataFrame:
    """One attestation per target, text and paragraph, the first in document order, with its quote (and the text's title)."""
    keys = ["target_id", "kind", "text_id", "para_id"]
    rest = [c for c in found.columns if c not in keys]
    once = found.groupBy(*keys).agg(F.min_by(F.struct(*rest), "ord").alias("x")).select(*keys, "x.*")
    once = once.withColumn("quote", context(F.col("para"), F.col("start"), F.col("length"), half)).drop("para", "start", "length")
    return once.join(titles.select("text_id", "title"), "text_id", "left") if titles is not None else once


def totals(found: DataFrame) -> DataFrame:
    """One row: attestations and distinct targets."""
    return found.agg(F.count("*").alias("attestations"), F.count_distinct("target_id").alias("targets"))


def capped(found: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """The first ``n`` of each key and how many more there are (a display cap).

    Ranked by a window of its own, so each partition keeps ``n`` rows a key before the shuffle; counted beside it.
    """
    ranked = found.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("nth") <= n)
    counts = found.groupBy(key).agg(F.greatest(F.lit(0), F.count("*") - n).alias("more"))
    return ranked.join(counts, key)


def per_text(found: DataFrame, key: str) -> DataFrame:
    """Attestations by key and text, in text order, with the number of texts (their titles compared without case)."""
    one = found.groupBy(key, "text_id").agg(F.count("*").alias("n"))
    return one.join(one.groupBy(key).agg(F.count("*").alias("texts")), key).orderBy(key, "text_id")


def with_fallback(entries: DataFrame, own: DataFrame, other: DataFrame, key: str = "xml_id", link: str = "lex_id") -> DataFrame:
    """(key, target, attestation columns…): an entry's own attestations; those of its linked entry only if it has none."""
    direct = entries.select(key, F.col(key).alias("target_id")).join(own, "target_id")
    lacking = entries.filter(F.col(link).isNotNull()).join(own.select(F.col("target_id").alias(key)).distinct(), key, "left_anti")
    linked = lacking.select(key, F.col(link).alias("target_id")).join(other, "target_id")
    return direct.unionByName(linked)


def first_with(rows: DataFrame, key: str, order: str, column: str) -> DataFrame:
    """Per key the first row in ``order`` whose ``column`` is given."""
    rest = [c for c in rows.columns if c != key]
    given = rows.filter(F.coalesce(column, F.lit("")) != "")
    return given.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("x")).select(key, "x.*")


def apparatus(docs: DataFrame, types: dict[str, tuple[str, str]], default: str = "rdg-orth") -> DataFrame:
    """Readings of each apparatus entry of ``docs``: running number in the text, lemma, reading, witness, type, its class and label,
    and the entry's type, which is its last reading's."""
    from loomtext.sources.markup import rows_of

    apps = rows_of(docs, ".//app", {"lemma": "lem*", "par_id": "^p@xml:id", "par_n": "^p@n"})
    apps = apps.withColumn("n", F.row_number().over(Window.partitionBy("doc").orderBy("ord")))
    readings = rows_of(docs, ".//app/rdg", {"app": "^app#", "reading": ".*", "witness": ".@wit", "type": ".@type"})
    readings = readings.withColumn("app", F.col("app").cast("int")).withColumn("type", F.coalesce("type", F.lit("orthographic")))
    css = F.create_map(*[F.lit(x) for k, (c, _) in types.items() for x in (k, c)])
    label = F.create_map(*[F.lit(x) for k, (_, c) in types.items() for x in (k, c)])
    readings = readings.select(
        "doc", "app", F.col("ord").alias("rdg_ord"), "reading", F.ltrim(F.coalesce("witness", F.lit("")), F.lit("#")).alias("witness"), "type",
        F.coalesce(F.element_at(css, F.col("type")), F.lit(default)).alias("type_class"), F.coalesce(F.element_at(label, F.col("type")), F.col("type")).alias("type_label"),
    )
    last = readings.groupBy("doc", "app").agg(F.max_by("type", "rdg_ord").alias("entry_type"))
    full = apps.join(last.withColumnRenamed("app", "ord"), ["doc", "ord"], "left").withColumn("entry_type", F.coalesce("entry_type", F.lit("orthographic")))
    return full.join(readings.withColumnRenamed("app", "ord"), ["doc", "ord"], "left")
