"""Paragraphs, text nodes and tokens.

Spans and offsets are computed by splitting a text into runs of word and non-word characters, whose lengths are added up
over Arrow batches; no shuffle. The walk through mixed content is one Arrow pass too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.functions import georgian
from loomtext.sources.markup import BATCH_CHARS, parse_xml, walk

#: Elements whose own text, and whose descendants' text, isn't read; their tails are.
SKIPPED = ["w", "lem", "rdg", "head", "note", "label", "pb", "lb", "cb"]

#: A text node, and a token of one; ``first`` is the node's first word, ``k`` the token's number in its row.
NODE = pa.struct([("para_id", pa.string()), ("para_ord", pa.int32()), ("node_idx", pa.int32()), ("quirk_idx", pa.int32()), ("is_tail", pa.bool_()), ("ord", pa.int32()), ("text", pa.string()), ("initial_char", pa.string())])
NODES = "array<struct<para_id:string,para_ord:int,node_idx:int,quirk_idx:int,is_tail:boolean,ord:int,text:string,initial_char:string>>"
TOKENS = "array<struct<k:int,surface:string,first:boolean,node_idx:int,is_tail:boolean,char_start:int,char_end:int,initial_char:string>>"


def paragraphs(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, para_id from 0, text): the lines of each document."""
    return docs.select(doc, F.posexplode(F.split(text, "\n")).alias("para_id", text))


def spans(texts: DataFrame, keys: list[str], text: str = "text", word: str = r"\p{L}+", other: str = r"[^\p{L}]+") -> DataFrame:
    """(keys, k, surface, char_start, char_end): the words of each text, their number from 0 in it, and their offsets in code points.

    ``word`` and ``other`` are maximal runs of complementary characters, so they alternate. The runs are cut in the JVM; their lengths
    are summed over whole Arrow batches, in time linear in a text's length, without a shuffle or a sort. Null texts have no word.
    """
    runs = F.regexp_extract_all(text, F.lit(f"({word})|({other})"), F.lit(0))
    df = texts.select(*keys, runs.alias("__runs")).filter("size(__runs) > 0")
    first = F.when(F.element_at("__runs", 1).rlike(f"^(?:{word})$"), 0).otherwise(1)
    df = df.select(*keys, "__runs", first.alias("__first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, first_word = b.column(b.num_columns - 2), b.column(b.num_columns - 1).to_numpy()
            size, flat = pc.list_value_length(lists).to_numpy(zero_copy_only=False), lists.flatten()
            end = np.cumsum(pc.utf8_length(flat).to_numpy(zero_copy_only=False), dtype=np.int64)
            begin = np.concatenate([[0], end[:-1]])
            row = np.repeat(np.arange(b.num_rows), size)
            head = np.cumsum(size) - size
            nth = np.arange(len(row)) - head[row]
            at = np.flatnonzero(nth % 2 == first_word[row])
            base, of = begin[head][row[at]], pa.array(row[at])
            numbers = [pa.array(x.astype(np.int32)) for x in (nth[at] // 2, begin[at] - base, end[at] - base)]
            yield pa.record_batch([*[b.column(i).take(of) for i in range(b.num_columns - 2)], numbers[0], flat.take(pa.array(at)), *numbers[1:]], names)

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-2]]
    names = [*df.columns[:-2], "k", "surface", "char_start", "char_end"]
    return df.mapInArrow(run, ", ".join([*kinds, "k int, surface string, char_start int, char_end int"]))


def slices(df: DataFrame, text: str, froms: Column, tos: Column, name: str) -> DataFrame:
    """``df`` with an array ``name`` of the pieces of ``text`` between the offsets of two arrays of int; each piece takes time by its own
    length, wherever in the text it is. Null without offsets."""
    df = df.withColumns({"__from": froms, "__to": tos})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = {n: i for i, n in enumerate(b.schema.names)}
            three = (b.column(at[n]) for n in (text, "__from", "__to"))
            cut = [None if f.as_py() is None else [t[i:j] for t in [s.as_py()] for i, j in zip(f.as_py(), e.as_py(), strict=True)] for s, f, e in zip(*three, strict=True)]
            keep = [n for n in b.schema.names if n not in ("__from", "__to")]
            yield pa.record_batch([*[b.column(at[n]) for n in keep], pa.array(cut, pa.list_(pa.string()))], [*keep, name])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-2]]
    return df.mapInArrow(run, ", ".join([*kept, f"`{name}` array<string>"]))


def numbered(words: DataFrame, keys: list[str], order: list[str], name: str = "k") -> DataFrame:
    """Words with their number from 0 inside each of ``keys``."""
    return words.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)


def words_of(docs: DataFrame, keys: list[str], text: str = "text", word: str = r"\p{L}+") -> DataFrame:
    """(keys, surface): the words without offsets; no shuffle."""
    return docs.select(*keys, F.explode(F.regexp_extract_all(text, F.lit(f"({word})"), F.lit(1))).alias("surface"))


def blank_words(text: Column, ends: str = '.,!?;:"') -> Column:
    """Array of white-space words without ``ends`` around them; those of punctuation alone are dropped."""
    words = F.transform(F.split(text, r"(?U)\s+"), lambda w: F.btrim(w, F.lit(ends)))
    return F.filter(words, lambda w: w.rlike(r"(?U)\w"))


def node_lists(docs: DataFrame, skipped: list[str] = SKIPPED, whole: bool = False) -> DataFrame:
    """The readable text nodes of ``docs`` (doc, text) in order, as a list: (text_id, nodes) for each paragraph (``p`` with an id) that has any,
    or, if ``whole``, (doc, text, nodes) for each document, those without any and those that don't parse too.

    node_idx is the element's number inside the paragraph; for a tail, of the element it follows.
    quirk_idx numbers a tail by the last descendant of the element it follows, for compatibility with
    data that was made so. initial_char is the ornate initial that the tail continues.
    """
    skip = frozenset(skipped)

    def hidden(el) -> bool:
        return el.tag in skip or (el.tag == "hi" and "initial" in el.get("rend", ""))

    def nodes(p) -> Iterator[tuple[int, int, bool, str, str]]:
        below = {el: k for k, (el, *_) in enumerate(walk(p))}

        def last(el) -> int:
            while len(el):
                el = el[-1]
            return below[el]

        # an explicit stack of (element, is its text hidden, what to do)
        work = [(p, False, "in")]
        while work:
            el, off, step = work.pop()
            if step == "tail":
                initial = el.text.strip()[:1] if el.tag == "hi" and "initial" in el.get("rend", "") and el.text else ""
                yield below[el], last(el), True, el.tail, initial if "Ⴀ" <= initial <= "Ⴥ" else ""
                continue
            off_here = off or hidden(el)
            if el.text and not off_here:
                yield below[el], below[el], False, el.text, ""
            for c in reversed(el):
                if c.tail and not off_here:
                    work.append((c, off_here, "tail"))
                work.append((c, off_here, "in"))

    def handed(heads: list[tuple], found: list[tuple], ends: list[int]) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else [()] * NODE.num_fields
        flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, NODE, strict=True)], fields=list(NODE))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
        return pa.record_batch([*[pa.array(c, pa.string()) for c in zip(*heads, strict=True)], lists], [*(["doc", "text"] if whole else ["text_id"]), "nodes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            heads, found, ends, size = [], [], [0], 0
            for doc, text in zip(b.column(0), b.column(1), strict=True):
                t = text.as_py() or ""
                root = parse_xml(t)
                for n, p in enumerate(x for x in root.iter("p") if x.get("xml_id")) if root is not None else ():
                    before = len(found)
                    found += [(p.get("xml_id"), n, a, q, tail, k, s, i) for k, (a, q, tail, s, i) in enumerate(nodes(p))]
                    if not whole and len(found) > before:
                        heads.append((root.get("xml_id") or doc.as_py(),))
                        ends.append(len(found))
                if whole:
                    heads.append((doc.as_py(), t))
                    ends.append(len(found))
                size += len(t)
                if size > BATCH_CHARS:
                    if heads:
                        yield handed(heads, found, ends)
                    heads, found, ends, size = [], [], [0], 0
            if heads:
                yield handed(heads, found, ends)

    return docs.select(F.col("doc").cast("string"), "text").mapInArrow(run, ("doc string, text string, " if whole else "text_id string, ") + f"nodes {NODES}")


def text_nodes(docs: DataFrame, skipped: list[str] = SKIPPED) -> DataFrame:
    """The text nodes of ``node_lists``, a row each: text_id, para_id, para_ord, node_idx, quirk_idx, is_tail, ord, text, initial_char."""
    found = node_lists(docs, skipped).select("text_id", F.inline("nodes"))
    return found.withColumn("initial_char", georgian.later_script(F.col("initial_char")))


def runs_of(nodes: str, word: str, other: str) -> Column:
    """For each of ``nodes`` the maximal runs of word characters and of others in its text, which alternate."""
    return F.transform(nodes, lambda n: F.regexp_extract_all(n["text"], F.lit(f"({word})|({other})"), F.lit(0)))


def paragraph_tokens(docs: DataFrame, skipped: list[str] = SKIPPED, word: str = georgian.WORD, other: str = "[^" + georgian.WORD[1:-2] + "]+", compat: bool = False) -> DataFrame:
    """(text_id, para_id, tokens) of each paragraph of ``docs`` (doc, text) that has a word: its tokens in order, as an array of structs (k from 0, surface, first of its
    node or not, node_idx, is_tail, char_start, char_end, initial_char). Runs are cut once in the JVM; numbers and offsets are summed over whole Arrow batches,
    a paragraph's nodes stay in its row, and nothing is shuffled."""
    runs, idx = runs_of("nodes", word, other), "quirk_idx" if compat else "node_idx"
    lists = node_lists(docs, skipped).select("text_id", F.col("nodes")[0]["para_id"].alias("para_id"), "nodes", runs.alias("runs"))
    starts = F.transform("runs", lambda r: F.get(r, F.lit(0)).rlike(f"^(?:{word})$"))
    lists = lists.select("text_id", "para_id", F.col(f"nodes.{idx}").alias("idx"), F.col("nodes.is_tail").alias("tail"), F.transform("nodes", lambda n: georgian.later_script(n["initial_char"])).alias("initial"), "runs", starts.alias("starts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            idx, tail, initial, lists, starts = (c.flatten() for c in b.columns[2:])  # a value for each node
            para = np.repeat(np.arange(b.num_rows), pc.list_value_length(b.column(5)).to_numpy(zero_copy_only=False))
            size, flat = pc.list_value_length(lists).to_numpy(zero_copy_only=False), lists.flatten()
            node = np.repeat(np.arange(len(size)), size)
            end = np.cumsum(pc.utf8_length(flat).to_numpy(zero_copy_only=False), dtype=np.int64)
            begin = np.concatenate([[0], end[:-1]])
            head = np.cumsum(size) - size
            nth = np.arange(len(node)) - head[node]
            lead = np.where(pc.fill_null(starts, False).to_numpy(zero_copy_only=False), 0, 1)
            at = np.flatnonzero(nth % 2 == lead[node])
            of = node[at]
            base, words = begin[head[of]], np.bincount(para[of], minlength=b.num_rows)
            ends = np.concatenate([[0], np.cumsum(words)])
            k = np.arange(len(at)) - ends[para[of]]
            where = pa.array(of)
            columns = [pa.array(k.astype(np.int32)), flat.take(pa.array(at)), pa.array(nth[at] // 2 == 0), idx.take(where), tail.take(where), *[pa.array((x[at] - base).astype(np.int32)) for x in (begin, end)], initial.take(where)]
            names = ["k", "surface", "first", "node_idx", "is_tail", "char_start", "char_end", "initial_char"]
            tokens = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays(columns, names))
            yield pa.record_batch([b.column(0), b.column(1), tokens], ["text_id", "para_id", "tokens"])

    return lists.mapInArrow(run, f"text_id string, para_id string, tokens {TOKENS}").filter("size(tokens) > 0")


def _named(words: DataFrame, normalise) -> DataFrame:
    """Tokens from words with their number ``k`` and their place. The first word of a tail that continues an initial is normalised with it; its surface stays as it is."""
    return words.select(
        F.concat_ws("_", "text_id", "para_id", F.concat(F.lit("t"), F.col("k").cast("string"))).alias("token_id"),
        "surface", normalise(F.when(F.col("first"), F.concat("initial_char", "surface")).otherwise(F.col("surface"))).alias("norm"), "text_id", "para_id", "node_idx", "is_tail", "char_start", "char_end", "initial_char",
    )


def tokens_of(docs: DataFrame, skipped: list[str] = SKIPPED, word: str = georgian.WORD, other: str = "[^" + georgian.WORD[1:-2] + "]+", normalise=georgian.normalise, compat: bool = False) -> DataFrame:
    """What ``tokenise`` gives of the text nodes of ``docs`` (doc, text), without a shuffle."""
    return _named(paragraph_tokens(docs, skipped, word, other, compat).select("text_id", "para_id", F.inline("tokens")), normalise)


def tokenise(nodes: DataFrame, word: str = georgian.WORD, other: str = "[^" + georgian.WORD[1:-2] + "]+", normalise=georgian.normalise, compat: bool = False) -> DataFrame:
    """Tokens of a table of text nodes (as of ``text_nodes``, in any order of its rows): token_id, surface, norm, text_id, para_id, node_idx, is_tail, char_start, char_end, initial_char."""
    # the nodes are numbered on by the words before them, so that no word is shuffled
    count = F.coalesce(F.size(F.regexp_extract_all("text", F.lit(f"({word})"), F.lit(1))), F.lit(0))
    earlier = Window.partitionBy("text_id", "para_ord").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumn("__earlier", F.coalesce(F.sum(count).over(earlier), F.lit(0)).cast("int"))
    words = spans(nodes.withColumn("node_idx", F.col("quirk_idx" if compat else "node_idx")), ["text_id", "para_id", "node_idx", "is_tail", "initial_char", "__earlier"], "text", word, other)
    return _named(words.withColumn("first", F.col("k") == 0).withColumn("k", F.col("__earlier") + F.col("k")), normalise)
