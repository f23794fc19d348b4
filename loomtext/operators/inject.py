"""Tags put back into documents: words and names wrapped where their offsets say, checked before and after.

One document is one row; its tokens are gathered beside it (bounded by the document) and the tags are spliced
into its tree from the last offset to the first. Nothing is rewritten in place: the result is a new version.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from itertools import accumulate
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from loomtext.functions import georgian
from loomtext.operators.lookup import MOST_KEYS
from loomtext.operators.tokens import SKIPPED, node_lists, runs_of, slices, tokens_of
from loomtext.operators.validate import introduced, tag_violations, violations
from loomtext.sources.markup import BATCH_CHARS, node_table, walk, well_formed
from loomtext.sources.tables import publish

#: How far a shifted word is looked for.
BACK, REACH = 5, 10
#: Elements in which scoped tagging leaves everything alone.
SCOPED_SKIP = ["rdg", "note", "bibl", "citedRange", "teiHeader", "fw", "head", "title", "abbr"]
NAMES_SKIP = [*SCOPED_SKIP, "w", "persName", "placeName"]


def taggable(matched: DataFrame, tiers: tuple[str, str] = ("primary", "master")) -> DataFrame:
    """Tokens to tag: names with an id, exact and normalised hits of the first dictionary, exact ones of the second."""
    a, b = tiers
    pair = F.struct("match_tier", "confidence")
    lex = [F.struct(F.lit(t), F.lit(c)) for t, c in ((a, "exact"), (a, "norm"), (b, "exact"))]
    return matched.filter((F.col("match_id") != "") & ((F.col("match_tier") == "authority") | pair.isin(lex)))


def in_order(tokens: DataFrame, key: str = "text_id") -> DataFrame:
    """(key, tokens): each document's tokens in the order in which they are spliced, last first."""
    one = F.struct("node_idx", "is_tail", "char_start", "char_end", "surface", "para_id", "match_id", "match_tier", "match_source")
    return tokens.groupBy(key).agg(F.sort_array(F.collect_list(one), asc=False).alias("tokens"))


def _local(tag: str, root: ET.Element) -> str:
    """A tag in the root's namespace."""
    return root.tag[: root.tag.index("}") + 1] + tag if "}" in root.tag else tag


def _texts(root: ET.Element) -> Callable[[ET.Element, bool], list[tuple[ET.Element, str]]]:
    """For an element's own text, or its tail: the places that hold it, (element, "text" or "tail"). Comments and processing
    instructions aren't nodes, so a text goes on in the tails of those that follow."""
    after: dict[ET.Element, ET.Element] = {}
    first: dict[ET.Element, ET.Element] = {}
    for p in root.iter():
        children = list(p)
        if children:
            first[p] = children[0]
        after.update(zip(children, children[1:], strict=False))

    def places(el: ET.Element, tail: bool) -> list[tuple[ET.Element, str]]:
        out = [(el, "tail" if tail else "text")]
        then = (after if tail else first).get(el)
        while then is not None and not isinstance(then.tag, str):
            out.append((then, "tail"))
            then = after.get(then)
        return out

    return places


def splice(root: ET.Element, tokens: list[dict], authority: str = "authority") -> tuple[int, int]:
    """Wraps the tokens in ``root``; returns how many were tagged and how many skipped. Places refer to the tree as it is
    on entry. Tokens come last first; each text is cut once, at the places of all its tokens."""
    ident = "{http://www.w3.org/XML/1998/namespace}id"
    nodes = {p.get(ident): [el for el, *_ in walk(p)] for p in root.iter() if isinstance(p.tag, str) and p.tag.rsplit("}", 1)[-1] == "p" and p.get(ident)}
    places = _texts(root)
    whole: dict[tuple[ET.Element, bool], tuple[list[tuple[ET.Element, str]], str, list[int]]] = {}
    taken: dict[tuple[ET.Element, bool], list[tuple[int, int, ET.Element]]] = {}
    done = skipped = 0
    for t in tokens:
        below = nodes.get(t["para_id"], [])
        el = below[t["node_idx"]] if t["node_idx"] < len(below) else None
        key = (el, bool(t["is_tail"]))
        if el is not None and key not in whole:
            held = places(*key)
            parts = [getattr(e, kind) or "" for e, kind in held]
            whole[key] = (held, "".join(parts), [0, *accumulate(map(len, parts))])
            taken[key] = []
        _, text, edges = whole.get(key, ([], "", [0]))
        word, start = t["surface"], t["char_start"]
        limit = taken[key][-1][0] if taken.get(key) else len(text)  # what follows is tagged already
        if not (start + len(word) <= limit and text.startswith(word, start)):
            at = text.find(word, max(0, start - BACK), limit)
            start = at if at >= 0 and abs(at - start) <= REACH else -1
        if start < 0 or not word or any(start < e < start + len(word) for e in edges):
            skipped += 1
            continue
        if t["match_tier"] == authority:
            new = ET.Element(_local("placeName" if "place" in (t["match_source"] or "") else "persName", root), {"ref": "#" + t["match_id"]})
        else:
            new = ET.Element(_local("w", root), {"lemmaRef": "#" + t["match_id"]})
        new.text = word
        taken[key].append((start, start + len(word), new))
        done += 1
    behind: dict[ET.Element, list[ET.Element]] = {}
    before: dict[ET.Element, list[ET.Element]] = {}
    for key, cuts in taken.items():
        held, text, edges = whole[key]
        cuts = cuts[::-1]
        for (holder, kind), low, high in zip(held, edges, edges[1:], strict=False):
            inside = [c for c in cuts if low <= c[0] < high]
            if inside:
                setattr(holder, kind, text[low : inside[0][0]] or None)
                for (_, end, new), (then, *_) in zip(inside, [*inside[1:], (high, high, None)], strict=True):
                    new.tail = text[end:then] or None
                (before if kind == "text" else behind)[holder] = [c[2] for c in inside]
    for p in [*root.iter()] if done else []:
        children = list(p)
        if p in before or any(c in behind for c in children):
            p[:] = [*before.get(p, ()), *(x for c in children for x in (c, *behind.get(c, ())))]
    return done, skipped


def _parsed(text: str) -> tuple[str, ET.Element, str]:
    """What stands before the root element, the root with comments and processing instructions in it, and what follows. Elements that are empty
    between a start and an end tag have the text ``""``, those of a single tag None."""
    raw = text.encode("utf-8", "surrogatepass")
    root = ET.fromstring(raw, ET.XMLParser(target=ET.TreeBuilder(insert_comments=True, insert_pis=True)))
    ends: list[int] = []
    opened: list[int] = []
    paired: list[bool] = []
    depth = 0
    p = expat.ParserCreate()

    def start(*_) -> None:
        nonlocal depth
        if not depth:
            ends.append(p.CurrentByteIndex)
        depth += 1
        opened.append(len(paired))
        paired.append(False)

    def end(*_) -> None:
        nonlocal depth
        depth -= 1
        at = p.CurrentByteIndex
        paired[opened.pop()] = raw[at : at + 2] == b"</" and raw[at - 2 : at] != b"/>"  # a single tag ends before ``at``
        if not depth:
            ends.append(at)

    p.StartElementHandler, p.EndElementHandler = start, end
    p.Parse(raw, True)
    for el, two in zip((x for x in root.iter() if isinstance(x.tag, str)), paired, strict=True):
        if two and not el.text and not len(el):
            el.text = ""
    close = raw.index(b">", ends[1]) + 1 if raw[ends[1] : ends[1] + 2] == b"</" else len(raw)
    return raw[: ends[0]].decode("utf-8", "surrogatepass"), root, raw[close:].decode("utf-8", "surrogatepass")


def _written(root: ET.Element) -> str:
    """The markup of a tree of ``_parsed``; what was empty between two tags stays so."""
    for el in root.iter():
        if el.text == "" and not len(el) and isinstance(el.tag, str):
            el.text = "\0"  # no text can hold it
    return ET.tostring(root, encoding="unicode").replace("\0", "")


_MADE = pa.schema([("doc", pa.string()), ("text", pa.string()), ("tagged", pa.int32()), ("skipped", pa.int32()), ("introduced", pa.list_(pa.string())), ("written", pa.bool_())])
_INJECTED = "doc string, text string, tagged int, skipped int, introduced array<string>, written boolean"


def _made(doc: str, old: str, some: list[dict], gate: bool) -> tuple:
    """A row of ``inject``: a document with its tokens spliced in, last first."""
    if not some:
        return doc, old, 0, 0, [], False
    try:
        lead, root, rest = _parsed(old)
    except (ET.ParseError, expat.ExpatError):
        return doc, old, 0, len(some), ["not well-formed"], False
    if "}" in root.tag:
        ET.register_namespace("", root.tag[1 : root.tag.index("}")])
    violations = tag_violations(root)
    done, skipped = splice(root, some)
    after = tag_violations(root)
    worse = [k for k in after if after[k] > violations[k]]
    stands = bool(done) and not (gate and worse)
    return doc, lead + _written(root) + rest if stands else old, done, skipped, worse, stands


def _handed(made: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of ``inject`` in batches; new texts are handed on before all of them are made."""
    batch = lambda rows: pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _MADE, strict=True)], schema=_MADE)
    rows, size = [], 0
    for r in made:
        rows.append(r)
        size += len(r[1])
        if size > BATCH_CHARS:
            yield batch(rows)
            rows, size = [], 0
    if rows:
        yield batch(rows)


def inject(docs: DataFrame, tokens: DataFrame, every: bool = False, gate: bool = True) -> DataFrame:
    """(doc, text, tagged, skipped, introduced, written) per document of ``docs`` (doc, text) with tokens (as of ``in_order``, by text_id).

    The new text stands only if tagging introduced no violation that wasn't there before; else the old one does. Comments and
    processing instructions stay, those around the root too. ``every`` also gives documents without tokens, as they are. Without ``gate`` the new text always
    stands, for ``gated`` to judge.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(k) for k in range(3)), strict=True)
            yield from _handed(_made(doc.as_py(), text.as_py() or "", tk.as_py() or [], gate) for doc, text, tk in rows)

    both = docs.select(F.col("doc").cast("string"), "text").join(tokens.select(F.col("text_id").alias("doc"), "tokens"), "doc", "left" if every else "inner")
    return both.mapInArrow(run, _INJECTED)


def inject_known(docs: DataFrame, keys: DataFrame, word: str, other: str, skipped: list[str] = SKIPPED, every: bool = False, gate: bool = True, most: int = MOST_KEYS) -> DataFrame:
    """What ``inject`` gives of the words of ``docs`` (doc, text; an id is one document's, the root's if it has one) that are keys.
    ``keys`` (surface, match_id, match_tier, match_source, confidence) has a row for each surface. Of ``most`` keys at most every task has all, and neither words nor texts are shuffled; more keys are joined with the words."""
    keys = taggable(keys).filter(F.col("surface").rlike(f"^(?:{word})$")).select("surface", "match_id", "match_tier", "match_source")
    if keys.limit(most + 1).count() > most:
        return inject(docs, in_order(tokens_of(docs, skipped, word, other, F.lower).join(keys, "surface")), every, gate)
    known = docs.sparkSession.sparkContext.broadcast({r.surface: {"match_id": r.match_id, "match_tier": r.match_tier, "match_source": r.match_source} for r in keys.collect()})  # ``most`` at most

    def hits(nodes: list[dict], texts: list[list[str]]) -> list[dict]:
        found, keys = [], known.value
        for n, runs in zip(nodes, texts, strict=True):
            at = 0
            for s in runs:  # runs between words are never keys
                hit = keys.get(s)
                if hit is not None:
                    found.append({"node_idx": n["node_idx"], "is_tail": n["is_tail"], "char_start": at, "char_end": at + len(s), "surface": s, "para_id": n["para_id"], **hit})
                at += len(s)
        return sorted(found, key=lambda t: (t["node_idx"], t["is_tail"], t["char_start"]), reverse=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = ((doc.as_py(), text.as_py(), hits(nodes.as_py(), runs.as_py())) for doc, text, nodes, runs in zip(*b.columns, strict=True))
            yield from _handed(_made(doc, text, some, gate) for doc, text, some in found if some or every)

    place = F.transform("nodes", lambda n: F.struct(n["para_id"].alias("para_id"), n["node_idx"].alias("node_idx"), n["is_tail"].alias("is_tail")))
    return node_lists(docs, skipped, whole=True).select("doc", "text", place.alias("nodes"), runs_of("nodes", word, other).alias("runs")).mapInArrow(run, _INJECTED)


def gated(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, refused) of a new version of documents (doc, text): accepted has every document's new text if it violates no rule more often than its
    old one does, else the old text; refused lists (doc, rule, before, after, added) for what got worse. A document of one version only
    counts as one without violations in the other; new ones that don't parse are refused by the rule ``not well-formed``."""
    counted = lambda docs: violations(node_table(docs))
    worse = introduced(counted(old), counted(new), ["doc", "rule"], "violations")
    broken = new.join(well_formed(new).filter("not ok").select("doc"), "doc", "left_semi")
    lost = broken.select("doc", F.lit("not well-formed").alias("rule"), F.lit(0).cast("long").alias("before"), F.lit(1).cast("long").alias("after"), F.lit(1).cast("long").alias("added"))
    refused = worse.unionByName(lost)
    bad = refused.select("doc").distinct()
    accepted = new.select("doc", "text").join(bad, "doc", "left_anti").unionByName(old.select("doc", "text").join(bad, "doc", "left_semi"))
    return accepted, refused


def observed_summary(injected: DataFrame, path: str, version: str) -> DataFrame:
    """Publishes the documents of ``inject`` as a version and gives the one row of ``summary``, counted while they were written."""
    seen = Observation()
    held_back = F.count_if(F.size("introduced") > 0)
    watched = injected.observe(seen, F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("tagged"), F.lit(0)).alias("tagged"), F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped"), held_back.alias("held_back"))
    publish(watched, path, version)
    return injected.sparkSession.createDataFrame([tuple(seen.get[k] for k in ("documents", "tagged", "skipped", "held_back"))], "documents long, tagged long, skipped long, held_back long")


def summary(injected: DataFrame) -> DataFrame:
    """One row: documents, tags, skipped tokens, documents held back."""
    return injected.agg(F.count("*").alias("documents"), F.sum("tagged").alias("tagged"), F.sum("skipped").alias("skipped"), F.count_if(F.size("introduced") > 0).alias("held_back"))


def spliced_text(texts: DataFrame, hits: DataFrame, keys: list[str], text: str = "text", before: str = "<w lemma=\"#", after: str = "\">", close: str = "</w>") -> DataFrame:
    """Plain texts with their hits (keys, char_start, char_end, id) wrapped: the pieces between and inside hits are cut once
    each and joined. Hits must not overlap; a text without any stays as it is."""
    one = hits.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("char_start", "char_end", "id"))).alias("__h"))
    df = texts.join(one, keys, "left")
    bounds = F.flatten(F.transform("__h", lambda h: F.array(h["char_start"], h["char_end"])))
    df = slices(df, text, F.concat(F.array(F.lit(0)), bounds), F.concat(bounds, F.array(F.char_length(text).cast("int"))), "__pieces")
    # every second piece is a hit
    wrapped = F.zip_with("__pieces", F.flatten(F.transform("__h", lambda h: F.array(F.lit(None).cast("string"), h["id"]))), lambda piece, id_: F.when(id_.isNull(), piece).otherwise(F.concat(F.lit(before), id_, F.lit(after), piece, F.lit(close))))
    return df.withColumn(text, F.when(F.col("__h").isNull(), F.col(text)).otherwise(F.array_join(wrapped, ""))).drop("__h", "__pieces")


def tag_surfaces(docs: DataFrame, table: DataFrame, skipped: list[str] = SCOPED_SKIP, wide_word: str = georgian.WIDE_WORD, tag: str = "w", attribute: str = "lemma") -> DataFrame:
    """(doc, text, tagged): words of documents wrapped by a surface map (text_id, surface, id[, tag]); the map's rows of a document are
    gathered beside it. A word is tried as it is, then without titlo. Elements of ``skipped`` and ornate initials are left alone."""
    import re

    pattern = re.compile(wide_word)
    skip = frozenset(skipped)

    def cuts(text: str | None, known: dict, root: ET.Element) -> tuple[str | None, list[ET.Element]]:
        lead, made, at = text, [], 0
        for m in pattern.finditer(text or ""):
            hit = known.get(m.group()) or known.get(m.group().replace("҃", ""))
            if hit:
                gap = text[at : m.start()]
                if made:
                    made[-1].tail = gap
                else:
                    lead = gap
                el = ET.Element(_local(hit[1] or tag, root), {"ref" if hit[1] else attribute: "#" + hit[0]})
                el.text, at = m.group(), m.end()
                made.append(el)
        if made:
            made[-1].tail = text[at:]
        return lead, made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs_, texts_, counts = [], [], []
            for doc, text, pairs in zip(*(b.column(k) for k in range(3)), strict=True):
                docs_.append(doc.as_py())
                old = text.as_py() or ""
                try:
                    lead, root, rest = _parsed(old)
                except (ET.ParseError, expat.ExpatError):
                    texts_.append(old)
                    counts.append(0)
                    continue
                if "}" in root.tag:
                    ET.register_namespace("", root.tag[1 : root.tag.index("}")])
                known, n, work = {p["surface"]: (p["id"], p["tag"]) for p in pairs.as_py() or []}, 0, [root]
                while work:
                    el = work.pop()
                    name = el.tag.rsplit("}", 1)[-1] if isinstance(el.tag, str) else "#"
                    if name in skip or name == "#" or (name == "hi" and el.get("rend") == "initial"):
                        continue
                    children = list(el)
                    el.text, new = cuts(el.text, known, root)
                    for c in children:
                        c.tail, after = cuts(c.tail, known, root)
                        new += [c, *after]
                    if len(new) > len(children):
                        n += len(new) - len(children)
                        el[:] = new
                    work += children
                texts_.append(lead + _written(root) + rest if n else old)
                counts.append(n)
            yield pa.record_batch([pa.array(docs_, pa.string()), pa.array(texts_, pa.string()), pa.array(counts, pa.int32())], ["doc", "text", "tagged"])

    kind = F.col("tag") if "tag" in table.columns else F.lit(None).cast("string")
    beside = table.groupBy(F.col("text_id").alias("doc")).agg(F.collect_list(F.struct("surface", "id", kind.alias("tag"))).alias("pairs"))
    both = docs.select(F.col("doc").cast("string"), "text").join(beside, "doc", "left")
    return both.mapInArrow(run, "doc string, text string, tagged int")
