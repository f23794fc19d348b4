"""Marked-up documents as node tables and as extracted rows.

A document is one row (path, text). Ordered mixed content can't be kept by column-wise XML readers, so
one Arrow pass parses each document and emits either its nodes in document order or the rows of one
element with declared fields. Namespaces are dropped; ``xml:id`` becomes attribute ``xml_id``.
Comments and processing instructions are not nodes. A document that doesn't parse gives no row.
"""

from __future__ import annotations

import functools
import html.parser
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NODES = "doc string, root_id string, node int, parent int, depth int, last int, tag string, attrs map<string,string>, text string, tail string, path array<string>"
_NODE_TYPES = pa.schema(
    [("doc", pa.string()), ("root_id", pa.string()), ("node", pa.int32()), ("parent", pa.int32()), ("depth", pa.int32()), ("last", pa.int32()), ("tag", pa.string()),
     ("attrs", pa.map_(pa.string(), pa.string())), ("text", pa.string()), ("tail", pa.string()), ("path", pa.list_(pa.string()))]
)
#: A batch of rows is handed on when its documents have more characters, or it has more rows, than these.
BATCH_CHARS, BATCH_ROWS = 2_000_000, 10_000
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def read_documents(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """(path, doc, text): whole files below ``path``; doc is the file name without its extension."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True)
    where = F.input_file_name()
    return files.select(where.alias("path"), F.regexp_extract(where, r"([^/]+?)(?:\.[^./]*)?$", 1).alias("doc"), F.col("value").alias("text"))


def parse_xml(text: str) -> ET.Element | None:
    """The root with bare tag names; None if the text isn't well-formed."""
    try:
        root = ET.fromstring(text.encode("utf-8", "surrogatepass"))
    except (ET.ParseError, ValueError):
        return None
    bare = lambda n: n.replace("{http://www.w3.org/XML/1998/namespace}", "xml_").rsplit("}", 1)[-1]
    for el in root.iter():
        el.tag = bare(el.tag)
        for name in [n for n in el.attrib if "{" in n]:
            el.attrib[bare(name)] = el.attrib.pop(name)
    return root


class _Html(html.parser.HTMLParser):
    """Builds a tree of what is there: void elements close at once, an end tag closes up to its nearest open start tag."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = ET.Element("#document")
        self.open = [self.root]
        self.last: ET.Element | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        el = ET.SubElement(self.open[-1], tag, {k: v or "" for k, v in attrs})
        self.last = el if tag in VOID else None
        if tag not in VOID:
            self.open.append(el)

    def handle_endtag(self, tag: str) -> None:
        at = next((k for k in range(len(self.open) - 1, 0, -1) if self.open[k].tag == tag), 0)
        if at:
            self.last = self.open[at]
            del self.open[at:]

    def handle_data(self, data: str) -> None:
        if self.last is not None:
            self.last.tail = (self.last.tail or "") + data
        else:
            self.open[-1].text = (self.open[-1].text or "") + data


def parse_html(text: str) -> ET.Element:
    """A tree of an HTML page, however ill-formed."""
    p = _Html()
    p.feed(text)
    p.close()
    return p.root


def walk(root: ET.Element) -> Iterator[tuple[ET.Element, int, int, tuple[str, ...]]]:
    """(element, its parent's number or -1, depth, tags from the root to it) in document order, without recursion."""
    stack, number = [(root, -1, ())], 0
    while stack:
        el, parent, above = stack.pop()
        path = (*above, el.tag)
        yield el, parent, len(above), path
        stack += [(c, number, path) for c in reversed(el) if isinstance(c.tag, str)]
        number += 1


def node_rows(doc: str, root: ET.Element) -> list[tuple]:
    rows = [[doc, root.get("xml_id"), k, p, d, k, el.tag, list(el.attrib.items()), el.text, el.tail if d else None, list(path)] for k, (el, p, d, path) in enumerate(walk(root))]
    for r in reversed(rows):
        if r[3] >= 0:
            rows[r[3]][5] = max(rows[r[3]][5], r[5])
    return rows


def node_table(docs: DataFrame, html_pages: bool = False) -> DataFrame:
    """One row per element of ``docs`` (doc, text): its number in document order, its parent's, the number of its last
    descendant, depth, tag, attributes, own text, tail, and the tags from the root to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc, text in zip(b.column(0), b.column(1), strict=True):
                t = text.as_py() or ""
                root = parse_html(t) if html_pages else parse_xml(t)
                rows = node_rows(doc.as_py(), root) if root is not None else []
                for at in range(0, len(rows), 50_000):
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows[at : at + 50_000], strict=True), _NODE_TYPES, strict=True)], schema=_NODE_TYPES)

    return docs.select(F.col("doc").cast("string"), "text").mapInArrow(run, NODES)


def well_formed(docs: DataFrame) -> DataFrame:
    """(doc, ok) for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([parse_xml(t.as_py() or "") is not None for t in b.column(1)])], ["doc", "ok"])

    return docs.select(F.col("doc").cast("string"), "text").mapInArrow(run, "doc string, ok boolean")


def batched(docs: pa.RecordBatch, rows: Callable[[str, ET.Element], Iterable[tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The ``rows`` of the parsed documents of a batch (doc, text), those of many small documents in one batch; documents that don't parse have none."""
    some, size = [], 0
    for doc, text in zip(docs.column(0), docs.column(1), strict=True):
        t = text.as_py() or ""
        root = parse_xml(t)
        if root is None:
            continue
        before = len(some)
        some += rows(doc.as_py(), root)
        size += len(t) if len(some) > before else 0
        if size > BATCH_CHARS or len(some) > BATCH_ROWS:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)
            some, size = [], 0
    if some:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)


def nodes_below(docs: DataFrame, top: str, full: dict[str, str | None], above: dict[str, tuple[str, ...]]) -> DataFrame:
    """The rows of ``node_table`` of the elements ``top`` and what is below them, without root_id and path, with ``full``, the text below the elements of the tags of ``full``, or of the
    first child that is named there, and a flag for each of ``above``: is the node below an element of one of these tags? Nothing is shuffled."""
    flags = {name: frozenset(tags) for name, tags in above.items()}
    schema = pa.schema([_NODE_TYPES.field(n) for n in ("doc", "node", "parent", "depth", "last", "tag", "attrs", "text", "tail")] + [("full", pa.string()), *((n, pa.bool_()) for n in flags)])

    def said(el: ET.Element) -> str | None:
        if el.tag not in full:
            return None
        of = el if full[el.tag] is None else el.find(full[el.tag])
        return None if of is None else "".join(of.itertext())

    def rows(doc: str, root: ET.Element) -> list[tuple]:
        last, flat = [], []
        for k, (el, parent, depth, path) in enumerate(walk(root)):
            last.append(k)
            flat.append((el, parent, depth, path))
        for k in range(len(flat) - 1, 0, -1):
            last[flat[k][1]] = max(last[flat[k][1]], last[k])
        hold: dict[tuple, tuple] = {}  # paths repeat
        out = []
        for k, (el, parent, depth, path) in enumerate(flat):
            if path not in hold:
                hold[path] = (top in path, *(not tags.isdisjoint(path[:-1]) for tags in flags.values()))
            inside, *marks = hold[path]
            if inside:
                out.append((doc, k, parent, depth, last[k], el.tag, [*el.attrib.items()], el.text, el.tail if depth else None, said(el), *marks))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from batched(b, rows, schema)

    kinds = "doc string, node int, parent int, depth int, last int, tag string, attrs map<string,string>, text string, tail string, full string"
    return docs.select(F.col("doc").cast("string"), "text").mapInArrow(run, ", ".join([kinds, *(f"`{n}` boolean" for n in flags)]))


def _laid_out(nodes: DataFrame) -> DataFrame:
    """(doc, ns, strings, ends): each document's nodes in order, the strings of their texts and tails in reading order, and the two places of every node among them."""
    rest = [c for c in nodes.columns if c not in ("doc", "node")]
    one = nodes.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("node", *rest))).alias("ns"))  # a document's own nodes
    placed = F.expr(
        "array_sort(flatten(transform(ns, n -> array(struct(n.node as at, 0 as z, 0 as d, n.node as id, coalesce(n.text, '') as s), "
        "struct(n.last as at, 1 as z, -n.node as d, n.node as id, coalesce(n.tail, '') as s)))))"
    )
    return one.withColumn("ps", placed).withColumn("strings", F.col("ps.s")).withColumn("ends", F.expr("array_sort(transform(ps, (p, i) -> struct(p.id as id, p.z as z, i as i)))"))


def with_subtree_text(nodes: DataFrame, tags: list[str]) -> DataFrame:
    """``nodes`` with ``full``, the text below each node of ``tags`` as in ``subtree_text``, null for others. Nodes are shuffled by doc once and stay so, so
    that windows and groups by doc after it shuffle nothing. Columns that can't be ordered, maps but ``attrs``, are not taken."""
    kept = [c for c in nodes.columns if c != "doc"]
    one = _laid_out(nodes.withColumn("attrs", F.map_entries("attrs")) if "attrs" in kept else nodes)
    wanted = ", ".join(map(repr, tags))
    full = f"case when n.tag in ({wanted}) then array_join(slice(strings, ends[2 * j].i + 1, ends[2 * j + 1].i - ends[2 * j].i), '') end as full"
    rows = one.select("doc", F.inline(F.expr(f"transform(ns, (n, j) -> struct({', '.join(f'n.`{c}` as `{c}`' for c in kept)}, {full}))")))
    return rows.withColumn("attrs", F.map_from_entries("attrs")) if "attrs" in kept else rows


def subtree_text(nodes: DataFrame, tags: list[str] | None = None) -> DataFrame:
    """(doc, node, full): all text below each node (or each of ``tags``) in reading order, its own included, its tail not.

    A document's texts are laid out once, each node's text at its start and its tail after its last descendant; what is
    below a node is the stretch between its own two places.
    """
    one = _laid_out(nodes.select("doc", "node", "last", "tag", "text", "tail"))
    spans = "transform(ns, (n, j) -> struct(n.node as node, n.tag as tag, ends[2 * j].i as a, ends[2 * j + 1].i as b))"
    if tags is not None:
        spans = f"filter({spans}, x -> x.tag in ({', '.join(map(repr, tags))}))"
    out = one.withColumn("spans", F.expr(spans)).select("doc", F.explode(F.expr("transform(spans, x -> struct(x.node as node, array_join(slice(strings, x.a + 1, x.b - x.a), '') as full))")).alias("x"))
    return out.select("doc", "x.node", "x.full")


# --- Rows of one element with declared fields ---------------------------------------------------

Field = str | Callable[[ET.Element], object]
_STEP = re.compile(r"^(?P<up>\^)?(?P<path>.*?)(?P<what>@[\w:\-]+|\*|!|#)?(?P<many>\[\])?$")


def _own(el: ET.Element) -> str | None:
    return (el.text or "").strip() or None


def _value(el: ET.Element, what: str | None, numbers: dict, renderer: Callable | None) -> object:
    if not what:
        return _own(el)
    if what == "*":
        return "".join(el.itertext()).strip() or None
    if what == "#":
        return str(numbers[el])
    if what == "!":
        return renderer(el) if renderer else None
    return el.get(what[1:].replace(":", "_")) or None


@functools.cache
def _steps(spec: str) -> list[tuple]:
    """(up, path, what, many) of each alternative of a specification."""
    return [_STEP.match(one).group("up", "path", "what", "many") for one in spec.split(" | ")]


def take(el: ET.Element, spec: str, numbers: dict, parents: dict, renderer: Callable | None = None) -> object:
    """A field of an element by its specification: a path below it (``.`` itself, ``^tag`` the nearest such ancestor, with ``[]`` all of them from the nearest),
    then nothing for own text, ``@name`` an attribute, ``*`` all text, ``!`` rendered, ``#`` its number; ``[]`` for all
    matches. Alternatives are separated by `` | ``; the first that gives something counts."""
    for up, path, what, many in _steps(spec):
        if up:
            found, node = [], parents.get(el)
            while node is not None:
                if node.tag == path and (what is None or what in "*!#" or node.get(what[1:].replace(":", "_"))):
                    found.append(node)
                    if not many:
                        break
                node = parents.get(node)
        else:
            found = [el] if path in (".", "") else el.findall(path)
        values = [v for v in (_value(f, what, numbers, renderer) for f in (found if many else found[:1])) if v is not None]
        if many:
            if values:
                return values
        elif values:
            return values[0]
    return [] if spec.rstrip().endswith("[]") else None


def rows_of(docs: DataFrame, element: str, fields: dict[str, str], renderer: Callable | None = None) -> DataFrame:
    """(doc, ord, fields…): one row per ``element`` (a path below the root) of each of ``docs`` (doc, text), ord its number in the document."""
    names = list(fields)
    types = {n: pa.list_(pa.string()) if s.rstrip().endswith("[]") else pa.string() for n, s in fields.items()}
    schema = pa.schema([("doc", pa.string()), ("ord", pa.int32()), *types.items()])

    def rows(doc: str, root: ET.Element) -> Iterator[tuple]:
        found = [root] if element == "." else root.findall(element)
        if found:
            numbers = {el: k for k, (el, *_) in enumerate(walk(root))}
            parents = {c: p for p in numbers for c in p}
            for el in found:
                yield doc, numbers[el], *[take(el, fields[n], numbers, parents, renderer) for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from batched(b, rows, schema)

    kinds = ", ".join(f"`{n}` {'array<string>' if pa.types.is_list(t) else 'string'}" for n, t in types.items())
    # a document without one of the path's names has no such element, unless an entity holds it
    named = [t for t in re.split(r"/+", re.sub(r"\[[^\]]*\]", "", element)) if re.fullmatch(r"\w[\w\-]*", t)]
    for t in named:
        docs = docs.filter(F.contains("text", F.lit(t)) | F.contains("text", F.lit("<!ENTITY")))
    return docs.select(F.col("doc").cast("string"), "text").mapInArrow(run, f"doc string, ord int, {kinds}")
