"""Documents checked against a RELAX NG grammar in XML syntax: content, text and attributes of every element, first errors of each file.

An element's content model becomes a deterministic automaton by derivatives (what may follow after a child has been read), made
on the driver from the grammar alone. The automata are a small table, a row a tag, that meets the node table by a broadcast bounded by
the grammar; every element's children are run through theirs by a fold inside the row. Patterns of one tag are alternatives of
each other, wherever in the grammar they stand.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A pattern is a tuple: NONE matches nothing, EMPTY no child; ("tag", t), ("seq", a, b), ("mix", a, b) in any order, ("many", a), ("or", frozenset).
NONE, EMPTY = ("none",), ("empty",)


def seq(a: tuple, b: tuple) -> tuple:
    return NONE if NONE in (a, b) else b if a == EMPTY else a if b == EMPTY else ("seq", a, b)


def mix(a: tuple, b: tuple) -> tuple:
    return NONE if NONE in (a, b) else b if a == EMPTY else a if b == EMPTY else ("mix", *sorted((a, b), key=repr))


def either(*some: tuple) -> tuple:
    flat = frozenset(x for p in some for x in (p[1] if p[0] == "or" else [p]) if x != NONE)
    return NONE if not flat else next(iter(flat)) if len(flat) == 1 else ("or", flat)


def many(a: tuple) -> tuple:
    return EMPTY if a in (NONE, EMPTY) else a if a[0] == "many" else ("many", a)


def ends(p: tuple) -> bool:
    """May the pattern end here?"""
    kind = p[0]
    if kind in ("seq", "mix"):
        return ends(p[1]) and ends(p[2])
    return kind in ("empty", "many") or (kind == "or" and any(map(ends, p[1])))


def after(p: tuple, tag: str) -> tuple:
    """What may follow in ``p`` after a child ``tag``."""
    kind = p[0]
    if kind == "tag":
        return EMPTY if p[1] == tag else NONE
    if kind == "seq":
        first = seq(after(p[1], tag), p[2])
        return either(first, after(p[2], tag)) if ends(p[1]) else first
    if kind == "mix":
        return either(mix(after(p[1], tag), p[2]), mix(p[1], after(p[2], tag)))
    if kind == "many":
        return seq(after(p[1], tag), p)
    return either(*[after(x, tag) for x in p[1]]) if kind == "or" else NONE


def tags_of(p: tuple) -> set[str]:
    return {p[1]} if p[0] == "tag" else set().union(*map(tags_of, p[1] if p[0] == "or" else [x for x in p[1:] if isinstance(x, tuple)]))


class Model(NamedTuple):
    """An element's content, whether it may hold text, and its attributes: (required, allowed values or None for any)."""

    content: tuple
    text: bool
    attributes: dict[str, tuple[bool, tuple[str, ...] | None]]


class Grammar(NamedTuple):
    roots: list[str]
    models: dict[str, Model]


def _local(el: ET.Element) -> str:
    return el.tag.rsplit("}", 1)[-1]


def read_grammar(text: str) -> Grammar:
    """A grammar of named elements from its XML text: group, choice, interleave, optional, zeroOrMore, oneOrMore, mixed, text, data,
    value, list, attribute, ref, empty and notAllowed. Names of attributes are spelt as in node tables."""
    root = ET.fromstring(text)
    defines: dict[str, list[ET.Element]] = {}
    for d in root.iter():
        if _local(d) == "define":
            defines.setdefault(d.get("name", ""), []).extend(d)
    models: dict[str, Model] = {}

    def group(els: list[ET.Element], sure: bool) -> Model:
        return reduce(lambda a, b: Model(seq(a.content, b.content), a.text or b.text, _both(a.attributes, b.attributes)), [pattern(e, sure) for e in els], Model(EMPTY, False, {}))

    def pattern(el: ET.Element, sure: bool) -> Model:
        """``sure``: does what stands here stand in every instance?"""
        kind, below = _local(el), list(el)
        if kind == "element":
            return Model(("tag", el.get("name", "").split(":")[-1]), False, {})
        if kind == "ref":
            return group(defines.get(el.get("name", ""), []), sure)
        if kind == "attribute":
            values = tuple(v.text or "" for v in el.iter() if _local(v) == "value")
            free = any(_local(v) in ("text", "data", "list") for v in el.iter())
            return Model(EMPTY, False, {el.get("name", "").replace(":", "_"): (sure, values if values and not free else None)})
        if kind in ("text", "data", "value", "list"):
            return Model(EMPTY, True, {})
        if kind == "notAllowed":
            return Model(NONE, False, {})
        if kind == "choice":
            parts = [pattern(e, False) for e in below]
            return Model(either(*[p.content for p in parts]), any(p.text for p in parts), reduce(_both, [p.attributes for p in parts], {}))
        if kind == "interleave":
            parts = [pattern(e, sure) for e in below]
            return Model(reduce(mix, [p.content for p in parts], EMPTY), any(p.text for p in parts), reduce(_both, [p.attributes for p in parts], {}))
        one = group(below, sure and kind in ("group", "mixed", "oneOrMore"))
        content = {"optional": lambda c: either(c, EMPTY), "zeroOrMore": many, "oneOrMore": lambda c: seq(c, many(c))}.get(kind, lambda c: c)(one.content)
        return Model(content, one.text or kind == "mixed", one.attributes)

    for el in root.iter():
        if _local(el) == "element" and el.get("name"):
            name, new = el.get("name", "").split(":")[-1], group(list(el), True)
            old = models.get(name)
            if old:
                shared = {k: (v[0] and new.attributes.get(k, (False,))[0], v[1]) for k, v in old.attributes.items()}
                new = Model(either(old.content, new.content), old.text or new.text, _both({k: (False, v[1]) for k, v in new.attributes.items() if k not in shared}, shared))
            models[name] = new
    start = [e for s in root.iter() if _local(s) == "start" for e in s] or ([root] if _local(root) == "element" else [])
    return Grammar(sorted(tags_of(either(*[pattern(e, True).content for e in start]))), models)


def _both(a: dict, b: dict) -> dict:
    """Attributes of two patterns: an attribute of both is required if either says so, values add up."""
    out = dict(a)
    for k, (sure, values) in b.items():
        had = out.get(k)
        out[k] = (sure, values) if had is None else (sure or had[0], None if None in (values, had[1]) else tuple(dict.fromkeys(had[1] + values)))
    return out


def automaton(content: tuple, symbols: list[str]) -> tuple[list[int], list[bool]]:
    """(next state by state and symbol in a row, -1 where nothing may follow; which states may end), state 0 first."""
    states, table, accept = {content: 0}, [], []
    todo = [content]
    while todo:
        p = todo.pop(0)
        accept.append(ends(p))
        here = tags_of(p)
        for s in symbols:
            to = after(p, s) if s in here else NONE
            if to != NONE and to not in states:
                states[to] = len(states)
                todo.append(to)
            table.append(states.get(to, -1))
    return table, accept


def _tables(spark: SparkSession, g: Grammar) -> tuple[DataFrame, list[str]]:
    symbols = sorted({t for m in g.models.values() for t in tags_of(m.content)})
    rows = []
    for tag, m in g.models.items():
        table, accept = automaton(m.content, symbols)
        closed = {k: list(v) for k, (_, v) in m.attributes.items() if v is not None}
        rows.append((tag, table, accept, m.text, sorted(k for k, (sure, _) in m.attributes.items() if sure), sorted(m.attributes), closed))
    return spark.createDataFrame(rows, "tag string, table array<int>, accept array<boolean>, may_text boolean, required array<string>, allowed array<string>, closed map<string,array<string>>"), symbols


def errors(nodes: DataFrame, g: Grammar) -> DataFrame:
    """(doc, node, kind, error): what in a node table the grammar doesn't allow. Of an element's children the first that can't stand
    where it does is reported, and nothing else about their order; an element that the grammar doesn't know isn't looked into, elements in it that it knows are.

    Kinds, in the order in which a node's are listed: 0 a missing attribute, 1 one that isn't allowed, 2 a wrong value, 3 text,
    4 content that isn't complete, 5 an element that isn't allowed where it stands.
    """
    models, symbols = _tables(nodes.sparkSession, g)
    ink = lambda c: F.trim(F.translate(F.coalesce(c, F.lit("")), "\n\t\r", "   ")) != ""
    number = F.coalesce(F.array_position(F.array(*map(F.lit, symbols)), F.col("tag")), F.lit(0)).cast("int") - 1
    # nodes are shuffled by doc once; each stands for itself and as a child of its parent
    lean = nodes.select("doc", "node", "parent", "tag", "attrs", ink(F.col("text")).alias("inked"), ink(F.col("tail")).alias("tailed"), number.alias("symbol")).repartition("doc")
    own = F.struct("parent", "tag", "attrs", "inked")
    kid = F.struct("node", "tag", "symbol")
    two = F.array(F.struct(F.col("node").alias("at"), own.alias("own"), F.when(F.lit(False), kid).alias("kid"), F.lit(False).alias("tailed")), F.struct(F.col("parent").alias("at"), F.when(F.lit(False), own).alias("own"), kid.alias("kid"), F.col("tailed")))
    rows = lean.select("doc", F.inline(two)).filter("at >= 0").groupBy("doc", "at").agg(F.first("own", ignorenulls=True).alias("own"), F.array_sort(F.collect_list("kid")).alias("kids"), F.max("tailed").alias("tails"))
    rows = rows.select("doc", F.col("at").alias("node"), "own.*", "kids", "tails").join(F.broadcast(models), "tag", "left")  # a row a tag of the grammar
    width = len(symbols)
    step = f"if(a.bad is not null, a, if(c.symbol < 0 or get(table, a.at * {width} + c.symbol) < 0, struct(a.at as at, struct(c.node as node, c.tag as tag) as bad), struct(get(table, a.at * {width} + c.symbol) as at, cast(null as struct<node:int,tag:string>) as bad)))"
    run = F.expr(f"aggregate(kids, struct(0 as at, cast(null as struct<node:int,tag:string>) as bad), (a, c) -> {step})")
    rows = rows.withColumn("run", run)
    one = lambda kind, error, node=F.col("node"): F.struct(node.alias("node"), F.lit(kind).alias("kind"), F.concat("tag", F.lit(": "), error).alias("error"))
    named = lambda names, kind, says: F.transform(names, lambda k: one(kind, F.concat(F.lit("attribute "), k, F.lit(says))))
    given = F.map_keys("attrs")
    wrong = F.filter(F.map_keys("closed"), lambda k: F.element_at("attrs", k).isNotNull() & ~F.array_contains(F.element_at("closed", k), F.element_at("attrs", k)))
    whole = F.array(
        F.when(~F.col("may_text") & (F.col("inked") | F.col("tails")), one(3, F.lit("text not allowed"))),
        F.when(F.col("run.bad").isNull() & ~F.get("accept", F.col("run.at")), one(4, F.lit("content incomplete"))),
        F.when(F.col("run.bad").isNotNull(), one(5, F.concat("run.bad.tag", F.lit(" not allowed here")), F.col("run.bad.node"))),
    )
    every = F.concat(
        named(F.filter("required", lambda k: F.element_at("attrs", k).isNull()), 0, " missing"), named(F.filter(given, lambda k: ~F.array_contains("allowed", k)), 1, " not allowed"),
        named(wrong, 2, " has a wrong value"), F.array_compact(whole),
    )
    strange = (F.col("parent") < 0) & ~F.col("tag").isin(g.roots)
    root = F.array_compact(F.array(F.when(strange, F.struct("node", F.lit(5).alias("kind"), F.concat("tag", F.lit(" not allowed as the root")).alias("error")))))
    return rows.select("doc", F.inline(F.when(F.col("table").isNull(), root).otherwise(F.concat(every, root))))


def first_errors(nodes: DataFrame, g: Grammar, most: int = 5) -> DataFrame:
    """(doc, nth, error, errors): the first ``most`` errors of every document that has any, in document order, and how many it has."""
    found = errors(nodes, g)
    nth = F.row_number().over(Window.partitionBy("doc").orderBy("node", "kind", "error"))
    total = F.count("*").over(Window.partitionBy("doc"))
    return found.withColumns({"nth": nth, "errors": total}).filter(F.col("nth") <= most).select("doc", "nth", "error", "errors")
