"""Content models as automata, against regular expressions; errors of small documents, traced by hand."""

from __future__ import annotations

import itertools
import random
import re

import pytest

from loomtext.operators import grammar as G
from loomtext.plans.trees import RNG
from loomtext.sources import markup


def drawn(r: random.Random, depth: int) -> tuple[tuple, str]:
    """A pattern and the regular expression of the same words."""
    kind = r.choice(["tag", "tag", "seq", "or", "many", "opt"]) if depth else "tag"
    if kind == "tag":
        t = r.choice("abc")
        return ("tag", t), t
    p, x = drawn(r, depth - 1)
    if kind == "many":
        return G.many(p), f"(?:{x})*"
    if kind == "opt":
        return G.either(p, G.EMPTY), f"(?:{x})?"
    q, y = drawn(r, depth - 1)
    return (G.seq(p, q), f"(?:{x})(?:{y})") if kind == "seq" else (G.either(p, q), f"(?:{x}|{y})")


@pytest.mark.parametrize("seed", range(40))
def test_automata_accept_what_the_expression_does(seed):
    pattern, expression = drawn(random.Random(seed), 4)
    table, accept = G.automaton(pattern, list("abc"))
    for n in range(6):
        for word in itertools.product("abc", repeat=n):
            at = 0
            for s in word:
                at = table[at * 3 + "abc".index(s)] if at >= 0 else -1
            assert (at >= 0 and accept[at]) == bool(re.fullmatch(expression, "".join(word)))


def test_interleaved_patterns_come_in_any_order():
    table, accept = G.automaton(G.mix(("tag", "a"), G.mix(G.seq(("tag", "b"), ("tag", "b")), G.many(("tag", "c")))), list("abc"))

    def accepts(word):
        at = 0
        for s in word:
            at = table[at * 3 + "abc".index(s)] if at >= 0 else -1
        return at >= 0 and accept[at]

    for n in range(6):
        for word in itertools.product("abc", repeat=n):
            assert accepts(word) == (word.count("a") == 1 and word.count("b") == 2)


def test_grammar_is_read():
    g = G.read_grammar(RNG)
    assert g.roots == ["TEI"] and g.models["app"].attributes == {"n": (True, None), "type": (False, ("lexical", "addition"))}
    assert g.models["rdg"].text and not g.models["app"].text and g.models["list"].content == G.EMPTY
    two = '<grammar><start><element name="a"><choice><element name="b"><attribute name="x"/><text/></element><group><attribute name="xml:id"/><element name="b"><attribute name="y"/></element></group></choice></element></start></grammar>'
    g = G.read_grammar(two)
    assert g.roots == ["a"] and g.models["b"].text and g.models["b"].attributes == {"x": (False, None), "y": (False, None)} and g.models["a"].attributes == {"xml_id": (False, None)}
    loop = '<grammar><start><ref name="s"/></start><define name="s"><element name="s"><zeroOrMore><ref name="s"/></zeroOrMore></element></define></grammar>'
    assert G.read_grammar(loop).models["s"].content == ("many", ("tag", "s"))


def test_errors_of_documents(spark):
    body = lambda x: f"<TEI><text><body>{x}</body></text></TEI>"
    docs = [
        ("good", body('<app n="1"><lem>a</lem><rdg>x<hi>y</hi>z</rdg><note/></app>\n<p><list/><hi/></p>')), ("root", "<p><list/></p>"), ("deep", body("<app n='1'><rdg><note>no</note></rdg><what><p/></what><rdg/></app>")),
        ("late", body('<p>\n<list> t </list></p><p><hi/></p><p><list/><list/></p>')), ("many", body("<app/>" * 4)), ("tail", body('<app n="" type=""><rdg/>tail</app>')), ("broken", "<TEI>"), ("null", None), ("other", "<x><y/></x>"),
    ]
    g = G.read_grammar(RNG)
    found = G.first_errors(markup.node_table(spark.createDataFrame(docs, "doc string, text string")), g)
    got: dict[str, list] = {}
    for r in found.orderBy("doc", "nth").collect():
        got.setdefault(r.doc, []).append(r.error)
        assert r.errors == {"many": 8}.get(r.doc, r.errors)
    assert got == {
        "root": ["p not allowed as the root"], "other": ["x not allowed as the root"], "deep": ["rdg: note not allowed here", "app: what not allowed here", "p: content incomplete"],
        "late": ["list: text not allowed", "p: content incomplete", "p: list not allowed here"], "tail": ["app: attribute type has a wrong value", "app: text not allowed"],
        "many": ["app: attribute n missing", "app: content incomplete", "app: attribute n missing", "app: content incomplete", "app: attribute n missing"],
    }
    assert not G.first_errors(markup.node_table(spark.createDataFrame([], "doc string, text string")), g).count()


def test_documents_are_parsed_once(spark):
    nodes = markup.node_table(spark.createDataFrame([("d", "<odd><TEI/></odd>")], "doc string, text string"))
    found = G.first_errors(nodes, G.read_grammar(RNG))
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert [(r.nth, r.error, r.errors) for r in found.orderBy("nth").collect()] == [(1, "odd not allowed as the root", 2), (2, "TEI: content incomplete", 2)]
