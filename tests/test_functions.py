"""Values of the column functions, traced by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loomtext.functions import georgian as g
from loomtext.functions import strings as s


@pytest.fixture(scope="module")
def value(spark):
    one = spark.range(1)

    def get(column):
        x = one.select(column.alias("x")).first().x
        return x.asDict() if hasattr(x, "asDict") else x

    return get


def lit(x):
    return F.lit(x)


def test_spelling(value):
    assert [value(g.normalise(lit(w))) for w in ("წმიდაჲ", "იტყჳს", "ჴორცი")] == ["წმიდაი", "იტყვს", "ხორცი"]
    assert [value(g.later_script(lit(c))) for c in ("Ⴓ", "Ⴈ", "Ⴡ", "Ⴥ", "Ⴀ")] == ["უ", "ი", "ჯ", "ჵ", "ა"]
    assert value(g.initial_letter(lit(" Ⴘ"))) == "შ" and value(g.initial_letter(lit("x"))) == ""
    assert value(g.cleaned(lit("ა҃ბ-გ დ"))) == "აბგდ"
    assert value(g.scoped_norm(lit("ჱჲჳჴ"))) == "ეივჴ"
    assert value(g.untitled(lit("ა҃ ბ"))) == "ა ბ"


def test_case_endings(value):
    cases = {w: value(g.strip_case(lit(w))) for w in ("ღმრთის", "კაცს", "კაცად", "კაცით", "კაცო", "კაცი", "კაც")}
    assert cases["ღმრთის"] == {"stem": "ღმრთ", "case": "genitive"}
    assert [c["case"] for c in cases.values()] == ["genitive", "dative", "adverbial", "instrumental", "vocative", "nominative", "uninflected"]


def test_stem_classes(value):
    assert value(g.stem_class(lit("ანგელოზი"))) == {"stem": "ანგელოზ", "class": "consonant"}
    assert value(g.stem_class(lit("ქება"))) == {"stem": "ქება", "class": "vowel_a"}
    assert value(g.stem_class(lit("აბი"))) is None
    assert {c: len(x) for c, x in g.PARADIGMS.items()} == {"consonant": 14, "vowel_a": 14, "vowel_e": 12, "vowel_o": 7, "vowel_u": 9}


def test_stem_forms(value):
    forms = value(g.stem_forms(lit("პეტრე"), g.NAME_ENDINGS, 3))
    assert "პეტრე" in forms and "პეტრეს" in forms and len(forms) == len(set(forms))
    assert value(g.stem_forms(lit("აბ"), g.NAME_ENDINGS, 3)) == ["აბ"]
    assert "დავით" in value(g.stem_forms(lit("დავითი"), g.NAME_ENDINGS, 3))


def test_identifiers(value):
    assert value(g.roman_id(lit(" ღმერთი "))) == "lex-ghmerti"
    assert value(g.roman_id(lit("abc"))) == ""
    assert value(g.dashed_id(lit("lex.a_b.c"))) == "lex-a-b-c"
    assert value(g.letter_slug(lit("ჭირი"))) == "chw" and value(g.letter_slug(lit("x"))) == "a"
    assert value(g.cut_inflection(lit("აჩრდილ-ი"))) == "აჩრდილ"
    assert value(g.split_lemmas(lit("აბა, ჰაბა; "))) == ["აბა", "ჰაბა"]
    assert value(g.split_refs(lit("a | b||"))) == ["a", "b"] and value(g.split_refs(lit(None))) == []
    assert value(g.collation_key(lit("აბჱx"))) == [0, 1, 7, 999]


def test_lists_and_labels(value):
    assert value(s.distinct_parts(lit("a; b; a"), ";", "; ")) == "a; b"
    assert value(s.distinct_parts(lit("x1|y|x1||"), "|", "|")) == "x1|y"
    assert value(s.primary_source(lit("a+b|c"))) == "a"
    assert value(s.labelled(lit("k"), {"a": "b"})) == "k" and value(s.labelled(lit("k"), {"a": "b"}, "d")) == "d"
    assert value(s.first_given(lit(""), lit(None), lit("z"))) == "z"
    assert value(s.first_words(lit("a b c d e"), 4, "…")) == "a b c d…" and value(s.first_words(lit("a b"), 4, "…")) == "a b"
    assert value(s.shortened(lit("abc"), 2, "…")) == "ab…"


def test_dates(value):
    months = {"09": "September"}
    assert value(s.recurring_day(lit("--09-05"), months)) == "5 September"
    assert value(s.recurring_day(lit("moveable"), months, "m")) == "m" and value(s.recurring_day(lit("x"), months)) == ""
    rank = lambda n: tuple(value(s.season_rank(s.recurring_month(lit(n)), lit(n == "moveable"))).values())
    assert [rank(n) for n in ("--09-01", "--08-01", "moveable", "")] == [(0, 0), (0, 11), (1, 0), (2, 0)]
    assert value(s.imprint_date(lit(None), lit("1900"), lit(None))) == "1900"
    assert value(s.imprint_date(lit(None), lit(None), lit(None))) == ""
    assert value(s.witness_date(lit(""), lit("1"), lit("2"))) == "1–2" and value(s.witness_date(lit(None), lit("1"), lit(""))) == ""
    assert value(s.life_dates(lit("0330"), lit("0379"), lit(True), lit(""), lit(""))) == "330–379"
    assert value(s.life_dates(lit(None), lit(None), lit(False), lit("0400"), lit("0450"))) == "c. 400–450"
    assert value(s.leaf_span(lit("1r"), lit("2v"), lit("x"))) == "ff. 1r-2v" and value(s.leaf_span(lit("1r"), lit(None), lit(" x "))) == "x"


def test_references(value):
    ranges = F.array(*[F.struct(lit(u).alias("unit"), lit(v).alias("value")) for u, v in (("page", "140"), ("line", "17"), ("line", "19"), ("page", "150"), ("line", "2"))])
    assert value(s.page_line_refs(ranges)) == "140, 17, 19; 150, 2"
    assert value(s.leading_numbers(lit("p. 12, 3; 45; x"))) == [12, 45]
    assert value(s.without_hashes(lit("##a"))) == "a" and value(s.local_target(lit("##a"))) == "#a" and value(s.local_target(lit("a"))) is None
    assert value(s.shown_number(lit(None), lit("pp12"))) == "12"
    assert value(s.author_shown(lit("A"), lit("B"), lit(None))) == "A, B" and value(s.author_shown(lit("A"), lit(""), lit("O"))) == "O"
    assert value(s.anchor(lit("https://x/?a=1&b"), lit("<t>"))).startswith('<a href="https://x/?a=1&amp;b" class="ext-link"')
    assert value(s.anchor(lit("#a"), lit("t"))) == '<a href="#a" class="bib-ref">t</a>' and value(s.anchor(lit("#a"), lit(""))) == ""
    pages = F.create_map(lit("lex-a"), lit("b"))
    assert value(s.qualified_hrefs(lit('<a href="#lex-a">x</a><a href="#lex-z">y</a>'), pages)) == '<a href="b.html#lex-a">x</a><a href="#lex-z">y</a>'
    assert value(s.html_escaped(lit("<&\"'>"), True)) == "&lt;&amp;&quot;&#x27;&gt;"
    assert value(s.url_encoded(lit("a b/ć"))) == "a%20b/%C4%87"


def test_percent_rounds_half_to_even(value):
    assert value(s.percent(lit(49), lit(54))) == "90.7" and value(s.percent(lit(1), lit(400))) == "0.2" and value(s.percent(lit(1), lit(0))) is None
