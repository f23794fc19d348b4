"""Column functions on strings, dates and references. Missing values are nulls; empty strings count as missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)\s+"


def given(c: Column) -> Column:
    """Null for an empty string."""
    return F.when(c != "", c)


def first_given(*columns: Column) -> Column:
    """The first that is neither null nor empty (fallback chains, language fallback)."""
    return F.coalesce(*map(given, columns))


def squeezed(c: Column) -> Column:
    """White space runs as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE, " "))


def primary_source(source: Column) -> Column:
    """What precedes the first ``+`` or ``|``."""
    return F.trim(F.regexp_extract(source, r"^[^+|]*", 0))


def labelled(c: Column, table: dict[str, str], default: Column | str | None = None) -> Column:
    """A value's label; what has none keeps the value, or takes ``default``."""
    other = c if default is None else F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), c), other) if table else other


def distinct_parts(c: Column, sep: str, joined: str, trim: bool = True) -> Column:
    """A delimited list without empty and repeated parts, first occurrences in order."""
    parts = F.split(c, "\\" + sep)
    parts = F.transform(parts, lambda x: F.trim(x)) if trim else parts
    return F.array_join(F.array_distinct(F.filter(parts, lambda x: x != "")), joined)


def shortened(c: Column, n: int, mark: str = "") -> Column:
    """The first ``n`` characters and ``mark``, which is always there."""
    return F.concat(F.left(c, F.lit(n)), F.lit(mark))


def first_words(c: Column, n: int, mark: str = "") -> Column:
    """The first ``n`` words; ``mark`` if there are more; fewer words stay as they are."""
    words = F.filter(F.split(c, SPACE), lambda x: x != "")
    return F.when(F.size(words) > n, F.concat(F.array_join(F.slice(words, 1, n), " "), F.lit(mark))).when(F.size(words) == n, F.array_join(words, " ")).otherwise(c)


def recurring_day(c: Column, months: dict[str, str], moveable: str = "") -> Column:
    """``--MM-DD`` as day and month name; ``moveable`` for that word; else empty."""
    month = F.regexp_extract(c, r"^--+(\d+)-(\d+)", 1)
    day = F.regexp_extract(c, r"^--+(\d+)-(\d+)", 2).try_cast("int").cast("string")
    shown = F.concat_ws(" ", day, labelled(month, months))
    return F.when(month != "", shown).when(c == "moveable", moveable).otherwise("")


def recurring_month(c: Column) -> Column:
    """The month number of ``--MM-DD``, else null."""
    return given(F.regexp_extract(c, r"^--+(\d+)-(\d+)", 1)).try_cast("int")


def season_rank(month: Column, moveable: Column, first: int = 9) -> Column:
    """struct to order days of a year that starts in ``first``: dated ones, moveable ones, the rest."""
    return F.when(month.isNotNull(), F.struct(F.lit(0).alias("kind"), F.pmod(month - first, F.lit(12)).alias("at"))).otherwise(
        F.struct(F.when(moveable, 1).otherwise(2).alias("kind"), F.lit(0).alias("at"))
    )


def life_dates(birth: Column, death: Column, has_both: Column, nb: Column, na: Column) -> Column:
    """``birth–death`` without leading zeros where both are recorded, else ``c. nb–na``, else empty."""
    bare = lambda c: F.ltrim(F.coalesce(c, F.lit("")), F.lit("0"))
    about = F.when((bare(nb) != "") & (bare(na) != ""), F.concat(F.lit("c. "), bare(nb), F.lit("–"), bare(na))).otherwise("")
    return F.when(has_both, F.concat(bare(birth), F.lit("–"), bare(death))).otherwise(about)


def witness_date(when: Column, nb: Column, na: Column) -> Column:
    """``when``, else ``nb–na`` if both are there, else empty."""
    return F.coalesce(given(when), F.when((F.coalesce(nb, F.lit("")) != "") & (F.coalesce(na, F.lit("")) != ""), F.concat(nb, F.lit("–"), na)), F.lit(""))


def imprint_date(when: Column, nb: Column, na: Column) -> Column:
    """``when``, else what is known of ``nb–na``; the element's text never counts."""
    return F.coalesce(given(when), F.regexp_replace(F.concat(F.coalesce(nb, F.lit("")), F.lit("–"), F.coalesce(na, F.lit(""))), "^–+|–+$", ""))


def leaf_span(a: Column, b: Column, text: Column) -> Column:
    """``ff. a-b`` if both ends are known, else the text."""
    both = (F.coalesce(a, F.lit("")) != "") & (F.coalesce(b, F.lit("")) != "")
    return F.when(both, F.concat(F.lit("ff. "), a, F.lit("-"), b)).otherwise(F.trim(F.coalesce(text, F.lit(""))))


def page_line_refs(ranges: Column) -> Column:
    """array of struct(unit, value) as ``page, line; page, line``: a page starts a new group."""
    start = F.struct(F.lit("").alias("done"), F.lit("").alias("cur"), F.lit(False).alias("open"))

    def step(acc: Column, r: Column) -> Column:
        new = (r["unit"] == "page") & acc["open"]
        joined = F.when(acc["done"] == "", acc["cur"]).otherwise(F.concat(acc["done"], F.lit("; "), acc["cur"]))
        return F.struct(
            F.when(new, joined).otherwise(acc["done"]).alias("done"),
            F.when(new | ~acc["open"], r["value"]).otherwise(F.concat(acc["cur"], F.lit(", "), r["value"])).alias("cur"),
            F.lit(True).alias("open"),
        )

    end = lambda acc: F.when(~acc["open"], "").when(acc["done"] == "", acc["cur"]).otherwise(F.concat(acc["done"], F.lit("; "), acc["cur"]))
    return F.aggregate(ranges, start, step, end)


def html_escaped(c: Column, apostrophe: bool = False) -> Column:
    """``&``, ``<``, ``>``, ``"`` (and ``'``) as entities."""
    for a, b in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")] + [("'", "&#x27;")] * apostrophe:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def without_hashes(c: Column) -> Column:
    """A reference without any leading ``#``."""
    return F.ltrim(c, F.lit("#"))


def local_target(c: Column) -> Column:
    """The id of a ``#id`` reference, null for other references; one ``#`` is cut."""
    return F.when(F.startswith(c, F.lit("#")), F.substring(c, 2, 1 << 30))


def leading_numbers(c: Column) -> Column:
    """The first whole number of each ``;`` group."""
    return F.transform(F.filter(F.transform(F.split(c, ";"), lambda g: F.regexp_extract(g, r"(\d+)", 1)), lambda x: x != ""), lambda x: x.cast("int"))


def shown_number(n: Column, ident: Column) -> Column:
    """A paragraph's number: its own, else its id without leading letters p."""
    return F.coalesce(n, F.ltrim(ident, F.lit("p")))


def author_shown(surname: Column, forename: Column, org: Column) -> Column:
    """The organisation, else surname and forename."""
    return F.coalesce(given(org), F.concat_ws(", ", given(surname), given(forename)))


def percent(part: Column, whole: Column) -> Column:
    """Percentage with one decimal, halves of the binary value to even; null if there is no whole."""
    return F.replace(F.format_number(F.try_divide(part, whole) * 100, 1), F.lit(","), F.lit(""))


def anchor(target: Column, inner: Column) -> Column:
    """Link of a reference: none without text, the text without a target, external and internal links by target."""
    safe = html_escaped(inner)
    href = html_escaped(target)
    out = F.concat(F.lit('<a href="'), href, F.lit('" class="ext-link" target="_blank" rel="noopener noreferrer">'), safe, F.lit("</a>"))
    own = F.concat(F.lit('<a href="'), href, F.lit('" class="bib-ref">'), safe, F.lit("</a>"))
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    return F.when(empty(inner), "").when(empty(target), safe).when(target.rlike("^https?://"), out).otherwise(own)


def qualified_hrefs(html: Column, pages: Column, prefix: str = "lex-", suffix: str = ".html") -> Column:
    """``href="#lex-…"`` led to its page where the map ``pages`` knows the id; other links stay."""
    link = rf'href="#({prefix}[^"]*)"'
    found = F.regexp_extract_all(html, F.lit(link), F.lit(1))
    between = F.split(html, link, -1)
    made = F.transform(found, lambda i: F.coalesce(F.concat(F.lit('href="'), F.element_at(pages, i), F.lit(suffix + "#"), i, F.lit('"')), F.concat(F.lit('href="#'), i, F.lit('"'))))
    return F.array_join(F.zip_with(between, made, lambda s, m: F.concat(s, F.coalesce(m, F.lit("")))), "")


def url_encoded(c: Column) -> Column:
    """Percent-encoded with blanks as ``%20``; slashes stay."""
    return F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))
