"""HTML of text bodies, lexicon definitions and articles: one row in, one page or fragment out.

A renderer is a table of rules: tag -> a function that gets the element, its rendered content and the page's
state. What has no rule is passed through. State holds running numbers and what a page gathers on
the side (apparatus, footnotes, first image).
"""

from __future__ import annotations

import html
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.sources.markup import parse_xml

Rule = Callable[[ET.Element, str, "Page"], str]


class Page:
    """State of one page and the rules in force."""

    def __init__(self, rules: dict[str, Rule], root: ET.Element | None = None, apostrophe: bool = True, **settings) -> None:
        self.rules, self.root, self.apostrophe, self.settings = rules, root, apostrophe, settings
        self.numbers: dict[str, int] = {}
        self.gathered: dict[str, list] = {}
        self.context: list[str] = []

    def next(self, name: str) -> int:
        self.numbers[name] = self.numbers.get(name, 0) + 1
        return self.numbers[name]

    def escape(self, text: str) -> str:
        return html.escape(text) if self.apostrophe else html.escape(text, quote=False).replace('"', "&quot;")

    def element(self, el: ET.Element) -> str:
        rule = self.rules.get(el.tag)
        if rule is None:
            return self.content(el)
        # rules that look inside by themselves are marked, so nothing is rendered (and numbered) twice
        return rule(el, "" if getattr(rule, "own", False) else self.content(el), self)

    def content(self, el: ET.Element) -> str:
        return self.escape(el.text or "") + "".join(self.element(c) + self.escape(c.tail or "") for c in el)


def own(rule: Rule) -> Rule:
    """Marks a rule that renders its content itself."""
    rule.own = True
    return rule


def wrap(before: str, after: str) -> Rule:
    return lambda el, inner, page: before + inner + after


def all_text(el: ET.Element | None) -> str:
    return "" if el is None else "".join(el.itertext())


# --- Lexicon definitions --------------------------------------------------------------------------

ENTRY_RULES: dict[str, Rule] = {
    "hi": lambda el, inner, page: f"<strong>{inner}</strong>" if el.get("rend") == "bold" else f"<em>{inner}</em>",
    "ref": lambda el, inner, page: f'<a class="xref" href="{page.escape(el.get("target"))}">{inner}</a>' if el.get("target") else inner,
    "cit": own(lambda el, inner, page: ""),
}


def entry_html(el: ET.Element) -> str:
    """Inline HTML of a definition or quotation, white space squeezed; nested citations are left out."""
    return re.sub(r"\s+", " ", Page(ENTRY_RULES).content(el)).strip()


# --- Text bodies ----------------------------------------------------------------------------------


@own
def _page_break(el: ET.Element, inner: str, page: Page) -> str:
    n, wit = el.get("n", ""), el.get("wit", "").lstrip("#")
    entry = page.settings.get("folios", {}).get(n, {})
    facs, sp = el.get("facs", "") or entry.get("facs", ""), entry.get("sp", 0)
    if facs and "first" not in page.gathered:
        page.gathered["first"] = [facs, n, sp]
    data = f'data-wit="{html.escape(wit)}" data-folio="{html.escape(n)}"'
    data += (f' data-facs="{html.escape(facs)}"' if facs else "") + (f' data-sp="{sp}"' if sp else "")
    return f'<span class="folio-milestone" {data} title="{html.escape(page.settings.get("shelfmark", ""))} {html.escape(wit)}, f. {html.escape(n)}">{html.escape(n)}</span>'


@own
def _apparatus(el: ET.Element, inner: str, page: Page) -> str:
    n, lemma = page.next("app"), all_text(el.find("lem"))
    readings = [(all_text(r), r.get("wit", "").lstrip("#"), r.get("type", "orthographic")) for r in el.findall("rdg")]
    page.gathered.setdefault("apparatus", []).append((n, page.settings.get("par", ""), lemma, readings[-1][2] if readings else "orthographic", readings))
    return f'<span class="app-inline" data-app="app-{n}" title="{html.escape(page.settings.get("variant", "var."))} {n}">{html.escape(lemma)}</span>'


@own
def _editor_note(el: ET.Element, inner: str, page: Page) -> str:
    kind, who = el.get("type", ""), page.settings.get("editors", {}).get(el.get("resp", "").lstrip("#"), "")
    text = html.escape(all_text(el))
    css = f" note-type-{html.escape(kind)}" if kind else ""
    by = f' <span class="note-resp">— {html.escape(who)}</span>' if who else ""
    return f'<span class="editorial-note{css}" title="{text}">[<span class="note-body">{text}{by}</span>]</span>'


def _highlight(el: ET.Element, inner: str, page: Page) -> str:
    css = {"initial": "geo-initial", "rubric": "geo-rubric"}.get(el.get("rend", ""))
    return f'<span class="{css}">{inner}</span>' if css else f"<em>{inner}</em>"


@own
def _word(el: ET.Element, inner: str, page: Page) -> str:
    target, text = (el.get("lemmaRef") or el.get("lemma") or "").lstrip("#"), html.escape(all_text(el))
    return f'<span class="lex-word" data-lemma="{html.escape(target)}">{text}</span>' if target else text


def _quoted(el: ET.Element, inner: str, page: Page) -> str:
    source = el.get("source", "").lstrip("#")
    return f'<span class="geo-quote"{f" data-source={chr(34)}{html.escape(source)}{chr(34)}" if source else ""}>{inner}</span>'


BODY_RULES: dict[str, Rule] = {
    "pb": _page_break, "app": _apparatus, "note": _editor_note, "hi": _highlight, "w": _word, "quote": _quoted,
    "lb": lambda el, inner, page: "<br>" if page.settings.get("lines") else "",
}


def body_page(root: ET.Element, **settings) -> tuple[str, Page]:
    """HTML of the ``div``s of type text, their children in document order, and the page's state."""
    page, out = Page(BODY_RULES, root, **settings), []
    for div in root.iterfind(".//body//div[@type='text']"):
        for child in div:
            page.settings["lines"] = child.tag in ("head", "trailer")
            if child.tag == "head":
                css = {"rubric": "ms-rubric", "dateline": "ms-dateline"}.get(child.get("type", ""), "ms-head")
                out.append(f'<div class="{css}">{page.content(child)}</div>')
            elif child.tag == "p":
                ident = child.get("xml_id") or f"p{page.next('anonymous')}"
                n = html.escape(child.get("n", ident.lstrip("p")))
                page.settings["par"] = ident
                out.append(f'<p id="{html.escape(ident)}"><span class="par-num" title="¶{n}">¶{n}</span>{page.content(child)}</p>')
            elif child.tag == "trailer":
                out.append(f'<div class="ms-trailer">{page.content(child)}</div>')
            elif child.tag == "note":
                out.append(f'<div class="editorial-note-block">{page.element(child)}</div>')
            elif child.tag == "pb":
                out.append(page.element(child))
    return "\n".join(out), page


# --- Articles -------------------------------------------------------------------------------------

#: Highlighting by its kind.
HIGHLIGHTS = {
    "bold": ("<strong>", "</strong>"), "b": ("<strong>", "</strong>"), "letterspaced": ('<span class="ls">', "</span>"), "spaced": ('<span class="ls">', "</span>"), "italic": ("<em>", "</em>"),
    "i": ("<em>", "</em>"), "sup": ("<sup>", "</sup>"), "superscript": ("<sup>", "</sup>"), "sub": ("<sub>", "</sub>"), "subscript": ("<sub>", "</sub>"),
}


def _marker(el: ET.Element, page: Page) -> str:
    n = page.escape(el.get("n", ""))
    label = page.settings.get("page_label", "p.")
    return f'<span class="pb-marker" title="{label} {n}">[{label} {n}]</span>' if n else ""


def _link(el: ET.Element, page: Page) -> str:
    target, text = el.get("target", ""), page.escape(all_text(el).strip())
    if not text or not target:
        return text
    if re.match("https?://", target):
        return f'<a href="{page.escape(target)}" class="ext-link" target="_blank" rel="noopener noreferrer">{text}</a>'
    return f'<a href="{page.escape(target)}" class="bib-ref">{text}</a>'


@own
def _footnote(el: ET.Element, inner: str, page: Page) -> str:
    if "note" in page.context:
        return page.content(el)
    k = page.next("note")
    n, ident = page.escape(el.get("n", str(k))), page.escape(el.get("xml_id", f"note-{k}"))
    page.context.append("note")
    page.gathered.setdefault("notes", []).append((el.get("n", str(k)), el.get("xml_id", f"note-{k}"), page.content(el)))
    page.context.pop()
    return f'<span class="note-ref-wrap" data-note-id="{ident}"><a href="#fn-{ident}" class="note-ref" id="ref-{ident}">{n}</a></span>'


@own
def _reference(el: ET.Element, inner: str, page: Page) -> str:
    if el.get("type") != "noteAnchor":
        return _link(el, page)
    target = el.get("target", "").lstrip("#")
    called = page.root.find(f".//note[@xml_id='{target}']") if page.root is not None and "'" not in target else None
    n = el.get("n") or (called.get("n", "") if called is not None else "")
    return f'<span class="note-ref-wrap" data-note-id="{page.escape(target)}"><a href="#fn-{page.escape(target)}" class="note-ref">{page.escape(n)}</a></span>'


@own
def _table(el: ET.Element, inner: str, page: Page) -> str:
    parts: dict[str, list[str]] = {"head": [], "row": []}
    for tag, made in _pieces(el, page, texts=False):
        parts.setdefault(tag, []).append(made)
    return f'<div class="table-wrap"><table class="art-table">{"".join([*parts["head"][:1], *parts["row"]])}</table></div>'


def _row(el: ET.Element, page: Page) -> str:
    """The cells of a table's row; a row or a cell of labels is of headings."""
    return "".join(_cell(c, "label" in (el.get("role"), c.get("role")), page) for c in el.findall("cell"))


def _cell(el: ET.Element, heads: bool, page: Page) -> str:
    spans = "".join(f' {html_name}="{page.escape(el.get(name))}"' for name, html_name in SPANS.items() if el.get(name))
    tag = "th" if heads else "td"
    return f"<{tag}{spans}>{page.content(el)}</{tag}>"


@own
def _verses(el: ET.Element, inner: str, page: Page) -> str:
    return f'<div class="lg">{"".join(made for _, made in _pieces(el, page, texts=False))}</div>'


@own
def _gap(el: ET.Element, inner: str, page: Page) -> str:
    why = (all_text(el.find("desc")).strip() or el.get("reason", ""), el.get("extent", ""))
    return f'<span class="gap" title="{page.escape("; ".join(filter(None, why)))}">[…]</span>'


@own
def _bibl(el: ET.Element, inner: str, page: Page) -> str:
    if "note" not in page.context:
        return f'<span class="bibl">{page.content(el)}</span>'
    page.context.append("bibl")
    out = f'<span class="bibl">{page.content(el)}</span>'
    page.context.pop()
    return out


def _title(el: ET.Element, inner: str, page: Page) -> str:
    if "note" not in page.context:
        return inner
    css = ("bib-" if page.context[-1] == "bibl" else "") + ("title-foreign" if el.get("xml_lang", "ka") not in ("", "ka") else "title")
    return f'<cite class="{css}">{inner}</cite>'


def _by(css: str, only: str) -> Rule:
    return lambda el, inner, page: f'<span class="{"bib-" if page.context[-1:] == ["bibl"] else ""}{css}">{inner}</span>' if only in page.context else inner


ARTICLE_RULES: dict[str, Rule] = {
    "note": _footnote, "ref": _reference, "table": _table, "lg": _verses, "gap": _gap, "bibl": _bibl, "title": _title, "author": _by("author", "note"), "series": _by("series", "bibl"),
    "pb": own(lambda el, inner, page: _marker(el, page)), "desc": own(lambda el, inner, page: ""), "lb": own(lambda el, inner, page: "<br>"), "l": wrap('<span class="l">', "</span>"),
    "supplied": lambda el, inner, page: f'<span class="supplied" title="{page.escape(page.settings.get("supplied", ""))}">[{inner}]</span>', "persName": wrap('<span class="persname">', "</span>"),
    "unclear": lambda el, inner, page: f'<span class="unclear" title="{page.escape(page.settings.get("unclear", ""))}">{inner}</span>',
    "hi": lambda el, inner, page: inner.join(HIGHLIGHTS.get((el.get("rend") or "").strip(), ("", ""))),
    "foreign": lambda el, inner, page: f'<span class="foreign"{f" lang={chr(34)}{page.escape(el.get("xml_lang"))}{chr(34)}" if el.get("xml_lang") else ""}>{inner}</span>',
}


#: What a child is dressed in, by where it stands; ``*`` is for children that are not named.
DRESS = {
    "list": {"head": ('<p class="list-head">', "</p>"), "label": ('<li class="item-label">', "</li>"), "pb": ('<li class="li-pb">', "</li>"), "*": ("<li>", "</li>")},
    "item": {"p": ('<p class="item-p">', "</p>"), "label": ('<span class="item-label">', "</span>")},
    "quote": {"p": ('<p class="quote-p">', "</p>"), "bibl": ('<span class="quote-bibl">', "</span>")},
    "table": {"head": ("<caption>", "</caption>"), "row": ("<tr>", "</tr>")},
    "lg": {"l": ('<span class="l">', "</span>"), "lg": ("", ""), "pb": ('<span class="l l-pb">', "</span>"), "*": ('<span class="l">', "</span>")},
}
#: Attributes by which cells span others.
SPANS = {"cols": "colspan", "rows": "rowspan"}
#: The kind of a division's block and what it is dressed in, by tag, or by tag and rend.
BLOCKS = {
    "p.label": ("label", '<p class="label-p">', "</p>"), "head": ("label", '<p class="label-p">', "</p>"), "quote": ("quote", "", ""), "lg": ("quote", '<blockquote class="block-quote">', "</blockquote>"),
    "list": ("list", "", ""), "table": ("table", "", ""), "pb": ("pb", '<div class="pb-block">', "</div>"), "closer": ("closer", '<div class="closer">', "</div>"), "gap": ("gap", '<p class="gap-block">', "</p>"),
    "milestone": ("milestone", "", ""), "milestone.asterism": ("milestone", '<p class="asterism" aria-hidden="true">*&#8195;*&#8195;*', "</p>"),
}
#: Children that end the paragraph which a quotation's own text opens, and those that make an item a sequence of blocks.
QUOTE_BREAKS, ITEM_BLOCKS = {"lg", "p", "bibl", "list"}, {"p", "label", "list"}


def _bare(el: ET.Element, page: Page, dressed: bool) -> str:
    """What a child is without its dress: some tags have a rendering of their own, else the content of what is dressed and
    the rule's result for what isn't."""
    alone = {"list": _list, "item": _item, "pb": _marker, "row": _row, "table": Page.element, "lg": Page.element, "gap": Page.element, "quote": _quotation, "milestone": lambda el, page: ""}
    if dressed and el.tag in alone:
        render = alone[el.tag]
        return page.element(el) if render is Page.element else render(el, page)
    if el.tag == "list":
        return _list(el, page)
    return page.content(el) if dressed else page.element(el)


def _pieces(el: ET.Element, page: Page, texts: bool = True) -> Iterator[tuple[str, str]]:
    """(tag, html) of an element's children in order, dressed as their place asks; between them, under an empty tag, the
    texts that aren't blank."""
    dress = DRESS[el.tag]

    def said(s: str | None) -> Iterator[tuple[str, str]]:
        if texts and s and s.strip():
            yield "", page.escape(s)

    yield from said(el.text)
    for c in el:
        before, after = dress.get(c.tag) or dress.get("*", ("", ""))
        yield c.tag, before + _bare(c, page, c.tag in dress or (c.tag == "item" and "*" in dress)) + after
        yield from said(c.tail)


def _list(el: ET.Element, page: Page) -> str:
    parts = [*_pieces(el, page, texts=False)]
    pick = lambda heads: "".join(h for tag, h in parts if (tag == "head") == heads)
    return f'<div class="art-list-wrap">{pick(True)}<ul class="art-list">{pick(False)}</ul></div>'


def _item(el: ET.Element, page: Page) -> str:
    in_blocks = any(c.tag in ITEM_BLOCKS for c in el)
    return "".join(h for _, h in _pieces(el, page)) if in_blocks else page.content(el)


def _quotation(el: ET.Element, page: Page) -> str:
    parts = [*_pieces(el, page)]
    lead = next((k for k, (tag, _) in enumerate(parts) if tag in QUOTE_BREAKS), len(parts)) if (el.text or "").strip() else 0
    htmls = [h for _, h in parts]
    opening = DRESS["quote"]["p"][0] + "".join(htmls[:lead]) + DRESS["quote"]["p"][1] if lead else ""
    return f'<blockquote class="block-quote">{opening}{"".join(htmls[lead:])}</blockquote>'


def _block(el: ET.Element, page: Page) -> tuple[str, str]:
    """(kind, html) of a child of a division; what is not named is a paragraph."""
    named = BLOCKS.get(f"{el.tag}.{el.get('rend')}") or BLOCKS.get(el.tag)
    if named is None:
        return "p", page.element(el) if el.tag in ("note", "ref", "supplied") else page.content(el)
    kind, before, after = named
    return kind, before + _bare(el, page, True) + after


def section_blocks(div: ET.Element, page: Page, level: int = 0) -> Iterator[tuple[str, int, str, str]]:
    """(section id, level, kind, html) of a division's blocks and those of its subdivisions, in order. A run-in
    heading opens the first paragraph; page breaks before it follow the heading."""
    ident, head = div.get("xml_id", ""), div.find("head")
    title = page.content(head) if head is not None else ""
    blocks: list = [c if c.tag == "div" else _block(c, page) for c in div if c is not head]
    blocks = [b for b in blocks if isinstance(b, ET.Element) or b[1].strip()]
    lead = next((k for k, b in enumerate(blocks) if isinstance(b, ET.Element) or b[0] != "pb"), len(blocks))
    run_in = head is not None and head.get("rend") == "run-in" and title and lead < len(blocks) and not isinstance(blocks[lead], ET.Element) and blocks[lead][0] == "p"
    if run_in:
        breaks = "".join(b[1].removeprefix('<div class="pb-block">').removesuffix("</div>") for b in blocks[:lead])
        blocks = [("p", f'<strong class="run-in-head" id="{page.escape(ident)}">{title}</strong> {breaks}{blocks[lead][1]}'), *blocks[lead + 1 :]]
    elif title:
        yield ident, level, "head", title
    for b in blocks:
        if isinstance(b, ET.Element):
            yield from section_blocks(b, page, level + 1)
        else:
            yield ident, level, *b


# --- Pages as rows --------------------------------------------------------------------------------


def text_pages(docs: DataFrame, folios: dict[str, dict] | None = None, **settings) -> DataFrame:
    """(doc, html, app_count, first_facs, first_folio, first_sp) of each document's body; ``folios`` is a small map of images."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0), b.column(1), strict=True):
                root = parse_xml(text.as_py() or "")
                if root is None:
                    continue
                out, page = body_page(root, folios=folios or {}, **settings)
                facs, folio, sp = page.gathered.get("first", ["", "", 0])
                rows.append((doc.as_py(), out, page.numbers.get("app", 0), facs, folio, int(sp)))
            if rows:
                kinds = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc", "html", "app_count", "first_facs", "first_folio", "first_sp"])

    return docs.select(F.col("doc").cast("string"), "text").mapInArrow(run, "doc string, html string, app_count int, first_facs string, first_folio string, first_sp int")


def article_blocks(docs: DataFrame, back: tuple[str, ...] = ("errata", "corrigenda", "appendix"), **settings) -> DataFrame:
    """(doc, ord, section, level, kind, html): blocks of articles in order; footnotes follow as kind ``note`` with their id as section."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0), b.column(1), strict=True):
                root = parse_xml(text.as_py() or "")
                if root is None:
                    continue
                page = Page(ARTICLE_RULES, root, apostrophe=False, **settings)
                divs = root.findall(".//body/div") + [d for d in root.findall(".//text/back/div") if d.get("type") in back]
                made = [x for d in divs for x in section_blocks(d, page)]
                made += [(ident, 0, "note", note) for _, ident, note in page.gathered.get("notes", [])]
                rows += [(doc.as_py(), k, *x) for k, x in enumerate(made)]
            if rows:
                kinds = [pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string()]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc", "ord", "section", "level", "kind", "html"])

    return docs.select(F.col("doc").cast("string"), "text").mapInArrow(run, "doc string, ord int, section string, level int, kind string, html string")
