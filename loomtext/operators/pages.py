"""Pages from node tables, without walking trees: text bodies and articles as HTML, footnotes and apparatus entries as rows.

What an element becomes is a matter of its tag, its attributes and the tags above it, so it is a column; ``tree.serialised`` puts
the pieces in order. Nodes are shuffled by document once, without their paths; what repeats text (notes, lemmas) and what refers to other nodes comes
from windows inside a document, not from joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.operators.tree import escaped, last_before, nearest_enclosing, outline, running, serialised
from loomtext.sources.markup import nodes_below, subtree_text, with_subtree_text

#: The classes of headings by type, of highlights by rend, and of readings by type with their labels.
HEADS = {"rubric": "ms-rubric", "dateline": "ms-dateline"}
HIGHLIGHTS = {"initial": "geo-initial", "rubric": "geo-rubric"}


def attr(name: str) -> Column:
    return F.coalesce(F.element_at("attrs", name), F.lit(""))


def _joined(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _above(*tags: str) -> Column:
    """Is the node below an element of one of ``tags``?"""
    return F.arrays_overlap(F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0))), F.array(*map(F.lit, tags)))


def _by(cases: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda done, case: done.when(*case), cases[1:], F.when(*cases[0]))


#: Elements of text bodies whose text is shown by itself (of an apparatus entry its lemma's), those that hide what is in them, and those with line breaks.
SPOKEN, HIDING, BROKEN = {"note": None, "w": None, "app": "lem"}, ("note", "app", "w"), ("head", "trailer")


def body_nodes(docs: DataFrame) -> DataFrame:
    """The nodes of ``docs`` (doc, text) that ``text_bodies`` needs, with what it would else find out by sorting."""
    return nodes_below(docs, "body", SPOKEN, {"__hidden": HIDING, "__lines": BROKEN})


def text_bodies(nodes: DataFrame, editors: dict[str, str] | None = None, variant: str = "var.", shelfmark: str = "", counts: dict[str, Column] | None = None) -> DataFrame:
    """(doc, html, counts…): the parts of type text of each document's body, as ``render.text_pages`` gives them, the parts of a page a line each.

    ``nodes`` is a node table or that of ``body_nodes``. Line breaks count in headings and trailers only. Words lose the markup inside them; of apparatus entries the lemma is shown
    and numbered through the document. Documents without such a part give no row. ``counts`` are numbers of the body's nodes for which a condition holds.
    """
    tag = F.col("tag")
    if "full" in nodes.columns:
        rows = running(nodes, tag == "app", "app").withColumn("lemma", F.when(tag == "app", F.col("full")))
    else:
        lean = nodes.filter(F.array_position("path", "body") > 0).select(
            "doc", "node", "parent", "depth", "last", "tag", "attrs", "text", "tail", _above(*HIDING).alias("__hidden"), _above(*BROKEN).alias("__lines")
        )
        rows = running(with_subtree_text(lean, ["note", "lem", "w"]), tag == "app", "app")
        own = Window.partitionBy("doc", F.when(tag == "lem", F.col("parent")).otherwise(F.col("node")))  # an element and the lemmas in it
        rows = rows.withColumn("lemma", F.min_by("full", F.when(tag == "lem", F.col("node"))).over(own))
    if counts:
        rows = rows.withColumns({name: F.count_if(c).over(Window.partitionBy("doc")) for name, c in counts.items()})
    # the outermost part of type text around a node
    so_far = Window.partitionBy("doc").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("doc").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    part = (tag == "div") & (attr("type") == "text")
    rows = rows.withColumn("__until", F.max(F.when(part, F.col("last"))).over(earlier))
    outer = part & F.coalesce(F.col("__until") < F.col("node"), F.lit(True))
    rows = rows.withColumn("__part", F.last(F.when(outer, F.struct(F.col("node").alias("div"), F.col("last").alias("until"), F.col("depth").alias("div_depth"))), ignorenulls=True).over(so_far))
    inside = rows.filter(F.col("node") <= F.col("__part.until")).select("*", "__part.div", "__part.div_depth").drop("__part", "__until")
    top = F.col("depth") == F.col("div_depth") + 1
    quoted = lambda name, strip="": escaped(F.ltrim(attr(name), F.lit(strip)) if strip else attr(name))
    ident, n = quoted("xml_id"), escaped(F.when(attr("n") != "", attr("n")).otherwise(F.ltrim(attr("xml_id"), F.lit("p"))))
    target = escaped(F.ltrim(F.when(attr("lemmaRef") != "", attr("lemmaRef")).otherwise(attr("lemma")), F.lit("#")))
    full = escaped(F.coalesce("full", F.lit("")))
    who = reduce(lambda done, e: done.when(F.ltrim(attr("resp"), F.lit("#")) == e[0], F.lit(e[1])), (editors or {}).items(), F.when(F.lit(False), F.lit("")))
    by = F.when(who.isNotNull(), _joined(' <span class="note-resp">— ', escaped(who), "</span>")).otherwise("")
    kind = F.when(attr("type") != "", _joined(" note-type-", quoted("type"))).otherwise("")
    note = _joined('<span class="editorial-note', kind, '" title="', full, '">[<span class="note-body">', full, by, "</span>]</span>")
    wit, folio = quoted("wit", "#"), quoted("n")
    facs = F.when(attr("facs") != "", _joined(' data-facs="', quoted("facs"), '"')).otherwise("")
    number = F.col("app").cast("string")
    source = F.when(attr("source") != "", _joined(' data-source="', quoted("source", "#"), '"')).otherwise("")
    css = lambda name, of, default: reduce(lambda done, c: done.when(attr(name) == c[0], F.lit(c[1])), list(of.items())[1:], F.when(attr(name) == next(iter(of)), F.lit(next(iter(of.values()))))).otherwise(default)
    highlight = css("rend", HIGHLIGHTS, F.lit(None))
    parts = top & tag.isin("head", "p", "pb", "trailer", "note")
    before = _by([
        (parts & (tag == "head"), _joined('<div class="', css("type", HEADS, F.lit("ms-head")), '">')), (parts & (tag == "trailer"), F.lit('<div class="ms-trailer">')),
        (parts & (tag == "note"), _joined('<div class="editorial-note-block">', note)), (parts & (tag == "p"), _joined('<p id="', ident, '"><span class="par-num" title="¶', n, '">¶', n, "</span>")),
        (tag == "pb", _joined('<span class="folio-milestone" data-wit="', wit, '" data-folio="', folio, '"', facs, f' title="{shelfmark} ', wit, ", f. ", folio, '">', folio, "</span>")),
        (tag == "app", _joined('<span class="app-inline" data-app="app-', number, f'" title="{variant} ', number, '">', escaped(F.coalesce("lemma", F.lit(""))), "</span>")),
        (tag == "note", note), (tag == "hi", F.when(highlight.isNull(), F.lit("<em>")).otherwise(_joined('<span class="', highlight, '">'))),
        (tag == "lb", F.when(F.col("__lines"), F.lit("<br>")).otherwise("")), (tag == "quote", _joined('<span class="geo-quote"', source, ">")),
        (tag == "w", F.when(target != "", _joined('<span class="lex-word" data-lemma="', target, '">', full, "</span>")).otherwise(full)),
    ])
    after = _by([
        (parts & tag.isin("head", "trailer", "note"), F.lit("</div>\n")), (parts & (tag == "p"), F.lit("</p>\n")), (parts & (tag == "pb"), F.lit("\n")),
        (tag == "hi", F.when(highlight.isNull(), F.lit("</em>")).otherwise("</span>")), (tag == "quote", F.lit("</span>")),
    ])
    # what a note, an apparatus entry or a word holds is shown by itself; of a division only its named parts are
    spoken = tag.isin("note", "app", "w", "pb")
    text = F.when(spoken | (F.col("node") == F.col("div")), F.lit(None)).otherwise(F.col("text"))
    tail = F.when((F.col("node") == F.col("div")) | top, F.lit(None)).otherwise(F.col("tail"))
    unnamed = top & ~tag.isin("head", "p", "pb", "trailer", "note")
    inside = inside.withColumn("__unnamed", F.max(F.when(unnamed, F.col("last"))).over(so_far)).filter("coalesce(`__unnamed` < node, true)")
    shown = inside.withColumns({"__before": before, "__after": after, "text": text, "tail": tail, "__keep": F.when(F.col("__hidden"), F.lit(None)).otherwise(F.lit(True))})
    out = serialised(shown, F.col("__before"), F.col("__after"), F.col("__keep"), beside=list(counts or {}))
    return out.select("doc", F.rtrim("html", F.lit("\n")).alias("html"), *(counts or {}))


#: What an article's elements are dressed in.
ARTICLE = {"p": ("<p>", "</p>"), "quote": ("<blockquote>", "</blockquote>"), "list": ("<ul>", "</ul>"), "item": ("<li>", "</li>"), "hi": ("<em>", "</em>"), "supplied": ("[", "]"), "lg": ('<div class="verse">', "</div>"), "l": ("<div>", "</div>")}


def articles(nodes: DataFrame, dress: dict[str, tuple[str, str]] = ARTICLE) -> DataFrame:
    """(doc, html): articles with nested sections. Headings have their section's number and a rank by its level, notes are numbered calls and follow
    at the end in order, a second call (``ref`` to a note's id) repeats the number; elements without a dress are passed through."""
    tag, below = F.col("tag"), F.slice("path", F.array_position("path", "body").cast("int"), F.size("path"))
    lean = nodes.filter((F.array_position("path", "body") > 0) & (tag != "body")).select(
        "doc", "node", "last", "tag", F.element_at("attrs", "xml_id").alias("ident"), F.substring(F.when((tag == "ref") & F.startswith(attr("target"), F.lit("#")), attr("target")), 2, 1 << 30).alias("called"), "text", "tail",
        _above("note").alias("__hidden"), F.size(F.filter(below, lambda t: t == "div")).alias("level"), ((tag == "head") & (F.get("path", F.size("path") - 2) == "div")).alias("__titled"),
    )
    rows = _called(running(with_subtree_text(lean, ["note"]), tag == "note", "nth"))
    # A section is counted at its level and begins a new count one level below; a heading asks every level down to its own for the count.
    one = lambda at, kind: F.struct(at.cast("int").alias("l"), F.lit(kind).alias("kind"))
    asked = F.when(tag == "div", F.array(one(F.col("level"), 1), one(F.col("level") + 1, 0))).when(F.col("__titled"), F.transform(F.sequence(F.lit(1), F.greatest("level", F.lit(1))), lambda k: one(k, 2))).otherwise(F.array(one(F.lit(0), 3)))
    rows = rows.select("*", F.inline(asked))
    so_far = Window.partitionBy("doc", "l").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__count", F.count_if(F.col("kind") == 1).over(so_far))
    rows = rows.withColumn("__before", F.last(F.when(F.col("kind") == 0, F.col("__count")), ignorenulls=True).over(so_far))
    place, nth, rank = (F.col("__count") - F.coalesce("__before", F.lit(0))).cast("string"), F.col("nth").cast("string"), F.least(F.col("level") + 1, F.lit(6)).cast("string")
    call = tag.isin("note", "ref") & nth.isNotNull()
    before = _by([
        (tag == "div", _joined('<section id="', escaped(F.coalesce("ident", F.lit(""))), '">')), (F.col("__titled"), _joined("<h", rank, ">")),
        (call, _joined('<sup><a href="#fn-', nth, '">', nth, "</a></sup>")), *[(tag == t, F.lit(b)) for t, (b, _) in dress.items()],
    ])
    after = _by([(tag == "div", F.lit("</section>")), (F.col("__titled"), _joined("</h", rank, ">")), *[(tag == t, F.lit(a)) for t, (_, a) in dress.items()]])
    opening, closing, end = F.col("node") * 2, F.col("last") * 2 + 1, (1 << 31) - 1
    text = lambda c: escaped(F.coalesce(c, F.lit("")))
    main = ~F.col("__hidden") & ((F.col("kind") % 2 == 1) | ((F.col("kind") == 2) & (F.col("l") == F.col("level"))))
    piece = lambda when, at, turn, sub, s: F.when(when, F.struct(at.cast("int").alias("at"), turn.cast("int").alias("turn"), sub.cast("int").alias("sub"), s.alias("s")))
    zero, last, note = F.lit(0), F.lit(end), (tag == "note") & (F.col("kind") == 3)
    pieces = [
        piece(main, opening, zero, zero, F.coalesce(before, F.lit(""))), piece(main & ~call, opening, zero, last, text("text")), piece(main, closing, -F.col("node"), zero, F.concat(F.coalesce(after, F.lit("")), text("tail"))),
        piece(~F.col("__hidden") & (F.col("kind") == 2), opening, zero, F.col("l"), F.concat(F.when(F.col("l") > 1, ".").otherwise(""), place, F.when(F.col("l") == F.col("level"), " ").otherwise(""))),
        piece(note & (F.col("nth") == 1), last, zero, zero, F.lit("<ol>")), piece(note, last, F.col("nth"), zero, _joined('<li id="fn-', nth, '">', text("full"), "</li>")), piece(note & (F.col("nth") == 1), last, last, zero, F.lit("</ol>")),
    ]
    stream = rows.select("doc", F.inline(F.array_compact(F.array(*pieces)))).filter("s <> ''")
    return stream.groupBy("doc").agg(F.array_join(F.array_sort(F.collect_list(F.struct("at", "turn", "sub", "s")))["s"], "").alias("html"))  # a document's own pieces


def _called(rows: DataFrame) -> DataFrame:
    """``rows`` (doc, tag, ident, called, nth) whose calls have the number of the note that they name, the first of notes that share an id, null without one."""
    note = F.col("tag") == "note"
    same = Window.partitionBy("doc", F.when(note, F.col("ident")).otherwise(F.col("called")))
    first = F.min(F.when(note, F.col("nth"))).over(same)
    return rows.withColumn("nth", F.when(note, F.col("nth")).when(F.col("called").isNotNull(), first))


def footnotes(nodes: DataFrame) -> DataFrame:
    """(doc, node, nth, note_id, text): the notes in document order, nested ones too, with their running number and all their text."""
    held = nodes.filter(F.array_contains("path", "note")).select("doc", "node", "last", "tag", F.element_at("attrs", "xml_id").alias("note_id"), "text", "tail")
    found = running(with_subtree_text(held, ["note"]), F.col("tag") == "note", "nth").filter("tag = 'note'")
    return found.select("doc", "node", "nth", "note_id", F.col("full").alias("text"))


def called_notes(nodes: DataFrame) -> DataFrame:
    """(doc, nth, note_id, text, calls): ``footnotes`` with the number of their ``second_calls``."""
    target = F.when((F.col("tag") == "ref") & F.startswith(attr("target"), F.lit("#")), F.substring(attr("target"), 2, 1 << 30)).alias("called")
    held = nodes.select("doc", "node", "last", "tag", F.element_at("attrs", "xml_id").alias("ident"), target, "text", "tail", F.array_contains("path", "note").alias("__held")).filter("__held or called is not null")
    rows = _called(running(with_subtree_text(held.drop("__held"), ["note"]), F.col("tag") == "note", "nth")).filter("nth is not null")
    said = F.first(F.when(F.col("tag") == "note", F.struct(F.col("ident").alias("note_id"), F.col("full").alias("text"))), ignorenulls=True)
    return rows.groupBy("doc", "nth").agg(said.alias("x"), F.count_if(F.col("tag") == "ref").alias("calls")).select("doc", "nth", "x.note_id", "x.text", "calls")


def second_calls(nodes: DataFrame, notes: DataFrame) -> DataFrame:
    """(doc, node, note_id, nth): references (``ref`` with a ``#`` target) to a note of the same document, with the note's number; the
    first of notes that share an id counts. References to anything else are left out."""
    first = notes.filter("note_id IS NOT NULL").groupBy("doc", "note_id").agg(F.min("nth").alias("nth"))
    calls = nodes.filter((F.col("tag") == "ref") & F.startswith(attr("target"), F.lit("#"))).select("doc", "node", F.substring(attr("target"), 2, 1 << 30).alias("note_id"))
    return calls.join(first, ["doc", "note_id"]).select("doc", "node", "note_id", "nth")


def apparatus_entries(nodes: DataFrame, kinds: dict[str, tuple[str, str]], default: str = "orthographic") -> DataFrame:
    """(doc, nth, lemma, readings, type, css, label): apparatus entries in document order with their running number, the lemma's text, how many
    readings there are, and the last reading's type with its class and label; types without a class have the default's."""
    entries = running(nodes, F.col("tag") == "app", "nth").filter("tag = 'app'").select("doc", F.col("node").alias("app"), "nth")
    texts = subtree_text(nodes, ["lem"]).withColumnRenamed("full", "lem_text")
    below = nodes.filter(F.col("tag").isin("lem", "rdg")).join(texts, ["doc", "node"], "left")
    kind = F.when(attr("type") != "", attr("type")).otherwise(default)
    one = below.groupBy("doc", F.col("parent").alias("app")).agg(
        F.min_by("lem_text", F.when(F.col("tag") == "lem", F.col("node"))).alias("lemma"), F.count_if(F.col("tag") == "rdg").alias("readings"), F.max_by(kind, F.when(F.col("tag") == "rdg", F.col("node"))).alias("type")
    )
    rows = entries.join(one, ["doc", "app"], "left").withColumns({"type": F.coalesce("type", F.lit(default)), "readings": F.coalesce("readings", F.lit(0)), "lemma": F.coalesce("lemma", F.lit(""))})
    named = lambda k: reduce(lambda done, x: done.when(F.col("type") == x[0], F.lit(x[1][k])), kinds.items(), F.when(F.lit(False), F.lit(""))).otherwise(kinds[default][k])
    return rows.select("doc", "nth", "lemma", "readings", "type", named(0).alias("css"), named(1).alias("label"))


def page_of(nodes: DataFrame, which: Column, folios: DataFrame) -> DataFrame:
    """The nodes of ``which`` with the page they begin on: ``folio`` of the last page break before them, its image ``facs`` (its own, else
    that of ``folios`` (folio, facs), else empty), and ``first_facs``, the first image that a page break of the document names itself."""
    breaks = F.col("tag") == "pb"
    rows = last_before(nodes, breaks, F.struct(attr("n").alias("folio"), attr("facs").alias("own")), "page")
    first = nodes.filter(breaks & (attr("facs") != "")).groupBy("doc").agg(F.min_by(attr("facs"), "node").alias("first_facs"))
    rows = rows.filter(which).select("*", F.col("page.folio").alias("folio"), F.nullif("page.own", F.lit("")).alias("__own")).drop("page")
    rows = rows.join(folios.select("folio", F.col("facs").alias("__facs")), "folio", "left").join(first, "doc", "left")
    return rows.withColumn("facs", F.when(F.col("folio").isNotNull(), F.coalesce("__own", "__facs", F.lit("")))).drop("__own", "__facs")


def sense_rows(nodes: DataFrame) -> DataFrame:
    """(doc, node, sense, parent, level, number, def, examples): senses at any depth inside their entry, kept if they have a definition or an
    example of their own. Numbers and levels count all senses, those without content too."""
    numbered = outline(nodes.filter(F.array_contains("path", "entry")), F.col("tag") == "sense")
    own = nearest_enclosing(nodes, F.col("tag").isin("def", "cit"), F.col("tag") == "sense", "sense")
    texts = subtree_text(nodes, ["def"])
    held = own.join(nodes.select("doc", "node", "tag", attr("type").alias("type")), ["doc", "node"]).join(texts, ["doc", "node"], "left")
    said = held.groupBy("doc", F.col("sense").alias("node")).agg(
        F.min_by(F.nullif(F.trim("full"), F.lit("")), F.when(F.col("tag") == "def", F.col("node"))).alias("def"), F.count_if((F.col("tag") == "cit") & (F.col("type") == "example")).cast("int").alias("examples")
    )
    ids = nodes.filter("tag = 'sense'").select("doc", "node", F.element_at("attrs", "xml_id").alias("sense"))
    out = numbered.join(ids, ["doc", "node"]).join(said, ["doc", "node"], "left").withColumn("examples", F.coalesce("examples", F.lit(0)))
    return out.filter(F.col("def").isNotNull() | (F.col("examples") > 0))
