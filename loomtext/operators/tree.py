"""Questions about trees, asked of the node table: what encloses a node, what stands before it, how deep it lies; and markup from nodes.

A node covers the numbers from its own to its last descendant's, so nesting is the nesting of intervals: openings and closings
in document order are a stream of events, and windows over it answer without walking a tree. A document is
the unit that a window sorts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomtext.sources.scratch import settled


def nearest_enclosing(nodes: DataFrame, inner: Column, outer: Column, name: str = "inside") -> DataFrame:
    """(doc, node, name): for the nodes of ``inner`` the nearest node of ``outer`` around them, null where there is none.

    Outer elements open one level each. An inner node at level d is in the last outer one that opened level d before it.
    """
    event = lambda when, at, kind, delta: F.when(when, F.struct(at.alias("at"), F.lit(kind).alias("kind"), F.col("node"), F.lit(delta).alias("delta")))
    opening, closing = F.col("node") * 2, F.col("last") * 2 + 1
    events = F.array_compact(F.array(event(inner, opening, 0, 0), event(outer, opening, 1, 1), event(outer, closing, 2, -1)))
    stream = nodes.select("doc", F.inline(events))
    level = F.sum("delta").over(Window.partitionBy("doc").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0))
    stream = stream.withColumn("level", level).filter("kind < 2")
    opened = F.last(F.when(F.col("kind") == 1, F.col("node")), ignorenulls=True).over(Window.partitionBy("doc", "level").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0))
    return stream.withColumn(name, opened).filter("kind = 0").select("doc", "node", name)


def last_before(nodes: DataFrame, mark: Column, value: Column, name: str) -> DataFrame:
    """``nodes`` with ``value`` of the last node of ``mark`` up to and with each node, in document order; null before the first."""
    so_far = Window.partitionBy("doc").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    return nodes.withColumn(name, F.last(F.when(mark, value), ignorenulls=True).over(so_far))


def running(nodes: DataFrame, of: Column, name: str) -> DataFrame:
    """``nodes`` with the running number, from 1 in each document, of those that ``of`` holds for; null for the others."""
    so_far = Window.partitionBy("doc").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    return nodes.withColumn(name, F.when(of, F.count_if(of).over(so_far)))


def outline(nodes: DataFrame, which: Column) -> DataFrame:
    """(doc, node, parent, level, number array): the nested elements of ``which`` with the nearest such element around them, their
    level from 1, and their place among siblings at every level from the top, as ``[2, 1, 3]`` for 2.1.3.

    Places are gathered by pointer doubling: in each round every node takes over what the node it points to has gathered and
    points where that one points, so a depth of d takes log2 d rounds.
    """
    found = nearest_enclosing(nodes, which, which, "parent")
    place = F.row_number().over(Window.partitionBy("doc", "parent").orderBy("node"))
    rows = found.select("doc", "node", "parent", F.array(place).alias("number"), F.col("parent").alias("up"))
    rows = settled(rows, "outline")
    while not rows.filter("up IS NOT NULL").isEmpty():
        above = rows.select("doc", F.col("node").alias("up"), F.col("number").alias("upper"), F.col("up").alias("further"))
        rows = rows.join(above, ["doc", "up"], "left").select("doc", "node", "parent", F.concat(F.coalesce("upper", F.array().cast("array<int>")), "number").alias("number"), F.col("further").alias("up"))
        rows = settled(rows, "outline")
    return rows.select("doc", "node", "parent", F.size("number").alias("level"), "number")


def serialised(nodes: DataFrame, before: Column, after: Column, keep: Column, name: str = "html", beside: list[str] = ()) -> DataFrame:
    """(doc, beside, name): each document put together again from its nodes: ``before``, its text, what is below it, ``after``, its tail.

    ``before`` and ``after`` are markup, texts and tails are escaped. ``keep`` is false for a node whose markup and text are left out while its
    tail stays, and null for one that goes with its tail, as what is inside something hidden does. ``beside`` are columns of the document.
    """
    text = escaped(F.coalesce("text", F.lit("")))
    tail = escaped(F.coalesce("tail", F.lit("")))
    blank = F.lit("")
    opening = F.struct((F.col("node") * 2).alias("at"), F.lit(0).alias("turn"), F.when(keep, F.concat(F.coalesce(before, blank), text)).otherwise(blank).alias("s"))
    closing = F.struct((F.col("last") * 2 + 1).alias("at"), (-F.col("node")).alias("turn"), F.concat(F.when(keep, F.coalesce(after, blank)).otherwise(blank), F.when(keep.isNull(), blank).otherwise(tail)).alias("s"))
    stream = nodes.select("doc", *beside, F.inline(F.array(opening, closing))).filter("s <> ''")
    return stream.groupBy("doc", *beside).agg(F.array_join(F.array_sort(F.collect_list(F.struct("at", "turn", "s")))["s"], "").alias(name))  # a document's own events


def escaped(text: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    return text
