"""Constraints on marked-up documents: counted before and after tagging, dangling references, closed lists."""

from __future__ import annotations

import xml.etree.ElementTree as ET

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where a tagged word must not be, and the closed lists.
HOLDERS = ["w", "lem", "rdg", "head", "note"]
READING_TYPES = ["orthographic", "grammatical", "lexical", "omission", "addition", "correction", "lacuna", "abbreviation", "confirmation"]


def tag_violations(root: ET.Element) -> dict[str, int]:
    """Words inside words, lemmas, readings, headings and notes of one tree."""
    counts = dict.fromkeys(HOLDERS, 0)
    work: list[tuple[ET.Element, frozenset]] = [(root, frozenset())]
    while work:
        el, above = work.pop()
        name = el.tag.rsplit("}", 1)[-1] if isinstance(el.tag, str) else ""
        if name == "w":
            for h in above:
                counts[h] += 1
        inside = above | {name} if name in counts else above
        work += [(c, inside) for c in el]
    return counts


def nested(nodes: DataFrame, tag: str = "w", holders: list[str] = HOLDERS) -> DataFrame:
    """Per document of a node table: how many ``tag`` elements are inside each holder."""
    inside = lambda h: F.count_if((F.col("tag") == tag) & F.array_contains(F.slice("path", 1, F.greatest(F.size("path") - 1, F.lit(0))), h)).alias(f"{tag}_in_{h}")
    return nodes.groupBy("doc").agg(*[inside(h) for h in holders])


def violations(nodes: DataFrame, tag: str = "w", holders: list[str] = HOLDERS) -> DataFrame:
    """(doc, rule, violations): ``nested`` a row a rule, those that are not violated left out."""
    one = F.array(*[F.struct(F.lit(f"{tag} in {h}").alias("rule"), F.col(f"{tag}_in_{h}").alias("violations")) for h in holders])
    return nested(nodes, tag, holders).select("doc", F.inline(one)).filter("violations > 0")


def rules(nodes: DataFrame, witness: str = "#S", editor: str = "#shanidze", types: list[str] = READING_TYPES) -> DataFrame:
    """(doc, rule, violations) for the documents and rules that are violated."""
    attr = lambda name: F.coalesce(F.element_at("attrs", name), F.lit(""))
    tag = F.col("tag")
    checks: dict[str, Column] = {
        "no w in rdg": (tag == "w") & F.array_contains("path", "rdg"),
        "rdg/@wit": (tag == "rdg") & (attr("wit") != witness),
        "rdg/@type": (tag == "rdg") & (attr("type") != "") & ~attr("type").isin(types),
        "pb/@ed": (tag == "pb") & ~attr("ed").isin(witness, editor),
        "pb/@facs": (tag == "pb") & (attr("ed") == witness) & (attr("facs") == ""),
        "lem/@resp": (tag == "lem") & (attr("resp") != editor),
    }
    broken = F.array_compact(F.array(*[F.when(c, name) for name, c in checks.items()]))
    return nodes.select("doc", F.explode(broken).alias("rule")).groupBy("doc", "rule").agg(F.count("*").alias("violations"))


def introduced(before: DataFrame, after: DataFrame, keys: list[str], count: str) -> DataFrame:
    """What got worse: (keys, before, after, added)."""
    b, a = before.select(*keys, F.col(count).alias("before")), after.select(*keys, F.col(count).alias("after"))
    both = b.join(a, keys, "full").select(*keys, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
    return both.withColumn("added", F.col("after") - F.col("before")).filter("added > 0")


def dangling(references: DataFrame, targets: DataFrame, ref: str, target: str) -> DataFrame:
    """References whose target doesn't exist; null references count as none."""
    return references.filter(F.col(ref).isNotNull()).join(targets.select(F.col(target).alias(ref)).distinct(), ref, "left_anti")
