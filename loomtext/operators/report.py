"""Report tables: what a run of matching, of profiling unmatched words, or of scoped matching amounts to, as rows in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.strings import percent
from loomtext.operators import oov

#: The lines of the overview in order.
OVERVIEW = ["total", "stopword", "authority", "matched", "none", "in_lexicon"]


def _lines(one: DataFrame, names: list[str], total: str) -> DataFrame:
    """(line, label, n, share) from the columns ``names`` of one row."""
    rows = F.array(*[F.struct(F.lit(k).alias("line"), F.lit(n).alias("label"), F.coalesce(F.col(n), F.lit(0)).alias("n"), percent(F.coalesce(F.col(n), F.lit(0)), F.col(total)).alias("share")) for k, n in enumerate(names)])
    return one.select(F.explode(rows).alias("x")).select("x.*")


def matching(counted: DataFrame, tiers: tuple[str, str] = ("primary", "master"), n: str = "freq") -> DataFrame:
    """(line, label, n, share): tokens in all, stop words, names, dictionary matches, unmatched ones, those in the lexicon; from
    counted types with their match. Shares in per cent of all tokens, as text; null if there are none."""
    tier = F.col("match_tier")
    sums = {"total": F.lit(True), "stopword": tier == "stopword", "authority": tier == "authority", "matched": tier.isin(*tiers), "none": tier == "none", "in_lexicon": F.col("in_lexicon") == "1"}
    return _lines(counted.agg(*[F.sum(F.when(c, F.col(n)).otherwise(0)).alias(k) for k, c in sums.items()]), OVERVIEW, "total")


def per_text(coverage: DataFrame, text: str = "text_id") -> DataFrame:
    """``match.text_coverage`` with the shares of matched tokens and of those in the lexicon."""
    return coverage.select(text, "matched", "total", percent(F.col("matched"), F.col("total")).alias("share"), "in_lex", percent(F.col("in_lex"), F.col("total")).alias("in_lex_share"))


def unmatched(found: DataFrame) -> DataFrame:
    """(line, category, types, tokens, share): every category in its order, those without a type too."""
    found_kinds = F.collect_list(F.struct("category", "types", "tokens")).alias("kinds")
    every = oov.rollup(found).agg(F.sum("tokens").alias("total"), found_kinds)  # one row
    kinds = found.sparkSession.createDataFrame([(k, c) for k, c in enumerate(oov.CATEGORIES)], "line int, category string")
    mine = F.try_element_at(F.filter("kinds", lambda x: x["category"] == F.col("category")), F.lit(1))
    rows = kinds.crossJoin(F.broadcast(every)).withColumn("one", mine)
    zero = lambda c: F.coalesce(F.col(f"one.{c}"), F.lit(0))
    return rows.select("line", "category", zero("types").alias("types"), zero("tokens").alias("tokens"), percent(zero("tokens"), F.col("total")).alias("share"))


def scoped(matched: DataFrame, carried: DataFrame) -> DataFrame:
    """One row: words that scoped matching found beyond the corpus-wide map ``carried`` (surface, id), the ids it newly covers, all ids covered."""
    new = matched.join(carried.select("surface").distinct(), "surface", "left_anti")
    both: Column = F.count_distinct("id")
    found = new.agg(F.count("*").alias("discoveries"), both.alias("newly_covered"))
    every = new.select("id").unionByName(carried.select("id")).agg(both.alias("covered"))
    return found.crossJoin(F.broadcast(every))  # one row each
