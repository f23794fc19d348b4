"""Positions and neighbours in one order over a whole table, without a task that sees all of it.

Boundaries cut the order into parts of about equal size. They are the quantiles of a sample chosen by hash, so they are the same whenever the
plan runs; ties are cut by further columns. Each part is ranked by itself, and the parts' sizes, added up, are what comes
before; the last row of the part before and the first of the one after are a part's outer neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of the sample for each part, rows that a part is meant to have, and most parts: beyond that parts grow, since their boundaries go to every task.
SAMPLED, PART_ROWS, MOST_PARTS = 50, 500_000, 4000


def _bounds(rows: DataFrame, key: Column, parts: int) -> list:
    """At most ``parts`` - 1 keys that cut ``rows`` evenly, in order; from about SAMPLED rows a part, chosen by the key's hash."""
    n = rows.count()
    share = min(1.0, SAMPLED * parts / n) if n else 1.0
    some = rows.select(key.alias("k")).filter(F.xxhash64("k") / F.lit(float(1 << 64)) + 0.5 <= share)
    found = [r.k for r in some.sort("k").collect()]  # bounded by the number of parts
    return [found[len(found) * i // parts] for i in range(1, parts)] if found else []


def _parted(rows: DataFrame, order: list[str | Column], parts: int | None) -> tuple[DataFrame, int]:
    """``rows`` with ``__key`` (the order as one struct) and ``__part``, how many boundaries lie at or before it."""
    key = F.struct(*[F.col(c) if isinstance(c, str) else c.alias(f"o{i}") for i, c in enumerate(order)])
    rows = rows.withColumn("__key", key)
    parts = parts or min(MOST_PARTS, max(2, -(-rows.count() // PART_ROWS)))
    bounds = _bounds(rows, F.col("__key"), parts)
    if not bounds:
        return rows.withColumn("__part", F.lit(0)), 1
    table = rows.sparkSession.createDataFrame([(bounds,)], _schema(rows))
    at = F.aggregate(F.sequence(F.lit(1), F.lit(_depth(len(bounds)))), F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), _halve)["lo"]
    rows = rows.crossJoin(F.broadcast(table)).withColumn("__part", at).drop("__bounds")  # one row beside each
    return rows, len(bounds) + 1


def _schema(rows: DataFrame):
    from pyspark.sql.types import ArrayType, StructField, StructType

    return StructType([StructField("__bounds", ArrayType(rows.schema["__key"].dataType))])


def _depth(n: int) -> int:
    return max(1, n.bit_length())


def _halve(a: Column, _: Column) -> Column:
    """One step of a binary search for the number of boundaries at or before the key."""
    mid = ((a["lo"] + a["hi"]) / 2).cast("int")
    before = F.get("__bounds", mid) <= F.col("__key")
    lo = F.when((a["lo"] < a["hi"]) & before, mid + 1).otherwise(a["lo"])
    hi = F.when((a["lo"] < a["hi"]) & ~before, mid).otherwise(a["hi"])
    return F.struct(lo.cast("int").alias("lo"), hi.cast("int").alias("hi"))


def ranked(rows: DataFrame, order: list[str | Column], name: str = "rank", parts: int | None = None) -> DataFrame:
    """``rows`` with their position from 1 in ``order`` (ascending columns or expressions, nulls first), which should end in something
    unique: rows that agree in all of it are numbered in any order. An empty table gives an empty one."""
    rows, _ = _parted(rows, order, parts)
    sizes = {r["__part"]: r["count"] for r in rows.groupBy("__part").count().collect()}  # a row for each part
    before, at = [], 0
    for p in sorted(sizes):
        before.append((p, at))
        at += sizes[p]
    base = F.broadcast(rows.sparkSession.createDataFrame(before, "__part int, __before long"))
    nth = F.row_number().over(Window.partitionBy("__part").orderBy("__key"))
    return rows.withColumn("__nth", nth).join(base, "__part").withColumn(name, F.col("__before") + F.col("__nth")).drop("__part", "__key", "__nth", "__before")


def neighbours(rows: DataFrame, order: list[str | Column], ident: str, names: tuple[str, str] = ("prev_id", "next_id"), parts: int | None = None) -> DataFrame:
    """``rows`` with ``ident`` of the row before and after each in ``order`` (as in ``ranked``), null at the ends."""
    rows, _ = _parted(rows, order, parts)
    ends = rows.groupBy("__part").agg(F.min_by(F.struct(ident), "__key").alias("first"), F.max_by(F.struct(ident), "__key").alias("last"))
    ends = sorted(((r["__part"], r["first"][0], r["last"][0]) for r in ends.collect()), key=lambda r: r[0])  # a row for each part
    kind = rows.schema[ident].dataType.simpleString()
    outer = [(p, ends[i - 1][2] if i else None, ends[i + 1][1] if i + 1 < len(ends) else None) for i, (p, _, _) in enumerate(ends)]
    outer = F.broadcast(rows.sparkSession.createDataFrame(outer, f"__part int, __prev {kind}, __next {kind}"))
    w = Window.partitionBy("__part").orderBy("__key")
    inner = rows.withColumns({"__first": F.row_number().over(w) == 1, "__lag": F.lag(ident).over(w), "__lead": F.lead(F.struct(ident)).over(w)})
    out = inner.join(outer, "__part")
    out = out.withColumn(names[0], F.when(F.col("__first"), F.col("__prev")).otherwise(F.col("__lag"))).withColumn(names[1], F.when(F.col("__lead").isNull(), F.col("__next")).otherwise(F.col(f"__lead.{ident}")))
    return out.drop("__part", "__key", "__first", "__lag", "__lead", "__prev", "__next")
