"""Whole-table order, text bitmaps, one-pass sinks, stores and the gate: on ties, nulls, empty tables, and by their plans."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loomtext.operators import inject, oov, ordering, tokens
from loomtext.plans import orders
from loomtext.sources import scratch, tables


def plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    return [(r.choice([None, "", "a", "b", "hot", "hot", "hot", "ü"]), r.choice([None, 1, 2]), k) for k in range(3000)]


@pytest.mark.parametrize("parts", [1, 2, 7, 40, None])
def test_ranks_and_neighbours_are_those_of_one_sort(spark, rows, parts):
    df = spark.createDataFrame(rows, "word string, n int, id long").repartition(5)
    first = lambda x: (x is not None, x if x is not None else 0)
    want = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), first(r[1]), r[2]))
    got = {r.id: r.place for r in ordering.ranked(df, ["word", "n", "id"], "place", parts).collect()}
    assert [got[r[2]] for r in want] == list(range(1, 3001))
    near = {r.id: (r.before, r.after) for r in ordering.neighbours(df, ["word", "n", "id"], "id", ("before", "after"), parts).collect()}
    ids = [None, *[r[2] for r in want], None]
    assert [near[i] for i in ids[1:-1]] == [(a, b) for a, b in zip(ids, ids[2:], strict=False)]


def test_order_of_expressions_and_small_tables(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1)], "w string, id int")
    assert [(r.w, r.rank) for r in ordering.ranked(df, [-F.col("id"), "w"]).orderBy("rank").collect()] == [("b", 1), ("a", 2)]
    assert ordering.ranked(df.limit(0), ["w"]).count() == ordering.neighbours(df.limit(0), ["w"], "id").count() == 0
    assert [(r.prev_id, r.next_id) for r in ordering.neighbours(df.limit(1), ["w"], "id").collect()] == [(None, None)]


def test_no_window_sees_all_rows(spark, sf_dir):
    for name in ("document_ranks", "document_neighbours", "collated_words"):
        text = plan(getattr(orders, name)(spark, sf_dir))
        assert "Window" in text and "SinglePartition" not in text.replace("Exchange SinglePartition, EXECUTOR_BROADCAST", "")


def test_bitmaps_hold_every_text_once(spark):
    words = spark.createDataFrame([("a", i) for i in (0, 1, 63, 64, 200, 200, -1)] + [("b", 63), (None, 5)], "surface string, text_id long")
    got = {(r.surface, r.bucket): r.texts for r in oov.texts_of(oov.text_bitmaps(words)).collect()}
    assert got == {("a", 0): [0, 1, 63], ("a", 1): [64], ("a", 3): [200], ("a", -1): [-1], ("b", 0): [63], (None, 0): [5]}
    assert oov.text_bitmaps(words.limit(0)).count() == 0


def test_split_sink_reads_once_and_counts_what_is_written(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def touched(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.createDataFrame([("x", "A"), ("y", "B"), ("z", None), ("w", "A")], "word string, kind string").mapInArrow(touched, "word string, kind string")
    seen = {r.folder: r.observed for r in tables.split_sink(df, str(tmp_path / "s"), "kind", {"a": "A", "c": "C"}).collect()}
    assert seen == {"all": 4, "a": 2, "c": 0} and read.value == 4
    back = tables.read_split(spark, str(tmp_path / "s"), "word string, kind string")
    assert sorted((r.folder, r.word) for r in back.collect()) == [("a", "w"), ("a", "x"), ("all", "w"), ("all", "x"), ("all", "y"), ("all", "z")]
    assert "PartitionFilters: [isnotnull(folder" in plan(back.filter("folder = 'a'"))


def test_stores_read_what_is_asked_for(spark, sf_dir, tmp_path):
    rows_ = spark.range(500).selectExpr("cast(id % 50 as string) as text_id", "id as n")
    tables.write_store(rows_, str(tmp_path / "t"), buckets=8)
    some = tables.read_store(spark, str(tmp_path / "t"), "text_id string, n long", ["3", "17"], buckets=8)
    assert sorted({r.text_id for r in some.collect()}) == ["17", "3"] and some.count() == 20
    text = plan(some)
    assert "PartitionFilters: [bucket" in text and "PushedFilters: [In(text_id" in text
    assert tables.read_store(spark, str(tmp_path / "t"), "text_id string, n long").count() == 500 and tables.read_store(spark, str(tmp_path / "t"), "text_id string, n long", []).count() == 0
    assert "Exchange" not in plan(orders.stored_tokens(spark, sf_dir))


def test_versions_appear_whole_or_not_at_all(spark, tmp_path):
    docs = spark.createDataFrame([("d", "<a/>")], "doc string, text string")
    tables.publish(docs, str(tmp_path / "v"), "1")
    with pytest.raises(FileExistsError):
        tables.publish(docs.union(docs), str(tmp_path / "v"), "1")
    assert tables.read_version(spark, str(tmp_path / "v"), "1").count() == 1 and sorted(p.name for p in (tmp_path / "v").iterdir()) == ["version=1"]


def test_gate_refuses_what_got_worse(spark):
    old = spark.createDataFrame([("same", "<p><rdg><w>x</w></rdg></p>"), ("worse", "<p>x</p>"), ("better", "<p><note><w>x</w></note></p>"), ("broken", "<p/>")], "doc string, text string")
    new = spark.createDataFrame([("same", "<p><rdg><w>y</w></rdg></p>"), ("worse", "<p><w><w>x</w></w></p>"), ("better", "<p><note>x</note></p>"), ("broken", "<p>"), ("new", "<p><head><w/></head></p>")], "doc string, text string")
    accepted, refused = inject.gated(old, new)
    assert sorted((r.doc, r.text) for r in accepted.collect()) == [("better", "<p><note>x</note></p>"), ("broken", "<p/>"), ("same", "<p><rdg><w>y</w></rdg></p>"), ("worse", "<p>x</p>")]
    assert sorted((r.doc, r.rule, r.added) for r in refused.collect()) == [("broken", "not well-formed", 1), ("new", "w in head", 1), ("worse", "w in w", 1)]


def test_one_line_of_many_words(spark):
    import time

    took = []
    for n in (20_000, 200_000):
        line = spark.createDataFrame([(1, "wörd " * n), (2, None), (3, ""), (4, "..."), (5, ". b")], "id long, text string")
        began = time.perf_counter()
        got = tokens.spans(line, ["id"]).agg(F.count("*"), F.sum("k"), F.sum("char_start"), F.sum("char_end")).first()
        took.append(time.perf_counter() - began)
        assert tuple(got) == (n + 1, n * (n - 1) // 2, 5 * n * (n - 1) // 2 + 2, 5 * n * (n - 1) // 2 + 4 * n + 3)
    assert took[1] < 20


def test_pieces_are_cut_where_they_are(spark):
    df = spark.createDataFrame([(1, "añb🙂c", [0, 1, 4], [1, 3, 5]), (2, "x", None, None), (3, None, [0], [1])], "id int, text string, a array<int>, b array<int>").filter("id < 3")
    assert [r.cut for r in tokens.slices(df, "text", F.col("a"), F.col("b"), "cut").orderBy("id").collect()] == [["a", "ñb", "c"], None]


def test_settled_tables_are_read_from_the_shared_folder(spark):
    df = scratch.settled(spark.range(10), "numbers")
    assert df.count() == 10 and "Scan parquet" in plan(df).replace("FileScan parquet", "Scan parquet")


def test_buckets_grow_with_the_texts(spark):
    texts = spark.createDataFrame([("abcdé",), (None,), ("x" * 96,)], "text string")
    assert tables.buckets_for(texts, chars=10, least=2) == 11 and tables.buckets_for(texts) == 16
    assert tables.buckets_for(texts.filter("false"), chars=10, least=2) == 2
