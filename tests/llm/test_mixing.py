from __future__ import annotations

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lmtables.llm.source_schedule import golden_point, mix, schedule, word_count

DOCS = "doc_id long, text string, source string, size int, target int, row int"


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            out |= {s: level * weight[s] for s in open_}
            break
        out |= {s: float(most * sizes[s]) for s in full}
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return out


def check(rows, got, tolerance):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size(text)
    want, source_of = targets(sizes), {r[0]: r[2] for r in rows}
    words = {r[0]: size(r[1]) for r in rows}
    for r in got:
        source = source_of[r.id]
        assert (r.size, r.source_size) == (words[r.id], sizes[source])
        assert r.target == pytest.approx(want[source]) and 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= tolerance * target + 2, (source, taken[source], target)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], DOCS)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = mix(docs).taken().collect()
    assert len(got) == len(rows)
    check(rows, got, 0.01)
    again = mix(docs.repartition(5)).taken().collect()
    assert {(r.id, r.taken) for r in again} == {(r.id, r.taken) for r in got}


def test_hot_tiny_and_null_sources(spark):
    rows = [(i, "w " * (i % 40), "hot") for i in range(900)]
    rows += [(1000 + i, "a b c d e f g h i j", None) for i in range(60)] + [(2000, "word " * 20_000, "one long")]
    rows += [(3000, None, "empty"), (3001, "", "é"), (3002, "x", "tiny"), (3003, " \n", "hot")]
    check(rows, mix(table(spark, rows)).taken().collect(), 0.02)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c", "s")] * 4 + [(None, "x y", "s")] * 2
    got = mix(table(spark, rows)).taken().collect()
    assert len(got) == 6 and sum(r.taken for r in got) == pytest.approx(1.5 * 16, abs=1)
    assert mix(table(spark, [])).taken().isEmpty()
    assert mix(table(spark, [(1, None, None)])).taken().first().taken == 0


def test_pieces_and_slots_agree(spark):
    rows = [(i, "w " * (1 + i % 300), f"s{i % 3}") for i in range(300)]
    plan = mix(table(spark, rows), block_words=64, least_blocks=10)
    whole = plan.pieces.groupBy("row").agg(F.sum("words").alias("w")).join(plan.documents, "row")
    assert whole.where("w <> size").isEmpty() and whole.count() == 300
    blocks = plan.pieces.groupBy("place", "block").agg(F.sum("words").alias("w"))
    last = blocks.groupBy("place").agg(F.max("block").alias("last"))
    assert blocks.join(last, "place").where("block < last AND w <> 64").isEmpty()
    assert plan.slots.groupBy("place", "block", "epoch").count().where("count > 1").isEmpty()
    assert plan.slots.where("epoch > 1").isEmpty()


def test_schedule_is_even_everywhere(spark):
    """In every stretch of the schedule the sources have nearly their shares."""
    shares = [0.5, 0.3, 0.15, 0.05]
    sources = spark.createDataFrame([(i, 10_000, s * 4000) for i, s in enumerate(shares)], "place int, blocks long, wanted double")
    slots = schedule(spark, sources, 2.0).orderBy("slot").collect()
    assert [r.slot for r in slots] == list(range(4000))
    for begin in range(0, 4000, 250):
        for i, s in enumerate(shares):
            assert abs(sum(r.place == i for r in slots[begin : begin + 250]) - 250 * s) <= 4
    for i in range(4):
        ranks = [r.block for r in slots if r.place == i]
        assert ranks == list(range(len(ranks)))


def test_points_and_words(spark):
    ratio = (5**0.5 - 1) / 2
    rows = spark.createDataFrame([(i,) for i in (0, 1, 2, 1000, 2**21 + 5)], "i long")
    for r in rows.select("i", golden_point(F.col("i")).alias("p")).collect():
        assert abs(r.p / 2**42 - r.i * ratio % 1) < 1e-5
    texts = ["", None, " ", "a", "a\tb\x0bc ", " ", "a b", "\n a  b\r\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.n for r in df.orderBy("i").select(word_count(F.col("t")).alias("n")).collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
