from __future__ import annotations

import zlib

import pytest

from lmtables.llm import zstd_quality

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet"), spark.read.parquet(f"{SF_DIR}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return zstd_quality.fit(*tables)


def test_held_out_accuracy(tables, model):
    docs, labels = tables
    rows = zstd_quality.score(docs, model).join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.94
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.97
    by_score = sorted(held, key=lambda r: r.score)
    low, high = by_score[: len(bad) // 2], by_score[-len(good) // 2 :]
    assert sum(r.quality for r in low) / len(low) < 0.2 and sum(r.quality for r in high) / len(high) > 0.98


def test_labels_of_fold_zero_are_not_used(tables, model):
    docs, labels = tables
    other = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    assert zstd_quality.fit(docs, other) == model


def test_odd_texts(spark, model):
    rows = [(1, None, 0.5), (2, "", 0.5), (None, "text", 0.5), (4, "word " * 400_000, 0.5), (4, "word " * 400_000, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    got = sorted((tuple(r) for r in zstd_quality.score(docs, model).collect()), key=repr)
    assert len(got) == 5 and got[0][2:] == got[1][2:]
    assert [g[1] for g in got if g[0] is None] == [False]
    kept = zstd_quality.accept(docs, model)
    assert kept.columns == docs.columns
    accepted = {g[0] for g in got if g[3]}
    assert {r.doc_id for r in kept.collect()} == accepted
    assert zstd_quality.score(docs.limit(0), model).isEmpty()


@pytest.mark.parametrize("quality", [None, 0, 1, 7])
def test_without_labels_of_both_classes(spark, quality):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, quality) for i in range(20)], "doc_id long, quality int")
    model = zstd_quality.fit(docs, labels)
    scores = {r.score for r in zstd_quality.score(docs, model).collect()}
    assert len(scores) == 1 and 0 <= scores.pop() <= 1


def test_few_samples(spark):
    rows = [(i, ("GOOD words " if i % 2 else "$$$ bad ") * 5) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    assert zstd_quality.score(docs, zstd_quality.fit(docs, labels)).count() == 12
