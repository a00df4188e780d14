from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lmtables.llm import source_schedule, zstd_quality
from lmtables.session import checkpoint_root, stage
from tests.llm.test_near import brute

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """Documents, and what each stage makes of them."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF_DIR), name)
        out.append(docs)
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def first_of(rows, group):
    best = {}
    for key, text in rows:
        best[group(key, text)] = min(best.get(group(key, text), key), key)
    return sorted(best.values())


def test_columns(steps):
    assert all(df.columns == steps[0].columns for df in steps[:-1])
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_quality(spark, steps):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scores = zstd_quality.score(steps[0], zstd_quality.fit(steps[0], labels))
    assert sorted(texts(steps[1])) == sorted(texts(steps[0].join(scores.where("predicted = 1"), "doc_id", "left_semi")))
    clean = labels.where("quality = 1").join(steps[0], "doc_id", "left_semi")
    assert clean.join(steps[1], "doc_id", "left_semi").count() >= 0.95 * clean.count()


def test_exact_dedup(steps):
    kept = [k for k, _ in texts(steps[2])]
    assert sorted(kept) == first_of(texts(steps[1]), lambda k, t: re.sub(r"[\x20\x09-\x0D]+", " ", t or ""))


def test_near_dedup(steps):
    rows = texts(steps[2])
    component = {k: c for k, _, c in brute(rows, 5, 80)}
    assert sorted(k for k, _ in texts(steps[3])) == first_of(rows, lambda k, t: component[k])


def test_mixing(steps):
    plan = {r.id: (r.taken, r.size) for r in source_schedule.mix(steps[3]).taken().collect()}
    copies = Counter(k for k, _ in texts(steps[4]))
    for key, (taken, size) in plan.items():
        assert abs(copies[key] - (taken / size if size else 0)) <= 0.5
    words = sum(len((t or "").split()) for _, t in texts(steps[4]))
    assert abs(words / sum(t for t, _ in plan.values()) - 1) < 0.05


def test_packing(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = steps[5].collect()
    total = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in texts(steps[4]))
    sizes = Counter()
    for r in rows:
        sizes[r.sequence_id] += r.length
    assert sum(sizes.values()) == total and max(sizes.values()) <= 2048
    assert sum(2048 - s for s in sizes.values() if s & (s - 1)) < 0.01 * total


def test_repeated_null_and_empty_rows(spark):
    rows = [(1, "good words here", "en", "a", 9)] * 3 + [(None, "good  words here", "en", None, 9), (4, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    once = corpus_pipeline.exact_dedup(spark, docs, SF_DIR)
    assert sorted((r.doc_id, r.text) for r in once.collect()) == [(1, "good words here"), (4, None)]
    assert corpus_pipeline.near_dedup(spark, docs, SF_DIR).count() == 2
    assert corpus_pipeline.mixing(spark, docs, SF_DIR).columns == docs.columns
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs.limit(0), SF_DIR).isEmpty()


def test_near_dedup_keeps_only_what_its_result_reads(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    folder = Path(checkpoint_root(spark))
    before = set(folder.iterdir())
    assert 0 < corpus_pipeline.near_dedup(spark, docs, SF_DIR).count() < docs.count()
    assert sorted(p.name.split("-")[0] for p in set(folder.iterdir()) - before) == ["gone", "numbered"]
