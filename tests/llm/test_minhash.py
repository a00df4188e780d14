from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from lmtables.llm import minhash
from lmtables.llm.heavy_light import jaccard_components
from lmtables.llm.minhash import EMPTY, PERMUTATIONS, SEGMENT, fingerprints, likeness, near_duplicates, runs, signatures, word_hashes

SCHEMA = "doc_id long, text string, id int, digest int, next int"


def shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_signature(text):
    values = runs(word_hashes(text.encode()))
    assert len(set(values.tolist())) == len(shingles(text))
    return signatures([values])[0].astype(">u4").tobytes().hex()


def by_hand(rows):
    order = sorted(((k is not None, k or 0, t or "") for k, t, *_ in rows))
    out = []
    for place, (known, key, text) in enumerate(order):
        after = order[(place + 1) % len(order)][2]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        prints = [plain_signature(t) for t in (text, edited, after)]
        near = [np.mean([a == b for a, b in zip(*(np.frombuffer(bytes.fromhex(p), ">u4") for p in (prints[0], q)))]) for q in prints[1:]]
        out.append((key if known else None, len(text), hashlib.sha256(edited.encode()).hexdigest(), *prints[:2], *near))
    return out


def check(spark, rows, ranges=None):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    got = [tuple(r) for r in fingerprints(df, ranges=ranges).collect()]
    assert sorted(got, key=repr) == sorted(by_hand(rows), key=repr)


@pytest.mark.parametrize("ranges", [1, 5, 60])
def test_ranges(spark, ranges):
    draw = random.Random(1)
    words = ["Ab", "c", "déf", "g\n", "hij ", "k\tl"]
    rows = [(i * 3, " ".join(draw.choices(words, k=draw.randrange(0, 60)))) for i in range(150)]
    draw.shuffle(rows)
    check(spark, rows, ranges)


def test_odd_rows(spark):
    check(spark, [(7, "one two three")], 3)
    check(spark, [(None, None), (1, ""), (2, " \n"), (3, "x" * 90_000), (4, "word " * 30_000), (5, "日本語" * 40), (6, "a b c d e f")], 4)
    check(spark, [(1, "a b c d e f g h")] * 40 + [(2, "i j k l m n o p q r")] * 3, 4)
    assert fingerprints(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_equal_texts_and_ties(spark):
    rows = [(1, "same text of some words here"), (1, "another text of some words here"), (9, "same text of some words here")]
    got = fingerprints(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA), ranges=2).collect()
    assert len(got) == 3 and len({r.fingerprint for r in got}) == 2


def test_signatures_are_plain_minima():
    draw = np.random.default_rng(2)
    sets = [draw.integers(0, 1 << 64, n, np.uint64) for n in (1, 0, SEGMENT, 3 * SEGMENT + 5, 7, 0)]
    found = signatures(sets)
    for values, row in zip(sets, found):
        assert (row == (signatures([values])[0])).all()
        if len(values):
            halves = np.minimum(*signatures(np.array_split(values, 2))) if len(values) > 1 else row
            assert (row == halves).all()
        else:
            assert (row == EMPTY).all()
    assert found.shape == (6, PERMUTATIONS)


def test_likeness_estimates_jaccard():
    draw = np.random.default_rng(4)
    for shared, own in [(300, 300), (900, 50), (10, 500)]:
        both = draw.integers(0, 1 << 64, shared, np.uint64)
        left, right = (np.concatenate([both, draw.integers(0, 1 << 64, own, np.uint64)]) for _ in range(2))
        jaccard = shared / (shared + 2 * own)
        assert abs(likeness(*(signatures([s]) for s in (left, right)))[0] - jaccard) < 0.15


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, fingerprints(docs).collect()), key=repr) == sorted(by_hand(rows), key=repr)


def classes_by_hand(rows, percent=80):
    sets = [shingles(t or "") for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for (key, _), g in zip(rows, group):
        if key is not None:
            least[g] = min(least.get(g, key), key)
    return sorted(((key, least.get(g)) for (key, _), g in zip(rows, group)), key=repr)


def classes(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(3)
    out = near_duplicates(df, **options)
    assert out.columns == ["doc_id", "class_id"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def varied(draw, words, changes):
    words = list(words)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"n{draw.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("large", [64, 3])
def test_classes_of_near_duplicates(spark, monkeypatch, large):
    monkeypatch.setattr(minhash, "LARGE", large)
    draw = random.Random(5)
    rows = []
    for _ in range(12):
        first = [f"w{draw.randrange(10**6)}" for _ in range(draw.choice([80, 150, 300]))]
        chain = list(first)
        for _ in range(6):
            chain[draw.randrange(len(chain))] = f"c{draw.randrange(10**6)}"
            rows += [(len(rows), varied(draw, chain, draw.randrange(0, 5)))]
    passage = [f"p{i}" for i in range(120)]
    rows += [(len(rows) + i, varied(draw, passage, 0) + " " + " ".join(f"u{i}x{j}" for j in range(60))) for i in range(40)]
    rows += [(500 + i, text) for i, (_, text) in enumerate(rows[:90:4])]
    draw.shuffle(rows)
    assert classes(spark, rows) == classes_by_hand(rows)


def test_classes_of_odd_rows(spark):
    same = "a b c d e f g"
    rows = [(None, same), (7, same.upper()), (7, " a  b c d e f g"), (3, "one two"), (2, "One\ttwo"), (9, None), (8, ""), (None, " \n"), (5, "word " * 20_000)]
    assert classes(spark, rows) == classes_by_hand(rows)
    assert classes(spark, [(4, None), (5, "")]) == [(4, 4), (5, 5)]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).isEmpty()


def test_classes_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((tuple(r) for r in near_duplicates(docs).collect()), key=repr)
    assert got == classes_by_hand(rows)


def test_classes_equal_the_exact_join(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    exact = {r.doc_id: r.component_id for r in jaccard_components(docs, words=5, percent=80).collect()}
    found = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    assert found == exact and any(k != v for k, v in found.items())
