from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lmtables.llm import heavy_light
from lmtables.llm.heavy_light import Shape, boundary, jaccard_components

DOCS = "doc_id long, text string, key int, component int, sig int"


def shingle_set(text, words=4):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return frozenset()
    size = min(words, len(tokens))
    return frozenset(tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1))


def brute(rows, words=4, percent=85):
    sets = [shingle_set(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in lists[g])
        for g in s:
            lists[g].append(i)
        for j, o in shared.items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                parent[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(
        ((k, len(s), least.get(find(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=repr
    )


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], DOCS).repartition(3)
    out = jaccard_components(df, **options)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(900)
    passage = " ".join(word() for _ in range(60))
    rows = []
    for base in range(12):
        tokens = [word() for _ in range(rng.choice([3, 5, 8, 14, 25, 60, 150]))]
        for _ in range(rng.choice([2, 5, 12])):
            copy = list(tokens)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy).upper() if rng.random() < 0.2 else "\n".join(copy))
    rows += [passage + " " + " ".join(word() for _ in range(rng.randrange(1, 40))) for _ in range(40)]
    rows += ["same text here twice over"] * 30 + ["a", "A", "a b", "a b c", "a b c d", "a b c d e", "", " \n", None]
    rng.shuffle(rows)
    return [(i if i % 17 else None, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_other_words_and_threshold(spark):
    rows = corpus(3)
    assert run(spark, rows, words=5, percent=80) == brute(rows, 5, 80)


@pytest.mark.parametrize("limit", [0, 30])
def test_split_lists_and_any_boundary(spark, monkeypatch, limit):
    monkeypatch.setattr(heavy_light, "LONG_LIST", 5)
    monkeypatch.setattr(heavy_light, "boundary", lambda sizes, shape: limit)
    rows = corpus(4)
    assert run(spark, rows) == brute(rows)


def test_chain_of_a_large_group(spark):
    """Each text is linked to its neighbours only; all are one component."""
    words = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(words[5 * i : 5 * i + 100])) for i in range(60)]
    got = run(spark, rows)
    assert got == brute(rows) and {r[2] for r in got} == {0}


def test_long_text_and_repeated_rows(spark):
    text = " ".join(f"u{i}" for i in range(60_000))
    rows = [(5, text), (5, text), (4, text + " end"), (9, "x y z"), (8, "X  y\tz")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_boundary_follows_the_sizes():
    shape = Shape()
    assert boundary({}, shape) == 0
    small, large = boundary({5: 1000, 6: 1000, 9: 10}, shape), boundary({300: 1000}, shape)
    assert small >= 6 and large == 0
    assert heavy_light.shingles("B a", 4).tolist() == heavy_light.shingles("b A", 4).tolist()
    assert np.array_equal(heavy_light.shingles("", 4), np.empty(0, np.uint64))


def test_rounds_end_when_they_gain_little(spark, monkeypatch):
    """45 classes of copies, by the two places where their words differ, share all lists of what they copy: a round of
    representatives finds a few links and leaves nearly all pairs open."""
    rounds, pairs = [], heavy_light._representative_pairs
    monkeypatch.setattr(heavy_light, "REPRESENTATIVES", 1)
    monkeypatch.setattr(heavy_light, "_representative_pairs", lambda entries, n: rounds.append(n) or pairs(entries, n))
    rng, rows = random.Random(5), []
    for i in range(150):
        copy = [f"b{j}" for j in range(120)]
        for place in rng.sample(range(10), 2):
            copy[12 * place] = f"c{i}_{place}"
        rows.append((i, " ".join(copy)))
    assert run(spark, rows, most_left=0.75) == brute(rows) and rounds == [0]
