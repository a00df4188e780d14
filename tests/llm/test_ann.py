from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lmtables.llm import graph_ann
from lmtables.llm.graph_ann import build_graph, nearest, robust_prune

SCHEMA = "vec_id long, embedding array<float>, score int, rank int"


def exact(rows, asked, k=20):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero([asked(v) for v in ids]):
        score = x @ x[i]
        order = [j for j in np.lexsort([ids, -score]) if j != i][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA)
    got = {}
    for r in nearest(df, F.col("vec_id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def recall(got, want):
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in found}) for q, found in want.items())
    return hits / sum(map(len, want.values()))


@pytest.mark.parametrize("scaled", [False, True])
def test_recall_over_shards(spark, monkeypatch, scaled):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 24)) * (rng.uniform(0.2, 3, (3000, 1)) if scaled else 1)
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    monkeypatch.setattr(graph_ann, "SHARD_ROWS", 800)
    got, want = run(spark, rows), exact(rows, lambda v: v % 20 == 0)
    assert recall(got, want) >= 0.95
    x = x.astype(np.float32).astype(float)
    for q, found in got.items():
        assert len(found) == 20 and found == sorted(found, key=lambda f: (-f[1], f[0])) and all(v != q for v, _ in found)
        assert np.allclose([s for _, s in found], [x[v] @ x[q] for v, _ in found])


@pytest.mark.parametrize("lengths", ["one", "tail"])
def test_recall_beside_very_long_vectors(spark, monkeypatch, lengths):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 24))
    if lengths == "one":
        x[7] *= 1e12 / np.linalg.norm(x[7])
    else:
        x *= np.exp(rng.normal(size=(2000, 1)) * 5)
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    monkeypatch.setattr(graph_ann, "SHARD_ROWS", 800)
    got, want = run(spark, rows), exact(rows, lambda v: v % 20 == 0)
    assert all(len(found) == 20 for found in got.values()) and len(got) == len(want)
    assert recall(got, want) >= 0.95


def test_copies_and_ties(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 8)).astype(np.float32)
    rows = [(i, x[0 if i % 3 == 0 else i % 40].tolist()) for i in range(900)]
    got, want = run(spark, rows), exact(rows, lambda v: v % 20 == 0)
    for q, found in want.items():
        assert [round(s, 5) for _, s in got[q]] == [round(s, 5) for _, s in found]
    same = [i for i in range(900) if i % 3 == 0 or i % 40 == 0]
    assert [v for v, _ in got[0]] == same[1:21]
    assert [v for v, _ in got[60]] == [v for v in same if v != 60][:20]


def test_what_takes_no_part(spark):
    good = [(20, [1.0, 0.0]), (1, [0.5, 1.0]), (2, [0.5, 0.0]), (3, [-1.0, 0.0])]
    bad = [(40, None), (60, [0.0, 0.0]), (80, [1.0, None]), (100, [float("nan"), 1.0]), (120, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    got = run(spark, good + bad + [(140, [1.0, 1.0, 1.0]), (160, [])] + good[:1])
    assert got == {20: [(1, 0.5), (2, 0.5), (3, -1.0)]}
    assert run(spark, []) == {}


def test_pruning_keeps_diverse_edges():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [5, 5]], float)
    distance = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    kept = robust_prune(distance, np.array([0]), np.array([[1, 2, 3, 4, -1, 0, 1]]), 3, 1.0)
    assert kept.tolist() == [[1, 3, 5]]


@pytest.mark.parametrize("size", [1, 2, 33, 34, 500])
def test_graphs_of_any_size_are_connected(size):
    graph, entry = build_graph(np.random.default_rng(4).normal(size=(size, 5)))
    seen, queue = {entry}, [entry]
    for node in queue:
        new = {int(n) for n in graph[node] if n < size} - seen
        seen |= new
        queue.extend(new)
    assert len(seen) >= 0.99 * size
    assert all(len(set(row[row < size])) == (row < size).sum() and i not in row for i, row in enumerate(graph))
