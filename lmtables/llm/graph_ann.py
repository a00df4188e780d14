"""Approximate nearest neighbours by inner product with a robust-pruned directed graph per shard."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lmtables.session import stage

SHARD_ROWS = 4096
# Lengths in a shard differ by this factor at most.
BAND = 16
BLOCK_ROWS = 256
DEGREE = 32
BUILD_WIDTH = 64
SEARCH_WIDTH = 96
ALPHA = 1.2
BATCH = 256


def beam_search(
    score: Callable[[np.ndarray, np.ndarray], np.ndarray], graph: np.ndarray, entry: int, count: int, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """Greedy best-first searches of ``count`` targets side by side: nodes (−1: none) and scores, ``width`` of each.

    ``score(targets, nodes)`` rates nodes for each target, higher is nearer. A search ends when all that its beam holds
    has been expanded.
    """
    size = len(graph)
    nodes, value = np.full((count, width), -1), np.full((count, width), -np.inf)
    done, seen = np.zeros((count, width), bool), np.zeros((count, size + 1), bool)
    seen[:, size] = True  # stands for "no neighbour"
    nodes[:, 0], seen[:, entry] = entry, True
    value[:, 0] = score(np.arange(count), np.full((count, 1), entry))[:, 0]
    active = np.arange(count)
    while len(active):
        waiting = np.where(done[active], -np.inf, value[active])
        best = waiting.argmax(axis=1)
        more = waiting[np.arange(len(active)), best] > -np.inf
        active, best = active[more], best[more]
        if not len(active):
            break
        done[active, best] = True
        near = graph[nodes[active, best]]
        fresh = ~seen[active[:, None], near]
        seen[active[:, None], near] = True
        rated = np.where(fresh, score(active, np.where(fresh, near, 0)), -np.inf)
        all_value = np.concatenate([value[active], rated], axis=1)
        top = np.argpartition(-all_value, width - 1, axis=1)[:, :width]
        value[active] = np.take_along_axis(all_value, top, axis=1)
        nodes[active] = np.take_along_axis(np.concatenate([nodes[active], near], axis=1), top, axis=1)
        done[active] = np.take_along_axis(np.concatenate([done[active], np.zeros(near.shape, bool)], axis=1), top, axis=1)
    return np.where(np.isfinite(value), nodes, -1), value


def robust_prune(distance: np.ndarray, rows: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each row the neighbours that stay: the nearest candidate, then the nearest that no kept one covers, and so on.

    A kept node covers a candidate if ``alpha`` times their squared distance is no more than the candidate's to the row.
    ``candidates`` may repeat nodes and hold −1; what stays is filled up with len(distance).
    """
    size = len(distance)
    none = (candidates < 0) | (candidates == size) | (candidates == rows[:, None])
    candidates = np.where(none, 0, candidates)
    own = np.where(none, np.inf, distance[rows[:, None], candidates])
    kept = np.full((len(rows), degree), size)
    each = np.arange(len(rows))
    for place in range(degree):
        best = own.argmin(axis=1)
        alive = np.isfinite(own[each, best])
        if not alive.any():
            break
        chosen = candidates[each, best]
        kept[alive, place] = chosen[alive]
        between = distance[chosen[:, None], candidates]
        own = np.where((alpha * between <= own) | (candidates == chosen[:, None]), np.inf, own)
    return kept


def build_graph(vectors: np.ndarray, seed: int = 7) -> tuple[np.ndarray, int]:
    """Neighbours of each node, filled up with len(vectors), and the entry node.

    Nodes are inserted in random order into a random graph: a greedy search from the entry proposes neighbours, pruning
    keeps diverse ones, and each of them gets a link back, pruned again where it has too many.
    """
    size = len(vectors)
    square = (vectors * vectors).sum(axis=1)
    # Bounded by the size of a shard; searches and pruning look distances up instead of computing them again.
    distance = np.maximum(square[:, None] + square[None, :] - 2 * vectors @ vectors.T, 0).astype(np.float32)
    entry = int(((vectors - vectors.mean(axis=0)) ** 2).sum(axis=1).argmin())
    if size <= DEGREE + 1:
        others = [[j for j in range(size) if j != i] + [size] * (DEGREE + 1 - size) for i in range(size)]
        return np.array(others, np.int32).reshape(size, DEGREE), entry
    rng = np.random.default_rng(seed)
    graph = np.full((size, DEGREE), size)
    graph[:, : DEGREE // 2] = (np.arange(size)[:, None] + rng.integers(1, size, (size, DEGREE // 2))) % size
    order = rng.permutation(size)
    for start in range(0, size, BATCH):
        rows = order[start : start + BATCH]
        found, _ = beam_search(lambda t, n: -distance[rows[t][:, None], n], graph, entry, len(rows), BUILD_WIDTH)
        proposed = np.concatenate([found, graph[rows]], axis=1)
        graph[rows] = robust_prune(distance, rows, proposed, DEGREE, ALPHA)
        source = np.repeat(rows, DEGREE)
        target = graph[rows].ravel()
        source, target = source[target < size], target[target < size]
        by_target = np.argsort(target, kind="stable")
        source, target = source[by_target], target[by_target]
        ends, first, many = np.unique(target, return_index=True, return_counts=True)
        back = np.full((len(ends), many.max()), size)
        back[np.repeat(np.arange(len(ends)), many), np.arange(len(target)) - np.repeat(first, many)] = source
        both = np.sort(np.concatenate([graph[ends], back], axis=1), axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = size
        both = np.sort(both, axis=1)
        over = (both < size).sum(axis=1) > DEGREE
        graph[ends[~over]] = both[~over][:, :DEGREE]
        if over.any():
            graph[ends[over]] = robust_prune(distance, ends[over], both[over], DEGREE, ALPHA)
    return graph.astype(np.int32), entry


def usable(vector: Column) -> Column:
    """Whether a vector takes part: no null, zero or non-finite ones."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~wrong & F.exists(vector, lambda x: x != 0)


def _index(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("first", ignore_index=True)
    vectors = np.stack(rows["vector"].to_numpy()).astype(np.float64)
    scaled = vectors / np.abs(vectors).max()
    scaled /= np.sqrt((scaled * scaled).sum(axis=1).max())
    # One more coordinate gives all vectors one length: then the nearest are those of largest inner product.
    extra = np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1), 0))
    graph, entry = build_graph(np.column_stack([scaled, extra]))
    sizes = rows["ids"].map(len).to_numpy(np.int64)
    return pd.DataFrame(
        {
            "dim": [rows["dim"].iloc[0]],
            "shard": [rows["shard"].iloc[0]],
            "vectors": [vectors.tobytes()],
            "ids": [np.concatenate(rows["ids"].to_numpy()).astype(np.int64).tobytes()],
            "sizes": [sizes.tobytes()],
            "graph": [graph.tobytes()],
            "entry": [entry],
        }
    )


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "dim": [rows["dim"].iloc[0]],
            "block": [rows["block"].iloc[0]],
            "query_ids": [rows["id"].to_numpy(np.int64).tobytes()],
            "query_vectors": [np.stack(rows["vector"].to_numpy()).astype(np.float64).tobytes()],
        }
    )


def _searched(k: int):
    def search(row) -> pd.DataFrame:
        vectors = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
        graph = np.frombuffer(row["graph"], np.int32).reshape(len(vectors), -1)
        sizes, ids = np.frombuffer(row["sizes"], np.int64), np.frombuffer(row["ids"], np.int64)
        first = np.cumsum(sizes) - sizes
        queries = np.frombuffer(row["query_vectors"]).reshape(-1, row["dim"])
        query_ids = np.frombuffer(row["query_ids"], np.int64)
        lengths = np.sqrt((queries * queries).sum(axis=1, keepdims=True))
        scaled = queries / np.where(np.isfinite(lengths) & (lengths > 0), lengths, 1)

        def score(targets: np.ndarray, nodes: np.ndarray) -> np.ndarray:
            return np.einsum("qnd,qd->qn", vectors[nodes], scaled[targets])

        width = min(SEARCH_WIDTH, len(vectors))
        nodes, _ = beam_search(score, graph, row["entry"], len(queries), width)
        out = []
        for query, own, found in zip(queries, query_ids, nodes):
            found = found[found >= 0]
            exact = (vectors[found] * query).sum(axis=1)
            many = sizes[found]
            places = np.repeat(first[found] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            near, value = ids[places], np.repeat(exact, many)
            near, value = near[near != own], value[near != own]
            best = np.lexsort([near, -value])[:k]
            out.append(pd.DataFrame({"query_id": own, "vec_id": near[best], "score": value[best]}))
        return pd.concat(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                yield pa.RecordBatch.from_pandas(search(row), preserve_index=False)

    return run


def build_index(rows: DataFrame, keep: int) -> DataFrame:
    """Graphs of all shards, one row each, from rows (id, vector, dim). All rows are indexed.

    Equal vectors are one node; the ``keep`` smallest of its ids stand for it, as ties go to smaller ids and no answer
    has more. Nodes are dealt to shards of about SHARD_ROWS by a hash of the vector, those of far other length than the
    median to shards of their own: a graph is built in vectors scaled by the longest of its shard, and beside one that
    is very long all others would be the same point.
    """
    rank = F.row_number().over(W.partitionBy("dim", "vector").orderBy("id"))
    ranked = rows.withColumn("rank", rank).where(F.col("rank") <= keep)
    nodes = ranked.groupBy("dim", "vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    nodes = stage(nodes, "nodes")
    largest = F.array_max(F.transform("vector", F.abs))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + (x / F.col("largest")) * (x / F.col("largest")))
    sized = nodes.withColumn("largest", largest).withColumn("length", F.log("largest") + F.log(squares) / 2)
    middle = sized.groupBy("dim").agg(F.percentile_approx("length", 0.5).alias("middle"))
    banded = sized.join(middle, "dim").withColumn("band", F.round((F.col("length") - F.col("middle")) / math.log(BAND)).cast("long"))
    dims = banded.groupBy("dim", "band").agg(F.ceil(F.count("*") / SHARD_ROWS).alias("shards"))
    shard = F.col("band") * (1 << 32) + F.pmod(F.xxhash64("vector"), F.col("shards"))
    dealt = banded.join(dims, ["dim", "band"]).select(
        "dim", shard.cast("long").alias("shard"), "vector", "ids", F.get("ids", F.lit(0)).alias("first")
    )
    schema = "dim int, shard long, vectors binary, ids binary, sizes binary, graph binary, entry int"
    # Building takes far longer than its bytes suggest, so partitions go by shards and are not coalesced by size.
    tasks = dims.agg(F.sum("shards")).first()[0] or 1
    dealt = dealt.repartition(2 * tasks, "dim", "shard")
    return stage(dealt.groupBy("dim", "shard").applyInPandas(_index, schema), "graphs")


def nearest(vectors: DataFrame, queries: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = 20) -> DataFrame:
    """Approximate ``k`` nearest neighbours: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (inner product).

    ``queries`` is a condition on the rows; candidates are all rows but the query's own, of the same dimension. Every
    block of queries meets every shard in a task of its own, whose beam search proposes neighbours; scores are taken
    from the original vectors in double precision, ties go to the smaller id. Vectors that are null, zero or hold null
    or non-finite components and rows without an id take no part; of rows that repeat an id the smallest vector does.
    """
    held = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), queries.alias("asked"))
    rows = held.where(F.col("id").isNotNull() & usable(F.col("vector"))).groupBy("id").agg(
        F.min("vector").alias("vector"), F.max("asked").alias("asked")
    )
    rows = stage(rows.withColumn("dim", F.size("vector")), "vectors")
    graphs = build_index(rows.select("id", "vector", "dim"), k + 1)
    asked = rows.where("asked")
    blocks = asked.groupBy("dim").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("blocks"))
    dealt = asked.join(blocks, "dim").select("dim", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("block"), "id", "vector")
    packed = stage(
        dealt.groupBy("dim", "block").applyInPandas(_block, "dim int, block long, query_ids binary, query_vectors binary"),
        "blocks",
    )
    # Each block goes once to each shard, so a task holds one graph and one block.
    shards = graphs.groupBy("dim").agg(F.collect_list("shard").alias("shards"))
    sent = packed.join(shards, "dim").withColumn("shard", F.explode("shards")).drop("shards")
    met = sent.join(graphs, ["dim", "shard"])
    found = met.mapInArrow(_searched(k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
