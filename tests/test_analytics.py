"""Routing, losses, position ids, inventory, worker documents."""

from __future__ import annotations

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lmtables.operators import evaluation, routing, worker
from lmtables.operators import submissions as S
from lmtables.operators.packing import shift_targets
from lmtables.sources import tensors as source

LOGITS = "layer INT, token_id BIGINT, logits ARRAY<FLOAT>"


def test_balanced_router_gives_k(spark):
    rows = [(0, t, [1.0 if e == t % 4 or e == (t + 1) % 4 else 0.0 for e in range(4)]) for t in range(400)]
    load = routing.expert_load(spark.createDataFrame(rows, LOGITS), 2)
    assert routing.load_balance_loss(load, 4).first().load_balance_loss == pytest.approx(2.0, abs=1e-6)


def test_loss_equals_dense_arithmetic(spark):
    rng = np.random.default_rng(1)
    dense = rng.normal(size=(200, 6)).astype(np.float32)
    rows = [(3, t, [float(x) for x in row]) for t, row in enumerate(dense)]
    load = routing.expert_load(spark.createDataFrame(rows, LOGITS), 3)
    probs = np.exp(dense) / np.exp(dense).sum(1, keepdims=True)
    chosen = np.argsort(-probs, axis=1)[:, :3]
    share = np.stack([(chosen == e).mean(0) for e in range(6)], axis=1)
    expected = 6 * (share * probs.mean(0)).sum()
    assert routing.load_balance_loss(load, 6).first().load_balance_loss == pytest.approx(expected, rel=1e-5)


def test_ties_go_to_the_lower_expert_and_weights_add_up(spark):
    df = spark.createDataFrame([(0, 1, [0.5, 0.5, 0.5, 0.1])], LOGITS)
    slots = routing.topk_experts(df, 2).first().slots
    assert [s.expert for s in slots] == [0, 1] and sum(s.weight for s in slots) == pytest.approx(1.0)
    raw = routing.topk_experts(df, 2, renormalize=False).first().slots
    assert sum(s.weight for s in raw) < 0.9


def test_cross_entropy_shift_and_ignore(spark):
    rng = np.random.default_rng(2)
    logits, labels = rng.normal(size=(2, 5, 7)), [[1, 2, -100, 4, 5], [0, -100, -100, 6, 3]]
    rows = [(s, p, labels[s][p], [float(x) for x in logits[s, p]]) for s in range(2) for p in range(5)]
    df = spark.createDataFrame(rows, "seq_id BIGINT, pos INT, label INT, logits ARRAY<DOUBLE>")
    losses = [
        np.log(np.exp(logits[s, p]).sum()) - logits[s, p, labels[s][p + 1]]
        for s in range(2)
        for p in range(4)
        if labels[s][p + 1] != -100
    ]
    found = evaluation.cross_entropy(df).first()
    assert found.loss == pytest.approx(np.mean(losses)) and found.targets == len(losses)
    nothing = evaluation.cross_entropy(df.withColumn("label", F.lit(-100))).first()
    assert math.isnan(nothing.loss)


def test_perplexity_overflows_to_infinity(spark):
    df = spark.createDataFrame([(1000.0,), (0.0,)], "loss DOUBLE")
    assert [r[0] for r in df.select(evaluation.perplexity(F.col("loss"))).collect()] == [math.inf, 1.0]


def test_shift_targets(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([1],), ([],)], "labels ARRAY<INT>")
    assert [r[0] for r in df.select(shift_targets(F.col("labels"))).collect()] == [[2, 3], [], []]


def test_position_ids(spark):
    rows = [(1, i, m) for i, m in enumerate([0, 0, 1, 1, 0, 1])]
    df = spark.createDataFrame(rows, "s BIGINT, p BIGINT, m INT")
    assert [r.position_id for r in evaluation.position_ids(df, "s", "p", "m").orderBy("p").collect()] == [1, 1, 0, 1, 1, 2]
    last = evaluation.position_ids(df, "s", "p", "m", last=2).orderBy("p")
    assert [(r.p, r.position_id) for r in last.collect()] == [(4, 1), (5, 2)]


def test_default_model_has_the_published_parameters(spark):
    width, heads, head, shared, routed, experts, layers, vocab = 2048, 24, 128, 4096, 2048, 8, 24, 128_000
    per_layer = [
        ("attention", width * heads * head), ("attention", width * head), ("attention", width * head),
        ("attention", heads * head * width), ("moe", width * experts), ("moe", 3 * width * shared),
        ("norm", width), ("norm", width),
    ] + [("moe", 3 * width * routed)] * experts
    templates = spark.createDataFrame([(i, c, n) for i, (c, n) in enumerate(per_layer)], "slot INT, component STRING, numel BIGINT")
    layered = templates.select("component", "numel", F.explode(F.sequence(F.lit(1), F.lit(layers)))).select(
        "component", "numel", F.lit(None).cast("string").alias("tied_to")
    )
    heads_and_ends = spark.createDataFrame(
        [("embedding", vocab * width, None), ("embedding", vocab * width, "embed_tokens"), ("norm", width, None)],
        layered.schema,
    )
    found = {r.component: r.parameters for r in evaluation.parameter_inventory(layered.unionByName(heads_and_ends)).collect()}
    assert found == {
        None: 3_597_109_248, "embedding": 262_144_000, "attention": 314_572_800, "moe": 3_020_292_096, "norm": 100_352
    }


TENSOR = "update_id STRING, name STRING, chunk_id INT, shape ARRAY<BIGINT>, values ARRAY<FLOAT>"


def replicas(spark, value=0.5, names=("x", "y")):
    return spark.createDataFrame([("u1", n, 0, [2], [1.0 - value] * 2) for n in names], TENSOR)


def base_model(spark):
    return spark.createDataFrame([("", n, 0, [2], [1.0, 1.0]) for n in ("x", "y")], TENSOR)


def test_worker_documents_pass_validation(spark):
    deltas = worker.build_deltas(base_model(spark), replicas(spark), "bfloat16")
    summary = worker.delta_summary(deltas)
    assert summary.first().delta_norm_reported == pytest.approx(1.0) and summary.first().tensor_count == 2
    files = worker.delta_files(deltas, "bfloat16", 5)
    rows = [
        ("u1", "r", 4, "rev", "gpu 1", 5, 2, 3, 8, 1.5, "corpus", None),
        ("u1", "r", 3, "rev", "gpu 1", 5, 2, 3, 8, 1.5, "corpus", None),
    ]
    schema = (
        "update_id STRING, repo_id STRING, round INT, base_model_revision STRING, worker_id STRING, local_steps INT, "
        "batch_size INT, accumulation INT, block_size INT, train_loss DOUBLE, dataset_name STRING, dataset_config_name STRING"
    )
    states = spark.createDataFrame([("r", 4, "rev", "open")], "repo_id STRING, round INT, base_model_revision STRING, status STRING")
    made = worker.update_documents(spark.createDataFrame(rows, schema), summary, files, states, "2024-01-01", "bfloat16")
    (document,) = made.collect()
    body = json.loads(document.body)
    assert list(body) == sorted(body) and len(body) == 17
    assert body["num_tokens"] == 5 * 2 * 3 * 8 and body["worker_id"] == "gpu-1" and body["dataset_config_name"] is None
    assert body["delta_files"] == [f"swarm/updates/round-000004/gpu-1/u1/delta-0000{i}-of-00002.safetensors" for i in (1, 2)]
    assert document.path == "swarm/updates/round-000004/gpu-1/u1/metadata.json"
    parsed = made.withColumn("meta", F.from_json("body", S.METADATA_SCHEMA))
    reason = S.metadata_reason(F.col("body"), F.col("meta"), F.lit(4), F.lit("rev"))
    assert parsed.select(reason.alias("r")).first().r is None


def test_worker_checks(spark):
    with pytest.raises(Exception, match="no tensor to compare with z"):
        worker.build_deltas(base_model(spark), replicas(spark, names=("x", "z")), "float32").collect()
    with pytest.raises(Exception, match="infinite or not a number, in"):
        worker.build_deltas(base_model(spark), replicas(spark, float("nan")), "float32").collect()
    overflow = worker.build_deltas(base_model(spark), replicas(spark, 1e6), "float16")
    assert overflow.first()["values"][0] == math.inf


def test_shard_sources(spark):
    rows = [("s1", "x"), ("s1", "y"), ("s2", "y"), ("s3", "z")]
    df = spark.createDataFrame(rows, "shard STRING, name STRING")
    index = spark.createDataFrame([({"x": "s1", "z": "s3"},)], "weight_map MAP<STRING, STRING>")
    assert source.scan_tensor_shards(df, index).count() == 3 and source.scan_tensor_shards(df).count() == 4
    assert [r.name for r in source.duplicate_tensors(df).collect()] == ["y"]
    with pytest.raises(Exception, match="No tensor shards"):
        source.require_shards(df.limit(0)).collect()


def test_chunked_losses_equal_those_of_whole_rows(spark):
    rng = np.random.default_rng(8)
    rows = []
    for pos in range(60):
        scale = [1, 300, 5000][pos % 3]
        logits = (rng.normal(size=23) * scale).tolist()
        if pos % 5 == 0:
            logits[:7] = [float("-inf")] * 7
        rows.append((pos // 10, pos % 10, int(rng.integers(7, 23)) if pos % 4 else -100, logits))
    whole = spark.createDataFrame(rows, "seq_id long, pos int, label int, logits array<double>")
    cut = [(s, p, a, x[a:b]) for s, p, _, x in rows for a, b in zip([0, 1, 7, 20], [1, 7, 20, 23])]
    chunks = spark.createDataFrame(cut, "seq_id long, pos int, first int, logits array<double>")
    got = evaluation.token_losses_by_chunks(chunks, whole)
    want = {(r.seq_id, r.pos): r.nll for r in evaluation.token_losses(whole).collect()}
    found = {(r.seq_id, r.pos): r.nll for r in got.collect()}
    assert set(found) == set(want) and len(want) > 30
    assert all(abs(found[k] - want[k]) <= 1e-9 * max(1, abs(want[k])) for k in want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    # A target that no part has, and no finite logit at all.
    lone = spark.createDataFrame([(0, 0, 0, [1.0, 2.0]), (1, 0, 0, [float("-inf")])], chunks.schema)
    labels = spark.createDataFrame([(0, 1, 5), (1, 1, 0)], "seq_id long, pos int, label int")
    assert [r.nll for r in evaluation.token_losses_by_chunks(lone, labels).collect()] == [None, None]
