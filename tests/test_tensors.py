"""Tensor algebra: the arithmetic cases of the exchange, and set forms against plain loops."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lmtables.functions import vectors as V
from lmtables.operators import shards, tensors
from lmtables.session import stage
from lmtables.sources.sinks import sink_metrics, sink_tensor_shards

TENSORS = {"embed": (3, 4), "layer.0": (5,), "norm": (2, 2)}


def tensor_rows(value, chunk: int = 3):
    """Rows of constant or callable content, cut into small chunks."""
    rows = []
    for name, shape in TENSORS.items():
        flat = [float(value(name, i) if callable(value) else value) for i in range(math.prod(shape))]
        for chunk_id, start in enumerate(range(0, len(flat), chunk)):
            rows.append((name, chunk_id, flat[start : start + chunk]))
    return rows


def model(spark, value):
    return spark.createDataFrame(tensor_rows(value), "name STRING, chunk_id INT, values ARRAY<FLOAT>")


def updates(spark, offsets, dtype="float32"):
    """Deltas of replicas that are the base minus an offset."""
    base = model(spark, 1.0)
    local = None
    for i, offset in enumerate(offsets, start=1):
        part = model(spark, 1.0 - offset).withColumn("update_id", F.lit(f"u{i}"))
        local = part if local is None else local.unionByName(part)
    return base, tensors.delta_tensors(base, local, dtype)


def scales_of(deltas, weights, **options):
    norms = tensors.delta_norms(deltas).withColumnRenamed("delta_norm", "verified_norm")
    rank = F.substring("update_id", 2, 5).cast("int")
    tokens = F.element_at(F.array(*[F.lit(w) for w in weights]), rank)
    return tensors.update_scales(norms.withColumn("merge_rank", rank).withColumn("num_tokens", tokens), **options)


def step(base, deltas, scales, momentum=None, **options):
    settings = {"outer_lr": 1.0, "outer_momentum": 0.0, "nesterov": False} | options
    return tensors.outer_step(base, tensors.merge_average(deltas, scales), momentum, **settings)


def flat(df, column):
    return np.concatenate([np.array(r[column]) for r in df.orderBy("name", "chunk_id").collect()])


def test_plain_average(spark):
    base, deltas = updates(spark, [0.1, 0.3])
    result = step(base, deltas, scales_of(deltas, [1, 1], weighting="uniform"))
    assert np.allclose(flat(result, "new_values"), 1.0 - 0.2, atol=1e-6)
    assert result.count() == base.count() > len(TENSORS)


def test_clip_to_a_tenth(spark):
    base, deltas = updates(spark, [10.0])
    norm = tensors.delta_norms(deltas).first().delta_norm
    assert norm == pytest.approx(10.0 * math.sqrt(21))
    result = step(base, deltas, scales_of(deltas, [1], weighting="uniform", max_delta_norm=norm / 10))
    assert np.allclose(flat(result, "new_values"), 0.0, atol=1e-5)


def test_two_rounds_of_nesterov(spark):
    options = {"outer_lr": 0.7, "outer_momentum": 0.9, "nesterov": True}
    base, first = updates(spark, [0.1])
    one = step(base, first, scales_of(first, [1]), **options)
    momentum = one.select("name", "chunk_id", F.col("momentum").alias("values"))
    _, second = updates(spark, [0.2])
    base_two = one.select("name", "chunk_id", F.col("new_values").alias("values"))
    two = step(base_two, second, scales_of(second, [1]), momentum, **options)
    assert np.allclose(flat(two, "momentum"), 0.29, atol=1e-5)
    assert np.allclose(flat(two, "new_values"), flat(one, "new_values") - 0.7 * 0.461, atol=1e-5)


def test_token_weights_and_clip_keep_the_denominator(spark):
    base, deltas = updates(spark, [1.0, 3.0])
    norm = math.sqrt(21)
    result = step(base, deltas, scales_of(deltas, [100, 300], weighting="tokens", max_delta_norm=norm))
    assert np.allclose(flat(result, "new_values"), 1.0 - (100 * 1.0 + 300 * 1.0) / 400, atol=1e-6)


def test_weights_must_be_positive(spark):
    _, deltas = updates(spark, [1.0])
    with pytest.raises(Exception, match="add up to nothing"):
        scales_of(deltas, [0], weighting="tokens").collect()
    with pytest.raises(ValueError):
        scales_of(deltas, [1], weighting="other")


def test_stored_momentum_is_rounded_and_the_step_is_not(spark):
    base, deltas = updates(spark, [0.1003])
    result = step(base, deltas, scales_of(deltas, [1]), momentum_dtype="bfloat16")
    assert np.allclose(flat(result, "new_values"), 1.0 - 0.1003, atol=1e-6)
    assert np.allclose(flat(result, "momentum"), V.round_to_dtype(np.array([0.1003]), "bfloat16")[0], atol=0)
    assert abs(flat(result, "momentum")[0] - 0.1003) > 1e-5


def test_momentum_of_unknown_tensors_is_dropped(spark):
    base, deltas = updates(spark, [0.5])
    old = spark.createDataFrame([("embed", 0, [1.0, 1.0, 1.0]), ("gone", 0, [9.0])], base.schema)
    result = step(base, deltas, scales_of(deltas, [1]), old, outer_momentum=0.5)
    values = {(r.name, r.chunk_id): r.momentum[0] for r in result.collect()}
    assert values["embed", 0] == pytest.approx(1.0) and values["embed", 1] == pytest.approx(0.5)
    assert ("gone", 0) not in values


def test_momentum_replay_over_many_rounds(spark):
    rng = random.Random(3)
    rows = [(name, c, r, [rng.gauss(0, 1) for _ in range(4)]) for name in "ab" for c in range(3) for r in range(40)]
    df = spark.createDataFrame(rows, "name STRING, chunk_id INT, round INT, values ARRAY<DOUBLE>").repartition(5)
    found = {(r.name, r.chunk_id, r.round): r.momentum for r in tensors.momentum_replay(df, 0.9).collect()}
    assert len(found) == len(rows)
    for name in "ab":
        for chunk in range(3):
            state = None
            for n, c, r, values in rows:
                if (n, c) == (name, chunk):
                    state = np.array(values) if state is None else 0.9 * state + np.array(values)
                    assert np.allclose(found[name, chunk, r], state)


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_momentum_replay_in_blocks(spark, block):
    rng = random.Random(6)
    rows = [(name, c, r * 5 - 20, [rng.gauss(0, 1) for _ in range(3)]) for name in ("a", None) for c in range(2) for r in range(rng.choice([1, 21, 40]))]
    df = spark.createDataFrame(rows, "name STRING, chunk_id INT, round INT, values ARRAY<DOUBLE>").repartition(5)
    key = lambda r: (str(r.name), r.chunk_id, r["round"])
    expected = {key(r): r.momentum for r in tensors.momentum_replay(df, 0.9).collect()}
    found = tensors.momentum_replay(df, 0.9, block_rounds=block).collect()
    assert len(found) == len(rows) and {key(r) for r in found} == set(expected)
    assert all(np.allclose(r.momentum, expected[key(r)], rtol=1e-12, atol=1e-12) for r in found)
    assert tensors.momentum_replay(df.limit(0), 0.9, block_rounds=block).isEmpty()


def test_a_long_history_is_spread_over_tasks(spark, monkeypatch):
    tasks = {}

    def counted(df, label):
        tasks[label] = df.select(F.spark_partition_id().alias("task")).distinct().count()
        return stage(df, label)

    monkeypatch.setattr(tensors, "stage", counted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(100_000).selectExpr("'a' AS name", "0 AS chunk_id", "id AS round", "array(1.0D, id % 7 - 3.0D) AS values")
    try:
        out = tensors.momentum_replay(df, 0.99, block_rounds=1_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks["within"] > 1
    values = np.array([r.momentum for r in out.orderBy("round").collect()])
    state, plain = np.zeros(2), []
    for r in range(100_000):
        state = 0.99 * state + np.array([1.0, r % 7 - 3.0])
        plain.append(state)
    assert np.allclose(values, plain, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("dtype,value,expected", [("float16", 70000.0, math.inf), ("float16", 1.0, 1.0), ("bfloat16", 3.0e38, 3.0e38), ("float32", 70000.0, 70000.0)])
def test_narrow_types(spark, dtype, value, expected):
    df = spark.createDataFrame([([value, -value],), (None,), ([],)], "values ARRAY<FLOAT>")
    rows = df.select(V.cast_dtype(F.col("values"), dtype).alias("v")).collect()
    assert rows[0].v == pytest.approx([expected, -expected], rel=4e-3)
    assert rows[1].v is None and rows[2].v == []


def test_unknown_type_raises(spark):
    with pytest.raises(ValueError, match="No rounding to"):
        V.cast_dtype(F.col("x"), "int8")


def test_rounding_is_to_even():
    ulp = 2.0**-7
    values = np.array([1 + ulp / 2, 1 + 3 * ulp / 2, np.nan, np.inf, -np.inf], dtype=np.float32)
    assert V.round_to_dtype(values, "bfloat16")[:2].tolist() == [1.0, 1 + 2 * ulp]
    assert np.isnan(V.round_to_dtype(values, "bfloat16")[2])
    assert V.round_to_dtype(values, "bfloat16")[3:].tolist() == [np.inf, -np.inf]


def test_verification_reports_the_first_problem(spark):
    base, deltas = updates(spark, [0.1, 0.2, 0.3, 0.4])
    shape = F.element_at(
        F.create_map(*[x for n, s in TENSORS.items() for x in (F.lit(n), F.array(F.lit(math.prod(s)).cast("bigint")))]), F.col("name")
    )
    deltas = deltas.drop("exact").where("NOT (update_id = 'u2' AND name = 'norm')")
    deltas = deltas.where("NOT (update_id = 'u3' AND name = 'embed' AND chunk_id = 3)").withColumn("shape", shape)
    spoiled = F.when(F.col("update_id") == "u4", F.transform("values", lambda _: F.lit(float("nan")).cast("float")))
    deltas = deltas.withColumn("values", F.coalesce(spoiled, F.col("values")))
    model_manifest = base.select("name", shape.alias("shape"), F.lit("r").alias("revision")).distinct()
    wanted = spark.createDataFrame([(f"u{i}", "r") for i in range(1, 6)], "update_id STRING, revision STRING")
    stats = tensors.tensor_stats(deltas)
    found = {r.update_id: r for r in tensors.verify_deltas(stats, model_manifest, wanted, strict=False).collect()}
    assert {k: r.problem for k, r in found.items()} == {"u1": None, "u2": "keys", "u3": "shape", "u4": "non_finite", "u5": "keys"}
    assert found["u1"].verified_norm == pytest.approx(0.1 * math.sqrt(21), rel=1e-6)
    assert found["u5"].tensor_count == 0
    with pytest.raises(Exception, match="Delta verification failed"):
        tensors.verify_deltas(stats, model_manifest, wanted, strict=True).collect()


def plain_shards(sizes, limit):
    out, shard, filled = [], 1, 0
    for index, size in enumerate(sizes):
        if index and filled + size > limit:
            shard, filled = shard + 1, 0
        filled += size
        out.append(shard)
    return out


def test_shard_plan(spark):
    rng = random.Random(5)
    rows = [(f"u{u}", f"t{t:04d}", rng.choice([10, 300, 900, 2500])) for u in range(12) for t in range(rng.randrange(1, 60))]
    df = spark.createDataFrame(rows, "update_id STRING, name STRING, tensor_bytes BIGINT").repartition(4)
    plan = shards.with_shard_names(shards.shard_plan(df, 1024), "delta")
    found = {(r.update_id, r.name): (r.shard_index, r.shard) for r in plan.collect()}
    for update in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == update)
        expected = plain_shards([r[2] for r in mine], 1024)
        assert [found[r[0], r[1]][0] for r in mine] == expected
        assert found[mine[0][0], mine[0][1]][1] == f"delta-00001-of-{max(expected):05d}"


def test_sink_writes_named_shards(spark, tmp_path):
    _, deltas = updates(spark, [0.1, 0.2], "bfloat16")
    rows = deltas.drop("exact")
    sized = rows.groupBy("update_id", "name").agg(F.sum(F.size("values") * 4).cast("bigint").alias("tensor_bytes"))
    path = str(tmp_path / "shards")
    for _ in range(2):
        sink_tensor_shards(rows, sized, path, prefix="delta", max_shard_bytes=64, metadata={"delta_sign": "base-minus-local"})
    back = spark.read.parquet(path)
    assert back.count() == rows.count()
    assert {r.shard for r in back.select("shard").distinct().collect()} == {"delta-00001-of-00002", "delta-00002-of-00002"}
    assert back.where("delta_sign <> 'base-minus-local'").isEmpty()
    with pytest.raises(ValueError, match="no tensors to write"):
        sink_tensor_shards(rows.limit(0), sized.limit(0), str(tmp_path / "none"), prefix="delta", max_shard_bytes=64)


def test_metrics_written_again(spark, tmp_path):
    schema, path = "run STRING, phase STRING, key STRING, value DOUBLE", str(tmp_path / "metrics")
    rows = [("r1", "train", "loss", 1.5), ("r1", "train", "total_parameters", 10.0), (None, "eval", "loss", 2.0)]
    for write in ("batch-0", "batch-0", "batch-1"):
        sink_metrics(spark.createDataFrame(rows, schema), path, write)
    sink_metrics(spark.createDataFrame([("r2", "eval", "loss", 1.0)], schema), path, "batch-1")
    sink_metrics(spark.createDataFrame([], schema), path, "batch-0")
    found = sorted(map(str, spark.read.parquet(path).select("run", "phase", "key", "value").collect()))
    assert len(found) == 7 and len(set(found)) == 4


def test_set_reconciliation(spark):
    rng = random.Random(8)
    model = {r: {f"t{i}": [rng.randrange(1, 4)] for i in range(rng.randrange(5, 30))} for r in ("r1", "r2")}
    have, asked = {}, {}
    for u in range(20):
        revision = rng.choice(["r1", "r2"])
        asked[f"u{u}"] = revision
        have[f"u{u}"] = dict(model[revision])
        for _ in range(rng.choice([0, 0, 1, 3])):
            have[f"u{u}"].pop(rng.choice(sorted(have[f"u{u}"])), None)
        for i in range(rng.choice([0, 0, 2])):
            have[f"u{u}"][f"x{i}"] = [1]
        if rng.random() < 0.3:
            have[f"u{u}"][rng.choice(sorted(have[f"u{u}"]))] = [9]
    asked["empty"], asked["lost"], have["stray"] = "r1", "nowhere", {"t0": [1]}
    rows = lambda sets, owner: spark.createDataFrame(
        [(o, asked.get(o, o), n, shape) for o, s in sets.items() for n, shape in s.items()],
        f"{owner} STRING, {'revision' if owner != 'revision' else 'unused'} STRING, name STRING, shape ARRAY<BIGINT>",
    )
    deltas, manifest = rows(have, "update_id"), rows(model, "revision").drop("unused")
    updates = spark.createDataFrame(list(asked.items()), "update_id STRING, revision STRING")
    diff = tensors.key_set_diff(deltas, manifest, updates)
    expected = {(u, n, "missing") for u, r in asked.items() for n in model.get(r, {}) if n not in have.get(u, {})}
    expected |= {(u, n, "unexpected") for u, s in have.items() for n in s if n not in model.get(asked.get(u), {})}
    got = [tuple(r) for r in diff.collect()]
    assert set(got) == expected and len(got) == len(expected)
    shaped = {(u, n) for u, s in have.items() for n, shape in s.items() if shape != model.get(asked.get(u), {}).get(n, shape)}
    assert {(r.update_id, r.name) for r in tensors.shape_mismatches(deltas, manifest).collect()} == shaped
    stored = deltas.select("update_id", "name", F.col("shape")[0].alias("stored_values")).where("name <> 't1'")
    short = {(u, "t1") for u, s in have.items() if "t1" in s and "t1" in model.get(asked.get(u), {})}
    assert {(r.update_id, r.name) for r in tensors.shape_mismatches(deltas, manifest, stored).collect()} == shaped | short


def test_equal_updates_are_not_expanded(spark):
    """With equal sets, names of the model are joined with an empty list of updates."""
    names = spark.range(50).selectExpr("concat('t', id) AS name", "'r' AS revision", "array(id) AS shape")
    deltas = names.crossJoin(spark.range(30).selectExpr("concat('u', id) AS update_id"))
    out = tensors.key_set_diff(deltas, names, deltas.select("update_id", "revision"))
    assert out.isEmpty()
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("FullOuter")
    assert tensors.shape_mismatches(deltas, names).isEmpty()
