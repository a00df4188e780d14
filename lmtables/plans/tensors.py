"""Tensor table queries: shards, snapshots, deltas, norms, merges, momentum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.functions import sizes
from lmtables.functions import vectors as V
from lmtables.operators import shards, tensors
from lmtables.plans.registry import query
from lmtables.plans.tables import Inputs, with_tables
from lmtables.session import stage
from lmtables.sources import tensors as source

WIDTH = 64
MAX_NORM = 20.0
LEARNING_RATE = 0.7
MOMENTUM = 0.9
SHARD_BYTES = 16_384


def fixed_sql(values: str) -> str:
    return (
        f"array_to_string(list_transform({values}, lambda e: CAST(CAST(floor(CAST(e AS DOUBLE) * 1000000 + 0.5) AS BIGINT) "
        "AS STRING)), ' ')"
    )


DELTAS_SQL = (
    "SELECT l.update_id, l.name, l.chunk_id, list_transform(list_zip(b.values, l.values), lambda p: p[1] - p[2]) AS values "
    'FROM "local" AS l JOIN base AS b ON b.name = l.name AND b.chunk_id = l.chunk_id'
)
ELEMENTS_SQL = (
    "SELECT update_id, name, chunk_id, unnest(values) AS v, unnest(range(len(values))) AS i FROM deltas"
)
NORMS_SQL = "SELECT update_id, sqrt(sum(CAST(v AS DOUBLE) * CAST(v AS DOUBLE))) AS norm FROM elements GROUP BY update_id"
SCALES_SQL = (
    "SELECT update_id, w, w * 1000.0 * CASE WHEN norm > {m} THEN {m} / norm ELSE 1 END / 6000.0 AS factor "
    "FROM norms JOIN (SELECT DISTINCT update_id, CAST(w AS DOUBLE) AS w FROM \"local\" WHERE w < 4) AS u USING (update_id)"
).format(m=MAX_NORM)
AVERAGE_SQL = (
    "SELECT e.name, e.chunk_id, e.i, sum(CAST(e.v AS DOUBLE) * s.factor ORDER BY e.update_id) AS g FROM elements AS e "
    "JOIN scales AS s USING (update_id) GROUP BY e.name, e.chunk_id, e.i"
)
STEPPED_SQL = (
    "SELECT a.name, a.chunk_id, a.i, g, CASE WHEN o.m IS NULL THEN g ELSE {mu} * o.m + g END AS m, b.v AS p "
    "FROM average AS a JOIN (SELECT name, chunk_id, unnest(values) AS v, unnest(range(len(values))) AS i FROM base) AS b "
    "USING (name, chunk_id, i) LEFT JOIN (SELECT name, chunk_id, unnest(values) AS m, unnest(range(len(values))) AS i "
    "FROM averages WHERE round = 0 AND label_even) AS o USING (name, chunk_id, i)"
).format(mu=f"CAST({MOMENTUM} AS DOUBLE)").replace(
    "FROM averages WHERE round = 0 AND label_even",
    "FROM averages WHERE round = 0 AND name IN ('block.0.weight', 'block.2.weight', 'block.4.weight')",
)
CHAIN = {
    "deltas": DELTAS_SQL,
    "elements": ELEMENTS_SQL,
    "norms": NORMS_SQL,
    "scales": SCALES_SQL,
    "average": AVERAGE_SQL,
}


def deltas(inputs: Inputs, dtype: str = "float32") -> DataFrame:
    return tensors.delta_tensors(inputs("base"), inputs("local"), dtype)


def manifest(tensor_rows: DataFrame, *owner: str) -> DataFrame:
    return tensor_rows.groupBy(*owner, "name").agg(
        F.array(F.count("*"), F.lit(WIDTH).cast("bigint")).alias("shape")
    )


def model_manifest(inputs: Inputs) -> DataFrame:
    return manifest(inputs("base"), "revision")


def delta_manifest(inputs: Inputs) -> DataFrame:
    return manifest(inputs("local"), "update_id", "revision")


def verified(inputs: Inputs, dtype: str = "float32") -> DataFrame:
    manifest_rows = delta_manifest(inputs)
    payload = deltas(inputs, dtype).join(manifest_rows.select("update_id", "name", "shape"), ["update_id", "name"])
    return tensors.verify_deltas(
        tensors.tensor_stats(payload),
        model_manifest(inputs),
        manifest_rows.select("update_id", "revision").distinct(),
        strict=False,
    )


def update_rows(inputs: Inputs) -> DataFrame:
    """Updates that verification accepts, with their place, tokens and norms."""
    return verified(inputs).where("problem IS NULL").select(
        "update_id",
        "verified_norm",
        F.substring("update_id", 8, 1).cast("int").alias("merge_rank"),
        (F.substring("update_id", 8, 1).cast("bigint") * 1000).alias("num_tokens"),
    )


def scales(inputs: Inputs) -> DataFrame:
    return stage(tensors.update_scales(update_rows(inputs), weighting="tokens", max_delta_norm=MAX_NORM), "scales")


def averages(inputs: Inputs) -> DataFrame:
    return tensors.merge_average(deltas(inputs), scales(inputs))


@query(
    "scan_tensor_shards",
    with_tables(
        ["sharded"],
        "SELECT name, chunk_id, shard FROM sharded WHERE shard IN ('model-00001-of-00003.safetensors', "
        "'model-00003-of-00003.safetensors')",
    ),
)
def _scan(inputs: Inputs) -> DataFrame:
    rows = inputs("sharded")
    index = rows.where("label % 3 <> 1 AND NOT (label = 3 AND shard LIKE '%00002-of%')").groupBy().agg(
        F.map_from_entries(F.collect_set(F.struct("name", "shard"))).alias("weight_map")
    )
    return source.scan_tensor_shards(rows, index).select("name", "chunk_id", "shard")


@query(
    "distinct_shards",
    with_tables(["sharded"], "SELECT DISTINCT shard FROM sharded WHERE NOT (label = 3 AND shard LIKE '%00002-of%')"),
)
def _distinct(inputs: Inputs) -> DataFrame:
    rows = inputs("sharded").where("NOT (label = 3 AND shard LIKE '%00002-of%')")
    index = rows.groupBy().agg(F.map_from_entries(F.collect_set(F.struct("name", "shard"))).alias("weight_map"))
    return source.distinct_shards(index)


@query(
    "duplicate_tensor_check",
    with_tables(
        ["sharded"],
        "SELECT name, count(DISTINCT shard) AS shards FROM sharded GROUP BY name HAVING count(DISTINCT shard) > 1",
    ),
)
def _duplicates(inputs: Inputs) -> DataFrame:
    return source.duplicate_tensors(inputs("sharded"))


@query(
    "tensor_lookup",
    with_tables(
        ["base"],
        f"SELECT name, chunk_id, {fixed_sql('values')} AS content, true AS found FROM base "
        "WHERE name IN ('block.2.weight', 'block.5.weight') UNION ALL SELECT 'block.99.weight', NULL, NULL, false",
    ),
)
def _lookup(inputs: Inputs) -> DataFrame:
    base = inputs("base")
    wanted = base.selectExpr("explode(array(name, 'block.99.weight')) AS name").where(
        "name IN ('block.2.weight', 'block.5.weight', 'block.99.weight')"
    )
    found = source.lookup_tensors(base, ["block.2.weight", "block.5.weight", "block.99.weight"]).select(
        "name", "chunk_id", V.fixed_point(F.col("values")).alias("content"), F.lit(True).alias("found")
    )
    absent = source.absent_tensors(base, wanted).select(
        "name",
        F.lit(None).cast("int").alias("chunk_id"),
        F.lit(None).cast("string").alias("content"),
        F.lit(False).alias("found"),
    )
    return found.unionByName(absent)


GREEDY_SQL = (
    "SELECT update_id, name, tensor_bytes, place, 1 AS shard_index, tensor_bytes AS filled FROM numbered WHERE place = 1 "
    "UNION ALL SELECT n.update_id, n.name, n.tensor_bytes, n.place, CASE WHEN g.filled + n.tensor_bytes > {0} "
    "THEN g.shard_index + 1 ELSE g.shard_index END, CASE WHEN g.filled + n.tensor_bytes > {0} THEN n.tensor_bytes "
    "ELSE g.filled + n.tensor_bytes END FROM greedy AS g JOIN numbered AS n ON n.update_id = g.update_id "
    "AND n.place = g.place + 1"
).format(SHARD_BYTES)


@query(
    "shard_plan",
    with_tables(
        ["local"],
        "SELECT update_id, name, tensor_bytes, CAST(shard_index AS INT) AS shard_index, "
        "'delta-' || lpad(CAST(shard_index AS STRING), 5, '0') || '-of-' || "
        "lpad(CAST(max(shard_index) OVER (PARTITION BY update_id) AS STRING), 5, '0') AS shard FROM greedy",
        {
            "sized": 'SELECT update_id, name, CAST(count(*) * 64 * 4 AS BIGINT) AS tensor_bytes FROM "local" '
            "GROUP BY update_id, name",
            "numbered": "SELECT *, row_number() OVER (PARTITION BY update_id ORDER BY name) AS place FROM sized",
            "greedy": GREEDY_SQL,
        },
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def _plan(inputs: Inputs) -> DataFrame:
    sized = delta_manifest(inputs).withColumn("tensor_bytes", sizes.tensor_bytes(F.col("shape"), F.lit("float32")))
    plan = shards.with_shard_names(shards.shard_plan(sized, SHARD_BYTES), "delta")
    return plan.select("update_id", "name", "tensor_bytes", "shard_index", "shard")


@query(
    "snapshot_at_revision",
    with_tables(
        ["checkpoint_files"],
        "SELECT revision, path FROM checkpoint_files WHERE revision = 'rev-7' AND NOT starts_with(path, 'swarm/')",
    ),
)
def _snapshot(inputs: Inputs) -> DataFrame:
    return source.snapshot_at_revision(inputs("checkpoint_files"), "rev-7")


@query(
    "checkpoint_complete",
    with_tables(
        ["checkpoint_files"],
        "SELECT revision, list_contains(l, 'config.json') AND list_contains(l, 'tokenizer_config.json') AND "
        "list_contains(l, 'modeling.py') AND (list_contains(l, 'model.safetensors') OR "
        "list_contains(l, 'model.safetensors.index.json')) AS complete FROM (SELECT revision, list(path) AS l "
        "FROM checkpoint_files GROUP BY revision) AS f",
    ),
)
def _complete(inputs: Inputs) -> DataFrame:
    return source.checkpoint_complete(inputs("checkpoint_files"), "modeling.py")


@query(
    "delta_tensors",
    with_tables(
        ["base", "local"],
        f"SELECT update_id, name, chunk_id, {fixed_sql('values')} AS delta FROM deltas",
        {"deltas": DELTAS_SQL},
    ),
)
def _deltas(inputs: Inputs) -> DataFrame:
    return deltas(inputs).select("update_id", "name", "chunk_id", V.fixed_point(F.col("values")).alias("delta"))


@query(
    "vector_l2_terms",
    with_tables(
        ["base", "local"],
        f"SELECT update_id, name, chunk_id, {fixed_sql('scaled')} AS scaled, {fixed_sql('added')} AS added, "
        "round(list_sum(list_transform(values, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE))), 6) AS squares FROM ("
        "SELECT *, list_transform(values, lambda v: CAST(v AS DOUBLE) * 0.25) AS scaled, list_transform(values, lambda v: "
        "CAST(v AS DOUBLE) * 0.5 + CAST(v AS DOUBLE)) AS added FROM deltas) AS d",
        {"deltas": DELTAS_SQL},
    ),
)
def _terms(inputs: Inputs) -> DataFrame:
    wide = F.col("values").cast("array<double>")
    return deltas(inputs).select(
        "update_id",
        "name",
        "chunk_id",
        V.fixed_point(V.scale(wide, F.lit(0.25))).alias("scaled"),
        V.fixed_point(V.axpy(wide, F.lit(0.5), wide)).alias("added"),
        F.round(V.squared_norm(F.col("values")), 6).alias("squares"),
    )


@query(
    "missing_base_tensors",
    with_tables(
        ["base", "local"],
        'SELECT DISTINCT name FROM "local" WHERE name NOT IN (SELECT name FROM base WHERE label NOT IN (2, 4))',
    ),
)
def _missing(inputs: Inputs) -> DataFrame:
    return tensors.missing_base_tensors(inputs("base").where("label NOT IN (2, 4)"), inputs("local"))


@query(
    "first_five_names",
    with_tables(
        ["base", "local"],
        "SELECT update_id, array_to_string(list(name ORDER BY name)[1:5], ',') AS names, "
        "CAST(count(*) AS BIGINT) AS name_count FROM (SELECT DISTINCT update_id, name FROM \"local\" "
        "WHERE name NOT IN (SELECT name FROM base WHERE label < 3)) AS m GROUP BY update_id",
    ),
)
def _first_names(inputs: Inputs) -> DataFrame:
    lacking = inputs("local").join(inputs("base").where("label < 3").select("name"), "name", "left_anti")
    return tensors.first_names(lacking, ["update_id"]).select(
        "update_id", F.array_join("names", ",").alias("names"), "name_count"
    )


@query(
    "key_set_diff",
    with_tables(
        ["base", "local"],
        "SELECT u.update_id, m.name, 'missing' AS kind FROM (SELECT DISTINCT update_id FROM \"local\") AS u, "
        "(SELECT DISTINCT name FROM base WHERE label <> 5) AS m WHERE NOT EXISTS (SELECT 1 FROM \"local\" AS l "
        "WHERE l.update_id = u.update_id AND l.name = m.name) UNION ALL SELECT DISTINCT update_id, name, 'unexpected' "
        "FROM \"local\" WHERE name NOT IN (SELECT name FROM base WHERE label <> 5)",
    ),
)
def _key_diff(inputs: Inputs) -> DataFrame:
    model = manifest(inputs("base").where("label <> 5"), "revision")
    have = delta_manifest(inputs)
    return tensors.key_set_diff(have, model, have)


@query(
    "shape_mismatch",
    with_tables(
        ["base", "local"],
        "SELECT l.update_id, l.name, CAST(l.n AS BIGINT) AS rows_found, CAST(b.n AS BIGINT) AS rows_expected FROM ("
        "SELECT update_id, name, count(*) AS n FROM \"local\" WHERE NOT (w = 2 AND label = 6 AND chunk_id % 2 = 0) "
        "GROUP BY update_id, name) AS l JOIN (SELECT name, count(*) AS n FROM base GROUP BY name) AS b USING (name) "
        "WHERE l.n <> b.n",
    ),
)
def _shapes(inputs: Inputs) -> DataFrame:
    local = inputs("local").where("NOT (w = 2 AND label = 6 AND chunk_id % 2 = 0)")
    have = manifest(local, "update_id", "revision")
    bad = tensors.shape_mismatches(have, model_manifest(inputs), tensors.stored_sizes(local, ["update_id"]))
    return bad.select(
        "update_id",
        "name",
        F.col("shape")[0].alias("rows_found"),
        F.col("expected_shape")[0].alias("rows_expected"),
    )


@query(
    "delta_norm",
    with_tables(
        ["base", "local"], "SELECT update_id, round(norm, 6) AS delta_norm FROM norms", CHAIN
    ),
)
def _norm(inputs: Inputs) -> DataFrame:
    return tensors.delta_norms(deltas(inputs, "bfloat16"), column="exact").select(
        "update_id", F.round("delta_norm", 6).alias("delta_norm")
    )


ROUNDED_SQL = (
    "CASE WHEN v = 0 THEN 0.0 ELSE round_even(CAST(v AS DOUBLE) / pow(2.0, greatest(floor(log2(abs(CAST(v AS DOUBLE)))), "
    "{low}) - {bits}), 0) * pow(2.0, greatest(floor(log2(abs(CAST(v AS DOUBLE)))), {low}) - {bits}) END"
)
BFLOAT_SQL = ROUNDED_SQL.format(low=-126, bits=7)
HALF_SQL = ROUNDED_SQL.format(low=-14, bits=10)


@query(
    "verified_norm",
    with_tables(
        ["base", "local"],
        f"SELECT update_id, round(sqrt(sum(r * r)), 6) AS verified_norm, CAST(count(DISTINCT name) AS BIGINT) AS tensor_count, "
        "CASE WHEN count(DISTINCT name) < 10 THEN 'keys' END AS problem "
        f"FROM (SELECT *, {BFLOAT_SQL} AS r FROM elements) AS e GROUP BY update_id",
        CHAIN,
    ),
)
def _verified(inputs: Inputs) -> DataFrame:
    return verified(inputs, "bfloat16").withColumn("verified_norm", F.round("verified_norm", 6))


@query(
    "cast_dtype",
    with_tables(
        ["base", "local"],
        "SELECT update_id, name, chunk_id, "
        "array_to_string(list(CAST(CAST(floor({b} * 16777216 + 0.5) AS BIGINT) AS STRING) ORDER BY i), ' ') AS bfloat16, "
        "array_to_string(list(CAST(CAST(floor({h} * 16777216 + 0.5) AS BIGINT) AS STRING) ORDER BY i), ' ') AS float16 "
        "FROM elements GROUP BY update_id, name, chunk_id".format(b=BFLOAT_SQL, h=HALF_SQL),
        CHAIN,
    ),
)
def _cast(inputs: Inputs) -> DataFrame:
    def exact(values):
        scaled = F.transform(values, lambda v: F.floor(v.cast("double") * F.lit(16777216.0) + F.lit(0.5)).cast("string"))
        return F.array_join(scaled, " ")

    narrow = deltas(inputs).select(
        "update_id",
        "name",
        "chunk_id",
        V.cast_dtype(F.col("exact"), "bfloat16").alias("b"),
        V.cast_dtype(F.col("exact"), "float16").alias("h"),
    )
    return narrow.select(
        "update_id", "name", "chunk_id", exact(F.col("b")).alias("bfloat16"), exact(F.col("h")).alias("float16")
    )


@query(
    "finite_check",
    with_tables(
        ["base", "local"],
        "SELECT DISTINCT update_id, name, chunk_id FROM (SELECT update_id, name, chunk_id, CASE WHEN chunk_id % 50 = 7 AND "
        "update_id = 'update-3' THEN CAST('nan' AS FLOAT) WHEN chunk_id % 50 = 9 AND update_id = 'update-1' "
        "THEN CAST('infinity' AS FLOAT) ELSE v END AS v FROM elements) AS e WHERE NOT isfinite(v)",
        CHAIN,
    ),
)
def _finite(inputs: Inputs) -> DataFrame:
    spoiled = F.when(
        F.expr("chunk_id % 50 = 7 AND update_id = 'update-3'"),
        F.concat("values", F.array(F.lit(float("nan")).cast("float"))),
    ).when(
        F.expr("chunk_id % 50 = 9 AND update_id = 'update-1'"),
        F.concat("values", F.array(F.lit(float("inf")).cast("float"))),
    ).otherwise(F.col("values"))
    return tensors.finite_report(deltas(inputs).withColumn("values", spoiled))


@query(
    "tensor_count",
    with_tables(
        ["local"], 'SELECT update_id, count(DISTINCT name) AS tensor_count FROM "local" GROUP BY update_id'
    ),
)
def _count(inputs: Inputs) -> DataFrame:
    return tensors.tensor_counts(inputs("local"))


@query(
    "clip_scale",
    with_tables(
        ["base", "local"],
        "SELECT update_id, round(CASE WHEN norm > {0} THEN {0} / norm ELSE 1 END, 6) AS clip FROM norms".format(MAX_NORM),
        CHAIN,
    ),
)
def _clip(inputs: Inputs) -> DataFrame:
    return tensors.delta_norms(deltas(inputs)).select(
        "update_id", F.round(tensors.clip_scale(F.col("delta_norm"), MAX_NORM), 6).alias("clip")
    )


@query(
    "merge_join_updates",
    with_tables(
        ["base", "local"],
        "SELECT d.update_id, d.name, d.chunk_id, round(s.factor, 6) AS factor, len(b.values) AS width FROM deltas AS d "
        "JOIN scales AS s USING (update_id) JOIN base AS b ON b.name = d.name AND b.chunk_id = d.chunk_id",
        CHAIN,
    ),
)
def _merge_join(inputs: Inputs) -> DataFrame:
    base = inputs("base").select("name", "chunk_id", F.size("values").cast("bigint").alias("width"))
    return (
        deltas(inputs)
        .join(scales(inputs), "update_id")
        .join(base, ["name", "chunk_id"])
        .select("update_id", "name", "chunk_id", F.round("factor", 6).alias("factor"), "width")
    )


def joined_sql(value: str, source_table: str) -> str:
    return (
        f"SELECT name, chunk_id, string_agg(CAST(CAST(floor(CAST({value} AS DOUBLE) * 1000000 + 0.5) AS BIGINT) AS STRING), ' ' ORDER BY i) "
        f"AS content FROM {source_table} GROUP BY name, chunk_id"
    )


@query("merge_average", with_tables(["base", "local"], joined_sql("g", "average"), CHAIN))
def _average(inputs: Inputs) -> DataFrame:
    return averages(inputs).select("name", "chunk_id", V.fixed_point(F.col("average")).alias("content"))


def old_momentum(inputs: Inputs) -> DataFrame:
    """History for three tensors of ten, and for one name the model does not have."""
    known = inputs("averages").where(
        "round = 0 AND name IN ('block.0.weight', 'block.2.weight', 'block.4.weight')"
    )
    stray = known.where("name = 'block.0.weight'").withColumn("name", F.lit("removed.weight"))
    return known.unionByName(stray)


def stepped(inputs: Inputs) -> DataFrame:
    return tensors.outer_step(
        inputs("base"),
        averages(inputs),
        old_momentum(inputs),
        outer_lr=LEARNING_RATE,
        outer_momentum=MOMENTUM,
        nesterov=True,
    )


STEP_CHAIN = CHAIN | {"stepped": STEPPED_SQL}


@query("momentum_join", with_tables(["base", "local", "averages"], joined_sql("CAST(m AS FLOAT)", "stepped"), STEP_CHAIN))
def _momentum(inputs: Inputs) -> DataFrame:
    return stepped(inputs).select("name", "chunk_id", V.fixed_point(F.col("momentum")).alias("content"))


@query(
    "outer_step",
    with_tables(
        ["base", "local", "averages"],
        joined_sql(
            f"CAST(CAST(p AS DOUBLE) - (g + m * CAST({MOMENTUM} AS DOUBLE)) * CAST({LEARNING_RATE} AS DOUBLE) AS FLOAT)",
            "stepped",
        ),
        STEP_CHAIN,
    ),
)
def _step(inputs: Inputs) -> DataFrame:
    return stepped(inputs).select("name", "chunk_id", V.fixed_point(F.col("new_values")).alias("content"))


@query(
    "momentum_replay",
    with_tables(
        ["averages"],
        "SELECT name, chunk_id, round, string_agg(CAST(CAST(floor(m * 1000000 + 0.5) AS BIGINT) AS STRING), ' ' ORDER BY i) "
        "AS content FROM replay GROUP BY name, chunk_id, round",
        {
            "flat": "SELECT name, chunk_id, round, unnest(values) AS g, unnest(range(len(values))) AS i FROM averages",
            "replay": "SELECT name, chunk_id, i, round, g AS m FROM flat WHERE round = 0 UNION ALL SELECT f.name, f.chunk_id, "
            f"f.i, f.round, CAST({MOMENTUM} AS DOUBLE) * r.m + f.g FROM replay AS r JOIN flat AS f ON f.name = r.name AND "
            "f.chunk_id = r.chunk_id AND f.i = r.i AND f.round = r.round + 1",
        },
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def _replay(inputs: Inputs) -> DataFrame:
    replayed = tensors.momentum_replay(inputs("averages"), MOMENTUM)
    return replayed.select("name", "chunk_id", "round", V.fixed_point(F.col("momentum")).alias("content"))
