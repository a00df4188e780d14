"""Writer queries: what was written is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.functions import sizes
from lmtables.operators import evaluation
from lmtables.plans import tensors as tensor_plans
from lmtables.plans.analytics import LOSSES
from lmtables.plans.registry import query
from lmtables.plans.streams import workspace
from lmtables.plans.tables import Inputs, with_tables
from lmtables.sources.sinks import sink_metrics, sink_tensor_shards

SHARDS = {
    "sized": 'SELECT update_id, name, CAST(count(*) * 64 * 4 AS BIGINT) AS tensor_bytes FROM "local" '
    "GROUP BY update_id, name",
    "numbered": "SELECT *, row_number() OVER (PARTITION BY update_id ORDER BY name) AS place FROM sized",
    "greedy": tensor_plans.GREEDY_SQL,
    "named": "SELECT update_id, name, 'delta-' || lpad(CAST(shard_index AS STRING), 5, '0') || '-of-' || "
    "lpad(CAST(max(shard_index) OVER (PARTITION BY update_id) AS STRING), 5, '0') AS shard FROM greedy",
    "deltas": tensor_plans.DELTAS_SQL,
}


@query(
    "sink_tensor_shards",
    with_tables(
        ["base", "local"],
        "SELECT d.update_id, n.shard, d.name, d.chunk_id, 'base-minus-local' AS delta_sign, "
        f"{tensor_plans.fixed_sql('d.values')} AS content FROM deltas AS d JOIN named AS n ON n.update_id = d.update_id "
        "AND n.name = d.name",
        SHARDS,
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def _shards(inputs: Inputs) -> DataFrame:
    path = workspace(inputs, "shards")
    manifest = tensor_plans.delta_manifest(inputs).select(
        "update_id", "name", sizes.tensor_bytes(F.col("shape"), F.lit("float32")).alias("tensor_bytes")
    )
    sink_tensor_shards(
        tensor_plans.deltas(inputs).drop("exact"),
        manifest,
        path,
        prefix="delta",
        max_shard_bytes=tensor_plans.SHARD_BYTES,
        metadata={"delta_sign": "base-minus-local"},
    )
    return inputs.spark.read.parquet(path).select(
        "update_id", "shard", "name", "chunk_id", "delta_sign", tensor_plans.V.fixed_point(F.col("values")).alias("content")
    )


@query(
    "sink_metrics",
    with_tables(
        ["token_logits"],
        "SELECT 'run-' || CAST(part AS STRING) AS run, 'eval' AS phase, m.key, round(CASE m.key WHEN 'eval_loss' THEN loss "
        "ELSE exp(loss) END, 6) AS value FROM (SELECT seq_id % 4 AS part, avg(nll) AS loss FROM nlls GROUP BY seq_id % 4) AS e, "
        "(VALUES ('eval_loss'), ('perplexity')) AS m(key) UNION ALL SELECT 'run-0', 'train', 'total_parameters', "
        "CAST((SELECT count(*) * 64 FROM embeddings) AS DOUBLE)",
        LOSSES,
    ),
)
def _metrics(inputs: Inputs) -> DataFrame:
    path = workspace(inputs, "metrics")
    losses = evaluation.token_losses(inputs("token_logits")).groupBy((F.col("seq_id") % 4).alias("part")).agg(
        F.avg("nll").alias("loss")
    )
    run = F.concat(F.lit("run-"), F.col("part").cast("string"))
    evaluated = losses.select(
        run.alias("run"),
        F.lit("eval").alias("phase"),
        F.explode(F.create_map(F.lit("eval_loss"), F.col("loss"), F.lit("perplexity"), evaluation.perplexity(F.col("loss")))),
    )
    parameters = inputs("base").agg(F.sum(F.size("values")).alias("value")).select(
        F.lit("run-0").alias("run"), F.lit("train").alias("phase"), F.lit("total_parameters").alias("key"), "value"
    )
    for _ in range(2):
        sink_metrics(evaluated, path, "eval-0")  # the second time as a retry
    sink_metrics(parameters, path, "start")
    return inputs.spark.read.parquet(path).select("run", "phase", "key", F.round("value", 6).alias("value"))
