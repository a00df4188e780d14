"""Writers of tensor shards and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.functions.numbers import whole_div
from lmtables.operators.shards import shard_plan, with_shard_names


def sink_tensor_shards(
    tensors: DataFrame,
    manifest: DataFrame,
    path: str,
    *,
    prefix: str,
    max_shard_bytes: int,
    owner: str = "update_id",
    chunks_per_file: int = 4096,
    metadata: dict[str, str] | None = None,
) -> DataFrame:
    """Writes chunks under ``owner=...``, with their shard (``prefix-00001-of-00003``), and returns the plan.

    All that an owner had before is replaced, so a second write with another limit leaves no old shards. A shard is
    spread over several files when it has many chunks, so a tensor above the shard size does not pass through one task.
    Empty input raises before anything is written.
    """
    plan = with_shard_names(shard_plan(manifest, max_shard_bytes, owner), prefix, owner)
    if plan.isEmpty():
        raise ValueError("There are no tensors to write.")
    placed = tensors.join(plan.select(owner, "name", "shard"), [owner, "name"])
    for key, value in (metadata or {}).items():
        placed = placed.withColumn(key, F.lit(value))
    part = whole_div(F.col("chunk_id"), chunks_per_file)
    (
        placed.withColumn("part", part)
        .repartition(owner, "shard", "part")
        .drop("part")
        .sortWithinPartitions(owner, "shard", "name", "chunk_id")
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(owner)
        .parquet(path)
    )
    return plan


def sink_metrics(metrics: DataFrame, path: str, write_id: str) -> None:
    """Writes rows (run, phase, key, value) under ``run=.../write=...``; readers see the id as the column ``write``.

    A write that is repeated with its id, by a retried batch for instance, replaces what it wrote for the same runs;
    other ids and other runs stay. An empty write changes nothing; a null run is a run.
    """
    (
        metrics.select("phase", "key", F.col("value").cast("double").alias("value"), "run", F.lit(write_id).alias("write"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run", "write")
        .parquet(path)
    )
