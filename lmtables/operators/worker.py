"""The worker's side of a round: from local replicas to submitted updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lmtables.functions import identifiers as ids
from lmtables.functions import vectors as V
from lmtables.functions.sizes import tensor_bytes
from lmtables.operators import shards, tensors
from lmtables.operators.submissions import ROUND, fresh_updates, tokens_per_update

DELTA_SIGN = "base-minus-local"


def build_deltas(base: DataFrame, local: DataFrame, dtype: str) -> DataFrame:
    """Deltas of all replicas (update_id, name, chunk_id, shape, values) against one base model.

    Raises on a trainable tensor the base lacks and on a value that is not finite; the latter is looked at before
    the rounding, so an overflow to infinity in a narrow type passes here and is found by the receiver.
    """
    joined = local.select("update_id", "name", "chunk_id", "shape", F.col("values").alias("local")).join(
        base.select("name", "chunk_id", F.col("values").alias("base")), ["name", "chunk_id"], "left"
    )
    missing = F.raise_error(F.concat(F.lit("The base model has no tensor to compare with "), F.col("name")))
    exact = V.subtract(F.col("base").cast("array<float>"), F.col("local").cast("array<float>"))
    checked = joined.withColumn(
        "exact", F.when(F.col("base").isNull(), missing.cast("array<float>")).otherwise(exact)
    )
    infinite = F.raise_error(F.concat(F.lit("A difference is infinite or not a number, in "), F.col("name")))
    checked = checked.withColumn(
        "exact", F.when(V.all_finite(F.col("exact")), F.col("exact")).otherwise(infinite.cast("array<float>"))
    )
    return checked.select(
        "update_id", "name", "chunk_id", "shape", "exact", V.cast_dtype(F.col("exact"), dtype).alias("values")
    )


def delta_summary(deltas: DataFrame) -> DataFrame:
    """Reported norm (before rounding) and tensor count per update, in one aggregation."""
    return deltas.groupBy("update_id").agg(
        F.sqrt(F.sum(V.squared_norm(F.col("exact")))).alias("delta_norm_reported"),
        F.countDistinct("name").cast("int").alias("tensor_count"),
    )


def delta_files(deltas: DataFrame, dtype: str, max_shard_bytes: int) -> DataFrame:
    """Shard file names per update, sorted; there are as many as a plan over the manifest makes."""
    manifest = deltas.groupBy("update_id", "name").agg(F.first("shape").alias("shape"))
    sized = manifest.withColumn("tensor_bytes", tensor_bytes(F.col("shape"), F.lit(dtype)))
    counts = (
        shards.shard_plan(sized, max_shard_bytes).groupBy("update_id").agg(F.max("shard_index").alias("shard_count"))
    )
    names = F.transform(
        F.sequence(F.lit(1), F.col("shard_count")),
        lambda i: F.concat(shards.shard_name(F.lit("delta"), i, F.col("shard_count")), F.lit(ids.PAYLOAD_SUFFIX)),
    )
    return counts.select("update_id", names.alias("file_names"))


def update_documents(
    replicas: DataFrame,
    summary: DataFrame,
    files: DataFrame,
    states: DataFrame,
    submitted_at: Column | str,
    dtype: str,
) -> DataFrame:
    """Metadata documents (repo_id, round, worker_id, update_id, path, body) of the updates that are still fresh.

    ``replicas`` is (update_id, repo_id, round, base_model_revision, worker_id, local_steps, batch_size, accumulation,
    block_size, train_loss, dataset_name, dataset_config_name). An update whose round has moved on is left out.
    """
    current = fresh_updates(replicas, states).join(summary, "update_id").join(files, "update_id")
    named = current.withColumn("worker_id", ids.sanitize_id(F.col("worker_id"))).withColumn(
        "folder", F.concat(ids.round_prefix(F.col("round")), F.concat_ws("/", "worker_id", "update_id"))
    )
    tokens = tokens_per_update(
        F.col("local_steps"), F.col("batch_size"), F.col("accumulation"), F.col("block_size")
    )
    # Metadata fields of the protocol that are copied as they are.
    copied = (
        "update_id",
        "worker_id",
        "round",
        "base_model_revision",
        "delta_norm_reported",
        "tensor_count",
        "local_steps",
        "train_loss",
        "dataset_name",
        "dataset_config_name",
        "block_size",
    )
    body = ids.json_sorted(
        {
            "protocol_version": F.lit(ids.PROTOCOL_VERSION),
            "delta_sign": F.lit(DELTA_SIGN),
            "delta_dtype": F.lit(dtype),
            "delta_files": F.transform("file_names", lambda n: F.concat_ws("/", F.col("folder"), n)),
            "num_tokens": tokens,
            "submitted_at": F.lit(submitted_at).cast("string"),
            **{name: F.col(name) for name in copied},
        }
    )
    return named.select(
        *ROUND,
        "worker_id",
        "update_id",
        F.concat_ws("/", "folder", F.lit(ids.METADATA_FILE)).alias("path"),
        body.alias("body"),
    )
