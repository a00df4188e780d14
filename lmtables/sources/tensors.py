"""Tensor shards, snapshots and checkpoints as tables.

A tensor table is partitioned by ``revision`` and ``shard`` when it is written, so the conditions below prune files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.functions.identifiers import PROTOCOL_TREE

# File names of a checkpoint.
CONFIG_FILE = "config.json"
TOKENIZER_FILE = "tokenizer_config.json"
WEIGHT_FILES = ("model.safetensors", "model.safetensors.index.json")


def index_entries(index: DataFrame) -> DataFrame:
    """(name, shard) rows of an index, a ``weight_map`` of name to file."""
    return index.select(F.explode("weight_map").alias("name", "shard"))


def distinct_shards(index: DataFrame) -> DataFrame:
    """Sorted shard files that an index points to."""
    return index_entries(index).select("shard").distinct().orderBy("shard")


def scan_tensor_shards(tensors: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Tensors of the shards an index names; of all shards where there is no index."""
    if index is None:
        return tensors
    return tensors.join(index_entries(index).select("shard"), "shard", "left_semi")


def require_shards(tensors: DataFrame) -> DataFrame:
    """One row with the number of shards; raises when there is none."""
    return tensors.agg(F.countDistinct("shard").alias("shards")).withColumn(
        "shards",
        F.when(F.col("shards") > 0, F.col("shards")).otherwise(
            F.raise_error(F.lit("No tensor shards found.")).cast("bigint")
        ),
    )


def duplicate_tensors(tensors: DataFrame) -> DataFrame:
    """Names that occur in more than one shard."""
    return (
        tensors.groupBy("name").agg(F.countDistinct("shard").alias("shards")).where("shards > 1")
    )


def lookup_tensors(tensors: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of the named tensors; the names reach the scan as a filter."""
    return tensors.where(F.col("name").isin(*names))


def absent_tensors(tensors: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.select("name").distinct().join(tensors.select("name"), "name", "left_anti")


def snapshot_at_revision(files: DataFrame, revision: str) -> DataFrame:
    """Files of one exact revision without the protocol's own tree."""
    return files.where((F.col("revision") == revision) & ~F.col("path").startswith(PROTOCOL_TREE))


def checkpoint_complete(files: DataFrame, modeling_file: str, keys: Sequence[str] = ("revision",)) -> DataFrame:
    """Whether each revision has configuration, tokenizer, model code, and weights in one file or with an index."""

    def has(*names: str):
        return F.coalesce(F.bool_or(F.col("path").isin(*names)), F.lit(False))

    return files.groupBy(*keys).agg(
        (has(CONFIG_FILE) & has(TOKENIZER_FILE) & has(modeling_file) & has(*WEIGHT_FILES)).alias("complete")
    )
