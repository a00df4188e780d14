"""Assignment of tensors to shard files."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shard_plan(manifest: DataFrame, max_shard_bytes: int, owner: str = "update_id", order: str = "name") -> DataFrame:
    """Adds ``shard_index`` (from 1): a new shard opens when the current one is not empty and would grow too large.

    This is a running sum that starts over, which no window expresses. It reads the manifest, one row per tensor and
    never the payload, as a sorted stream with two numbers of state.
    """
    rows = manifest.select(owner, order, "tensor_bytes")
    schema = T.StructType([*rows.schema.fields, T.StructField("shard_index", T.IntegerType())])

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, shard, filled = None, 0, 0
        for batch in batches:
            shards = []
            for name, size in zip(batch[owner], batch["tensor_bytes"]):
                if name != current:
                    current, shard, filled = name, 1, 0
                elif filled + size > max_shard_bytes:
                    shard, filled = shard + 1, 0
                filled += size
                shards.append(shard)
            yield batch.assign(shard_index=pd.Series(shards, dtype="int32", index=batch.index))

    return rows.repartition(owner).sortWithinPartitions(owner, order).mapInPandas(assign, schema)


def with_shard_names(plan: DataFrame, prefix: str, owner: str = "update_id") -> DataFrame:
    """Adds ``shard_count`` and the file name, known only once all tensors of the owner are placed."""
    counts = plan.groupBy(owner).agg(F.max("shard_index").alias("shard_count"))
    return plan.join(counts, owner).withColumn(
        "shard", shard_name(F.lit(prefix), F.col("shard_index"), F.col("shard_count"))
    )


def shard_name(prefix: Column, index: Column, count: Column) -> Column:
    return F.format_string("%s-%05d-of-%05d", prefix, index, count)
