"""Running totals that never put a whole group into one window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def before(df: DataFrame, group: str, bucket: str, order: Sequence[str], value: str) -> DataFrame:
    """Adds ``before``: the sum of ``value`` over earlier rows of the group, by bucket and then by ``order``.

    Totals per bucket are added up first, so a window holds the buckets of a group or the rows of one bucket.
    """
    earlier = W.partitionBy(group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy(group, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    totals = df.groupBy(group, bucket).agg(F.sum(value).alias("_total"))
    offsets = totals.select(group, bucket, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    inner = df.withColumn("_inner", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    placed = inner.join(offsets, [group, bucket])
    return placed.withColumn("before", F.col("_offset") + F.col("_inner")).drop("_offset", "_inner")
