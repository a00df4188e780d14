"""Running totals and top-k rows that never put a whole group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# Bits dropped from the ordering key at each level. A window holds at most 2**8 rows at level 0, 2**17 rows above
# and 2**21 at the top, whatever the number of rows and however the keys are spread over 63 bits.
LEVEL_SHIFTS = (8, 25, 42)
BUCKET = "order_bucket"
GROUP = "order_group"


def group_of(keys: Sequence[str]) -> Column:
    """All keys in one column that is never null, so that groups with a null key meet in joins like others."""
    return F.struct(*keys) if keys else F.lit(0)


def bucket_of(order: Column) -> Column:
    """The level-0 bucket of an integer ordering key; rows without a key come first.

    The result is never null: otherwise each join above would add its own null filter to its own scan, and the
    levels could not share one shuffle of the lengths.
    """
    return F.coalesce(F.shiftright(order.cast("bigint"), LEVEL_SHIFTS[0]), F.lit(-(2**62)))


def bucket_offsets(
    lengths: DataFrame, keys: Sequence[str], order: str, value: str, order_bits: int = 63
) -> DataFrame:
    """For each group (``group_of`` its keys) and bucket, the total of all earlier buckets.

    ``lengths`` is a narrow table (keys, order, value). Each level adds up the one below and takes its running
    totals only inside a parent bucket, so the work stays spread even when one group has nearly all rows.
    ``order_bits`` may be lowered when the ordering key is known to be smaller; rows that break it raise.
    """
    shifts = [shift for shift in LEVEL_SHIFTS if shift == LEVEL_SHIFTS[0] or shift < order_bits]
    key = F.col(order).cast("bigint")
    if order_bits < 63:
        too_wide = F.raise_error(F.lit(f"ordering key {order} needs more than {order_bits} bits")).cast("bigint")
        key = F.when(F.shiftright(F.abs(key), order_bits) > 0, too_wide).otherwise(key)
    level = (
        lengths.select(group_of(keys).alias(GROUP), bucket_of(key).alias("bucket"), F.col(value).alias("total"))
        .groupBy(GROUP, "bucket")
        .agg(F.sum("total").alias("total"))
    )
    return _offsets(level, [b - a for a, b in zip(shifts, shifts[1:])])


def _offsets(level: DataFrame, steps: list[int]) -> DataFrame:
    if not steps:
        inside = W.partitionBy(GROUP).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
        return level.select(GROUP, "bucket", F.coalesce(F.sum("total").over(inside), F.lit(0)).alias("offset"))
    parent = F.shiftright("bucket", steps[0])
    inside = W.partitionBy(GROUP, "parent").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    placed = level.withColumn("parent", parent).select(
        GROUP, "parent", "bucket", F.coalesce(F.sum("total").over(inside), F.lit(0)).alias("inner")
    )
    above = level.groupBy(GROUP, parent.alias("bucket")).agg(F.sum("total").alias("total"))
    above = _offsets(above, steps[1:]).select(GROUP, F.col("bucket").alias("parent"), "offset")
    return placed.join(above, [GROUP, "parent"]).select(
        GROUP, "bucket", (F.col("inner") + F.col("offset")).alias("offset")
    )


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    out: str,
    *,
    inclusive: bool = False,
    ties: Sequence[str] = (),
    lengths: DataFrame | None = None,
    order_bits: int = 63,
) -> DataFrame:
    """Adds ``out``, the running total of ``value`` inside each group, ordered by an integer key, then ``ties``.

    Rows whose group keys are null form a group as well; a null order comes first.

    ``lengths`` (keys, order, ``value``) may be given where the values are cheaper to compute than ``df`` itself.
    """
    valued = df.withColumn("value", value.cast("bigint")).withColumn(BUCKET, bucket_of(F.col(order)))
    valued = valued.withColumn(GROUP, group_of(keys))
    if lengths is None:
        lengths = valued.select(*keys, order, "value")
    offsets = bucket_offsets(lengths, keys, order, "value", order_bits).withColumnRenamed("bucket", BUCKET)
    inside = W.partitionBy(GROUP, BUCKET).orderBy(order, *ties).rowsBetween(W.unboundedPreceding, 0)
    local = F.sum("value").over(inside)
    local = local if inclusive else local - F.col("value")
    return (
        valued.withColumn("local", local)
        .join(offsets, [GROUP, BUCKET])
        .withColumn(out, (F.col("local") + F.col("offset")).cast("bigint"))
        .drop("value", GROUP, BUCKET, "local", "offset")
    )


def top_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    limit: Column | int,
    *,
    rank: str,
    salt_by: str,
    salts: int | None = None,
) -> DataFrame:
    """The first ``limit`` rows of each group with their rank; a hot group is cut down per salt before it meets.

    There are as many salts as the session has shuffle partitions, unless told otherwise.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = F.lit(limit) if isinstance(limit, int) else limit
    salted = df.withColumn("salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)))
    per_salt = W.partitionBy(*keys, "salt").orderBy(*order)
    narrowed = salted.withColumn(rank, F.row_number().over(per_salt)).where(F.col(rank) <= limit).drop("salt", rank)
    return narrowed.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(
        F.col(rank) <= limit
    )
