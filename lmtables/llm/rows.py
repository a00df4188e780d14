"""Row numbers that hold for a whole job, and the effect of decisions made per row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.session import stage

ROW = "_row_number"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number per row. It is written out: a second scan of the input may be split otherwise, for
    instance after executors were lost, and would number its rows otherwise."""
    return stage(docs.withColumn(ROW, F.monotonically_increasing_id()), "numbered")


def first_of_groups(rows: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """One row of each group, that with the smallest key (null last), and all rows that are in no group.

    ``rows`` are numbered, ``groups`` has the row number and ``group``. Only the numbers of rows that go are joined to
    the rows.
    """
    order = F.struct(F.col(key).isNull().alias("last"), key, ROW)
    member = groups.join(rows.select(ROW, key), ROW)
    first = member.groupBy("group").agg(F.min(order).alias("first"))
    gone = member.join(first, "group").where(F.col(ROW) != F.col("first")[ROW]).select(ROW)
    return rows.join(stage(gone, "gone"), ROW, "left_anti").drop(ROW)
