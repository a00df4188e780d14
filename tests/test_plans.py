"""Rules of the queries over tables that differ from the given ones."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lmtables.operators import submissions as S
from lmtables.plans import rounds, tensors
from lmtables.plans.tables import Inputs

VALUES = [1.0, 2.0] * (tensors.WIDTH // 2)


def inputs(spark, left_out):
    """Base and four replicas of two tensors, without the given (update_id, name)."""
    base = spark.createDataFrame(
        [(f"block.{n}", 0, "rev", VALUES) for n in range(2)], "name STRING, chunk_id INT, revision STRING, values ARRAY<FLOAT>"
    )
    local = base.withColumn("w", F.explode(F.array(*[F.lit(w) for w in (1, 2, 3, 4)])))
    local = local.withColumn("update_id", F.concat(F.lit("update-"), "w"))
    local = local.withColumn("values", F.transform("values", lambda v: (v - F.col("w") / 10).cast("float")))
    for update_id, name in left_out:
        local = local.where(~((F.col("update_id") == update_id) & (F.col("name") == name)))
    return {"base": base, "local": local}.__getitem__


def test_updates_that_verification_rejects_are_left_out(spark):
    def used(left_out):
        return [r.update_id for r in tensors.update_rows(inputs(spark, left_out)).orderBy("merge_rank").collect()]

    assert used([]) == ["update-1", "update-2", "update-3", "update-4"]
    assert used([("update-4", "block.1")]) == ["update-1", "update-2", "update-3"]
    assert used([("update-2", "block.0")]) == ["update-1", "update-3", "update-4"]


@pytest.mark.parametrize("build", [rounds._same, rounds._next])
def test_submissions_are_judged_once(spark, monkeypatch, build):
    calls = []
    judge = S.validate_submissions
    monkeypatch.setattr(S, "validate_submissions", lambda *tables: calls.append(1) or judge(*tables))
    build(Inputs(spark, "/root/testdata/sf0.001"))
    assert len(calls) == 1
