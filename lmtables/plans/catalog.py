"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lmtables.plans import analytics, corpus, ledger, rounds, scalars, sinks, streams, tensors  # noqa: F401 - importing registers
from lmtables.plans.registry import spark_queries, sql_texts
from lmtables.plans.tables import Inputs


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.blocks(Inputs(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return spark_queries()


def oracle_sql() -> dict[str, str]:
    return sql_texts()
