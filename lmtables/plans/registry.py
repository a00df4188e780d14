"""Names of queries, their Spark form and their SQL form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lmtables.plans.tables import Inputs


@dataclass(frozen=True)
class Query:
    build: Callable[[Inputs], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of the input tables under ``name``."""

    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        QUERIES[name] = Query(build, sql)
        return build

    return register


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: build(Inputs(spark, sf_dir))

    return {name: bound(entry.build) for name, entry in QUERIES.items()}


def sql_texts() -> dict[str, str]:
    return {name: entry.sql for name, entry in QUERIES.items() if entry.sql is not None}
