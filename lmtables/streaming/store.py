"""The tables of the exchange as folders of Parquet under one root, written by one coordinator."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from lmtables.operators.rounds import MARKER_TYPE, ROUNDS_SCHEMA

TENSOR_COLUMNS = "name STRING, chunk_id INT, shape ARRAY<BIGINT>, values ARRAY<FLOAT>"
SCHEMAS = {
    "rounds": ROUNDS_SCHEMA,
    "markers": f"repo_id STRING, round INT, marker {MARKER_TYPE}, model_revision STRING",
    "models": f"{TENSOR_COLUMNS}, repo_id STRING, revision STRING",
    "momentum": f"{TENSOR_COLUMNS}, repo_id STRING, completed_round INT",
    "deltas": f"{TENSOR_COLUMNS}, repo_id STRING, pr_num BIGINT, revision STRING",
    "closed": "repo_id STRING, pr_num BIGINT, merged_round INT",
    "quarantine": "repo_id STRING, round INT, pr_num BIGINT, update_id STRING, problem STRING",
    "failed": "repo_id STRING, round INT, pr_num BIGINT, update_id STRING, problem STRING",
}
PARTITIONS = {
    "models": ("repo_id", "revision"),
    "momentum": ("repo_id", "completed_round"),
    "deltas": ("repo_id", "pr_num", "revision"),
}


class TableStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMAS[name])

    def stream(self, name: str) -> DataFrame:
        """Rows of an append-only table as they are written, from its first one on."""
        self.spark.createDataFrame([], SCHEMAS[name]).write.mode("append").parquet(self.path(name))
        return self.spark.readStream.schema(SCHEMAS[name]).parquet(self.path(name))

    def append(self, name: str, rows: DataFrame) -> None:
        columns = self.spark.createDataFrame([], SCHEMAS[name]).columns
        rows.select(*columns).write.mode("append").parquet(self.path(name))

    def replace_partitions(self, name: str, rows: DataFrame) -> None:
        """Writes partitioned rows; a repeated write of a partition replaces it, other partitions stay."""
        columns = self.spark.createDataFrame([], SCHEMAS[name]).columns
        (
            rows.select(*columns)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITIONS[name])
            .parquet(self.path(name))
        )
