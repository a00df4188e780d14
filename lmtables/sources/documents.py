"""JSON documents with a protocol version gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lmtables.functions.identifiers import PROTOCOL_VERSION


def scan_json_docs(documents: DataFrame, schema: str, *, body: str = "body") -> DataFrame:
    """Parses JSON texts and adds ``supported``: whether the document has the version this protocol speaks."""
    return documents.withColumn("doc", F.from_json(body, schema)).withColumn(
        "supported", F.coalesce(F.col("doc.protocol_version") == PROTOCOL_VERSION, F.lit(False))
    )


def require_supported(documents: DataFrame) -> DataFrame:
    """Raises on a document of another version when its row is read."""
    found = F.coalesce(F.col("doc.protocol_version").cast("string"), F.lit("none"))
    message = F.concat(F.lit(f"Unsupported protocol version; expected {PROTOCOL_VERSION}, found "), found)
    return documents.withColumn(
        "supported", F.when(~F.col("supported"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    )


def quarantine(documents: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """Splits rows by a condition; a null counts as failed."""
    passed = F.coalesce(ok, F.lit(False))
    return documents.where(passed), documents.where(~passed)
