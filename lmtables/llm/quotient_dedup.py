"""Exact deduplication through counting quotient filters and a comparison of bytes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lmtables.session import stage

QUOTIENT_BITS = 12
BLOCK_ROWS = 1 << 18
LEAST_BLOCK_BITS = 4
FLUSH = 1 << 20


@dataclass(frozen=True)
class QuotientFilter:
    """A multiset of fixed-width fingerprints: a run of sorted remainders and their counts for each quotient."""

    runs: np.ndarray  # length of the run of each quotient
    remainders: np.ndarray
    counts: np.ndarray

    @classmethod
    def build(cls, fingerprints: np.ndarray, remainder_bits: int, counts: np.ndarray | None = None) -> QuotientFilter:
        """From fingerprints of QUOTIENT_BITS + remainder_bits bits, repeated or with their counts."""
        order = np.argsort(fingerprints, kind="stable")
        ordered = fingerprints[order]
        weight = np.ones(len(ordered), np.int64) if counts is None else counts[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, int)
        distinct = ordered[first]
        quotient = (distinct >> np.uint64(remainder_bits)).astype(np.int64)
        mask = np.uint64((1 << remainder_bits) - 1)
        return cls(
            np.bincount(quotient, minlength=1 << QUOTIENT_BITS).astype(np.uint32),
            distinct & mask,
            np.add.reduceat(weight, first) if len(first) else np.empty(0, np.int64),
        )

    def fingerprints(self, remainder_bits: int) -> np.ndarray:
        quotient = np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs)
        return (quotient << np.uint64(remainder_bits)) | self.remainders

    @classmethod
    def merge(cls, filters: list[QuotientFilter], remainder_bits: int) -> QuotientFilter:
        """Runs of one quotient are merged by remainder and counts of one remainder add up; nothing is lost."""
        return cls.build(
            np.concatenate([f.fingerprints(remainder_bits) for f in filters]),
            remainder_bits,
            np.concatenate([f.counts for f in filters]),
        )

    def pack(self) -> tuple[bytes, bytes, bytes]:
        used = np.flatnonzero(self.runs).astype(np.uint16)
        runs = np.stack([used.astype(np.uint32), self.runs[used]]) if len(used) else np.empty((2, 0), np.uint32)
        return runs.tobytes(), self.remainders.tobytes(), self.counts.astype(np.int64).tobytes()

    @classmethod
    def unpack(cls, runs: bytes, remainders: bytes, counts: bytes) -> QuotientFilter:
        used, length = np.frombuffer(runs, np.uint32).reshape(2, -1)
        full = np.zeros(1 << QUOTIENT_BITS, np.uint32)
        full[used] = length
        return cls(full, np.frombuffer(remainders, np.uint64), np.frombuffer(counts, np.int64))


def _partial_filters(block_bits: int):
    low = 64 - block_bits

    def emit(parts: list[np.ndarray]) -> pa.RecordBatch:
        fingerprints = np.concatenate(parts)
        block = (fingerprints >> np.uint64(low)).astype(np.int64) if block_bits else np.zeros(len(fingerprints), np.int64)
        inner = fingerprints & np.uint64((1 << low) - 1) if block_bits else fingerprints
        rows = []
        for b in np.unique(block):
            rows.append((int(b), *QuotientFilter.build(inner[block == b], low - QUOTIENT_BITS).pack()))
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])],
            ["block", "runs", "remainders", "counts"],
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
                size += batch.num_rows
            if size >= FLUSH:
                yield emit(held)
                held, size = [], 0
        if size:
            yield emit(held)

    return build


def _repeated(block_bits: int):
    low = 64 - block_bits

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [QuotientFilter.unpack(*r) for r in rows[["runs", "remainders", "counts"]].itertuples(index=False)]
        whole = QuotientFilter.merge(parts, low - QUOTIENT_BITS)
        inner = whole.fingerprints(low - QUOTIENT_BITS)
        if block_bits:
            inner = inner | (np.uint64(int(rows["block"].iloc[0])) << np.uint64(low))
        many = whole.counts > 1
        return pd.DataFrame({"fp": inner[many].view(np.int64), "n": whole.counts[many]})

    return merge


def repeated_fingerprints(fingerprints: DataFrame, rows: int) -> DataFrame:
    """Fingerprints that occur more than once: ``fp``, ``n``.

    ``fingerprints`` has one long column. Every input partition builds one filter per block of the fingerprint space;
    the filters of a block meet in one task, which holds about BLOCK_ROWS of ``rows`` fingerprints. A fingerprint that
    a third of all rows share is one slot with a count in each of them.
    """
    block_bits = max(LEAST_BLOCK_BITS, math.ceil(math.log2(max(rows, 1) / BLOCK_ROWS)))
    partial = fingerprints.mapInArrow(_partial_filters(block_bits), "block long, runs binary, remainders binary, counts binary")
    return partial.groupBy("block").applyInPandas(_repeated(block_bits), "fp long, n long")


def normalized(text: Column) -> Column:
    """Runs of ASCII white space become one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, dropped ones too: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when their normalized bytes are; the row with the smallest key stays, a null key coming last, and
    of rows that repeat key and text exactly one. Only texts whose fingerprint the merged filters count more than once
    are compared, byte by byte, by grouping on the text itself. Null text is empty; other columns are not read.
    """
    body = normalized(F.col(text))
    narrow = stage(
        docs.select(F.col(key).alias("id"), body.alias("body")).select(
            "id",
            F.monotonically_increasing_id().alias("row"),
            F.xxhash64("body").alias("fp"),
            F.unhex(F.sha2("body", 256)).alias("sha"),
        ),
        "fingerprints",
    )
    repeated = stage(repeated_fingerprints(narrow.select("fp"), narrow.count()), "repeated")
    verified = (
        docs.select(body.alias("body"))
        .withColumn("fp", F.xxhash64("body"))
        .join(repeated, "fp", "left_semi")
        .groupBy("fp", "body")
        .agg(F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select("fp", F.unhex(F.sha2("body", 256)).alias("sha"), "group_size")
    )
    order = F.struct(F.col("id").isNull().alias("last"), "id", "row")
    first = narrow.join(repeated, "fp", "left_semi").groupBy("fp", "sha").agg(F.min(order).alias("first"))
    groups = verified.join(first, ["fp", "sha"])
    whole = narrow.join(groups, ["fp", "sha"], "left")
    return whole.select(
        F.col("id").alias(key),
        F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("first.row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
