"""Quality scores from how much better one of two compression dictionaries fits a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lmtables.llm.memory import releasing, some_at_once

CHUNK = 1024
SMOOTHING = 50


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries of good and bad text (None without labels of that class) and the calibration of the difference."""

    good: bytes | None
    bad: bytes | None
    differences: tuple[float, ...] = (0.0,)
    shares: tuple[float, ...] = (0.5,)
    level: int = 3

    def probability(self, difference: np.ndarray) -> np.ndarray:
        """Linear between the knots; a small logistic part keeps the order of scores where the curve is flat."""
        smooth = 1 / (1 + np.exp(-np.clip(20 * difference, -30, 30)))
        return 0.99 * np.interp(difference, self.differences, self.shares) + 0.01 * smooth


def fold(key: Column, folds: int = 5) -> Column:
    """crc32 of the key's text modulo ``folds``; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def _chunks(text: str | None) -> list[bytes]:
    data = (text or "").encode()
    return [data[i : i + CHUNK] for i in range(0, len(data), CHUNK)]


def _compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level)
    return zstandard.ZstdCompressor(
        dict_data=data, level=level, write_checksum=False, write_content_size=False, write_dict_id=False
    )


def _differences(model: QualityModel):
    """(size with the bad dictionary − size with the good one) / size of the text, over all chunks of the whole text."""
    if model.good is None or model.bad is None:
        return lambda texts: np.zeros(len(texts))
    good, bad = (_compressor(d, model.level) for d in (model.good, model.bad))

    def measure(texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for i, text in enumerate(some_at_once(texts)):
            gain = size = 0
            for chunk in _chunks(text):
                gain += len(bad.compress(chunk)) - len(good.compress(chunk))
                size += len(chunk)
            out[i] = gain / (size + SMOOTHING)
        return out

    return measure


def _sample_chunks(per_row: int):
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quality, chunk = [], []
            for q, text in zip(some_at_once(batch.column("quality")), some_at_once(batch.column("text"))):
                drawn = sorted(_chunks(text), key=xxhash.xxh64_intdigest)[:per_row]
                chunk += drawn
                quality += [q] * len(drawn)
            yield pa.RecordBatch.from_arrays([pa.array(quality, pa.int32()), pa.array(chunk, pa.binary())], ["quality", "chunk"])

    return take


def _measured(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = _differences(model)
        for batch in batches:
            values = measure(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(values)], ["quality", "difference"])

    return run


def _dictionary(samples: list[bytes], size: int) -> bytes | None:
    """Trained by zstandard; the samples themselves where there are too few of them for training."""
    samples = sorted(s for s in samples if s)
    if not samples:
        return None
    try:
        return zstandard.train_dictionary(size, sorted(samples, key=xxhash.xxh64_intdigest)).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Isotonic regression: knots (mean difference of a block, share of label 1 in it), both increasing.

    Neighbouring blocks whose shares are out of order are pooled. A share is drawn slightly towards one half, so that
    no score is exactly 0 or 1.
    """
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # weight, weight × x, weight × y
    for xi, yi, wi in zip(x[order], y[order], weight[order]):
        blocks.append([wi, wi * xi, wi * yi])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][0] >= blocks[-1][2] * blocks[-2][0]:
            top = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], top)]
    return tuple(b[1] / b[0] for b in blocks), tuple((b[2] + 0.5) / (b[0] + 1) for b in blocks)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
    rows_per_class: int = 4000,
    chunks_per_row: int = 4,
    dictionary_bytes: int = 65536,
) -> QualityModel:
    """Learns from a sample of the labelled rows whose fold is not 0.

    The sample is bounded by ``rows_per_class``: the labels first in hash order, half for the dictionaries (of each
    text ``chunks_per_row`` chunks out of all of it), half for the calibration, where rows are weighted back to the
    true shares of the classes. Null labels and labels other than 0 and 1 are not used. Only the sampled labels are
    sent to all workers, so texts are not shuffled.
    """
    usable = labels.select(F.col(key).alias("id"), F.col(quality).cast("int").alias("quality")).where(
        (fold(F.col("id")) != 0) & F.col("quality").isin(0, 1)
    )
    totals = {row[0]: row[1] for row in usable.groupBy("quality").count().collect()}
    if not totals:
        return QualityModel(None, None)
    order = F.xxhash64(F.col("id"), F.lit(17))
    picked = [usable.where(F.col("quality") == q).orderBy(order, "id").limit(rows_per_class) for q in (0, 1)]
    sample = picked[0].unionByName(picked[1]).withColumn("part", F.pmod(F.xxhash64("id", F.lit(23)), F.lit(2)))
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    drawn = (
        texts.where("part = 0").select("quality", "text").mapInArrow(releasing(_sample_chunks(chunks_per_row)), "quality int, chunk binary")
    ).collect()
    model = QualityModel(*(_dictionary([bytes(r[1]) for r in drawn if r[0] == q], dictionary_bytes) for q in (1, 0)))
    model = replace(model, shares=(totals.get(1, 0) / sum(totals.values()),))
    if model.good is None or model.bad is None:
        return model
    measured = (
        texts.where("part = 1").select("quality", "text").mapInArrow(releasing(_measured(model)), "quality int, difference double")
    ).collect()
    x, y = np.array([r[1] for r in measured]), np.array([r[0] for r in measured], float)
    if len(set(y)) < 2:
        return model
    each = {q: totals[q] / sum(totals.values()) * len(y) / np.sum(y == q) for q in (0, 1)}
    differences, shares = _curve(x, y, np.where(y == 1, each[1], each[0]))
    return replace(model, differences=differences, shares=shares)


def score(docs: DataFrame, model: QualityModel, *, key: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Scores every whole text: key, ``held_out`` (fold 0), ``score`` (probability of label 1), ``predicted``.

    A null text counts as empty and gets the score of no evidence. Rows repeat as they do in ``docs``; a null key is
    not held out; other columns are not read.
    """
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = _differences(model)
        for batch in batches:
            values = model.probability(measure(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], ["id", "score"])

    scored = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        run, f"id {kind.simpleString()}, score double"
    )
    return scored.select(
        F.col("id").alias(key),
        F.coalesce(fold(F.col("id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def accept(docs: DataFrame, model: QualityModel, *, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose whole text scores ``threshold`` or more."""

    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = _differences(model)
        for batch in batches:
            values = model.probability(measure(batch.column(place)))
            yield batch.filter(pa.array(values >= threshold))

    return docs.mapInArrow(releasing(run), docs.schema)
