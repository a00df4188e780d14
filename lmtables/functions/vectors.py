"""Element-wise arithmetic on array columns.

Everything stays in Catalyst but the rounding to 16-bit types, for which Spark has no expression; that one is an
Arrow function over whole batches.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lmtables.functions.sizes import DTYPE_BYTES


def subtract(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: a - b)


def scale(values: Column, factor: Column) -> Column:
    return F.transform(values, lambda v: v * factor)


def axpy(values: Column, factor: Column, other: Column) -> Column:
    """``factor * values + other``."""
    return F.zip_with(values, other, lambda a, b: a * factor + b)


def squared_norm(values: Column) -> Column:
    """Sum of squares in double precision."""
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v.cast("double") * v.cast("double"))


def all_finite(values: Column) -> Column:
    """NaN sorts above infinity in Spark, so it fails the comparison too."""
    return F.forall(values, lambda v: F.abs(v) < F.lit(float("inf")))


def softmax(logits: Column) -> Column:
    """Row softmax with the maximum taken off first, as floats."""
    peak = F.array_max(logits).cast("double")
    weights = F.transform(logits, lambda v: F.exp(v.cast("double") - peak))
    total = F.aggregate(weights, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(weights, lambda v: (v / total).cast("float"))


def log_sum_exp(logits: Column) -> Column:
    peak = F.array_max(logits).cast("double")
    return peak + F.log(F.aggregate(logits, F.lit(0.0), lambda acc, v: acc + F.exp(v.cast("double") - peak)))


def round_to_dtype(values: np.ndarray, dtype: str) -> np.ndarray:
    """Float32 values moved to the nearest value of ``dtype``, ties to even, overflow to infinity."""
    values = np.asarray(values, dtype=np.float32)
    if dtype == "float32":
        return values
    if dtype == "float16":
        with np.errstate(over="ignore"):
            return values.astype(np.float16).astype(np.float32)
    if dtype == "bfloat16":
        bits = values.view(np.uint32)
        rounded = ((bits.astype(np.uint64) + 0x7FFF + ((bits >> 16) & 1)) & 0xFFFF0000).astype(np.uint32)
        return np.where(np.isnan(values), np.float32(np.nan), rounded.view(np.float32))
    raise ValueError(f"No rounding to {dtype!r} is known, only to {', '.join(DTYPE_BYTES)}.")


def cast_dtype(values: Column, dtype: str) -> Column:
    """Rounds an ``ARRAY<FLOAT>`` column to a narrow type while keeping it as floats."""
    round_to_dtype(np.zeros(1, np.float32), dtype)
    if dtype == "float32":
        return values.cast("array<float>")
    return _rounding_function(dtype)(values.cast("array<float>"))


def _rounding_function(dtype: str) -> Callable[..., Column]:
    def rounded(batch: pa.Array) -> pa.Array:
        flat = batch.flatten()
        narrow = round_to_dtype(flat.to_numpy(zero_copy_only=False), dtype)
        lengths = np.diff(batch.offsets.to_numpy())
        lengths[batch.is_null().to_numpy(zero_copy_only=False)] = 0
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        mask = batch.is_null() if batch.null_count else None
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(narrow, mask=_null_mask(flat)), mask=mask)

    rounded.__annotations__ = {"batch": pa.Array, "return": pa.Array}
    return F.arrow_udf(rounded, "array<float>")


def _null_mask(flat: pa.Array) -> np.ndarray | None:
    return flat.is_null().to_numpy(zero_copy_only=False) if flat.null_count else None


def fixed_point(values: Column, digits: int = 6) -> Column:
    """One comparable text per vector: elements times ``10**digits``, rounded, as integers joined by blanks."""
    factor = float(10**digits)
    return F.array_join(
        F.transform(values, lambda v: F.floor(v.cast("double") * F.lit(factor) + F.lit(0.5)).cast("string")), " "
    )
