"""Byte sizes of texts and tensors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size units (powers of 1000) and bytes per element of the supported types.
UNIT_BYTES = {"": 1, "KB": 1000, "MB": 1000**2, "GB": 1000**3}
DTYPE_BYTES = {"float32": 4, "float16": 2, "bfloat16": 2}
SIZE_PATTERN = r"^\s*([0-9]+(?:\.[0-9]+)?)\s*([KMG]B)?\s*$"


def parse_size(text: Column) -> Column:
    """``2GB`` gives 2000000000; fractions are truncated; anything else, ``5B`` and ``1TB`` included, gives NULL."""
    upper = F.upper(text)
    number = F.regexp_extract(upper, SIZE_PATTERN, 1).try_cast("double")
    unit = F.regexp_extract(upper, SIZE_PATTERN, 2)
    factor = F.lit(None).cast("double")
    for name, size in UNIT_BYTES.items():
        factor = F.when(unit == name, F.lit(float(size))).otherwise(factor)
    return F.floor(number * factor).cast("bigint")


def element_size(dtype: Column) -> Column:
    """Bytes per element; NULL for a type the protocol does not know."""
    size = F.lit(None).cast("bigint")
    for name, width in DTYPE_BYTES.items():
        size = F.when(dtype == name, F.lit(width).cast("bigint")).otherwise(size)
    return size


def numel(shape: Column) -> Column:
    return F.aggregate(shape, F.lit(1).cast("bigint"), lambda total, side: total * side)


def tensor_bytes(shape: Column, dtype: Column) -> Column:
    return numel(shape) * element_size(dtype)
