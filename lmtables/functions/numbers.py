"""Whole-number arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_div(number: Column, divisor: Column | int) -> Column:
    """Quotient of two non-negative integers, exact for all of ``BIGINT``; division through doubles is not."""
    return F.call_function("div", number, F.lit(divisor))
