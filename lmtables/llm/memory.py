"""Python workers outlive their tasks; what a task no longer needs goes back to the system."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

ROWS_AT_ONCE = 256


def some_at_once(column: pa.Array) -> Iterator[object]:
    """The values of a column as Python objects, a bounded number of which exist at a time."""
    for begin in range(0, len(column), ROWS_AT_ONCE):
        yield from column.slice(begin, ROWS_AT_ONCE).to_pylist()


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, which frees unused memory when its task ends."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except AttributeError:  # another C library
                pass

    return task
