"""User functions over batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# The length range, in words, that the worked reward example pays for.
REWARD_MIN_WORDS = 20
REWARD_MAX_WORDS = 60


def batched_map(
    df: DataFrame,
    fn: Callable[[dict[str, list]], dict[str, list]],
    schema: str,
    *,
    columns: Sequence[str] | None = None,
    batch_size: int = 1000,
    calls: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """Applies a function from column lists to column lists to batches of rows; the row count may change.

    Batches have ``batch_size`` rows and never cross a partition; the last one of a partition may be shorter. With
    ``calls`` (such as split and scope of :func:`lmtables.operators.packing.batch_scope`) rows that agree in these columns
    are one batch, whatever its size, in the order of ``order``; null is a value of its own. Values come as Python
    values: nulls as None, integers of any size as they are. Without rows the function is not called.
    """
    if calls:
        df = df.repartition(*calls).sortWithinPartitions(*calls, *order)
    names = list(columns) if columns is not None else df.columns
    source = df.select(*names, *(F.col(c).alias(f"_call_{k}") for k, c in enumerate(calls)))
    out = to_arrow_schema(T._parse_datatype_string(schema))

    def pieces(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
        """Rows of one call each."""
        if not calls:
            yield (), batch
            return
        keys = list(zip(*(batch.column(len(names) + k).to_pylist() for k in range(len(calls)))))
        starts = [i for i, key in enumerate(keys) if not i or key != keys[i - 1]]
        for start, end in zip(starts, [*starts[1:], len(keys)]):
            yield keys[start], batch.slice(start, end - start)

    def called(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        found = fn({name: table.column(k).to_pylist() for k, name in enumerate(names)})
        return pa.RecordBatch.from_arrays([pa.array(found[f.name], f.type) for f in out], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, current = 0, ()
        for batch in batches:
            for key, piece in pieces(batch):
                if held and key != current:
                    yield called(held)
                    held, rows = [], 0
                current, start = key, 0
                while start < piece.num_rows:
                    part = piece if calls else piece.slice(start, batch_size - rows)
                    held.append(part)
                    start, rows = start + part.num_rows, rows + part.num_rows
                    if not calls and rows == batch_size:
                        yield called(held)
                        held, rows = [], 0
        if held:
            yield called(held)

    return source.mapInArrow(run, schema)


def reward_udf(fn: Callable[..., list[float]], **options: object) -> Callable[[Column], Column]:
    """Wraps a user reward, a list of completions to a list of numbers, as a vectorized column function.

    Null completions are empty texts, as in :func:`reward_correct_length`; a reward of None is null.
    """

    def score(completions: pd.Series) -> pd.Series:
        return pd.Series(fn(completions.fillna("").tolist(), **options), index=completions.index, dtype="float64")

    score.__annotations__ = {"completions": pd.Series, "return": pd.Series}
    return F.pandas_udf(score, "double")


def reward_correct_length(completion: Column) -> Column:
    """1.0 for 20 to 60 words between white space, else 0.0; null has no words."""
    words = F.size(F.regexp_extract_all(F.coalesce(completion, F.lit("")), F.lit(r"\S+"), F.lit(0)))
    return words.between(REWARD_MIN_WORDS, REWARD_MAX_WORDS).cast("double")
