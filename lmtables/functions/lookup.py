"""Vectorized lookup of token lists in a vocabulary that fits into every worker."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def id_lookup(spark: SparkSession, words: pa.Array, ids: pa.Array, unk_id: int) -> Callable[[Column], Column]:
    """A column function from ``ARRAY<STRING>`` to ``ARRAY<INT>``; unknown tokens get ``unk_id``.

    The vocabulary goes to the workers once as a broadcast variable. All tokens of a batch are looked up in one call.
    """
    codes = np.append(ids.to_numpy(zero_copy_only=False), unk_id).astype(np.int32)
    shared = spark.sparkContext.broadcast((words, codes))

    def encode(batch: pa.Array) -> pa.Array:
        known, by_place = shared.value
        flat = batch.flatten()
        if known.type != flat.type:
            known = known.cast(flat.type)
        places = pc.fill_null(pc.index_in(flat, value_set=known), len(known)).to_numpy()
        offsets = batch.offsets.to_numpy()
        return pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), pa.array(by_place[places]))

    encode.__annotations__ = {"batch": pa.Array, "return": pa.Array}
    return F.arrow_udf(encode, "array<int>")
