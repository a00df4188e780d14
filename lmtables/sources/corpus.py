"""Corpus tables with named splits."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "json", "text", "csv", "orc")
TEXT_COLUMN = {"text": "value"}
FILE_ORDER, LINE = "doc_id", "line"
FILE_BITS = 40  # of a place in a file: a file's size, or its number of rows, stays below
FEW_FILES = 100_000


def scan_corpus(
    spark: SparkSession,
    path: str | dict[str, str],
    *,
    fmt: str = "parquet",
    text_col: str | None = None,
    keep: tuple[str, ...] | None = None,
    split: Column | None = None,
    schema: str | None = None,
    file_order: bool | None = None,
) -> DataFrame:
    """(split, keep..., text): a path with a split expression, or one path per split name.

    Only the named columns reach the scan. A mapping must have ``train``; other splits are optional. ``keep`` is
    ``doc_id`` if not given. With ``file_order``, the default for text files, no column has to name the rows: their order
    is that of the files by name and of the rows in them, told by two columns more, see :func:`with_file_order`.
    """
    file_order = fmt == "text" if file_order is None else file_order
    text_col = text_col or TEXT_COLUMN.get(fmt, "text")
    keep = (() if file_order else ("doc_id",)) if keep is None else keep
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format {fmt!r}; choose from {', '.join(FORMATS)}.")

    def read(location: str) -> DataFrame:
        reader = spark.read.format(fmt)
        if schema is not None:
            reader = reader.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", "true").option("multiLine", "true")
        return reader.load(location)

    def narrowed(rows: DataFrame, name: Column) -> DataFrame:
        columns = [name.alias("split"), *keep, F.col(text_col).alias("text")]
        return with_file_order(rows, columns, fmt) if file_order else rows.select(*columns)

    if isinstance(path, str):
        return narrowed(read(path), split if split is not None else F.lit("train"))
    if "train" not in path:
        raise KeyError("A corpus needs a train split.")
    parts = [narrowed(read(location), F.lit(name)) for name, location in path.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def with_file_order(rows: DataFrame, columns: list[Column | str], fmt: str) -> DataFrame:
    """``columns`` of a scan with ``doc_id`` and ``line``, which put its rows in the order of the files.

    ``doc_id`` has the number of the file, by name, above the place in it: the row number for Parquet, else the byte at
    which the row's part of the file starts. ``line`` orders the rows of one part, which one task reads from its start.
    However a file is cut into parts, the order is the same; the numbers are not, so they are no names of rows.
    Column names other than these two are the caller's.
    """
    spark = rows.sparkSession
    # The listing and the scan write the slashes behind the scheme differently.
    names = sorted(re.sub(r"^(\w+):/+", r"\1:/", name) for name in rows.inputFiles())
    files = spark.createDataFrame(list(enumerate(names)), "_number long, _file string")
    if len(names) <= FEW_FILES:
        files = F.broadcast(files)
    place = F.col("_metadata.row_index") if fmt == "parquet" else F.col("_metadata.file_block_start")
    read = rows.select(
        *columns,
        F.regexp_replace("_metadata.file_path", r"^(\w+):/+", "$1:/").alias("_file"),
        place.alias("_place"),
        F.monotonically_increasing_id().alias(LINE),
    )
    unknown = F.raise_error(F.concat(F.lit("A file came up during the scan: "), F.col("_file"))).cast("bigint")
    number = F.shiftleft(F.coalesce("_number", unknown), FILE_BITS) + F.col("_place")
    return read.join(files, "_file", "left").withColumn(FILE_ORDER, number).drop("_file", "_place", "_number")


def split_counts(blocks: DataFrame) -> DataFrame:
    return blocks.groupBy("split").agg(F.count("*").alias("examples"))
