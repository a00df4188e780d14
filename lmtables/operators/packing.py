"""Concatenation of token lists and cutting into fixed-size blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lmtables.functions.numbers import whole_div
from lmtables.operators.prefix import running_total
from lmtables.operators.tokens import pretokens, tokenize


def token_offsets(
    tokens: DataFrame,
    order: str = "doc_id",
    keys: Sequence[str] = ("split",),
    *,
    column: str = "input_ids",
    lengths: DataFrame | None = None,
    order_bits: int = 63,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Adds ``n`` (list length) and ``start`` (number of tokens before the document in its group)."""
    sized = tokens.withColumn("n", F.size(column).cast("bigint"))
    return running_total(sized, keys, order, F.col("n"), "start", lengths=lengths, order_bits=order_bits, ties=ties)


def batch_scope(
    rows: DataFrame,
    batch_rows: int,
    order: str = "doc_id",
    split: str = "split",
    *,
    num_proc: int = 1,
    order_bits: int = 63,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Adds ``scope``: the number of the map call a row falls into.

    Rows of a split are dealt to ``num_proc`` contiguous shards, the first ones taking one row more when the
    division leaves a rest, and each shard is read in batches of ``batch_rows``.
    """
    indexed = running_total(rows, [split], order, F.lit(1), "row_index", order_bits=order_bits, ties=ties)
    if num_proc == 1:
        return indexed.withColumn("scope", whole_div(F.col("row_index"), batch_rows)).drop("row_index")
    totals = rows.groupBy(split).agg(F.count("*").alias("split_rows")).withColumnRenamed(split, "_split")
    share = whole_div(F.col("split_rows"), num_proc)
    rest = F.col("split_rows") % num_proc
    long_part = rest * (share + 1)
    shard = F.when(F.col("row_index") < long_part, whole_div(F.col("row_index"), share + 1)).otherwise(
        rest + whole_div(F.col("row_index") - long_part, F.greatest(share, F.lit(1)))
    )
    first = F.col("shard") * share + F.least(F.col("shard"), rest)
    calls_per_shard = whole_div(share + batch_rows, batch_rows)
    return (
        indexed.join(totals, F.col(split).eqNullSafe(F.col("_split")))
        .drop("_split")
        .withColumn("shard", shard)
        .withColumn(
            "scope",
            F.col("shard") * calls_per_shard + whole_div(F.col("row_index") - first, batch_rows),
        )
        .drop("shard", "split_rows", "row_index")
    )


def cut_pieces(placed: DataFrame, block_size: int, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per (document, block) overlap with the slice of each list that falls into the block."""
    spans = F.sequence(
        whole_div(F.col("start"), block_size), whole_div(F.col("start") + F.col("n") - 1, block_size)
    )
    low = F.greatest(F.col("block_idx") * block_size - F.col("start"), F.lit(0)).cast("int")
    high = F.least((F.col("block_idx") + 1) * block_size - F.col("start"), F.col("n")).cast("int")
    return (
        placed.where("n > 0")
        .select(*keys, "start", "n", *columns, F.explode(spans).alias("block_idx"))
        .select(*keys, "block_idx", "start", *[F.slice(c, low + 1, high - low).alias(c) for c in columns])
    )


def assemble_blocks(pieces: DataFrame, block_size: int, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Full blocks from pieces. A group holds at most ``block_size`` tokens; the short tail is dropped."""
    gathered = pieces.groupBy(*keys, "block_idx").agg(
        F.array_sort(F.collect_list(F.struct("start", *columns))).alias("pieces")
    )
    joined = gathered.select(
        *keys, "block_idx", *[F.flatten(F.col("pieces").getField(c)).alias(c) for c in columns]
    )
    return joined.where(F.size(columns[0]) == block_size)


def pack_blocks(
    tokens: DataFrame,
    block_size: int,
    order: str = "doc_id",
    *,
    split: str = "split",
    batch_rows: int | None = None,
    num_proc: int = 1,
    columns: Sequence[str] = ("input_ids",),
    lengths: DataFrame | None = None,
    order_bits: int = 63,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Concatenates token lists in row order, cuts blocks of ``block_size`` and copies ``input_ids`` to ``labels``.

    Without ``batch_rows`` a split is one sequence with one tail to drop; with it, each map call of that many rows
    (see :func:`batch_scope`) is. ``ties`` order rows of one ``order``, as those of a corpus in file order. A call has at most ``batch_rows`` documents, so one window over it is bounded.
    """
    columns = list(columns)
    if batch_rows is None:
        keys = [split]
        placed = token_offsets(
            tokens, order, keys, column=columns[0], lengths=lengths, order_bits=order_bits, ties=ties
        )
    else:
        keys = [split, "scope"]
        scoped = batch_scope(tokens, batch_rows, order, split, num_proc=num_proc, order_bits=order_bits, ties=ties)
        before = W.partitionBy(*keys).orderBy(order, *ties).rowsBetween(W.unboundedPreceding, 0)
        placed = scoped.withColumn("n", F.size(columns[0]).cast("bigint")).withColumn(
            "start", F.sum("n").over(before) - F.col("n")
        )
    blocks = assemble_blocks(cut_pieces(placed, block_size, keys, columns), block_size, keys, columns)
    if batch_rows is None:
        blocks = blocks.withColumn("scope", F.lit(0).cast("bigint"))
    if "input_ids" in columns:
        blocks = blocks.withColumn("labels", F.col("input_ids"))
    return blocks


def doc_lengths(docs: DataFrame, text_col: str = "text", order: str = "doc_id", split: str = "split") -> DataFrame:
    """Token count per document straight from the text, without a vocabulary."""
    words = F.coalesce(F.size(pretokens(F.col(text_col))), F.lit(0))
    return docs.select(split, order, F.greatest(words, F.lit(0)).cast("bigint").alias("value"))


def pack_corpus(
    docs: DataFrame,
    vocab: DataFrame,
    block_size: int,
    *,
    text_col: str = "text",
    order: str = "doc_id",
    split: str = "split",
    unk_id: int = 3,
    order_bits: int = 63,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Text to blocks with two shuffles of ids and none of text.

    Documents are coded where they are read; ids move once to the bucket of their running total, and their pieces once
    to the block they belong to. The lengths that the totals need are counted without coding.
    """
    tokens = tokenize(docs, vocab, text_col, keep=(split, order, *ties), unk_id=unk_id)
    lengths = doc_lengths(docs, text_col, order, split)
    return pack_blocks(tokens, block_size, order, split=split, lengths=lengths, order_bits=order_bits, ties=ties)


def pack_stats(
    lengths: DataFrame, block_size: int, split: str = "split", scope: str | None = None, value: str = "value"
) -> DataFrame:
    """Blocks, kept and dropped tokens per split from list lengths alone; no payload moves."""
    keys = [split] if scope is None else [split, scope]
    per_scope = lengths.groupBy(*keys).agg(F.sum(value).alias("tokens"))
    full = whole_div(F.col("tokens"), block_size)
    return per_scope.groupBy(split).agg(
        F.sum(full).alias("blocks"),
        F.sum("tokens").alias("tokens"),
        F.sum(F.col("tokens") - full * block_size).alias("dropped_tokens"),
    )


def require_blocks(stats: DataFrame, split: str = "split", name: str = "train") -> DataFrame:
    """Raises when the named split has no full block."""
    message = F.lit("No block of the training split is full: the corpus is shorter than one block.")
    return stats.withColumn(
        "blocks",
        F.when((F.col(split) == name) & (F.col("blocks") <= 0), F.raise_error(message).cast("bigint")).otherwise(
            F.col("blocks")
        ),
    )


def shift_targets(labels: Column) -> Column:
    """Labels one step ahead: position *i* predicts label *i + 1*; the last position has no target."""
    return F.slice(labels, F.lit(2), F.greatest(F.size(labels) - 1, F.lit(0)))
