"""Vocabulary building and tokenization of a documents table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lmtables.functions.lookup import id_lookup

# The special tokens, in id order.
SPECIALS = ("<pad>", "<bos>", "<eos>", "<unk>")
PRETOKEN_PATTERN = r"\S+"
# Largest vocabulary that is sent to every worker, some tens of MB.
LOOKUP_LIMIT = 1_000_000


def pretokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PRETOKEN_PATTERN), F.lit(0))


def count_tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Frequency of each pre-token; counts are combined before the shuffle, so frequent tokens do not pile up."""
    return (
        docs.select(F.explode(pretokens(F.col(text_col))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("freq"))
    )


def build_vocab(
    docs: DataFrame, text_col: str = "text", vocab_size: int = 32_000, specials: Sequence[str] = SPECIALS
) -> DataFrame:
    """The ``vocab_size`` entries (specials first, then by frequency, ties by token) with their ids.

    Each partition keeps its ``vocab_size`` first words only; the ranking window without partitions sees
    ``vocab_size`` rows, a bound set by the caller.
    """
    spark = docs.sparkSession
    places = vocab_size - len(specials)
    if places <= 0:
        raise ValueError("vocab_size must exceed the number of special tokens.")
    counted = count_tokens(docs, text_col)
    if specials:
        counted = counted.where(~F.col("token").isin(*specials))
    order = [F.col("freq").desc(), F.col("token").asc()]
    top = counted.orderBy(*order).limit(places)
    ranked = top.withColumn("rank", F.row_number().over(W.orderBy(*order)))
    words = ranked.select("token", (F.col("rank") - 1 + len(specials)).cast("int").alias("token_id"), "freq")
    if not specials:
        return words
    heads = spark.range(len(specials)).select(
        F.element_at(F.array(*[F.lit(s) for s in specials]), (F.col("id") + 1).cast("int")).alias("token"),
        F.col("id").cast("int").alias("token_id"),
        F.lit(0).cast("bigint").alias("freq"),
    )
    return heads.unionByName(words)


def special_ids(vocab: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """One row with pad, bos and eos ids: pad falls back to eos, then unk; an id that is still missing becomes 0."""
    found = {
        role: F.max(F.when(F.col("token") == names[role], F.col("token_id"))) if role in names else F.lit(None)
        for role in ("pad", "bos", "eos", "unk")
    }
    return vocab.agg(
        F.coalesce(found["pad"], found["eos"], found["unk"], F.lit(0)).cast("int").alias("pad_token_id"),
        F.coalesce(found["bos"], F.lit(0)).cast("int").alias("bos_token_id"),
        F.coalesce(found["eos"], F.lit(0)).cast("int").alias("eos_token_id"),
        F.count("*").alias("vocab_size"),
    )


def join_vocab(exploded: DataFrame, vocab: DataFrame, unk_id: int) -> DataFrame:
    """Token rows with ids; unknown tokens get ``unk_id``.

    Without a hint: a small vocabulary is broadcast by adaptive execution, and with a large one the partitions of
    frequent tokens are split by its skew handling.
    """
    return exploded.join(vocab.select("token", "token_id"), "token", "left").withColumn(
        "token_id", F.coalesce("token_id", F.lit(unk_id)).cast("int")
    )


def small_vocab(vocab: DataFrame, limit: int = LOOKUP_LIMIT) -> tuple[pa.Array, pa.Array] | None:
    """Tokens and ids on the driver, or None for a vocabulary of more than ``limit`` entries."""
    table = vocab.select("token", F.col("token_id").cast("int").alias("token_id")).limit(limit + 1).toArrow()
    if table.num_rows > limit:
        return None
    return tuple(table.column(name).combine_chunks() for name in ("token", "token_id"))


def tokenize(
    docs: DataFrame,
    vocab: DataFrame,
    text_col: str = "text",
    keep: Sequence[str] = ("split", "doc_id"),
    *,
    unk_id: int = SPECIALS.index("<unk>"),
    lookup_limit: int = LOOKUP_LIMIT,
    attention_mask: bool = False,
) -> DataFrame:
    """One row per document with its token ids; all raw columns but ``keep`` are dropped.

    The vocabulary is counted and read here, once. Up to ``lookup_limit`` entries it is sent to the workers, and each
    document is coded where it was read: no shuffle, and no row per token. A larger one is joined, with the same rows.
    """
    keep = list(keep)
    small = small_vocab(vocab, lookup_limit)
    if small is None:
        tokens = _tokenize_by_join(docs, vocab, text_col, keep, unk_id)
    else:
        encode = id_lookup(docs.sparkSession, *small, unk_id)
        words = F.coalesce(pretokens(F.col(text_col)), F.array().cast("array<string>"))
        tokens = docs.select(*keep, encode(words).alias("input_ids"))
    if attention_mask:
        tokens = tokens.withColumn("attention_mask", F.transform("input_ids", lambda _: F.lit(1)))
    return tokens


def _tokenize_by_join(docs: DataFrame, vocab: DataFrame, text_col: str, keep: list[str], unk_id: int) -> DataFrame:
    """Token rows joined with the vocabulary and put together again, by a number per document.

    So documents with the same ``keep`` columns, or nulls in them, stay apart as they do in the lookup.
    """
    numbered = docs.select(*keep, F.col(text_col).alias("_text"), F.monotonically_increasing_id().alias("_row"))
    exploded = numbered.select(*keep, "_row", F.posexplode_outer(pretokens(F.col("_text"))).alias("pos", "token"))
    coded = join_vocab(exploded, vocab, unk_id)
    pairs = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "token_id"))))
    return coded.groupBy(*keep, "_row").agg(pairs.alias("pairs")).select(*keep, F.col("pairs.token_id").alias("input_ids"))
