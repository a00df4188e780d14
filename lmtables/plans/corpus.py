"""Corpus queries: scan, vocabulary, tokenization, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.operators import packing, tokens
from lmtables.plans.registry import query
from lmtables.plans.tables import Inputs, with_tables
from lmtables.sources.corpus import scan_corpus, split_counts

VOCAB_SIZE = 8000
BLOCK_SIZE = 256
BATCH_ROWS = 100
NUM_PROC = 4

TOKENS_SQL = (
    "SELECT split, doc_id, unnest(words) AS token, unnest(range(len(words))) AS pos "
    "FROM (SELECT split, doc_id, regexp_extract_all(text, '\\S+') AS words FROM corpus) AS w"
)
VOCAB_SQL = (
    "SELECT token, CAST(row_number() OVER (ORDER BY freq DESC, token) + 3 AS INT) AS token_id, freq FROM ("
    "SELECT token, count(*) AS freq FROM toks WHERE token NOT IN ('<pad>', '<bos>', '<eos>', '<unk>') "
    f"GROUP BY token ORDER BY freq DESC, token LIMIT {VOCAB_SIZE - 4}) AS c"
)
IDS_SQL = (
    "SELECT split, doc_id, pos, COALESCE(token_id, 3) AS token_id FROM toks LEFT JOIN words USING (token)"
)
WORDS = {"toks": TOKENS_SQL, "words": VOCAB_SQL}
IDS = WORDS | {"ids": IDS_SQL}
PLACED = IDS | {
    "placed": "SELECT split, token_id, row_number() OVER (PARTITION BY split ORDER BY doc_id, pos) - 1 AS place FROM ids"
}
LENGTHS_SQL = "SELECT split, doc_id, CAST(len(regexp_extract_all(text, '\\S+')) AS BIGINT) AS n FROM corpus"


def corpus(inputs: Inputs) -> DataFrame:
    return scan_corpus(
        inputs.spark,
        f"{inputs.sf_dir}/documents.parquet",
        split=F.expr("CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END"),
    )


def vocab(inputs: Inputs) -> DataFrame:
    return tokens.build_vocab(corpus(inputs), vocab_size=VOCAB_SIZE)


def blocks(inputs: Inputs) -> DataFrame:
    return packing.pack_corpus(corpus(inputs), vocab(inputs), BLOCK_SIZE)


def as_text(column: str):
    return F.array_join(F.transform(column, lambda t: t.cast("string")), " ")


@query("scan_corpus", with_tables(["corpus"], "SELECT split, doc_id, text FROM corpus"))
def _scan(inputs: Inputs) -> DataFrame:
    return corpus(inputs)


@query(
    "split_counts",
    with_tables(
        ["corpus"],
        f"SELECT split, CAST(sum(n) // {BLOCK_SIZE} AS BIGINT) AS examples FROM lengths GROUP BY split",
        {"lengths": LENGTHS_SQL},
    ),
)
def _split_counts(inputs: Inputs) -> DataFrame:
    return split_counts(blocks(inputs))


@query(
    "build_vocab",
    with_tables(
        ["corpus"],
        "SELECT token, token_id, freq FROM words UNION ALL SELECT * FROM (VALUES ('<pad>', 0, 0), ('<bos>', 1, 0), "
        "('<eos>', 2, 0), ('<unk>', 3, 0)) AS s(token, token_id, freq)",
        WORDS,
    ),
)
def _vocab(inputs: Inputs) -> DataFrame:
    return vocab(inputs)


@query(
    "special_ids",
    with_tables(
        ["corpus"],
        "SELECT 2 AS pad_token_id, 0 AS bos_token_id, 2 AS eos_token_id, CAST(count(*) + 4 AS BIGINT) AS vocab_size "
        "FROM words",
        WORDS,
    ),
)
def _special_ids(inputs: Inputs) -> DataFrame:
    return tokens.special_ids(vocab(inputs), {"eos": "<eos>", "unk": "<unk>"})


@query(
    "tokenize",
    with_tables(
        ["corpus"],
        "SELECT c.split, c.doc_id, COALESCE(i.input_ids, '') AS input_ids, CAST(COALESCE(i.n, 0) AS BIGINT) AS n "
        "FROM corpus AS c LEFT JOIN (SELECT doc_id, string_agg(CAST(token_id AS STRING), ' ' ORDER BY pos) AS input_ids, "
        "count(*) AS n FROM ids GROUP BY doc_id) AS i USING (doc_id)",
        IDS,
    ),
)
def _tokenize(inputs: Inputs) -> DataFrame:
    coded = tokens.tokenize(corpus(inputs), vocab(inputs))
    return coded.select(
        "split", "doc_id", as_text("input_ids").alias("input_ids"), F.size("input_ids").cast("bigint").alias("n")
    )


@query(
    "token_vocab_join",
    with_tables(
        ["corpus"],
        "SELECT split, CAST(token_id AS INT) AS token_id, count(*) AS occurrences FROM ids GROUP BY split, token_id",
        IDS,
    ),
)
def _token_vocab_join(inputs: Inputs) -> DataFrame:
    exploded = corpus(inputs).select("split", F.explode(tokens.pretokens(F.col("text"))).alias("token"))
    return (
        tokens.join_vocab(exploded, vocab(inputs), 3)
        .groupBy("split", "token_id")
        .agg(F.count("*").alias("occurrences"))
    )


@query(
    "token_offsets",
    with_tables(
        ["corpus"],
        'SELECT split, doc_id, n, CAST(sum(n) OVER (PARTITION BY split ORDER BY doc_id) - n AS BIGINT) AS "start" '
        "FROM lengths",
        {"lengths": LENGTHS_SQL},
    ),
)
def _token_offsets(inputs: Inputs) -> DataFrame:
    words = corpus(inputs).select("split", "doc_id", tokens.pretokens(F.col("text")).alias("words"))
    return packing.token_offsets(
        words, column="words", lengths=packing.doc_lengths(corpus(inputs))
    ).select("split", "doc_id", "n", "start")


@query(
    "pack_blocks",
    with_tables(
        ["corpus"],
        f"SELECT split, CAST(place // {BLOCK_SIZE} AS BIGINT) AS block_idx, "
        "string_agg(CAST(token_id AS STRING), ' ' ORDER BY place) AS input_ids FROM placed "
        f"GROUP BY split, place // {BLOCK_SIZE} HAVING count(*) = {BLOCK_SIZE}",
        PLACED,
    ),
)
def _pack_blocks(inputs: Inputs) -> DataFrame:
    return blocks(inputs).select("split", "block_idx", as_text("input_ids").alias("input_ids"))


@query(
    "labels_copy",
    with_tables(
        ["corpus"],
        f"SELECT split, CAST(place // {BLOCK_SIZE} AS BIGINT) AS block_idx, "
        "string_agg(CAST(token_id AS STRING), ' ' ORDER BY place) AS labels, true AS same FROM placed "
        f"GROUP BY split, place // {BLOCK_SIZE} HAVING count(*) = {BLOCK_SIZE}",
        PLACED,
    ),
)
def _labels_copy(inputs: Inputs) -> DataFrame:
    return blocks(inputs).select(
        "split", "block_idx", as_text("labels").alias("labels"), (F.col("labels") == F.col("input_ids")).alias("same")
    )


SCOPE_SQL = (
    "SELECT split, doc_id, shard * ((rows_in_split // {p} + {b}) // {b}) + (i - (shard * (rows_in_split // {p}) + "
    "least(shard, rows_in_split % {p}))) // {b} AS scope FROM (SELECT *, CASE WHEN i < (rows_in_split % {p}) * "
    "(rows_in_split // {p} + 1) THEN i // (rows_in_split // {p} + 1) ELSE rows_in_split % {p} + "
    "(i - (rows_in_split % {p}) * (rows_in_split // {p} + 1)) // (rows_in_split // {p}) END AS shard FROM "
    "(SELECT split, doc_id, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS i, "
    "count(*) OVER (PARTITION BY split) AS rows_in_split FROM corpus) AS n) AS s"
).format(p=NUM_PROC, b=BATCH_ROWS)


@query(
    "pack_scope",
    with_tables(
        ["corpus"],
        f"SELECT split, CAST(scope AS BIGINT) AS scope, CAST(place // {BLOCK_SIZE} AS BIGINT) AS block_idx, "
        "string_agg(CAST(token_id AS STRING), ' ' ORDER BY place) AS input_ids FROM (SELECT i.split, s.scope, "
        "i.token_id, row_number() OVER (PARTITION BY i.split, s.scope ORDER BY i.doc_id, i.pos) - 1 AS place "
        "FROM ids AS i JOIN scopes AS s USING (doc_id)) AS p "
        f"GROUP BY split, scope, place // {BLOCK_SIZE} HAVING count(*) = {BLOCK_SIZE}",
        IDS | {"scopes": SCOPE_SQL},
    ),
)
def _pack_scope(inputs: Inputs) -> DataFrame:
    coded = tokens.tokenize(corpus(inputs), vocab(inputs))
    packed = packing.pack_blocks(coded, BLOCK_SIZE, batch_rows=BATCH_ROWS, num_proc=NUM_PROC)
    return packed.select("split", "scope", "block_idx", as_text("input_ids").alias("input_ids"))


@query(
    "pack_stats",
    with_tables(
        ["corpus"],
        "SELECT split, CAST(count(*) FILTER (tokens_in_block = {0}) AS BIGINT) AS blocks, "
        "CAST(sum(tokens_in_block) AS BIGINT) AS tokens, "
        "CAST(COALESCE(sum(tokens_in_block) FILTER (tokens_in_block < {0}), 0) AS BIGINT) AS dropped_tokens "
        "FROM (SELECT split, place // {0} AS b, count(*) AS tokens_in_block FROM placed GROUP BY split, place // {0}) "
        "AS g GROUP BY split".format(BLOCK_SIZE),
        PLACED,
    ),
)
def _pack_stats(inputs: Inputs) -> DataFrame:
    stats = packing.pack_stats(packing.doc_lengths(corpus(inputs)), BLOCK_SIZE)
    return packing.require_blocks(stats)
