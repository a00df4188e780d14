"""Scalar function and user function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.functions import identifiers as ids
from lmtables.functions import sizes
from lmtables.functions import user
from lmtables.functions import vectors as V
from lmtables.plans.registry import query
from lmtables.plans.tables import Inputs, with_tables

SANITIZED_SQL = "substr(trim(regexp_replace({0}, '[^A-Za-z0-9_.-]+', '-', 'g'), '-.'), 1, 80)"


@query(
    "sanitize_id",
    "SELECT doc_id, nullif({0}, '') AS id FROM documents".format(SANITIZED_SQL.format("text")),
)
def _sanitize(inputs: Inputs) -> DataFrame:
    return inputs.given("documents").select("doc_id", ids.sanitize_id(F.col("text")).alias("id"))


SIZE_TEXT = (
    "CAST(event_id % 1000 AS STRING) || CASE event_id % 8 WHEN 0 THEN 'GB' WHEN 1 THEN ' mb' WHEN 2 THEN '.5KB ' "
    "WHEN 3 THEN '' WHEN 4 THEN 'B' WHEN 5 THEN 'TB' WHEN 6 THEN '.25 gB' ELSE 'x' END"
)


@query(
    "parse_size",
    f"SELECT event_id, size_text, CAST(CASE event_id % 8 WHEN 0 THEN n * 1000000000 WHEN 1 THEN n * 1000000 "
    "WHEN 2 THEN n * 1000 + 500 WHEN 3 THEN n WHEN 6 THEN n * 1000000000 + 250000000 END AS BIGINT) AS bytes FROM ("
    f"SELECT event_id, event_id % 1000 AS n, {SIZE_TEXT} AS size_text FROM events) AS e",
)
def _size(inputs: Inputs) -> DataFrame:
    rows = inputs.given("events").selectExpr("event_id", f"{SIZE_TEXT} AS size_text")
    return rows.withColumn("bytes", sizes.parse_size(F.col("size_text")))


@query(
    "worker_seed",
    with_tables(
        ["updates"],
        "SELECT pr_num, CAST((42 + CAST(round AS BIGINT) * 1000003 + CAST('0x' || substr(sha256(worker_id || update_id), 1, 8) "
        "AS BIGINT)) % 2147483648 AS BIGINT) AS seed FROM updates",
    ),
)
def _seed(inputs: Inputs) -> DataFrame:
    who = F.concat("worker_id", "update_id")
    return inputs("updates").select("pr_num", ids.worker_seed(F.lit(42), F.col("round"), who).alias("seed"))


@query(
    "update_path",
    with_tables(
        ["updates"],
        "SELECT pr_num, 'swarm/updates/round-' || lpad(CAST(round AS STRING), 6, '0') || '/' || worker_id || '/' || "
        "update_id || '/metadata.json' AS path FROM updates",
    ),
)
def _path(inputs: Inputs) -> DataFrame:
    path = ids.update_path(F.col("round"), F.col("worker_id"), F.col("update_id"), F.lit(ids.METADATA_FILE))
    return inputs("updates").select("pr_num", path.alias("path"))


@query(
    "parent_dir",
    with_tables(
        ["repo_files"],
        "SELECT revision, path, CASE WHEN contains(path, '/') THEN left(path, length(path) - "
        "position('/' IN reverse(path)) + 1) ELSE '' END AS folder FROM repo_files",
    ),
)
def _parent(inputs: Inputs) -> DataFrame:
    return inputs("repo_files").select("revision", "path", ids.parent_dir(F.col("path")).alias("folder"))


@query("identity", with_tables(["updates"], "SELECT pr_num, author || '/' || worker_id AS identity FROM updates"))
def _identity(inputs: Inputs) -> DataFrame:
    return inputs("updates").select("pr_num", ids.identity(F.col("author"), F.col("worker_id")).alias("identity"))


@query(
    "update_id",
    with_tables(
        ["updates"],
        "SELECT pr_num, md5(repo_id || '|' || CAST(round AS STRING) || '|' || worker_id || '|' || CAST(pr_num % 2 AS STRING)) "
        "AS update_id FROM updates",
    ),
)
def _update_id(inputs: Inputs) -> DataFrame:
    made = ids.update_id(F.col("repo_id"), F.col("round"), F.col("worker_id"), F.col("pr_num") % 2)
    return inputs("updates").select("pr_num", made.alias("update_id"))


@query("short_revision", with_tables(["updates"], "SELECT pr_num, left(revision, 12) AS short_revision FROM updates"))
def _short(inputs: Inputs) -> DataFrame:
    return inputs("updates").select("pr_num", ids.short_revision(F.col("revision")).alias("short_revision"))


@query(
    "tensor_bytes",
    "SELECT label, dtype, CAST(count(*) * 64 * CASE dtype WHEN 'float32' THEN 4 ELSE 2 END AS BIGINT) AS bytes FROM "
    "(SELECT label, CASE label % 3 WHEN 0 THEN 'float32' WHEN 1 THEN 'float16' ELSE 'bfloat16' END AS dtype FROM embeddings) "
    "AS e GROUP BY label, dtype",
)
def _bytes(inputs: Inputs) -> DataFrame:
    shaped = (
        inputs.given("embeddings")
        .selectExpr("label", "CASE label % 3 WHEN 0 THEN 'float32' WHEN 1 THEN 'float16' ELSE 'bfloat16' END AS dtype")
        .groupBy("label", "dtype")
        .agg(F.array(F.count("*"), F.lit(64).cast("bigint")).alias("shape"))
    )
    return shaped.select("label", "dtype", sizes.tensor_bytes(F.col("shape"), F.col("dtype")).alias("bytes"))


@query(
    "json_sorted",
    with_tables(
        ["updates"],
        "SELECT pr_num, '{\"policy\":{\"max_updates\":8,\"min_updates\":' || CAST(k AS STRING) || '},\"round\":' || "
        "CAST(round AS STRING) || ',\"worker_id\":\"' || worker_id || '\"}' AS document FROM updates",
    ),
)
def _json(inputs: Inputs) -> DataFrame:
    document = ids.json_sorted(
        {
            "worker_id": F.col("worker_id"),
            "round": F.col("round"),
            "policy": {"min_updates": F.col("k"), "max_updates": F.lit(8)},
        }
    )
    return inputs("updates").select("pr_num", document.alias("document"))


@query(
    "softmax",
    with_tables(
        ["router_logits"],
        "SELECT layer, token_id, expert, round(CAST(CAST(exp(x - top) / sum(exp(x - top)) OVER (PARTITION BY token_id) AS FLOAT) AS DOUBLE), 6) AS prob FROM "
        "(SELECT *, max(x) OVER (PARTITION BY token_id) AS top FROM (SELECT layer, token_id, "
        "CAST(unnest(logits) AS DOUBLE) AS x, CAST(unnest(range(len(logits))) AS INT) AS expert FROM router_logits) AS f) AS t",
    ),
)
def _softmax(inputs: Inputs) -> DataFrame:
    return inputs("router_logits").select(
        "layer", "token_id", F.posexplode(V.softmax(F.col("logits"))).alias("expert", "p")
    ).select("layer", "token_id", "expert", F.round(F.col("p").cast("double"), 6).alias("prob"))


@query(
    "batched_map",
    "SELECT conv_id, turn, CAST(len(regexp_extract_all(text, '\\S+')) AS BIGINT) AS words FROM conversations "
    "WHERE length(text) % 3 <> 0",
)
def _map(inputs: Inputs) -> DataFrame:
    def count_words(batch: dict[str, list]) -> dict[str, list]:
        kept = [i for i, text in enumerate(batch["text"]) if text is not None and len(text) % 3]
        return {
            "conv_id": [batch["conv_id"][i] for i in kept],
            "turn": [batch["turn"][i] for i in kept],
            "words": [len(batch["text"][i].split()) for i in kept],
        }

    return user.batched_map(
        inputs.given("conversations"),
        count_words,
        "conv_id BIGINT, turn BIGINT, words BIGINT",
        columns=["conv_id", "turn", "text"],
    )


REWARD_SQL = (
    "SELECT conv_id, turn, CASE WHEN len(regexp_extract_all(text, '\\S+')) BETWEEN 20 AND 60 THEN 1.0::DOUBLE "
    "ELSE 0.0::DOUBLE END AS reward FROM completions"
)


@query("reward_udf", with_tables(["completions"], REWARD_SQL))
def _reward_udf(inputs: Inputs) -> DataFrame:
    def length_reward(completions: list[str], low: int, high: int) -> list[float]:
        return [1.0 if low <= len(c.split()) <= high else 0.0 for c in completions]

    reward = user.reward_udf(length_reward, low=user.REWARD_MIN_WORDS, high=user.REWARD_MAX_WORDS)
    return inputs("completions").select("conv_id", "turn", reward(F.col("text")).alias("reward"))


@query("reward_correct_length", with_tables(["completions"], REWARD_SQL))
def _reward(inputs: Inputs) -> DataFrame:
    return inputs("completions").select("conv_id", "turn", user.reward_correct_length(F.col("text")).alias("reward"))
