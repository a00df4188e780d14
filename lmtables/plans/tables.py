"""Input tables of the registered queries, derived row by row from the given tables.

Each derivation is a list of projections whose expressions mean the same in Spark SQL and in DuckDB; where the two
spell a function differently, a pair gives both. The operators under test are not used here.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


Expression = str | tuple[str, str]


@dataclass(frozen=True)
class Derived:
    source: str
    layers: tuple[dict[str, Expression], ...]
    where: str | None = None

    def spark(self, load: Callable[[str], DataFrame]) -> DataFrame:
        df = load(self.source)
        for layer in self.layers:
            df = df.selectExpr(*[f"{_side(e, 0)} AS {name}" for name, e in layer.items()])
        return df.where(self.where) if self.where else df

    def sql(self) -> str:
        text = self.source
        for depth, layer in enumerate(self.layers):
            columns = ", ".join(f"{_side(e, 1)} AS {name}" for name, e in layer.items())
            inner = text if depth == 0 else f"({text}) AS t{depth}"
            text = f"SELECT {columns} FROM {inner}"
        return f"SELECT * FROM ({text}) AS t WHERE {self.where}" if self.where else text


def _side(expression: Expression, side: int) -> str:
    return expression if isinstance(expression, str) else expression[side]


def each(*items: str) -> tuple[str, str]:
    """One row per item."""
    return f"explode(array({', '.join(items)}))", f"unnest([{', '.join(items)}])"


def mapped(values: str, body: str) -> tuple[str, str]:
    """A new array from an expression over ``v``."""
    return f"transform({values}, v -> {body})", f"list_transform({values}, lambda v: {body})"


def sliced(values: str, first: int, last: int) -> tuple[str, str]:
    return f"slice({values}, {first}, {last - first + 1})", f"{values}[{first}:{last}]"


KEEP_SUBMISSION = {
    name: name
    for name in (
        "event_id", "repo_id", "pr_num", "created_at", "author", "round", "status", "title", "k", "raw_worker", "value"
    )
}

SUBMISSION_BASE = {
    "event_id": "event_id",
    "repo_id": "'org/model-' || CAST(user_id % 3 AS STRING)",
    "pr_num": "event_id",
    "created_at": "ts",
    "author": "'user' || CAST(user_id % 20 AS STRING)",
    "round": "CAST(CAST(ts AS DATE) - DATE '2024-01-01' AS INT)",
    "status": "CASE event_type WHEN 'click' THEN 'open' WHEN 'view' THEN 'open' WHEN 'purchase' THEN 'draft' "
    "WHEN 'signup' THEN 'merged' ELSE 'closed' END",
    "title": "CASE WHEN event_id % 7 = 0 THEN 'Fix a typo' ELSE '[swarm] update ' || CAST(event_id AS STRING) END",
    "k": "CAST(substring(props, 7, length(props) - 7) AS INT)",
    "raw_worker": "'gpu ' || CAST(event_id % 3 AS STRING)",
    "value": "value",
}

# One layer more: ids and paths of the update that a submission carries. An older round is claimed now and then.
UPDATE_IDS = KEEP_SUBMISSION | {
    "worker_id": "'gpu-' || CAST(event_id % 3 AS STRING)",
    "update_id": "md5('update-' || CAST(event_id AS STRING))",
    "n_events": "CAST(1 + event_id % 3 AS INT)",
    "claimed_round": "CASE WHEN event_id % 43 = 0 AND round > 0 THEN round - 1 ELSE round END",
}
UPDATE_PATHS = UPDATE_IDS | {
    "worker_id": "worker_id",
    "update_id": "update_id",
    "n_events": "n_events",
    "claimed_round": "claimed_round",
    "last_commit": "CASE WHEN event_id % 2 = 0 THEN n_events - 1 ELSE n_events END",
    "folder": "'swarm/updates/round-' || lpad(CAST(claimed_round AS STRING), 6, '0') || '/' || worker_id || '/' || "
    "update_id",
}
UPDATE_FIELDS = KEEP_SUBMISSION | {
    name: name for name in ("worker_id", "update_id", "n_events", "claimed_round", "folder")
} | {
    "revision": "CASE WHEN last_commit > 0 THEN md5('commit-' || CAST(event_id AS STRING) || '-' || "
    "CAST(last_commit AS STRING)) END",
    "first_delta": "folder || '/delta-00001-of-00002.safetensors'",
    "second_delta": "CASE WHEN event_id % 23 = 0 THEN '../delta-00002-of-00002.safetensors' "
    "ELSE folder || '/delta-00002-of-00002.safetensors' END",
}
BODY = (
    "'{\"protocol_version\": ' || CASE WHEN event_id % 13 = 0 THEN '2' ELSE '1' END || "
    "', \"update_id\": \"' || update_id || '\", \"worker_id\": \"' || worker_id || "
    "'\", \"round\": ' || CAST(CASE WHEN event_id % 47 = 0 THEN claimed_round + 1 ELSE claimed_round END AS STRING) || "
    "', \"base_model_revision\": \"' || repo_id || '@' || "
    "CAST(CASE WHEN event_id % 11 = 0 THEN claimed_round - 1 ELSE claimed_round END AS STRING) || "
    "'\", \"delta_files\": ' || CASE WHEN event_id % 37 = 0 THEN '[]' WHEN event_id % 41 = 0 THEN '\"none\"' "
    "ELSE '[\"' || first_delta || '\", \"' || second_delta || '\"]' END || "
    "CASE WHEN event_id % 17 = 0 THEN '' ELSE ', \"tensor_count\": 10' END || "
    "', \"local_steps\": ' || CAST(k - 3 AS STRING) || "
    "', \"num_tokens\": ' || CASE WHEN event_id % 19 = 0 THEN 'null' "
    "ELSE CAST(CAST(k - 3 AS BIGINT) * 16384 AS STRING) END || "
    "', \"block_size\": 2048}'"
)

TABLES: dict[str, Derived] = {
    "corpus": Derived(
        "documents",
        (
            {
                "split": "CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END",
                "doc_id": "doc_id",
                "text": "text",
            },
        ),
    ),
    "submissions": Derived("events", (SUBMISSION_BASE,)),
    "updates": Derived("events", (SUBMISSION_BASE, UPDATE_IDS, UPDATE_PATHS, UPDATE_FIELDS)),
    # One to three events per submission; the last one of an even submission has no commit.
    "submission_events": Derived(
        "events",
        (
            {
                "event_id": "event_id",
                "repo_id": "'org/model-' || CAST(user_id % 3 AS STRING)",
                "seq": each("1", "2", "3"),
            },
            {
                "repo_id": "repo_id",
                "pr_num": "event_id",
                "seq": "CAST(seq AS INT)",
                "n_events": "1 + event_id % 3",
                "oid": "CASE WHEN event_id % 2 = 0 AND seq = 1 + event_id % 3 THEN NULL ELSE md5('commit-' || "
                "CAST(event_id AS STRING) || '-' || CAST(seq AS STRING)) END",
            },
        ),
        "seq <= n_events",
    ),
    "repo_files": Derived(
        "events",
        (
            SUBMISSION_BASE,
            UPDATE_IDS,
            UPDATE_PATHS,
            UPDATE_FIELDS,
            {
                "repo_id": "repo_id",
                "revision": "revision",
                "path": each(
                    "'README.md'",
                    "folder || '/metadata.json'",
                    "CASE WHEN event_id % 31 = 0 THEN folder || '/copy/metadata.json' END",
                    "first_delta",
                    "CASE WHEN event_id % 29 <> 0 THEN second_delta END",
                ),
            },
        ),
        "path IS NOT NULL AND revision IS NOT NULL",
    ),
    "documents_json": Derived(
        "events",
        (
            SUBMISSION_BASE,
            UPDATE_IDS,
            UPDATE_PATHS,
            UPDATE_FIELDS,
            {
                "repo_id": "repo_id",
                "revision": "revision",
                "path": "folder || '/metadata.json'",
                "body": BODY,
                "event_id": "event_id",
            },
        ),
    ),
    # One row per event, reduced to one per (repo_id, round) below.
    "round_rows": Derived(
        "events",
        (
            SUBMISSION_BASE,
            {
                "repo_id": "repo_id",
                "round": "round",
                "base_model_revision": "repo_id || '@' || CAST(round AS STRING)",
                "min_updates": "CASE WHEN round % 5 = 0 THEN 1000 ELSE 2 + round % 3 END",
                "max_updates": "CASE WHEN round % 5 = 0 THEN 2000 ELSE 8 END",
            },
        ),
    ),
    "allowed_authors": Derived("events", ({"author": "'user' || CAST(user_id % 20 AS STRING)"},), "author <> 'user7'"),
    "base": Derived(
        "embeddings",
        (
            {
                # The model is named by the width of its vectors.
                "revision": ("'rev-' || CAST(size(embedding) AS STRING)", "'rev-' || CAST(len(embedding) AS STRING)"),
                "name": "'block.' || CAST(label AS STRING) || '.weight'",
                "chunk_id": "CAST(vec_id AS INT)",
                "label": "CAST(label AS INT)",
                "shard": "'model-0000' || CAST(label % 3 + 1 AS STRING) || '-of-00003.safetensors'",
                "values": "embedding",
            },
        ),
    ),
    # Files of many checkpoints; some lack the model code, some the weights, some have an index instead.
    "checkpoint_files": Derived(
        "embeddings",
        (
            {
                "revision": "'rev-' || CAST(vec_id AS STRING)",
                "path": each(
                    "'config.json'",
                    "'tokenizer_config.json'",
                    "CASE WHEN vec_id % 7 <> 0 THEN 'modeling.py' END",
                    "CASE WHEN vec_id % 3 = 0 THEN 'model.safetensors' END",
                    "CASE WHEN vec_id % 3 = 1 THEN 'model.safetensors.index.json' END",
                    "'swarm/state.json'",
                ),
            },
        ),
        "path IS NOT NULL",
    ),
    "current_files": Derived(
        "embeddings",
        (
            {
                "repo_id": "'org/model-' || CAST(vec_id % 17 AS STRING)",
                "path": each(
                    "'config.json'",
                    "'model-0000' || CAST(label % 4 + 1 AS STRING) || '-of-00004.safetensors'",
                    "'model.safetensors.index.json'",
                    "'optimizer.safetensors'",
                ),
            },
        ),
    ),
    "new_files": Derived(
        "embeddings",
        (
            {
                "repo_id": "'org/model-' || CAST(vec_id % 17 AS STRING)",
                "path": each(
                    "'config.json'",
                    "'model-0000' || CAST(label % 4 + 1 AS STRING) || '-of-0000' || "
                    "CAST(4 - vec_id % 17 % 2 AS STRING) || '.safetensors'",
                    "'model.safetensors.index.json'",
                ),
            },
        ),
    ),
    # A tensor that lies in two shards, and an index that leaves one shard out.
    "sharded": Derived(
        "embeddings",
        (
            {
                "name": "'block.' || CAST(label AS STRING) || '.weight'",
                "chunk_id": "CAST(vec_id AS INT)",
                "label": "label",
                "shard": "'model-0000' || CAST(CASE WHEN label = 3 AND vec_id % 2 = 0 THEN 2 ELSE label % 3 + 1 END "
                "AS STRING) || '-of-00003.safetensors'",
            },
        ),
    ),
    # Four workers in the varying form; worker 4 lacks one tensor, worker 3 has one of a wrong kind of values.
    "local": Derived(
        "embeddings",
        (
            {"vec_id": "vec_id", "label": "label", "embedding": "embedding", "w": each("1", "2", "3", "4")},
            {
                "update_id": "'update-' || CAST(w AS STRING)",
                "revision": ("'rev-' || CAST(size(embedding) AS STRING)", "'rev-' || CAST(len(embedding) AS STRING)"),
                "w": "CAST(w AS INT)",
                "name": "'block.' || CAST(label AS STRING) || '.weight'",
                "chunk_id": "CAST(vec_id AS INT)",
                "label": "CAST(label AS INT)",
                "values": mapped(
                    "embedding",
                    "CAST(CAST(v AS DOUBLE) * (1 - CAST(w AS DOUBLE) / 20) - CAST(w AS DOUBLE) / 10 AS FLOAT)",
                ),
            },
        ),
        "NOT (w = 4 AND label = 9)",
    ),
    # Averages of six rounds per chunk.
    "averages": Derived(
        "embeddings",
        (
            {"vec_id": "vec_id", "label": "label", "embedding": "embedding", "round": each("0", "1", "2", "3", "4", "5")},
            {
                "name": "'block.' || CAST(label AS STRING) || '.weight'",
                "chunk_id": "CAST(vec_id AS INT)",
                "round": "CAST(round AS INT)",
                "values": mapped("embedding", "CAST(v AS DOUBLE) * (1 + CAST(round AS DOUBLE) / 4)"),
            },
        ),
    ),
    "router_logits": Derived(
        "embeddings",
        (
            {"layer": "CAST(label AS INT)", "token_id": "vec_id", "first": sliced("embedding", 1, 8)},
            {"layer": "layer", "token_id": "token_id", "logits": mapped("first", "CAST(v * 10 AS FLOAT)")},
        ),
    ),
    "token_logits": Derived(
        "embeddings",
        (
            {"vec_id": "vec_id", "middle": sliced("embedding", 9, 24)},
            {
                "seq_id": "CAST(floor(vec_id / 16) AS BIGINT)",
                "pos": "CAST(vec_id % 16 AS INT)",
                "label": "CAST(CASE WHEN vec_id % 5 = 0 THEN -100 ELSE vec_id % 16 END AS INT)",
                "logits": mapped("middle", "CAST(v * 10 AS FLOAT)"),
            },
        ),
    ),
    "masks": Derived(
        "conversations",
        ({"conv_id": "conv_id", "turn": "turn", "mask": "CAST(CASE WHEN role = 'system' THEN 0 ELSE 1 END AS INT)"},),
    ),
    "completions": Derived(
        "conversations", ({"conv_id": "conv_id", "turn": "turn", "text": "text", "role": "role"},), "role = 'assistant'"
    ),
}


class Inputs:
    """Loads given and derived tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __call__(self, name: str) -> DataFrame:
        if name == "rounds":
            return self._rounds()
        return TABLES[name].spark(self.given)

    def _rounds(self) -> DataFrame:
        policy = (
            "named_struct('min_updates', CAST(min_updates AS INT), 'max_updates', CAST(max_updates AS INT), "
            "'local_steps', 500, 'outer_lr', 0.7D, 'outer_momentum', 0.9D, 'nesterov', true, "
            "'update_dtype', 'bfloat16') AS policy"
        )
        return self("round_rows").distinct().selectExpr(
            "repo_id", "CAST(round AS BIGINT) AS seq", "1 AS protocol_version", "'open' AS status", "round",
            "base_model_revision", policy,
        )


ROUNDS_SQL = (
    "SELECT DISTINCT repo_id, CAST(round AS BIGINT) AS seq, 1 AS protocol_version, 'open' AS status, round, "
    "base_model_revision, CAST(min_updates AS INT) AS min_updates, CAST(max_updates AS INT) AS max_updates "
    "FROM round_rows"
)


def with_tables(names: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """A DuckDB statement with the named derived tables in front of it."""
    parts = []
    for name in names:
        if name == "rounds":
            if "round_rows" not in names:
                parts.append(f"round_rows AS ({TABLES['round_rows'].sql()})")
            parts.append(f"rounds AS ({ROUNDS_SQL})")
        else:
            parts.append(f"{name} AS ({TABLES[name].sql()})")
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body
