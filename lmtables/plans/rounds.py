"""Round lifecycle queries: states, locks, markers, file sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.operators import rounds as R
from lmtables.plans.ledger import CHAIN, GIVEN, accepted, chain_sql, chosen
from lmtables.operators.submissions import select_quorum
from lmtables.plans.registry import query
from lmtables.plans.tables import Inputs, with_tables
from lmtables.sources.tensors import checkpoint_complete

NOW = "2024-02-01 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def states(inputs: Inputs) -> DataFrame:
    """Each round's open state in the full layout of the rounds table."""
    return inputs("rounds").select(
        "repo_id",
        "seq",
        "protocol_version",
        "status",
        "round",
        "base_model_revision",
        F.lit(None).cast(R.PENDING_TYPE).alias("pending_merge"),
        F.col("policy").cast(R.POLICY_TYPE).alias("policy"),
        F.lit(None).cast(R.MARKER_TYPE).alias("last_merge"),
        now().alias("updated_at"),
    )


def locked(inputs: Inputs) -> DataFrame:
    return R.lock_rounds(states(inputs), chosen(inputs), now())


def norms(inputs: Inputs) -> DataFrame:
    return inputs("updates").select("repo_id", "round", "pr_num", F.col("value").alias("verified_norm"))


def markers(inputs: Inputs, merging: DataFrame) -> DataFrame:
    """Markers of locked rounds as published: every fourth round lost one id, the others list theirs in reverse."""
    listed = F.col("marker.update_ids")
    spoiled = F.when(F.col("round") % 4 == 0, F.slice(listed, F.lit(2), F.size(listed))).otherwise(F.reverse(listed))
    return R.merge_markers(merging, norms(inputs), now()).select(
        "repo_id",
        "round",
        F.col("marker").withField("update_ids", spoiled).alias("marker"),
        R.merged_revision(F.col("repo_id"), F.col("round"), F.col("marker.update_ids")).alias("model_revision"),
    )


LISTS = {
    "lists": "SELECT c.repo_id, c.round, count(*) AS n, string_agg(update_id, ' ' ORDER BY merge_rank) AS update_ids, "
    "string_agg(author || '/' || worker_id, ' ' ORDER BY merge_rank) AS participants, "
    "string_agg(update_id, ',' ORDER BY update_id) AS sorted_ids FROM chosen AS c GROUP BY c.repo_id, c.round"
}


@query(
    "init_round",
    with_tables(
        ["submissions"],
        "SELECT repo_id, CAST(0 AS BIGINT) AS seq, 'open' AS status, 0 AS round, repo_id || '@init' AS base_model_revision, "
        "2 AS min_updates FROM (SELECT DISTINCT 'org/fork-' || author AS repo_id FROM submissions) AS r "
        "WHERE repo_id NOT IN ('org/fork-user3', 'org/fork-user4', 'org/fork-user5')",
    ),
)
def _init(inputs: Inputs) -> DataFrame:
    asked = inputs("submissions").selectExpr("'org/fork-' || author AS repo_id").distinct()
    requests = asked.select(
        "repo_id",
        F.concat("repo_id", F.lit("@init")).alias("base_model_revision"),
        F.expr(
            "named_struct('min_updates', 2, 'max_updates', 8, 'local_steps', 500, 'outer_lr', 0.7D, "
            "'outer_momentum', 0.9D, 'nesterov', true, 'update_dtype', 'bfloat16')"
        ).alias("policy"),
    )
    # One repository has no tokenizer yet.
    stored = ["config.json", "tokenizer_config.json", "modeling.py", "model.safetensors.index.json"]
    files = asked.select(
        F.concat("repo_id", F.lit("@init")).alias("revision"), F.explode(F.array(*map(F.lit, stored))).alias("path")
    ).where("NOT (revision = 'org/fork-user5@init' AND path = 'tokenizer_config.json')")
    existing = R.init_rounds(
        requests.where("repo_id IN ('org/fork-user3', 'org/fork-user4')"), states(inputs), now()
    )
    complete = checkpoint_complete(files, "modeling.py")
    return R.init_rounds(requests, existing, now(), checkpoints=complete).select(
        "repo_id", "seq", "status", "round", "base_model_revision", "policy.min_updates"
    )


@query(
    "lock_round",
    chain_sql(
        "SELECT r.repo_id, r.round, r.seq + 1 AS seq, 'merging' AS status, l.n AS pending, l.update_ids FROM rounds AS r "
        "JOIN lists AS l ON l.repo_id = r.repo_id AND l.round = r.round",
        LISTS,
    ),
)
def _lock(inputs: Inputs) -> DataFrame:
    return locked(inputs).select(
        "repo_id",
        "round",
        "seq",
        "status",
        F.size("pending_merge").cast("bigint").alias("pending"),
        F.array_join("pending_merge.update_id", " ").alias("update_ids"),
    )


@query(
    "rebuild_pending",
    chain_sql("SELECT repo_id, round, CAST(merge_rank AS INT) AS merge_rank, pr_num, revision, author, metadata_path FROM chosen"),
)
def _rebuild(inputs: Inputs) -> DataFrame:
    return R.rebuild_pending(locked(inputs)).select(
        "repo_id", "round", "merge_rank", "pr_num", "revision", "author", "metadata_path"
    )


@query(
    "merge_marker",
    chain_sql(
        "SELECT l.repo_id, l.round AS source_round, r.base_model_revision AS source_model_revision, l.update_ids, "
        "l.participants, CAST(0.7 AS DOUBLE) AS outer_lr, true AS nesterov, s.norm_sum FROM lists AS l JOIN rounds AS r "
        "ON r.repo_id = l.repo_id AND r.round = l.round JOIN (SELECT c.repo_id, c.round, round(sum(value), 6) AS norm_sum "
        "FROM chosen AS c JOIN submissions AS v ON v.pr_num = c.pr_num GROUP BY c.repo_id, c.round) AS s "
        "ON s.repo_id = l.repo_id AND s.round = l.round",
        LISTS,
    ),
)
def _marker(inputs: Inputs) -> DataFrame:
    total = F.aggregate(F.map_values("marker.verified_delta_norms"), F.lit(0.0), lambda acc, v: acc + v)
    return R.merge_markers(locked(inputs), norms(inputs), now()).select(
        "repo_id",
        "marker.source_round",
        "marker.source_model_revision",
        F.array_join("marker.update_ids", " ").alias("update_ids"),
        F.array_join("marker.participants", " ").alias("participants"),
        "marker.outer_lr",
        "marker.nesterov",
        F.round(total, 6).alias("norm_sum"),
    )


@query("same_update_set", chain_sql("SELECT repo_id, round, round % 4 <> 0 OR n = 0 AS same FROM lists", LISTS))
def _same(inputs: Inputs) -> DataFrame:
    same = R.same_update_set(F.col("marker.update_ids"), F.col("pending_merge.update_id"))
    merging = locked(inputs)
    return merging.join(markers(inputs, merging), ["repo_id", "round"]).select("repo_id", "round", same.alias("same"))


@query(
    "open_next_round",
    chain_sql(
        "SELECT l.repo_id, l.round + 1 AS round, r.seq + 2 AS seq, 'open' AS status, "
        "sha1(l.repo_id || '|' || CAST(l.round AS STRING) || '|' || l.sorted_ids) AS base_model_revision, "
        "true AS cleared, l.round AS merged_round FROM lists AS l JOIN rounds AS r ON r.repo_id = l.repo_id "
        "AND r.round = l.round WHERE l.round % 4 <> 0",
        LISTS,
    ),
)
def _next(inputs: Inputs) -> DataFrame:
    merging = locked(inputs)
    published = R.matching_markers(merging, markers(inputs, merging))
    return R.open_next_rounds(published, merging.columns, now()).select(
        "repo_id",
        "round",
        "seq",
        "status",
        "base_model_revision",
        F.col("pending_merge").isNull().alias("cleared"),
        F.col("last_merge.source_round").alias("merged_round"),
    )


@query(
    "close_accepted",
    chain_sql(
        "SELECT s.repo_id, s.pr_num, CASE WHEN c.pr_num IS NOT NULL THEN 'closed' ELSE s.status END AS status "
        "FROM submissions AS s LEFT JOIN chosen AS c ON c.repo_id = s.repo_id AND c.pr_num = s.pr_num"
    ),
)
def _close(inputs: Inputs) -> DataFrame:
    return R.close_accepted(inputs("submissions"), chosen(inputs)).select("repo_id", "pr_num", "status")


@query(
    "current_state",
    with_tables(
        ["rounds"],
        "SELECT repo_id, seq, round, base_model_revision FROM rounds QUALIFY row_number() OVER (PARTITION BY repo_id "
        "ORDER BY seq DESC) = 1",
    ),
)
def _current(inputs: Inputs) -> DataFrame:
    return R.current_states(states(inputs)).select("repo_id", "seq", "round", "base_model_revision")


WEIGHTS_SQL = (
    "SELECT DISTINCT repo_id, path FROM current_files WHERE starts_with(path, 'model') AND (suffix(path, '.safetensors') OR "
    "suffix(path, '.safetensors.index.json'))"
)


@query(
    "stale_weight_files",
    with_tables(
        ["current_files", "new_files"],
        f"{WEIGHTS_SQL} EXCEPT SELECT repo_id, path FROM new_files",
    ),
)
def _stale(inputs: Inputs) -> DataFrame:
    return R.stale_weight_files(inputs("current_files").distinct(), inputs("new_files").distinct())


@query(
    "commit_file_set",
    with_tables(
        ["current_files", "new_files"],
        "SELECT DISTINCT repo_id, path, 'add' AS operation FROM new_files UNION ALL SELECT DISTINCT repo_id, "
        "'swarm/merge-result.json', 'add' FROM new_files UNION ALL SELECT repo_id, path, 'delete' FROM ("
        f"{WEIGHTS_SQL} EXCEPT SELECT repo_id, path FROM new_files) AS s",
    ),
)
def _files(inputs: Inputs) -> DataFrame:
    return R.commit_file_set(inputs("current_files").distinct(), inputs("new_files").distinct())
