"""The life of a round as transitions over a table of states.

``rounds`` is append-only: (repo_id, seq, protocol_version, status, round, base_model_revision, pending_merge, policy,
last_merge, updated_at). ``seq`` counts the states of a repository; the current one has the highest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lmtables.functions.identifiers import INDEX_SUFFIX, MERGE_MARKER_PATH, PAYLOAD_SUFFIX, PROTOCOL_VERSION, identity
from lmtables.operators.submissions import ROUND

POLICY_TYPE = (
    "STRUCT<min_updates: INT, max_updates: INT, local_steps: INT, outer_lr: DOUBLE, outer_momentum: DOUBLE, "
    "nesterov: BOOLEAN, update_dtype: STRING>"
)
PENDING_TYPE = (
    "ARRAY<STRUCT<merge_rank: INT, pr_num: BIGINT, revision: STRING, author: STRING, worker_id: STRING, "
    "update_id: STRING, num_tokens: BIGINT, metadata_path: STRING>>"
)
MARKER_TYPE = (
    "STRUCT<protocol_version: INT, source_round: INT, source_model_revision: STRING, update_ids: ARRAY<STRING>, "
    "participants: ARRAY<STRING>, verified_delta_norms: MAP<STRING, DOUBLE>, outer_lr: DOUBLE, "
    "outer_momentum: DOUBLE, nesterov: BOOLEAN, merged_at: TIMESTAMP>"
)
ROUNDS_SCHEMA = (
    "repo_id STRING, seq BIGINT, protocol_version INT, status STRING, round INT, base_model_revision STRING, "
    f"pending_merge {PENDING_TYPE}, policy {POLICY_TYPE}, last_merge {MARKER_TYPE}, updated_at TIMESTAMP"
)


def current_states(rounds: DataFrame) -> DataFrame:
    """Latest state per repository."""
    others = [c for c in rounds.columns if c != "repo_id"]
    latest = F.max_by(F.struct(*others), F.col("seq"))
    return rounds.groupBy("repo_id").agg(latest.alias("state")).select("repo_id", "state.*").select(*rounds.columns)


def init_rounds(
    requests: DataFrame, rounds: DataFrame, now: Column | str, force: bool = False, *, checkpoints: DataFrame | None = None
) -> DataFrame:
    """Round 0 rows for the requested repositories; those that already have a state are left out unless forced.

    ``requests`` is (repo_id, base_model_revision, policy). A forced row follows the old states in ``seq``. With
    ``checkpoints`` (revision, complete), as :func:`lmtables.sources.tensors.checkpoint_complete` gives them, a round only
    starts on a revision that is there and complete; without it the caller vouches for the revisions.
    """
    if checkpoints is not None:
        usable = checkpoints.where("complete").select(F.col("revision").alias("base_model_revision")).distinct()
        requests = requests.join(usable, "base_model_revision", "left_semi")
    known = rounds.groupBy("repo_id").agg(F.max("seq").alias("last_seq"))
    if force:
        requests = requests.join(known, "repo_id", "left")
    else:
        requests = requests.join(known, "repo_id", "left_anti").withColumn("last_seq", F.lit(None).cast("bigint"))
    return requests.where("policy.min_updates > 0 AND policy.min_updates <= policy.max_updates").select(
        "repo_id",
        (F.coalesce("last_seq", F.lit(-1)) + 1).cast("bigint").alias("seq"),
        F.lit(PROTOCOL_VERSION).alias("protocol_version"),
        F.lit("open").alias("status"),
        F.lit(0).alias("round"),
        "base_model_revision",
        F.lit(None).cast(PENDING_TYPE).alias("pending_merge"),
        F.col("policy").cast(POLICY_TYPE).alias("policy"),
        F.lit(None).cast(MARKER_TYPE).alias("last_merge"),
        F.lit(now).cast("timestamp").alias("updated_at"),
    )


def policy_rejects(requests: DataFrame, checkpoints: DataFrame | None = None) -> DataFrame:
    """The requests that ``init_rounds`` turns away, with the reason; nulls in a policy make it invalid."""
    usable = F.coalesce(F.expr("policy.min_updates > 0 AND policy.min_updates <= policy.max_updates"), F.lit(False))
    reason = F.when(~usable, "policy")
    if checkpoints is not None:
        complete = checkpoints.groupBy(F.col("revision").alias("base_model_revision")).agg(F.bool_or("complete").alias("_complete"))
        requests = requests.join(complete, "base_model_revision", "left").select(*requests.columns, "_complete")
        reason = reason.when(~F.coalesce("_complete", F.lit(False)), "checkpoint")
    return requests.withColumn("reject_reason", reason).where("reject_reason IS NOT NULL").drop("_complete")


def pending_lists(chosen: DataFrame) -> DataFrame:
    """The chosen submissions of each round as one ordered list of at most ``max_updates`` entries."""
    entry = F.struct(
        F.col("merge_rank").cast("int").alias("merge_rank"),
        "pr_num",
        "revision",
        "author",
        "worker_id",
        "update_id",
        "num_tokens",
        "metadata_path",
    )
    return chosen.groupBy(*ROUND).agg(F.array_sort(F.collect_list(entry)).alias("pending_merge"))


def lock_rounds(states: DataFrame, chosen: DataFrame, now: Column | str) -> DataFrame:
    """Open states with chosen submissions become ``merging`` states that carry the list."""
    lists = pending_lists(chosen)
    return (
        states.where("status = 'open'")
        .drop("pending_merge")
        .join(lists, list(ROUND))
        .withColumn("status", F.lit("merging"))
        .withColumn("seq", F.col("seq") + 1)
        .withColumn("updated_at", F.lit(now).cast("timestamp"))
        .select(*states.columns)
    )


def rebuild_pending(states: DataFrame) -> DataFrame:
    """The submissions stored in locked states, as rows again."""
    return states.where("status = 'merging'").select(*ROUND, F.inline("pending_merge"))


def merge_markers(merging: DataFrame, norms: DataFrame, now: Column | str) -> DataFrame:
    """One marker per merged round. ``norms`` is (repo_id, round, pr_num, verified_norm): an update id that two
    submissions bear has a norm for each."""
    rows = rebuild_pending(merging).join(norms.select(*ROUND, "pr_num", "verified_norm"), [*ROUND, "pr_num"])
    who = identity(F.col("author"), F.col("worker_id"))
    lists = rows.groupBy(*ROUND).agg(
        F.array_sort(
            F.collect_list(F.struct("merge_rank", "update_id", who.alias("identity"), "verified_norm"))
        ).alias("entries")
    )
    return merging.join(lists, list(ROUND)).select(
        *ROUND,
        F.struct(
            F.lit(PROTOCOL_VERSION).alias("protocol_version"),
            F.col("round").alias("source_round"),
            F.col("base_model_revision").alias("source_model_revision"),
            F.col("entries.update_id").alias("update_ids"),
            F.col("entries.identity").alias("participants"),
            F.map_from_entries(
                F.transform("entries", lambda e: F.struct(e["identity"], e["verified_norm"]))
            ).alias("verified_delta_norms"),
            F.col("policy.outer_lr").alias("outer_lr"),
            F.col("policy.outer_momentum").alias("outer_momentum"),
            F.col("policy.nesterov").alias("nesterov"),
            F.lit(now).cast("timestamp").alias("merged_at"),
        )
        .cast(MARKER_TYPE)
        .alias("marker"),
    )


def same_update_set(left: Column, right: Column) -> Column:
    """Equality of two id lists as multisets."""
    return F.array_sort(left).eqNullSafe(F.array_sort(right))


def matching_markers(merging: DataFrame, markers: DataFrame) -> DataFrame:
    """Merging states whose merge is already published: same round and the same update ids.

    ``markers`` is (repo_id, round, marker, model_revision).
    """
    return merging.join(markers, list(ROUND)).where(
        (F.col("marker.source_round") == F.col("round"))
        & same_update_set(F.col("marker.update_ids"), F.col("pending_merge.update_id"))
    )


def open_next_rounds(published: DataFrame, columns: list[str], now: Column | str) -> DataFrame:
    """Published merging states become the next round's open states on the new revision."""
    return (
        published.withColumn("status", F.lit("open"))
        .withColumn("round", F.col("round") + 1)
        .withColumn("seq", F.col("seq") + 1)
        .withColumn("base_model_revision", F.col("model_revision"))
        .withColumn("pending_merge", F.lit(None).cast(PENDING_TYPE))
        .withColumn("last_merge", F.col("marker"))
        .withColumn("updated_at", F.lit(now).cast("timestamp"))
        .select(*columns)
    )


def close_accepted(submissions: DataFrame, pending: DataFrame) -> DataFrame:
    """New version of the submissions in which the merged ones are closed."""
    merged = pending.select("repo_id", "pr_num", F.lit(True).alias("merged")).distinct()
    return (
        submissions.join(merged, ["repo_id", "pr_num"], "left")
        .withColumn("status", F.when(F.col("merged"), "closed").otherwise(F.col("status")))
        .drop("merged")
    )


def merged_revision(repo_id: Column, round_number: Column, update_ids: Column) -> Column:
    """Revision name of a merge; a repeated merge of the same updates gets the same name."""
    return F.sha1(F.concat_ws("|", repo_id, round_number.cast("string"), F.array_join(F.array_sort(update_ids), ",")))


def is_weight_file(path: Column) -> Column:
    return path.startswith("model") & (path.endswith(PAYLOAD_SUFFIX) | path.endswith(INDEX_SUFFIX))


def stale_weight_files(current: DataFrame, new: DataFrame) -> DataFrame:
    """Weight files of a repository that the new model does not write again."""
    return current.where(is_weight_file(F.col("path"))).join(new, ["repo_id", "path"], "left_anti")


def commit_file_set(current: DataFrame, new: DataFrame) -> DataFrame:
    """All file operations of one commit: additions (the marker among them) and deletions."""
    added = new.select("repo_id", "path").withColumn("operation", F.lit("add"))
    marker = new.select("repo_id").distinct().select(
        "repo_id", F.lit(MERGE_MARKER_PATH).alias("path"), F.lit("add").alias("operation")
    )
    deleted = stale_weight_files(current, new).select("repo_id", "path").withColumn("operation", F.lit("delete"))
    return added.unionByName(deleted).unionByName(marker)
