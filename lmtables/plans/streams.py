"""Streaming queries: the given events table is read as a stream and run to its end."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.plans.ledger import CHAIN, GIVEN, MAX_PER_AUTHOR, chain_sql
from lmtables.plans.registry import query
from lmtables.plans import tensors as tensor_plans
from lmtables.plans.tables import SUBMISSION_BASE, Inputs, with_tables
from lmtables.functions.vectors import fixed_point
from lmtables.operators import rounds as R
from lmtables.session import checkpoint_root
from lmtables.streaming.intake import start, submission_stream, validating_sink
from lmtables.streaming.publish import active_momentum, coordinator_step
from lmtables.streaming.quorum import EVENT_TYPES, quorum_stream, round_events, submission_events, use_rocksdb
from lmtables.streaming.store import TableStore


def workspace(inputs: Inputs, name: str) -> str:
    return os.path.join(checkpoint_root(inputs.spark), f"{name}-{uuid.uuid4().hex}")


def stream_of_submissions(inputs: Inputs) -> DataFrame:
    events = inputs.given("events")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema.fields)
    # A pattern, so that the table may be one file or a folder of files.
    raw = submission_stream(inputs.spark, f"{inputs.sf_dir}/events.parque[t]", schema)
    return raw.selectExpr(*[f"{e} AS {name}" for name, e in SUBMISSION_BASE.items()])


def intake(inputs: Inputs, *, rounds_known: bool = True) -> str:
    """Runs the intake over all submissions and returns the folder of its results."""
    folder = workspace(inputs, "intake")

    def tables() -> dict[str, DataFrame]:
        given = {
            "events": inputs("submission_events"),
            "files": inputs("repo_files"),
            "documents": inputs("documents_json"),
            "allowed": inputs("allowed_authors"),
        }
        return given | ({"rounds": inputs("rounds")} if rounds_known else {})

    sink = validating_sink(tables, f"{folder}/valid", f"{folder}/rejected")
    writer = stream_of_submissions(inputs).writeStream.foreachBatch(sink).option("checkpointLocation", f"{folder}/log")
    start(writer, once=True).awaitTermination()
    return folder


def results(inputs: Inputs, folder: str, part: str) -> DataFrame:
    return inputs.spark.read.option("basePath", f"{folder}/{part}").parquet(f"{folder}/{part}")


@query(
    "stream_submissions",
    chain_sql("SELECT repo_id, round, pr_num, author, worker_id FROM validated WHERE reject_reason IS NULL"),
)
def _stream(inputs: Inputs) -> DataFrame:
    return results(inputs, intake(inputs), "valid").select("repo_id", "round", "pr_num", "author", "worker_id")


@query(
    "stream_rejects",
    chain_sql(
        "SELECT repo_id, round, pr_num, reject_reason FROM validated WHERE reject_reason IS NOT NULL"
    ),
)
def _rejects(inputs: Inputs) -> DataFrame:
    return results(inputs, intake(inputs), "rejected").select("repo_id", "round", "pr_num", "reject_reason")


# Events arrive as files of ten days, two of them out of order, and the stream runs after each. Every other submission
# of most rounds comes a file later, and these rounds open when all of theirs are there; the others open first.
DAYS = 10
ARRIVAL = (0, 2, 1, 3, 4, 5)
LATE = "round % 4 <> 0"


def arrivals(inputs: Inputs, folder: str) -> str:
    """Writes what the intake let through, and the openings of the rounds, by the file they arrive in."""
    valid = submission_events(results(inputs, folder, "valid"))
    opened = inputs("rounds").selectExpr(
        "repo_id", "round", "base_model_revision", "policy", "'open' AS status", "CAST(round AS BIGINT) AS seq",
        "named_struct('source_round', CAST(NULL AS INT)) AS last_merge",
    )
    file = f"CAST(floor(round / {DAYS}) AS INT)"
    events = valid.withColumn("file", F.expr(f"{file} + CASE WHEN {LATE} THEN CAST(pr_num % 2 AS INT) ELSE 0 END")).unionByName(
        round_events(opened).withColumn("file", F.expr(f"{file} + CASE WHEN {LATE} THEN 3 ELSE 0 END"))
    )
    events.write.partitionBy("file").parquet(f"{folder}/arriving")
    return f"{folder}/arriving"


def decisions_by_stream(inputs: Inputs, folder: str, max_per_author: int, *, combine: bool = True) -> DataFrame:
    """Decisions of the quorum stream, which goes on from its checkpoint after each file."""
    use_rocksdb(inputs.spark)
    arriving = arrivals(inputs, folder)
    schema = ", ".join(f"{c} {t}" for c, t in EVENT_TYPES.items())
    inputs.spark.createDataFrame([], schema).write.parquet(f"{folder}/arrived")
    for file in ARRIVAL:
        rows = inputs.spark.read.schema(f"{schema}, file INT").parquet(arriving).where(F.col("file") == file)
        rows.drop("file").write.mode("append").parquet(f"{folder}/arrived")
        writer = (
            quorum_stream(submission_stream(inputs.spark, f"{folder}/arrived", schema), max_per_author, trim=True, combine=combine)
            .writeStream.format("parquet")
            .option("path", f"{folder}/decided")
            .option("checkpointLocation", f"{folder}/quorum-log")
        )
        start(writer, once=True).awaitTermination()
    return inputs.spark.read.parquet(f"{folder}/decided")


def chosen_by_stream(inputs: Inputs, max_per_author: int) -> DataFrame:
    decided = decisions_by_stream(inputs, intake(inputs, rounds_known=False), max_per_author)
    return decided.where("decision = 'chosen'")


@query(
    "late_round_reject",
    chain_sql(
        "SELECT repo_id, round, reject_reason, count(*) AS late FROM validated WHERE reject_reason IN ('round', "
        "'base_revision') GROUP BY repo_id, round, reject_reason"
    ),
)
def _late(inputs: Inputs) -> DataFrame:
    """For another round: seen at once. On another base: told when the round opens, maybe many batches later."""
    folder = intake(inputs, rounds_known=False)
    at_once = results(inputs, folder, "rejected").where("reject_reason = 'round'").select("repo_id", "round", "reject_reason")
    # Not cut before it is judged: a repeated submission of one identity is turned away as well.
    decided = decisions_by_stream(inputs, folder, MAX_PER_AUTHOR, combine=False).where("reason = 'base_revision'")
    later = decided.select("repo_id", "round", F.col("reason").alias("reject_reason"))
    return at_once.unionByName(later).groupBy("repo_id", "round", "reject_reason").agg(F.count("*").alias("late"))


@query(
    "stateful_quorum",
    chain_sql("SELECT repo_id, round, pr_num, update_id, CAST(merge_rank AS INT) AS merge_rank FROM chosen"),
)
def _quorum(inputs: Inputs) -> DataFrame:
    return chosen_by_stream(inputs, MAX_PER_AUTHOR).select("repo_id", "round", "pr_num", "update_id", "merge_rank")


ONE_EACH = CHAIN | {
    "accepted": "SELECT * FROM firsts QUALIFY row_number() OVER (PARTITION BY repo_id, round, author "
    "ORDER BY created_at, pr_num) <= 1"
}


@query(
    "stateful_dedupe",
    with_tables(
        GIVEN,
        "SELECT repo_id, round, author, worker_id, count(*) AS chosen FROM chosen GROUP BY repo_id, round, author, worker_id",
        ONE_EACH,
    ),
)
def _dedupe(inputs: Inputs) -> DataFrame:
    return chosen_by_stream(inputs, 1).groupBy("repo_id", "round", "author", "worker_id").agg(
        F.count("*").alias("chosen")
    )


MERGE_TIME = "2024-02-01 00:00:00"
REPO = "org/model-0"
POLICY = (
    "named_struct('min_updates', 2, 'max_updates', 8, 'local_steps', 500, 'outer_lr', 0.7D, 'outer_momentum', 0.9D, "
    "'nesterov', true, 'update_dtype', 'float32') AS policy"
)


class Interrupted(Exception):
    """Stands for a coordinator that is lost in the middle of a step."""


def merged_store(inputs: Inputs) -> TableStore:
    """One round of four updates, of which one is incomplete; the coordinator is lost before the marker and resumes."""
    store = TableStore(inputs.spark, workspace(inputs, "exchange"))
    deltas = tensor_plans.deltas(inputs).drop("exact")
    shapes = tensor_plans.model_manifest(inputs).select("name", "shape")
    models = inputs("base").join(shapes, "name").withColumn("repo_id", F.lit(REPO))
    store.replace_partitions("models", models)
    submitted = deltas.join(shapes, "name").selectExpr(
        "*", f"'{REPO}' AS repo_id", "CAST(substr(update_id, 8) AS BIGINT) AS pr_num", "update_id AS revision"
    )
    store.replace_partitions("deltas", submitted)
    request = models.selectExpr("repo_id", "revision AS base_model_revision", POLICY).distinct()
    store.append("rounds", R.init_rounds(request, store.read("rounds"), MERGE_TIME))
    accepted = (
        inputs("local")
        .select("update_id", "w")
        .distinct()
        .selectExpr(
            f"'{REPO}' AS repo_id",
            "0 AS round",
            "CAST(w AS BIGINT) AS pr_num",
            "timestamp_seconds(w) AS created_at",
            "'author' AS author",
            "update_id AS worker_id",
            "update_id",
            "CAST(w * 1000 AS BIGINT) AS num_tokens",
            "update_id AS revision",
            "update_id AS metadata_path",
        )
    )

    def lose(point: str) -> None:
        if point == "model":
            raise Interrupted

    try:
        coordinator_step(store, accepted, MERGE_TIME, after=lose)
    except Interrupted:
        coordinator_step(store, None, MERGE_TIME)
    return store


PLAIN_AVERAGE = {
    key: tensor_plans.CHAIN[key] for key in ("deltas", "elements")
} | {
    "average": "SELECT e.name, e.chunk_id, e.i, sum(CAST(e.v AS DOUBLE) * (CAST(substr(e.update_id, 8) AS DOUBLE) * "
    "CAST(1000 AS DOUBLE) / CAST(6000 AS DOUBLE)) ORDER BY e.update_id) AS g "
    "FROM elements AS e WHERE e.update_id <> 'update-4' GROUP BY e.name, e.chunk_id, e.i",
    "moved": "SELECT a.name, a.chunk_id, a.i, g, CAST(CAST(b.v AS DOUBLE) - (g + g * CAST(0.9 AS DOUBLE)) * "
    "CAST(0.7 AS DOUBLE) AS FLOAT) AS p FROM average AS a JOIN (SELECT name, chunk_id, unnest(values) AS v, "
    "unnest(range(len(values))) AS i FROM base) AS b USING (name, chunk_id, i)",
}


@query(
    "exactly_once_merge",
    with_tables(["base", "local"], tensor_plans.joined_sql("p", "moved"), PLAIN_AVERAGE),
)
def _merge(inputs: Inputs) -> DataFrame:
    store = merged_store(inputs)
    newest = R.current_states(store.read("rounds")).select("repo_id", F.col("base_model_revision").alias("revision"))
    return (
        store.read("models")
        .join(newest, ["repo_id", "revision"], "left_semi")
        .select("name", "chunk_id", fixed_point(F.col("values")).alias("content"))
    )


@query(
    "momentum_state",
    with_tables(["base", "local"], tensor_plans.joined_sql("CAST(g AS FLOAT)", "average"), PLAIN_AVERAGE),
)
def _momentum(inputs: Inputs) -> DataFrame:
    return active_momentum(merged_store(inputs)).select(
        "name", "chunk_id", fixed_point(F.col("values")).alias("content")
    )
