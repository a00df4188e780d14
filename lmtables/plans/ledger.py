"""Submission ledger queries: discovery, validation, acceptance, quorum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.functions import identifiers as ids
from lmtables.operators import submissions as S
from lmtables.plans.registry import query
from lmtables.plans.tables import Inputs, with_tables
from lmtables.session import stage
from lmtables.sources.documents import quarantine, scan_json_docs

MAX_PER_AUTHOR = 2

CANDIDATES = (
    "SELECT * FROM submissions WHERE status IN ('open', 'draft') AND starts_with(title, '[swarm]')"
)
REVISIONS = (
    "SELECT repo_id, pr_num, arg_max(oid, seq) FILTER (oid IS NOT NULL) AS revision FROM submission_events "
    "GROUP BY repo_id, pr_num"
)
METADATA_FILES = (
    "SELECT c.repo_id, c.pr_num, r.revision, count(*) AS n, min(f.path) AS metadata_path FROM candidates AS c "
    "JOIN revisions AS r ON r.repo_id = c.repo_id AND r.pr_num = c.pr_num "
    "JOIN repo_files AS f ON f.repo_id = c.repo_id AND f.revision = r.revision "
    "WHERE f.path LIKE 'swarm/updates/round-' || lpad(CAST(c.round AS STRING), 6, '0') || '/%/metadata.json' "
    "GROUP BY c.repo_id, c.pr_num, r.revision"
)
READ = (
    "SELECT c.*, a.author IS NOT NULL AS admitted, r.revision, COALESCE(m.n, 0) AS n, "
    "CASE WHEN m.n = 1 THEN m.metadata_path END AS metadata_path, d.body, s.base_model_revision FROM candidates AS c "
    "LEFT JOIN (SELECT DISTINCT author FROM allowed_authors) AS a ON a.author = c.author "
    "LEFT JOIN revisions AS r ON r.repo_id = c.repo_id AND r.pr_num = c.pr_num "
    "LEFT JOIN metadata_files AS m ON m.repo_id = c.repo_id AND m.pr_num = c.pr_num "
    "LEFT JOIN documents_json AS d ON d.repo_id = c.repo_id AND d.revision = r.revision AND m.n = 1 "
    "AND d.path = m.metadata_path "
    "LEFT JOIN rounds AS s ON s.repo_id = c.repo_id AND s.round = c.round"
)
REQUIRED = (
    "['base_model_revision', 'delta_files', 'local_steps', 'num_tokens', 'protocol_version', 'round', 'tensor_count', "
    "'update_id', 'worker_id']"
)
DOCUMENT_RULES = (
    f"WHEN len(list_filter({REQUIRED}, lambda q: NOT list_contains(json_keys(body), q))) > 0 THEN 'missing_keys' "
    "WHEN CAST(json_extract_string(body, '$.protocol_version') AS INT) IS DISTINCT FROM 1 THEN 'protocol' "
    "WHEN CAST(json_extract_string(body, '$.round') AS INT) IS DISTINCT FROM round THEN 'round' "
    "WHEN json_extract_string(body, '$.base_model_revision') IS DISTINCT FROM base_model_revision "
    "THEN 'base_revision' "
    "WHEN json_type(body, '$.delta_files') <> 'ARRAY' OR json_array_length(body, '$.delta_files') = 0 "
    "THEN 'no_delta_files' "
    "WHEN COALESCE(CAST(json_extract_string(body, '$.local_steps') AS BIGINT), 0) <= 0 "
    "OR COALESCE(CAST(json_extract_string(body, '$.num_tokens') AS BIGINT), 0) <= 0 THEN 'non_positive' "
)
JUDGED = (
    "SELECT *, CASE WHEN NOT admitted THEN 'not_allowlisted' WHEN revision IS NULL THEN 'no_commits' "
    f"WHEN n <> 1 THEN 'metadata_count' WHEN body IS NULL THEN 'unreadable_metadata' {DOCUMENT_RULES} END AS reason "
    "FROM read_rows"
)
DELTA_PATHS = (
    "SELECT repo_id, pr_num, revision, unnest(range(len(paths))) AS place, unnest(paths) AS delta_path, "
    "regexp_extract(metadata_path, '^(.*/)[^/]*$', 1) AS folder FROM (SELECT *, "
    "json_extract_string(body, '$.delta_files[*]') AS paths FROM judged WHERE reason IS NULL) AS j"
)
PROBLEMS = (
    "SELECT repo_id, pr_num, arg_min(problem, place) AS problem FROM (SELECT p.repo_id, p.pr_num, p.place, CASE "
    "WHEN NOT (starts_with(delta_path, folder) AND suffix(delta_path, '.safetensors')) THEN 'unsafe_path' "
    "WHEN f.path IS NULL THEN 'missing_file' END AS problem FROM delta_paths AS p LEFT JOIN repo_files AS f "
    "ON f.repo_id = p.repo_id AND f.revision = p.revision AND f.path = p.delta_path) AS q "
    "WHERE problem IS NOT NULL GROUP BY repo_id, pr_num"
)
VALIDATED = (
    "SELECT j.repo_id, j.round, j.pr_num, j.created_at, j.author, json_extract_string(j.body, '$.worker_id') AS worker_id, "
    "json_extract_string(j.body, '$.update_id') AS update_id, "
    "CAST(json_extract_string(j.body, '$.num_tokens') AS BIGINT) AS num_tokens, j.revision, j.metadata_path, "
    "COALESCE(j.reason, p.problem) AS reject_reason FROM judged AS j LEFT JOIN problems AS p "
    "ON p.repo_id = j.repo_id AND p.pr_num = j.pr_num"
)
FIRSTS = (
    "SELECT * FROM validated WHERE reject_reason IS NULL QUALIFY row_number() OVER (PARTITION BY repo_id, round, author, "
    "worker_id ORDER BY created_at, pr_num) = 1"
)
ACCEPTED = (
    "SELECT * FROM firsts QUALIFY row_number() OVER (PARTITION BY repo_id, round, author ORDER BY created_at, pr_num) "
    f"<= {MAX_PER_AUTHOR}"
)
QUORUM = (
    "SELECT a.repo_id, a.round, count(*) AS accepted, min(r.min_updates) AS min_updates, "
    "min(r.max_updates) AS max_updates FROM accepted AS a JOIN rounds AS r ON r.repo_id = a.repo_id "
    "AND r.round = a.round GROUP BY a.repo_id, a.round HAVING count(*) >= min(r.min_updates)"
)
CHOSEN = (
    "SELECT a.*, row_number() OVER (PARTITION BY a.repo_id, a.round ORDER BY created_at, pr_num) AS merge_rank "
    "FROM accepted AS a JOIN quorum AS q ON q.repo_id = a.repo_id AND q.round = a.round "
    "QUALIFY merge_rank <= q.max_updates"
)
GIVEN = ["submissions", "submission_events", "repo_files", "documents_json", "rounds", "allowed_authors"]
CHAIN = {
    "candidates": CANDIDATES,
    "revisions": REVISIONS,
    "metadata_files": METADATA_FILES,
    "read_rows": READ,
    "judged": JUDGED,
    "delta_paths": DELTA_PATHS,
    "problems": PROBLEMS,
    "validated": VALIDATED,
    "firsts": FIRSTS,
    "accepted": ACCEPTED,
    "quorum": QUORUM,
    "chosen": CHOSEN,
}


def chain_sql(body: str, extra: dict[str, str] | None = None) -> str:
    return with_tables(GIVEN, body, CHAIN | (extra or {}))


def validated(inputs: Inputs) -> DataFrame:
    return S.validate_submissions(
        inputs("submissions"),
        inputs("submission_events"),
        inputs("repo_files"),
        inputs("documents_json"),
        inputs("rounds"),
        inputs("allowed_authors"),
    )


def valid(inputs: Inputs) -> DataFrame:
    return validated(inputs).where("reject_reason IS NULL")


def accepted(inputs: Inputs) -> DataFrame:
    return S.accept_updates(valid(inputs), MAX_PER_AUTHOR)


def chosen(inputs: Inputs) -> DataFrame:
    return S.select_quorum(stage(accepted(inputs), "accepted"), inputs("rounds"))


def located(inputs: Inputs) -> DataFrame:
    candidates = S.open_submissions(inputs("submissions")).join(
        S.latest_revisions(inputs("submission_events")), ["repo_id", "pr_num"]
    )
    return candidates.withColumn("round_folder", ids.round_prefix(F.col("round"))).join(
        S.metadata_locations(inputs("repo_files")), ["repo_id", "revision", "round_folder"]
    )


@query(
    "scan_json_docs",
    with_tables(
        ["documents_json"],
        "SELECT repo_id, path, CAST(json_extract_string(body, '$.protocol_version') AS INT) AS protocol_version, "
        "json_extract_string(body, '$.update_id') AS update_id, "
        "json_extract_string(body, '$.protocol_version') = '1' AS supported FROM documents_json",
    ),
)
def _json(inputs: Inputs) -> DataFrame:
    return scan_json_docs(inputs("documents_json"), "protocol_version INT, update_id STRING").select(
        "repo_id", "path", "doc.protocol_version", "doc.update_id", "supported"
    )


@query("open_submissions", with_tables(["submissions"], f"SELECT repo_id, pr_num, author, status FROM ({CANDIDATES}) AS c"))
def _open(inputs: Inputs) -> DataFrame:
    return S.open_submissions(inputs("submissions")).select("repo_id", "pr_num", "author", "status")


@query(
    "status_report",
    with_tables(
        ["rounds", "submissions"],
        "SELECT s.repo_id, s.round, s.status, s.base_model_revision, CAST(COALESCE(n, 0) AS BIGINT) AS open_submissions "
        "FROM (SELECT * FROM rounds QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY seq DESC) = 1) AS s "
        "LEFT JOIN (SELECT repo_id, count(*) AS n FROM submissions WHERE status = 'open' "
        "AND starts_with(title, '[swarm]') GROUP BY repo_id) AS c USING (repo_id)",
    ),
)
def _status(inputs: Inputs) -> DataFrame:
    from lmtables.operators.rounds import current_states

    return S.status_report(current_states(inputs("rounds")), inputs("submissions")).select(
        "repo_id", "round", "status", "base_model_revision", "open_submissions"
    )


@query(
    "status_listing",
    with_tables(
        ["rounds", "submissions"],
        "SELECT repo_id, 'state' AS kind, round, base_model_revision, n AS open_submissions, CAST(NULL AS BIGINT) AS pr_num, "
        "CAST(NULL AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS author FROM (SELECT r.repo_id, r.round, "
        "r.base_model_revision, (SELECT count(*) FROM listed AS l WHERE l.repo_id = r.repo_id) AS n FROM latest AS r) AS c "
        "UNION ALL SELECT repo_id, 'submission', NULL, NULL, NULL, pr_num, title, author FROM listed "
        "WHERE repo_id IN (SELECT repo_id FROM latest)",
        {
            "listed": "SELECT * FROM submissions WHERE status = 'open' AND starts_with(title, '[swarm]')",
            "latest": "SELECT * FROM rounds QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY seq DESC) = 1",
        },
    ),
)
def _listing(inputs: Inputs) -> DataFrame:
    from lmtables.operators.rounds import current_states

    return S.status_listing(current_states(inputs("rounds")), inputs("submissions")).drop("round_status")


@query(
    "author_allowlist",
    with_tables(
        ["submissions", "allowed_authors"],
        "SELECT repo_id, pr_num, author FROM submissions WHERE author IN (SELECT author FROM allowed_authors)",
    ),
)
def _allow(inputs: Inputs) -> DataFrame:
    return S.allow_authors(inputs("submissions"), inputs("allowed_authors")).select("repo_id", "pr_num", "author")


@query(
    "metadata_required",
    with_tables(
        ["documents_json"],
        "SELECT repo_id, path, array_to_string(lacking, ',') AS missing, len(lacking) = 0 AS complete FROM ("
        f"SELECT *, list_filter({REQUIRED}, lambda q: NOT list_contains(json_keys(body), q)) AS lacking "
        "FROM documents_json) AS d",
    ),
)
def _required(inputs: Inputs) -> DataFrame:
    lacking = S.missing_keys(F.col("body"))
    return inputs("documents_json").select(
        "repo_id", "path", F.array_join(lacking, ",").alias("missing"), (F.size(lacking) == 0).alias("complete")
    )


@query(
    "metadata_reason",
    with_tables(
        ["updates", "documents_json", "rounds"],
        f"SELECT repo_id, pr_num, CASE {DOCUMENT_RULES} END AS reason FROM (SELECT u.repo_id, u.pr_num, u.round, d.body, "
        "r.base_model_revision FROM updates AS u JOIN documents_json AS d ON d.event_id = u.event_id "
        "JOIN rounds AS r ON r.repo_id = u.repo_id AND r.round = u.round) AS j",
    ),
)
def _reason(inputs: Inputs) -> DataFrame:
    read = (
        inputs("updates")
        .select("event_id", "repo_id", "pr_num", "round")
        .join(inputs("documents_json").select("event_id", "body"), "event_id")
        .join(inputs("rounds").select("repo_id", "round", "base_model_revision"), ["repo_id", "round"])
        .withColumn("meta", F.from_json("body", S.METADATA_SCHEMA))
    )
    reason = S.metadata_reason(F.col("body"), F.col("meta"), F.col("round"), F.col("base_model_revision"))
    return read.select("repo_id", "pr_num", reason.alias("reason"))


@query(
    "metadata_exactly_one",
    with_tables(
        GIVEN,
        "SELECT repo_id, pr_num, metadata_path, n = 1 AS exactly_one, CAST(n AS BIGINT) AS metadata_files "
        "FROM metadata_files",
        {k: CHAIN[k] for k in ("candidates", "revisions", "metadata_files")},
    ),
)
def _exactly_one(inputs: Inputs) -> DataFrame:
    return located(inputs).select(
        "repo_id", "pr_num", "metadata_path", (F.col("metadata_files") == 1).alias("exactly_one"), "metadata_files"
    )


@query(
    "safe_delta_paths",
    chain_sql(
        "SELECT j.repo_id, j.pr_num, COALESCE(p.problem, 'fine') AS verdict FROM judged AS j LEFT JOIN problems AS p "
        "ON p.repo_id = j.repo_id AND p.pr_num = j.pr_num WHERE j.reason IS NULL"
    ),
)
def _safe(inputs: Inputs) -> DataFrame:
    verdict = F.coalesce("reject_reason", F.lit("fine"))
    return (
        validated(inputs)
        .select("repo_id", "pr_num", verdict.alias("verdict"))
        .where(F.col("verdict").isin("fine", "unsafe_path", "missing_file"))
    )


@query(
    "fresh_updates",
    with_tables(
        ["updates", "documents_json", "rounds"],
        "SELECT u.repo_id, u.pr_num FROM updates AS u JOIN documents_json AS d ON d.event_id = u.event_id JOIN rounds AS r "
        "ON r.repo_id = u.repo_id AND r.status = 'open' AND r.round = CAST(json_extract_string(d.body, '$.round') AS INT) "
        "AND r.base_model_revision = json_extract_string(d.body, '$.base_model_revision')",
    ),
)
def _fresh(inputs: Inputs) -> DataFrame:
    claims = (
        inputs("updates")
        .select("event_id", "repo_id", "pr_num")
        .join(inputs("documents_json").select("event_id", "body"), "event_id")
        .withColumn("meta", F.from_json("body", S.METADATA_SCHEMA))
        .select("repo_id", "pr_num", "meta.round", "meta.base_model_revision")
    )
    return S.fresh_updates(claims, inputs("rounds")).select("repo_id", "pr_num")


@query(
    "policy_valid",
    with_tables(
        ["submissions"],
        "SELECT repo_id, pr_num, k % 5 - 1 AS min_updates, k % 3 AS max_updates, "
        "k % 5 - 1 > 0 AND k % 5 - 1 <= k % 3 AS policy_valid FROM submissions",
    ),
)
def _policy(inputs: Inputs) -> DataFrame:
    asked = inputs("submissions").selectExpr("repo_id", "pr_num", "k % 5 - 1 AS min_updates", "k % 3 AS max_updates")
    return S.valid_policies(asked)


@query(
    "rejects_table",
    chain_sql(
        "SELECT repo_id, round, pr_num, CASE WHEN reject_reason IS NOT NULL THEN reject_reason WHEN EXISTS (SELECT 1 FROM "
        "accepted AS a WHERE a.repo_id = v.repo_id AND a.round = v.round AND a.author = v.author AND "
        "a.worker_id = v.worker_id) THEN 'duplicate_identity' ELSE 'author_limit' END AS reject_reason FROM validated AS v "
        "WHERE (repo_id, pr_num) NOT IN (SELECT (repo_id, pr_num) FROM accepted)"
    ),
)
def _rejects(inputs: Inputs) -> DataFrame:
    _, rejected = S.discover(validated(inputs), MAX_PER_AUTHOR)
    return rejected.select("repo_id", "round", "pr_num", "reject_reason")


@query(
    "quarantine_documents",
    with_tables(
        ["documents_json"],
        "SELECT repo_id, path, json_extract_string(body, '$.protocol_version') AS found FROM documents_json "
        "WHERE json_extract_string(body, '$.protocol_version') IS DISTINCT FROM '1'",
    ),
)
def _quarantine(inputs: Inputs) -> DataFrame:
    docs = scan_json_docs(inputs("documents_json"), "protocol_version INT")
    _, bad = quarantine(docs, F.col("supported"))
    return bad.select("repo_id", "path", F.col("doc.protocol_version").cast("string").alias("found"))


@query(
    "project_update_metadata",
    with_tables(
        ["updates"],
        "SELECT pr_num, '{\"base_model_revision\":\"' || repo_id || '@' || CAST(round AS STRING) || "
        "'\",\"block_size\":2048,\"dataset_config_name\":null,\"dataset_name\":\"corpus\",\"delta_dtype\":\"bfloat16\","
        "\"delta_files\":[\"' || first_delta || '\",\"' || second_delta || '\"],\"delta_norm_reported\":null,"
        "\"delta_sign\":\"base-minus-local\",\"local_steps\":' || CAST(k AS STRING) || ',\"num_tokens\":' || "
        "CAST(CAST(k AS BIGINT) * 16384 AS STRING) || ',\"protocol_version\":1,\"round\":' || CAST(round AS STRING) || "
        "',\"submitted_at\":null,\"tensor_count\":10,\"train_loss\":null,\"update_id\":\"' || update_id || "
        "'\",\"worker_id\":\"' || worker_id || '\"}' AS metadata FROM updates",
    ),
)
def _project(inputs: Inputs) -> DataFrame:
    return inputs("updates").select("pr_num", update_metadata().alias("metadata"))


def update_metadata():
    """The 17 fields of an update's metadata document as key-sorted JSON, from the columns of an updates table."""
    null = F.lit(None)
    return ids.json_sorted(
        {
            "protocol_version": F.lit(ids.PROTOCOL_VERSION),
            "update_id": F.col("update_id"),
            "worker_id": F.col("worker_id"),
            "round": F.col("round"),
            "base_model_revision": F.concat_ws("@", "repo_id", F.col("round").cast("string")),
            "delta_sign": F.lit("base-minus-local"),
            "delta_dtype": F.lit("bfloat16"),
            "delta_files": F.array("first_delta", "second_delta"),
            "delta_norm_reported": null.cast("double"),
            "tensor_count": F.lit(10),
            "local_steps": F.col("k"),
            "num_tokens": S.tokens_per_update(F.col("k"), F.lit(8), F.lit(1), F.lit(2048)),
            "train_loss": null.cast("double"),
            "dataset_name": F.lit("corpus"),
            "dataset_config_name": null.cast("string"),
            "block_size": F.lit(2048),
            "submitted_at": null.cast("string"),
        }
    )


@query(
    "tokens_per_update",
    with_tables(["submissions"], "SELECT pr_num, CAST(k AS BIGINT) * 8 * 4 * 2048 AS num_tokens FROM submissions"),
)
def _tokens(inputs: Inputs) -> DataFrame:
    return inputs("submissions").select(
        "pr_num", S.tokens_per_update(F.col("k"), F.lit(8), F.lit(4), F.lit(2048)).alias("num_tokens")
    )


@query(
    "latest_revision",
    with_tables(["submission_events"], REVISIONS),
)
def _latest(inputs: Inputs) -> DataFrame:
    return S.latest_revisions(inputs("submission_events"))


@query(
    "submission_files",
    with_tables(
        GIVEN,
        "SELECT m.repo_id, m.pr_num, m.revision, m.metadata_path, json_extract_string(d.body, '$.update_id') AS update_id "
        "FROM metadata_files AS m JOIN documents_json AS d ON d.repo_id = m.repo_id AND d.revision = m.revision "
        "AND d.path = m.metadata_path WHERE m.n = 1",
        {k: CHAIN[k] for k in ("candidates", "revisions", "metadata_files")},
    ),
)
def _files(inputs: Inputs) -> DataFrame:
    docs = inputs("documents_json").select("repo_id", "revision", F.col("path").alias("metadata_path"), "body")
    return (
        located(inputs)
        .where("metadata_files = 1")
        .join(docs, ["repo_id", "revision", "metadata_path"])
        .select(
            "repo_id", "pr_num", "revision", "metadata_path", F.get_json_object("body", "$.update_id").alias("update_id")
        )
    )


@query(
    "state_join",
    with_tables(
        ["submissions", "rounds"],
        "SELECT s.repo_id, s.pr_num, s.round, r.status, r.base_model_revision, r.min_updates FROM submissions AS s "
        "JOIN rounds AS r ON r.repo_id = s.repo_id AND r.round = s.round",
    ),
)
def _state(inputs: Inputs) -> DataFrame:
    states = inputs("rounds").select("repo_id", "round", "status", "base_model_revision", "policy.min_updates")
    return inputs("submissions").select("repo_id", "pr_num", "round").join(states, ["repo_id", "round"])


@query(
    "already_submitted",
    with_tables(
        ["updates"],
        "SELECT repo_id, pr_num, worker_id, round FROM updates AS u WHERE NOT EXISTS (SELECT 1 FROM ("
        "SELECT repo_id, worker_id, max(round) AS last_round FROM updates WHERE status = 'merged' GROUP BY ALL) AS l "
        "WHERE l.repo_id = u.repo_id AND l.worker_id = u.worker_id AND l.last_round = u.round)",
    ),
)
def _already(inputs: Inputs) -> DataFrame:
    updates = inputs("updates")
    merged = _ledger_rows(updates.where("status = 'merged'"))
    ledger = S.advance_ledger(merged.where("last_submitted_round < 10"), merged.where("last_submitted_round >= 10"))
    return S.not_yet_submitted(updates.select("repo_id", "pr_num", "worker_id", "round"), ledger).select(
        "repo_id", "pr_num", "worker_id", "round"
    )


def _ledger_rows(updates: DataFrame) -> DataFrame:
    return updates.select("repo_id", "worker_id", F.col("round").alias("last_submitted_round"), "update_id")


@query(
    "worker_highwater",
    with_tables(
        ["updates"],
        "SELECT repo_id, worker_id, round AS last_submitted_round, update_id FROM updates QUALIFY row_number() OVER "
        "(PARTITION BY repo_id, worker_id ORDER BY round DESC, update_id DESC) = 1",
    ),
)
def _highwater(inputs: Inputs) -> DataFrame:
    rows = _ledger_rows(inputs("updates"))
    return S.advance_ledger(rows.where("last_submitted_round < 10"), rows.where("last_submitted_round >= 10"))


@query("first_per_identity", chain_sql("SELECT repo_id, round, author, worker_id, pr_num FROM firsts"))
def _firsts(inputs: Inputs) -> DataFrame:
    return S.first_per_identity(valid(inputs)).select("repo_id", "round", "author", "worker_id", "pr_num")


@query("author_cap", chain_sql("SELECT repo_id, round, author, worker_id, pr_num FROM accepted"))
def _cap(inputs: Inputs) -> DataFrame:
    return S.author_cap(S.first_per_identity(valid(inputs)), MAX_PER_AUTHOR).select(
        "repo_id", "round", "author", "worker_id", "pr_num"
    )


@query(
    "submissions_per_author",
    chain_sql("SELECT repo_id, round, author, count(*) AS accepted FROM accepted GROUP BY repo_id, round, author"),
)
def _per_author(inputs: Inputs) -> DataFrame:
    return S.submissions_per_author(accepted(inputs))


@query(
    "submission_order",
    with_tables(
        ["submissions"],
        f"SELECT repo_id, pr_num, CAST(row_number() OVER (PARTITION BY repo_id ORDER BY created_at, pr_num) AS BIGINT) "
        f"AS place FROM ({CANDIDATES}) AS c",
    ),
)
def _order(inputs: Inputs) -> DataFrame:
    return S.submission_order(S.open_submissions(inputs("submissions"))).select("repo_id", "pr_num", "place")


@query("quorum", chain_sql("SELECT repo_id, round, accepted, min_updates, max_updates FROM quorum"))
def _quorum(inputs: Inputs) -> DataFrame:
    return S.quorum(accepted(inputs), inputs("rounds"))


@query(
    "take_max_updates",
    chain_sql("SELECT repo_id, round, pr_num, update_id, CAST(merge_rank AS INT) AS merge_rank FROM chosen"),
)
def _take(inputs: Inputs) -> DataFrame:
    return chosen(inputs).select("repo_id", "round", "pr_num", "update_id", "merge_rank")


NORMS_SQL = "SELECT repo_id, pr_num, value AS verified_norm FROM submissions"


@query(
    "round_summary",
    chain_sql(
        "SELECT r.repo_id, r.round, CAST(COALESCE(a.n, 0) AS BIGINT) AS valid_updates, r.min_updates, c.participants, "
        "c.norm_sum FROM rounds AS r LEFT JOIN (SELECT repo_id, round, count(*) AS n FROM accepted GROUP BY repo_id, round) "
        "AS a ON a.repo_id = r.repo_id AND a.round = r.round LEFT JOIN (SELECT c.repo_id, c.round, "
        "string_agg(c.author || '/' || c.worker_id, ' ' ORDER BY merge_rank) AS participants, "
        "round(sum(n.verified_norm), 6) AS norm_sum FROM chosen AS c JOIN norms AS n ON n.repo_id = c.repo_id "
        "AND n.pr_num = c.pr_num GROUP BY c.repo_id, c.round) AS c ON c.repo_id = r.repo_id AND c.round = r.round",
        {"norms": NORMS_SQL},
    ),
)
def _summary(inputs: Inputs) -> DataFrame:
    accepted_rows = stage(accepted(inputs), "accepted")
    norms = inputs("submissions").select("repo_id", "pr_num", F.col("value").alias("verified_norm"))
    summary = S.round_summary(
        accepted_rows, S.select_quorum(accepted_rows, inputs("rounds")), inputs("rounds"), norms
    )
    total = F.aggregate(F.map_values("verified_delta_norms"), F.lit(0.0), lambda acc, v: acc + v)
    return summary.select(
        "repo_id",
        "round",
        "valid_updates",
        "min_updates",
        F.array_join("participants", " ").alias("participants"),
        F.round(total, 6).alias("norm_sum"),
    )
