"""The submission ledger: filters, validation, acceptance and quorum as set operations.

Ledger tables carry ``repo_id`` first, so one job serves many repositories. A round is named by (repo_id, round).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lmtables.functions.identifiers import (
    METADATA_FILE,
    PAYLOAD_SUFFIX,
    PROTOCOL_VERSION,
    TITLE_PREFIX,
    UPDATE_ROOT,
    identity,
    parent_dir,
    round_prefix,
)
from lmtables.operators.prefix import running_total, top_rows
from lmtables.session import stage

# The keys a metadata document must have, and the statuses that take part in discovery.
REQUIRED_KEYS = (
    "protocol_version",
    "update_id",
    "worker_id",
    "round",
    "base_model_revision",
    "delta_files",
    "tensor_count",
    "local_steps",
    "num_tokens",
)
CANDIDATE_STATUSES = ("open", "draft")
METADATA_SCHEMA = (
    "protocol_version INT, update_id STRING, worker_id STRING, round INT, base_model_revision STRING, "
    "delta_sign STRING, delta_dtype STRING, delta_files ARRAY<STRING>, delta_norm_reported DOUBLE, "
    "tensor_count INT, local_steps BIGINT, num_tokens BIGINT, train_loss DOUBLE, dataset_name STRING, "
    "dataset_config_name STRING, block_size INT, submitted_at STRING"
)
ROUND = ("repo_id", "round")
# Seconds since 1970 stay below this many bits for a thousand years.
SECOND_BITS = 35


def open_submissions(submissions: DataFrame) -> DataFrame:
    """Candidates of a round: open or draft, with the title prefix."""
    return submissions.where(
        F.col("status").isin(*CANDIDATE_STATUSES) & F.col("title").startswith(TITLE_PREFIX)
    )


def listed_as_open(submissions: DataFrame) -> DataFrame:
    """What a status report lists: open submissions with the title prefix; drafts are not listed."""
    return submissions.where((F.col("status") == "open") & F.col("title").startswith(TITLE_PREFIX))


def status_report(states: DataFrame, submissions: DataFrame) -> DataFrame:
    """Current state of each repository with its number of open submissions; drafts are not counted here."""
    counts = listed_as_open(submissions).groupBy("repo_id").agg(F.count("*").alias("open_submissions"))
    return states.join(counts, "repo_id", "left").withColumn(
        "open_submissions", F.coalesce("open_submissions", F.lit(0)).cast("bigint")
    )


def status_listing(states: DataFrame, submissions: DataFrame) -> DataFrame:
    """The whole report as rows: one per repository (``kind`` state, with ``open_submissions``) and one per open submission
    (``kind`` submission, with ``pr_num``, ``title``, ``author``); (repo_id, kind, pr_num) is the reading order.

    Submissions of a repository without a state are left out, as there is no report on it. Repeated rows are listed
    as often as they are counted.
    """
    state_row = status_report(states, submissions).select(
        "repo_id",
        F.lit("state").alias("kind"),
        "round",
        F.col("status").alias("round_status"),
        "base_model_revision",
        "open_submissions",
    )
    rows = listed_as_open(submissions).join(states.select("repo_id"), "repo_id", "left_semi").select(
        "repo_id", F.lit("submission").alias("kind"), "pr_num", "title", "author"
    )
    return state_row.unionByName(rows, allowMissingColumns=True)


def allow_authors(submissions: DataFrame, allowed: DataFrame | None) -> DataFrame:
    """``None`` admits everyone; a given list, even an empty one, admits its members only."""
    if allowed is None:
        return submissions
    return submissions.join(allowed.select("author"), "author", "left_semi")


def latest_revisions(events: DataFrame) -> DataFrame:
    """Last event with a commit id per submission; NULL where there is none."""
    has_commit = F.col("oid").isNotNull() & (F.col("oid") != "")
    return events.groupBy("repo_id", "pr_num").agg(
        F.max_by("oid", F.when(has_commit, F.col("seq"))).alias("revision")
    )


def metadata_locations(files: DataFrame) -> DataFrame:
    """Number of metadata files per revision and round folder, and one such path.

    Taken from the listing alone and combined before the shuffle, so the candidates are not read a second time.
    """
    return (
        files.where(F.col("path").startswith(UPDATE_ROOT + "/") & F.col("path").endswith("/" + METADATA_FILE))
        .groupBy("repo_id", "revision", round_folder(F.col("path")).alias("round_folder"))
        .agg(F.count("*").alias("metadata_files"), F.min("path").alias("metadata_path"))
    )


def round_folder(path: Column) -> Column:
    return F.regexp_extract(path, f"^({UPDATE_ROOT}/[^/]*/)", 1)


def missing_keys(raw: Column) -> Column:
    """Required keys a JSON document lacks, sorted; a key whose value is null is present."""
    return F.array_sort(F.array_except(F.array(*[F.lit(k) for k in REQUIRED_KEYS]), F.json_object_keys(raw)))


def metadata_reason(raw: Column, meta: Column, round_number: Column, base_revision: Column) -> Column:
    """First rule that a metadata document breaks, NULL if none; nulls fail every comparison."""
    return F.coalesce(
        _document_reason(raw, meta, round_number), _base_reason(meta, base_revision), _content_reason(meta)
    )


def _document_reason(raw: Column, meta: Column, round_number: Column) -> Column:
    return (
        F.when(F.json_object_keys(raw).isNull(), "unreadable_metadata")
        .when(F.size(missing_keys(raw)) > 0, "missing_keys")
        .when(~meta["protocol_version"].eqNullSafe(F.lit(PROTOCOL_VERSION)), "protocol")
        .when(~meta["round"].eqNullSafe(round_number), "round")
    )


def _base_reason(meta: Column, base_revision: Column) -> Column:
    return F.when(~meta["base_model_revision"].eqNullSafe(base_revision), "base_revision")


def _content_reason(meta: Column) -> Column:
    def positive(field: str) -> Column:
        return F.coalesce(meta[field] > 0, F.lit(False))

    return F.when(~F.coalesce(F.size(meta["delta_files"]) > 0, F.lit(False)), "no_delta_files").when(
        ~(positive("local_steps") & positive("num_tokens")), "non_positive"
    )


def payload_problems(documents: DataFrame, files: DataFrame) -> DataFrame:
    """First bad delta path per metadata document: unsafe before missing, in the order the document lists them."""
    listed = files.where(F.col("path").endswith(PAYLOAD_SUFFIX)).select(
        "repo_id", "revision", F.col("path").alias("delta_path"), F.lit(True).alias("listed")
    )
    paths = documents.select(
        "repo_id",
        "revision",
        F.col("path").alias("metadata_path"),
        parent_dir(F.col("path")).alias("folder"),
        F.posexplode(F.from_json("body", "delta_files ARRAY<STRING>")["delta_files"]).alias("place", "delta_path"),
    )
    problem = F.when(~is_safe_path(F.col("delta_path"), F.col("folder")), "unsafe_path").when(
        F.col("listed").isNull(), "missing_file"
    )
    return (
        paths.join(listed, ["repo_id", "revision", "delta_path"], "left")
        .withColumn("problem", problem)
        .where("problem IS NOT NULL")
        .groupBy("repo_id", "revision", "metadata_path")
        .agg(F.min_by("problem", "place").alias("payload_problem"))
    )


def is_safe_path(path: Column, folder: Column) -> Column:
    return F.coalesce(path.startswith(folder) & path.endswith(PAYLOAD_SUFFIX), F.lit(False))


def revision_listing(files: DataFrame) -> DataFrame:
    """Metadata and payload files of each revision: ``metadata_paths``, ``payload_paths``, from one read of the listing."""
    is_metadata = F.col("path").startswith(UPDATE_ROOT + "/") & F.col("path").endswith("/" + METADATA_FILE)
    is_payload = F.col("path").endswith(PAYLOAD_SUFFIX)
    return files.where(is_metadata | is_payload).groupBy("repo_id", "revision").agg(
        F.collect_list(F.when(is_metadata, F.col("path"))).alias("metadata_paths"),
        F.collect_list(F.when(is_payload, F.col("path"))).alias("payload_paths"),
    )


def revision_documents(documents: DataFrame) -> DataFrame:
    """The documents of each revision: ``bodies``, an array of path and body."""
    return documents.groupBy("repo_id", "revision").agg(F.collect_list(F.struct("path", "body")).alias("bodies"))


def first_payload_problem(delta_files: Column, folder: Column, listed: Column) -> Column:
    """First bad path of a document, in its order: unsafe before missing; NULL if there is none."""
    problems = F.transform(
        delta_files,
        lambda p: F.when(~is_safe_path(p, folder), "unsafe_path").when(
            ~F.coalesce(F.array_contains(listed, p), F.lit(False)), "missing_file"
        ),
    )
    return F.get(F.filter(problems, lambda p: p.isNotNull()), F.lit(0))


def _read_candidates(
    submissions: DataFrame, events: DataFrame, files: DataFrame, documents: DataFrame, allowed: DataFrame | None
) -> DataFrame:
    """Candidates with their parsed metadata and ``early_reason``, a fault that shows before any document is read.

    Listing and documents come as one row per revision, so that both meet the candidates in one exchange of these. A
    candidate without a revision, or with an early fault, looks for one that does not exist: no null keys meet.
    """
    candidates = open_submissions(submissions)
    if allowed is None:
        candidates = candidates.withColumn("admitted", F.lit(True))
    else:
        names = allowed.select("author", F.lit(True).alias("admitted")).distinct()
        candidates = candidates.join(names, "author", "left")
    fault = F.when(F.col("admitted").isNull(), "not_allowlisted").when(F.col("revision").isNull(), "no_commits")
    nowhere = F.concat(F.lit("\0"), F.col("pr_num").cast("string"))
    located = (
        candidates.join(latest_revisions(events), ["repo_id", "pr_num"], "left")
        .withColumn("fault", fault)
        .withColumn("looked_up", F.when(F.col("fault").isNull(), F.col("revision")).otherwise(nowhere))
    )
    for found in (revision_listing(files), revision_documents(documents)):
        located = located.join(found.withColumnRenamed("revision", "looked_up"), ["repo_id", "looked_up"], "left")
    prefix = round_prefix(F.col("round"))
    in_round = F.filter(F.coalesce("metadata_paths", F.array().cast("array<string>")), lambda p: p.startswith(prefix))
    path = F.when(F.size("in_round") == 1, F.get("in_round", F.lit(0)))
    body = F.get(F.filter("bodies", lambda d: d["path"] == F.col("metadata_path")), F.lit(0))["body"]
    return (
        located.withColumn("in_round", in_round)
        .withColumn("early_reason", F.coalesce("fault", F.when(F.size("in_round") != 1, "metadata_count")))
        .withColumn("metadata_path", path)
        .withColumn("body", body)
        .withColumn("meta", F.from_json("body", METADATA_SCHEMA))
    )


def _facts() -> list[Column | str]:
    return [
        *ROUND,
        "pr_num",
        "created_at",
        "author",
        F.col("meta.worker_id").alias("worker_id"),
        F.col("meta.update_id").alias("update_id"),
        F.col("meta.num_tokens").alias("num_tokens"),
        "revision",
        "metadata_path",
        "meta",
    ]


def _payload_reason() -> Column:
    return first_payload_problem(F.col("meta.delta_files"), parent_dir(F.col("metadata_path")), F.col("payload_paths"))


def validate_submissions(
    submissions: DataFrame,
    events: DataFrame,
    files: DataFrame,
    documents: DataFrame,
    rounds: DataFrame,
    allowed: DataFrame | None = None,
) -> DataFrame:
    """Candidates with their parsed metadata and ``reject_reason`` (NULL for a valid one).

    ``submissions.round`` names the round a submission is held against. The listing and the documents are read once and
    payload tables are not touched at all.
    """
    base = rounds.select(*ROUND, "base_model_revision")
    judged = _read_candidates(submissions, events, files, documents, allowed).join(base, list(ROUND), "left")
    document = metadata_reason(F.col("body"), F.col("meta"), F.col("round"), F.col("base_model_revision"))
    return judged.select(*_facts(), F.coalesce("early_reason", document, _payload_reason()).alias("reject_reason"))


def screen_submissions(
    submissions: DataFrame,
    events: DataFrame,
    files: DataFrame,
    documents: DataFrame,
    allowed: DataFrame | None = None,
) -> DataFrame:
    """As :func:`validate_submissions`, for rounds that may not be open yet.

    The base revision can only be judged once the round is open, so ``base_model_revision`` says what the metadata
    claims. ``reject_reason`` has the faults that come before that rule, ``later_reason`` the first one behind it.
    """
    judged = _read_candidates(submissions, events, files, documents, allowed)
    document = _document_reason(F.col("body"), F.col("meta"), F.col("round"))
    return judged.select(
        *_facts(),
        F.col("meta.base_model_revision").alias("base_model_revision"),
        F.coalesce("early_reason", document).alias("reject_reason"),
        F.coalesce(_content_reason(F.col("meta")), _payload_reason()).alias("later_reason"),
    )


IDENTITY = (*ROUND, "author", "worker_id")


def first_per_identity(valid: DataFrame) -> DataFrame:
    """Earliest valid submission of each (author, worker) in a round, ties by number.

    The minimum of a struct, combined before the shuffle, takes the place of a ranking window, so that an identity
    with very many submissions costs one row per task.
    """
    others = [c for c in valid.columns if c not in (*IDENTITY, "created_at", "pr_num")]
    earliest = F.min_by(F.struct("created_at", "pr_num", *others), F.struct("created_at", "pr_num"))
    return (
        valid.groupBy(*IDENTITY)
        .agg(earliest.alias("first"))
        .select(*IDENTITY, "first.*")
        .select(*valid.columns)
    )


def author_cap(firsts: DataFrame, max_per_author: int) -> DataFrame:
    """At most ``max_per_author`` accepted identities per author and round, in order of time."""
    return top_rows(
        firsts,
        [*ROUND, "author"],
        [F.col("created_at").asc(), F.col("pr_num").asc()],
        max_per_author,
        rank="author_rank",
        salt_by="pr_num",
    ).drop("author_rank")


def accept_updates(valid: DataFrame, max_per_author: int = 1) -> DataFrame:
    """What the sequential rule "skip known identities and full authors" accepts.

    Capping the first rows of the identities equals the sequential rule, because an identity belongs to one author.
    """
    return author_cap(first_per_identity(valid), max_per_author)


def acceptance_rejects(valid: DataFrame, accepted: DataFrame) -> DataFrame:
    """Valid submissions that were not accepted, with the reason the sequential rule would give."""
    taken = accepted.select(*(F.col(c).alias(f"_{c}") for c in IDENTITY), F.col("pr_num").alias("taken_by"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in IDENTITY]
    return (
        valid.join(taken, same, "left")
        .drop(*(f"_{c}" for c in IDENTITY))
        .where("taken_by IS NULL OR taken_by <> pr_num")
        .withColumn("reject_reason", F.when(F.col("taken_by").isNull(), "author_limit").otherwise("duplicate_identity"))
        .drop("taken_by")
    )


def discover(validated: DataFrame, max_per_author: int = 1) -> tuple[DataFrame, DataFrame]:
    """Accepted submissions, and all others with their reasons.

    Both results and the join between them need the validated table, so it is written once to the shared folder.
    """
    validated = stage(validated, "validated")
    valid = validated.where("reject_reason IS NULL")
    accepted = stage(accept_updates(valid, max_per_author), "accepted")
    rejected = validated.where("reject_reason IS NOT NULL").unionByName(acceptance_rejects(valid, accepted))
    return accepted, rejected


def quorum(accepted: DataFrame, rounds: DataFrame) -> DataFrame:
    """Rounds with enough accepted submissions, and how many there are."""
    counts = accepted.groupBy(*ROUND).agg(F.count("*").alias("accepted"))
    return counts.join(
        rounds.select(*ROUND, F.col("policy.min_updates").alias("min_updates"), F.col("policy.max_updates").alias("max_updates")),
        list(ROUND),
    ).where(F.col("accepted") >= F.col("min_updates"))


def take_max_updates(accepted: DataFrame, limits: DataFrame) -> DataFrame:
    """The first ``max_updates`` accepted submissions of each round, with their place in ``merge_rank``."""
    joined = accepted.join(limits.select(*ROUND, "max_updates"), list(ROUND))
    return top_rows(
        joined,
        ROUND,
        [F.col("created_at").asc(), F.col("pr_num").asc()],
        F.col("max_updates"),
        rank="merge_rank",
        salt_by="pr_num",
    ).drop("max_updates")


def submission_order(candidates: DataFrame) -> DataFrame:
    """Place of each candidate in its repository by time, ties by number, without ranking a repository in one task."""
    timed = candidates.withColumn("second", F.unix_timestamp("created_at"))
    return running_total(
        timed,
        ["repo_id"],
        "second",
        F.lit(1),
        "place",
        inclusive=True,
        ties=["created_at", "pr_num"],
        order_bits=SECOND_BITS,
    ).drop("second")


def select_quorum(accepted: DataFrame, rounds: DataFrame) -> DataFrame:
    """The submissions to merge. ``accepted`` is read twice, to count and to choose: best a written table."""
    return take_max_updates(accepted, quorum(accepted, rounds))


def submissions_per_author(accepted: DataFrame) -> DataFrame:
    return accepted.groupBy(*ROUND, "author").agg(F.count("*").alias("accepted"))


def round_summary(accepted: DataFrame, chosen: DataFrame, rounds: DataFrame, norms: DataFrame) -> DataFrame:
    """Per round: valid submissions against the minimum; participants and norms of the chosen ones.

    The lists hold at most ``max_updates`` entries.
    """
    counts = accepted.groupBy(*ROUND).agg(F.count("*").alias("valid_updates"))
    entry = F.struct(
        "merge_rank", identity(F.col("author"), F.col("worker_id")).alias("identity"), F.col("verified_norm")
    )
    lists = (
        chosen.join(norms.select("repo_id", "pr_num", "verified_norm"), ["repo_id", "pr_num"])
        .groupBy(*ROUND)
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    )
    return (
        rounds.select(*ROUND, F.col("policy.min_updates").alias("min_updates"))
        .join(counts, list(ROUND), "left")
        .join(lists, list(ROUND), "left")
        .select(
            *ROUND,
            F.coalesce("valid_updates", F.lit(0)).cast("bigint").alias("valid_updates"),
            "min_updates",
            F.col("entries.identity").alias("participants"),
            F.map_from_entries(F.transform("entries", lambda e: F.struct(e["identity"], e["verified_norm"]))).alias(
                "verified_delta_norms"
            ),
        )
    )


def fresh_updates(updates: DataFrame, states: DataFrame) -> DataFrame:
    """Updates whose round is still open on the same base revision."""
    current = states.where("status = 'open'").select(*ROUND, "base_model_revision")
    return updates.join(current, [*ROUND, "base_model_revision"], "left_semi")


def valid_policies(policies: DataFrame) -> DataFrame:
    """Adds ``policy_valid``: 0 < min_updates <= max_updates."""
    return policies.withColumn(
        "policy_valid",
        F.coalesce((F.col("min_updates") > 0) & (F.col("min_updates") <= F.col("max_updates")), F.lit(False)),
    )


def not_yet_submitted(workers: DataFrame, ledger: DataFrame, force: bool = False) -> DataFrame:
    """Workers that may submit for the round: those whose last submission was for another one, unless forced."""
    if force:
        return workers
    seen = ledger.select("repo_id", "worker_id", F.col("last_submitted_round").alias("round"))
    return workers.join(seen, ["repo_id", "worker_id", "round"], "left_anti")


def advance_ledger(ledger: DataFrame, submitted: DataFrame) -> DataFrame:
    """Last submitted round and update per (repository, worker), as a new version of the ledger."""
    columns = ["repo_id", "worker_id", "last_submitted_round", "update_id"]
    newest = F.max(F.struct("last_submitted_round", "update_id"))
    return (
        ledger.select(*columns)
        .unionByName(submitted.select(*columns))
        .groupBy("repo_id", "worker_id")
        .agg(newest.alias("last"))
        .select("repo_id", "worker_id", "last.last_submitted_round", "last.update_id")
    )


def tokens_per_update(local_steps: Column, batch: Column, accumulation: Column, block_size: Column) -> Column:
    return local_steps.cast("bigint") * batch.cast("bigint") * accumulation.cast("bigint") * block_size.cast("bigint")
