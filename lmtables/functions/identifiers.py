"""Identifiers, paths, seeds and JSON text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the exchange protocol.
PROTOCOL_VERSION = 1
TITLE_PREFIX = "[swarm]"
PROTOCOL_TREE = "swarm/"
UPDATE_ROOT = "swarm/updates"
METADATA_FILE = "metadata.json"
PAYLOAD_SUFFIX = ".safetensors"
INDEX_SUFFIX = ".safetensors.index.json"
MERGE_MARKER_PATH = "swarm/merge-result.json"
ID_CHARACTERS = "A-Za-z0-9_.-"
ID_LENGTH = 80
EDGE_FREE = "A-Za-z0-9_"
# Possessive throughout, so that nothing is tried twice.
ID_PART = (
    f"^[^{EDGE_FREE}]*+((?:[{EDGE_FREE}]|(?:[.-]|[^{ID_CHARACTERS}]++)(?=[^{EDGE_FREE}]*+[{EDGE_FREE}])){{0,{ID_LENGTH}}}+)"
)
SEED_ROUND_STRIDE = 1_000_003
SEED_MODULUS = 2**31


def sanitize_id(value: Column) -> Column:
    """Runs of foreign characters become ``-``; edges lose ``-`` and ``.``; cut to 80 last; empty gives NULL.

    What the id is made of is found first: after the left edge, 80 characters or runs, each with something behind it that
    stays. Only that part is rewritten, however long the text is.
    """
    part = F.regexp_extract(value, ID_PART, 1)
    return F.regexp_replace(F.when(part != "", part), f"[^{ID_CHARACTERS}]+", "-")


def worker_seed(seed: Column, round_number: Column, worker_id: Column) -> Column:
    digest_part = F.conv(F.substring(F.sha2(worker_id, 256), 1, 8), 16, 10).cast("bigint")
    return (seed.cast("bigint") + round_number.cast("bigint") * SEED_ROUND_STRIDE + digest_part) % SEED_MODULUS


def round_prefix(round_number: Column) -> Column:
    """Folder, with trailing slash, that holds the updates of one round."""
    return F.format_string(f"{UPDATE_ROOT}/round-%06d/", round_number.cast("int"))


def update_path(round_number: Column, worker_id: Column, update_id: Column, file_name: Column) -> Column:
    return F.concat(round_prefix(round_number), F.concat_ws("/", worker_id, update_id, file_name))


def parent_dir(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*/)[^/]*$", 1)


def identity(author: Column, worker_id: Column) -> Column:
    """Author and worker; a null one leaves its place empty, so that two identities never become one."""
    return F.concat(F.coalesce(author, F.lit("")), F.lit("/"), F.coalesce(worker_id, F.lit("")))


def update_id(repo_id: Column, round_number: Column, worker_id: Column, attempt: Column | int = 0) -> Column:
    """A 32-digit id that a retried task computes again; ``attempt`` tells forced resubmissions apart."""
    attempt = F.lit(attempt) if isinstance(attempt, int) else attempt
    return F.md5(F.concat_ws("|", repo_id, round_number.cast("string"), worker_id, attempt.cast("string")))


def short_revision(revision: Column) -> Column:
    return F.substring(revision, 1, 12)


def json_sorted(fields: dict[str, Column]) -> Column:
    """JSON text whose keys are in sorted order; nested dicts are sorted as well."""

    def ordered(level: dict) -> Column:
        return F.struct(
            *[
                (ordered(level[key]) if isinstance(level[key], dict) else level[key]).alias(key)
                for key in sorted(level)
            ]
        )

    return F.to_json(ordered(fields), {"ignoreNullFields": "false"})
