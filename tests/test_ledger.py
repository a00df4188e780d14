"""Validation rules, and acceptance against the sequential rule."""

from __future__ import annotations

import datetime as dt
import json
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from lmtables.functions import identifiers as ids
from lmtables.functions import sizes, user
from lmtables.operators import packing
from lmtables.operators import rounds as R
from lmtables.operators import submissions as S
from lmtables.sources.documents import require_supported, scan_json_docs
from lmtables.sources.tensors import checkpoint_complete

T0 = dt.datetime(2024, 1, 1)
GOOD = {
    "protocol_version": 1,
    "update_id": "u",
    "worker_id": "w",
    "round": 3,
    "base_model_revision": "rev",
    "delta_files": ["swarm/updates/round-000003/w/u/delta-00001-of-00001.safetensors"],
    "tensor_count": 1,
    "local_steps": 5,
    "num_tokens": 10,
}


def without(key):
    return {k: v for k, v in GOOD.items() if k != key}


@pytest.mark.parametrize(
    "document,reason",
    [
        (GOOD, None),
        (without("tensor_count"), "missing_keys"),
        (GOOD | {"tensor_count": None}, None),
        (GOOD | {"protocol_version": 2, "round": 9}, "protocol"),
        (GOOD | {"protocol_version": None}, "protocol"),
        (GOOD | {"round": 2}, "round"),
        (GOOD | {"round": None}, "round"),
        (GOOD | {"base_model_revision": "old"}, "base_revision"),
        (GOOD | {"delta_files": []}, "no_delta_files"),
        (GOOD | {"delta_files": "one"}, "no_delta_files"),
        (GOOD | {"delta_files": None}, "no_delta_files"),
        (GOOD | {"local_steps": 0}, "non_positive"),
        (GOOD | {"num_tokens": None}, "non_positive"),
        ("{broken", "unreadable_metadata"),
    ],
)
def test_metadata_rules(spark, document, reason):
    body = document if isinstance(document, str) else json.dumps(document)
    df = spark.createDataFrame([(body,)], "body STRING").withColumn("meta", F.from_json("body", S.METADATA_SCHEMA))
    found = df.select(S.metadata_reason(F.col("body"), F.col("meta"), F.lit(3), F.lit("rev")).alias("r")).first().r
    assert found == reason


FOLDER = "swarm/updates/round-000003/w/u"


def ledger(spark, documents, listings=None, allowed=None, oids=("c1",), statuses=None, titles=None):
    subs, events, files, docs = [], [], [], []
    for n, document in enumerate(documents):
        status = (statuses or {}).get(n, "open")
        title = (titles or {}).get(n, "[swarm] x")
        subs.append(("repo", n, title, status, f"a{n}", T0 + dt.timedelta(seconds=n), 3))
        for seq, oid in enumerate(oids):
            events.append(("repo", n, seq, oid and f"{oid}-{n}"))
        revision = f"{[o for o in oids if o][-1]}-{n}" if any(oids) else "none"
        paths = (listings or {}).get(n, [f"{FOLDER}/metadata.json", f"{FOLDER}/delta-00001-of-00001.safetensors"])
        files += [("repo", revision, p) for p in paths]
        docs += [("repo", revision, p, json.dumps(document)) for p in paths if p.endswith("metadata.json")]
    rounds = [("repo", 3, "rev", "open")]
    checked = S.validate_submissions(
        spark.createDataFrame(subs, "repo_id STRING, pr_num BIGINT, title STRING, status STRING, author STRING, created_at TIMESTAMP, round INT"),
        spark.createDataFrame(events, "repo_id STRING, pr_num BIGINT, seq INT, oid STRING"),
        spark.createDataFrame(files or [("x", "x", "x")], "repo_id STRING, revision STRING, path STRING"),
        spark.createDataFrame(docs or [("x", "x", "x", "{}")], "repo_id STRING, revision STRING, path STRING, body STRING"),
        spark.createDataFrame(rounds, "repo_id STRING, round INT, base_model_revision STRING, status STRING"),
        None if allowed is None else spark.createDataFrame([(a,) for a in allowed], "author STRING"),
    )
    return {r.pr_num: r.reject_reason for r in checked.collect()}


def test_candidates_and_listings(spark):
    delta = f"{FOLDER}/delta-00001-of-00001.safetensors"
    listings = {
        1: [delta],
        2: [f"{FOLDER}/metadata.json", f"{FOLDER}/b/metadata.json", delta],
        3: [f"{FOLDER}/metadata.json"],
        4: ["swarm/updates/round-000002/w/u/metadata.json", delta],
    }
    found = ledger(spark, [GOOD] * 8, listings, statuses={5: "merged", 6: "draft"}, titles={7: "fix"})
    assert found == {0: None, 1: "metadata_count", 2: "metadata_count", 3: "missing_file", 4: "metadata_count", 6: None}


def test_unsafe_and_missing_in_listed_order(spark):
    delta = f"{FOLDER}/delta-00001-of-00001.safetensors"
    documents = [
        GOOD | {"delta_files": [delta, f"{FOLDER}/gone.safetensors", "../x.safetensors"]},
        GOOD | {"delta_files": ["../x.safetensors", f"{FOLDER}/gone.safetensors"]},
        GOOD | {"delta_files": [f"{FOLDER}/delta.bin"]},
        GOOD | {"delta_files": [5]},
        GOOD | {"delta_files": [None]},
    ]
    assert ledger(spark, documents) == {0: "missing_file", 1: "unsafe_path", 2: "unsafe_path", 3: "unsafe_path", 4: "unsafe_path"}


def test_allow_list_none_and_empty(spark):
    assert ledger(spark, [GOOD, GOOD]) == {0: None, 1: None}
    assert ledger(spark, [GOOD, GOOD], allowed=["a1"]) == {0: "not_allowlisted", 1: None}
    assert ledger(spark, [GOOD, GOOD], allowed=[]) == {0: "not_allowlisted", 1: "not_allowlisted"}


def test_last_commit_counts(spark):
    assert ledger(spark, [GOOD], oids=("c1", "c2", None)) == {0: None}
    assert ledger(spark, [GOOD], oids=(None, "")) == {0: "no_commits"}


def sequential(rows, cap):
    """The rule as a loop: (accepted numbers, reason by number)."""
    seen, counts, accepted, reasons = set(), {}, [], {}
    for created, number, author, worker in sorted(rows):
        if (author, worker) in seen:
            reasons[number] = "duplicate_identity"
        elif counts.get(author, 0) >= cap:
            reasons[number] = "author_limit"
        else:
            seen.add((author, worker))
            counts[author] = counts.get(author, 0) + 1
            accepted.append(number)
    return accepted, reasons


def valid_rows(spark, cases):
    rows = [
        ("repo", case, T0 + dt.timedelta(seconds=created), number, author, worker)
        for case, group in enumerate(cases)
        for created, number, author, worker in group
    ]
    return spark.createDataFrame(
        rows, "repo_id STRING, round INT, created_at TIMESTAMP, pr_num BIGINT, author STRING, worker_id STRING"
    ).withColumn("reject_reason", F.lit(None).cast("string"))


def random_cases(seed, count=60):
    rng = random.Random(seed)
    return [
        [
            (rng.randrange(10), case * 1000 + i, rng.choice("abc"), rng.choice("xyz"))
            for i in range(rng.randrange(1, 25))
        ]
        for case in range(count)
    ]


@pytest.mark.parametrize("cap", [1, 2])
def test_acceptance_equals_the_loop(spark, cap):
    cases = random_cases(cap)
    accepted, rejected = S.discover(valid_rows(spark, cases), cap)
    found, reasons = {}, {}
    for r in accepted.collect():
        found.setdefault(r["round"], set()).add(r.pr_num)
    for r in rejected.collect():
        reasons[r.pr_num] = r.reject_reason
    for case, group in enumerate(cases):
        expected, why = sequential(group, cap)
        assert found[case] == set(expected)
        assert {k: v for k, v in reasons.items() if k // 1000 == case} == why


def test_quorum_and_limit(spark):
    cases = random_cases(7)
    accepted = S.accept_updates(valid_rows(spark, cases), 2)
    rounds = spark.range(len(cases)).selectExpr(
        "'repo' AS repo_id", "CAST(id AS INT) AS round", "named_struct('min_updates', 3, 'max_updates', 4) AS policy"
    )
    found = {}
    for r in S.select_quorum(accepted, rounds).orderBy("merge_rank").collect():
        found.setdefault(r["round"], []).append(r.pr_num)
    for case, group in enumerate(cases):
        expected, _ = sequential(group, 2)
        assert found.get(case, []) == (expected[:4] if len(expected) >= 3 else [])


def test_worker_ledger(spark):
    old = spark.createDataFrame([("r", "w1", 3, "u1"), ("r", "w2", 2, "u2")], "repo_id STRING, worker_id STRING, last_submitted_round INT, update_id STRING")
    new = spark.createDataFrame([("r", "w2", 3, "u3"), ("r", "w3", 1, "u4")], old.schema)
    ledger_now = S.advance_ledger(old, new)
    assert sorted(map(tuple, ledger_now.collect())) == [("r", "w1", 3, "u1"), ("r", "w2", 3, "u3"), ("r", "w3", 1, "u4")]
    workers = spark.createDataFrame([("r", "w1", 3), ("r", "w1", 4), ("r", "w4", 3)], "repo_id STRING, worker_id STRING, round INT")
    assert sorted(r["round"] for r in S.not_yet_submitted(workers, ledger_now).collect()) == [3, 4]
    assert S.not_yet_submitted(workers, ledger_now, force=True).count() == 3


@pytest.mark.parametrize(
    "text,expected",
    [("500MB", 500_000_000), ("2GB", 2_000_000_000), (" 1.5 kb ", 1500), ("7", 7), ("1.9", 1), ("5B", None), ("1TB", None), ("", None), ("1.GB", None)],
)
def test_parse_size(spark, text, expected):
    assert spark.createDataFrame([(text,)], "t STRING").select(sizes.parse_size(F.col("t")).alias("v")).first().v == expected


@pytest.mark.parametrize(
    "text,expected",
    [("a b", "a-b"), ("--.x.--", "x"), ("é", None), ("__", "__"), ("a" * 90, "a" * 80), ("x" * 79 + "!y", "x" * 79 + "-"), ("", None)],
)
def test_sanitize_id(spark, text, expected):
    assert spark.createDataFrame([(text,)], "t STRING").select(ids.sanitize_id(F.col("t")).alias("v")).first().v == expected


def sanitized(text):
    kept = re.sub("[^A-Za-z0-9_.-]+", "-", text).strip("-.")[:80]
    return kept or None


def test_sanitize_id_of_any_text(spark):
    chosen = random.Random(5)
    texts = ["".join(chosen.choices("aZ9_.- \n\u00e9\U0001f600", [3, 1, 1, 1, 2, 2, 3, 1, 1, 1], k=chosen.randrange(200))) for _ in range(3000)]
    # Cut within and behind a run, with and without something after it; edges longer than the id.
    for cut in (78, 79, 80, 81):
        texts += ["a" * cut + mark * 500 + end for mark in ".- \u00e9" for end in ("", "b", ".b", " .-")]
    texts += ["x." * 300, ". " * 5000, ". " * 5000 + "a", "a" + "-" * 100_000 + "b", "a." + " " * 100_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING").select("i", ids.sanitize_id(F.col("t")).alias("v"))
    assert {r.i: r.v for r in rows.collect()} == {i: sanitized(t) for i, t in enumerate(texts)}


def test_sanitize_id_does_not_rewrite_the_rest_of_a_text(spark):
    texts = spark.range(0, 400, 1, 4).select(F.repeat(F.concat("id", F.lit(" a, b; ")), 5000).alias("t"))

    def seconds(value):
        begun = time.perf_counter()
        texts.agg(F.sum(F.hash(value))).collect()
        return time.perf_counter() - begun

    whole = F.regexp_replace("t", "[^A-Za-z0-9_.-]+", "-")
    for value in (whole, ids.sanitize_id(F.col("t"))):
        seconds(value)
    assert seconds(ids.sanitize_id(F.col("t"))) < seconds(whole) / 2


def test_version_gate(spark):
    docs = spark.createDataFrame([('{"protocol_version": 1}',), ('{"protocol_version": 2}',), ("{}",)], "body STRING")
    parsed = scan_json_docs(docs, "protocol_version INT")
    assert [r.supported for r in parsed.collect()] == [True, False, False]
    with pytest.raises(Exception, match="Unsupported protocol version"):
        require_supported(parsed).collect()


def test_init_rounds(spark):
    policy = "named_struct('min_updates', {0}, 'max_updates', 3, 'local_steps', 1, 'outer_lr', 0.7D, 'outer_momentum', 0.9D, 'nesterov', true, 'update_dtype', 'float32') AS policy"
    old = spark.createDataFrame([("a", 5, 1, "open", 2, "r2", None, None, None, None)], R.ROUNDS_SCHEMA)
    asked = spark.sql(f"SELECT 'a' AS repo_id, 'x' AS base_model_revision, {policy.format(1)} UNION ALL SELECT 'b', 'y', {policy.format(1)} UNION ALL SELECT 'c', 'z', {policy.format(4)}")
    now = F.lit("2024-01-01").cast("timestamp")
    assert [(r.repo_id, r.seq) for r in R.init_rounds(asked, old, now).collect()] == [("b", 0)]
    forced = R.init_rounds(asked, old, now, force=True)
    assert {(r.repo_id, r.seq) for r in forced.collect()} == {("a", 6), ("b", 0)}
    files = [("y", p) for p in ("config.json", "tokenizer_config.json", "code.py", "model.safetensors")] + [("x", "config.json")]
    complete = checkpoint_complete(spark.createDataFrame(files, "revision STRING, path STRING"), "code.py")
    usable = R.init_rounds(asked, old, now, force=True, checkpoints=complete)
    assert [(r.repo_id, r.base_model_revision) for r in usable.collect()] == [("b", "y")]
    reasons = {r.repo_id: r.reject_reason for r in R.policy_rejects(asked, complete).collect()}
    assert reasons == {"a": "checkpoint", "c": "policy"}
    current = R.current_states(old.unionByName(forced))
    assert {(r.repo_id, r["round"]) for r in current.collect()} == {("a", 0), ("b", 0)}


def test_user_functions(spark):
    texts = [("w " * n,) for n in (19, 20, 60, 61)]
    df = spark.createDataFrame(texts, "text STRING")
    assert [r[0] for r in df.select(user.reward_correct_length(F.col("text"))).collect()] == [0.0, 1.0, 1.0, 0.0]
    grown = user.batched_map(spark.range(10).coalesce(1), lambda b: {"n": [len(b["id"])] * 2}, "n BIGINT", batch_size=4)
    assert sorted(r.n for r in grown.collect()) == [2, 2, 4, 4, 4, 4]


def test_null_texts_and_wide_integers(spark):
    df = spark.createDataFrame([(2**53 + 1, "w " * 20), (None, None), (3, "")], "id BIGINT, text STRING").coalesce(1)
    reward = user.reward_udf(lambda texts, low: [1.0 if len(t.split()) >= low else 0.0 for t in texts], low=20)
    both = df.select(reward(F.col("text")).alias("a"), user.reward_correct_length(F.col("text")).alias("b"))
    assert [tuple(r) for r in both.collect()] == [(1.0, 1.0), (0.0, 0.0), (0.0, 0.0)]
    same = user.batched_map(df, lambda batch: batch, "id BIGINT, text STRING", batch_size=2)
    assert same.collect() == df.collect()
    assert user.batched_map(df.limit(0), lambda batch: 1 / 0, "id BIGINT").isEmpty()


def test_batches_are_full_across_arrow_batches(spark):
    rows = spark.range(0, 25_000, 1, 2)
    sizes = user.batched_map(rows, lambda b: {"n": [len(b["id"])]}, "n INT", batch_size=3_000).collect()
    assert sorted(r.n for r in sizes) == [500, 500] + [3_000] * 8


def test_calls_see_the_rows_of_one_map_call(spark):
    """A function that drops its own tail, called for each scope, packs as the DataFrame operators do."""
    rng = random.Random(4)
    rows = [(rng.choice(["train", None]), i, [rng.randrange(50) for _ in range(rng.randrange(0, 9))]) for i in range(300)]
    docs = spark.createDataFrame(rows, "split STRING, doc_id BIGINT, input_ids ARRAY<INT>").repartition(4)

    def cut(batch):
        flat = [t for ids in batch["input_ids"] for t in ids]
        blocks = [flat[i : i + 16] for i in range(0, len(flat) - 15, 16)]
        count = len(blocks)
        return {"split": batch["split"][:1] * count, "scope": batch["scope"][:1] * count, "block_idx": list(range(count)), "input_ids": blocks}

    scoped = packing.batch_scope(docs, 40, num_proc=3)
    schema = "split STRING, scope BIGINT, block_idx BIGINT, input_ids ARRAY<INT>"
    called = user.batched_map(scoped, cut, schema, columns=["split", "scope", "input_ids"], calls=["split", "scope"], order=["doc_id"])
    packed = packing.pack_blocks(docs, 16, batch_rows=40, num_proc=3).select("split", "scope", "block_idx", "input_ids")
    assert sorted(map(str, called.collect())) == sorted(map(str, packed.collect()))


def test_status_listing(spark):
    states = spark.createDataFrame([("a", 3, "open", "r"), ("b", 0, "merging", "s")], "repo_id STRING, round INT, status STRING, base_model_revision STRING")
    rows = [("a", 1, "open", "[swarm] x", "u"), ("a", 2, "draft", "[swarm] y", "u"), ("a", 3, "open", "other", "u"), ("a", 4, "open", None, "u"), ("a", 5, "open", "[swarm]", None), ("c", 6, "open", "[swarm] z", "u")]
    given = spark.createDataFrame(rows, "repo_id STRING, pr_num BIGINT, status STRING, title STRING, author STRING")
    got = S.status_listing(states, given).orderBy("repo_id", "kind", "pr_num").collect()
    assert [(r.repo_id, r.kind, r.pr_num, r.author) for r in got if r.kind == "submission"] == [("a", "submission", 1, "u"), ("a", "submission", 5, None)]
    assert {r.repo_id: (r["round"], r.round_status, r.open_submissions) for r in got if r.kind == "state"} == {"a": (3, "open", 2), "b": (0, "merging", 0)}
