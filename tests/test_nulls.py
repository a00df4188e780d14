"""Null keys, repeated rows and second writes, where earlier versions lost or mixed rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lmtables.functions.identifiers import identity
from lmtables.operators import evaluation, packing, rounds, submissions, tokens
from lmtables.operators.prefix import running_total
from lmtables.sources.sinks import sink_tensor_shards


@pytest.fixture(scope="module")
def docs(spark):
    rows = [("train", 1, "a b"), ("train", 1, "c"), ("train", 2, None), (None, 3, "a"), ("train", None, "b z")]
    return spark.createDataFrame(rows, "split string, doc_id long, text string")


@pytest.fixture(scope="module")
def vocab(spark):
    rows = [("<pad>", 0), ("<bos>", 1), ("<eos>", 2), ("<unk>", 3), ("a", 4), ("b", 5), ("c", 6)]
    return spark.createDataFrame(rows, "token string, token_id int")


def test_both_forms_of_tokenization_agree(docs, vocab):
    found = [
        sorted((tuple(r) for r in tokens.tokenize(docs, vocab, lookup_limit=limit).collect()), key=repr) for limit in (100, 2)
    ]
    assert found[0] == found[1] and len(found[0]) == 5
    assert ("train", 1, [4, 5]) in found[0] and ("train", 1, [6]) in found[0] and ("train", 2, []) in found[0]


def test_offsets_and_blocks_keep_null_groups(docs, vocab):
    coded = tokens.tokenize(docs, vocab)
    assert packing.token_offsets(coded).count() == 5
    blocks = packing.pack_blocks(coded, 1).collect()
    assert len(blocks) == 6 and sum(r.split is None for r in blocks) == 1
    scoped = packing.batch_scope(docs, 2, num_proc=2)
    assert scoped.count() == 5


def test_running_total_of_null_groups(spark):
    rows = [(None, None, 1), (None, 5, 2), (7, 1, 3), (7, 300, 4)]
    df = spark.createDataFrame(rows, "g long, k long, v long")
    got = {(r.g, r.k): r.t for r in running_total(df, ["g"], "k", F.col("v"), "t").collect()}
    assert got == {(None, None): 0, (None, 5): 1, (7, 1): 0, (7, 300): 3}
    assert running_total(df, [], "k", F.col("v"), "t").count() == 4


def test_position_ids_of_null_sequences(spark):
    masks = spark.createDataFrame([(None, 0, 1), (None, 1, 1), (7, 0, 1)], "conv_id long, turn long, attention_mask int")
    assert evaluation.position_ids(masks, "conv_id", "turn", "attention_mask").count() == 3


def test_an_accepted_row_without_worker_is_not_rejected(spark):
    rows = [("r", 0, "ann", None, 1, 10), ("r", 0, "ann", None, 2, 20), ("r", 0, "bob", "w", 3, 30)]
    valid = spark.createDataFrame(rows, "repo_id string, round int, author string, worker_id string, pr_num int, created_at int")
    accepted = submissions.accept_updates(valid)
    rejected = submissions.acceptance_rejects(valid, accepted)
    assert sorted(r.pr_num for r in accepted.collect()) == [1, 3]
    assert [(r.pr_num, r.reject_reason) for r in rejected.collect()] == [(2, "duplicate_identity")]
    assert set(rejected.columns) == {*valid.columns, "reject_reason"}


def test_identities_without_worker_stay_apart(spark):
    row = spark.range(1).select(identity(F.lit("a"), F.lit(None).cast("string")).alias("x"), identity(F.lit("a"), F.lit("b")).alias("y"))
    assert tuple(row.first()) == ("a/", "a/b")


def test_invalid_policies_are_reported(spark):
    requests = spark.sql(
        "SELECT repo_id, 'rev' AS base_model_revision, named_struct('min_updates', lo, 'max_updates', hi) AS policy "
        "FROM VALUES ('a', 1, 2), ('b', 0, 2), ('c', 3, 2), ('d', CAST(NULL AS INT), 2) AS t(repo_id, lo, hi)"
    )
    assert sorted(r.repo_id for r in rounds.policy_rejects(requests).collect()) == ["b", "c", "d"]


def test_a_second_write_leaves_no_old_shards(spark, tmp_path):
    chunks = spark.range(8).selectExpr(
        "'u' AS update_id", "concat('t', id) AS name", "0L AS chunk_id", "array(1f, 2f) AS values"
    )
    manifest = chunks.selectExpr("update_id", "name", "8L AS tensor_bytes")
    path = str(tmp_path / "shards")
    for limit in (16, 32):
        plan = sink_tensor_shards(chunks, manifest, path, prefix="delta", max_shard_bytes=limit)
        written = spark.read.parquet(path)
        assert written.count() == 8
        assert {r.shard for r in written.collect()} == {r.shard for r in plan.collect()}
    with pytest.raises(ValueError):
        sink_tensor_shards(chunks.limit(0), manifest.limit(0), path, prefix="delta", max_shard_bytes=16)
    assert spark.read.parquet(path).count() == 8
