"""The coordinator step: batch replay over several rounds, and every place where it can be cut off."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lmtables.operators import rounds as R
from lmtables.streaming.publish import active_momentum, coordinator_step, open_submissions
from lmtables.streaming.store import TableStore

NOW = "2024-01-01"
REPOS = ("a", "b")
POLICY = (
    "named_struct('min_updates', 2, 'max_updates', 3, 'local_steps', 1, 'outer_lr', 0.7D, 'outer_momentum', 0.9D, "
    "'nesterov', true, 'update_dtype', 'float32')"
)


class Crash(Exception):
    pass


def crash_at(point):
    def after(name):
        if name == point:
            raise Crash(name)

    return after


def new_store(spark, path) -> TableStore:
    store = TableStore(spark, str(path))
    requests = spark.sql(" UNION ALL ".join(f"SELECT '{r}' AS repo_id, 'base-{r}' AS base_model_revision, {POLICY} AS policy" for r in REPOS))
    store.append("rounds", R.init_rounds(requests, store.read("rounds"), NOW))
    store.replace_partitions("models", chunks(spark, [(r, 1.0) for r in REPOS]).selectExpr("*", "owner AS repo_id", "concat('base-', owner) AS revision"))
    return store


def chunks(spark, owners, names=("x", "y")):
    rows = [(owner, name, c, [4], [float(value)] * 2) for owner, value in owners for name in names for c in range(2)]
    return spark.createDataFrame(rows, "owner STRING, name STRING, chunk_id INT, shape ARRAY<BIGINT>, values ARRAY<FLOAT>")


def submit(spark, store, round_number, offsets, repos=REPOS, names=("x", "y"), first=0):
    """Accepted submissions with constant deltas, numbered in order of time."""
    keys = [(repo, i + 100 * round_number, i, offset) for repo in repos for i, offset in enumerate(offsets, first)]
    deltas = chunks(spark, [(f"{repo} {pr}", offset) for repo, pr, _, offset in keys], names)
    store.replace_partitions("deltas", deltas.selectExpr("*", "split(owner, ' ')[0] AS repo_id", "CAST(split(owner, ' ')[1] AS BIGINT) AS pr_num", "'rev' AS revision"))
    rows = [(repo, round_number, pr, f"author{i}", "w", f"{repo}-{round_number}-{i}", 10, "rev", "path") for repo, pr, i, _ in keys]
    schema = "repo_id STRING, round INT, pr_num BIGINT, author STRING, worker_id STRING, update_id STRING, num_tokens BIGINT, revision STRING, metadata_path STRING"
    return spark.createDataFrame(rows, schema).withColumn("created_at", F.timestamp_seconds("pr_num"))


def state(store):
    return {r.repo_id: r for r in R.current_states(store.read("rounds")).collect()}


def values(store, repo):
    rows = store.read("models").where((F.col("repo_id") == repo) & (F.col("revision") == state(store)[repo].base_model_revision))
    return np.concatenate([r["values"] for r in rows.collect()])


def expected_values(rounds):
    value, momentum = 1.0, None
    for offsets in rounds:
        g = float(np.mean(offsets))
        momentum = g if momentum is None else 0.9 * momentum + g
        value -= 0.7 * (g + 0.9 * momentum)
    return value


def test_three_rounds(spark, tmp_path):
    store = new_store(spark, tmp_path)
    history = []
    for number, offsets in enumerate([(0.1, 0.3), (0.2, 0.2), (0.05, 0.15)]):
        coordinator_step(store, submit(spark, store, number, offsets), NOW)
        history.append(offsets)
        for repo in REPOS:
            assert np.allclose(values(store, repo), expected_values(history), atol=1e-5)
    now = state(store)["a"]
    assert (now.status, now["round"], now.last_merge.source_round) == ("open", 3, 2)
    assert now.last_merge.participants == ["author0/w", "author1/w"]
    assert set(now.last_merge.verified_delta_norms) == {"author0/w", "author1/w"}
    assert store.read("closed").count() == 12
    assert {r.completed_round for r in active_momentum(store).collect()} == {2}


def test_below_quorum_nothing_happens(spark, tmp_path):
    store = new_store(spark, tmp_path)
    coordinator_step(store, submit(spark, store, 0, (0.1,)), NOW)
    assert {(r.status, r["round"]) for r in state(store).values()} == {("open", 0)}
    assert store.read("markers").isEmpty()


def test_at_most_max_updates(spark, tmp_path):
    store = new_store(spark, tmp_path)
    coordinator_step(store, submit(spark, store, 0, (0.1, 0.1, 0.1, 9.0, 9.0)), NOW)
    assert np.allclose(values(store, "a"), expected_values([(0.1,)]), atol=1e-5)


@pytest.mark.parametrize("point", ["lock", "momentum", "model", "marker", "state"])
def test_resume_after_each_point(spark, tmp_path, point):
    store, history, number = new_store(spark, tmp_path), [], 0
    if point == "momentum":
        # With a history, so that a repeated merge could take its own momentum for the old one.
        history, number = [(0.1, 0.3)], 1
        coordinator_step(store, submit(spark, store, 0, history[0]), NOW)
    accepted = submit(spark, store, number, (0.2, 0.4))
    with pytest.raises(Crash):
        coordinator_step(store, accepted, NOW, after=crash_at(point))
    # Submissions that come in meanwhile must not enter the locked round.
    late = submit(spark, store, number, (5.0, 5.0, 5.0), first=10)
    if point != "state":
        assert {r.status for r in state(store).values()} == {"merging"}
    coordinator_step(store, late, NOW)
    for repo in REPOS:
        assert np.allclose(values(store, repo), expected_values([*history, (0.2, 0.4)]), atol=1e-5)
    assert {(r.status, r["round"]) for r in state(store).values()} == {("open", number + 1)}
    assert store.read("markers").count() == len(REPOS) * (number + 1)
    assert store.read("closed").where(f"merged_round = {number}").count() == 2 * len(REPOS)


def test_bad_payload_is_put_aside_or_raises(spark, tmp_path):
    store = new_store(spark, tmp_path)
    accepted = submit(spark, store, 0, (float("nan"), 0.1, 0.3))
    with pytest.raises(Exception, match="Delta verification failed"):
        coordinator_step(store, accepted, NOW, strict=True)
    coordinator_step(store, accepted, NOW)
    assert np.allclose(values(store, "b"), expected_values([(0.1, 0.3)]), atol=1e-5)
    assert {r.problem for r in store.read("quarantine").collect()} == {"non_finite"}


def test_bad_payload_can_break_the_quorum(spark, tmp_path):
    store = new_store(spark, tmp_path)
    accepted = submit(spark, store, 0, (0.1, 0.2), names=("x",))
    coordinator_step(store, accepted, NOW)
    assert {(r.status, r["round"]) for r in state(store).values()} == {("open", 0)}
    assert {r.problem for r in store.read("quarantine").collect()} == {"keys"}


def test_no_payload_at_all(spark, tmp_path):
    store = new_store(spark, tmp_path)
    accepted = submit(spark, store, 0, (0.1, 0.2)).withColumn("revision", F.lit("other"))
    coordinator_step(store, accepted, NOW)
    assert {r.problem for r in store.read("quarantine").collect()} == {"keys"}


def test_lost_momentum_restarts(spark, tmp_path):
    store = new_store(spark, tmp_path)
    coordinator_step(store, submit(spark, store, 0, (0.1, 0.3)), NOW)
    fresh = TableStore(spark, str(tmp_path))
    fresh.read_original = fresh.read
    fresh.read = lambda name: fresh.read_original(name).limit(0) if name == "momentum" else fresh.read_original(name)
    coordinator_step(fresh, submit(spark, store, 1, (0.2, 0.2)), NOW)
    expected = expected_values([(0.1, 0.3)]) - 0.7 * 1.9 * 0.2
    assert np.allclose(values(store, "a"), expected, atol=1e-5)


def test_copied_update_ids_stay_apart(spark, tmp_path):
    store = new_store(spark, tmp_path)
    accepted = submit(spark, store, 0, (0.1, 0.3), repos=("a",)).unionByName(submit(spark, store, 0, (0.5, 0.7), repos=("b",)))
    coordinator_step(store, accepted.withColumn("update_id", F.lit("copied")), NOW)
    assert np.allclose(values(store, "a"), expected_values([(0.1, 0.3)]), atol=1e-5)
    assert np.allclose(values(store, "b"), expected_values([(0.5, 0.7)]), atol=1e-5)
    last = state(store)["b"].last_merge
    assert last.update_ids == ["copied", "copied"]
    norms = last.verified_delta_norms
    assert norms["author0/w"] == pytest.approx(0.5 * 8**0.5, rel=1e-6) and norms["author1/w"] == pytest.approx(0.7 * 8**0.5, rel=1e-6)


def test_a_bad_repository_does_not_stop_the_others(spark, tmp_path):
    store = new_store(spark, tmp_path)
    accepted = submit(spark, store, 0, (0.1, 0.3))
    with pytest.raises(Crash):
        coordinator_step(store, accepted, NOW, after=crash_at("lock"))
    submit(spark, store, 0, (float("nan"), 0.3), repos=("a",))  # written over after it was locked
    with pytest.raises(Exception, match="Delta verification failed"):
        coordinator_step(store, None, NOW, strict=True)
    for _ in range(2):
        coordinator_step(store, None, NOW)
        assert {k: (r.status, r["round"]) for k, r in state(store).items()} == {"a": ("merging", 0), "b": ("open", 1)}
        assert [(r.repo_id, r.pr_num, r.problem) for r in store.read("failed").collect()] == [("a", 0, "non_finite")]
    assert np.allclose(values(store, "b"), expected_values([(0.1, 0.3)]), atol=1e-5)
    submit(spark, store, 0, (0.1, 0.3), repos=("a",))
    coordinator_step(store, None, NOW)
    assert np.allclose(values(store, "a"), expected_values([(0.1, 0.3)]), atol=1e-5)


def test_merged_submissions_stay_closed(spark, tmp_path):
    store = new_store(spark, tmp_path)
    accepted = submit(spark, store, 0, (0.1, 0.3), repos=("a",))
    coordinator_step(store, accepted, NOW)
    # Claimed again for the next round, together with one new submission: too few are left.
    again = accepted.unionByName(submit(spark, store, 1, (0.5,), repos=("a",))).withColumn("round", F.lit(1))
    coordinator_step(store, again, NOW)
    assert (state(store)["a"].status, state(store)["a"]["round"]) == ("open", 1)
    listing = again.select("repo_id", "pr_num", F.lit("open").alias("status"))
    assert {r.pr_num: r.status for r in open_submissions(store, listing).collect()} == {0: "closed", 1: "closed", 100: "open"}
