"""The quorum stream over files that arrive in steps, with one checkpoint."""

from __future__ import annotations

import datetime as dt
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lmtables.operators import submissions as S
from lmtables.streaming.intake import start, submission_stream, validating_sink
from lmtables.streaming import quorum as Q
from lmtables.streaming.quorum import IDENTITY, keep_earliest, quorum_stream, use_rocksdb

T0 = dt.datetime(2024, 1, 1)


EVENTS = ", ".join(f"{c} {t}" for c, t in Q.EVENT_TYPES.items())


def event(kind, number, pr=None, second=None, author=None, worker=None, **values):
    row = {"kind": kind, "repo_id": "r", "round": number, "pr_num": pr, "author": author, "worker_id": worker}
    if kind == "submission":
        row |= {"created_at": T0 + dt.timedelta(seconds=second), "update_id": f"u{pr}", "num_tokens": 10, "revision": "rev", "metadata_path": "path"}
    return row | values


def opening(number, low, high, base=None, seq=None):
    return event("opening", number, min_updates=low, max_updates=high, base_model_revision=base, seq=number if seq is None else seq)


def arrive(spark, folder, rows):
    """Rows are events, or submissions in short."""
    full = [r if isinstance(r, dict) else event("submission", *r) for r in rows]
    spark.createDataFrame([tuple(r.get(c) for c in Q.EVENT_TYPES) for r in full], EVENTS).repartition(2).write.mode("append").parquet(str(folder))


def decisions(spark, tmp_path, cap=1, **options):
    """One run over what is new; all decisions so far."""
    use_rocksdb(spark)
    stream = submission_stream(spark, str(tmp_path / "in"), EVENTS)
    writer = (
        quorum_stream(stream, cap, **options)
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "log"))
    )
    start(writer, once=True).awaitTermination()
    return spark.read.parquet(str(tmp_path / "out")).orderBy("round", "attempt", "merge_rank", "pr_num").collect()


def drain(spark, tmp_path, cap=1, **options):
    found = {}
    for r in decisions(spark, tmp_path, cap, **options):
        if r.decision == "chosen":
            found.setdefault((r["round"], r.attempt), []).append(r.pr_num)
    return found


def state_rows(spark, tmp_path, name, **options):
    reader = spark.read.format("statestore").option("stateVarName", name).options(**options)
    return reader.load(str(tmp_path / "log")).collect()


@pytest.mark.parametrize("trim", [False, True])
def test_late_earlier_submission_displaces_its_rival(spark, tmp_path, trim):
    arrive(spark, tmp_path / "in", [opening(0, 2, 2), opening(1, 2, 2), (0, 5, 50, "a", "w1")])
    assert drain(spark, tmp_path, trim=trim) == {}
    arrive(spark, tmp_path / "in", [(0, 3, 30, "a", "w2"), (1, 9, 90, "b", "w")])
    assert drain(spark, tmp_path, trim=trim) == {}
    arrive(spark, tmp_path / "in", [(0, 4, 40, "b", "w")])
    assert drain(spark, tmp_path, trim=trim) == {(0, 1): [3, 4]}
    arrive(spark, tmp_path / "in", [(0, 1, 10, "c", "w"), (1, 8, 80, "c", "w")])
    assert drain(spark, tmp_path, trim=trim) == {(0, 1): [3, 4], (1, 1): [8, 9]}


def test_withdrawn_submission_lets_the_next_one_move_up(spark, tmp_path):
    arrive(spark, tmp_path / "in", [opening(0, 2, 8), (0, 1, 10, "a", "w"), (0, 2, 20, "a", "w")])
    assert drain(spark, tmp_path) == {}
    arrive(spark, tmp_path / "in", [event("withdrawal", 0, 1), (0, 3, 30, "b", "w")])
    assert drain(spark, tmp_path) == {(0, 1): [2, 3]}


def test_submissions_wait_for_their_round(spark, tmp_path):
    rows = [(0, 1, 10, "a", "w"), event("submission", 0, 2, 20, "b", "w", base_model_revision="new")]
    rows += [event("submission", 0, 3, 30, "c", "w", base_model_revision="old"), event("submission", 0, 4, 40, "d", "w", later_reason="x")]
    arrive(spark, tmp_path / "in", rows)
    assert decisions(spark, tmp_path) == []
    arrive(spark, tmp_path / "in", [opening(0, 2, 8, base="new"), event("submission", 0, 5, 50, "e", "w", base_model_revision="old")])
    assert drain(spark, tmp_path) == {(0, 1): [1, 2]}
    got = {(r.pr_num, r.reason) for r in decisions(spark, tmp_path) if r.decision == "rejected"}
    assert got == {(3, "base_revision"), (4, "x"), (5, "base_revision")}


def test_reopened_round_hands_on_another_set(spark, tmp_path):
    arrive(spark, tmp_path / "in", [opening(0, 2, 2), *[(0, n, n, a, "w") for n, a in enumerate("aabcd", 1)]])
    assert drain(spark, tmp_path) == {(0, 1): [1, 3]}
    arrive(spark, tmp_path / "in", [event("reopening", 0, 1)])
    assert drain(spark, tmp_path) == {(0, 1): [1, 3], (0, 2): [2, 3]}  # the same author's next one moves up
    arrive(spark, tmp_path / "in", [event("reopening", 0, 2), event("reopening", 0, 3), (0, 1, 1, "a", "w")])
    assert drain(spark, tmp_path)[0, 3] == [4, 5]  # what was put aside stays away
    arrive(spark, tmp_path / "in", [event("reopening", 0, n) for n in (4, 5)])
    assert set(drain(spark, tmp_path)) == {(0, 1), (0, 2), (0, 3)}  # too few are left
    arrive(spark, tmp_path / "in", [(0, 6, 6, "e", "w"), (0, 7, 7, "f", "w")])
    assert drain(spark, tmp_path)[0, 4] == [6, 7]


def test_finished_rounds_leave_no_state(spark, tmp_path):
    rows = [opening(n, 2, 2) for n in range(2)] + [(n, 10 * n + i, i, "abc"[i], "w") for n in range(2) for i in range(3)]
    arrive(spark, tmp_path / "in", rows)
    assert drain(spark, tmp_path) == {(0, 1): [0, 1], (1, 1): [10, 11]}
    assert len(state_rows(spark, tmp_path, "candidates")) == 6
    arrive(spark, tmp_path / "in", [event("finished", 0, seq=1)])
    decisions(spark, tmp_path)
    for name, left in (("candidates", 3), ("opening", 1), ("attempt", 1), ("closed", 1)):
        assert len(state_rows(spark, tmp_path, name)) == left, name
    # Late for a finished round; an opening of before it does not bring it back, a newer one does.
    arrive(spark, tmp_path / "in", [(0, 7, 7, "d", "w"), opening(0, 1, 1, seq=0)])
    assert [(r.pr_num, r.reason) for r in decisions(spark, tmp_path) if r.decision == "rejected"] == [(7, "round")]
    arrive(spark, tmp_path / "in", [opening(0, 1, 1, seq=5), (0, 8, 8, "d", "w")])
    assert sorted(drain(spark, tmp_path)[0, 1]) == [0, 1, 8]


def test_state_that_nobody_asks_for_ends(spark, tmp_path):
    brief = {"wait_ms": 1, "closed_ms": 1}
    arrive(spark, tmp_path / "in", [(3, 1, 1, "a", "w"), event("finished", 4, seq=9)])
    assert decisions(spark, tmp_path, **brief) == []
    time.sleep(0.1)
    arrive(spark, tmp_path / "in", [(5, 2, 1, "a", "w")])
    got = decisions(spark, tmp_path, **brief)
    assert (3, 1, "round") in {(r["round"], r.pr_num, r.reason) for r in got}  # its round never opened
    assert {r.key["round"] for r in state_rows(spark, tmp_path, "candidates")} <= {5}
    arrive(spark, tmp_path / "in", [(4, 3, 1, "a", "w"), opening(4, 1, 1, seq=4)])
    assert drain(spark, tmp_path, **brief)[4, 1] == [3]  # the mark of the finished round is gone


def test_a_round_that_fills_up_before_it_opens_is_held_in_pages(spark, tmp_path):
    rows = [event("submission", 0, n, n, f"a{n}", "w", base_model_revision="old" if n % 3 == 0 else "new") for n in range(600)]
    arrive(spark, tmp_path / "in", rows)
    assert drain(spark, tmp_path) == {}
    # One more page, a number that comes again with another claim, one that is withdrawn, and one that was before it came.
    more = [(0, Q.PAGE_NUMBERS + 5, 5, "b", "w"), event("submission", 0, 2, 2, "a2", "w", base_model_revision="old")]
    arrive(spark, tmp_path / "in", [*more, event("withdrawal", 0, 1), event("withdrawal", 0, 9000)])
    assert drain(spark, tmp_path) == {}
    assert len(state_rows(spark, tmp_path, "waiting")) == 2
    assert state_rows(spark, tmp_path, "candidates") == []
    arrive(spark, tmp_path / "in", [(0, 9000, 0, "c", "w"), opening(0, 3, 3, base="new")])
    got = decisions(spark, tmp_path)
    assert [r.pr_num for r in got if r.decision == "chosen"] == [4, 5, Q.PAGE_NUMBERS + 5]
    turned_away = sorted((r.pr_num, r.reason, r.num_tokens) for r in got if r.decision == "rejected")
    assert turned_away == sorted((n, "base_revision", 10) for n in {2, *range(0, 600, 3)})
    assert state_rows(spark, tmp_path, "waiting") == []
    assert len(state_rows(spark, tmp_path, "candidates")) == 600 - 200 - 2 + 1


def test_every_submission_is_judged_before_it_is_cut(spark, tmp_path):
    """One identity hands in again and again, on the wrong base as well."""
    rows = [event("submission", 0, n, n, "a", "w", base_model_revision="old" if n % 2 else "new") for n in range(40)]
    options = {"trim": True, "combine": False}
    arrive(spark, tmp_path / "in", [*rows[:20], opening(0, 2, 2, base="new")])
    assert len([r for r in decisions(spark, tmp_path, **options) if r.reason == "base_revision"]) == 10
    assert [r.key["round"] for r in state_rows(spark, tmp_path, "candidates")] == [0]
    arrive(spark, tmp_path / "in", [*rows[20:], (0, 50, 50, "b", "w")])
    got = decisions(spark, tmp_path, **options)
    assert len([r for r in got if r.reason == "base_revision"]) == 20
    assert [r.pr_num for r in got if r.decision == "chosen"] == [0, 50]


def test_a_newer_opening_judges_again(spark, tmp_path):
    claims = ["one", "one", "two", None]
    rows = [event("submission", 0, n, n, f"a{n}", "w", base_model_revision=c) for n, c in enumerate(claims)]
    arrive(spark, tmp_path / "in", [*rows[:2], rows[3], opening(0, 9, 9, base="one", seq=1)])
    assert decisions(spark, tmp_path) == []
    arrive(spark, tmp_path / "in", [rows[2], opening(0, 2, 9, base="two", seq=2)])
    got = decisions(spark, tmp_path)
    assert [r.pr_num for r in got if r.decision == "chosen"] == [2, 3]
    assert [(r.pr_num, r.reason) for r in got if r.decision == "rejected"] == [(0, "base_revision"), (1, "base_revision")]


@pytest.mark.parametrize("trim", [False, True])
def test_any_batches_equal_the_batch_operators(spark, tmp_path, trim):
    rng = random.Random(2)
    rows = [(rng.randrange(3), n, rng.randrange(40), rng.choice("abcd"), rng.choice("xyz")) for n in range(120)]
    for begin in range(0, 120, 40):
        arrive(spark, tmp_path / "in", rows[begin : begin + 40])
        assert drain(spark, tmp_path, 2, trim=trim) == {}
    valid = spark.read.parquet(str(tmp_path / "in")).drop("min_updates", "max_updates")
    policy = "named_struct('min_updates', 3, 'max_updates', 5) AS policy"
    states = spark.range(3).selectExpr("'r' AS repo_id", "CAST(id AS INT) AS round", policy)
    expected = {}
    for r in S.select_quorum(S.accept_updates(valid, 2), states).orderBy("merge_rank").collect():
        expected.setdefault((r["round"], 1), []).append(r.pr_num)
    arrive(spark, tmp_path / "in", [opening(n, 3, 5) for n in range(3)])
    assert drain(spark, tmp_path, 2, trim=trim) == expected


@pytest.mark.parametrize("seed", range(40))
def test_trimming_parts_first_changes_nothing(seed):
    rng = random.Random(seed)
    rows = pd.DataFrame(
        [("r", number % 2, rng.choice("abc"), rng.choice("uvwxyz"), rng.randrange(30), number) for number in range(90)],
        columns=[*IDENTITY, "created_at", "pr_num"],
    )
    rows, most = rows.sample(frac=1, random_state=seed), rng.choice([1, 2, 4, 100, None])
    whole = keep_earliest(rows, 2, most)
    kept = None
    for begin in range(0, len(rows), 7):
        part = rows.iloc[begin : begin + 7]
        kept = keep_earliest(part if kept is None else pd.concat([kept, part]), 2, most)
    assert set(kept["pr_num"]) == set(whole["pr_num"])


def test_intake_replaces_a_repeated_batch(spark, tmp_path):
    document = (
        '{"protocol_version": 1, "update_id": "u", "worker_id": "w", "round": %d, "base_model_revision": "rev", '
        '"delta_files": ["swarm/updates/round-000003/w/u/d.safetensors"], "tensor_count": 1, "local_steps": 1, "num_tokens": 1}'
    )
    tables = {
        "events": spark.createDataFrame([("r", n, 1, f"c{n}") for n in (1, 2)], "repo_id STRING, pr_num BIGINT, seq INT, oid STRING"),
        "files": spark.createDataFrame(
            [("r", f"c{n}", f"swarm/updates/round-000003/w/u/{f}") for n in (1, 2) for f in ("metadata.json", "d.safetensors")],
            "repo_id STRING, revision STRING, path STRING",
        ),
        "documents": spark.createDataFrame(
            [("r", f"c{n}", "swarm/updates/round-000003/w/u/metadata.json", document % (3 if n == 1 else 2)) for n in (1, 2)],
            "repo_id STRING, revision STRING, path STRING, body STRING",
        ),
        "rounds": spark.createDataFrame([("r", 3, "rev")], "repo_id STRING, round INT, base_model_revision STRING"),
    }
    batch = spark.createDataFrame(
        [("r", n, "[swarm] x", "open", "a", T0, 3) for n in (1, 2)],
        "repo_id STRING, pr_num BIGINT, title STRING, status STRING, author STRING, created_at TIMESTAMP, round INT",
    )
    sink = validating_sink(lambda: tables, str(tmp_path / "valid"), str(tmp_path / "rejected"))
    for _ in range(2):
        sink(batch, 0)
    assert [r.pr_num for r in spark.read.parquet(str(tmp_path / "valid")).collect()] == [1]
    assert [(r.pr_num, r.reject_reason) for r in spark.read.parquet(str(tmp_path / "rejected")).collect()] == [(2, "round")]


def publishing(spark, store, tmp_path, log="log"):
    from lmtables.streaming.publish import publishing_sink, round_stream
    from tests.test_publish import NOW

    use_rocksdb(spark)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spark.read.parquet(str(tmp_path / "in")).schema)
    stream = round_stream(store, submission_stream(spark, str(tmp_path / "in"), schema))
    return stream.writeStream.foreachBatch(publishing_sink(store, lambda: NOW)).option("checkpointLocation", str(tmp_path / log))


def test_stream_to_merged_model(spark, tmp_path):
    import numpy as np

    from tests.test_publish import expected_values, new_store, state, submit, values

    store = new_store(spark, tmp_path / "store")
    submit(spark, store, 0, (0.1, 0.3), repos=("a",)).write.parquet(str(tmp_path / "in"))
    for attempt in range(2):
        start(publishing(spark, store, tmp_path, f"log{attempt}"), once=True).awaitTermination()
        assert np.allclose(values(store, "a"), expected_values([(0.1, 0.3)]), atol=1e-5)
    assert state(store)["a"]["round"] == 1 and state(store)["b"]["round"] == 0
    assert store.read("markers").count() == 1


def test_round_that_opens_while_the_stream_runs(spark, tmp_path):
    """One run: the first round is merged, which opens the second one, whose submissions were there before it."""
    import numpy as np

    from tests.test_publish import expected_values, new_store, state, submit, values

    store = new_store(spark, tmp_path / "store")
    submit(spark, store, 1, (0.2, 0.2), repos=("a",)).write.parquet(str(tmp_path / "in"))
    query = start(publishing(spark, store, tmp_path), once=False, poll_seconds=1)
    try:
        submit(spark, store, 0, (0.1, 0.3), repos=("a",)).write.mode("append").parquet(str(tmp_path / "in"))
        deadline = time.time() + 90
        while state(store)["a"]["round"] < 2 and time.time() < deadline:
            assert query.exception() is None
            time.sleep(1)
    finally:
        query.stop()
    assert state(store)["a"]["round"] == 2
    assert np.allclose(values(store, "a"), expected_values([(0.1, 0.3), (0.2, 0.2)]), atol=1e-5)


def test_bad_payload_reopens_the_round(spark, tmp_path):
    import numpy as np

    from tests.test_publish import expected_values, new_store, state, submit, values

    store = new_store(spark, tmp_path / "store")
    # At most three are merged: the fourth one takes the place of the first, whose payload is bad.
    submit(spark, store, 0, (float("nan"), 0.1, 0.3, 0.5), repos=("a",)).write.parquet(str(tmp_path / "in"))
    start(publishing(spark, store, tmp_path), once=True).awaitTermination()
    assert (state(store)["a"].status, state(store)["a"]["round"]) == ("open", 0)
    assert [r.pr_num for r in store.read("quarantine").collect()] == [0]
    start(publishing(spark, store, tmp_path), once=True).awaitTermination()
    assert state(store)["a"]["round"] == 1
    assert np.allclose(values(store, "a"), expected_values([(0.1, 0.3, 0.5)]), atol=1e-5)
