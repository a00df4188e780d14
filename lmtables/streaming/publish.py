"""One coordinator step over all repositories: lock, merge, publish, open the next round.

Each write either happens whole or not at all, and the marker is the point at which a merge counts as done. A step
that was cut off anywhere is finished by the next one from what the tables say:

* locked without a matching marker: the stored list is merged again, into the same revision;
* locked with a matching marker: only the next round is opened;
* open: submissions are chosen anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lmtables.operators import rounds as R
from lmtables.operators.merge import PAYLOAD, merge_round, verify_updates
from lmtables.operators.submissions import ROUND, select_quorum
from lmtables.session import stage
from lmtables.streaming.quorum import quorum_stream, reopening_events, round_events, submission_events, union_events
from lmtables.streaming.store import TableStore


def coordinator_step(
    store: TableStore,
    accepted: DataFrame | None,
    now: Column | str,
    *,
    weighting: str = "tokens",
    max_delta_norm: float = 0.0,
    momentum_dtype: str = "float32",
    strict: bool = False,
    reopen: bool = False,
    after: Callable[[str], None] = lambda point: None,
) -> None:
    """``accepted`` holds accepted submissions of open rounds; ``after`` is called behind each write (for tests)."""
    lock_ready_rounds(store, accepted, now, strict=strict, reopen=reopen)
    after("lock")
    publish_merges(
        store,
        now,
        weighting=weighting,
        max_delta_norm=max_delta_norm,
        momentum_dtype=momentum_dtype,
        strict=strict,
        after=after,
    )
    finalize_merges(store, now, after=after)


def lock_ready_rounds(
    store: TableStore, accepted: DataFrame | None, now: Column | str, *, strict: bool, reopen: bool = False
) -> None:
    """Verifies the payload of the chosen submissions and locks their rounds.

    A bad payload raises when ``strict``; otherwise it is put aside and the quorum is tested again without it. With
    ``reopen``, ``accepted`` are sets chosen elsewhere: a set with a bad payload is not locked at all, as what is put
    aside reopens its round there and another set will come.
    """
    if accepted is None:
        return
    states = R.current_states(store.read("rounds")).where("status = 'open'")
    fresh = accepted.join(states.select(*ROUND, "base_model_revision"), list(ROUND))
    fresh = fresh.join(store.read("closed"), ["repo_id", "pr_num"], "left_anti")
    known_bad = store.read("quarantine").select(*ROUND, "pr_num")
    left_out = [*ROUND] if reopen else [*ROUND, "pr_num"]
    if reopen:
        known_bad = fresh.join(known_bad, [*ROUND, "pr_num"], "left_semi")
    usable = stage(fresh.join(known_bad.select(*left_out), left_out, "left_anti"), "usable")
    while True:
        chosen = stage(select_quorum(usable, states), "chosen")
        if chosen.isEmpty():
            return
        report = verify_updates(chosen, store.read("deltas"), store.read("models"), strict=strict)
        named = chosen.select("round", "update_id", *PAYLOAD)
        bad = stage(report.where("problem IS NOT NULL").join(named, list(PAYLOAD)), "bad")
        if bad.isEmpty():
            break
        store.append("quarantine", bad)
        usable = usable.join(bad.select(*left_out), left_out, "left_anti")
    store.append("rounds", R.lock_rounds(states, chosen, now))


def publish_merges(
    store: TableStore,
    now: Column | str,
    *,
    weighting: str,
    max_delta_norm: float,
    momentum_dtype: str,
    strict: bool = False,
    after: Callable[[str], None] = lambda point: None,
) -> None:
    """Merges every locked round that has no matching marker yet; model and momentum first, marker last.

    Payload that is bad now, although it was good when the round was locked, raises when ``strict``. Otherwise its
    repository is left out and stays locked, named in the table ``failed``; all others are merged. A later step
    tries it again.
    """
    merging = R.current_states(store.read("rounds")).where("status = 'merging'")
    done = R.matching_markers(merging, store.read("markers")).select(*ROUND)
    merging = stage(merging.join(done, list(ROUND), "left_anti"), "merging")
    if merging.isEmpty():
        return
    updates = R.rebuild_pending(merging).join(merging.select(*ROUND, "base_model_revision"), list(ROUND))
    deltas = store.read("deltas").join(updates.select(*PAYLOAD), list(PAYLOAD), "left_semi")
    report = verify_updates(updates, deltas, store.read("models"), strict=strict)
    named = updates.select("round", "update_id", *PAYLOAD)
    norms = stage(report.join(named, list(PAYLOAD)), "norms")
    bad = norms.where("problem IS NOT NULL")
    if not bad.isEmpty():
        store.append("failed", bad.join(store.read("failed"), [*ROUND, "pr_num", "problem"], "left_anti"))
        merging = stage(merging.join(bad.select(*ROUND), list(ROUND), "left_anti"), "merging")
        if merging.isEmpty():
            return
    revisions = merging.select(
        *ROUND,
        R.merged_revision(F.col("repo_id"), F.col("round"), F.col("pending_merge.update_id")).alias("model_revision"),
    )
    previous = merging.select("repo_id", (F.col("round") - 1).alias("completed_round"))
    momentum = store.read("momentum").join(previous, ["repo_id", "completed_round"], "left_semi")
    merged = merge_round(
        merging,
        store.read("models"),
        deltas,
        norms,
        momentum,
        weighting=weighting,
        max_delta_norm=max_delta_norm,
        momentum_dtype=momentum_dtype,
    )
    stepped = stage(merged, "stepped")
    store.replace_partitions(
        "momentum",
        stepped.select(
            "repo_id", F.col("round").alias("completed_round"), "name", "chunk_id", "shape", F.col("momentum").alias("values")
        ),
    )
    after("momentum")
    store.replace_partitions(
        "models",
        stepped.select(
            "repo_id", F.col("model_revision").alias("revision"), "name", "chunk_id", "shape", F.col("new_values").alias("values")
        ),
    )
    after("model")
    store.append("markers", R.merge_markers(merging, norms, now).join(revisions, list(ROUND)))
    after("marker")


def finalize_merges(store: TableStore, now: Column | str, *, after: Callable[[str], None] = lambda point: None) -> None:
    """Opens the next round of every published merge, then closes the merged submissions.

    What is closed follows from the states alone, so a step that is cut off between the two is made good by the next.
    """
    merging = R.current_states(store.read("rounds")).where("status = 'merging'")
    published = stage(R.matching_markers(merging, store.read("markers")), "published")
    if not published.isEmpty():
        store.append("rounds", R.open_next_rounds(published, merging.columns, now))
        after("state")
    due = stage(merged_submissions(store).join(store.read("closed"), ["repo_id", "pr_num"], "left_anti"), "due")
    if not due.isEmpty():
        store.append("closed", due)


def merged_submissions(store: TableStore) -> DataFrame:
    """Submissions of the last completed round of each repository: repo_id, pr_num, merged_round."""
    states = store.read("rounds")
    last = R.current_states(states).select("repo_id", F.col("last_merge.source_round").alias("round"))
    listed = R.rebuild_pending(states.join(last.where("round IS NOT NULL"), list(ROUND), "left_semi"))
    return listed.select("repo_id", "pr_num", F.col("round").alias("merged_round")).distinct()


def open_submissions(store: TableStore, submissions: DataFrame) -> DataFrame:
    """The listing with merged submissions closed, whatever the host says of them by now."""
    return R.close_accepted(submissions, store.read("closed"))


def active_momentum(store: TableStore) -> DataFrame:
    """Momentum that the next merge of each repository starts from: that of the last completed round."""
    states = R.current_states(store.read("rounds"))
    last = states.select("repo_id", F.col("last_merge.source_round").alias("completed_round")).where(
        "completed_round IS NOT NULL"
    )
    return store.read("momentum").join(last, ["repo_id", "completed_round"], "left_semi")


def publishing_sink(store: TableStore, now: Callable[[], str], **options: object) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges the sets a quorum stream hands on.

    A bad payload goes to the table ``quarantine``, from which the stream reopens the round; the states it writes open
    the next round there. A repeated batch finds its rounds already moved on and changes nothing; one that was cut
    off is finished from the tables, as in :func:`coordinator_step`.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        chosen = batch.where("decision = 'chosen'").drop("decision", "attempt", "reason", "merge_rank")
        coordinator_step(store, stage(chosen, f"chosen-{batch_id}"), now(), reopen=True, **options)

    return sink


def round_stream(store: TableStore, submissions: DataFrame, max_per_author: int = 1, **options: object) -> DataFrame:
    """The quorum stream of a store: submissions, every state that is written to it, and what is put aside."""
    events = union_events(
        submission_events(submissions), round_events(store.stream("rounds")), reopening_events(store.stream("quarantine"))
    )
    return quorum_stream(events, max_per_author, **options)
