"""The stateful part of discovery: rounds and submissions as events, chosen sets as decisions.

A round is a key of the state. It opens, collects, hands on a chosen set, may come back when a payload was bad, and is
finished; each of these is an event of the stream, in any order and in any batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

KEY = ["repo_id", "round"]
IDENTITY = [*KEY, "author", "worker_id"]
TIME = ["created_at", "pr_num"]
CARRIED = ["author", "worker_id", "update_id", "num_tokens", "revision", "metadata_path"]
HELD = [*CARRIED, "base_model_revision", "later_reason"]
ROW = [*KEY, "pr_num", "created_at", *HELD]
VALUE_SCHEMA = (
    "created_us BIGINT, author STRING, worker_id STRING, update_id STRING, num_tokens BIGINT, revision STRING, "
    "metadata_path STRING, base_model_revision STRING, later_reason STRING"
)
EVENT_TYPES = {
    "kind": "string", "repo_id": "string", "round": "int", "pr_num": "bigint", "created_at": "timestamp",
    "author": "string", "worker_id": "string", "update_id": "string", "num_tokens": "bigint", "revision": "string",
    "metadata_path": "string", "base_model_revision": "string", "later_reason": "string", "seq": "bigint",
    "min_updates": "int", "max_updates": "int",
}
DECISION_SCHEMA = (
    "decision STRING, attempt INT, reason STRING, repo_id STRING, round INT, pr_num BIGINT, created_at TIMESTAMP, "
    "author STRING, worker_id STRING, update_id STRING, num_tokens BIGINT, revision STRING, metadata_path STRING, "
    "merge_rank INT"
)
DECISION_COLUMNS = [c.split(" ")[0] for c in DECISION_SCHEMA.split(", ")]
ROWS_AT_ONCE = 4096
HELD_AT_ONCE = 32_768
PAGE_NUMBERS = 4096
PAGE_SCHEMA = pa.schema(
    [("pr_num", pa.int64()), ("created_at", pa.timestamp("us"))]
    + [(name, pa.int64() if name == "num_tokens" else pa.string()) for name in HELD]
)
WAIT_MS = 7 * 24 * 3600 * 1000
CLOSED_MS = 7 * 24 * 3600 * 1000


def _events(rows: DataFrame, kind: Column, columns: list[str]) -> DataFrame:
    known = {"kind": kind} | {c: F.col(c) for c in columns}
    return rows.select(*(known.get(c, F.lit(None)).cast(t).alias(c) for c, t in EVENT_TYPES.items()))


def submission_events(rows: DataFrame) -> DataFrame:
    """From submissions that passed the rules that need no round. With ``base_model_revision``, what the metadata
    claims, the base is judged against the opening; with ``later_reason`` so are the faults behind that rule."""
    optional = [c for c in ("base_model_revision", "later_reason") if c in rows.columns]
    return _events(rows, F.lit("submission"), [*KEY, *TIME, *CARRIED, *optional])


def withdrawal_events(rows: DataFrame) -> DataFrame:
    return _events(rows, F.lit("withdrawal"), [*KEY, "pr_num"])


def reopening_events(quarantine: DataFrame) -> DataFrame:
    """From submissions with a bad payload: their round goes on without them."""
    return _events(quarantine, F.lit("reopening"), [*KEY, "pr_num"])


def round_events(states: DataFrame) -> DataFrame:
    """From states of rounds as they are written: an open state opens its round and finishes the one merged before."""
    opened = F.struct(
        F.lit("opening").alias("kind"), "round", "base_model_revision", "seq",
        F.col("policy.min_updates").alias("min_updates"), F.col("policy.max_updates").alias("max_updates"),
    )
    finished = F.struct(
        F.lit("finished").alias("kind"), F.col("last_merge.source_round").alias("round"),
        F.lit(None).cast("string").alias("base_model_revision"), "seq",
        F.lit(None).cast("int").alias("min_updates"), F.lit(None).cast("int").alias("max_updates"),
    )
    both = states.where("status = 'open'").select("repo_id", F.explode(F.array(opened, finished)).alias("e"))
    rows = both.select("repo_id", "e.*").where("round IS NOT NULL")
    return _events(rows, F.col("kind"), [*KEY, "base_model_revision", "seq", "min_updates", "max_updates"])


def union_events(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def keep_earliest(rows: pd.DataFrame, max_per_author: int, max_updates: int | None = None, within: list[str] = KEY) -> pd.DataFrame:
    """First row per identity, first identities per author, then the first ``max_updates`` of the round, by time.

    Applying it to parts first changes nothing: whatever a part cuts off has enough accepted rows before it, and a row
    that is displaced later gives way to an earlier one.
    """
    ordered = rows.sort_values(TIME, kind="stable").drop_duplicates([*within, "author", "worker_id"])
    accepted = ordered.groupby([*within, "author"], sort=False, dropna=False).head(max_per_author)
    return accepted if max_updates is None else accepted[accepted.groupby(within, sort=False).cumcount() < max_updates]


class QuorumProcessor(StatefulProcessor):
    """State of one round; tasks hold HELD_AT_ONCE submissions at a time.

    ``opening``: base revision and limits, once known. ``waiting``: submissions that are not judged yet, in pages of
    PAGE_NUMBERS numbers, so that a round that fills up costs one access to the store per page and not per submission.
    ``candidates`` by number: those that may be chosen. ``aside``: numbers that take no part any more. ``attempt``: how
    many sets were handed on, and whether the last one is out. ``closed``: the round is finished; it is all that is left
    of it then, and goes by itself.
    """

    def __init__(self, max_per_author: int, trim: bool, wait_ms: int, closed_ms: int) -> None:
        self.max_per_author, self.trim, self.wait_ms, self.closed_ms = max_per_author, trim, wait_ms, closed_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.opening = handle.getValueState("opening", "base_model_revision STRING, min_updates INT, max_updates INT, seq BIGINT")
        self.waiting = handle.getMapState("waiting", "page BIGINT", "rows BINARY")
        self.candidates = handle.getMapState("candidates", "pr_num BIGINT", VALUE_SCHEMA)
        self.aside = handle.getMapState("aside", "pr_num BIGINT", "done BOOLEAN")
        self.attempt = handle.getValueState("attempt", "number INT, out BOOLEAN")
        self.closed = handle.getValueState("closed", "seq BIGINT", self.closed_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        opening, finished, gone, new = None, None, [], []
        for batch in rows:
            for kind, part in batch.groupby("kind", sort=False):
                if kind == "submission":
                    new.append(part.sort_values(TIME, kind="stable"))
                    if sum(map(len, new)) >= HELD_AT_ONCE:
                        self._hold(new)
                        new = []
                elif kind in ("withdrawal", "reopening"):
                    gone += [int(pr) for pr in part["pr_num"]]
                    self._reopen(kind)
                else:
                    last = part.loc[part["seq"].idxmax()]
                    if kind == "opening" and (opening is None or last["seq"] > opening["seq"]):
                        opening = last
                    elif kind == "finished":
                        finished = max(int(last["seq"]), finished or 0)
        if new:
            self._hold(new)
        for pr in gone:
            self.aside.updateValue((pr,), (True,))
            self.candidates.removeKey((pr,))
            self._withdraw(pr)
        yield from self._settle(key, opening, finished)
        if self.opening.exists():
            yield from self._decide(key)
        elif next(self.waiting.keys(), None) is not None and not list(self.handle.listTimers()):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The round never opened: what waited for it is turned away."""
        if not self.opening.exists():
            yield from self._too_late(key)
            self.aside.clear()

    def _hold(self, parts: list[pd.DataFrame]) -> None:
        """Adds submissions to their pages; the later row of a number takes the place of the earlier one."""
        new = pd.concat(parts) if len(parts) > 1 else parts[0]
        new = new[list(PAGE_SCHEMA.names)].astype({"pr_num": "int64"}).drop_duplicates("pr_num", keep="last")
        if self.aside.exists():
            new = new[[not self.aside.containsKey((int(pr),)) for pr in new["pr_num"]]]
        for page, rows in new.groupby(new["pr_num"] // PAGE_NUMBERS, sort=False):
            table = pa.Table.from_pandas(rows, PAGE_SCHEMA, preserve_index=False)
            held = self.waiting.getValue((int(page),))
            if held is not None:
                held = _read_page(held[0])
                replaced = pc.is_in(held["pr_num"], value_set=table["pr_num"].combine_chunks())
                table = pa.concat_tables([held.filter(pc.invert(replaced)), table])
            self._write_page(int(page), table)

    def _write_page(self, page: int, table: pa.Table) -> None:
        if table.num_rows:
            (batch,) = table.combine_chunks().to_batches()
            self.waiting.updateValue((page,), (batch.serialize().to_pybytes(),))
        else:
            self.waiting.removeKey((page,))

    def _withdraw(self, pr: int) -> None:
        held = self.waiting.getValue((pr // PAGE_NUMBERS,))
        if held is not None:
            held = _read_page(held[0])
            self._write_page(pr // PAGE_NUMBERS, held.filter(pc.not_equal(held["pr_num"], pr)))

    def _waiting_rows(self, key) -> Iterator[pd.DataFrame]:
        """Everything that waits, about ROWS_AT_ONCE at a time."""
        tables, size = [], 0
        for (page,) in [*list(self.waiting.keys()), (None,)]:
            if page is not None:
                tables.append(_read_page(self.waiting.getValue((page,))[0]))
                size += tables[-1].num_rows
            if tables and (page is None or size >= ROWS_AT_ONCE):
                rows = pa.concat_tables(tables).to_pandas(integer_object_nulls=True)
                yield rows.assign(**dict(zip(KEY, key)))[ROW].astype({"pr_num": "int64", "created_at": "datetime64[ns]"})
                tables, size = [], 0

    def _reopen(self, kind: str) -> None:
        if kind == "reopening" and self.attempt.exists():
            self.attempt.update((self.attempt.get()[0], False))

    def _settle(self, key, opening, finished: int | None) -> Iterator[pd.DataFrame]:
        """Takes in the end or the opening of the round, the later of the two if both are told, and judges who waits."""
        if self.closed.exists():
            finished = max(self.closed.get()[0], finished or 0)
        known = self.opening.get() if self.opening.exists() else None
        newest = max(int(opening["seq"]) if opening is not None else -1, known[3] if known else -1)
        if finished is not None and finished >= newest:
            self.closed.update((finished,))
            yield from self._too_late(key) if not known else ()
            for state in (self.opening, self.waiting, self.candidates, self.aside, self.attempt):
                state.clear()
            self._forget_timers()
            return
        if opening is not None and (known is None or int(opening["seq"]) > known[3]):
            self.closed.clear()
            self.attempt.clear()
            self._forget_timers()
            judged = known is not None
            known = (opening["base_model_revision"], int(opening["min_updates"]), int(opening["max_updates"]), int(opening["seq"]))
            self.opening.update(known)
            if judged:
                yield from self._judged_again(key, known[0])
        if known:
            yield from self._admit(key, known[0], known[2])

    def _forget_timers(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def _too_late(self, key) -> Iterator[pd.DataFrame]:
        for held in self._waiting_rows(key):
            yield _decided(held, "rejected", 0, ["round"] * len(held), None)
        self.waiting.clear()

    def _judged_again(self, key, base: str) -> Iterator[pd.DataFrame]:
        """Candidates that an earlier opening let through."""
        for held in self._chunks(key):
            reasons = _faults(held, base)
            bad = held[reasons.notna()]
            for pr in bad["pr_num"]:
                self.candidates.removeKey((int(pr),))
            if len(bad):
                yield _decided(bad, "rejected", 0, list(reasons[reasons.notna()]), None)

    def _admit(self, key, base: str, most: int) -> Iterator[pd.DataFrame]:
        """Judges who waits: the others become candidates, with ``trim`` only those that can be chosen."""
        known, kept = next(self.candidates.keys(), None) is not None, None
        for held in self._waiting_rows(key):
            reasons = _faults(held, base)
            bad, good = held[reasons.notna()], held[reasons.isna()]
            if known:
                for pr in (held if self.trim else bad)["pr_num"]:
                    self.candidates.removeKey((int(pr),))
            if self.trim:
                kept = keep_earliest(good if kept is None else pd.concat([kept, good]), self.max_per_author, most)
            else:
                self._put(good)
            if len(bad):
                yield _decided(bad, "rejected", 0, list(reasons[reasons.notna()]), None)
        if kept is not None:
            for held in list(self._chunks(key)):
                kept = keep_earliest(pd.concat([held, kept]), self.max_per_author, most)
            self.candidates.clear()
            self._put(kept)
        self.waiting.clear()

    def _put(self, rows: pd.DataFrame) -> None:
        for row in rows.itertuples(index=False):
            # Numbers that are null in some rows come as floats.
            carried = [None if pd.isna(v) else int(v) if n == "num_tokens" else v for n, v in ((n, getattr(row, n)) for n in HELD)]
            self.candidates.updateValue((int(row.pr_num),), (pd.Timestamp(row.created_at).value // 1000, *carried))

    def _decide(self, key) -> Iterator[pd.DataFrame]:
        if self.attempt.exists() and self.attempt.get()[1]:
            return
        _, least, most, _ = self.opening.get()
        kept = None
        for held in self._chunks(key):
            kept = keep_earliest(held if kept is None else pd.concat([kept, held]), self.max_per_author, most)
        if kept is not None and len(kept) >= least:
            number = self.attempt.get()[0] + 1 if self.attempt.exists() else 1
            self.attempt.update((number, True))
            if self.trim:
                self.candidates.clear()
            yield _decided(kept, "chosen", number, None, range(1, len(kept) + 1))

    def _chunks(self, key) -> Iterator[pd.DataFrame]:
        """Candidates of the state, some at a time. A chunk is read to its end before it is given out."""
        source, begun = self.candidates.iterator(), True
        while begun:
            rows = []
            for pr, value in source:
                rows.append((*key, pr[0], pd.Timestamp(value[0], unit="us"), *value[1:]))
                if len(rows) == ROWS_AT_ONCE:
                    break
            begun = len(rows) == ROWS_AT_ONCE
            if rows:
                held = pd.DataFrame(rows, columns=ROW)
                yield held.astype({"pr_num": "int64", "created_at": "datetime64[ns]"})


def _read_page(rows: bytes) -> pa.Table:
    return pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(bytes(rows)), PAGE_SCHEMA)])


def _faults(rows: pd.DataFrame, base: str) -> pd.Series:
    """Null for submissions that may be chosen. Without a claimed base the rule was applied before."""
    claimed = rows["base_model_revision"]
    return rows["later_reason"].astype("object").mask(claimed.notna() & (claimed != base), "base_revision")


def _decided(rows: pd.DataFrame, decision: str, attempt: int, reasons, ranks) -> pd.DataFrame:
    out = rows[[*KEY, "pr_num", "created_at", *CARRIED]].assign(decision=decision, attempt=attempt)
    out["reason"] = pd.Series(reasons, index=out.index, dtype="object") if reasons else None
    out["merge_rank"] = pd.array(list(ranks) if ranks else [None] * len(out), dtype="Int32")
    return out[DECISION_COLUMNS]


def combine_locally(events: DataFrame, max_per_author: int) -> DataFrame:
    """Cuts each task's submissions to what can still be chosen, before the shuffle on the round.

    A round with most of the input then sends a few rows per author and task, and the result is the same as long as no
    submission is taken out again. Submissions with different claims about their base are kept apart; those that
    will be turned away when the round opens all go on.
    """
    base = [*KEY, "base_model_revision"]

    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            usable = (batch["kind"] == "submission") & batch["later_reason"].isna()
            if (~usable).any():
                yield batch[~usable]
            if usable.any():
                part = batch[usable].copy()
                part["base_model_revision"] = part["base_model_revision"].fillna("")
                kept = keep_earliest(part if kept is None else pd.concat([kept, part]), max_per_author, within=base)
        if kept is not None:
            yield kept.assign(base_model_revision=kept["base_model_revision"].where(kept["base_model_revision"] != "", None))

    return events.mapInPandas(combine, events.schema)


def quorum_stream(
    events: DataFrame,
    max_per_author: int = 1,
    *,
    trim: bool = False,
    combine: bool | None = None,
    wait_ms: int = WAIT_MS,
    closed_ms: int = CLOSED_MS,
) -> DataFrame:
    """Decisions about the submissions of each round: the ``chosen`` sets, and those ``rejected`` with a reason.

    ``events`` is a stream of submissions, openings, withdrawals, reopenings and ends of rounds (see the functions that
    make them, and :func:`union_events`). Submissions wait for their round to open, ``wait_ms`` at most, and are judged
    against its base then. A set is handed on once, as soon as the minimum is met; candidates are ranked by time at each
    decision, so an earlier submission that arrives late takes the place of a later one. A reopening takes a
    submission out and lets the round hand on another set, as its next attempt; a withdrawal only takes it out. A
    finished round leaves a mark, which goes after ``closed_ms``; later submissions are rejected by it.

    Every candidate is held until its round is finished, as it may have to move up. With ``trim``, those that cannot be
    chosen any more go at once, before the shuffle as well; withdrawals and reopenings find no substitute then. Without
    ``combine`` they go once they are judged, so that each submission that is to be rejected is.
    Events without a repository or a round belong to no round and are left out.
    """
    # A null would also turn the other rounds of its batch into floats, which are keys of their own.
    events = events.where("repo_id IS NOT NULL AND round IS NOT NULL")
    if trim if combine is None else combine:
        events = combine_locally(events, max_per_author)
    return events.groupBy(*KEY).transformWithStateInPandas(
        statefulProcessor=QuorumProcessor(max_per_author, trim, wait_ms, closed_ms),
        outputStructType=DECISION_SCHEMA,
        outputMode="Append",
        timeMode="ProcessingTime",
    )


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark) -> None:
    """The state store that ``transformWithStateInPandas`` needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
