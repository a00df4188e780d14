"""The trie of all turn prefixes of conversations, with figures per node, from range shards and a small skeleton."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.session import stage

NAME_BYTES = 16
ROOT = b""
SAMPLED = 32  # conversations looked at for each splitter; more of them only make shards more even
IDS_AT_ONCE = 8192
NODE, PART, ENDS = 0, 1, 2  # kinds of rows that shards write

SHARD = pa.schema(
    [("kind", pa.int8()), ("name", pa.binary()), ("parent", pa.binary()), ("hung", pa.bool_())]
    + [(c, pa.int64()) for c in ("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "size")]
    + [("ends", pa.string()), ("shard", pa.int64()), ("place", pa.int64())]
)
SHARD_TYPE = (
    "kind byte, name binary, parent binary, hung boolean, depth long, conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved long, size long, ends string, shard long, place long"
)
SKELETON_TYPE = "name binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved long"


@dataclass(frozen=True)
class PrefixTrie:
    """nodes: name, parent, depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    ends: id, name, the node at which each conversation ends.

    A node's name is a digest of its turns; the root's is empty. ``conv_id`` is its smallest member.
    """

    nodes: DataFrame
    ends: DataFrame


def conversation_turns(
    conversations: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Each conversation's turns in order: ``id``, ``turns`` (array of mark, size).

    ``mark`` is a digest of role and text, ``size`` the code points of the text; null role and text are empty. Turns go
    by ``turn``, null first, then by role and mark. Rows without a key belong to no conversation; an empty table has
    none; other columns are not read. Texts stay where they are read: a turn of any length is 24 bytes from there on.
    """
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_), 256)
    mark = F.unhex(F.substring(digest, 1, 2 * NAME_BYTES)).alias("mark")
    turns = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).alias("id"), F.struct(F.col(turn).alias("turn"), role_.alias("role"), mark, F.length(text_).cast("long").alias("size")).alias("t")
    )
    ordered = turns.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return ordered.select("id", F.transform("turns", lambda t: F.struct(t["mark"].alias("mark"), t["size"].alias("size"))).alias("turns"))


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths: the names of a conversation's nodes one after the other, so that they sort depth first."""
    for batch in batches:
        turns = batch.column(1)
        offsets, marks = turns.offsets.to_pylist(), turns.values.field("mark").to_pylist()
        sizes = pa.ListArray.from_arrays(turns.offsets, turns.values.field("size"))
        paths = []
        for begin, end in zip(offsets, offsets[1:]):
            above, names = ROOT, []
            for mark in marks[begin:end]:
                above = hashlib.sha256(above + mark).digest()[:NAME_BYTES]
                names.append(above)
            paths.append(b"".join(names))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.binary()), sizes], ["id", "path", "sizes"])


def _names(path: bytes) -> list[bytes]:
    return [path[i : i + NAME_BYTES] for i in range(0, len(path), NAME_BYTES)]


def _dealt(splitters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = splitters.value
        for batch in batches:
            shard = [bisect_right(known, row) for row in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())]
            yield batch.append_column("shard", pa.array(shard, pa.int32()))

    return run


@dataclass
class OpenNode:
    """A node whose subtree is still being read. ``ids`` wait for ``digest`` or, in the skeleton, for a row of their own."""

    name: bytes
    size: int
    in_skeleton: bool
    conv_id: int | None = None
    n_convs: int = 0
    n_children: int = 0
    n_leaves: int = 0
    saved: int = 0
    ids: list[int] = field(default_factory=list)
    digest: object = None

    def told(self) -> str:
        """The digest of all ids so far, in order."""
        if self.digest is None:
            return hashlib.sha256(",".join(map(str, self.ids)).encode()).hexdigest()
        self.flush()
        return self.digest.hexdigest()

    def flush(self) -> None:
        """Takes the waiting ids into the digest."""
        if not self.ids:
            return
        text = ",".join(map(str, self.ids))
        if self.digest is None:
            self.digest = hashlib.sha256(text.encode())
        else:
            self.digest.update(f",{text}".encode())
        self.ids = []


class ShardReader:
    """Reads conversations in path order and writes each node as soon as the next path has left it.

    Only the nodes of the current path are held. What lies in the skeleton may go on in other shards and is written as
    a partial aggregate; every other node is whole.
    """

    def __init__(self, skeleton: frozenset[bytes], ids_at_once: int) -> None:
        self.skeleton = skeleton
        self.ids_at_once = ids_at_once
        self.open: list[OpenNode] = []
        self.rows: list[tuple] = []
        self.path: bytes | None = None
        self.shard = self.place = 0

    def read(self, id_: int, path: bytes, sizes: list[int], shard: int) -> None:
        if shard != self.shard:
            self._chunk(self.open[-1]) if self.open else None
            self.shard = shard
        if path != self.path:
            names, shared = [ROOT, *_names(path)], 0
            while shared < min(len(names), len(self.open)) and names[shared] == self.open[shared].name:
                shared += 1
            self._close(shared)
            for depth in range(shared, len(names)):
                self.open.append(OpenNode(names[depth], sizes[depth - 1] if depth else 0, names[depth] in self.skeleton))
            self.path = path
        node = self.open[-1]
        node.n_convs += 1
        node.conv_id = id_ if node.conv_id is None else min(node.conv_id, id_)
        node.ids.append(id_)
        if len(node.ids) >= self.ids_at_once:
            self._chunk(node)

    def _chunk(self, node: OpenNode) -> None:
        if not node.in_skeleton:
            node.flush()
        elif node.ids:
            text = ",".join(map(str, node.ids))
            self.rows.append((ENDS, node.name, *[None] * 9, text, self.shard, self.place))
            self.place += 1
            node.ids = []

    def _close(self, depth: int) -> None:
        while len(self.open) > depth:
            node, level = self.open.pop(), len(self.open)
            above = self.open[-1] if self.open else None
            known = (node.name, above and above.name, bool(above and above.in_skeleton), level, node.conv_id, node.n_convs, node.n_children)
            if node.in_skeleton:
                self._chunk(node)
                self.rows.append((PART, *known, node.n_leaves, node.saved, node.size, None, None, None))
            else:
                leaves = node.n_leaves or 1
                saved = node.saved + (node.n_convs - 1) * node.size
                self.rows.append((NODE, *known, leaves, saved, node.size, node.told(), None, None))
                above.n_children += 1
                above.n_leaves += leaves
                above.saved += saved
            if above:
                above.n_convs += node.n_convs
                above.conv_id = node.conv_id if above.conv_id is None else min(above.conv_id, node.conv_id)

    def finish(self) -> None:
        self._close(0)

    def written(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[]] * len(SHARD)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SHARD)], schema=SHARD)


def _shards(skeleton, ids_at_once: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ShardReader(skeleton.value, ids_at_once)
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "path", "sizes", "shard"))):
                reader.read(*row)
            yield reader.written()
        reader.finish()
        yield reader.written()

    return run


def _reduced(parts: pd.DataFrame) -> pd.DataFrame:
    """Whole figures of the skeleton's nodes, from the deepest up: what hangs on a node outside of the skeleton is
    summed already, its children inside of it are added."""
    rows = {r.name_: r for r in parts.rename(columns={"name": "name_"}).sort_values("depth", ascending=False).itertuples()}
    figures = {name: [int(r.n_children), int(r.n_leaves), int(r.saved)] for name, r in rows.items()}
    for name, r in rows.items():
        own = figures[name]
        own[1] = own[1] or 1
        own[2] += (int(r.n_convs) - 1) * int(r.size)
        if r.parent is not None:
            above = figures[r.parent]
            above[0], above[1], above[2] = above[0] + 1, above[1] + own[1], above[2] + own[2]
    out = parts.drop(columns="size")
    for place, column in enumerate(("n_children", "n_leaves", "saved")):
        out[column] = [figures[name][place] for name in out["name"]]
    return out


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests over the rows of each name, which come in order; a name's rows are never held together."""
    name, digest = None, None
    for batch in batches:
        names, digests = [], []
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if digest is not None and key == name:
                digest.update(f",{text}".encode())
                continue
            if digest is not None:
                names.append(name)
                digests.append(digest.hexdigest())
            name, digest = key, hashlib.sha256(text.encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], ["name", "told"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([digest.hexdigest()])], ["name", "told"])


def prefix_trie(conversations: DataFrame, *, shards: int | None = None, ids_at_once: int = IDS_AT_ONCE) -> PrefixTrie:
    """The trie of conversations given as ``id`` (an integer) and ``turns`` (array of mark, size), see
    :func:`conversation_turns`.

    Every distinct sequence of first turns is a node; a conversation without turns ends at the root. Equal conversations
    end at one node; an empty table has no node. ``saved_tokens`` sums, over a subtree, the members beyond the first
    times the size of the node's last turn; ``ends_sha256`` is a digest of the ids that end at the node, ascending, with
    commas between. Ids are distinct, other columns are not read.

    Splitters, pairs of path and id, cut the conversations in path order into ``shards`` ranges (the session's shuffle
    partitions if not given), so that even equal conversations are dealt to many. A node that goes on beyond its shard
    starts a splitter's path: the trie of these paths, the skeleton, is sent to all shards. It has a node per splitter
    and turn of one conversation at most, whatever the number of conversations. Shards finish all other nodes
    in one sorted pass that holds one path and ``ids_at_once`` ids of a node; partial aggregates of the skeleton's nodes are combined by name, and the
    skeleton, which is small, is then summed from its leaves up. A conversation is one row, of 24 bytes a turn.
    """
    spark = conversations.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = conversations.select(F.col("id").cast("long").alias("id"), "turns")
    paths = stage(ids.mapInArrow(_named, "id long, path binary, sizes array<long>"), "paths")
    looked_at = paths.select("path", "id").orderBy(F.xxhash64("id"), "id").limit(shards * SAMPLED).collect()
    ordered = sorted((bytes(r.path), r.id) for r in looked_at)
    splitters = [ordered[len(ordered) * i // shards] for i in range(1, shards)] if len(ordered) >= shards else ordered
    names = frozenset([ROOT, *(name for path, _ in splitters for name in _names(path))])
    sent = [spark.sparkContext.broadcast(splitters), spark.sparkContext.broadcast(names)]

    dealt = paths.mapInArrow(_dealt(sent[0]), "id long, path binary, sizes array<long>, shard int")
    in_order = dealt.repartitionById(len(splitters) + 1, "shard").sortWithinPartitions("shard", "path", "id")
    read = stage(in_order.mapInArrow(_shards(sent[1], ids_at_once), SHARD_TYPE), "shards")
    for value in sent:
        value.unpersist()

    parts = read.where(F.col("kind") == PART).groupBy("name").agg(
        *(F.any_value(c).alias(c) for c in ("parent", "depth", "size")),
        F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")),
    )
    reduced = parts.groupBy().applyInPandas(_reduced, SKELETON_TYPE)
    chunks = read.where(F.col("kind") == ENDS).select("name", "ends", "shard", "place")
    told = chunks.repartition("name").sortWithinPartitions("name", "shard", "place").select("name", "ends").mapInArrow(
        _digested, "name binary, told string"
    )
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    skeleton = stage(reduced.join(told, "name", "left").withColumn("ends", F.coalesce("told", nothing)).drop("told"), "skeleton")
    own = read.where(F.col("kind") == NODE).select(*skeleton.columns, "hung")
    # Children of the skeleton are the many of a few parents; these few are sent to them. The others meet their parents.
    above = skeleton.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    hung = own.where("hung").drop("hung").unionByName(skeleton)
    inner = own.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = hung.join(F.broadcast(above), "parent", "left").unionByName(own.where("NOT hung").drop("hung").join(inner, "parent"))
    return PrefixTrie(
        nodes.withColumnsRenamed({"saved": "saved_tokens", "ends": "ends_sha256"}),
        paths.select("id", F.expr(f"substring(path, -{NAME_BYTES})").alias("name")),
    )
