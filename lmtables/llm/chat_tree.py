"""Conversations as prefix trees: turns that conversations share from their start on are emitted once."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lmtables.llm.totals import before
from lmtables.session import stage

START, END = "<|im_start|>", "<|im_end|>"
TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)
OPENING, OPENED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """No control string is left: a backslash goes into each ``<|``, and into each that has backslashes already."""
    return OPENING.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return OPENED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class ChatCodec:
    """Turns to tokens and back. The two marks are ids above the vocabulary; role, text and line ends are encoded apart,
    so that equal turns have equal tokens wherever they stand."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.start, self.end = size, size + 1
        self.newline = self._ids("\n")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Tokens of a turn, and from where to where they are its text."""
        head = [self.start, *self._ids(escape_role(role)), *self.newline]
        body = self._ids(escape(text))
        return [*head, *body, self.end, *self.newline], len(head), len(head) + len(body)

    def decode(self, tokens: list[int]) -> str:
        parts, begin = [], 0
        for place, token in enumerate([*tokens, self.start]):
            if token in (self.start, self.end):
                if begin < place:
                    parts.append(self.tokenizer.decode(tokens[begin:place], skip_special_tokens=False))
                parts.append(START if token == self.start else END)
                begin = place + 1
        return "".join(parts[:-1])


@lru_cache(maxsize=2)
def codec(path: str) -> ChatCodec:
    return ChatCodec(path)


@dataclass(frozen=True)
class ChatForest:
    """nodes: tree, node, parent, depth, tokens, loss_from, loss_to, start, position, ancestors.
    paths: leaf, tree, nodes, spans. conversations: id, leaf.

    A tree's sequence has its nodes by ``start``, depth first, each once. A token at place i of a node has position id
    ``position`` + i and attends to the ``ancestors`` intervals of the sequence and to its node up to itself; the
    tokens from ``loss_from`` to ``loss_to`` bear loss. ``spans`` are the intervals that a conversation is read from.
    """

    nodes: DataFrame
    paths: DataFrame
    conversations: DataFrame


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        source, depth, node, parent, role, text, leaf = [], [], [], [], [], [], []
        for row, turns in enumerate(batch.column(1).to_pylist()):
            above, first = "", len(node)
            for k, turn in enumerate(turns):
                r, t = turn["role"] or "", turn["text"] or ""
                key = xxhash.xxh3_128_hexdigest(f"{above}|{len(r)}|{r}|{t}")
                source.append(row)
                depth.append(k)
                node.append(key)
                parent.append(above or None)
                role.append(r)
                text.append(t)
                above = key
            leaf += [above] * (len(node) - first)
        columns = [batch.column(0).take(pa.array(source, pa.int64())), pa.array(leaf, pa.string()), pa.array(depth, pa.int32())]
        columns += [pa.array(c, pa.string()) for c in (node, parent, role, text)]
        yield pa.RecordBatch.from_arrays(columns, ["id", "leaf", "depth", "node", "parent", "role", "text"])


def _encoded(path: str, learned: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in batches:
            tokens, start, stop = [], [], []  # tokens as arrays: lists of numbers take ten times the room
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                ids, begin, end = encode(role, text)
                tokens.append(np.array(ids, np.int32))
                start.append(begin)
                stop.append(end if role in learned else begin)
            columns = [batch.column(c) for c in ("node", "parent", "depth")] + [pa.array(tokens, pa.list_(pa.int32()))]
            columns += [pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(list(map(len, tokens)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "parent", "depth", "tokens", "loss_from", "loss_to", "length"])

    return run


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Starts and positions of the nodes that a path is the first to have."""
    for batch in batches:
        node, start, position = [], [], []
        rows = zip(*(batch.column(c).to_pylist() for c in ("nodes", "lengths", "shared", "before")))
        for nodes, lengths, shared, offset in rows:
            reach = np.cumsum([0, *lengths])
            node += nodes[shared:]
            position += reach[shared:-1].tolist()
            start += (offset + reach[shared:-1] - reach[shared]).tolist()
        columns = [pa.array(node, pa.string()), pa.array(start, pa.int64()), pa.array(position, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["node", "start", "position"])


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Intervals of the ancestors of each node of a path that is its own, and the intervals of the whole path."""
    for batch in batches:
        leaf, node, spans, whole = [], [], [], []
        for key, steps, shared in zip(*(batch.column(c).to_pylist() for c in ("leaf", "steps", "shared"))):
            found: list[list[int]] = []
            for k, step in enumerate(steps):
                if k >= shared:
                    node.append(step["node"])
                    leaf.append(key)
                    spans.append([{"start": s, "end": e} for s, e in found])
                    whole.append(False)
                if found and found[-1][1] == step["start"]:
                    found[-1][1] += step["length"]
                else:
                    found.append([step["start"], step["start"] + step["length"]])
            node.append(None)
            leaf.append(key)
            spans.append([{"start": s, "end": e} for s, e in found])
            whole.append(True)
        columns = [pa.array(leaf, pa.string()), pa.array(node, pa.string()), pa.array(spans, SPANS), pa.array(whole)]
        yield pa.RecordBatch.from_arrays(columns, ["leaf", "node", "spans", "whole"])


def _after_previous(paths: DataFrame) -> DataFrame:
    """Adds ``shared``: how many nodes a path has in common with the one before it in order.

    Paths lie in range partitions (``pid``). The one before a partition's first is the last of the partitions before,
    one row each. A node's name depends on all above it, so nodes in common are counted by comparing place by place.
    """
    last = paths.groupBy("pid").agg(F.max_by("nodes", "path").alias("tail"), F.max("path").alias("end"))
    earlier = W.orderBy("pid").rowsBetween(W.unboundedPreceding, -1)
    tails = last.select("pid", F.max_by("tail", "end").over(earlier).alias("tail"))
    previous = F.lag("nodes").over(W.partitionBy("pid").orderBy("path"))
    joined = paths.withColumn("previous", previous).join(tails, "pid").withColumn("previous", F.coalesce("previous", "tail"))
    same = F.zip_with("nodes", F.coalesce("previous", F.array().cast("array<string>")), lambda a, b: a.eqNullSafe(b))
    return joined.withColumn("shared", F.size(F.filter(same, lambda x: x))).drop("previous", "tail")


def chat_forest(
    conversations: DataFrame,
    path: str,
    *,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learned: frozenset[str] = frozenset({"assistant"}),
) -> ChatForest:
    """Merges conversations that share initial turns and lays every tree out as one sequence.

    Turns are put in order of ``turn``, then role and text; null texts and roles are empty; rows without a key are one
    conversation; other columns are not read. Equal conversations are one path. A single conversation is one row in a
    task, a tree is not: its paths are sorted by range partitions, nodes and paths meet by equal keys, and running
    totals are taken per partition and over partition totals. So a first turn that a third of all conversations share
    is spread like any other.
    """
    turns = conversations.select(
        F.col(key).alias("id"), F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")).alias("t")
    )
    kind = conversations.schema[key].dataType.simpleString()
    ordered = turns.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    rows = stage(
        ordered.mapInArrow(
            _turns, f"id {kind}, leaf string, depth int, node string, parent string, role string, text string"
        ),
        "turns",
    )
    # A node's name is a digest of its turn and all above it, so any row that has it will do.
    distinct = rows.groupBy("node").agg(*(F.any_value(c).alias(c) for c in ("parent", "depth", "role", "text")))
    nodes = stage(
        distinct.mapInArrow(
            _encoded(path, learned),
            "node string, parent string, depth int, tokens array<int>, loss_from int, loss_to int, length long",
        ),
        "nodes",
    )
    steps = rows.groupBy("leaf", "depth").agg(F.any_value("node").alias("node"))
    sized = steps.join(nodes.select("node", "length"), "node")
    paths = sized.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("depth", "node", "length"))).alias("s"))
    paths = paths.select(
        "leaf",
        F.transform("s", lambda x: x["node"]).alias("nodes"),
        F.transform("s", lambda x: x["length"]).alias("lengths"),
        F.array_join(F.transform("s", lambda x: x["node"]), "").alias("path"),
    )
    sorted_ = stage(paths.repartitionByRange("path").withColumn("pid", F.spark_partition_id()), "paths")
    with_shared = _after_previous(sorted_).withColumn("tree", F.get("nodes", F.lit(0)))
    own = F.aggregate(F.slice("lengths", F.col("shared") + 1, F.size("lengths")), F.lit(0).cast("long"), lambda t, x: t + x)
    laid = stage(before(with_shared.withColumn("own", own), "tree", "pid", ["path"], "own"), "laid")
    starts = laid.select("nodes", "lengths", "shared", "before").mapInArrow(_placed, "node string, start long, position long")
    placed = steps.join(nodes.select("node", "length"), "node").join(starts.select("node", "start"), "node")
    whole = placed.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("depth", "node", "start", "length"))).alias("steps"))
    spans = stage(
        whole.join(laid.select("leaf", "shared"), "leaf")
        .select("leaf", "steps", "shared")
        .mapInArrow(_spanned, "leaf string, node string, spans array<struct<start:long,end:long>>, whole boolean"),
        "spans",
    )
    trees = laid.select("leaf", "tree", "nodes")
    ancestors = spans.where("NOT whole").join(trees.select("leaf", "tree"), "leaf").select("node", "tree", F.col("spans").alias("ancestors"))
    return ChatForest(
        nodes.join(starts, "node").join(ancestors, "node"),
        trees.join(spans.where("whole").select("leaf", "spans"), "leaf"),
        rows.where("node = leaf").select("id", "leaf"),
    )


def _read_back(path: str):
    names = ["leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = codec(path).decode
        for batch in batches:
            out = []
            for row in range(batch.num_rows):  # one conversation at a time as Python objects
                leaf, pieces = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                formatted = "".join(decode(p["tokens"]) for p in pieces)
                turns = [(unescape_role(r), unescape(t)) for r, t in TURN.findall(formatted)]
                masked = [unescape(decode(p["tokens"][p["loss_from"] : p["loss_to"]])) for p in pieces]
                digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                learned = "".join(masked)
                out.append((leaf, len(turns), digest, len(learned), hashlib.sha256(learned.encode()).hexdigest(), len(formatted)))
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return run


def read_back(forest: ChatForest, path: str, *, key: str = "conv_id") -> DataFrame:
    """What every conversation says according to the tokens and masks of its tree: key, ``n_turns``, ``turns_sha256``,
    ``loss_chars``, ``loss_sha256``, ``formatted_chars``."""
    steps = forest.paths.select("leaf", F.posexplode("nodes").alias("depth", "node"))
    pieces = steps.join(forest.nodes.select("node", "tokens", "loss_from", "loss_to"), "node")
    whole = pieces.groupBy("leaf").agg(
        F.sort_array(F.collect_list(F.struct("depth", "tokens", "loss_from", "loss_to"))).alias("pieces")
    )
    said = whole.mapInArrow(
        _read_back(path),
        "leaf string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
    return forest.conversations.join(said, "leaf").select(
        F.col("id").alias(key), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"
    )
