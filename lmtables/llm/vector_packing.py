"""Packs examples into sequences under several limits at once: tokens, segments and loss-bearing tokens."""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.llm.memory import releasing, some_at_once
from lmtables.llm.prefix_counts import byte_letters
from lmtables.session import stage

GROUP_ROWS = 8192
CACHED = 400_000
LONGEST_CACHED = 48
FULL = 1 << 62


# Fixed value: the pre-token pattern of this kind of vocabulary, for text in lower case.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
# Latin text needs no look at single characters.
BEYOND = re.compile("[^\x00-\u024f]")


class PieceEncoder:
    """Ids of whole texts for word-end BPE vocabularies in ``tokenizers`` format, each distinct word and piece encoded once.

    Words are normalized (NFC, lower case) and split as the vocabulary file says; the merges are the library's. Words
    with characters that are not assigned in Python's tables, which the library may class otherwise, go to the library
    whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {token.content: i for i, token in added.items()}
        self.splits = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.letters = {b: c for c, b in byte_letters().items()}
        # Ids as bytes: half the room of tuples, and joined at once.
        self.pieces: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isprintable()  # such bytes stand for themselves
        letters = piece if plain else "".join(map(self.letters.__getitem__, piece.encode()))
        found = array("I", [t.id for t in self.merge(letters)]).tobytes()
        if len(piece) <= LONGEST_CACHED:
            if len(self.pieces) > CACHED:
                self.pieces.clear()
            self.pieces[piece] = found
        return found

    def _plain(self, word: str) -> bytes:
        if not word.isascii():
            word = unicodedata.normalize("NFC", word)
        # A capital sigma has one lower case here, whatever stands around it.
        word = word.lower() if "\u03a3" not in word else "".join(map(str.lower, word))
        return b"".join([self.pieces.get(piece) or self._piece(piece) for piece in PIECE.findall(word)])

    def _word(self, data: bytes) -> bytes:
        word = data.decode()
        if data.isalpha():  # ASCII letters alone: one piece
            piece = word.lower()
            found = self.pieces.get(piece) or self._piece(piece)
        elif not data.isascii() and BEYOND.search(word) and any(unicodedata.category(c) == "Cn" for c in word):
            found = array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        elif "<|" not in word:
            found = self._plain(word)
        else:
            parts = self.splits.split(word)
            found = b"".join([array("I", [self.special[p]]).tobytes() if p in self.special else self._plain(p) for p in parts])
        if len(data) <= LONGEST_CACHED:
            if len(self.words) > CACHED:
                self.words.clear()
            self.words[data] = found
        return found

    def encode(self, text: str) -> array:
        """Ids of the words between ASCII white space, which no rule of such a vocabulary looks across."""
        known, ids = self.words.get, array("I")
        ids.frombytes(b"".join([known(word) or self._word(word) for word in text.encode().split()]))
        return ids


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def token_pieces(
    docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 1, with_ids: bool = False
) -> DataFrame:
    """Texts as ids, with ``end_id`` after each, cut into pieces of ``capacity``: ``id``, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens`` and, if asked for, ``ids``. The last piece has what is left over."""
    kind = docs.schema[key].dataType.simpleString()
    names = ["id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            source, start, length, crc, total, held = [], [], [], [], [], []
            for row, text_ in enumerate(some_at_once(batch.column(1))):
                ids = encode(text_ or "")
                ids.append(end_id)
                values = np.frombuffer(ids, np.uint32).astype("<u4", copy=False)
                for begin in range(0, len(values), capacity):
                    piece = values[begin : begin + capacity]
                    source.append(row)
                    start.append(begin)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(values))
                    if with_ids:
                        held.append(piece)
            columns = [batch.column(0).take(pa.array(source, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
            columns += [pa.array(held, pa.list_(pa.int64()))] * with_ids
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * with_ids
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(releasing(run), schema)


def fill_bins(demand: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in the bin of each row of ``demand`` (rows × limits), every bin within all ``limits``.

    The dot-product heuristic: the open bin takes the example that still fits and whose demand, weighted by how scarce
    each limit is over all examples, is most aligned with what the bin has left. Equal examples count as one kind, so
    a step looks at kinds only.
    """
    share = demand / limits
    kinds, kind_of = np.unique(demand, axis=0, return_inverse=True)
    kind_of = kind_of.reshape(-1)
    waiting = np.bincount(kind_of, minlength=len(kinds))
    members = np.split(np.argsort(kind_of, kind="stable"), np.cumsum(waiting)[:-1])
    weighted = kinds / limits * share.mean(axis=0)
    bins, places = np.empty(len(demand), np.int64), np.empty(len(demand), np.int64)
    bin_, taken, alive = 0, np.zeros(len(kinds), np.int64), np.arange(len(kinds))
    while len(alive):
        room, place = limits.astype(float), 0
        open_ = alive
        while len(open_):
            open_ = open_[(kinds[open_] <= room).all(axis=1) & (waiting[open_] > 0)]
            if not len(open_):
                break
            best = open_[np.argmax(weighted[open_] @ (room / limits))]
            row = members[best][taken[best]]
            bins[row], places[row] = bin_, place
            taken[best] += 1
            waiting[best] -= 1
            room -= kinds[best]
            place += 1
        bin_ += 1
        alive = alive[waiting[alive] > 0]
    return bins, places


def _free(name: str, taken: list[str]) -> str:
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def pack(pieces: DataFrame, *, tokens: str, loss: str, max_tokens: int, max_segments: int, max_loss: int) -> DataFrame:
    """Places every piece: all columns of ``pieces`` with ``sequence_id`` and ``offset`` (its first token there).

    A piece above a limit, of tokens or of loss, is in no sequence: both are null, and no other piece is touched by it.
    Null tokens or loss are none; a piece of no token takes a segment only. A piece of ``max_tokens`` is a sequence of
    its own. The others are dealt evenly, by row and not by key, to groups of about GROUP_ROWS, and each group is packed
    by ``fill_bins``; equal rows are pieces each. No pieces give no rows. Columns of ``pieces`` called sequence_id or
    offset give way to the result's. The result does not depend on which executor packs a group.
    """
    if min(max_tokens, max_segments) < 1 or max_loss < 0:
        raise ValueError("a sequence needs room for one token and one segment")
    given = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    row, group, size, cost = (_free(c, pieces.columns) for c in ("_piece", "_group", "_tokens", "_loss"))
    held = stage(pieces.withColumn(row, F.monotonically_increasing_id()), "pieces")
    held = held.select(*given, row, *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(n) for c, n in ((tokens, size), (loss, cost))))
    fits = (F.col(size) <= max_tokens) & (F.col(cost) <= max_loss)
    small = held.where(fits & (F.col(size) < max_tokens))
    groups = max(1, -(-small.count() // GROUP_ROWS))
    limits = np.array([max_tokens, max_segments, max(max_loss, 1)])

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(row, ignore_index=True)
        demand = np.column_stack([rows[size], np.ones(len(rows), np.int64), rows[cost]])
        bins, places = fill_bins(demand, limits)
        order = np.lexsort([places, bins])
        taken = demand[order, 0]
        before = np.cumsum(taken) - taken
        opens = np.concatenate([[True], bins[order][1:] != bins[order][:-1]])
        offset = np.empty(len(rows), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(opens, before, 0))
        return pd.DataFrame({row: rows[row], "sequence_id": rows[group].to_numpy() * (1 << 32) + bins, "offset": offset})

    narrow = small.select(row, size, cost, F.pmod(F.xxhash64(row), F.lit(groups)).alias(group))
    placed = narrow.groupBy(group).applyInPandas(place, f"{row} long, sequence_id long, offset long")
    found = small.join(placed, row).select(*given, "sequence_id", "offset")
    own = F.when(fits, F.lit(FULL) + F.col(row)).alias("sequence_id")
    others = held.where(~fits | (F.col(size) >= max_tokens))
    return found.unionByName(others.select(*given, own, F.when(fits, F.lit(0)).cast("long").alias("offset")))


def pack_documents(
    docs: DataFrame,
    path: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    max_tokens: int = 2048,
    max_segments: int = 256,
    max_loss: int = 2048,
    with_ids: bool = False,
) -> DataFrame:
    """Documents as packed pieces: key, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``,
    ``offset`` (and ``ids``). All ids of a document bear loss. Null text is one end token; repeated rows and rows
    without a key are packed each; other columns are not read."""
    pieces = token_pieces(docs, path, key=key, text=text, capacity=min(max_tokens, max_loss), with_ids=with_ids)
    packed = pack(
        pieces.withColumn("loss", F.col("length")),
        tokens="length",
        loss="loss",
        max_tokens=max_tokens,
        max_segments=max_segments,
        max_loss=max_loss,
    )
    return packed.drop("loss").withColumnRenamed("id", key)
