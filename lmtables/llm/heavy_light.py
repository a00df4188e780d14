"""Exact Jaccard join of shingle sets: subsets of small sets, inverted lists of large ones."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lmtables.llm.components import connected_components
from lmtables.llm.memory import releasing
from lmtables.session import stage, unstage

SKETCH_BITS = 23  # counters of the frequency sketch: its size does not depend on the data
FILTER_BITS = 24
SLICE_BITS = 14
MERGED_AT_ONCE = 64
LEAST_PARITY_BITS, MOST_PARITY_BITS = 1024, 32768  # of a set's parity bitmap
REPRESENTATIVES, ROUNDS = 8, 4
ROWS_AT_ONCE = 256
LONG_LIST = 50_000  # an inverted list that the sketch expects to be longer does not meet in one task
LARGEST_SMALL = 400  # far beyond the sizes for which subsets can be cheaper
SCAN_COST = 1.0  # of reading a posting, against writing one signature

STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@dataclass(frozen=True)
class Shape:
    words: int = 4
    percent: int = 85

    def least_overlap(self, size: int) -> int:
        """Shared shingles that a set of this size needs with any set it is linked to."""
        return -(-self.percent * size // 100)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return values ^ (values >> np.uint64(29))


def _runs(hashed: np.ndarray, size: int) -> np.ndarray:
    total = np.full(max(0, len(hashed) - size + 1), size, np.uint64)
    for i in range(size):
        total = mixed(total + hashed[i : i + len(total)] * STEPS[i % len(STEPS)])
    return total


def shingle_sets(texts: pa.Array | list[str | None], words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its runs of ``words`` words.

    Words are runs of characters other than ASCII white space, with A-Z in lower case. A shorter text is one run, an
    empty one has none. Texts are hashed side by side; only ROWS_AT_ONCE of them are Python objects at a time.
    """
    for begin in range(0, len(texts), ROWS_AT_ONCE):
        part = texts[begin : begin + ROWS_AT_ONCE]
        tokens = [(t or "").encode().lower().split() for t in (part if isinstance(part, list) else part.to_pylist())]
        sizes = [len(t) for t in tokens]
        hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(tokens)), np.uint64, sum(sizes))
        del tokens
        whole, place = _runs(hashed, words), 0
        for size in sizes:
            if size >= words:
                yield np.unique(whole[place : place + size - words + 1])
            else:
                yield _runs(hashed[place : place + size], size) if size else np.empty(0, np.uint64)
            place += size


def shingles(text: str | None, words: int) -> np.ndarray:
    return next(shingle_sets([text], words))


def set_key(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def short_key(key: bytes) -> int:
    return int.from_bytes(key[:8], "big", signed=True)


def _parity(values: np.ndarray, bits: int) -> np.ndarray:
    """One bit per residue of the shingles: whether an odd number of them has it."""
    odd = np.bincount((values & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _parity_bits(size: int) -> int:
    """As many as shingles or up to twice as many, within bounds, so that the bitmaps of two sets of nearly one size
    differ in length by a factor of two at most."""
    bits = LEAST_PARITY_BITS
    while bits < size and bits < MOST_PARITY_BITS:
        bits *= 2
    return bits


def _slices(counters: np.ndarray) -> list[tuple[int, bytes]]:
    parts = counters.reshape(-1, 1 << SLICE_BITS)
    return [(i, zlib.compress(part.tobytes(), 1)) for i, part in enumerate(parts) if part.any()]


def _slice_array(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def _joined(rows: list, size: int, kind: type) -> np.ndarray:
    out = np.zeros(size, kind)
    for row in rows:
        out[row["slice"] << SLICE_BITS : (row["slice"] + 1) << SLICE_BITS] = _slice_array(row["data"], kind)
    return out


def merge_counters(parts: DataFrame, bits: int) -> np.ndarray:
    """Adds up 2**bits counters, given as rows (part, slice, data), a bounded number of parts at a time. Counters stop
    at their largest value, which only makes very frequent shingles equal in order."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << SLICE_BITS, np.uint32)
        for data in rows["data"]:
            total = np.minimum(total + _slice_array(data, np.uint16), np.iinfo(np.uint16).max)
        data = zlib.compress(total.astype(np.uint16).tobytes(), 1)
        return pd.DataFrame({"part": [rows["part"].iloc[0] // MERGED_AT_ONCE], "slice": [rows["slice"].iloc[0]], "data": [data]})

    count = (parts.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        group = F.floor(F.col("part") / MERGED_AT_ONCE).alias("_group")
        parts = parts.groupBy(group, "slice").applyInPandas(add, "part long, slice int, data binary")
        count = -(-count // MERGED_AT_ONCE)
        if count <= 1:
            break
        parts = stage(parts, "counters")
    return _joined(parts.collect(), 1 << bits, np.uint16)  # 2**bits counters whatever the data


def _described(shape: Shape, kind: pa.DataType):
    """Documents with key, size and parity bitmap of their sets; after them the task's sketch of shingle frequencies."""
    names = ["id", "digest", "short", "n", "parity", "brief", "slice", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.uint16)
        top, most = np.uint64(64 - SKETCH_BITS), np.iinfo(np.uint16).max
        for batch in batches:
            keys, sizes, parity, brief = [], [], [], []
            for values in shingle_sets(batch.column(1), shape.words):
                keys.append(set_key(values) if len(values) else None)
                sizes.append(len(values))
                parity.append(_parity(values, _parity_bits(len(values))) if len(values) else None)
                brief.append(_parity(values, LEAST_PARITY_BITS) if len(values) else None)
                cells, times = np.unique(values >> top, return_counts=True)
                sketch[cells] = np.minimum(sketch[cells] + times, most)
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array([k and short_key(k) for k in keys], pa.int64())]
                + [pa.array(sizes, pa.int64()), *(pa.array(p, pa.list_(pa.int64())) for p in (parity, brief))]
                + [pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())],
                names,
            )
        found = _slices(sketch)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(found), kind), pa.nulls(len(found), pa.binary()), pa.nulls(len(found), pa.int64())]
            + [pa.nulls(len(found), pa.int64()), *[pa.nulls(len(found), pa.list_(pa.int64()))] * 2]
            + [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.binary())],
            names,
        )

    return run


def boundary(sizes: dict[int, int], shape: Shape) -> int:
    """The largest size of a set whose subsets are enumerated, by the least total cost over the histogram of sizes.

    A small set writes one signature per pair of shingles in its prefix; a large one, and a small one that may be
    linked to a large one, writes one per shingle and has its lists scanned.
    """
    spare = {a: a - shape.least_overlap(a) for a in sizes}
    subsets = {a: sizes[a] * max(1, (spare[a] + 2) * (spare[a] + 1) // 2) for a in sizes}
    lists = {a: sizes[a] * (spare[a] + 1) * (1 + SCAN_COST) for a in sizes}

    def cost(limit: int) -> float:
        return sum(subsets[a] for a in sizes if a <= limit) + sum(lists[a] for a in sizes if 100 * a >= shape.percent * (limit + 1))

    return min([0, *sizes], key=lambda limit: (cost(limit), limit))


def _signatures(shape: Shape, sketch, limit: int):
    """Signatures of every text. Two linked sets share one at least.

    Shingles are ordered by sketched frequency, rare ones first, then by hash. Sets that share o shingles have k of
    them among the first size − o + k of each; with o at least ``least_overlap`` this gives pairs (k = 2) for small
    sets and single shingles (k = 1) for large ones.
    """
    top = np.uint64(64 - SKETCH_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            keys, sizes, sigs, splits, repeats = [], [], [], [], []
            for values in shingle_sets(batch.column(0), shape.words):
                size = len(values)
                if not size:
                    continue
                often = counts[(values >> top).astype(np.int64)]
                # Values are sorted, so a stable sort puts equal leading bits in order as well.
                order = np.argsort(often.astype(np.uint64) << np.uint64(48) | values >> np.uint64(16), kind="stable")
                least = shape.least_overlap(size)
                written = 0
                if size <= limit:
                    k = min(2, least)
                    head = order[: size - least + k]
                    first, second = np.triu_indices(len(head), 1) if k == 2 else (np.arange(len(head)),) * 2
                    low, high = values[head[first]], values[head[second]]
                    sigs.append(mixed(np.minimum(low, high) * STEPS[0] + np.maximum(low, high) * STEPS[1]))
                    splits.append(np.minimum(often[head[first]], often[head[second]]))
                    written += len(low)
                if 100 * size >= shape.percent * (limit + 1):
                    head = order[: size - least + 1]
                    sigs.append(values[head])
                    splits.append(often[head])
                    written += len(head)
                keys.append(short_key(set_key(values)))
                sizes.append(size)
                repeats.append(written)
            if not keys:
                continue
            columns = [np.concatenate(sigs).view(np.int64), np.repeat(np.array(keys, np.int64), repeats)]
            columns.append(np.repeat(np.array(sizes, np.int32), repeats))
            columns.append(np.concatenate(splits) >= LONG_LIST)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["sig", "short", "n", "long"])

    return run


def _shared_lists(signatures: DataFrame, sets: DataFrame, shape: Shape, any_long: bool) -> DataFrame:
    """Entries of lists with two different sets at least: ``sig``, ``key``, ``lo`` (the first key of the list).

    A list in order of size falls apart where the next set is too large for a link with the one before; what is alone
    then goes. Lists are first told apart by half of each set's digest, which keeps the one large shuffle narrow. Lists
    that the sketch expects to be long do not meet in one task: their ends are found by an aggregate that combines first.
    Without such lists (``any_long``) the texts are not read again for them.
    """
    by_size = W.partitionBy("sig").orderBy("n", "short")
    smaller, larger = F.lag("n").over(by_size), F.lead("n").over(by_size)
    follows = F.coalesce(_near_in_size(smaller, F.col("n"), shape), F.lit(False))
    followed = F.coalesce(_near_in_size(F.col("n"), larger, shape), F.lit(False))
    begins = F.max(F.when(~F.col("follows"), F.col("n"))).over(by_size)
    short = signatures.where("NOT long").select("sig", "short", "n", follows.alias("follows"), followed.alias("followed"))
    parts = short.withColumn("begins", begins).where("follows OR followed").select("sig", "begins", "short")
    same = W.partitionBy("sig", "begins")
    brief = parts.select(
        F.xxhash64("sig", "begins").alias("sig"), "short", F.min("short").over(same).alias("lo"), F.max("short").over(same).alias("hi")
    ).where("lo <> hi")
    if any_long:
        long = signatures.where("long").select("sig", "short")
        ends = long.groupBy("sig").agg(F.min("short").alias("lo"), F.max("short").alias("hi")).where("lo <> hi")
        brief = brief.unionByName(long.join(ends, "sig"))
    shared = stage(brief.select("sig", "short", "lo").distinct(), "shared")
    named = sets.select("short", "key")
    lists = stage(
        shared.join(named, "short")
        .join(named.select(F.col("short").alias("lo"), F.col("key").alias("first")), "lo")
        .select("sig", "key", F.col("first").alias("lo")),
        "lists",
    )
    unstage(shared)
    return lists


def _halved(bits: Column) -> Column:
    half = (F.size(bits) / 2).cast("int")
    return F.zip_with(F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half), lambda a, b: a.bitwiseXOR(b))


def _most_shared(left: Column, right: Column, n_left: Column, n_right: Column) -> Column:
    """No more shingles than this are shared: each differing parity bit stands for a shingle of one set only. The longer
    bitmap is folded to the length of the other."""
    left, right = (
        F.when(F.size(left) > F.size(right), _halved(left)).otherwise(left),
        F.when(F.size(right) > F.size(left), _halved(right)).otherwise(right),
    )
    return _by_bits(left, right, n_left, n_right)


def _by_bits(left: Column, right: Column, n_left: Column, n_right: Column) -> Column:
    counts = F.zip_with(left, right, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    differing = F.aggregate(counts, F.lit(0), lambda total, bits: total + bits)
    return F.floor((n_left + n_right - differing) / 2)


def _near_in_size(n_left: Column, n_right: Column, shape: Shape) -> Column:
    return F.least(n_left, n_right) * 100 >= F.greatest(n_left, n_right) * shape.percent


def _linked(shared: Column, n_left: Column, n_right: Column, shape: Shape) -> Column:
    return shared * 100 >= (n_left + n_right - shared) * shape.percent


def _sized(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    for end in ("x", "y"):
        pairs = pairs.join(sets.select(F.col("key").alias(end), F.col("n").alias(f"n_{end}")), end)
    return pairs


def _bounded(sized: DataFrame, sets: DataFrame, shape: Shape) -> DataFrame:
    """Adds ``bound``, the most that a pair (x, y) of nearly equal sizes can share, by their bitmaps; others go."""
    pairs = sized.where(_near_in_size(F.col("n_x"), F.col("n_y"), shape))
    for end in ("x", "y"):
        pairs = pairs.join(sets.select(F.col("key").alias(end), F.col("parity").alias(f"p_{end}")), end)
    by_bits = _most_shared(F.col("p_x"), F.col("p_y"), F.col("n_x"), F.col("n_y"))
    return pairs.select("x", "y", "n_x", "n_y", F.least("n_x", "n_y", by_bits).alias("bound"))


def _key_filter(keys: DataFrame) -> np.ndarray:
    """Bits of a filter of fixed size that has all given keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS >> 5, np.uint32)
        for batch in batches:
            for key in batch.column(0).to_pylist():
                place = _filter_place(key)
                bits[place >> 5] |= np.uint32(1 << (place & 31))
        rows = _slices(bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["slice", "data"]
        )

    def union(rows: pd.DataFrame) -> pd.DataFrame:
        data = np.bitwise_or.reduce([_slice_array(d, np.uint32) for d in rows["data"]]).tobytes()
        return pd.DataFrame({"slice": [rows["slice"].iloc[0]], "data": [zlib.compress(data, 1)]})

    parts = keys.mapInArrow(run, "slice int, data binary").groupBy("slice").applyInPandas(union, "slice int, data binary")
    return _joined(parts.collect(), 1 << FILTER_BITS >> 5, np.uint32)


def _filter_place(key: bytes) -> int:
    return int.from_bytes(key[:8], "little") & ((1 << FILTER_BITS) - 1)


def _texts(docs: DataFrame, sets: DataFrame, shape: Shape) -> DataFrame:
    """One text for each of the given sets (key, digest): ``key``, ``text``. A filter of fixed size drops most other texts
    where they are read; the join behind it makes the result exact."""
    wanted = docs.sparkSession.sparkContext.broadcast(_key_filter(sets.select("digest")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            rows, digests = [], []
            for i, values in enumerate(shingle_sets(batch.column(0), shape.words)):
                if len(values):
                    digest = set_key(values)
                    place = _filter_place(digest)
                    if int(bits[place >> 5]) >> (place & 31) & 1:
                        rows.append(i)
                        digests.append(digest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), batch.column(0).take(pa.array(rows, pa.int64()))], ["digest", "text"]
            )

    found = docs.mapInArrow(releasing(run), "digest binary, text string")
    texts = stage(found.join(sets, "digest").groupBy("key").agg(F.min("text").alias("text")), "texts")
    wanted.unpersist()
    return texts


def _verified(pairs: DataFrame, texts: DataFrame, shape: Shape) -> DataFrame:
    """Exact numbers of shared shingles: ``x``, ``y``, ``n_x``, ``n_y``, ``shared``."""
    names = ["x", "y", "n_x", "n_y", "shared"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def values(key: int, text: str) -> np.ndarray:
            if key not in held:
                if len(held) >= 256:
                    held.clear()
                held[key] = shingles(text, shape.words)
            return held[key]

        for batch in batches:
            shared = []
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(begin, ROWS_AT_ONCE)
                for a, b, ta, tb in zip(*(part.column(c).to_pylist() for c in ("x", "y", "t_x", "t_y"))):
                    shared.append(len(np.intersect1d(values(a, ta), values(b, tb), assume_unique=True)))
            columns = [batch.column(c) for c in names[:4]] + [pa.array(shared, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    # Written tables have known sizes: few pairs reach the texts without a shuffle of all of these.
    pairs = stage(pairs.select("x", "y", "n_x", "n_y"), "pairs")
    keys = stage(pairs.select(F.explode(F.array("x", "y")).alias("key")).distinct(), "keys")
    texts = stage(texts.join(keys, "key", "left_semi"), "asked")
    with_texts = pairs
    for end in ("x", "y"):
        with_texts = with_texts.join(texts.select(F.col("key").alias(end), F.col("text").alias(f"t_{end}")), end)
    verified = stage(with_texts.mapInArrow(releasing(run), "x long, y long, n_x long, n_y long, shared long"), "verified")
    unstage(pairs, keys, texts)
    return verified


def jaccard_components(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 4, percent: int = 85, most_left: float = 1.0
) -> DataFrame:
    """One row per document: key, ``n_shingles``, ``component_id``, the smallest key reachable by links.

    Two documents are linked when 100 × shared ≥ percent × union over their sets of distinct shingles of ``words``
    words. Null and empty texts have empty sets and no links; repeated rows and equal sets are one class with one row
    each; a component without any key has a null id; other columns are not read.

    1. One pass over the texts gives sizes, keys and parity bitmaps of the sets and a frequency sketch of fixed size.
    2. The boundary between small and large sets is the one of least cost; ``_signatures`` writes subsets or list
       entries. Lists with one set are dropped.
    3. Every set is compared with the first set of each of its lists, exactly, and components are formed; then with a
       few others of one list with several components left, in rounds. A round that leaves more than the share
       ``most_left`` of the pairs for step 4 is the last one.
    4. In lists that still have several components, sets of different components are compared as well, unless sizes,
       parity bitmaps or the known distances to the list's first set rule a link out. So no link is missed, and no list
       or group of copies becomes all of its pairs.
    """
    shape = Shape(words, percent)
    kind = docs.schema[key].dataType
    spark = docs.sparkSession
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    texts_only = source.select("text")
    described = stage(
        source.mapInArrow(
            releasing(_described(shape, to_arrow_type(kind))),
            f"id {kind.simpleString()}, digest binary, short long, n long, parity array<long>, brief array<long>, "
            "slice int, data binary",
        ).withColumn("part", F.spark_partition_id().cast("long")),
        "described",
    )
    found = described.where("slice IS NULL AND digest IS NOT NULL")
    distinct = found.groupBy("digest").agg(*(F.any_value(c).alias(c) for c in ("short", "n", "parity", "brief")))
    # From here on a set goes by its number, half as wide as its digest.
    sets = stage(distinct.withColumn("key", F.monotonically_increasing_id()), "sets")
    counters = merge_counters(described.where("slice IS NOT NULL").select("part", "slice", "data"), SKETCH_BITS)
    # Only the sets keep their bitmaps.
    rows = stage(described.where("slice IS NULL").select("id", "digest", "n"), "rows")
    unstage(described)
    any_long, sketch = bool((counters >= LONG_LIST).any()), spark.sparkContext.broadcast(counters)
    small = sets.where(F.col("n") <= LARGEST_SMALL).groupBy("n").count().collect()
    limit = boundary({row["n"]: row["count"] for row in small}, shape)
    signatures = texts_only.mapInArrow(releasing(_signatures(shape, sketch, limit)), "sig long, short long, n int, long boolean")
    lists = _shared_lists(signatures, sets, shape, any_long)
    sketch.unpersist()
    texts = _texts(texts_only, sets.join(lists.select("key").distinct(), "key").select("key", "digest"), shape)

    def checked(pairs: DataFrame) -> DataFrame:
        possible = pairs.where(_linked(F.col("bound"), F.col("n_x"), F.col("n_y"), shape))
        return _verified(possible, texts, shape)

    def links(found: DataFrame) -> DataFrame:
        return found.where(_linked(F.col("shared"), F.col("n_x"), F.col("n_y"), shape)).select("x", "y")

    def components(pairs: DataFrame, label: str) -> DataFrame:
        stars = connected_components(pairs, "x", "y")
        return replaced(stars, stage(stars, label))

    def joined(members: DataFrame, found: DataFrame) -> DataFrame:
        # Links connect the components so far, which are joined among themselves; a set without one is its own.
        pairs = links(found)
        for end in ("x", "y"):
            pairs = pairs.join(members.select(F.col("node").alias(end), F.col("component").alias(f"c_{end}")), end, "left")
        bridges = components(pairs.select(F.coalesce("c_x", "x").alias("x"), F.coalesce("c_y", "y").alias("y")), "bridges")
        moved = members.join(bridges.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
        moved = moved.select("node", F.coalesce("to", "component").alias("component"))
        joint = stage(moved.unionByName(bridges.join(members, "node", "left_anti")), "members")
        return replaced(bridges, joint)

    def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
        unstage(old)
        return new

    first = lists.where("key <> lo").select(F.col("key").alias("x"), F.col("lo").alias("y")).distinct()
    first = stage(_sized(first, sets), "first")
    near = stage(_bounded(first, sets, shape), "near")
    compared = checked(near)
    members = components(links(compared), "members")
    entries = _open_entries(lists, members)
    left, round_ = _pairs_left(entries), 0
    while left and round_ < ROUNDS:
        pairs = _bounded(_sized(_representative_pairs(entries, round_), sets), sets, shape)
        found = checked(pairs)
        new = links(found).count()
        before, round_ = left, round_ + 1
        if new:
            members = replaced(members, joined(members, found))
            entries = replaced(entries, _open_entries(entries.drop("component"), members))
            left = _pairs_left(entries)
        unstage(found)
        # Hardly anything is left to connect, or the comparison of the rest is hardly any smaller for the round.
        if 50 * new < sets.count() ** 0.5 or left > most_left * before:
            break
    if left:
        known = first.join(near.select("x", "y", "bound"), ["x", "y"], "left").join(
            compared.select("x", "y", "shared"), ["x", "y"], "left"
        )
        rest = _rest_of_pairs(entries, sets, known, shape)
        found = checked(_bounded(_sized(rest, sets), sets, shape))
        members = replaced(members, joined(members, found))
        unstage(rest, found)
    unstage(lists, texts, first, near, compared, entries)

    classes = rows.where("digest IS NOT NULL").join(sets.select("digest", "key"), "digest")
    classes = classes.join(members, F.col("key") == F.col("node"), "left")
    classes = classes.select("id", "n", F.coalesce("component", "key").alias("class"))
    least = classes.groupBy("class").agg(F.min("id").alias("component_id"))
    linked = classes.join(least, "class").select("id", "n", "component_id")
    alone = rows.where("digest IS NULL").select("id", "n", F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id")


def _open_entries(lists: DataFrame, members: DataFrame) -> DataFrame:
    """Entries, with their components, of the lists in which several components are left."""
    component = F.coalesce("component", "key").alias("component")
    entries = lists.join(members, F.col("key") == F.col("node"), "left").select("sig", "key", "lo", component)
    ends = entries.groupBy("sig").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1")
    return stage(entries.join(ends.select("sig"), "sig"), "open")


def _pairs_left(entries: DataFrame) -> int:
    """Pairs of entries that the comparison of the rest starts from: those outside of the largest component of their
    list against all of it."""
    counts = entries.groupBy("sig", "component").agg(F.count("*").alias("entries"))
    lists = counts.groupBy("sig").agg(F.sum("entries").alias("entries"), F.max("entries").alias("largest"))
    return lists.agg(F.sum((F.col("entries") - F.col("largest")) * F.col("entries").cast("double"))).first()[0] or 0


def _representative_pairs(entries: DataFrame, round_: int) -> DataFrame:
    """Each set of a list with several components against a few others of one of its lists: ``x``, ``y``.

    These comparisons connect most of what is connected and are as many as sets, times a constant. Another round takes
    other lists and other representatives. What they leave open is compared in full afterwards.
    """
    rank = F.row_number().over(W.partitionBy("sig").orderBy(F.xxhash64("key", F.lit(round_))))
    few = entries.select("sig", "key", "component", rank.alias("rank")).where(F.col("rank") <= REPRESENTATIVES)
    others = few.select("sig", F.col("key").alias("other"), F.col("component").alias("c"))
    chosen = F.min_by("sig", F.xxhash64("sig", F.lit(round_))).alias("sig")
    one = entries.groupBy("key").agg(chosen, F.any_value("component").alias("component"))
    pairs = one.join(others, "sig").where("component <> c")
    return pairs.select(F.greatest("key", "other").alias("x"), F.least("key", "other").alias("y")).distinct()


def _rest_of_pairs(entries: DataFrame, sets: DataFrame, known: DataFrame, shape: Shape) -> DataFrame:
    """Pairs of one list that are in different components and not ruled out: ``x``, ``y``.

    ``known`` tells what a set (x) shares with the first set (y) of a list, exactly or at most. Jaccard distance obeys
    the triangle inequality: if the distances of two sets to the first set differ by more than a link may span, the two
    are not linked.
    """
    shared = F.coalesce("shared", "bound", F.least("n_x", "n_y"))
    distance = 1 - shared / (F.col("n_x") + F.col("n_y") - shared)
    known = known.select(
        F.col("x").alias("key"),
        F.col("y").alias("lo"),
        distance.alias("near"),
        F.when(F.col("shared").isNull(), F.lit(1.0)).otherwise(distance).alias("far"),
    )
    counts = entries.groupBy("sig", "component").agg(F.count("*").alias("entries"))
    largest = counts.groupBy("sig").agg(F.max_by("component", F.struct("entries", "component")).alias("largest"))
    # The first set itself has been compared with all others of its list.
    left = (
        entries.where("key <> lo")
        .join(known, ["key", "lo"])
        .join(sets.select("key", "n", "brief"), "key")
        .join(largest, "sig")
        .withColumn("outside", F.col("component") != F.col("largest"))
    )
    left = stage(left.drop("largest", "lo"), "left")
    # Sets outside of the largest component of their list meet all others, so its own pairs are never formed.
    a, b = left.where("outside").alias("a"), left.alias("b")
    n_a, n_b = F.col("a.n"), F.col("b.n")
    span = 1 - shape.percent / 100 + 1e-9
    pairs = a.join(b, "sig").where(
        (F.col("a.component") != F.col("b.component"))
        & (~F.col("b.outside") | (F.col("a.key") < F.col("b.key")))
        & _near_in_size(n_a, n_b, shape)
        & (F.col("a.near") - F.col("b.far") <= span)
        & (F.col("b.near") - F.col("a.far") <= span)
        & _linked(_by_bits(F.col("a.brief"), F.col("b.brief"), n_a, n_b), n_a, n_b, shape)
    )
    x, y = F.greatest("a.key", "b.key").alias("x"), F.least("a.key", "b.key").alias("y")
    return pairs.select(x, y).distinct()
