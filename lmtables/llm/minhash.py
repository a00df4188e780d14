"""MinHash fingerprints of documents, of their edited texts, and classes of near duplicates by signature bands."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lmtables.llm.components import connected_components
from lmtables.llm.heavy_light import mixed
from lmtables.llm.rows import ROW, numbered
from lmtables.session import stage, unstage

WORDS = 5
PERMUTATIONS = 128
SEGMENT = 1 << 15  # shingles that are permuted at a time: they stay in the cache
ROWS_AT_ONCE, CHARS_AT_ONCE = 512, 1 << 20
SAMPLED = 32  # documents looked at for each splitter; more of them only make ranges more even
EMPTY = np.uint32(0xFFFFFFFF)  # every value of the signature of an empty set, and of no other
SPACES = b" \t\n\x0b\x0c\r"

_draw = np.random.Generator(np.random.PCG64(13))
FACTORS, TERMS = (_draw.integers(0, 1 << 64, PERMUTATIONS, np.uint64) for _ in range(2))
STEPS = _draw.integers(0, 1 << 64, 16, np.uint64) | np.uint64(1)

BANDS, DEEP_BANDS = 32, 350
BAND_ROWS, DEEP_ROWS = PERMUTATIONS // BANDS, 16
LARGE = 64  # members of a bucket that still holds several classes
BAND_CHOICES = np.arange(PERMUTATIONS).reshape(BANDS, BAND_ROWS)
DEEP_CHOICES = np.stack([_draw.choice(PERMUTATIONS, DEEP_ROWS, replace=False) for _ in range(DEEP_BANDS)])


def signatures(sets: Sequence[np.ndarray]) -> np.ndarray:
    """A signature for each set of 64-bit hashes, equal for equal sets: rows of PERMUTATIONS 32-bit values.

    The i-th permutation takes the upper half x of a hash to the upper half of FACTORS[i] * x + TERMS[i] modulo 2**64,
    a strongly universal family, and keeps the least value. Sets are laid side by side and cut into segments.
    """
    out = np.full((len(sets), PERMUTATIONS), EMPTY, np.uint32)
    group: list[tuple[int, np.ndarray]] = []
    size = 0
    for row, values in enumerate(sets):
        for begin in range(0, len(values), SEGMENT):
            part = values[begin : begin + SEGMENT]
            group.append((row, part))
            size += len(part)
            if size >= SEGMENT:
                _permuted(group, out)
                group, size = [], 0
    if group:
        _permuted(group, out)
    return out


def _permuted(group: list[tuple[int, np.ndarray]], out: np.ndarray) -> None:
    rows = np.array([row for row, _ in group])
    starts = np.cumsum([0, *(len(part) for _, part in group)])[:-1]
    values = np.concatenate([part for _, part in group]) >> np.uint64(32)
    found, work = np.empty((len(group), PERMUTATIONS), np.uint64), np.empty_like(values)
    for i in range(PERMUTATIONS):
        np.multiply(values, FACTORS[i], out=work)
        np.add(work, TERMS[i], out=work)
        found[:, i] = np.minimum.reduceat(work, starts)
    least = np.minimum(found >> np.uint64(32), np.uint64(EMPTY - 1)).astype(np.uint32)
    np.minimum.at(out, rows, least)


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Share of equal values, row by row: an estimate of the Jaccard similarity of the sets. Empty sets are alike."""
    return (left == right).mean(axis=1)


def word_hashes(text: bytes) -> np.ndarray:
    """Words are runs of bytes other than ASCII white space, with A-Z in lower case."""
    words = text.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def runs(words: np.ndarray, size: int = WORDS) -> np.ndarray:
    """Hashes of all runs of ``size`` words; fewer words are one run, none are none."""
    size = min(size, len(words))
    total = np.full(len(words) - size + 1 if size else 0, size, np.uint64)
    for i in range(size):
        total = mixed(total + words[i : i + len(total)] * STEPS[i])
    return total


def edit(text: str, next_text: str) -> tuple[str, str]:
    """What stays of a text, and what comes behind it: its last quarter (rounded down) gives way to the start of the next
    text, as long or all of it."""
    quarter = len(text) // 4
    return text[: len(text) - quarter], next_text[:quarter]


def shingles_of_both(text: str, kept: str, added: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles that a text shares with ``kept + added`` by their common start, those of its own, and those of the other.

    Words up to the last white space of ``kept`` are the same in both and are hashed once.
    """
    whole, start = text.encode(), kept.encode()
    stable = max(start.rfind(c) for c in SPACES) + 1
    common = word_hashes(whole[:stable])
    ends = [word_hashes(rest) for rest in (whole[stable:], start[stable:] + added.encode())]
    if any(len(common) + len(end) < WORDS for end in ends):
        return np.empty(0, np.uint64), *(runs(np.concatenate([common, end])) for end in ends)
    first = runs(common) if len(common) >= WORDS else np.empty(0, np.uint64)
    # A shingle has at most WORDS - 1 words before those of the end.
    return first, *(runs(np.concatenate([common[-WORDS + 1 :], end])) if len(end) else end for end in ends)


def _in_ranges(docs: DataFrame, ranges: int) -> DataFrame:
    """Documents (id, text) dealt to ranges in order of id and text digest, with ``range``, and ``next`` for copies.

    Each range starts with a splitter; a copy of it goes to the range before, that of the first one to the last range.
    So every document finds the one after it in its own range, and texts are shuffled once.
    """
    keyed = docs.withColumn("digest", F.xxhash64("text"))
    place = F.struct("id", "digest")
    narrow = keyed.select("id", "digest")
    looked_at = narrow.orderBy(F.xxhash64("id", "digest"), "id").limit(ranges * SAMPLED).agg(
        F.sort_array(F.collect_set(place)).alias("found")
    )
    least = narrow.agg(F.min(place).alias("least"))
    found, first = looked_at.first().found, least.first().least
    if first is None:
        return keyed.withColumns({"range": F.lit(0), "next": F.lit(False)}).limit(0)
    splitters = sorted({0, *(len(found) * i // ranges for i in range(1, ranges))})
    chosen = [first, *(s for s in (found[i] for i in splitters) if s != first)]
    kind = docs.schema["id"].dataType
    known = F.array(*(F.struct(F.lit(s["id"]).cast(kind).alias("id"), F.lit(s["digest"]).alias("digest")) for s in chosen))
    range_ = F.size(F.filter(known, lambda s: s <= place)) - 1
    dealt = keyed.withColumn("range", range_)
    is_first = F.get(known, F.col("range")) == place
    own = F.struct(F.col("range"), F.lit(False).alias("next"))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(len(chosen))).alias("range"), F.lit(True).alias("next"))
    copies = F.when(is_first, F.array(own, before)).otherwise(F.array(own))
    return (
        dealt.select("id", "text", "digest", F.explode(copies).alias("at"))
        .select("id", "text", "digest", "at.range", "at.next")
        .repartitionById(len(chosen), "range")
        .sortWithinPartitions("range", "next", "id", "digest", "text")
    )


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], tuple]]:
    """Consecutive documents of one range as (id, text), some at a time, and the one after them."""
    held: list[tuple] = []
    chars, after = 0, None
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(begin, ROWS_AT_ONCE)
            for id_, text, copy in zip(*(part.column(c).to_pylist() for c in ("id", "text", "next"))):
                if copy and after is not None:
                    continue  # one of several equal rows
                if held and (copy or len(held) >= ROWS_AT_ONCE or chars >= CHARS_AT_ONCE):
                    yield held, (id_, text)
                    held, chars = [], 0
                if copy:
                    after = text
                else:
                    held.append((id_, text))
                    chars += len(text)


def _fingerprinted(kind: pa.DataType):
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, after in _groups(batches):
            texts = [text for _, text in rows] + [after[1]]
            digests, common, own, other = [], [], [], []
            for text, next_text in zip(texts, texts[1:]):
                kept, added = edit(text, next_text)
                digests.append(hashlib.sha256((kept + added).encode()).hexdigest())
                for out, found in zip((common, own, other), shingles_of_both(text, kept, added)):
                    out.append(found)
            own.append(runs(word_hashes(after[1].encode())))
            count = len(rows)
            found = signatures(list(chain(common, own, other)))
            shared, ends, edited = found[:count], found[count : 2 * count + 1], found[2 * count + 1 :]
            ends[:count] = np.minimum(ends[:count], shared)
            edited = np.minimum(edited, shared)
            columns = [pa.array([i for i, _ in rows], kind), pa.array([len(t) for t in texts[:-1]], pa.int64()), pa.array(digests)]
            columns += [pa.array([s.astype(">u4").tobytes().hex() for s in side]) for side in (ends[:count], edited)]
            columns += [pa.array(likeness(ends[:count], side), pa.float64()) for side in (edited, ends[1:])]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Fingerprints of documents and of their edited texts: key, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint`` (hex text of the signatures), ``near_edited``, ``near_next``.

    The set of a text are its runs of five words; a shorter text is one run. The edited text ends with the start of the
    next document by key, after the last one of the first; a single document is its own next. Null text is empty: its
    fingerprint is that of the empty set, which is alike to itself only. Rows go by key, null first, then by a digest of
    the text, then by the text; equal rows are rows each and follow each other. An empty table has no fingerprints;
    other columns are not read.

    Documents are dealt to ``ranges`` (the session's shuffle partitions if not given) and read in order, a bounded number
    at a time; texts are shuffled once.
    """
    kind = docs.schema[key].dataType
    ranges = ranges or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = f"id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return _in_ranges(texts, ranges).mapInArrow(_fingerprinted(to_arrow_type(kind)), schema).withColumnRenamed("id", key)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Row numbers and texts, a bounded number at a time."""
    for batch in batches:
        rows, texts, chars = [], [], 0
        for number, text in zip(batch.column(0), batch.column(1)):
            rows.append(number.as_py())
            texts.append(text.as_py())
            chars += len(texts[-1])
            if len(rows) >= ROWS_AT_ONCE or chars >= CHARS_AT_ONCE:
                yield rows, texts
                rows, texts, chars = [], [], 0
        if rows:
            yield rows, texts


def _signed_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in _pieces(batches):
        sets = [np.unique(runs(word_hashes(text.encode()))) for text in texts]
        columns = [pa.array(rows, pa.int64()), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())]
        columns += [pa.array([len(s) for s in sets], pa.int64())]
        columns += [pa.array([s.astype(">u4").tobytes() for s in signatures(sets)], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["row", "digest", "size", "signature"])


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in _pieces(batches):
        sets = [np.unique(runs(word_hashes(text.encode()))).view(np.int64) for text in texts]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["row", "shingles"])


def _bucketed(choices: np.ndarray):
    """Buckets of a signature: one hash for each choice of its values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(begin, ROWS_AT_ONCE)
                found = np.frombuffer(b"".join(part.column("signature").to_pylist()), ">u4").reshape(-1, PERMUTATIONS)
                total = np.broadcast_to(np.arange(len(choices), dtype=np.uint64) + np.uint64(choices.size), (len(found), len(choices)))
                for i in range(choices.shape[1]):
                    total = mixed(total + found[:, choices[:, i]].astype(np.uint64) * STEPS[i])
                columns = [pa.array(total.ravel().view(np.int64))]
                columns += [pa.array(np.repeat(part.column(c).to_numpy(), len(choices))) for c in ("row", "size")]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "row", "size"])

    return run


def _members(signed: DataFrame, choices: np.ndarray) -> DataFrame:
    return signed.select("row", "size", "signature").mapInArrow(_bucketed(choices), "bucket long, row long, size long")


def _open(members: DataFrame, classes: DataFrame | None) -> DataFrame:
    """Members of buckets that hold more than one class, with ``class`` and the ``count`` of their bucket."""
    if classes is None:
        labelled = members.withColumn("class", F.col("row"))
    else:
        known = classes.select(F.col("node").alias("row"), F.col("component").alias("class"))
        labelled = members.join(known, "row", "left").withColumn("class", F.coalesce("class", "row"))
    buckets = labelled.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("count"))
    return labelled.join(buckets.where("low <> high").select("bucket", "count"), "bucket")


def _verified(pairs: DataFrame, shingles: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sets have the Jaccard similarity asked for, by their shingles."""
    left, right = (shingles.select(F.col("row").alias(c), F.col("shingles").alias(f"of_{c}")) for c in "ab")
    common = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    met = pairs.join(left, "a").join(right, "b")
    return met.where(100 * common >= percent * (F.size("of_a") + F.size("of_b") - common)).select("a", "b")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """Classes of documents that links connect: key and ``class_id``, the smallest key of the class.

    Two documents link where ``100 * common >= percent * all`` holds for their sets of five-word shingles. Equal sets are
    one member. Members meet in the buckets of BANDS bands of their signatures; a pair of similarity 0.8 misses all of
    them once in twenty million cases. In each bucket one member at first, then eight times as many each round, meet all
    those of other classes, until the bucket holds one class or all its members were met; candidates of any likeness are
    verified by their shingles. A bucket that still holds several classes and more than LARGE members after the first
    round is left for the DEEP_BANDS deep bands of its members, which a pair of 0.8 misses five times in 100,000 and
    unlike texts that share a passage almost never meet in. So no pair of a bucket is dropped and none is met twice
    for copies.

    Null and empty texts have no shingles and link to nothing; null keys and equal keys are rows each, a class of null
    keys only has a null class_id. An empty table gives no rows; other columns are not read.
    """
    rows = numbered(docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    texts = rows.select(F.col(ROW).alias("row"), "text")
    sets = stage(texts.mapInArrow(_signed_sets, "row long, digest binary, size long, signature binary"), "sets")
    filled = sets.where("size > 0")
    signed = stage(
        filled.groupBy("digest").agg(F.min("row").alias("row"), F.first("size").alias("size"), F.first("signature").alias("signature")),
        "signed",
    )
    shingles = stage(
        texts.join(signed.select("row"), "row", "left_semi").mapInArrow(_shingled, "row long, shingles array<long>"), "shingles"
    )
    members = stage(_open(_members(signed, BAND_CHOICES), None), "members")
    links = classes = None
    leaders, deep = 1, False
    while not members.isEmpty():
        order = Window.partitionBy("bucket").orderBy(F.xxhash64("bucket", "row"), "row")
        first = members.withColumn("place", F.row_number().over(order)).where(F.col("place") <= leaders)
        first = stage(first.select("bucket", "place", F.col("row").alias("a"), F.col("class").alias("a_class"), F.col("size").alias("a_size")), "first")
        other = members.select("bucket", F.col("row").alias("b"), F.col("class").alias("b_class"), F.col("size").alias("b_size"))
        place = first.select("bucket", F.col("a").alias("b"), F.col("place").alias("b_place"))
        alike = 100 * F.least("a_size", "b_size") >= percent * F.greatest("a_size", "b_size")
        met = first.join(other.join(place, ["bucket", "b"], "left"), "bucket").where(
            (F.col("a_class") != F.col("b_class")) & alike & (F.col("b_place").isNull() | (F.col("b_place") > F.col("place")))
        )
        pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        found = stage(_verified(pairs, shingles, percent), "links")
        links = found if links is None else links.unionByName(found)
        classes = stage(connected_components(links, "a", "b"), "classes")
        rest = members.select("bucket", "row", "size").join(first.select("bucket", F.col("a").alias("row")), ["bucket", "row"], "left_anti")
        open_ = stage(_open(rest, classes), "members")
        if not deep:
            large = open_.where(F.col("count") > LARGE)
            again = signed.join(large.select("row").distinct(), "row", "left_semi")
            open_ = open_.where(F.col("count") <= LARGE).unionByName(_open(_members(again, DEEP_CHOICES), classes))
            open_, deep = stage(open_, "members"), True
        unstage(members, first)
        members, leaders = open_, leaders * 8
    whole = filled.select("row", "digest").join(signed.select("digest", F.col("row").alias("node")), "digest")
    if classes is not None:
        whole = whole.join(classes, "node", "left").withColumn("node", F.coalesce("component", "node"))
    whole = whole.select("row", "node").unionByName(sets.where("size = 0").select("row", F.col("row").alias("node")))
    named = rows.select(F.col(ROW).alias("row"), "id").join(whole, "row")
    least = named.groupBy("node").agg(F.min("id").alias("class_id"))
    return named.join(least, "node").select(F.col("id").alias(key), "class_id")
