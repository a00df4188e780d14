"""A Merkle manifest of a dataset: one tree per source, one over the sources, and a witness for every row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lmtables.session import stage

ARITY = 16
LEVELS = 3  # of a block, which one task raises at a time
DIGEST_BYTES = 32


def digest_of(digests: Sequence[bytes]) -> bytes:
    """The digest of digests, which are put together as lower-case hex text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def height(count: int) -> int:
    """Levels until one node is left."""
    levels = 0
    while count > 1:
        count, levels = -(-count // ARITY), levels + 1
    return levels


class Appender:
    """A tree that grows by aligned appends.

    A run of nodes is open until it has ARITY of them. The leaves under an open run hold partial witnesses: those under
    a new node get the digests of the nodes before it, those under the earlier ones get the new digest. A full run is
    one node of the next level, where the same goes on; so a witness is always whole up to the open runs.
    """

    def __init__(self, with_witnesses: bool) -> None:
        self.with_witnesses = with_witnesses
        self.runs: list[list[tuple[bytes, int, int]]] = [[]]  # by level: digest, first leaf, end of leaves
        self.witnesses: list[bytearray] = []
        self.size = 0

    def append(self, digest: bytes) -> None:
        if self.with_witnesses:
            self.witnesses.append(bytearray())
        self.size += 1
        self._add(0, digest, self.size - 1, self.size)

    def _add(self, level: int, digest: bytes, begin: int, end: int) -> None:
        run = self.runs[level]
        if self.with_witnesses and run:
            for witness in self.witnesses[run[0][1] : begin]:
                witness += digest
            before = b"".join(d for d, _, _ in run)
            for witness in self.witnesses[begin:end]:
                witness += before
        run.append((digest, begin, end))
        if len(run) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run = self.runs[level]
        whole, begin, end = digest_of([d for d, _, _ in run]), run[0][1], run[-1][2]
        run.clear()
        if len(self.runs) == level + 1:
            self.runs.append([])
        self._add(level + 1, whole, begin, end)

    def close(self, levels: int) -> bytes:
        """The root, ``levels`` above the leaves; open runs become nodes as they are, even those of one node."""
        for level in range(levels):
            if self.runs[level]:
                self._complete(level)
        return self.runs[levels][0][0]


def fold(leaf: bytes, siblings: bytes, places: Sequence[tuple[int, int]]) -> bytes:
    """The root that a leaf and its siblings give; ``places`` has place and number of nodes in each tree upwards."""
    taken = 0
    for place, count in places:
        while count > 1:
            left = place % ARITY
            others = min(ARITY, count - place + left) - 1
            run = siblings[taken : taken + others * DIGEST_BYTES]
            taken += len(run)
            cut = left * DIGEST_BYTES
            leaf = digest_of([run[:cut], leaf, run[cut:]])
            place, count = place // ARITY, -(-count // ARITY)
    return leaf


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Digest of a row: of each column ``-`` if null, else its size in UTF-8 bytes, a colon and itself as text."""
    texts = [c.cast("string") for c in columns]
    told = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*told), 256))


def _placed(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``place`` in the tree, by ``order``, and ``n``, the nodes of the tree.

    Nodes are sorted in ranges of all keys, so that a tree with most of the rows is spread; equal rows are told apart by
    a number. Places are those in a range, plus the counts of the ranges before.
    """
    ranged = nodes.withColumn("salt", F.monotonically_increasing_id())
    keys = ["tree", *order, "salt"]
    parts = stage(ranged.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "ranges")
    counts = parts.groupBy("tree", "part").agg(F.count("*").alias("rows"))
    earlier = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "tree", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"), F.sum("rows").over(W.partitionBy("tree")).alias("n")
    )
    inside = F.row_number().over(W.partitionBy("part", "tree").orderBy(*order, "salt"))
    placed = parts.withColumn("inside", inside).join(offsets, ["tree", "part"])
    return placed.withColumn("place", F.col("offset") + F.col("inside") - 1).drop("salt", "part", "inside", "offset")


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("place") / ARITY**levels))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """Stretches of rows of one block."""
    keys, begin = list(zip(batch.column("tree").to_pylist(), batch.column("block").to_pylist())), 0
    for end in range(1, len(keys) + 1):
        if end == len(keys) or keys[end] != keys[begin]:
            yield keys[begin], begin, end
            begin = end


def _raised(levels: int):
    """Root of each block; the next layer has them as its nodes."""

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found) if found else [[]] * 4
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["tree", "place", "n", "digest"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, appender, count = None, None, 0

        def done() -> list[tuple]:
            return [(now[0], now[1], -(-count // ARITY**levels), appender.close(min(levels, height(count))))] if now else []

        for batch in batches:
            digests, counts, found = batch.column("digest").to_pylist(), batch.column("n").to_pylist(), []
            for key, begin, end in _runs(batch):
                if key != now:
                    found += done()
                    now, appender, count = key, Appender(False), counts[begin]
                for digest in digests[begin:end]:
                    appender.append(digest)
            yield rows(found)
        yield rows(done())

    return run


LAYER = "tree string, place long, n long, digest binary"


def _layers(nodes: DataFrame, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Layers of nodes, each with the block roots of the one below, and the trees' roots: ``tree``, ``digest`` and the
    ``layer`` that has a tree in one block.

    Block roots are appended like leaves, so a layer has ARITY**levels times fewer rows than the one below.
    """
    layers, tops = [nodes], None
    while True:
        narrow = _blocks(layers[-1].select("tree", "place", "n", "digest"), levels)
        sorted_ = narrow.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
        roots = stage(sorted_.mapInArrow(_raised(levels), LAYER), "roots")
        whole = roots.where("n = 1").select("tree", "digest", F.lit(len(layers) - 1).alias("layer"))
        tops = whole if tops is None else tops.unionByName(whole)
        rest = roots.where("n > 1")
        if rest.isEmpty():
            return layers, tops
        layers.append(rest)


UPPER = ("siblings", "subroot", "source_place")


def _witnessed(schema: pa.Schema, levels: int):
    """Rows with the siblings of their block and those from its root upwards; these come first in a block's rows."""
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, appender, held, upper = None, None, [], {}

        def done() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            rows = pa.Table.from_batches(held).combine_chunks()
            appender.close(min(levels, height(rows.column("n")[0].as_py())))
            found = [bytes(w) + upper["siblings"] for w in appender.witnesses]
            added = {"siblings": pa.array(found, pa.binary())}
            added |= {c: pa.array([upper[c]] * len(found), schema.field(c).type) for c in UPPER[1:]}
            columns = [added[c] if c in added else rows.column(c) for c in names]
            yield from pa.Table.from_arrays(columns, schema=schema).to_batches()

        for batch in batches:
            places = batch.column("place").to_pylist()
            for key, begin, end in _runs(batch):
                if key != now:
                    yield from done()
                    now, appender, held = key, Appender(True), []
                if places[begin] < 0:
                    upper = {c: batch.column(c)[begin].as_py() for c in UPPER}
                    begin += 1
                part = batch.slice(begin, end - begin)
                for digest in part.column("digest").to_pylist():
                    appender.append(digest)
                if len(part):
                    held.append(part)
        yield from done()

    return run


def _with_witnesses(layer: DataFrame, upper: DataFrame, levels: int) -> DataFrame:
    """``layer`` with ``siblings`` of each node up to the root, given those of its block roots (``tree``, ``place``)."""
    kinds = {"siblings": "binary", "subroot": "binary", "source_place": "long"}
    first = upper.select("tree", F.col("place").alias("block"), F.lit(-1).cast("long").alias("place"), *UPPER)
    rows = _blocks(layer.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items()}), levels)
    both = rows.unionByName(first, allowMissingColumns=True)
    sorted_ = both.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")
    out = rows.drop("block").schema
    return sorted_.mapInArrow(_witnessed(to_arrow_schema(out), levels), out)


def _descended(layers: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """Witnesses of the lowest layer. ``tops`` says for each tree what its root hands down, and to which layer: ``tree``,
    ``layer`` and UPPER."""
    above = tops.select("tree", "layer", F.lit(0).cast("long").alias("place"), *UPPER)
    found = None
    for number in reversed(range(len(layers))):
        upper = above.where(F.col("layer") == number).drop("layer")
        if found is not None:
            upper = upper.unionByName(stage(found.select("tree", "place", *UPPER), "witnesses"))
        found = _with_witnesses(layers[number], upper, levels)
    return found


@dataclass(frozen=True)
class Manifest:
    """witnesses: what was given, with place, n, subroot, source_place, siblings. ``root`` and the number of ``sources``.

    ``siblings`` has the digests of a row's siblings, level by level up to the root and from left to right.
    """

    witnesses: DataFrame
    root: bytes | None
    sources: int


def manifest(leaves: DataFrame, *, levels: int = LEVELS) -> Manifest:
    """The trees over ``leaves``: ``source``, ``id``, ``digest`` and any columns that go along.

    Per source, null first, leaves go by id, null first, then by digest; equal rows are leaves each. While several nodes
    are left, every ARITY of them become one, the last ones as they are. The roots of the sources, in bytewise order
    of their names, are the leaves of one more tree. No rows: no root and no witness. Columns that go along must not be
    called tree, place, n, block, salt, part, subroot, source_place or siblings.

    Blocks of ARITY**levels leaves are raised by one task each and their roots are appended to the next layer like leaves, so a
    source with most of the rows takes as many tasks as it has blocks. Witnesses grow by the same appends; what a block
    root gets further up is handed down to the leaves of its block, which are read once more for it.
    """
    spark = leaves.sparkSession
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    nodes = stage(_placed(leaves.withColumn("tree", tree), ["id", "digest"]), "leaves")
    layers, subroots = _layers(nodes, levels)
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest", "layer")
    sources = stage(_placed(named, ["name"]), "sources")
    upper, top = _layers(sources.drop("layer"), levels)
    root = top.first()
    kinds = "tree string, layer int, siblings binary, subroot binary, source_place long"
    handed = spark.createDataFrame([("", len(upper) - 1, bytearray(), None, None)], kinds)
    known = _descended([sources, *upper[1:]], handed, levels)
    tops = stage(
        known.select(
            F.col("name").alias("tree"), "layer", "siblings", F.col("digest").alias("subroot"), F.col("place").alias("source_place")
        ),
        "subroots",
    )
    found = _descended(layers, tops, levels).drop("tree")
    return Manifest(found, bytes(root.digest) if root else None, sources.count() if root else 0)


def folded(witnesses: DataFrame, leaf: str, sources: int, *, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns with ``folded_root``, from the digest in ``leaf`` and the row's siblings, and ``proof_sha256``,
    the digest of the siblings, both as hex text."""
    names = ["place", "n", "source_place", "siblings", leaf]
    rows = witnesses.select(*keep, *(F.col(c).alias(f"_{i}") for i, c in enumerate(names)))
    out = witnesses.select(*keep).withColumns({c: F.lit("") for c in ("folded_root", "proof_sha256")}).schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots, proofs = [], []
            for place, count, source, siblings, digest in zip(*(batch.column(f"_{i}").to_pylist() for i in range(5))):
                roots.append(fold(digest, siblings, [(place, count), (source, sources)]).hex())
                proofs.append(digest_of([siblings]).hex())
            columns = [batch.column(c) for c in keep] + [pa.array(roots), pa.array(proofs)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return rows.mapInArrow(run, out)
