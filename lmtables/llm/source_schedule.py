"""Mixes sources to target weights by a low-discrepancy schedule over shuffled blocks of equal size."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lmtables.llm.totals import before
from lmtables.session import stage

# The fractional part of the golden ratio as a whole number of 2**-PHASE_BITS; a slot number has at most 40 bits.
PHASE_BITS, HALF = 42, 20
GOLDEN = int(2**PHASE_BITS * (5**0.5 - 1) / 2) | 1
# Points are looked up in this many equal cells of the unit interval.
CELL_BITS = 12
# Documents are ordered inside 16**3 hash buckets, slots inside runs of 4096.
HASH_DIGITS, RUN_BITS = 3, 12


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null text has none."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(plain == "", F.lit(0)).otherwise(F.length(plain) - F.length(F.replace(plain, F.lit(" "))) + 1).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Targets per source: ``source``, ``place`` (its number in order), ``source_size``, ``target``.

    Sources in order (null last) get ``weights`` in turn and share ``share`` times all sizes. A target stops at
    ``most`` times its source's size and what is over goes to the others by weight, until none is above: target =
    min(most × size, level × weight) for one common level. Sources sorted by most × size / weight fill up in that
    order, so the level is found from running sums. One row per source is in a window here, no documents.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.array(*(F.lit(float(w)) for w in weights))
    ranked = total.withColumn("place", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.select(
        "source",
        "place",
        "source_size",
        F.get(weight, F.col("place") % len(weights)).alias("weight"),
        (F.col("source_size") * most).alias("full"),
    )
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    earlier = W.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("full").over(earlier), F.lit(0.0))
    level = left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
    stepped = ranked.withColumn("level", level)
    # The level is that of the first source which stays below its own bound; without one, all of them are full.
    open_ = F.min_by("level", F.when(F.col("level") * F.col("weight") <= F.col("full"), F.col("full") / F.col("weight")))
    target = F.least(F.coalesce(F.col("water") * F.col("weight"), F.col("full")), F.col("full"))
    return stepped.withColumn("water", open_.over(everything)).select(
        "source", "place", "source_size", target.alias("target")
    )


def golden_point(slot: Column) -> Column:
    """slot × golden ratio modulo 1 in units of 2**-PHASE_BITS, in whole numbers that stay below 2**63."""
    whole = 1 << PHASE_BITS
    high = F.shiftright(slot, HALF) * F.lit((GOLDEN << HALF) % whole) % whole
    low = slot % (1 << HALF) * F.lit(GOLDEN) % whole
    return (high + low) % whole


def schedule(spark: SparkSession, sources: DataFrame, most: float) -> DataFrame:
    """The slots of the mix in order: ``slot``, ``place`` (of the source), ``block``, ``epoch``.

    ``sources`` has place, blocks and wanted (slots, fractional). Slot i stands at the fractional part of i × golden
    ratio; the cumulative shares of the sources map the point to a source. Its rank among the source's slots gives the
    block; after the last block comes the next epoch. Slots beyond ``most`` epochs stay empty.
    """
    whole, cell = 1 << PHASE_BITS, PHASE_BITS - CELL_BITS
    running = W.orderBy("place").rowsBetween(W.unboundedPreceding, W.currentRow)
    everything = W.orderBy("place").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    edge = F.round(F.sum("wanted").over(running) / F.sum("wanted").over(everything) * whole).cast("long")
    bounds = sources.where("wanted > 0").select("place", "blocks", edge.alias("to"))
    start = F.coalesce(F.lag("to").over(W.orderBy("place")), F.lit(0))
    bounds = bounds.withColumn("from", start).where("to > from")
    cells = F.sequence(F.shiftright("from", cell), F.shiftright(F.col("to") - 1, cell))
    slots = sources.agg(F.round(F.sum("wanted")).cast("long")).first()[0] or 0
    points = spark.range(slots).select(F.col("id").alias("slot"), golden_point(F.col("id")).alias("point"))
    placed = (
        points.withColumn("cell", F.shiftright("point", cell))
        .join(bounds.withColumn("cell", F.explode(cells)), "cell")
        .where("point >= from AND point < to")
        .select("slot", "place", "blocks", F.shiftright("slot", RUN_BITS).alias("run"), F.lit(1).alias("one"))
    )
    ranked = before(placed, "place", "run", ["slot"], "one").where(F.col("before") < F.floor(F.col("blocks") * F.lit(most)))
    epoch = F.floor(F.col("before") / F.col("blocks")).cast("long")
    return ranked.select("slot", "place", (F.col("before") % F.col("blocks")).alias("block"), epoch.alias("epoch"))


@dataclass(frozen=True)
class Mix:
    """documents: id, row, size, source_size, target, place. slots: slot, place, block, epoch. pieces: row, place,
    block, words (of one document in one block)."""

    documents: DataFrame
    slots: DataFrame
    pieces: DataFrame

    def taken(self) -> DataFrame:
        """Documents with ``taken``, the words that all slots together take of each."""
        uses = self.slots.groupBy("place", "block").agg(F.count("*").alias("uses"))
        words = self.pieces.join(uses, ["place", "block"]).groupBy("row").agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
        whole = self.documents.join(words, "row", "left")
        return whole.withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mix(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = 1024,
    least_blocks: int = 1024,
    seed: str = "mix",
    row: str | None = None,
) -> Mix:
    """Plans a mix of ``share`` times all words with the sources near their targets (see ``source_targets``).

    Every source is put in hash order and cut into blocks of ``block_words``; a source that would have fewer than
    ``least_blocks`` gets smaller ones. ``schedule`` gives each slot a block. Running totals are taken inside hash
    buckets and over bucket totals, never over a source. Documents without words lie in no block. Null sources are one
    source; repeated rows are rows of their own; other columns are not read. The order depends on keys and texts only,
    so reruns agree. ``row`` names a column that numbers the rows, where the caller wants to join the result to them.
    """
    mark = F.md5(F.concat_ws("|", F.lit(seed), F.col(key).cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    held = stage(
        docs.select(
            F.col(key).alias("id"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            mark.alias("mark"),
            (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
        ),
        "sizes",
    )
    targets = source_targets(held, weights, share, most)
    block_size = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.col("source_size") / least_blocks))).cast("long")
    sources = stage(
        targets.withColumn("block_size", block_size)
        .withColumn("blocks", F.ceil(F.col("source_size") / F.col("block_size")).cast("long"))
        .withColumn("wanted", F.col("target") / F.col("block_size")),
        "sources",
    )
    joined = held.join(sources, held["source"].eqNullSafe(sources["source"])).select(
        "id", "row", "size", "mark", "place", "source_size", "target", "block_size"
    )
    filled = joined.where("size > 0").withColumn("bucket", F.substring("mark", 1, HASH_DIGITS))
    begun = before(filled, "place", "bucket", ["mark", "row"], "size").withColumn("end", F.col("before") + F.col("size"))
    first, last = F.floor(F.col("before") / F.col("block_size")), F.floor((F.col("end") - 1) / F.col("block_size"))
    pieces = begun.withColumn("block", F.explode(F.sequence(first, last))).select(
        "row",
        "place",
        "block",
        (
            F.least(F.col("end"), (F.col("block") + 1) * F.col("block_size"))
            - F.greatest(F.col("before"), F.col("block") * F.col("block_size"))
        ).alias("words"),
    )
    documents = joined.select("id", "row", "size", "source_size", "target", "place")
    return Mix(documents, schedule(docs.sparkSession, sources, most), pieces)
