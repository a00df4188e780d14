"""Losses of logged logits, position ids and parameter inventories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lmtables.functions.vectors import log_sum_exp
from lmtables.operators.prefix import running_total, top_rows

# The label that is left out of the loss, and the weight of the routing loss.
IGNORE_LABEL = -100
ROUTER_LOSS_COEFFICIENT = 0.001
STEP = 256.0


def shift_labels(rows: DataFrame) -> DataFrame:
    """(seq_id, pos, target): position *i* (from 0) predicts the label at *i + 1*; the last position has no row.

    Only labels move, and on (seq_id, pos), so a long or frequent sequence does not gather in one task.
    """
    return rows.where("pos > 0").select(
        "seq_id", (F.col("pos") - 1).cast("int").alias("pos"), F.col("label").alias("target")
    )


def token_losses(token_logits: DataFrame, ignore: int = IGNORE_LABEL) -> DataFrame:
    """Negative log likelihood per counted position."""
    targets = shift_labels(token_logits).where(F.col("target") != ignore)
    return token_logits.select("seq_id", "pos", "logits").join(targets, ["seq_id", "pos"]).select(
        "seq_id",
        "pos",
        "target",
        (log_sum_exp(F.col("logits")) - F.element_at("logits", F.col("target") + 1).cast("double")).alias("nll"),
    )


def token_losses_by_chunks(chunks: DataFrame, labels: DataFrame, ignore: int = IGNORE_LABEL) -> DataFrame:
    """As :func:`token_losses`, for rows of logits that come in parts.

    ``chunks`` is (seq_id, pos, first, logits): the logits of the vocabulary from id ``first`` on, in parts of any size;
    ``labels`` is (seq_id, pos, label). Each part is cut down to its logarithmic sum next to its target. These are added
    up within steps of STEP, where no term over- or underflows, and the few steps of a position are put together last,
    so that sums combine before they shuffle. A part of minus infinities adds nothing; a position whose target is in
    none of its parts, or of which all logits are minus infinity, has a null loss.
    """
    targets = shift_labels(labels).where(F.col("target") != ignore)
    key = ["seq_id", "pos", "target"]
    place = F.col("target") - F.col("first")
    adds = F.array_max("logits") > float("-inf")
    parts = chunks.join(targets, key[:2]).select(
        *key,
        F.when(adds, log_sum_exp(F.col("logits"))).alias("log"),
        F.when(place >= 0, F.get("logits", place.cast("int"))).cast("double").alias("hit"),
    )
    steps = parts.withColumn("step", F.floor(F.col("log") / STEP)).groupBy(*key, "step").agg(
        F.sum(F.exp(F.col("log") - F.col("step") * STEP)).alias("total"), F.max("hit").alias("hit")
    )
    whole = steps.groupBy(*key).agg(
        F.max("step").alias("top"),
        F.collect_list(F.when(F.col("total").isNotNull(), F.struct("step", "total"))).alias("steps"),
        F.max("hit").alias("hit"),
    )
    scaled = F.aggregate(
        "steps", F.lit(0.0), lambda sum_, s: sum_ + s["total"] * F.exp((s["step"] - F.col("top")).cast("double") * STEP)
    )
    return whole.select(*key, (F.col("top") * STEP + F.log(scaled) - F.col("hit")).alias("nll"))


def cross_entropy(token_logits: DataFrame, ignore: int = IGNORE_LABEL, keys: Sequence[str] = ()) -> DataFrame:
    """Mean loss and its number of targets; NaN where nothing is left to count."""
    return token_losses(token_logits, ignore).groupBy(*keys).agg(
        F.coalesce(F.avg("nll"), F.lit(float("nan"))).alias("loss"), F.count("*").alias("targets")
    )


def perplexity(loss: Column) -> Column:
    """exp(loss); infinity on overflow."""
    return F.exp(loss)


def total_loss(causal: DataFrame, layer_losses: DataFrame, coefficient: float = ROUTER_LOSS_COEFFICIENT) -> DataFrame:
    """Causal loss plus the mean routing loss of the layers times its coefficient."""
    routing = layer_losses.agg(F.avg("load_balance_loss")).scalar()
    return causal.select("loss", routing.alias("aux_loss")).withColumn(
        "total_loss", F.col("loss") + F.lit(coefficient) * F.col("aux_loss")
    )


def position_ids(
    masks: DataFrame, sequence: str, order: str, mask: str, last: int | None = None, order_bits: int = 63
) -> DataFrame:
    """Running count of the mask minus one, 1 where masked; ``last`` keeps the last positions of each sequence only."""
    counted = running_total(masks, [sequence], order, F.col(mask), "mask_count", inclusive=True, order_bits=order_bits)
    placed = counted.withColumn(
        "position_id", F.when(F.col(mask) == 0, F.lit(1)).otherwise(F.col("mask_count") - 1).cast("bigint")
    ).drop("mask_count")
    if last is None:
        return placed
    return top_rows(placed, [sequence], [F.col(order).desc()], last, rank="place_from_end", salt_by=order).drop(
        "place_from_end"
    )


def parameter_inventory(manifest: DataFrame) -> DataFrame:
    """Parameters per component and in total (component NULL); a tied tensor is counted with the one it is tied to."""
    return (
        manifest.where("tied_to IS NULL")
        .rollup("component")
        .agg(F.sum("numel").alias("parameters"), F.count("*").alias("tensors"))
    )
