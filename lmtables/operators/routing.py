"""Expert routing of logged router logits: rows (layer, token_id, logits)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.functions.vectors import softmax


def topk_experts(router_logits: DataFrame, k: int, renormalize: bool = True) -> DataFrame:
    """Adds ``probs`` and ``slots``, the k best experts as (expert, weight) in order; ties go to the lower index.

    One pass per row: no explode and no shuffle.
    """
    ranked = F.array_sort(
        F.transform("probs", lambda p, i: F.struct((-p).alias("minus_prob"), i.alias("expert")))
    )
    best = F.transform(F.slice(ranked, 1, k), lambda s: F.struct(s["expert"], (-s["minus_prob"]).alias("weight")))
    routed = router_logits.withColumn("probs", softmax(F.col("logits"))).withColumn("slots", best)
    if not renormalize:
        return routed
    total = F.aggregate("slots", F.lit(0.0), lambda acc, s: acc + s["weight"].cast("double"))
    return routed.withColumn("slot_total", total).withColumn(
        "slots",
        F.transform(
            "slots",
            lambda s: F.struct(s["expert"], (s["weight"].cast("double") / F.col("slot_total")).cast("float").alias("weight")),
        ),
    ).drop("slot_total")


def dispatch_table(router_logits: DataFrame, k: int, renormalize: bool = True) -> DataFrame:
    """One row per (token, slot) with its expert and weight; an expert without rows has nothing to do."""
    return topk_experts(router_logits, k, renormalize).select(
        "layer", "token_id", F.posexplode("slots").alias("slot", "choice")
    ).select("layer", F.col("choice.expert").alias("expert"), "token_id", "slot", F.col("choice.weight").alias("weight"))


def expert_load(router_logits: DataFrame, k: int) -> DataFrame:
    """Per layer and expert: tokens, mean probability, and the number of tokens whose slot chose the expert.

    All of it in one aggregation that is combined before the shuffle. ``slot_counts`` is an array over slots.
    """
    routed = topk_experts(router_logits, k, renormalize=False)
    per_expert = routed.select(
        "layer",
        F.transform("slots", lambda s: s["expert"]).alias("chosen"),
        F.posexplode("probs").alias("expert", "prob"),
    ).withColumn("slot", F.array_position("chosen", F.col("expert")))
    counts = [F.count_if(F.col("slot") == place).alias(f"slot_{place}") for place in range(1, k + 1)]
    return (
        per_expert.groupBy("layer", "expert")
        .agg(F.count("*").alias("tokens"), F.avg(F.col("prob").cast("double")).alias("mean_prob"), *counts)
        .select(
            "layer", "expert", "tokens", "mean_prob", F.array(*[f"slot_{p}" for p in range(1, k + 1)]).alias("slot_counts")
        )
    )


def load_shares(load: DataFrame) -> DataFrame:
    """Rows (layer, slot, expert, share, mean_prob) of a load table."""
    return load.select(
        "layer", "expert", "tokens", "mean_prob", F.posexplode("slot_counts").alias("slot", "chosen")
    ).select("layer", "slot", "expert", (F.col("chosen") / F.col("tokens")).alias("share"), "mean_prob")


def load_balance_loss(load: DataFrame, num_experts: int) -> DataFrame:
    """Per layer: experts * sum over slots and experts of share * mean probability (k for a balanced router)."""
    return load_shares(load).groupBy("layer").agg(
        (F.sum(F.col("share") * F.col("mean_prob")) * num_experts).alias("load_balance_loss")
    )
