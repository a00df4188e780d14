"""Routing, loss and inventory queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.operators import evaluation, routing
from lmtables.plans.registry import query
from lmtables.plans.tables import Inputs, with_tables

EXPERTS = 8
TOP_K = 2

ROUTED = {
    "flat": "SELECT layer, token_id, CAST(unnest(logits) AS DOUBLE) AS x, CAST(unnest(range(len(logits))) AS INT) AS expert "
    "FROM router_logits",
    "probs": "SELECT layer, token_id, expert, CAST(CAST(exp(x - top) / sum(exp(x - top)) OVER w AS FLOAT) AS DOUBLE) AS prob FROM "
    "(SELECT *, max(x) OVER (PARTITION BY token_id) AS top FROM flat) AS f WINDOW w AS (PARTITION BY token_id)",
    "slots": "SELECT *, row_number() OVER (PARTITION BY token_id ORDER BY prob DESC, expert) - 1 AS slot FROM probs "
    f"QUALIFY slot < {TOP_K}",
    "loads": "SELECT p.layer, p.expert, p.tokens, p.mean_prob, g.slot, COALESCE(s.n, 0) / p.tokens AS share FROM (SELECT "
    "layer, expert, count(*) AS tokens, avg(prob) AS mean_prob FROM probs GROUP BY layer, expert) AS p CROSS JOIN "
    f"(SELECT unnest(range({TOP_K})) AS slot) AS g LEFT JOIN (SELECT layer, expert, slot, count(*) AS n FROM slots "
    "GROUP BY layer, expert, slot) AS s ON s.layer = p.layer AND s.expert = p.expert AND s.slot = g.slot",
    "layer_losses": f"SELECT layer, {EXPERTS} * sum(share * mean_prob) AS loss FROM loads GROUP BY layer",
}


@query(
    "topk_experts",
    with_tables(
        ["router_logits"],
        "SELECT token_id, CAST(slot AS INT) AS slot, expert, round(CAST(CAST(prob / sum(prob) OVER (PARTITION BY token_id) AS FLOAT) AS DOUBLE), 6) AS weight "
        "FROM slots",
        ROUTED,
    ),
)
def _topk(inputs: Inputs) -> DataFrame:
    routed = routing.topk_experts(inputs("router_logits"), TOP_K)
    return routed.select("token_id", F.posexplode("slots").alias("slot", "choice")).select(
        "token_id", "slot", "choice.expert", F.round(F.col("choice.weight").cast("double"), 6).alias("weight")
    )


@query(
    "dispatch_table",
    with_tables(
        ["router_logits"],
        "SELECT layer, expert, token_id, CAST(slot AS INT) AS slot, round(prob, 6) AS weight FROM slots",
        ROUTED,
    ),
)
def _dispatch(inputs: Inputs) -> DataFrame:
    return routing.dispatch_table(inputs("router_logits"), TOP_K, renormalize=False).withColumn(
        "weight", F.round(F.col("weight").cast("double"), 6)
    )


@query(
    "expert_load",
    with_tables(
        ["router_logits"],
        "SELECT layer, CAST(slot AS INT) AS slot, expert, round(share, 6) AS share, round(mean_prob, 6) AS mean_prob FROM loads",
        ROUTED,
    ),
)
def _load(inputs: Inputs) -> DataFrame:
    shares = routing.load_shares(routing.expert_load(inputs("router_logits"), TOP_K))
    return shares.withColumn("share", F.round("share", 6)).withColumn("mean_prob", F.round("mean_prob", 6))


@query(
    "load_balance_loss",
    with_tables(["router_logits"], "SELECT layer, round(loss, 6) AS load_balance_loss FROM layer_losses", ROUTED),
)
def _balance(inputs: Inputs) -> DataFrame:
    losses = routing.load_balance_loss(routing.expert_load(inputs("router_logits"), TOP_K), EXPERTS)
    return losses.withColumn("load_balance_loss", F.round("load_balance_loss", 6))


LOSSES = {
    "nlls": "SELECT l.seq_id, l.pos, t.label AS target, (SELECT max(CAST(x AS DOUBLE)) + ln(sum(exp(CAST(x AS DOUBLE)))) - "
    "max(CAST(x AS DOUBLE)) FROM (SELECT unnest(l.logits) AS x) AS u) - CAST(l.logits[t.label + 1] AS DOUBLE) AS nll "
    "FROM token_logits AS l JOIN token_logits AS t ON t.seq_id = l.seq_id AND t.pos = l.pos + 1 WHERE t.label <> -100",
}


@query(
    "shift_labels",
    with_tables(
        ["token_logits"],
        "SELECT seq_id, pos, target FROM (SELECT seq_id, pos, lead(label) OVER (PARTITION BY seq_id ORDER BY pos) AS target "
        "FROM token_logits) AS s WHERE target IS NOT NULL",
    ),
)
def _shift(inputs: Inputs) -> DataFrame:
    return evaluation.shift_labels(inputs("token_logits"))


CHUNK = 4


def in_chunks(token_logits: DataFrame) -> DataFrame:
    """Rows of logits in parts, as they are logged for a vocabulary that is too long for one row."""
    firsts = F.sequence(F.lit(0), F.size("logits") - 1, F.lit(CHUNK))
    return token_logits.select("seq_id", "pos", "logits", F.explode(firsts).alias("first")).withColumn(
        "logits", F.slice("logits", F.col("first") + 1, F.lit(CHUNK))
    )


@query(
    "cross_entropy",
    with_tables(
        ["token_logits"],
        "SELECT seq_id % 4 AS part, round(avg(nll), 6) AS loss, count(*) AS targets FROM nlls GROUP BY seq_id % 4",
        LOSSES,
    ),
)
def _entropy(inputs: Inputs) -> DataFrame:
    logits = inputs("token_logits")
    losses = evaluation.token_losses_by_chunks(in_chunks(logits), logits).withColumn("part", F.col("seq_id") % 4)
    return losses.groupBy("part").agg(F.round(F.avg("nll"), 6).alias("loss"), F.count("*").alias("targets"))


@query(
    "perplexity",
    with_tables(
        ["token_logits"],
        "SELECT round(avg(nll), 6) AS loss, round(exp(avg(nll)), 6) AS perplexity, count(*) AS targets FROM nlls",
        LOSSES,
    ),
)
def _perplexity(inputs: Inputs) -> DataFrame:
    total = evaluation.cross_entropy(inputs("token_logits"))
    return total.select(
        F.round("loss", 6).alias("loss"),
        F.round(evaluation.perplexity(F.col("loss")), 6).alias("perplexity"),
        "targets",
    )


@query(
    "total_loss",
    with_tables(
        ["token_logits", "router_logits"],
        "SELECT round(c, 6) AS loss, round(a, 6) AS aux_loss, round(c + 0.001 * a, 6) AS total_loss FROM "
        "(SELECT (SELECT avg(nll) FROM nlls) AS c, (SELECT avg(loss) FROM layer_losses) AS a) AS t",
        ROUTED | LOSSES,
    ),
)
def _total(inputs: Inputs) -> DataFrame:
    losses = routing.load_balance_loss(routing.expert_load(inputs("router_logits"), TOP_K), EXPERTS)
    total = evaluation.total_loss(evaluation.cross_entropy(inputs("token_logits")), losses)
    return total.select(
        F.round("loss", 6).alias("loss"), F.round("aux_loss", 6).alias("aux_loss"), F.round("total_loss", 6).alias("total_loss")
    )


@query(
    "position_ids",
    with_tables(
        ["masks"],
        "SELECT conv_id, turn, mask, CAST(CASE WHEN mask = 0 THEN 1 ELSE sum(mask) OVER (PARTITION BY conv_id ORDER BY turn) "
        "- 1 END AS BIGINT) AS position_id FROM masks",
    ),
)
def _positions(inputs: Inputs) -> DataFrame:
    return evaluation.position_ids(inputs("masks"), "conv_id", "turn", "mask").select(
        "conv_id", "turn", "mask", "position_id"
    )


@query(
    "last_position_ids",
    with_tables(
        ["masks"],
        "SELECT conv_id, turn, position_id FROM (SELECT conv_id, turn, CAST(CASE WHEN mask = 0 THEN 1 ELSE sum(mask) OVER "
        "(PARTITION BY conv_id ORDER BY turn) - 1 END AS BIGINT) AS position_id, row_number() OVER (PARTITION BY conv_id "
        "ORDER BY turn DESC) AS back FROM masks) AS m WHERE back <= 2",
    ),
)
def _last_positions(inputs: Inputs) -> DataFrame:
    return evaluation.position_ids(inputs("masks"), "conv_id", "turn", "mask", last=2).select(
        "conv_id", "turn", "position_id"
    )


COMPONENT = (
    "CASE label % 4 WHEN 0 THEN 'embedding' WHEN 1 THEN 'attention' WHEN 2 THEN 'moe' ELSE 'norm' END"
)
TIED = "CASE WHEN label = 8 THEN 'block.0.weight' END"


@query(
    "parameter_inventory",
    f"SELECT component, CAST(sum(numel) AS BIGINT) AS parameters, count(*) AS tensors FROM (SELECT label, {COMPONENT} "
    f"AS component, {TIED} AS tied_to, count(*) * 64 AS numel FROM embeddings GROUP BY label) AS m WHERE tied_to IS NULL "
    "GROUP BY ROLLUP (component)",
)
def _inventory(inputs: Inputs) -> DataFrame:
    manifest = (
        inputs.given("embeddings")
        .groupBy("label")
        .agg((F.count("*") * 64).alias("numel"))
        .selectExpr("label", "numel", f"{COMPONENT} AS component", f"{TIED} AS tied_to")
    )
    return evaluation.parameter_inventory(manifest)
