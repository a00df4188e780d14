"""One outer step for all locked rounds at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lmtables.operators import tensors
from lmtables.operators.rounds import merged_revision, rebuild_pending
from lmtables.operators.submissions import ROUND
from lmtables.session import stage

PAYLOAD = ("repo_id", "pr_num", "revision")  # the submission as the host knows it; update ids are the submitter's choice
MODEL = ("repo_id", "base_model_revision")
POLICY = ("outer_lr", "outer_momentum", "nesterov")


def tensor_manifest(rows: DataFrame, *keys: str) -> DataFrame:
    """One row per tensor, from its chunks."""
    return rows.groupBy(*keys, "name").agg(F.first("shape").alias("shape"))


def verify_updates(updates: DataFrame, deltas: DataFrame, base: DataFrame, *, strict: bool) -> DataFrame:
    """Verification of the payload of submissions (repo_id, pr_num, revision, base_model_revision), one row for each.

    All other payload is left unread. Submissions and models of other repositories with the same names stay apart.
    """
    wanted = updates.select(*PAYLOAD, "base_model_revision").distinct()
    payload = deltas.join(wanted.select(*PAYLOAD), list(PAYLOAD), "left_semi")
    models = base.withColumnRenamed("revision", "base_model_revision").join(wanted.select(*MODEL).distinct(), list(MODEL), "left_semi")
    return tensors.verify_deltas(
        tensors.tensor_stats(payload, PAYLOAD), tensor_manifest(models, *MODEL), wanted, owner=PAYLOAD, model=MODEL, strict=strict
    )


def merge_round(
    merging: DataFrame,
    base: DataFrame,
    deltas: DataFrame,
    norms: DataFrame,
    momentum: DataFrame | None,
    *,
    weighting: str = "tokens",
    max_delta_norm: float = 0.0,
    momentum_dtype: str = "float32",
) -> DataFrame:
    """New values and momentum per chunk of every locked repository, with the revision they belong to.

    ``merging`` are locked states; ``norms`` is (repo_id, pr_num, revision, verified_norm). The outer settings travel with
    the factor of each update, so no chunk is joined with a table of policies.
    """
    pending = rebuild_pending(merging).join(norms.select(*PAYLOAD, "verified_norm"), list(PAYLOAD))
    revision = merged_revision(F.col("repo_id"), F.col("round"), F.col("pending_merge.update_id"))
    settings = merging.select(
        *ROUND, revision.alias("model_revision"), *[F.col(f"policy.{name}").alias(name) for name in POLICY]
    )
    keys = [*ROUND, "model_revision", *POLICY]
    scales = tensors.update_scales(
        pending.join(settings, list(ROUND)),
        weighting=weighting,
        max_delta_norm=max_delta_norm,
        keys=keys,
        owner=PAYLOAD,
    )
    averages = tensors.merge_average(deltas, stage(scales, "scales"), keys=keys, owner=PAYLOAD)
    models = base.join(
        merging.select("repo_id", F.col("base_model_revision").alias("revision")), ["repo_id", "revision"], "left_semi"
    )
    return tensors.outer_step(
        models,
        averages,
        momentum,
        outer_lr=F.col("outer_lr"),
        outer_momentum=F.col("outer_momentum"),
        nesterov=F.col("nesterov"),
        momentum_dtype=momentum_dtype,
        keys=["repo_id"],
    )
