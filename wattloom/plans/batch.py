"""Reports over all users of a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.metrics import CLASSIFICATION, REGRESSION

STAGES = ("train", "val", "test", "inference")
METRICS = (*CLASSIFICATION, *REGRESSION)
COUNTS = ("TN", "FP", "FN", "TP", "n_samples")


def stage_table(users: DataFrame, metrics: DataFrame, skips: DataFrame, preferred: Sequence[str] = ("main_final", "main")) -> DataFrame:
    """Four rows per user: the preferred model's metrics of each stage, or a status saying why not.

    `metrics` is long (user_id, split, model, metric, value); a skipped user keeps empty rows.
    """
    stages = F.explode(F.array(*[F.lit(s) for s in STAGES])).alias("stage")
    grid = users.select("user_id", stages)
    rank = F.coalesce(*[F.when(F.col("model") == m, F.lit(i)) for i, m in enumerate(preferred)], F.lit(len(preferred)))
    wide = (
        metrics.where(F.col("metric").isin(*METRICS))
        .groupBy("user_id", "split", "model")
        .pivot("metric", list(METRICS))
        .agg(F.first("value", True))
    )
    best = wide.groupBy("user_id", F.col("split").alias("stage")).agg(
        F.min_by(F.struct("model", *METRICS), F.struct(rank, F.col("model"))).alias("_best")
    )
    joined = grid.join(best, ["user_id", "stage"], "left").join(skips.select("user_id", "skip_reason"), "user_id", "left")
    missing = F.when(F.col("stage") == "inference", "no_inference").otherwise(F.concat(F.lit("no_"), F.col("stage"), F.lit("_metrics")))
    skipped = F.col("skip_reason").isNotNull()
    status = (
        F.when(skipped, F.concat(F.lit("soft_skip:"), F.col("skip_reason")))
        .when(F.col("_best").isNull(), missing)
        .otherwise(F.concat(F.lit("ok:"), F.col("_best.model")))
    )
    values = [
        F.when(~skipped, F.col(f"_best.{m}")).cast("bigint" if m in COUNTS else "double").alias(m) for m in METRICS
    ]
    return joined.select("user_id", "stage", status.alias("status"), *values)


def user_status(gates: DataFrame, durations: DataFrame) -> DataFrame:
    """Status rows (ok / soft_skip / fail) from the gates and the run times."""
    joined = durations.join(gates.select("user_id", "skip_reason"), "user_id", "left")
    status = F.when(F.col("skip_reason").isNotNull(), "soft_skip").when(F.col("success"), "ok").otherwise("fail")
    return joined.withColumn("status", status)
