"""The whole inference of a fitted model: scores, start guard, correction, baselines and the switch to a fallback."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.drift import blend
from wattloom.operators.guard import LOOKAHEAD_S, MAX_ON_HOURS, guard_mask, startups, suppress
from wattloom.operators.series import Series
from wattloom.plans.training import Settings, TwoStageModel, baselines, corrected, score_base, season_mapped
from wattloom.session import cut_lineage

GUARDED = ("state_pred", "p_on", "y_raw", "y_low", "y_high")
BASELINES = ("y_fallback", "y_rf", "y_naive_mean")
# Every track of the plan and its column.
TRACKS = {
    "main_raw": "y_raw", "main": "y_calib", "main_final": "y_final", "fallback": "y_fallback", "rf": "y_rf",
    "naive_zero": "y_naive_zero", "naive_mean": "y_naive_mean",
}


@dataclass(frozen=True)
class Guard:
    """Readings with their spike column, and `guard_w` per key (see `operators.guard`)."""

    bus: DataFrame
    thresholds: DataFrame
    bus_ts: str
    spike: str
    minutes: int = 15
    max_on_h: float = MAX_ON_HOURS
    lookahead_s: int = LOOKAHEAD_S


def infer(
    rows: DataFrame, model: TwoStageModel, series: Series, settings: Settings = Settings(), guard: Guard | None = None,
    decisions: DataFrame | None = None, calibrate: bool = True,
) -> DataFrame:
    """Scores with `suppressed`, the guarded and corrected main track, guarded baselines and `y_final`.

    The guard zeroes steps without a recent start before the correction sees them, and the same steps of every baseline.
    `decisions` (see `drift.switch_decision`) blend the corrected track with the pooled model by `main_weight`; keys without
    a decision keep the main track. Without a guard nothing is suppressed.
    """
    keys = list(series.key)
    scored = score_base(rows, model, series, settings)
    if guard is None:
        scored = scored.withColumn("suppressed", F.lit(False))
    else:
        # The guard reads the scores several times; each time would run all trees again.
        scored = cut_lineage(scored)
        starts = startups(guard.bus, scored, guard.thresholds, keys, guard.bus_ts, guard.spike, series.ts, minutes=guard.minutes)
        masked = guard_mask(scored, starts, series, guard.max_on_h, guard.lookahead_s)
        scored = suppress(masked, list(GUARDED)).drop("last_startup", "since_h")
    fixed = corrected(scored, model) if calibrate else scored.withColumn("y_calib", F.col("y_raw"))
    if model.season_maps:
        fixed = season_mapped(fixed, model.season_maps)
    out = baselines(fixed, model)
    out = suppress(out, [c for c in BASELINES if c in out.columns])
    if decisions is None:
        return out.withColumn("y_final", F.col("y_calib"))
    return blend(out, decisions, keys, "y_calib", "y_fallback", "y_final")
