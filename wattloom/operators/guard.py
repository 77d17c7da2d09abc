"""Start-up guard: calibration from labelled data, scaling to a new user, and the step-level mask."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import clip, soft_max, soft_max_weight, sqrt_interp
from wattloom.functions.timeparse import floor_to
from wattloom.operators.joins import event_windows, startup_as_of
from wattloom.operators.quantiles import column_percentiles, percentiles
from wattloom.operators.segments import off_centres, on_edges
from wattloom.operators.series import Series, attach
from wattloom.session import cut_lineage

# Fixed values.
ALLOW_RANGE, ALLOW_REF = (0.75, 0.90), 30
MARGIN_RANGE, MARGIN_REF = (1.05, 1.30), 1500
SOFTMAX_TEMPERATURE_W, SOFTMAX_PIVOT_W = 8.0, 15.0
PROB_GAMMA, PROB_MIN_RATIO = 0.30, 0.60
SCALE_RANGE = (0.05, 2.0)
MAX_ON_HOURS = 12.0
LOOKAHEAD_S = 900
AUTO_DISABLE_W = 50.0
COVER_MIN = 0.30


def threshold_columns(on_p10: Column, off_p99: Column, n_on: Column, n_off: Column) -> dict[str, Column]:
    """Adaptive factors, the two bounds and their smooth maximum."""
    allow = sqrt_interp(n_on, ALLOW_REF, *ALLOW_RANGE)
    margin = sqrt_interp(n_off, MARGIN_REF, *MARGIN_RANGE)
    on_bound, off_bound = on_p10 * allow, off_p99 * margin
    return {
        "allow_factor": allow,
        "margin_factor": margin,
        "on_constraint": on_bound,
        "off_constraint": off_bound,
        "binding": F.when(on_bound >= off_bound, "ON").otherwise("OFF"),
        "softmax_weight": soft_max_weight(on_bound, off_bound, SOFTMAX_PIVOT_W, SOFTMAX_TEMPERATURE_W),
        "threshold_abs": soft_max(on_bound, off_bound, SOFTMAX_PIVOT_W, SOFTMAX_TEMPERATURE_W),
    }


def calibrate(
    branch: DataFrame, bus: DataFrame, series: Series, power: str, spike: str, main: str, bus_ts: str,
    on_w: float = 50.0, off_w: float = 10.0,
) -> DataFrame:
    """One guard row per key from start events and quiet stretches of the labelled period."""
    keys = list(series.key)
    edges = on_edges(branch, series, power, on_w).select(*keys, series.ts)
    centres = off_centres(branch, series, power, off_w)
    # Two event tables, each read by several percentiles: written once.
    on_win = cut_lineage(event_windows(edges, bus, keys, series.ts, bus_ts, spike, 1_200, 600))
    off_win = cut_lineage(event_windows(centres, bus, keys, "centre_ts", bus_ts, spike, 900, 900))
    on_points = {"win_absmax": {"on_p10_abs": 0.10, "on_p50_abs": 0.50}, "win_min": {"train_on_p50": 0.50, "train_on_p90": 0.90}}
    off_points = {"win_absmax": {"off_p50_abs": 0.50, "off_p99_abs": 0.99}, "win_min": {"train_off_p1": 0.01, "train_off_p5": 0.05, "train_off_p50": 0.50}}
    on_seen = column_percentiles(on_win, keys, on_points).withColumnRenamed("n_win_absmax", "n_on_amax").drop("n_win_min")
    off_seen = column_percentiles(off_win, keys, off_points).withColumnRenamed("n_win_absmax", "n_off_amax").drop("n_win_min")
    anchor = percentiles(bus, keys, main, {"train_d73_p95": 0.95}).drop("n")
    users = branch.select(*keys).distinct()
    joined = users
    for part in (on_seen, off_seen, anchor):
        joined = joined.join(part, keys, "left")
    zero = {c: 0.0 for c in ("on_p10_abs", "on_p50_abs", "off_p50_abs", "off_p99_abs", "train_on_p50", "train_on_p90", "train_off_p1", "train_off_p5", "train_off_p50")}
    # Without any event the percentile of a single 0 is used, so the count is 1.
    joined = joined.fillna({**zero, "n_on_amax": 1, "n_off_amax": 1})
    return joined.withColumns(
        threshold_columns(F.col("on_p10_abs"), F.col("off_p99_abs"), F.col("n_on_amax"), F.col("n_off_amax"))
    )


def auto_disable(meta: DataFrame, bus: DataFrame, keys: Sequence[str], spike: str, bus_ts: str) -> DataFrame:
    """Adds `trigger_a` (signal too weak), `cover_ratio`, `trigger_b` (too few days reach it), `enabled`."""
    daily = bus.where(F.col(spike).isNotNull()).groupBy(*keys, F.to_date(bus_ts).alias("_day")).agg(F.max(F.abs(spike)).alias("_peak"))
    reached = daily.join(meta.select(*keys, "threshold_abs"), list(keys))
    cover = reached.groupBy(*keys).agg(
        (F.count_if(F.col("_peak") >= F.col("threshold_abs")) / F.count(F.lit(1))).alias("cover_ratio"),
        F.count(F.lit(1)).alias("n_days"),
    )
    strongest = F.greatest("off_p99_abs", "on_p10_abs", "threshold_abs")
    flagged = meta.join(cover, list(keys), "left").withColumn("trigger_a", strongest < AUTO_DISABLE_W)
    flagged = flagged.withColumn("trigger_b", F.coalesce(F.col("cover_ratio") < COVER_MIN, F.lit(False)))
    return flagged.withColumn("enabled", ~(F.col("trigger_a") | F.col("trigger_b")))


def scaled_threshold(meta: DataFrame, bus: DataFrame, keys: Sequence[str], main: str) -> DataFrame:
    """Guard threshold of the scored period: training threshold times the clipped ratio of main-signal p95."""
    seen = percentiles(bus, keys, main, {"user_d73_p95": 0.95}).drop("n")
    joined = meta.join(seen, list(keys), "left")
    anchor = F.when(F.col("train_d73_p95") != 0, F.col("train_d73_p95"))
    scale = F.coalesce(clip(F.col("user_d73_p95") / anchor, *SCALE_RANGE), F.lit(1.0))
    return joined.withColumn("scale", scale).withColumn("guard_w", F.col("threshold_abs") * F.col("scale"))


def startups(
    bus: DataFrame, steps: DataFrame, thresholds: DataFrame, keys: Sequence[str], bus_ts: str, spike: str,
    step_ts: str, p_on: str = "p_on", minutes: int = 15, gamma: float = PROB_GAMMA, min_ratio: float = PROB_MIN_RATIO,
) -> DataFrame:
    """Readings whose magnitude reaches the local threshold, lowered where the model is confident.

    A reading meets its own step by an equi-join on the bin; without a step the threshold is not lowered.
    """
    bins = steps.select(*keys, F.col(step_ts).alias("_bin"), F.col(p_on).alias("_p")).groupBy(*keys, "_bin").agg(F.max("_p").alias("_p"))
    readings = bus.select(*keys, F.col(bus_ts).alias("startup_ts"), F.col(spike).alias("_v")).where("_v IS NOT NULL")
    met = readings.withColumn("_bin", floor_to(F.col("startup_ts"), minutes)).join(bins, [*keys, "_bin"], "left")
    met = attach(met, thresholds.select(*keys, "guard_w"), keys)
    factor = clip(1.0 - gamma * F.coalesce("_p", F.lit(0.0)), min_ratio, 1.0)
    return met.where(F.abs("_v") >= F.col("guard_w") * factor).select(*keys, "startup_ts")


def guard_mask(steps: DataFrame, starts: DataFrame, series: Series, max_on_h: float = MAX_ON_HOURS, lookahead_s: int = LOOKAHEAD_S) -> DataFrame:
    """Adds `suppressed`: no startup up to ts + lookahead, or the last one is too long ago."""
    seen = startup_as_of(steps, starts, series, lookahead_s)
    return seen.withColumn("suppressed", F.col("last_startup").isNull() | (F.col("since_h") > max_on_h))


def suppress(df: DataFrame, columns: Sequence[str], mask: str = "suppressed") -> DataFrame:
    """Zero state, power, bounds and probability on suppressed steps."""
    return df.withColumns({c: F.when(F.col(mask), F.lit(0).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in columns})
