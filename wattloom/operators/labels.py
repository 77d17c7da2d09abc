"""Cleaning of label series with start-up signals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.series import Series, events_around, seconds_between


def clean_labels(
    branch: DataFrame,
    bus: DataFrame,
    series: Series,
    target: str,
    spike: str,
    bus_ts: str,
    startup_w: float = 50.0,
    small_min: float = 5.0,
    small_max: float = 50.0,
    lookback_min: float = 120.0,
) -> DataFrame:
    """Set small loads to 0 where they precede a startup or have none around.

    Adds `cleaned_w`, `small`, `before_startup` (a startup follows within the lookback, strictly
    later) and `isolated` (none within the lookback on either side).
    """
    startups = bus.where(F.abs(F.col(spike)) >= startup_w)
    around = events_around(branch, startups, series, (), bus_ts)
    here = F.col(series.ts)
    since = seconds_between(F.col("prev_event.at"), here)
    until = seconds_between(here, F.col("next_event.at"))
    limit = lookback_min * 60.0
    small = F.coalesce(F.col(target).between(small_min, small_max), F.lit(False))
    ahead = F.coalesce(until <= limit, F.lit(False))
    behind = F.coalesce(since <= limit, F.lit(False))
    flagged = around.withColumn("small", small).withColumn("before_startup", small & ahead)
    flagged = flagged.withColumn("isolated", small & ~ahead & ~behind)
    zero = F.col("before_startup") | F.col("isolated")
    return flagged.withColumn("cleaned_w", F.when(zero, F.lit(0.0)).otherwise(F.col(target))).drop("prev_event", "next_event")


def cleaning_report(cleaned: DataFrame, bus: DataFrame, series: Series, target: str, spike: str, startup_w: float = 50.0, step_h: float = 0.25) -> DataFrame:
    keys = list(series.key)
    starts = bus.groupBy(*keys).agg(F.count_if(F.abs(F.col(spike)) >= startup_w).alias("n_startup_points"))
    body = cleaned.groupBy(*keys).agg(
        F.count_if("small").alias("n_small_loads_total"),
        F.count_if(F.col("before_startup") | F.col("isolated")).alias("n_cleaned_to_zero"),
        F.count_if("before_startup").alias("cleaned_in_startup_window"),
        F.count_if("isolated").alias("cleaned_isolated"),
        (F.sum(target) * step_h / 1000).alias("original_kwh"),
        (F.sum("cleaned_w") * step_h / 1000).alias("cleaned_kwh"),
    )
    return body.join(starts, keys, "left").withColumn("kwh_reduction", F.col("original_kwh") - F.col("cleaned_kwh"))
