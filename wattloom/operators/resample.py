"""Binning, grids, gap filling and sampling profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.scalars import over
from wattloom.functions.timeparse import floor_to
from wattloom.operators.quantiles import percentiles
from wattloom.operators.series import Series, attach, over_rows, row_gaps, seconds_between


def tumbling_mean(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    spikes: Sequence[str] = (),
    minutes: int = 15,
    out_ts: str = "ts",
) -> DataFrame:
    """Left-closed, left-labelled bins: mean of each column, plus the extremes of the spike columns.

    One partially aggregated shuffle on (key, bin); NULL readings are skipped. A spike column is
    always kept among the means.
    """
    means = list(dict.fromkeys([*columns, *spikes]))
    aggs = [F.avg(c).alias(c) for c in means]
    for c in spikes:
        aggs += [
            F.max(c).alias(f"{c}_max5"),
            F.min(c).alias(f"{c}_min5"),
            F.max(F.abs(c)).alias(f"{c}_absmax5"),
        ]
    binned = df.withColumn("_bin", floor_to(F.col(ts), minutes))
    return binned.groupBy(*keys, F.col("_bin").alias(out_ts)).agg(*aggs)


def spike_sources(columns: Sequence[str], available: Sequence[str], default: Sequence[str]) -> list[str]:
    """Base columns whose extremes are needed: the default ones and those asked for by suffix."""
    suffixes = ("_max5", "_min5", "_absmax5")
    asked = {c.removesuffix(s) for c in columns for s in suffixes if c.endswith(s)}
    return [c for c in sorted({*default, *asked}) if c in available]


def full_grid(df: DataFrame, keys: Sequence[str], ts: str, minutes: int = 15) -> DataFrame:
    """Every bin between the first and last one of each key; bins without rows are NULL."""
    span = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    grid = span.select(
        *keys, F.explode(F.sequence("_lo", "_hi", F.expr(f"INTERVAL {minutes} MINUTES"))).alias(ts)
    )
    return grid.join(df, [*keys, ts], "left")


def align(bins: DataFrame, labels: DataFrame, keys: Sequence[str], target: str, label_ts: str = "time", ts: str = "ts") -> DataFrame:
    """Inner join of the binned meter with its label series; label NULLs are dropped, label is `y_ac`."""
    wanted = labels.where(F.col(target).isNotNull()).select(
        *keys, F.col(label_ts).alias(ts), F.col(target).alias("y_ac")
    )
    return bins.join(wanted, [*keys, ts], "inner")


def bounded_fill(df: DataFrame, series: Series, columns: Sequence[str], k: int) -> DataFrame:
    """Forward fill over at most `k` rows, then back fill over at most `k` rows."""
    if k <= 0:
        return df

    def forward(w):
        return {c: F.coalesce(c, F.last(c, True).over(w.rowsBetween(-k, 0))) for c in columns}

    def backward(w):
        return {c: F.coalesce(c, F.first(c, True).over(w.rowsBetween(0, k))) for c in columns}

    return over_rows(df, series, [forward, backward], before=k, after=k)


def fill_and_drop(df: DataFrame, series: Series, columns: Sequence[str], k: int = 2) -> DataFrame:
    """Bounded fill, then drop rows that still miss a value."""
    return bounded_fill(df, series, columns, k).dropna(how="any", subset=list(columns))


def dropped_share(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    n0 = before.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_before"))
    n1 = after.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_after"))
    counted = n0.join(n1, list(keys), "left").withColumn("n_after", F.coalesce("n_after", F.lit(0)))
    return counted.withColumn("dropped_share", 1 - F.col("n_after") / F.col("n_before"))


def hourly_to_quarter(weather: DataFrame, keys: Sequence[str], columns: Sequence[str], ts: str = "time") -> DataFrame:
    """Linear-in-time interpolation to 15 minutes; the last reading stays flat for 45 minutes.

    The window runs over hours of a place, a series bounded by the calendar and not by the meters.
    """
    w = Window.partitionBy(*keys).orderBy(ts)
    ahead = {"_next": F.lead(ts).over(w), **{f"_n_{c}": F.lead(c).over(w) for c in columns}}
    spans = weather.withColumns(ahead)
    quarter = F.expr("INTERVAL 15 MINUTES")
    until = F.coalesce(F.col("_next") - quarter, F.col(ts) + F.expr("INTERVAL 45 MINUTES"))
    steps = spans.withColumn("_at", F.explode(F.sequence(F.col(ts), until, quarter)))
    share = F.coalesce(seconds_between(F.col(ts), F.col("_at")) / seconds_between(F.col(ts), F.col("_next")), F.lit(0.0))
    values = [(F.col(c) + (F.coalesce(f"_n_{c}", c) - F.col(c)) * share).alias(c) for c in columns]
    return steps.select(*keys, F.col("_at").alias(ts), *values)


def daily_extremes(weather: DataFrame, keys: Sequence[str], temp: str, ts: str = "time") -> DataFrame:
    return weather.groupBy(*keys, F.to_date(ts).alias("date")).agg(
        F.max(temp).alias("temp_day_max"), F.min(temp).alias("temp_day_min"), F.avg(temp).alias("temp_day_mean")
    )


def raw_daily_counts(df: DataFrame, keys: Sequence[str], ts: str, out: str = "n_raw") -> DataFrame:
    """Readings per day; a table without the time column gives an empty result."""
    if ts not in df.columns:
        return df.limit(0).select(*keys, F.lit(None).cast("date").alias("date"), F.lit(0).cast("long").alias(out))
    timed = df.where(F.col(ts).isNotNull())
    return timed.groupBy(*keys, F.to_date(ts).alias("date")).agg(F.count(F.lit(1)).alias(out))


def median_step(df: DataFrame, series: Series) -> DataFrame:
    """Median seconds between rows (`step_s`) of the keys that have one above zero."""
    gaps = row_gaps(df.select(*series.key, *series.order), series)
    return percentiles(gaps, series.key, "dt_s", {"step_s": 0.5}).drop("n").where("step_s > 0")


def sampling_profile(df: DataFrame, series: Series, default_s: float = 900.0) -> DataFrame:
    """Step statistics per key, the uneven-step flag (CV > 0.10) and gaps above twice the median."""
    gaps = row_gaps(df.select(*series.key, *series.order), series).where("dt_s IS NOT NULL")
    steps = percentiles(gaps, series.key, "dt_s", {"_median": 0.5}).drop("n")
    step = F.when(F.col("_median") > 0, F.col("_median")).otherwise(F.lit(default_s))
    joined = attach(gaps, steps, series.key).withColumn("step_s", step)
    cv = over(F.stddev_pop("dt_s"), F.avg("dt_s"))
    return joined.groupBy(*series.key).agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.first("step_s").alias("step_s"),
        F.avg("dt_s").alias("mean_s"),
        F.min("dt_s").alias("min_s"),
        F.max("dt_s").alias("max_s"),
        cv.alias("cv"),
        F.coalesce(cv > 0.10, F.lit(False)).alias("uneven"),
        F.count_if(F.col("dt_s") > 2 * F.col("step_s")).alias("n_gaps"),
    )
