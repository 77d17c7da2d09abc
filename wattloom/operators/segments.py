"""Run periods, daily summaries and short-run filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import energy_kwh, on_state
from wattloom.operators.resample import median_step
from wattloom.operators.series import Series, over_rows, runs, seconds_between


DEFAULT_STEP_S = 900.0


def on_periods(
    df: DataFrame,
    series: Series,
    power: str,
    threshold=10.0,
    split_by_day: bool = True,
    max_gap_s: float | None = None,
    off_days: bool = True,
    step: DataFrame | None = None,
) -> DataFrame:
    """ON runs of every key, and one row for each day without any ON sample.

    `step` is a per-key table with `step_s`; by default the median step is measured. Rows without
    power are dropped first, so runs bridge gaps unless `max_gap_s` is given.
    """
    keys = list(series.key)
    clean = df.where(F.col(power).isNotNull() & F.col(series.ts).isNotNull())
    limit = F.col(threshold) if isinstance(threshold, str) else F.lit(float(threshold))
    clean = clean.select(*keys, *series.order, F.col(power).cast("double").alias("_w"), on_state(F.col(power), limit).alias("state"))
    step = median_step(clean, series) if step is None else step
    stats = ["n", "sum_v", "min_v", "max_v"]
    both = runs(clean, series, "state", "_w", split_day=split_by_day, max_gap_s=max_gap_s)
    both = both.withColumn("date", F.to_date("start"))
    on = both.where("state = 1")
    spans = on.select(*keys, "date", "state", "start", "end", *stats)
    if off_days:
        # Day-split runs already hold every row of a day; whole runs need the rows again.
        parts = both if split_by_day else clean.select(
            *keys, F.to_date(series.ts).alias("date"), "state", F.col(series.ts).alias("start"), F.col(series.ts).alias("end"),
            F.lit(1).cast("long").alias("n"), F.col("_w").alias("sum_v"), F.col("_w").alias("min_v"), F.col("_w").alias("max_v"),
        )
        days = parts.groupBy(*keys, "date").agg(
            F.max("state").alias("state"), F.min("start").alias("start"), F.max("end").alias("end"),
            F.sum("n").alias("n"), F.sum("sum_v").alias("sum_v"), F.min("min_v").alias("min_v"), F.max("max_v").alias("max_v"),
        )
        if split_by_day:
            off = days.where("state = 0")
        else:
            off = days.join(on.select(*keys, "date").distinct(), [*keys, "date"], "left_anti")
        spans = spans.unionByName(off.withColumn("state", F.lit(0)))
    sized = spans.join(step, keys, "left").withColumn("step_s", F.coalesce("step_s", F.lit(DEFAULT_STEP_S)))
    duration = (seconds_between(F.col("start"), F.col("end")) + F.col("step_s")) / 60.0
    return sized.select(
        *keys,
        "date",
        F.col("start").alias("begin_time"),
        F.col("end").alias("end_time"),
        "state",
        duration.alias("duration_min"),
        F.col("min_v").alias("min_w"),
        (F.col("sum_v") / F.col("n")).alias("mean_w"),
        F.col("max_v").alias("peak_w"),
        energy_kwh(F.col("sum_v"), F.col("step_s") / 3600.0).alias("energy_kwh"),
    )


def rounded_periods(periods: DataFrame) -> DataFrame:
    """Report precision: minutes 2, watts 3, energy 6 digits."""
    return periods.withColumns(
        {
            "duration_min": F.round("duration_min", 2),
            "min_w": F.round("min_w", 3),
            "mean_w": F.round("mean_w", 3),
            "peak_w": F.round("peak_w", 3),
            "energy_kwh": F.round("energy_kwh", 6),
        }
    )


def daily_summary(periods: DataFrame, keys: list[str], bus_counts: DataFrame | None = None, branch_counts: DataFrame | None = None) -> DataFrame:
    """One row per key and day from day-split periods; OFF days report their whole-day values.

    Count tables (keys, date, n_raw) add `n_bus_raw` / `n_branch_raw`, 0 on days without readings.
    """
    on = F.col("state") == 1
    minutes = F.sum(F.when(on, F.col("duration_min")))
    weighted = F.sum(F.when(on, F.col("mean_w") * F.col("duration_min"))) / F.when(minutes > 0, minutes)
    out = periods.groupBy(*keys, "date").agg(
        F.count_if(on).alias("n_segments"),
        F.coalesce(minutes, F.lit(0.0)).alias("total_on_min"),
        (F.coalesce(minutes, F.lit(0.0)) / 60.0).alias("total_on_hours"),
        F.date_format(F.min(F.when(on, F.col("begin_time"))), "HH:mm:ss").alias("first_on_time"),
        F.date_format(F.max(F.when(on, F.col("end_time"))), "HH:mm:ss").alias("last_off_time"),
        F.coalesce(F.min(F.when(on, F.col("min_w"))), F.min("min_w")).alias("min_w"),
        F.coalesce(weighted, F.avg(F.when(on, F.col("mean_w"))), F.max("mean_w")).alias("mean_w"),
        F.coalesce(F.max(F.when(on, F.col("peak_w"))), F.max("peak_w")).alias("peak_w"),
        F.coalesce(F.sum(F.when(on, F.col("energy_kwh"))), F.max("energy_kwh")).alias("energy_kwh"),
    )
    for counts, name in ((bus_counts, "n_bus_raw"), (branch_counts, "n_branch_raw")):
        if counts is not None:
            out = out.join(counts.withColumnRenamed("n_raw", name), [*keys, "date"], "left")
            out = out.withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def rounded_summary(daily: DataFrame) -> DataFrame:
    return daily.withColumns(
        {
            "total_on_min": F.round("total_on_min", 2),
            "total_on_hours": F.round("total_on_hours", 3),
            "min_w": F.round("min_w", 3),
            "mean_w": F.round("mean_w", 3),
            "peak_w": F.round("peak_w", 3),
            "energy_kwh": F.round("energy_kwh", 6),
        }
    )


def _filter_steps(column: str, min_on: int, fill: int, low, high) -> list:
    """Sliding min/max steps that remove ON runs shorter than `min_on` and fill OFF runs up to `fill`.

    A value survives the first pass when some full stretch of `min_on` rows around it holds at least
    that value; the second pass is the mirror image. Incomplete stretches at the ends of a series do
    not count, so short runs there are treated like any other. Works on 0/1 states and, since both
    passes commute with thresholds, on scores: the filtered state at any threshold is `score >= thr`.
    """
    steps = []
    if min_on > 1:
        n = min_on - 1
        steps.append(
            lambda w: {
                "_full": F.when(F.count(column).over(w.rowsBetween(-n, 0)) == min_on, F.min(column).over(w.rowsBetween(-n, 0)))
            }
        )
        steps.append(lambda w: {column: F.coalesce(F.max("_full").over(w.rowsBetween(0, n)), F.lit(low))})
    if fill > 0:
        steps.append(
            lambda w: {
                "_wide": F.when(F.count(column).over(w.rowsBetween(-fill, 0)) == fill + 1, F.max(column).over(w.rowsBetween(-fill, 0)))
            }
        )
        steps.append(lambda w: {column: F.coalesce(F.min("_wide").over(w.rowsBetween(0, fill)), F.lit(high))})
    return steps


def filter_short_runs(df: DataFrame, series: Series, column: str, out: str, min_on: int = 2, fill: int = 1, scores: bool = False) -> DataFrame:
    """Remove short ON runs, then fill short OFF runs; `scores` filters probabilities for all thresholds at once."""
    low, high = (-1.0, 2.0) if scores else (0, 1)
    reach = max(min_on - 1, 0) + max(fill, 0)
    staged = df.withColumn(out, F.col(column))
    steps = _filter_steps(out, min_on, fill, low, high)
    if not steps:
        return staged
    return over_rows(staged, series, steps, before=reach, after=reach).drop("_full", "_wide")


def gate_power(state: Column, power: Column) -> Column:
    return state * F.greatest(power, F.lit(0.0))


def post_filter(df: DataFrame, series: Series, state: str, power: str, min_on: int = 2, fill: int = 1) -> DataFrame:
    """Filtered state (`state_filt`) and the power it lets through (`y_pred_filt`)."""
    filtered = filter_short_runs(df, series, state, "state_filt", min_on, fill)
    return filtered.withColumn("y_pred_filt", gate_power(F.col("state_filt"), F.col(power)))


def on_edges(df: DataFrame, series: Series, power: str, threshold: float = 50.0) -> DataFrame:
    """Rows that are ON while the row before was not."""
    on = F.coalesce(F.col(power) > threshold, F.lit(False))
    return over_rows(
        df.withColumn("_on", on),
        series,
        lambda w: {"_edge": F.col("_on") & ~F.coalesce(F.lag("_on").over(w), F.lit(False))},
        before=1,
    ).where("_edge").drop("_on", "_edge")


def off_centres(df: DataFrame, series: Series, power: str, threshold: float = 10.0, rows: int = 4) -> DataFrame:
    """Centre (third) row times of all stretches of four OFF rows that another row follows."""
    half = rows // 2

    def quiet(w):
        ahead = w.rowsBetween(0, rows - 1)
        full = (F.count(power).over(ahead) == rows) & F.lead(series.ts, rows).over(w).isNotNull()
        return {
            "_quiet": full & (F.max(power).over(ahead) < threshold),
            "centre_ts": F.lead(series.ts, half).over(w),
        }

    return over_rows(df, series, quiet, before=0, after=rows).where("_quiet").select(*series.key, "centre_ts")
