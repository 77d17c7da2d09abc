"""Profiles and diagnostic reports.

A report that needs medians joins the exact percentiles of its groups to one plain aggregation, so
no group is ever sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import SEASONS, over, pearson, season_by_month
from wattloom.operators.quantiles import column_percentiles, percentiles
from wattloom.operators.series import Series, attach, row_gaps, seconds_between


def to_long(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(list(keys), list(columns), "column", "value")


def column_profile(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Per column: range, mean, deviation, median, missing share and distinct values."""
    long = to_long(df, keys, columns)
    group = [*keys, "column"]
    stats = long.groupBy(*group).agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        (F.count_if(F.col("value").isNull()) / F.count(F.lit(1)) * 100).alias("missing_pct"),
    )
    values = long.where("value IS NOT NULL").groupBy(*group, "value").agg(F.count(F.lit(1)).alias("_c"))
    distinct = values.groupBy(*group).agg(F.count(F.lit(1)).alias("n_distinct"))
    middle = percentiles(long, group, "value", {"median": 0.5}).drop("n")
    return stats.join(middle, group, "left").join(distinct, group, "left").fillna({"n_distinct": 0})


def label_correlation(df: DataFrame, columns: Sequence[str], label: str, keys: Sequence[str] = ()) -> DataFrame:
    """|Pearson| of every column with the label, in one pass over the table."""
    wide = df.groupBy(*keys).agg(*[F.abs(pearson(F.col(c).cast("double"), F.col(label).cast("double"))).alias(c) for c in columns])
    return wide.unpivot(list(keys), list(columns), "column", "abs_corr").where("abs_corr IS NOT NULL AND NOT isnan(abs_corr)")


def top_columns(correlations: DataFrame, k: int = 25) -> list[str]:
    """Names of the k most correlated columns (a list of at most the column count)."""
    ranked = correlations.orderBy(F.desc("abs_corr"), "column").limit(k)
    return [r["column"] for r in ranked.collect()]


def label_distribution(df: DataFrame, keys: Sequence[str], label: str, ts: str) -> DataFrame:
    positive = F.col(label) > 0
    stats = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        over(F.count_if(F.col(label) == 0), F.count(label)).alias("zero_share"),
        F.avg(F.when(positive, F.col(label))).alias("mean_positive"),
        F.max(label).alias("peak"),
    )
    middle = percentiles(df.where(positive), keys, label, {"median_positive": 0.5}).drop("n")
    return stats.join(middle, list(keys), "left") if keys else stats.withColumn("median_positive", middle.scalar())


def overlap_period(bus: DataFrame, branch: DataFrame, keys: Sequence[str], bus_ts: str, branch_ts: str) -> DataFrame:
    """Common time span of both meters per key."""
    a = bus.groupBy(*keys).agg(F.min(bus_ts).alias("_b0"), F.max(bus_ts).alias("_b1"))
    b = branch.groupBy(*keys).agg(F.min(branch_ts).alias("_l0"), F.max(branch_ts).alias("_l1"))
    both = a.join(b, list(keys))
    return both.select(*keys, F.greatest("_b0", "_l0").alias("start"), F.least("_b1", "_l1").alias("end")).withColumn(
        "overlap_days", seconds_between(F.col("start"), F.col("end")) / 86_400.0
    )


def season_on_stats(df: DataFrame, keys: Sequence[str], ts: str, power: str, on: Column) -> DataFrame:
    """ON distribution for all three seasons, also those without ON rows."""
    rows = df.where(on).withColumn("season", season_by_month(F.col(ts)))
    group = [*keys, "season"]
    stats = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_on"),
        F.avg(power).alias("mean_W"),
        F.stddev_pop(power).alias("std_W"),
        F.min(power).alias("min_W"),
        F.max(power).alias("max_W"),
    )
    middle = percentiles(rows, group, power, {"median_W": 0.5}).drop("n")
    all_seasons = df.select(*keys).distinct() if keys else df.sparkSession.range(1)
    grid = all_seasons.select(*keys, F.explode(F.array(*[F.lit(s) for s in SEASONS])).alias("season"))
    return grid.join(stats, group, "left").join(middle, group, "left").fillna({"n_on": 0})


def season_rows(df: DataFrame, ts: str) -> DataFrame:
    """Each row once for its season and once for ALL, so totals and medians share one plan."""
    return df.withColumn("season", F.explode(F.array(season_by_month(F.col(ts)), F.lit("ALL"))))


def residual_bias(df: DataFrame, keys: Sequence[str], ts: str, y_true: str, y_pred: str, s_true: str) -> DataFrame:
    """ON residual (pred − true) overall and per season: n, mean, median, deviation."""
    rows = season_rows(df.where(F.col(s_true) == 1), ts).withColumn("_res", F.col(y_pred) - F.col(y_true))
    group = [*keys, "season"]
    stats = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_on"), F.avg("_res").alias("mean_res"), F.stddev_pop("_res").alias("std_res")
    )
    return stats.join(percentiles(rows, group, "_res", {"median_res": 0.5}).drop("n"), group)


def monthly_residuals(df: DataFrame, keys: Sequence[str], ts: str, y_true: str, before: str, after: str, s_true: str) -> DataFrame:
    """ON rows per month: median residual and MAE before and after a correction."""
    rows = df.where(F.col(s_true) == 1).withColumn("month", F.date_format(ts, "yyyy-MM"))
    rows = rows.withColumn("_r0", F.col(before) - F.col(y_true)).withColumn("_r1", F.col(after) - F.col(y_true))
    group = [*keys, "month"]
    stats = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_on"), F.avg(F.abs("_r0")).alias("mae_before"), F.avg(F.abs("_r1")).alias("mae_after")
    )
    middle = column_percentiles(rows, group, {"_r0": {"median_before": 0.5}, "_r1": {"median_after": 0.5}})
    return stats.join(middle.where("n__r0 > 0 AND n__r1 > 0").drop("n__r0", "n__r1"), group)


def split_month_counts(df: DataFrame, keys: Sequence[str], ts: str, split: str = "split") -> DataFrame:
    """Rows and covered days per split and month; days are counted from the day table."""
    days = df.groupBy(*keys, split, F.to_date(ts).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    month = F.date_format("_day", "yyyy-MM").alias("month")
    return days.groupBy(*keys, split, month).agg(F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_days"))


def season_scores(df: DataFrame, keys: Sequence[str], ts: str, y_true: str, y_pred: str, on_w: float = 10.0, step_h: float = 0.25) -> DataFrame:
    """Per season and ALL: rows, ON rows, ON means, MAE, SAE and energies."""
    on = F.col(y_true) >= on_w
    return season_rows(df, ts).groupBy(*keys, "season").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(on).alias("n_on"),
        F.avg(F.when(on, F.col(y_true))).alias("true_mean"),
        F.avg(F.when(on, F.col(y_pred))).alias("pred_mean"),
        F.avg(F.abs(F.col(y_pred) - F.col(y_true))).alias("mae"),
        (F.abs(F.sum(y_pred) - F.sum(y_true)) / F.greatest(F.sum(y_true), F.lit(1e-6))).alias("sae"),
        (F.sum(y_true) * step_h / 1000).alias("kwh_true"),
        (F.sum(y_pred) * step_h / 1000).alias("kwh_pred"),
    )


def power_bin(value: Column, edges: Sequence[float]) -> Column:
    """Lower edge of the half-open bin, NULL outside."""
    out = F.lit(None).cast("double")
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        out = F.when((value >= low) & (value < high), F.lit(float(low))).otherwise(out)
    return out


# Bin edges in watts.
RESIDUAL_EDGES = (0, 200, 400, 600, 800, 1000)
PROFILE_EDGES = (0, 200, 400, 500, 600, 700, 800, 900, 1000)
PROFILE_POINTS = {"p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95}


def residual_bins(df: DataFrame, keys: Sequence[str], y_true: str, y_pred: str, on_w: float = 10.0, edges: Sequence[float] = RESIDUAL_EDGES) -> DataFrame:
    rows = df.where(F.col(y_true) >= on_w).withColumn("bin_w", power_bin(F.col(y_true), edges)).where("bin_w IS NOT NULL")
    rows = rows.withColumn("_res", F.col(y_pred) - F.col(y_true))
    group = [*keys, "bin_w"]
    stats = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(y_true).alias("true_mean"),
        F.avg(y_pred).alias("pred_mean"),
        F.avg("_res").alias("mean_res"),
        F.avg((F.col("_res") < 0).cast("double")).alias("under_share"),
    )
    return stats.join(percentiles(rows, group, "_res", {"median_res": 0.5}).drop("n"), group)


def missed_on(df: DataFrame, keys: Sequence[str], y_true: str, s_true: str, s_pred: str, step_h: float = 0.25) -> DataFrame:
    """False negatives: count, share, their power and the energy they hide."""
    on, miss = F.col(s_true) == 1, (F.col(s_true) == 1) & (F.col(s_pred) == 0)
    lost = F.sum(F.when(miss, F.col(y_true)))
    stats = df.groupBy(*keys).agg(
        F.count_if(miss).alias("n_fn"),
        F.count_if(on).alias("n_on"),
        (F.count_if(miss) / F.greatest(F.count_if(on), F.lit(1))).alias("fn_share"),
        F.avg(F.when(miss, F.col(y_true))).alias("fn_mean_w"),
        F.max(F.when(miss, F.col(y_true))).alias("fn_max_w"),
        F.min(F.when(miss, F.col(y_true))).alias("fn_min_w"),
        (lost * step_h / 1000).alias("lost_kwh"),
        over(lost, F.sum(F.when(on, F.col(y_true)))).alias("lost_share"),
    )
    middle = percentiles(df.where(miss), keys, y_true, {"fn_median_w": 0.5}).drop("n")
    return stats.join(middle, list(keys), "left") if keys else stats.withColumn("fn_median_w", middle.scalar())


def power_profile(df: DataFrame, keys: Sequence[str], power: str, on_w: float = 10.0) -> DataFrame:
    on = df.where(F.col(power) >= on_w)
    stats = on.groupBy(*keys).agg(
        F.avg(power).alias("mean_w"), F.stddev_pop(power).alias("std_w"), F.min(power).alias("min_w"), F.max(power).alias("max_w")
    )
    shares = df.groupBy(*keys).agg(over(F.count_if(F.col(power) >= on_w), F.count(power)).alias("on_share"))
    points = percentiles(on, keys, power, PROFILE_POINTS).withColumnRenamed("n", "n_on")
    return stats.join(points, list(keys)).join(shares, list(keys))


def power_histogram(df: DataFrame, keys: Sequence[str], power: str, on_w: float = 10.0, edges: Sequence[float] = PROFILE_EDGES) -> DataFrame:
    on = df.where(F.col(power) >= on_w)
    counts = on.withColumn("bin_w", power_bin(F.col(power), edges)).groupBy(*keys, "bin_w").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_all"))
    shared = counts.join(totals, list(keys)).withColumn("share", F.col("n") / F.col("_all"))
    return shared.where("bin_w IS NOT NULL").drop("_all")


def dataset_comparison(old: DataFrame, new: DataFrame, by: Column, name: str, power: str, on_w: float = 10.0) -> DataFrame:
    """ON rows and mean power of two datasets side by side per season, month or ten-day block."""
    both = old.withColumn("_set", F.lit("old")).unionByName(new.withColumn("_set", F.lit("new")), allowMissingColumns=True)
    rows = both.where(F.col(power) >= on_w).withColumn(name, by)
    wide = rows.groupBy(name).pivot("_set", ["old", "new"]).agg(F.count(F.lit(1)).alias("n"), F.avg(power).alias("mean_w"))
    return wide.fillna({"old_n": 0, "new_n": 0})


def ten_day_block(ts: Column) -> Column:
    day = F.dayofmonth(ts)
    part = F.when(day <= 10, "1-10").when(day <= 20, "11-20").otherwise("21-31")
    return F.concat_ws(" ", F.date_format(ts, "yyyy-MM"), part)


def monthly_weather(weather: DataFrame, keys: Sequence[str], ts: str = "time") -> DataFrame:
    return weather.groupBy(*keys, F.date_format(ts, "yyyy-MM").alias("month")).agg(
        F.avg("temperature_2m").alias("mean_c"),
        F.min("temperature_2m").alias("min_c"),
        F.max("temperature_2m").alias("max_c"),
        F.avg("relative_humidity_2m").alias("mean_humidity"),
        F.count(F.lit(1)).alias("n_hours"),
    )


def prediction_profile(df: DataFrame, keys: Sequence[str], ts: str, y_pred: str) -> DataFrame:
    """What can be said without labels: span, level and share of positive predictions."""
    stats = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.avg(y_pred).alias("mean_w"),
        F.max(y_pred).alias("max_w"),
        F.avg((F.col(y_pred) > 0).cast("double")).alias("positive_share"),
    )
    return stats.join(percentiles(df, keys, y_pred, {"median_w": 0.5}).drop("n"), list(keys))


def season_shares(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    counts = df.groupBy(*keys, season_by_month(F.col(ts)).alias("season")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_all"))
    joined = counts.join(totals, list(keys)) if keys else counts.withColumn("_all", totals.scalar())
    return joined.withColumn("share", F.col("n") / F.col("_all")).drop("_all")


def month_counts(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return df.groupBy(*keys, F.date_format(ts, "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


def calibration_effect(df: DataFrame, keys: Sequence[str], y_true: str, raw: str, calibrated: str, step_h: float = 0.25) -> DataFrame:
    """MAE, SAE and energy error before and after calibration, and the improvement."""
    true = F.col(y_true)
    total = F.greatest(F.sum(true), F.lit(1e-6))

    def parts(c: str, tag: str):
        return [
            F.avg(F.abs(F.col(c) - true)).alias(f"mae_{tag}"),
            (F.abs(F.sum(c) - F.sum(true)) / total).alias(f"sae_{tag}"),
            ((F.sum(c) - F.sum(true)) * step_h / 1000).alias(f"kwh_err_{tag}"),
        ]

    out = df.groupBy(*keys).agg(*parts(raw, "raw"), *parts(calibrated, "calib"))
    return out.withColumns({f"{m}_gain": F.col(f"{m}_raw") - F.col(f"{m}_calib") for m in ("mae", "sae", "kwh_err")})


def calibration_shift(df: DataFrame, keys: Sequence[str], ts: str, raw: str, calibrated: str, state: str) -> DataFrame:
    rows = df.where(F.col(state) == 1).withColumn("season", season_by_month(F.col(ts)))
    return rows.groupBy(*keys, "season").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(raw).alias("mean_raw"),
        F.avg(calibrated).alias("mean_calib"),
        (F.avg(calibrated) - F.avg(raw)).alias("mean_shift"),
    )


def data_quality(
    df: DataFrame, series: Series, features: Sequence[str], label: str, main: str | None = None, on_w: float = 10.0
) -> DataFrame:
    """Per key: span, step regularity, missing columns, ON share, outlier share and the issue list."""
    keys = list(series.key)
    main = main or features[0]
    gaps = row_gaps(df.select(*keys, *series.order), series).where("dt_s IS NOT NULL")
    median = percentiles(gaps, keys, "dt_s", {"dt_median_s": 0.5}).drop("n")
    steps = gaps.groupBy(*keys).agg(F.stddev_samp("dt_s").alias("_sd"), F.max("dt_s").alias("dt_max_gap_s"))
    missing = F.array(*[F.struct((F.count_if(F.col(c).isNull()) / F.count(F.lit(1))).alias("share"), F.lit(c).alias("column")) for c in features])
    level = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.min(series.ts).alias("time_start"),
        F.max(series.ts).alias("time_end"),
        missing.alias("_missing"),
        F.count_if(F.col(label).isNull()).alias("y_n_missing"),
        F.min(label).alias("y_min"),
        F.max(label).alias("y_max"),
        F.avg(label).alias("y_mean"),
        F.avg((F.col(label) >= on_w).cast("double")).alias("on_pct"),
        F.avg(main).alias("_mu"),
        F.stddev_samp(main).alias("_sigma"),
        F.count(main).alias("_n_main"),
    )
    seen = attach(df.select(*keys, main), level.select(*keys, "_mu", "_sigma"), keys)
    outliers = seen.groupBy(*keys).agg(F.avg((F.abs(F.col(main) - F.col("_mu")) > 5 * F.col("_sigma")).cast("double")).alias("_out"))
    joined = level.join(median, keys, "left").join(steps, keys, "left").join(outliers, keys, "left")
    top = F.slice(F.reverse(F.array_sort("_missing")), 1, 5)
    wide = joined.withColumns(
        {
            "span_days": seconds_between(F.col("time_start"), F.col("time_end")) / 86_400.0,
            "dt_cv": F.col("_sd") / F.greatest(F.abs("dt_median_s"), F.lit(1.0)),
            "missing_top5": F.transform(top, lambda m: m["column"]),
            "n_high_missing": F.size(F.filter(top, lambda m: m["share"] > 0.1)),
            "outlier_share": F.when(F.col("_n_main") > 20, F.col("_out")),
        }
    )
    issues = F.array_compact(
        F.array(
            F.when(F.col("dt_cv") > 0.2, "uneven_step"),
            F.when(F.col("dt_max_gap_s") > 4 * F.col("dt_median_s"), "sampling_gap"),
            F.when(F.col("n_high_missing") > 0, "missing_columns"),
            F.when((F.col("on_pct") < 0.05) | (F.col("on_pct") > 0.95), "unbalanced_label"),
            F.when(F.col("outlier_share") > 0.01, "outliers"),
        )
    )
    return wide.withColumn("issues", issues).drop("_sd", "_missing", "_mu", "_sigma", "_n_main", "_out")


def gray_zone(df: DataFrame, keys: Sequence[str], y_true: str, s_pred: str, low: float, high: float) -> DataFrame:
    """Rows between two ON thresholds, and F1 of the same prediction under each."""

    def f1(limit: float) -> Column:
        true = F.col(y_true) >= limit
        tp = F.count_if(true & (F.col(s_pred) == 1))
        wrong = F.count_if(true != (F.col(s_pred) == 1))
        return F.coalesce(2.0 * tp / F.when(2 * tp + wrong > 0, 2 * tp + wrong), F.lit(0.0))

    zone = (F.col(y_true) >= low) & (F.col(y_true) < high)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(zone).alias("n_gray"), f1(low).alias("f1_low"), f1(high).alias("f1_high")
    )
