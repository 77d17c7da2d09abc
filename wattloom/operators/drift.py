"""Temperature lookup tables, drift reports and the model switch."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.scalars import drift_level, lut_flag
from wattloom.operators.joins import bins_per_key, hit_bins
from wattloom.operators.quantiles import percentiles
from wattloom.operators.series import DAY, Series, attach
from wattloom.operators.windows import ema
from wattloom.session import cut_lineage

MIN_LUT_ROWS = 5
MIN_DRIFT_ROWS = 10


def temperature_bins(df: DataFrame, keys: Sequence[str], temp: str, n_bins: int = 20) -> DataFrame:
    """Quantile bins of temperature per key: distinct edges, one row per neighbouring pair."""
    points = {f"_q{i}": i / n_bins for i in range(n_bins + 1)}
    edges = percentiles(df, keys, temp, points)
    distinct = F.array_sort(F.array_distinct(F.array(*[F.col(q) for q in points])))
    pairs = F.transform(
        F.sequence(F.lit(1), F.size("_edges") - 1),
        lambda i: F.struct(
            (i - 1).cast("int").alias("bin_id"),
            F.element_at("_edges", i).alias("temp_lo"),
            F.element_at("_edges", i + 1).alias("temp_hi"),
        ),
    )
    return edges.select(*keys, distinct.alias("_edges")).where(F.size("_edges") >= 2).select(*keys, F.inline(pairs))


def rows_in_bins(df: DataFrame, bins: DataFrame, keys: Sequence[str], temp: str) -> DataFrame:
    """Each row once per bin that holds it (edges belong to both neighbours)."""
    per_key = bins_per_key(bins.withColumn("expected_signal", F.col("expected_signal") if "expected_signal" in bins.columns else F.lit(None).cast("double")), keys)
    hit = attach(df, per_key, keys, how="inner")
    return hit.withColumn("_bin", F.explode(hit_bins(F.col(temp), F.col("_bins")))).select(
        *df.columns, F.col("_bin.bin_id").alias("bin_id")
    )


def build_lut(df: DataFrame, keys: Sequence[str], temp: str, signal: str, n_bins: int = 20) -> DataFrame:
    """Expected signal per temperature bin (median of at least five rows) and one global row per key.

    Bins are renumbered by temperature; the global median has `bin_id` −1. This is a fitting step: the
    edges and the table (some twenty rows per key) are checkpointed, so later plans start from them.
    """
    bins = cut_lineage(temperature_bins(df, keys, temp, n_bins))
    held = rows_in_bins(df.select(*keys, temp, signal), bins, keys, temp)
    group = [*keys, "bin_id"]
    stats = held.groupBy(*group).agg(F.avg(signal).alias("mean_signal"), F.stddev_pop(signal).alias("std_signal"))
    middle = percentiles(held, group, signal, {"p25_signal": 0.25, "expected_signal": 0.5, "p75_signal": 0.75})
    filled = bins.join(middle, group).where(F.col("n") >= MIN_LUT_ROWS).join(stats, group)
    order = Window.partitionBy(*keys).orderBy("temp_lo")
    table = filled.select(
        *keys,
        (F.row_number().over(order) - 1).alias("bin_id"),
        "temp_lo",
        "temp_hi",
        (F.col("temp_hi") - F.col("temp_lo")).alias("temp_width"),
        "expected_signal",
        F.col("n").alias("n_samples"),
        "mean_signal",
        "std_signal",
        "p25_signal",
        "p75_signal",
    )
    overall = percentiles(df, keys, signal, {"expected_signal": 0.5}).drop("n").withColumn("bin_id", F.lit(-1))
    return cut_lineage(table.unionByName(overall, allowMissingColumns=True))


def lut_actual_vs_expected(df: DataFrame, lut: DataFrame, keys: Sequence[str], temp: str, signal: str) -> DataFrame:
    """Scored rows against the training table, bin by bin; empty bins stay with NO_DATA."""
    bins = lut.where("bin_id >= 0").select(*keys, "bin_id", "temp_lo", "temp_hi", "expected_signal")
    held = rows_in_bins(df.select(*keys, temp, signal), bins, keys, temp)
    group = [*keys, "bin_id"]
    stats = held.groupBy(*group).agg(F.avg(signal).alias("infer_mean_signal"))
    points = percentiles(
        held, group, signal, {"infer_p25_signal": 0.25, "infer_median_signal": 0.5, "infer_p75_signal": 0.75}
    ).withColumnRenamed("n", "infer_n_samples")
    joined = bins.join(points, group, "left").join(stats, group, "left").fillna({"infer_n_samples": 0})
    residual = F.col("infer_median_signal") - F.col("expected_signal")
    relative = residual / F.greatest(F.abs("expected_signal"), F.lit(1e-6))
    return joined.withColumn("abs_residual", residual).withColumn("rel_drift", relative).withColumn(
        "drift_flag", lut_flag(F.col("rel_drift"))
    )


def concept_bins(df: DataFrame, lut: DataFrame, keys: Sequence[str], temp: str, signal: str) -> DataFrame:
    """Relative distance of the bin median to the training value, bins with at least ten rows."""
    compared = lut_actual_vs_expected(df, lut, keys, temp, signal).where(F.col("infer_n_samples") >= MIN_DRIFT_ROWS)
    ratio = F.abs("abs_residual") / F.greatest(F.col("expected_signal"), F.lit(1e-6))
    return compared.withColumn("drift_ratio", F.round(ratio, 4))


def drift_report(df: DataFrame, lut: DataFrame, keys: Sequence[str], ts: str, temp: str, signal: str) -> DataFrame:
    """All drift dimensions of each key: covariate, concept (weighted, worst, top three), hour skew."""
    schema = [*keys, "dimension", "rank", "train_ref", "infer_obs", "drift_ratio", "n"]
    overall = lut.where("bin_id < 0").select(*keys, F.col("expected_signal").alias("train_ref"))
    observed = df.groupBy(*keys).agg(F.avg(signal).alias("infer_obs"), F.count(F.lit(1)).alias("n"))
    ratio = F.abs(F.col("infer_obs") - F.col("train_ref")) / F.greatest(F.col("train_ref"), F.lit(1e-6))
    covariate = observed.join(overall, list(keys)).select(
        *keys, F.lit("covariate/bus_signal_mean").alias("dimension"), F.lit(1).alias("rank"),
        F.round("train_ref", 2).alias("train_ref"), F.round("infer_obs", 2).alias("infer_obs"), F.round(ratio, 4).alias("drift_ratio"), "n",
    )
    bins = concept_bins(df, lut, keys, temp, signal)
    order = Window.partitionBy(*keys).orderBy(F.desc("drift_ratio"), "bin_id")
    ranked = bins.select(
        *keys, F.round("expected_signal", 1).alias("train_ref"), F.round("infer_median_signal", 1).alias("infer_obs"),
        "drift_ratio", F.col("infer_n_samples").alias("n"), F.row_number().over(order).alias("rank"),
    )
    weighted = ranked.groupBy(*keys).agg(
        F.round(F.sum(F.col("drift_ratio") * F.col("n")) / F.sum("n"), 4).alias("drift_ratio"), F.sum("n").alias("n")
    ).select(
        *keys, F.lit("concept/temp_power_weighted").alias("dimension"), F.lit(1).alias("rank"),
        F.lit(None).cast("double").alias("train_ref"), F.lit(None).cast("double").alias("infer_obs"), "drift_ratio", "n",
    )
    worst = ranked.where("rank = 1").withColumn("dimension", F.lit("concept/temp_power_worst_bin")).select(*schema)
    detail = ranked.where("rank <= 3").withColumn("dimension", F.lit("concept/temp_power_detail")).select(*schema)
    report = covariate.unionByName(weighted).unionByName(worst).unionByName(detail).unionByName(hour_skew(df, keys, ts).select(*schema))
    return report.withColumn("level", drift_level(F.col("drift_ratio")))


def hour_skew(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Share of the busiest hour, reported above 8 %."""
    hours = df.groupBy(*keys, F.hour(ts).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    top = hours.groupBy(*keys).agg((F.max("_n") / F.sum("_n")).alias("infer_obs"), F.sum("_n").alias("n"))
    even = F.lit(1 / 24)
    return top.where(F.col("infer_obs") > 0.08).select(
        *keys, F.lit("time/hour_skew").alias("dimension"), F.lit(1).alias("rank"), even.alias("train_ref"), "infer_obs",
        F.round((F.col("infer_obs") - even) / even, 4).alias("drift_ratio"), "n",
    )


def switch_decision(report: DataFrame, keys: Sequence[str], calibrated: bool = False, has_fallback: bool = True) -> DataFrame:
    """Mode and main-model weight of each key from its drift report."""
    concept = F.coalesce(F.max(F.when(F.col("dimension").startswith("concept/"), F.abs("drift_ratio"))), F.lit(0.0))
    counts = report.groupBy(*keys).agg(
        F.count_if(F.col("level") == "ALERT").alias("drift_alert_count"),
        F.count_if(F.col("level") == "WARN").alias("drift_warn_count"),
        F.round(concept, 4).alias("max_concept_drift"),
    )
    alert, warn, peak = F.col("drift_alert_count"), F.col("drift_warn_count"), F.col("max_concept_drift")
    mode = (
        F.when((alert >= 3) | (peak >= 0.50), "ALERT").when((alert >= 1) | (warn >= 2) | (peak >= 0.20), "WARN").otherwise("NORMAL")
    )
    weights = {"ALERT": 0.5 if calibrated else 0.0, "WARN": 0.75 if calibrated else 0.6}
    weight = F.lit(1.0)
    if has_fallback:
        weight = F.when(F.col("mode") == "ALERT", weights["ALERT"]).when(F.col("mode") == "WARN", weights["WARN"]).otherwise(1.0)
    out = counts.withColumn("mode", mode).withColumn("main_weight", weight)
    return out.withColumn("use_fallback", F.lit(has_fallback) & (F.col("main_weight") < 1.0))


def blend(df: DataFrame, decisions: DataFrame, keys: Sequence[str], main: str, fallback: str, out: str) -> DataFrame:
    """w·main + (1−w)·fallback with each key's weight (1 where no decision exists); a side without weight may be NULL."""
    joined = attach(df, decisions.select(*keys, F.col("main_weight").alias("_w")), keys)
    w = F.coalesce("_w", F.lit(1.0))
    return joined.withColumn(out, F.when(w >= 1, F.col(main)).when(w <= 0, F.col(fallback)).otherwise(w * F.col(main) + (1 - w) * F.col(fallback))).drop("_w")


def batch_moments(df: DataFrame, keys: Sequence[str], batch: str, columns: Sequence[str]) -> DataFrame:
    """Mergeable (n, Σx, Σx²) per key, batch and column: the input of running statistics."""
    sums = []
    for c in columns:
        sums += [F.sum(c).alias(f"{c}_s1"), F.sum(F.col(c) * F.col(c)).alias(f"{c}_s2")]
    return df.groupBy(*keys, batch).agg(F.count(F.lit(1)).alias("n"), *sums)


def running_stats(df: DataFrame, keys: Sequence[str], batch: str, column: str, alpha: float = 0.01) -> DataFrame:
    """Running mean and deviation after each batch (a day), and the EMA of batch means.

    Windows run over batches of a key, a series bounded by the calendar.
    """
    per_batch = df.where(F.col(column).isNotNull()).groupBy(*keys, batch).agg(
        F.count(column).alias("n"), F.avg(column).alias("_m"), F.var_pop(column).alias("_v")
    )
    w = Window.partitionBy(*keys).orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    total, s1 = F.sum("n").over(w), F.sum(F.col("n") * F.col("_m")).over(w)
    s2 = F.sum(F.col("n") * (F.col("_v") + F.col("_m") * F.col("_m"))).over(w)
    out = per_batch.withColumn("n_seen", total).withColumn("mean", s1 / total)
    out = out.withColumn("std", F.when(total > 1, F.sqrt(F.greatest((s2 - s1 * s1 / total) / (total - 1), F.lit(0.0)))).otherwise(1.0))
    halflife = math.log(0.5) / math.log(1.0 - alpha)
    days = Series(tuple(keys), batch, chunk_s=365 * DAY)
    return ema(out, days, {"mean_ema": ("_m", halflife)}).select(*keys, batch, "n_seen", "mean", "std", "mean_ema")


def drift_score(stats: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """|EMA − training mean| in training deviations."""
    joined = stats.join(reference, list(keys))
    return joined.withColumn("drift_score", F.abs(F.col("mean_ema") - F.col("train_mean")) / F.greatest("train_std", F.lit(1e-6)))
