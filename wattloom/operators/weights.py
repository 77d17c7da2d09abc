"""Sample weights for training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.operators.quantiles import percentiles, running_counts
from wattloom.operators.series import attach
from wattloom.session import cut_lineage


def inverse_density(
    df: DataFrame, keys: Sequence[str], value: str, n_bins: int = 20, cap_quantile: float = 0.95, floor_ratio: float = 0.1, out: str = "weight"
) -> DataFrame:
    """One over the rows in a value's bin, capped at a quantile, floored, scaled to mean 1.

    Everything after the bin counts happens on the (key, bin) table, at most `n_bins` rows per key,
    which is checkpointed because the steps read it repeatedly.
    """
    span = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = (F.col("_hi") + 1e-6 - F.col("_lo")) / n_bins
    binned = attach(df, span, keys).withColumn(
        "_bin", F.least(F.greatest(F.floor((F.col(value) - F.col("_lo")) / width), F.lit(0)), F.lit(n_bins - 1)).cast("int")
    )
    group = [*keys, "_bin"]
    table = binned.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("_hi") <= F.col("_lo")).alias("_flat"))
    table = cut_lineage(table.withColumn("_w", 1.0 / F.greatest(F.col("_n").cast("double"), F.lit(1e-3))))
    counted = running_counts(table, keys, "_w", {"n": F.sum("_n")})
    rank = (F.col("n_all") - 1) * F.lit(cap_quantile)

    def at(r: Column) -> Column:
        return F.max(F.when((F.col("n_below") <= r) & (r < F.col("n_below") + F.col("n")), F.col("_w")))

    cap = counted.groupBy(*keys).agg(at(F.floor(rank)).alias("_a"), at(F.ceil(rank)).alias("_b"), F.max("n_all").alias("_all"))
    share = (F.col("_all") - 1) * F.lit(cap_quantile)
    cap = cap.select(*keys, "_all", (F.col("_a") + (F.col("_b") - F.col("_a")) * (share - F.floor(share))).alias("_cap"))
    capped = table.join(cap, list(keys)).withColumn("_w", F.least("_w", "_cap"))
    level = capped.groupBy(*keys).agg((F.sum(F.col("_n") * F.col("_w")) / F.max("_all")).alias("_mean"))
    floored = capped.join(level, list(keys)).withColumn("_w", F.greatest(F.col("_w"), F.col("_mean") * floor_ratio))
    scale = floored.groupBy(*keys).agg((F.sum(F.col("_n") * F.col("_w")) / F.max("_all")).alias("_scale"))
    final = floored.join(scale, list(keys)).select(
        *keys, "_bin", F.when(F.col("_flat"), F.lit(1.0)).otherwise(F.col("_w") / F.col("_scale")).alias(out)
    )
    return binned.drop("_lo", "_hi").join(final, group).drop("_bin")


def weight_summary(df: DataFrame, keys: Sequence[str], value: str, weight: str = "weight", n_bins: int = 5) -> DataFrame:
    """Rows and mean weight per value quantile (the last bin is closed)."""
    points = {f"_q{i}": i / n_bins for i in range(n_bins + 1)}
    edges = percentiles(df, keys, value, points).drop("n")
    joined = attach(df.select(*keys, value, weight), edges, keys)
    bin_id = F.lit(None).cast("int")
    for i in range(n_bins):
        upper = F.col(value) <= F.col(f"_q{i + 1}") if i == n_bins - 1 else F.col(value) < F.col(f"_q{i + 1}")
        bin_id = F.when((F.col(value) >= F.col(f"_q{i}")) & upper, F.lit(i)).otherwise(bin_id)
    low = F.coalesce(*[F.when(F.col("bin_id") == i, F.col(f"_q{i}")) for i in range(n_bins)])
    high = F.coalesce(*[F.when(F.col("bin_id") == i, F.col(f"_q{i + 1}")) for i in range(n_bins)])
    binned = joined.withColumn("bin_id", bin_id).where("bin_id IS NOT NULL")
    return binned.groupBy(*keys, "bin_id").agg(
        F.max(low).alias("low"), F.max(high).alias("high"), F.count(F.lit(1)).alias("n"), F.avg(weight).alias("avg_weight")
    )


def boundary_focal(df: DataFrame, keys: Sequence[str], proxy: str, predicted: str | None = None, gamma: float = 2.0, alpha: float = 0.25, out: str = "weight") -> DataFrame:
    """More weight near the decision boundary, or on rows a first model gets wrong; mean 1.

    Without predictions a proxy outside [−0.5, 1.5] (watts) is squashed around its median first.
    """
    eps = 1e-6
    p = F.col(proxy)
    if predicted is not None:
        right = F.when(p >= 0.5, F.col(predicted)).otherwise(1.0 - F.col(predicted))
        right = F.least(F.greatest(right, F.lit(eps)), F.lit(1.0 - eps))
        weighted = df.withColumn("_w", alpha * F.pow(1.0 - right, F.lit(gamma)) + (1.0 - alpha))
    else:
        span = df.groupBy(*keys).agg(((F.max(p) > 1.5) | (F.min(p) < -0.5)).alias("_raw"))
        middle = percentiles(df, keys, proxy, {"_med": 0.5}).drop("n")
        centred = attach(df, span.join(middle, list(keys)), keys).withColumn("_dev", F.abs(p - F.col("_med")))
        spread = percentiles(centred, keys, "_dev", {"_mad": 0.5}).drop("n")
        known = attach(centred, spread, keys)
        squashed = 1.0 / (1.0 + F.exp(-(p - F.col("_med")) / ((F.col("_mad") + eps) * 0.8)))
        plain = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
        distance = F.abs(F.when(F.col("_raw"), squashed).otherwise(plain) - 0.5)
        weighted = known.withColumn("_w", 1.0 + alpha * F.exp(-distance * distance / (2.0 * 0.15 * 0.15)))
        weighted = weighted.drop("_raw", "_med", "_dev", "_mad")
    mean = weighted.groupBy(*keys).agg(F.greatest(F.avg("_w"), F.lit(eps)).alias("_mean"))
    return attach(weighted, mean, keys).withColumn(out, F.col("_w") / F.col("_mean")).drop("_w", "_mean")


def small_data_settings(n: Column) -> Column:
    """Booster settings by training rows."""

    def setting(trees: int, depth: int, rate: float, sample: float, leaf: int) -> Column:
        return F.struct(
            F.lit(trees).alias("trees"), F.lit(depth).alias("depth"), F.lit(rate).alias("rate"),
            F.lit(sample).alias("sample"), F.lit(leaf).alias("min_leaf"),
        )

    return (
        F.when(n < 500, setting(100, 2, 0.08, 0.9, 8))
        .when(n < 1500, setting(200, 3, 0.06, 0.85, 5))
        .when(n < 3000, setting(300, 3, 0.05, 0.8, 3))
        .otherwise(setting(300, 3, 0.05, 0.8, 2))
    )
