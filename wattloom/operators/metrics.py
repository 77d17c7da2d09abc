"""Accuracy metrics: one partially aggregated pass per grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import over, pearson
from wattloom.operators.quantiles import auc

# Names and order of the reported metrics.
CLASSIFICATION = ("Accuracy", "Precision", "Recall", "F1", "AUC", "TN", "FP", "FN", "TP")
REGRESSION = ("MAE_W", "RMSE_W", "SAE", "NDE", "kWh_true", "kWh_pred", "kWh_err", "n_samples")


def ratio(a: Column, b: Column) -> Column:
    return F.coalesce(over(a, b), F.lit(0.0))


def confusion(true: Column, pred: Column) -> dict[str, Column]:
    return {
        "TN": F.count_if((true == 0) & (pred == 0)),
        "FP": F.count_if((true == 0) & (pred == 1)),
        "FN": F.count_if((true == 1) & (pred == 0)),
        "TP": F.count_if((true == 1) & (pred == 1)),
    }


def from_confusion(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    return {
        "Accuracy": over(tp + tn, tn + fp + fn + tp),
        "Precision": ratio(tp, tp + fp),
        "Recall": ratio(tp, tp + fn),
        "F1": ratio(2.0 * tp, 2 * tp + fp + fn),
    }


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    return ratio((1 + beta * beta) * precision * recall, beta * beta * precision + recall)


def classification_metrics(df: DataFrame, keys: Sequence[str], true: str, pred: str, score: str | None = None) -> DataFrame:
    counts = df.groupBy(*keys).agg(*[c.alias(n) for n, c in confusion(F.col(true), F.col(pred)).items()])
    out = counts.withColumns(from_confusion(F.col("TN"), F.col("FP"), F.col("FN"), F.col("TP")))
    if score is not None:
        area = auc(df.select(*keys, true, score), keys, true, score)
        out = out.join(area, list(keys), "left") if keys else out.withColumn("AUC", area.scalar())
    return out


def regression_columns(true: Column, pred: Column, step_h: float = 0.25, floor: float = 1e-6) -> dict[str, Column]:
    error = pred - true
    return {
        "MAE_W": F.avg(F.abs(error)),
        "RMSE_W": F.sqrt(F.avg(error * error)),
        "SAE": F.abs(F.sum(pred) - F.sum(true)) / F.greatest(F.sum(true), F.lit(floor)),
        "NDE": F.sqrt(F.sum(error * error) / F.greatest(F.sum(true * true), F.lit(floor))),
        "kWh_true": F.sum(true) * step_h / 1000.0,
        "kWh_pred": F.sum(pred) * step_h / 1000.0,
        "kWh_err": (F.sum(pred) - F.sum(true)) * step_h / 1000.0,
        "n_samples": F.count(F.lit(1)),
    }


def regression_metrics(df: DataFrame, keys: Sequence[str], true: str, pred: str, step_h: float = 0.25) -> DataFrame:
    columns = regression_columns(F.col(true), F.col(pred), step_h)
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in columns.items()])


def all_metrics(
    df: DataFrame, keys: Sequence[str], y_true: str, y_pred: str, s_true: str, s_pred: str, score: str | None = None, step_h: float = 0.25
) -> DataFrame:
    """Classification and regression metrics of one grouping in a single aggregation (plus AUC)."""
    columns = {
        **confusion(F.col(s_true), F.col(s_pred)),
        **regression_columns(F.col(y_true), F.col(y_pred), step_h),
    }
    out = df.groupBy(*keys).agg(*[c.alias(n) for n, c in columns.items()])
    out = out.withColumns(from_confusion(F.col("TN"), F.col("FP"), F.col("FN"), F.col("TP")))
    if score is not None:
        area = auc(df.select(*keys, s_true, score), keys, s_true, score)
        out = out.join(area, list(keys), "left") if keys else out.withColumn("AUC", area.scalar())
    return out


def daily_metrics(
    df: DataFrame, keys: Sequence[str], ts: str, y_true: str, y_pred: str, s_true: str, s_pred: str, score: str | None = None, step_h: float = 0.25
) -> DataFrame:
    """Metrics per key and day; SAE is NULL on days with less than 1 Wh of true energy."""
    dated = df.withColumn("date", F.to_date(ts))
    out = all_metrics(dated, [*keys, "date"], y_true, y_pred, s_true, s_pred, score, step_h)
    return out.withColumn("SAE", F.when(F.col("kWh_true") >= 1e-3, F.abs("kWh_err") / F.col("kWh_true"))).drop("NDE")


def leak_ood_metrics(
    df: DataFrame, train_dates: DataFrame, keys: Sequence[str], ts: str, y_true: str, y_pred: str, s_true: str, s_pred: str,
    model: str = "model", main: str = "main", score: str | None = None,
) -> DataFrame:
    """Metrics on training days and on unseen days, per model; only for keys that have leaked rows.

    All models share the main model's classification, so that is aggregated from its rows only.
    """
    days = train_dates.select(*keys, F.col("date").alias("_date")).distinct().withColumn("_seen", F.lit(True))
    flagged = df.withColumn("_date", F.to_date(ts)).join(days, [*keys, "_date"], "left")
    flagged = flagged.withColumn("split", F.when(F.col("_seen"), "inference_leak").otherwise("inference_ood"))
    group = [*keys, "split"]
    classes = classification_metrics(flagged.where(F.col(model) == main), group, s_true, s_pred, score)
    powers = regression_metrics(flagged, [*group, model], y_true, y_pred)
    both = powers.join(classes, group, "left")
    leaked = both.where("split = 'inference_leak'").select(*keys).distinct() if keys else None
    return both.join(leaked, list(keys), "left_semi") if keys else both


def leak_ood_days(df: DataFrame, train_dates: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows and sorted day lists on either side; a list is bounded by the days of the period."""
    days = train_dates.select(*keys, "date").distinct().withColumn("_seen", F.lit(True))
    daily = df.groupBy(*keys, F.to_date(ts).alias("date")).agg(F.count(F.lit(1)).alias("_n"))
    flagged = daily.join(days, [*keys, "date"], "left")
    text = F.date_format("date", "yyyy-MM-dd")
    return flagged.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("_seen"), F.col("_n"))), F.lit(0)).alias("n_leak"),
        F.coalesce(F.sum(F.when(F.col("_seen").isNull(), F.col("_n"))), F.lit(0)).alias("n_ood"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("_seen"), text))), ",").alias("leak_dates"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("_seen").isNull(), text))), ",").alias("ood_dates"),
    )


def metric_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Wide metrics to long rows (metric_type, metric, value)."""
    present = [c for c in (columns or [*CLASSIFICATION, *REGRESSION]) if c in df.columns]
    cast = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in present])
    long = cast.unpivot(list(keys), present, "metric", "value")
    kind = F.when(F.col("metric").isin(*CLASSIFICATION), "classification").otherwise("regression")
    return long.select(*keys, kind.alias("metric_type"), "metric", "value")


def comparison_table(rows: DataFrame, models: Sequence[str], keys: Sequence[str] = (), include: Sequence[str] = ()) -> DataFrame:
    """Metric × model; columns with "main" first, the others by name."""
    if include:
        rows = rows.where(F.col("metric").isin(*include))
    main = [m for m in sorted(models) if "main" in m.lower()]
    order = [*main, *sorted(set(models) - set(main))]
    wide = rows.groupBy(*keys, "metric_type", "metric").pivot("model", order).agg(F.first("value", True))
    return wide.select(*keys, "metric_type", "metric", *[F.col(f"`{m}`") for m in order])


def split_pivot(rows: DataFrame, splits: Sequence[str] = ("train", "val", "test"), keys: Sequence[str] = ()) -> DataFrame:
    return rows.groupBy(*keys, "model", "metric_type", "metric").pivot("split", list(splits)).agg(F.first("value", True))


def latest_snapshot(rows: DataFrame, keys: Sequence[str] = (), order: Sequence[str] = ("timestamp",)) -> DataFrame:
    """Rows of the last written version, the newest row per (split, model, source, type, metric).

    The last version is found by an aggregate; newest-per-key is an aggregate too (no sort of a group).
    """
    last = rows.where(F.col("project_version").isNotNull()).agg(F.max_by("project_version", F.struct(*order))).scalar()
    version = rows.where(F.col("project_version") == last)
    group = [*keys, "split", "model", "source", "metric_type", "metric"]
    return version.groupBy(*group).agg(
        F.max(order[0]).alias(order[0]), F.max_by("value", F.struct(*order)).alias("value"), F.max("project_version").alias("project_version")
    )


def model_consistency(df: DataFrame, keys: Sequence[str], main: str, baseline: str, on_w: float = 10.0) -> DataFrame:
    """Agreement of each baseline with the main model where no labels exist."""
    agree = ((F.col(main) >= on_w) == (F.col(baseline) >= on_w)).cast("double")
    return df.groupBy(*keys).agg(
        F.avg(F.abs(F.col(main) - F.col(baseline))).alias("MAE_vs_main_W"),
        pearson(F.col(main), F.col(baseline)).alias("Pearson_vs_main"),
        F.avg(agree).alias("state_agree_rate"),
        F.count(F.lit(1)).alias("n_samples"),
    )


# Thresholds of the search grid, in hundredths.
GRID = tuple(range(2, 96))


def threshold_counts(df: DataFrame, keys: Sequence[str], score: str, true: str, grid: Sequence[float]) -> DataFrame:
    """Confusion counts at every threshold of an ascending grid.

    Each row falls into one of len(grid)+1 score cells, so the table is reduced to a small histogram
    per key in one pass instead of being copied once per threshold.
    """
    levels = F.array(*[F.lit(float(t)) for t in grid])
    reached = F.expr(" + ".join(f"CAST(`{score}` >= {float(t)!r}D AS INT)" for t in grid))
    cells = df.withColumn("_cell", reached).groupBy(*keys, "_cell").agg(
        F.count_if(F.col(true) == 1).alias("_p"), F.count_if(F.col(true) == 0).alias("_n")
    )
    totals = cells.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_cell", F.struct("_p", "_n")))).alias("_hist"),
        F.sum("_p").alias("_P"),
        F.sum("_n").alias("_N"),
    )
    spread = totals.select(*keys, "_hist", "_P", "_N", F.posexplode(levels).alias("_i", "threshold"))

    def above(field: str) -> Column:
        hits = F.filter(F.map_entries("_hist"), lambda e: e["key"] > F.col("_i"))
        return F.aggregate(hits, F.lit(0).cast("long"), lambda acc, e: acc + e["value"][field])

    return spread.select(
        *keys,
        "threshold",
        above("_p").alias("TP"),
        above("_n").alias("FP"),
        (F.col("_P") - above("_p")).alias("FN"),
        (F.col("_N") - above("_n")).alias("TN"),
    )


def threshold_curve(df: DataFrame, keys: Sequence[str], score: str, true: str, grid: Sequence[float] | None = None, beta: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and F-beta at every threshold."""
    grid = [t / 100 for t in GRID] if grid is None else list(grid)
    counts = threshold_counts(df, keys, score, true, grid)
    scored = counts.withColumns(from_confusion(F.col("TN"), F.col("FP"), F.col("FN"), F.col("TP")))
    return scored.withColumn("f_beta", f_beta(F.col("Precision"), F.col("Recall"), beta))


def best_threshold(curve: DataFrame, keys: Sequence[str], by: str = "f_beta") -> DataFrame:
    """Highest value, the lowest threshold on ties."""
    best = F.max(F.struct(F.col(by).alias("v"), (-F.col("threshold")).alias("t"))).alias("_best")
    return curve.groupBy(*keys).agg(best).select(*keys, (-F.col("_best.t")).alias("best_thr"), F.col("_best.v").alias("best_score"))
