"""Two-stage model: ON/OFF classifier, season experts for power, corrections and baselines.

Models are fitted once for all users (MLlib distributes each fit); user-level differences enter
through features, thresholds and the correction steps. Loops below run over the three seasons only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, IsotonicRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.scalars import SEASONS, season_by_month
from wattloom.operators.metrics import best_threshold, threshold_curve
from wattloom.operators.quantiles import percentiles
from wattloom.operators.segments import filter_short_runs
from wattloom.operators.series import Series
from wattloom.operators.weights import small_data_settings
from wattloom.plans.bands import LeafBands, banded, fit_leaf_bands
from wattloom.session import cut_lineage

BAND_INPUTS = ("features", "_power", "_season_id")
MIN_EXPERT_ROWS = 50
MIN_CALIBRATION_ROWS = 30
CORRECTION_CAP_W = 150.0
NAIVE_MEAN_W = 500.0


@dataclass(frozen=True)
class Settings:
    trees: int = 300
    depth: int = 3
    rate: float = 0.05
    sample: float = 0.8
    forest_trees: int = 300
    forest_depth: int = 8
    correction_trees: int = 50
    band_trees: int = 50
    band_depth: int = 5
    seed: int = 42
    # Fewest rows of a leaf of the boosters; `adapt` sets it, and trees, depth, rate and sample, by the number of training rows.
    min_leaf: int = 1
    adapt: bool = False
    min_on: int = 1
    fill: int = 3
    beta: float = 0.5
    ensemble: bool = False
    probability_calibration: str = "none"
    season_calibration: str = "none"


@dataclass
class TwoStageModel:
    """Fitted parts; `score` adds every track to a feature table."""

    features: list[str]
    prepare: PipelineModel
    classifier: Transformer
    second_classifier: Transformer | None
    probability: Transformer | None
    threshold: float
    experts: dict[str, Transformer]
    fallback: Transformer
    bands: LeafBands | None
    forest: Transformer | None
    naive_mean: float
    correction: Transformer | None = None
    correction_cap: float = CORRECTION_CAP_W
    season_maps: dict[str, Transformer | tuple[float, float]] = field(default_factory=dict)


def assemble(df: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Vector of the features and its standardised form, fitted on the given rows only."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="error")
    scaler = StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)
    return PipelineModel([assembler, scaler.fit(assembler.transform(df))])


def _classifier(settings: Settings, **options):
    return GBTClassifier(
        featuresCol="features", labelCol="state", maxIter=settings.trees, maxDepth=settings.depth, stepSize=settings.rate,
        subsamplingRate=settings.sample, minInstancesPerNode=settings.min_leaf, seed=settings.seed, checkpointInterval=25, **options,
    )


def _regressor(settings: Settings, label: str, trees: int | None = None, inputs: str = "features", out: str = "_power", **options):
    return GBTRegressor(
        featuresCol=inputs, labelCol=label, maxIter=trees or settings.trees, maxDepth=settings.depth, stepSize=settings.rate,
        subsamplingRate=settings.sample, minInstancesPerNode=settings.min_leaf, seed=settings.seed, lossType="absolute", predictionCol=out, checkpointInterval=25, **options,
    )


def probability_of(df: DataFrame, model: Transformer, out: str) -> DataFrame:
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array("probability")[1]).drop("probability", "rawPrediction", "prediction")


def expert_summary(df: DataFrame, season: str = "season", label: str = "y", state: str = "state") -> DataFrame:
    """ON rows, mean, deviation and median per season, and whether a season gets its own expert."""
    on = df.where(F.col(state) == 1)
    stats = on.groupBy(season).agg(F.count(F.lit(1)).alias("n_on"), F.avg(label).alias("y_mean"), F.stddev_pop(label).alias("y_std"))
    middle = percentiles(on, [season], label, {"y_median": 0.5}).drop("n")
    grid = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in SEASONS])).alias(season))
    wide = grid.join(stats, season, "left").join(middle, season, "left").fillna({"n_on": 0})
    return wide.withColumn("status", F.when(F.col("n_on") >= MIN_EXPERT_ROWS, "trained").otherwise("fallback"))


# A boosting round passes over all partitions several times; small ones cost more to schedule than to read.
ROWS_PER_TASK = 50_000


def sized(df: DataFrame) -> DataFrame:
    """The rows in as many partitions as their number calls for, at most as many as they have."""
    return df.coalesce(max(1, -(-df.count() // ROWS_PER_TASK)))


def adapted(settings: Settings, rows: int, spark: SparkSession) -> Settings:
    """Booster settings for so many training rows: fewer, shallower and larger-leaved trees for little data."""
    own = spark.range(1).select(small_data_settings(F.lit(rows)).alias("s")).first()["s"]
    return replace(settings, **own.asDict())


def at_once(jobs: Mapping[str, Callable]) -> dict:
    """Results of functions that do not need each other, run side by side: a boosting round is many short jobs, and those of
    one model leave most of the cluster idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = {name: pool.submit(inheritable_thread_target(job)) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


def fit(
    train: DataFrame, val: DataFrame, features: Sequence[str], series: Series, settings: Settings = Settings(), weight: str | None = None,
) -> TwoStageModel:
    """Fit all parts. Inputs hold the features, `y` (W), `state`, `season` and the series columns.

    Give it materialised tables (see `session.cut_lineage`): tree fits read them many times.
    """
    train = sized(train)
    if settings.adapt:
        settings = adapted(settings, train.count(), train.sparkSession)
    prepare = assemble(train, features)
    weights = {"weightCol": weight} if weight else {}
    ready = prepare.transform(train)
    on = ready.where("state = 1")
    summary = {r["season"]: r for r in expert_summary(train).collect()}
    own = [s for s in SEASONS if summary[s]["status"] == "trained"]
    forest_settings = {"featuresCol": "features", "numTrees": settings.forest_trees, "maxDepth": settings.forest_depth, "seed": settings.seed}
    jobs: dict[str, Callable] = {
        "classifier": lambda: _classifier(settings, **weights).fit(ready),
        "fallback": lambda: _regressor(settings, "y", **weights).fit(on),
        "forest": lambda: RandomForestRegressor(labelCol="y", predictionCol="_power", **forest_settings).fit(ready),
    }
    if settings.ensemble:
        jobs["second"] = lambda: RandomForestClassifier(labelCol="state", **forest_settings).fit(ready)
    for s in own:
        jobs[f"expert {s}"] = lambda s=s: _regressor(settings, "y", **weights).fit(on.where(F.col("season") == s))
    done = at_once(jobs)
    experts = {s: done[f"expert {s}"] for s in own}
    fallback = done["fallback"]
    trained_means = [summary[s]["y_mean"] for s in experts]
    naive = sum(trained_means) / len(trained_means) if trained_means else NAIVE_MEAN_W
    model = TwoStageModel(list(features), prepare, done["classifier"], done.get("second"), None, 0.5, experts, fallback, None, done["forest"], float(naive))

    def fit_bands() -> LeafBands:
        residuals = route(on, experts, fallback).withColumns({"_res": F.col("y") - F.col("_power"), "_season_id": season_id()})
        return fit_leaf_bands(cut_lineage(residuals.select(*BAND_INPUTS, "_res")), "_res", BAND_INPUTS, settings.band_trees, settings.band_depth, seed=settings.seed)

    def fit_threshold() -> float:
        # Scores are written before they are used: each use would run all trees again.
        checked = cut_lineage(stage_one(val, model))
        if settings.probability_calibration != "none":
            model.probability = fit_probability(checked, settings.probability_calibration)
            checked = cut_lineage(calibrated_probability(checked, model.probability))
        return choose_threshold(checked, series, settings)

    done = at_once({"bands": fit_bands, "threshold": fit_threshold})
    model.bands, model.threshold = done["bands"], done["threshold"]
    scored = cut_lineage(score_base(val, model, series, settings))
    fit_correction(model, scored, settings)
    if settings.season_calibration != "none":
        model.season_maps = fit_season_maps(scored, settings.season_calibration)
    return model


def stage_one(df: DataFrame, model: TwoStageModel) -> DataFrame:
    """ON probability: the classifier, averaged 0.6 / 0.4 with a second one, then calibrated."""
    ready = model.prepare.transform(df)
    scored = probability_of(ready, model.classifier, "p_on")
    if model.second_classifier is not None:
        scored = probability_of(scored, model.second_classifier, "_p2").withColumn("p_on", 0.6 * F.col("p_on") + 0.4 * F.col("_p2")).drop("_p2")
    if model.probability is not None:
        scored = calibrated_probability(scored, model.probability)
    return scored


def fit_probability(df: DataFrame, method: str) -> Transformer:
    """Isotonic or logistic map from score to probability, learned on validation rows."""
    if method == "isotonic":
        return IsotonicRegression(featuresCol="p_on", labelCol="state", predictionCol="_cal").fit(df.withColumn("state", F.col("state").cast("double")))
    inputs = VectorAssembler(inputCols=["p_on"], outputCol="_pv").transform(df)
    return LogisticRegression(featuresCol="_pv", labelCol="state").fit(inputs)


def calibrated_probability(df: DataFrame, probability: Transformer) -> DataFrame:
    if "IsotonicRegression" in type(probability).__name__:
        return probability.transform(df).withColumn("p_on", F.col("_cal")).drop("_cal")
    inputs = VectorAssembler(inputCols=["p_on"], outputCol="_pv").transform(df)
    return probability_of(inputs, probability, "p_on").drop("_pv")


def choose_threshold(val: DataFrame, series: Series, settings: Settings) -> float:
    """Best F-beta threshold with the short-run filters applied, over all validation rows."""
    rows = filter_short_runs(val.select(*series.key, *series.order, "p_on", "state"), series, "p_on", "_score", settings.min_on, settings.fill, scores=True)
    best = best_threshold(threshold_curve(rows, [], "_score", "state", beta=settings.beta), []).first()
    return float(best["best_thr"]) if best is not None and best["best_thr"] is not None else 0.5


def route(df: DataFrame, experts: Mapping[str, Transformer], fallback: Transformer) -> DataFrame:
    """Power from the season's expert, from the pooled model where a season has none."""
    known = list(experts)
    # A row without a season takes the pooled model too.
    rest = df.where(~F.coalesce(F.col("season").isin(known), F.lit(False))) if known else df
    out = fallback.transform(rest)
    for s, expert in experts.items():
        out = out.unionByName(expert.transform(df.where(F.col("season") == s)))
    return out


def score_base(df: DataFrame, model: TwoStageModel, series: Series, settings: Settings) -> DataFrame:
    """Classifier, experts and short-run filters: state_pred, p_on, y_raw and its band."""
    first = stage_one(df, model)
    powered = route(first, model.experts, model.fallback).withColumns({"_p50": F.greatest("_power", F.lit(0.0)), "_season_id": season_id()})
    ranged = banded(powered, model.bands, {"_low": 0.10, "_high": 0.90})
    states = ranged.withColumn("_state", (F.col("p_on") >= model.threshold).cast("int")).drop("_raw", "features", "_power", "_season_id")
    filtered = filter_short_runs(states, series, "_state", "state_pred", settings.min_on, settings.fill)
    return filtered.withColumns(
        {
            "y_raw": F.col("state_pred") * F.col("_p50"),
            "y_low": F.col("state_pred") * F.greatest(F.col("_p50") + F.coalesce("_low", F.lit(0.0)), F.lit(0.0)),
            "y_high": F.col("state_pred") * F.greatest(F.col("_p50") + F.coalesce("_high", F.lit(0.0)), F.lit(0.0)),
        }
    ).drop("_state", "_p50", "_low", "_high")


def season_id(season: str = "season") -> Column:
    return F.when(F.col(season) == "summer", 0.0).when(F.col(season) == "winter", 2.0).otherwise(1.0)


def correction_inputs(df: DataFrame, recent: str = "power_recent_24h_mean") -> DataFrame:
    temp = F.coalesce(F.col("temp_2m"), F.lit(20.0)) if "temp_2m" in df.columns else F.lit(20.0)
    near = F.coalesce(F.col(recent), F.lit(0.0)) if recent in df.columns else F.lit(0.0)
    wide = df.withColumns({"_temp": temp, "_recent": near, "_season_id": season_id()})
    inputs = VectorAssembler(inputCols=["_temp", "hour", "_recent", "_season_id", "y_raw"], outputCol="_five")
    return inputs.transform(wide).drop("_temp", "_recent", "_season_id")


def fit_correction(model: TwoStageModel, scored: DataFrame, settings: Settings) -> None:
    """Small booster for the residual of predicted-ON validation rows; its reach is capped."""
    rows = correction_inputs(scored.where("state_pred = 1 AND y > 0")).withColumn("_delta", F.col("y") - F.col("y_raw"))
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs("_delta")).alias("mae")).first()
    if stats["n"] < MIN_CALIBRATION_ROWS:
        return
    model.correction_cap = min(2.0 * stats["mae"], CORRECTION_CAP_W)
    model.correction = _regressor(settings, "_delta", settings.correction_trees, "_five", "_fix").fit(rows)


def corrected(df: DataFrame, model: TwoStageModel) -> DataFrame:
    """`y_calib`: the capped correction on ON rows, never below zero."""
    if model.correction is None:
        return df.withColumn("y_calib", F.col("y_raw"))
    fixed = model.correction.transform(correction_inputs(df))
    cap = model.correction_cap
    delta = F.when(F.col("state_pred") == 1, F.least(F.greatest("_fix", F.lit(-cap)), F.lit(cap))).otherwise(0.0)
    return fixed.withColumn("y_calib", F.greatest(F.col("y_raw") + delta, F.lit(0.0))).drop("_fix", "_five")


def fit_season_maps(scored: DataFrame, method: str) -> dict[str, Transformer | tuple[float, float]]:
    """Per season a monotone or straight-line map of ON predictions to true power; else identity."""
    rows = scored.where("state = 1 AND y_raw > 0")
    lines = season_lines(rows, "season", "y_raw", "y").collect()
    out: dict[str, Transformer | tuple[float, float]] = {}
    for line in lines:
        if line["n"] < MIN_CALIBRATION_ROWS:
            continue
        if method == "linear":
            out[line["season"]] = (line["intercept"], line["slope"])
        else:
            mine = rows.where(F.col("season") == line["season"])
            out[line["season"]] = IsotonicRegression(featuresCol="y_raw", labelCol="y", predictionCol="_iso").fit(mine)
    return out


def season_lines(df: DataFrame, season: str, x: str, y: str) -> DataFrame:
    return df.groupBy(season).agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")
    )


def linear_calibration(df: DataFrame, lines: DataFrame, season: str, value: str, on: Column, out: str) -> DataFrame:
    """Straight-line correction of ON rows, floor 0; seasons with under 30 rows keep their value."""
    joined = df.join(F.broadcast(lines.where(F.col(season).isin(*SEASONS))), season, "left")
    line = F.greatest(F.col("intercept") + F.col("slope") * F.col(value), F.lit(0.0))
    return joined.withColumn(out, F.when(on & (F.col("n") >= MIN_CALIBRATION_ROWS), line).otherwise(F.col(value))).drop("n", "slope", "intercept")


def season_mapped(df: DataFrame, maps: Mapping[str, Transformer | tuple[float, float]], value: str = "y_raw", out: str = "y_season") -> DataFrame:
    known = list(maps)
    apply = F.coalesce((F.col("state_pred") == 1) & F.col("season").isin(known), F.lit(False)) if known else F.lit(False)
    result = df.where(~apply).withColumn(out, F.col(value))
    for s, m in maps.items():
        mine = df.where((F.col("state_pred") == 1) & (F.col("season") == s))
        if isinstance(m, tuple):
            mapped = mine.withColumn(out, F.greatest(m[0] + m[1] * F.col(value), F.lit(0.0)))
        else:
            mapped = m.transform(mine).withColumn(out, F.greatest("_iso", F.lit(0.0))).drop("_iso")
        result = result.unionByName(mapped)
    return result


def baselines(df: DataFrame, model: TwoStageModel) -> DataFrame:
    """Comparison predictions: zero, ON mean, pooled regressor behind the main state, plain forest."""
    ready = model.prepare.transform(df)
    pooled = model.fallback.transform(ready).withColumn("y_fallback", F.col("state_pred") * F.greatest("_power", F.lit(0.0))).drop("_power")
    wide = pooled
    if model.forest is not None:
        wide = model.forest.transform(wide).withColumn("y_rf", F.greatest("_power", F.lit(0.0))).drop("_power")
    return wide.withColumn("y_naive_zero", F.lit(0.0)).withColumn("y_naive_mean", F.col("state_pred") * model.naive_mean).drop("_raw", "features")


def score(df: DataFrame, model: TwoStageModel, series: Series, settings: Settings = Settings()) -> DataFrame:
    """All tracks side by side: y_raw, y_calib, season map and baselines."""
    base = corrected(score_base(df, model, series, settings), model)
    if model.season_maps:
        base = season_mapped(base, model.season_maps)
    return baselines(base, model)


def long_tracks(scored: DataFrame, keys: Sequence[str], tracks: Mapping[str, str]) -> DataFrame:
    """One row per step and model."""
    pairs = F.array(*[F.struct(F.lit(name).alias("model"), F.col(c).cast("double").alias("y_pred")) for name, c in tracks.items()])
    return scored.select(*keys, F.inline(pairs))


def naive_predictions(df: DataFrame, summary: DataFrame, state: str) -> DataFrame:
    """Zero, and the mean of the trained seasons' means behind the predicted state (500 W without any)."""
    mean = summary.where("status = 'trained'").agg(F.coalesce(F.avg("y_mean"), F.lit(NAIVE_MEAN_W))).scalar()
    return df.withColumn("y_naive_zero", F.lit(0.0)).withColumn("y_naive_mean", F.col(state) * mean)


def importances(model: Transformer, features: Sequence[str], df: DataFrame, k: int = 20) -> DataFrame:
    """The k most important features of a fitted tree model (a list as long as the feature names)."""
    rows = [(name, float(v)) for name, v in zip(features, model.featureImportances.toArray(), strict=True)]
    table = df.sparkSession.createDataFrame(rows, "feature STRING, importance DOUBLE")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def sanity(scored: DataFrame, keys: Sequence[str], y_true: str, y_pred: str, s_true: str, s_pred: str, min_rows: int = 300, min_f1: float = 0.7, max_mae: float = 300.0) -> DataFrame:
    """Checks of a scored table and the list of those that failed."""
    tp = F.count_if((F.col(s_true) == 1) & (F.col(s_pred) == 1))
    wrong = F.count_if(F.col(s_true) != F.col(s_pred))
    bad_power = F.col(y_pred).isNull() | F.isnan(y_pred) | (F.col(y_pred) < 0) | (F.abs(F.col(y_pred)) == float("inf"))
    stats = scored.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col(s_pred).isin(0, 1)).alias("n_bad_state"),
        F.count_if(bad_power).alias("n_bad_power"),
        F.coalesce(2.0 * tp / F.when(2 * tp + wrong > 0, 2 * tp + wrong), F.lit(0.0)).alias("F1"),
        F.avg(F.abs(F.col(y_pred) - F.col(y_true))).alias("MAE_W"),
    )
    checks = F.array_compact(
        F.array(
            F.when(F.col("n_rows") < min_rows, "too_few_rows"),
            F.when(F.col("n_bad_state") > 0, "bad_state"),
            F.when(F.col("n_bad_power") > 0, "bad_power"),
            F.when(F.col("F1") < min_f1, "low_f1"),
            F.when(F.col("MAE_W") > max_mae, "high_mae"),
        )
    )
    return stats.withColumn("failed", checks).withColumn("passed", F.size("failed") == 0)


def with_season(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("season", season_by_month(F.col(ts)))
