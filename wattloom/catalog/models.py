"""Model training and scoring on the hourly site series; tree models have no SQL twin."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.catalog.drifts import _report as site_drift
from wattloom.catalog.features import feature_rows
from wattloom.catalog.guards import _meta as guard_meta
from wattloom.catalog.guards import spikes
from wattloom.catalog.registry import query
from wattloom.catalog.scores import SQL_LONG, long_scores
from wattloom.catalog.views import SITE_HOURS, SQL_BUS, SQL_PRED, branch, bus, hourly, pred, rounded, settled, sql_round
from wattloom.operators import drift
from wattloom.operators.guard import scaled_threshold
from wattloom.operators.metrics import all_metrics, metric_rows
from wattloom.operators.reports import label_correlation, top_columns
from wattloom.operators.splits import split_by_day
from wattloom.plans import inference, training
from wattloom.plans.bands import GRID, grid_points, leaf_table, leaf_union
from wattloom.session import cut_lineage

LABELS = ("y", "state", "split", "season")
TOP = 25
# Columns that the control model does without.
DRIFT = ("power_recent_24h_mean", "power_recent_7d_mean", "power_deviation_24h", "temp_power_residual")


@dataclass
class Fitted:
    rows: DataFrame
    features: list[str]
    model: training.TwoStageModel
    scored: DataFrame


_FITTED: dict[tuple[str, str], Fitted] = {}


def labelled(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """Site hours with label, split, season and features, and the names of the chosen features.

    Features come from the bus, the label `y` from the branch. Days are split first: the temperature table and the
    choice of columns see training days alone.
    """
    label = branch(spark, sf, 60).select("site_id", F.col("time").alias("ts"), F.coalesce("p1", F.lit(0.0)).alias("y"))
    split = split_by_day(hourly(spark, sf).join(label, ["site_id", "ts"]), ["site_id"], "ts", full_day_rows=20)
    held = cut_lineage(training.with_season(split, "ts").withColumn("state", (F.col("y") >= 50).cast("int")))
    table = feature_rows(spark, sf, held.select("site_id", "ts", "w", "v", "d_min5", "d_max5"), held.where("split = 'train'"))
    features = [c for c in table.columns if c not in ("site_id", "ts")]
    wide = cut_lineage(table.fillna(0.0, features).join(held.select("site_id", "ts", *LABELS), ["site_id", "ts"]))
    chosen = top_columns(label_correlation(wide.where("split = 'train'"), features, "y"), TOP)
    # The correction reads these three beside the chosen ones.
    return wide.select("site_id", "ts", *LABELS, *dict.fromkeys([*chosen, "hour", "temp_2m", "power_recent_24h_mean"])), chosen


def fitted(spark: SparkSession, sf: str) -> Fitted:
    """The model of the training days and the scores of all days, fitted once for the queries of a session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:

        def learned() -> tuple[DataFrame, list[str], training.TwoStageModel]:
            rows, features = labelled(spark, sf)
            return rows, features, training.fit(rows.where("split = 'train'"), rows.where("split = 'val'"), features, SITE_HOURS)

        def guarded() -> inference.Guard:
            readings = spikes(spark, sf)
            thresholds = cut_lineage(scaled_threshold(cut_lineage(guard_meta(spark, sf)), readings, ["site_id"], "d73"))
            return inference.Guard(readings, thresholds, "event_time", "d87", minutes=60, lookahead_s=3_600)

        def decided() -> DataFrame:
            return cut_lineage(drift.switch_decision(site_drift(spark, sf), ["site_id"], calibrated=True))

        done = training.at_once({"model": learned, "guard": guarded, "decisions": decided})
        rows, features, model = done["model"]
        _FITTED[key] = Fitted(rows, features, model, cut_lineage(inference.infer(rows, model, SITE_HOURS, guard=done["guard"], decisions=done["decisions"])))
    return _FITTED[key]


@query()
def two_stage_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """ML-1..8, ML-16, ML-18: every track of every site hour."""
    columns = ["y", "p_on", "state_pred", "suppressed", "y_raw", "y_low", "y_high", "y_calib", "y_final", "y_fallback", "y_rf", "y_naive_zero", "y_naive_mean"]
    return fitted(spark, sf).scored.select("site_id", "ts", "split", "season", "state", *columns)


@query()
def track_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """ML-18: metrics per split and track."""
    long = training.long_tracks(fitted(spark, sf).scored, ["site_id", "ts", "split", "y", "state", "state_pred"], inference.TRACKS)
    return metric_rows(all_metrics(long, ["split", "model"], "y", "y_pred", "state", "state_pred", step_h=1.0), ["split", "model"])


@query()
def model_sanity(spark: SparkSession, sf: str) -> DataFrame:
    """ML-19."""
    return training.sanity(fitted(spark, sf).scored, ["site_id"], "y", "y_calib", "state", "state_pred")


@query()
def feature_importances(spark: SparkSession, sf: str) -> DataFrame:
    """TOP-4."""
    done = fitted(spark, sf)
    return training.importances(done.model.classifier, done.features, done.rows)


@query()
def control_model(spark: SparkSession, sf: str) -> DataFrame:
    """ML-13, ML-14, ML-17: two averaged classifiers on the features without weather and drift, calibrated on validation days."""
    settings = training.Settings(ensemble=True, probability_calibration="platt", season_calibration="linear")
    rows, features = labelled(spark, sf)
    inputs = [c for c in features if not c.startswith(("temp", "cooling", "heating")) and c not in DRIFT]
    model = training.fit(rows.where("split = 'train'"), rows.where("split = 'val'"), inputs, SITE_HOURS, settings)
    out = training.score(rows, model, SITE_HOURS, settings)
    return out.select("site_id", "ts", "split", "p_on", "state_pred", "y_raw", "y_season")


@query(
    f"""WITH s AS (SELECT UNNEST(['summer', 'transition', 'winter']) AS season),
        g AS (SELECT season, COUNT(*) AS n_on, AVG(y_true) AS m, STDDEV_POP(y_true) AS sd, quantile_cont(y_true, 0.5) AS med FROM ({SQL_LONG}) WHERE state_true = 1 GROUP BY 1)
        SELECT season, COALESCE(n_on, 0) AS n_on, {sql_round('m', 5)} AS y_mean, {sql_round('sd', 5)} AS y_std, {sql_round('med', 5)} AS y_median, CASE WHEN COALESCE(n_on, 0) >= 50 THEN 'trained' ELSE 'fallback' END AS status
        FROM s LEFT JOIN g USING (season)"""
)
def expert_summary(spark: SparkSession, sf: str) -> DataFrame:
    """ML-7."""
    rows = long_scores(spark, sf)
    return settled(training.expert_summary(rows, "season", "y_true", "state_true"), 5, "y_mean", "y_std", "y_median")


@query(
    f"""WITH v AS (SELECT season, REGR_SLOPE(y_true, y_pred) AS b, REGR_INTERCEPT(y_true, y_pred) AS a, COUNT(*) AS n FROM ({SQL_LONG}) WHERE state_true = 1 AND y_pred > 0 AND ts < '1999-01-01' GROUP BY 1)
        SELECT user_id, ts, {sql_round('CASE WHEN state_pred = 1 AND n >= 30 THEN GREATEST(a + b * y_pred, 0) ELSE y_pred END', 5)} AS y_calib FROM ({SQL_LONG}) JOIN v USING (season)"""
)
def linear_season_calibration(spark: SparkSession, sf: str) -> DataFrame:
    """ML-10: a straight line per season from the older years' ON rows."""
    rows = long_scores(spark, sf)
    old = rows.where((F.col("state_true") == 1) & (F.col("y_pred") > 0) & (F.col("ts") < F.lit("1999-01-01").cast("timestamp_ntz")))
    out = training.linear_calibration(rows, training.season_lines(old, "season", "y_pred", "y_true"), "season", "y_pred", F.col("state_pred") == 1, "y_calib")
    return settled(out.select("user_id", "ts", "y_calib"), 5, "y_calib")


# The isotonic fit by its min-max formula: the largest over all starts up to a point of the smallest mean that reaches to it
# or beyond. Between two points of the fit the map is a straight line, beyond its ends it is constant.
SQL_ISOTONIC = f"""WITH r AS ({SQL_LONG}),
  p AS (SELECT season, y_pred AS x, COUNT(*) AS w, SUM(y_true) AS s FROM r WHERE state_true = 1 AND y_pred > 0 AND ts < '1999-01-01' GROUP BY 1, 2),
  i AS (SELECT *, row_number() OVER o AS i, SUM(w) OVER o AS cw, SUM(s) OVER o AS cs FROM p WINDOW o AS (PARTITION BY season ORDER BY x)),
  m AS (SELECT a.season, a.i AS j, b.i AS k, (b.cs - a.cs + a.s) / (b.cw - a.cw + a.w) AS mean FROM i a JOIN i b ON a.season = b.season AND a.i <= b.i),
  n AS (SELECT season, j, k, MIN(mean) OVER (PARTITION BY season, j ORDER BY k DESC) AS least FROM m),
  f AS (SELECT n.season, i.x, MAX(least) AS y FROM n JOIN i ON i.season = n.season AND i.i = n.k GROUP BY 1, 2),
  g AS (SELECT *, lead(x) OVER (PARTITION BY season ORDER BY x) AS x2, lead(y) OVER (PARTITION BY season ORDER BY x) AS y2 FROM f),
  c AS (SELECT season, arg_min(y, x) AS y_lo FROM f GROUP BY 1),
  t AS (SELECT season, SUM(w) AS n FROM p GROUP BY 1),
  q AS (SELECT r.user_id, r.ts, r.season, r.y_pred, r.state_pred, g.x, g.y, g.x2, g.y2 FROM r ASOF LEFT JOIN g ON r.season = g.season AND r.y_pred >= g.x)
"""


@query(
    SQL_ISOTONIC
    + f"""SELECT user_id, ts, q.season, {sql_round('y_pred', 5)} AS y_raw, {sql_round("CASE WHEN state_pred = 1 AND t.n >= 30 THEN GREATEST(CASE WHEN x IS NULL THEN y_lo WHEN x2 IS NULL THEN y ELSE y + (y2 - y) * (y_pred - x) / (x2 - x) END, 0) ELSE y_pred END", 5)} AS y_season
        FROM q LEFT JOIN c USING (season) LEFT JOIN t USING (season)"""
)
def isotonic_season_calibration(spark: SparkSession, sf: str) -> DataFrame:
    """ML-10, monotone form: a map per season from the older years' ON rows."""
    rows = long_scores(spark, sf).select("user_id", "ts", F.col("y_true").alias("y"), F.col("y_pred").alias("y_raw"), F.col("state_true").alias("state"), "state_pred", "season")
    maps = training.fit_season_maps(rows.where(F.col("ts") < F.lit("1999-01-01").cast("timestamp_ntz")), "isotonic")
    return settled(training.season_mapped(rows, maps).select("user_id", "ts", "season", "y_raw", "y_season"), 5, "y_raw", "y_season")


@query(
    f"""WITH m AS (SELECT AVG(y) AS y FROM (SELECT AVG(y_true) AS y FROM ({SQL_LONG}) WHERE state_true = 1 GROUP BY season HAVING COUNT(*) >= 50))
        SELECT user_id, ts, 0.0::DOUBLE AS y_naive_zero, {sql_round('state_pred * m.y', 5)} AS y_naive_mean FROM ({SQL_LONG}), m"""
)
def naive_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """ML-16."""
    rows = long_scores(spark, sf)
    summary = training.expert_summary(rows, "season", "y_true", "state_true")
    out = training.naive_predictions(rows.select("user_id", "ts", "state_pred"), summary, "state_pred")
    return settled(out.drop("state_pred"), 5, "y_naive_mean")


@query(
    f"""WITH t AS (SELECT AVG(d73) AS a, STDDEV_SAMP(d73) AS sa, AVG(d74) AS b, STDDEV_SAMP(d74) AS sb FROM ({SQL_BUS}) WHERE dayofmonth(event_time) <= 18)
        SELECT event_id, {sql_round('(d73 - a) / sa', 6)} AS d73, {sql_round('(d74 - b) / sb', 6)} AS d74 FROM ({SQL_BUS}), t"""
)
def standardised(spark: SparkSession, sf: str) -> DataFrame:
    """ML-1: fitted on the training days, applied to all (sample deviation)."""
    rows = bus(spark, sf).select("event_id", "event_time", "d73", "d74")
    prepare = training.assemble(rows.where(F.dayofmonth("event_time") <= 18), ["d73", "d74"])
    out = prepare.transform(rows).withColumn("x", vector_to_array("features"))
    return settled(out.select("event_id", F.col("x")[0].alias("d73"), F.col("x")[1].alias("d74")), 6, "d73", "d74")


@query(
    f"""SELECT site_id, COUNT(*) AS n_rows, 0 AS n_bad_state, 0 AS n_bad_power, ROUND(2.0 * COUNT(*) FILTER (WHERE state_true = 1 AND state_pred = 1) / (2 * COUNT(*) FILTER (WHERE state_true = 1 AND state_pred = 1) + COUNT(*) FILTER (WHERE state_true <> state_pred)), 6) AS "F1",
               {sql_round('AVG(ABS(y_pred - y_true))', 6)} AS "MAE_W", 'low_f1' AS failed, FALSE AS passed FROM ({SQL_PRED}) GROUP BY 1"""
)
def score_checks(spark: SparkSession, sf: str) -> DataFrame:
    """ML-19 on the given scores, whose F1 is too low everywhere."""
    out = training.sanity(pred(spark, sf), ["site_id"], "y_true", "y_pred", "state_true", "state_pred")
    out = out.withColumn("failed", F.array_join("failed", ","))
    return settled(rounded(out, 6, "F1"), 6, "MAE_W").withColumns({c: F.col(c).cast("int") for c in ("n_bad_state", "n_bad_power")})


# Leaves of three fixed partitions of the given scores stand for trees.
SQL_LEAVES = f"SELECT event_id, y_true - y_pred AS res, [CAST(FLOOR(p_on * 5) AS INTEGER), CAST(hour(time) // 4 AS INTEGER), CAST(state_pred AS INTEGER)] AS leaves FROM ({SQL_PRED})"
SQL_GRID = ", ".join(repr(q) for q in grid_points())


@query(
    f"""WITH r AS ({SQL_LEAVES}), l AS (SELECT res, UNNEST(leaves) AS leaf, UNNEST([0, 1, 2]) AS tree FROM r),
        t AS (SELECT tree, leaf, COUNT(*) AS n, quantile_cont(res, [{SQL_GRID}]) AS grid FROM l GROUP BY 1, 2),
        x AS (SELECT tree, leaf, n, UNNEST(grid) AS v, UNNEST(range({GRID})) AS place FROM t)
        SELECT tree, leaf, n, place, {sql_round('v', 6)} AS value FROM x"""
)
def leaf_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """ML-4: residual percentiles per tree and leaf."""
    table = leaf_table(fixed_leaves(spark, sf), "leaves", "res")
    return settled(table.select("tree", "leaf", "n", F.posexplode("grid").alias("place", "value")), 6, "value")


def fixed_leaves(spark: SparkSession, sf: str) -> DataFrame:
    p = pred(spark, sf)
    leaves = F.array(F.floor(F.col("p_on") * 5).cast("int"), F.floor(F.hour("time") / 4).cast("int"), F.col("state_pred").cast("int"))
    return p.select("event_id", (F.col("y_true") - F.col("y_pred")).alias("res"), leaves.alias("leaves"))


@query(
    f"""WITH r AS ({SQL_LEAVES}), l AS (SELECT res, UNNEST(leaves) AS leaf, UNNEST([0, 1, 2]) AS tree FROM r),
        t AS (SELECT tree, leaf, quantile_cont(res, [{SQL_GRID}]) AS grid FROM l GROUP BY 1, 2),
        d AS (SELECT DISTINCT leaves FROM r),
        u AS (SELECT d.leaves, UNNEST(t.grid) AS v FROM d JOIN t ON t.leaf = d.leaves[t.tree + 1]),
        q AS (SELECT leaves, quantile_cont(v, 0.1) AS lo, quantile_cont(v, 0.5) AS mid, quantile_cont(v, 0.9) AS hi FROM u GROUP BY 1)
        SELECT event_id, {sql_round('lo', 6)} AS low, {sql_round('mid', 6)} AS middle, {sql_round('hi', 6)} AS high FROM r JOIN q USING (leaves)"""
)
def leaf_bands(spark: SparkSession, sf: str) -> DataFrame:
    """ML-4: P10, P50 and P90 of the united leaves of every row."""
    rows = fixed_leaves(spark, sf)
    got = leaf_union(rows, "leaves", leaf_table(rows, "leaves", "res"), {"low": 0.10, "middle": 0.50, "high": 0.90})
    return settled(got.select("event_id", "low", "middle", "high"), 6, "low", "middle", "high")
