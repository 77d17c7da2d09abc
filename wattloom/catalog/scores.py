"""Accuracy metrics and diagnostic reports on the scored series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.catalog.registry import query
from wattloom.catalog.views import NUDGE, SQL_BRANCH, SQL_DAY, SQL_HOURLY, SQL_PRED, branch, bus, day, hourly, pred, rounded, settled, site_events, sql_round, table
from wattloom.functions.scalars import season_by_month
from wattloom.operators import metrics, reports
from wattloom.operators.quantiles import auc
from wattloom.operators.resample import raw_daily_counts
from wattloom.sources import meters

SQL_CONF = """COUNT(*) FILTER (WHERE state_true = 0 AND state_pred = 0) AS "TN", COUNT(*) FILTER (WHERE state_true = 0 AND state_pred = 1) AS "FP",
  COUNT(*) FILTER (WHERE state_true = 1 AND state_pred = 0) AS "FN", COUNT(*) FILTER (WHERE state_true = 1 AND state_pred = 1) AS "TP" """
SQL_RATES = """ROUND(("TP" + "TN") / ("TN" + "FP" + "FN" + "TP"), 6) AS "Accuracy", ROUND(COALESCE("TP" / NULLIF("TP" + "FP", 0), 0), 6) AS "Precision",
  ROUND(COALESCE("TP" / NULLIF("TP" + "FN", 0), 0), 6) AS "Recall", ROUND(COALESCE(2.0 * "TP" / NULLIF(2 * "TP" + "FP" + "FN", 0), 0), 6) AS "F1" """
SQL_REG = """AVG(ABS(y_pred - y_true)) AS mae, SQRT(AVG((y_pred - y_true) * (y_pred - y_true))) AS rmse, ABS(SUM(y_pred) - SUM(y_true)) / GREATEST(SUM(y_true), 1e-6) AS sae,
  SQRT(SUM((y_pred - y_true) * (y_pred - y_true)) / GREATEST(SUM(y_true * y_true), 1e-6)) AS nde, SUM(y_true) * 0.25 / 1000 AS kt, SUM(y_pred) * 0.25 / 1000 AS kp, COUNT(*) AS n"""
SQL_REG_SHOWN = f"""{sql_round('mae', 6)} AS "MAE_W", {sql_round('rmse', 6)} AS "RMSE_W", {sql_round('sae', 6)} AS "SAE", {sql_round('nde', 6)} AS "NDE",
  {sql_round('kt', 6)} AS "kWh_true", {sql_round('kp', 6)} AS "kWh_pred", {sql_round('kp - kt', 6)} AS "kWh_err", n AS n_samples"""
RATES = ("Accuracy", "Precision", "Recall", "F1")
POWERS = ("MAE_W", "RMSE_W", "SAE", "NDE", "kWh_true", "kWh_pred", "kWh_err")


def sql_auc(group: str, source: str = SQL_PRED, label: str = "state_true", score: str = "p_on") -> str:
    """Rank-sum AUC with average ranks."""
    return f"""SELECT {group}, CASE WHEN SUM(l) > 0 AND SUM(1 - l) > 0 THEN (SUM(CASE WHEN l = 1 THEN r END) - SUM(l) * (SUM(l) + 1) / 2.0) / (SUM(l) * SUM(1 - l)) END AS auc
      FROM (SELECT {group}, {label} AS l, rank() OVER (PARTITION BY {group} ORDER BY {score}) + (COUNT(*) OVER (PARTITION BY {group}, {score}) - 1) / 2.0 AS r FROM ({source}))
      GROUP BY {group}"""


@query(f'WITH c AS (SELECT site_id, split, {SQL_CONF} FROM ({SQL_PRED}) GROUP BY 1, 2), a AS ({sql_auc("site_id, split")}) SELECT c.*, {SQL_RATES}, ROUND(auc, 6) AS "AUC" FROM c JOIN a USING (site_id, split)')
def class_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-7/8."""
    out = metrics.classification_metrics(pred(spark, sf), ["site_id", "split"], "state_true", "state_pred", "p_on")
    return rounded(out, 6, *RATES, "AUC")


@query(f'SELECT user_id, ROUND(auc, 6) AS "AUC" FROM ({sql_auc("user_id")})')
def auc_per_user(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(auc(pred(spark, sf), ["user_id"], "state_true", "p_on"), 6, "AUC")


@query(f"SELECT user_id, {SQL_REG_SHOWN} FROM (SELECT user_id, {SQL_REG} FROM ({SQL_PRED}) GROUP BY 1)")
def reg_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-9."""
    return settled(metrics.regression_metrics(pred(spark, sf), ["user_id"], "y_true", "y_pred"), 6, *POWERS)


SQL_DAILY = f"""
  WITH p AS (SELECT *, CAST(time AS DATE) AS date FROM ({SQL_PRED})), c AS (SELECT site_id, date, {SQL_CONF} FROM p GROUP BY 1, 2),
  r AS (SELECT site_id, date, {SQL_REG} FROM p GROUP BY 1, 2), a AS ({sql_auc('site_id, date', 'SELECT * FROM p')}),
  n AS (SELECT event_type AS site_id, CAST(ts AS DATE) AS date, COUNT(*) AS n_bus_raw FROM events GROUP BY 1, 2)
  SELECT c.*, {SQL_RATES}, ROUND(auc, 6) AS "AUC", {sql_round('mae', 6)} AS "MAE_W", {sql_round('rmse', 6)} AS "RMSE_W",
         {sql_round('CASE WHEN kt >= 1e-3 THEN ABS(kp - kt) / kt END', 6)} AS "SAE", {sql_round('kt', 6)} AS "kWh_true", {sql_round('kp', 6)} AS "kWh_pred",
         {sql_round('kp - kt', 6)} AS "kWh_err", n AS n_samples, n_bus_raw
  FROM c JOIN r USING (site_id, date) JOIN a USING (site_id, date) JOIN n USING (site_id, date)"""


@query(SQL_DAILY)
def daily_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-10 with the raw counts of the day."""
    out = metrics.daily_metrics(pred(spark, sf), ["site_id"], "time", "y_true", "y_pred", "state_true", "state_pred", "p_on")
    counts = raw_daily_counts(bus(spark, sf), ["site_id"], "event_time", "n_bus_raw")
    out = out.join(counts, ["site_id", "date"], "left")
    powers = [c for c in POWERS if c in out.columns]
    return settled(rounded(out, 6, *RATES, "AUC"), 6, *powers)


# Three tracks of the same steps; training days are those of even users' train rows.
SQL_TRACKS = f"""SELECT p.* EXCLUDE (y_pred), m.model, y_pred * m.f AS y_pred FROM ({SQL_PRED}) p CROSS JOIN (VALUES ('main', 1.0::DOUBLE), ('main_calib', 1.1::DOUBLE), ('main_final', 0.95::DOUBLE)) m(model, f)"""


def tracks(spark: SparkSession, sf: str) -> DataFrame:
    rows = pred(spark, sf)
    made = F.array(*[F.struct(F.lit(m).alias("model"), (F.col("y_pred") * f).alias("y_pred")) for m, f in (("main", 1.0), ("main_calib", 1.1), ("main_final", 0.95))])
    return rows.select(*[c for c in rows.columns if c != "y_pred"], F.inline(made))


SQL_TRAIN_DAYS = f"""SELECT DISTINCT site_id, CAST(time AS DATE) AS date FROM ({SQL_PRED}) WHERE split = 'train' AND length(site_id) > 4 AND dayofmonth(time) % 2 = 0"""
SQL_LEAK = f"""
  WITH t AS (SELECT p.* EXCLUDE (split), CASE WHEN d.date IS NOT NULL THEN 'inference_leak' ELSE 'inference_ood' END AS split
             FROM ({SQL_TRACKS}) p LEFT JOIN ({SQL_TRAIN_DAYS}) d ON d.site_id = p.site_id AND d.date = CAST(p.time AS DATE)),
  c AS (SELECT site_id, split, {SQL_CONF} FROM t WHERE model = 'main' GROUP BY 1, 2), r AS (SELECT site_id, split, model, {SQL_REG} FROM t GROUP BY 1, 2, 3),
  a AS ({sql_auc('site_id, split', "SELECT * FROM t WHERE model = 'main'")})
  SELECT r.site_id, r.split, r.model, {SQL_REG_SHOWN}, "TN", "FP", "FN", "TP", {SQL_RATES}, ROUND(auc, 6) AS "AUC"
  FROM r JOIN c USING (site_id, split) JOIN a USING (site_id, split) WHERE r.site_id IN (SELECT site_id FROM ({SQL_TRAIN_DAYS}))"""


def _train_days(spark: SparkSession, sf: str) -> DataFrame:
    rows = pred(spark, sf).where((F.col("split") == "train") & (F.length("site_id") > 4) & (F.dayofmonth("time") % 2 == 0))
    return meters.covered_days(rows, ["site_id"], "time")


@query(SQL_LEAK)
def leak_ood(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-11, AGG-11."""
    out = metrics.leak_ood_metrics(tracks(spark, sf), _train_days(spark, sf), ["site_id"], "time", "y_true", "y_pred", "state_true", "state_pred", score="p_on")
    return settled(rounded(out, 6, *RATES, "AUC"), 6, *POWERS)


@query(
    f"""WITH d AS (SELECT site_id, CAST(time AS DATE) AS date, COUNT(*) AS n FROM ({SQL_PRED}) GROUP BY 1, 2), t AS ({SQL_TRAIN_DAYS}),
        f AS (SELECT d.*, t.date IS NOT NULL AS seen FROM d LEFT JOIN t USING (site_id, date))
        SELECT site_id, CAST(COALESCE(SUM(n) FILTER (WHERE seen), 0) AS BIGINT) AS n_leak, CAST(COALESCE(SUM(n) FILTER (WHERE NOT seen), 0) AS BIGINT) AS n_ood,
               COALESCE(string_agg(CAST(date AS VARCHAR), ',' ORDER BY date) FILTER (WHERE seen), '') AS leak_dates,
               COALESCE(string_agg(CAST(date AS VARCHAR), ',' ORDER BY date) FILTER (WHERE NOT seen), '') AS ood_dates FROM f GROUP BY 1"""
)
def leak_ood_days(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.leak_ood_days(pred(spark, sf), _train_days(spark, sf), ["site_id"], "time")


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    """Long metric rows of all splits and tracks."""
    powers = metrics.regression_metrics(tracks(spark, sf), ["site_id", "split", "model"], "y_true", "y_pred")
    return metrics.metric_rows(powers, ["site_id", "split", "model"])


SQL_ROWS = (
    f"WITH r AS (SELECT site_id, split, model, {SQL_REG} FROM ({SQL_TRACKS}) GROUP BY 1, 2, 3), l AS ("
    + " UNION ALL ".join(
        f"SELECT site_id, split, model, 'regression' AS metric_type, '{name}' AS metric, CAST({sql} AS DOUBLE) AS value FROM r"
        for name, sql in (("MAE_W", "mae"), ("RMSE_W", "rmse"), ("SAE", "sae"), ("NDE", "nde"), ("kWh_true", "kt"), ("kWh_pred", "kp"), ("kWh_err", "kp - kt"), ("n_samples", "n"))
    )
    + ")"
)


@query(SQL_ROWS + f" SELECT * EXCLUDE (value), {sql_round('value', 6)} AS value FROM l")
def metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-12."""
    return settled(_rows(spark, sf), 6, "value")


@query(SQL_ROWS + " SELECT site_id, metric_type, metric, " + ", ".join(f"{sql_round(f'MAX(CASE WHEN model = {chr(39)}{m}{chr(39)} THEN value END)', 6)} AS {m}" for m in ("main", "main_calib", "main_final")) + " FROM l WHERE split = 'test' GROUP BY 1, 2, 3")
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-13."""
    models = ["main_final", "main", "main_calib"]
    out = metrics.comparison_table(_rows(spark, sf).where("split = 'test'"), models, ["site_id"])
    return settled(out, 6, *models)


@query(SQL_ROWS + " SELECT site_id, model, metric_type, metric, " + ", ".join(f"{sql_round(f'MAX(CASE WHEN split = {chr(39)}{s}{chr(39)} THEN value END)', 6)} AS {s}" for s in ("train", "val", "test")) + " FROM l GROUP BY 1, 2, 3, 4")
def metric_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-14."""
    return settled(metrics.split_pivot(_rows(spark, sf), keys=["site_id"]), 6, "train", "val", "test")


# A metric history: every event is one written row; versions grow with time.
SQL_HISTORY = f"""SELECT ts AS timestamp, event_id, 'v' || lpad(CAST(dayofmonth(ts) // 4 AS VARCHAR), 2, '0') AS project_version, CASE WHEN user_id % 2 = 0 THEN 'main_train' ELSE 'evaluate' END AS source,
  CASE user_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'test' END AS split, event_type AS model, 'regression' AS metric_type, 'm' || CAST(user_id % 5 AS VARCHAR) AS metric, value FROM events"""


@query(
    f"""WITH h AS ({SQL_HISTORY}), v AS (SELECT arg_max(project_version, timestamp) AS last FROM h),
        r AS (SELECT h.*, row_number() OVER (PARTITION BY split, model, source, metric_type, metric ORDER BY timestamp DESC, event_id DESC) AS rn FROM h, v WHERE project_version = last)
        SELECT split, model, source, metric_type, metric, timestamp, value, project_version FROM r WHERE rn = 1"""
)
def snapshot_latest(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-15, SET-3."""
    e = table(spark, sf, "events")
    history = e.select(
        F.col("ts").alias("timestamp"), "event_id",
        F.concat(F.lit("v"), F.lpad(F.expr("CAST(dayofmonth(ts) DIV 4 AS STRING)"), 2, "0")).alias("project_version"),
        F.when(F.col("user_id") % 2 == 0, "main_train").otherwise("evaluate").alias("source"),
        F.when(F.col("user_id") % 3 == 0, "train").when(F.col("user_id") % 3 == 1, "val").otherwise("test").alias("split"),
        F.col("event_type").alias("model"), F.lit("regression").alias("metric_type"),
        F.concat(F.lit("m"), (F.col("user_id") % 5).cast("string")).alias("metric"), "value",
    )
    return metrics.latest_snapshot(history, order=("timestamp", "event_id"))


SQL_SEASON = "CASE WHEN month({t}) IN (12, 1, 2) THEN 'winter' WHEN month({t}) BETWEEN 5 AND 9 THEN 'summer' ELSE 'transition' END"
# Scored multi-year series: order sums per customer group and day.
SQL_LONG = f"""SELECT user_id, ts, w / 1000 AS y_true, w / 1000 * (0.7::DOUBLE + (n % 5) * 0.15::DOUBLE) AS y_pred, CAST(w / 1000 >= 200 AS INT) AS state_true,
  CAST(n % 5 > 0 AS INT) AS state_pred, {SQL_SEASON.format(t='ts')} AS season FROM ({SQL_DAY})"""


def long_scores(spark: SparkSession, sf: str) -> DataFrame:
    w = F.col("w") / 1000
    return day(spark, sf).select(
        "user_id", "ts", w.alias("y_true"), (w * (0.7 + (F.col("n") % 5) * 0.15)).alias("y_pred"), (w >= 200).cast("int").alias("state_true"),
        (F.col("n") % 5 > 0).cast("int").alias("state_pred"), season_by_month(F.col("ts")).alias("season"),
    )


@query(
    f"""WITH s AS (SELECT UNNEST(['summer', 'transition', 'winter']) AS season), u AS (SELECT DISTINCT user_id FROM ({SQL_LONG})),
        g AS (SELECT user_id, season, COUNT(*) AS n, AVG(y_true) AS a, STDDEV_POP(y_true) AS sd, MIN(y_true) AS lo, MAX(y_true) AS hi, quantile_cont(y_true, 0.5) AS med
              FROM ({SQL_LONG}) WHERE state_true = 1 AND NOT (season = 'summer' AND user_id = 3) GROUP BY 1, 2)
        SELECT u.user_id, s.season, COALESCE(n, 0) AS n_on, {sql_round('a', 5)} AS "mean_W", {sql_round('sd', 5)} AS "std_W", {sql_round('lo', 5)} AS "min_W", {sql_round('hi', 5)} AS "max_W",
               {sql_round('med', 5)} AS "median_W" FROM u CROSS JOIN s LEFT JOIN g USING (user_id, season)"""
)
def season_on_stats(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-19; one user has no ON rows in summer and keeps an empty row."""
    on = (F.col("state_true") == 1) & ~((season_by_month(F.col("ts")) == "summer") & (F.col("user_id") == 3))
    out = reports.season_on_stats(long_scores(spark, sf).drop("season"), ["user_id"], "ts", "y_true", on)
    return settled(out, 5, "mean_W", "std_W", "min_W", "max_W", "median_W")


@query(
    f"""SELECT user_id, COALESCE(season, 'ALL') AS season, COUNT(*) AS n_on, {sql_round('AVG(y_pred - y_true)', 5)} AS mean_res, {sql_round('STDDEV_POP(y_pred - y_true)', 5)} AS std_res,
               {sql_round('quantile_cont(y_pred - y_true, 0.5)', 5)} AS median_res FROM ({SQL_LONG}) WHERE state_true = 1 GROUP BY GROUPING SETS ((user_id, season), (user_id))"""
)
def residual_bias(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-20."""
    out = reports.residual_bias(long_scores(spark, sf).drop("season"), ["user_id"], "ts", "y_true", "y_pred", "state_true")
    return settled(out, 5, "mean_res", "std_res", "median_res")


@query(
    f"""SELECT strftime(ts, '%Y-%m') AS month, COUNT(*) AS n_on, {sql_round('AVG(ABS(y_pred - y_true))', 5)} AS mae_before, {sql_round('AVG(ABS(y_pred * 0.9 - y_true))', 5)} AS mae_after,
               {sql_round('quantile_cont(y_pred - y_true, 0.5)', 5)} AS median_before, {sql_round('quantile_cont(y_pred * 0.9 - y_true, 0.5)', 5)} AS median_after
        FROM ({SQL_LONG}) WHERE state_true = 1 GROUP BY 1"""
)
def monthly_residuals(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-21."""
    rows = long_scores(spark, sf).withColumn("y_calib", F.col("y_pred") * 0.9)
    out = reports.monthly_residuals(rows, [], "ts", "y_true", "y_pred", "y_calib", "state_true")
    return settled(out, 5, "mae_before", "mae_after", "median_before", "median_after")


@query(f"SELECT site_id, split, strftime(time, '%Y-%m') AS month, COUNT(*) AS n_rows, COUNT(DISTINCT CAST(time AS DATE)) AS n_days FROM ({SQL_PRED}) GROUP BY 1, 2, 3")
def split_month_counts(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-22."""
    return reports.split_month_counts(pred(spark, sf), ["site_id"], "time")


@query(
    f"""SELECT user_id, COALESCE(season, 'ALL') AS season, COUNT(*) AS n, COUNT(*) FILTER (WHERE y_true >= 200) AS n_on, {sql_round('AVG(y_true) FILTER (WHERE y_true >= 200)', 5)} AS true_mean,
               {sql_round('AVG(y_pred) FILTER (WHERE y_true >= 200)', 5)} AS pred_mean, {sql_round('AVG(ABS(y_pred - y_true))', 5)} AS mae,
               {sql_round('ABS(SUM(y_pred) - SUM(y_true)) / SUM(y_true)', 6)} AS sae, {sql_round('SUM(y_true) * 0.25 / 1000', 6)} AS kwh_true, {sql_round('SUM(y_pred) * 0.25 / 1000', 6)} AS kwh_pred
        FROM ({SQL_LONG}) GROUP BY GROUPING SETS ((user_id, season), (user_id))"""
)
def season_scores(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-23."""
    out = reports.season_scores(long_scores(spark, sf).drop("season"), ["user_id"], "ts", "y_true", "y_pred", 200.0)
    return settled(settled(out, 5, "true_mean", "pred_mean", "mae"), 6, "sae", "kwh_true", "kwh_pred")


@query(
    f"""SELECT site_id, FLOOR(y_true / 200) * 200 AS bin_w, COUNT(*) AS n, {sql_round('AVG(y_true)', 5)} AS true_mean, {sql_round('AVG(y_pred)', 5)} AS pred_mean, {sql_round('AVG(y_pred - y_true)', 5)} AS mean_res,
               ROUND(AVG(CAST(y_pred < y_true AS INT)), 6) AS under_share, {sql_round('quantile_cont(y_pred - y_true, 0.5)', 5)} AS median_res
        FROM ({SQL_PRED}) WHERE y_true >= 10 AND y_true < 1000 GROUP BY 1, 2"""
)
def power_bins(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-24."""
    out = reports.residual_bins(pred(spark, sf), ["site_id"], "y_true", "y_pred")
    return settled(rounded(out, 6, "under_share"), 5, "true_mean", "pred_mean", "mean_res", "median_res")


@query(
    f"""WITH f AS (SELECT *, state_true = 1 AND state_pred = 0 AS miss FROM ({SQL_PRED}))
        SELECT site_id, COUNT(*) FILTER (WHERE miss) AS n_fn, COUNT(*) FILTER (WHERE state_true = 1) AS n_on, ROUND(COUNT(*) FILTER (WHERE miss) / COUNT(*) FILTER (WHERE state_true = 1), 6) AS fn_share,
               {sql_round('AVG(y_true) FILTER (WHERE miss)', 5)} AS fn_mean_w, MAX(y_true) FILTER (WHERE miss) AS fn_max_w, MIN(y_true) FILTER (WHERE miss) AS fn_min_w,
               {sql_round('SUM(y_true) FILTER (WHERE miss) * 0.25 / 1000', 6)} AS lost_kwh, {sql_round('SUM(y_true) FILTER (WHERE miss) / SUM(y_true) FILTER (WHERE state_true = 1)', 6)} AS lost_share,
               {sql_round('quantile_cont(y_true, 0.5) FILTER (WHERE miss)', 5)} AS fn_median_w FROM f GROUP BY 1"""
)
def missed_on(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-25."""
    out = reports.missed_on(pred(spark, sf), ["site_id"], "y_true", "state_true", "state_pred")
    return settled(settled(rounded(out, 6, "fn_share"), 5, "fn_mean_w", "fn_median_w"), 6, "lost_kwh", "lost_share")


SQL_POINTS = ", ".join(f"{sql_round(f'quantile_cont(y_true, {q})', 5)} AS {n}" for n, q in reports.PROFILE_POINTS.items())


@query(
    f"""WITH o AS (SELECT site_id, COUNT(*) AS n_on, {sql_round('AVG(y_true)', 5)} AS mean_w, {sql_round('STDDEV_POP(y_true)', 5)} AS std_w, MIN(y_true) AS min_w, MAX(y_true) AS max_w, {SQL_POINTS}
                   FROM ({SQL_PRED}) WHERE y_true >= 10 GROUP BY 1)
        SELECT o.*, s.on_share FROM o JOIN (SELECT site_id, ROUND(COUNT(*) FILTER (WHERE y_true >= 10) / COUNT(*), 6) AS on_share FROM ({SQL_PRED}) GROUP BY 1) s USING (site_id)"""
)
def power_profile(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-26."""
    out = reports.power_profile(pred(spark, sf), ["site_id"], "y_true")
    return settled(rounded(out, 6, "on_share"), 5, "mean_w", "std_w", *reports.PROFILE_POINTS)


@query(
    f"""WITH b AS (SELECT site_id, CASE WHEN y_true < 400 THEN FLOOR(y_true / 200) * 200 ELSE FLOOR(y_true / 100) * 100 END AS bin_w, COUNT(*) AS n FROM ({SQL_PRED}) WHERE y_true >= 10 GROUP BY 1, 2)
        SELECT site_id, bin_w, n, ROUND(n / SUM(n) OVER (PARTITION BY site_id), 6) AS share FROM b WHERE bin_w < 1000"""
)
def power_histogram(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-26."""
    return rounded(reports.power_histogram(pred(spark, sf), ["site_id"], "y_true"), 6, "share")


def _sql_compare(name: str, expression: str) -> str:
    return f"""SELECT {expression} AS {name}, COUNT(*) FILTER (WHERE ts < '1998-01-01') AS old_n, {sql_round("AVG(y_true) FILTER (WHERE ts < '1998-01-01')", 5)} AS old_mean_w,
      COUNT(*) FILTER (WHERE ts >= '1998-01-01') AS new_n, {sql_round("AVG(y_true) FILTER (WHERE ts >= '1998-01-01')", 5)} AS new_mean_w FROM ({SQL_LONG}) WHERE y_true >= 200 GROUP BY 1"""


def _compare(spark: SparkSession, sf: str, by, name: str) -> DataFrame:
    rows = long_scores(spark, sf).drop("season")
    edge = F.lit("1998-01-01").cast("timestamp_ntz")
    out = reports.dataset_comparison(rows.where(F.col("ts") < edge), rows.where(F.col("ts") >= edge), by, name, "y_true", 200.0)
    return settled(out, 5, "old_mean_w", "new_mean_w")


@query(_sql_compare("season", SQL_SEASON.format(t="ts")))
def datasets_by_season(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-27."""
    return _compare(spark, sf, season_by_month(F.col("ts")), "season")


@query(_sql_compare("month", "strftime(ts, '%m')"))
def datasets_by_month(spark: SparkSession, sf: str) -> DataFrame:
    return _compare(spark, sf, F.date_format("ts", "MM"), "month")


@query(_sql_compare("block", "strftime(ts, '%Y-%m') || ' ' || CASE WHEN dayofmonth(ts) <= 10 THEN '1-10' WHEN dayofmonth(ts) <= 20 THEN '11-20' ELSE '21-31' END"))
def datasets_by_ten_days(spark: SparkSession, sf: str) -> DataFrame:
    return _compare(spark, sf, reports.ten_day_block(F.col("ts")), "block")


@query(
    f"""SELECT site_id, model, {sql_round('AVG(ABS(y_main - y_base))', 5)} AS "MAE_vs_main_W", ROUND(CORR(y_main, y_base), 6) AS "Pearson_vs_main",
               ROUND(AVG(CAST((y_main >= 10) = (y_base >= 10) AS INT)), 6) AS state_agree_rate, COUNT(*) AS n_samples
        FROM (SELECT site_id, m.model, y_pred AS y_main, CASE m.model WHEN 'rf' THEN y_true * 0.9 WHEN 'mean' THEN 60.0 * state_pred ELSE y_pred * p_on END AS y_base
              FROM ({SQL_PRED}) CROSS JOIN (VALUES ('rf'), ('mean'), ('soft')) m(model)) GROUP BY 1, 2"""
)
def consistency(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-29."""
    rows = pred(spark, sf)
    base = {"rf": F.col("y_true") * 0.9, "mean": 60.0 * F.col("state_pred"), "soft": F.col("y_pred") * F.col("p_on")}
    long = rows.select("site_id", F.col("y_pred").alias("y_main"), F.inline(F.array(*[F.struct(F.lit(m).alias("model"), c.alias("y_base")) for m, c in base.items()])))
    out = metrics.model_consistency(long, ["site_id", "model"], "y_main", "y_base")
    return settled(rounded(out, 6, "Pearson_vs_main", "state_agree_rate"), 5, "MAE_vs_main_W")


@query(
    f"""SELECT site_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE y_true >= 50 AND y_true < 100) AS n_gray, """
    + ", ".join(
        f"ROUND(2.0 * COUNT(*) FILTER (WHERE y_true >= {t} AND state_pred = 1) / (2 * COUNT(*) FILTER (WHERE y_true >= {t} AND state_pred = 1) + COUNT(*) FILTER (WHERE (y_true >= {t}) <> (state_pred = 1))), 6) AS f1_{n}"
        for n, t in (("low", 50), ("high", 100))
    )
    + f" FROM ({SQL_PRED}) GROUP BY 1"
)
def gray_zone(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-36."""
    return rounded(reports.gray_zone(pred(spark, sf), ["site_id"], "y_true", "state_pred", 50, 100), 6, "f1_low", "f1_high")


@query(
    f"""SELECT user_id, COUNT(*) AS n_rows, MIN(time) AS first_ts, MAX(time) AS last_ts, {sql_round('AVG(y_pred)', 6)} AS mean_w, {sql_round('MAX(y_pred)', 6)} AS max_w,
               ROUND(AVG(CAST(y_pred > 0 AS INT)), 6) AS positive_share, {sql_round('quantile_cont(y_pred, 0.5)', 6)} AS median_w FROM ({SQL_PRED}) GROUP BY 1"""
)
def prediction_profile(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-38."""
    out = reports.prediction_profile(pred(spark, sf), ["user_id"], "time", "y_pred")
    return settled(rounded(out, 6, "positive_share"), 6, "mean_w", "max_w", "median_w")


@query(f"WITH c AS (SELECT user_id, {SQL_SEASON.format(t='ts')} AS season, COUNT(*) AS n FROM ({SQL_DAY}) GROUP BY 1, 2) SELECT *, ROUND(n / SUM(n) OVER (PARTITION BY user_id), 6) AS share FROM c")
def season_shares(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-38."""
    return rounded(reports.season_shares(day(spark, sf), ["user_id"], "ts"), 6, "share")


@query(f"SELECT user_id, strftime(ts, '%Y-%m') AS month, COUNT(*) AS n FROM ({SQL_DAY}) GROUP BY 1, 2")
def month_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.month_counts(day(spark, sf), ["user_id"], "ts")


SQL_EFFECT_PARTS = ", ".join(
    f"AVG(ABS({c} - y_true)) AS mae_{t}, ABS(SUM({c}) - SUM(y_true)) / SUM(y_true) AS sae_{t}, (SUM({c}) - SUM(y_true)) * 0.25 / 1000 AS kwh_err_{t}" for c, t in (("y_pred", "raw"), ("y_calib", "calib"))
)
EFFECT = [f"{m}_{t}" for m in ("mae", "sae", "kwh_err") for t in ("raw", "calib", "gain")]


@query(
    f"""WITH e AS (SELECT user_id, {SQL_EFFECT_PARTS} FROM (SELECT *, y_pred * 0.9 AS y_calib FROM ({SQL_LONG})) GROUP BY 1)
        SELECT user_id, {", ".join(f"{sql_round(f'{m}_{t}' if t != 'gain' else f'{m}_raw - {m}_calib', 5)} AS {m}_{t}" for m in ('mae', 'sae', 'kwh_err') for t in ('raw', 'calib', 'gain'))} FROM e"""
)
def calibration_effect(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-39."""
    rows = long_scores(spark, sf).withColumn("y_calib", F.col("y_pred") * 0.9)
    return settled(reports.calibration_effect(rows, ["user_id"], "y_true", "y_pred", "y_calib"), 5, *EFFECT)


@query(
    f"""SELECT user_id, season, COUNT(*) AS n, {sql_round('AVG(y_pred)', 5)} AS mean_raw, {sql_round('AVG(y_pred * 0.9)', 5)} AS mean_calib, {sql_round('AVG(y_pred * 0.9) - AVG(y_pred)', 5)} AS mean_shift
        FROM ({SQL_LONG}) WHERE state_pred = 1 GROUP BY 1, 2"""
)
def calibration_shift(spark: SparkSession, sf: str) -> DataFrame:
    rows = long_scores(spark, sf).drop("season").withColumn("y_calib", F.col("y_pred") * 0.9)
    return settled(reports.calibration_shift(rows, ["user_id"], "ts", "y_pred", "y_calib", "state_pred"), 5, "mean_raw", "mean_calib", "mean_shift")


@query(
    f"""WITH g AS (SELECT site_id, date_diff('microsecond', lag(event_time) OVER (PARTITION BY site_id ORDER BY event_time, event_id), event_time) / 1e6 AS dt FROM (SELECT event_type AS site_id, ts AS event_time, event_id FROM events)),
        d AS (SELECT site_id, quantile_cont(dt, 0.5) AS med, STDDEV_SAMP(dt) AS sd, MAX(dt) AS gap FROM g WHERE dt IS NOT NULL GROUP BY 1),
        b AS (SELECT event_type AS site_id, value AS y, CASE WHEN CAST(json_extract_string(props, '$.k') AS DOUBLE) % 3 = 0 THEN value END AS patchy, ts FROM events),
        l AS (SELECT site_id, COUNT(*) AS n_samples, MIN(ts) AS time_start, MAX(ts) AS time_end, 1 - COUNT(patchy) / COUNT(*) AS miss, AVG(CAST(y >= 10 AS INT)) AS on_pct, AVG(y) AS mu, STDDEV_SAMP(y) AS sg FROM b GROUP BY 1),
        o AS (SELECT b.site_id, AVG(CAST(ABS(y - mu) > 5 * sg AS INT)) AS outs FROM b JOIN l USING (site_id) GROUP BY 1)
        SELECT l.site_id, n_samples, time_start, time_end, {sql_round("date_diff('microsecond', time_start, time_end) / 8.64e10", 6)} AS span_days, {sql_round('med', 4)} AS dt_median_s, {sql_round('sd / GREATEST(med, 1)', 6)} AS dt_cv,
               {sql_round('gap', 4)} AS dt_max_gap_s, ROUND(on_pct, 6) AS on_pct, ROUND(outs, 6) AS outlier_share,
               array_to_string(list_filter([CASE WHEN sd / med > 0.2 THEN 'uneven_step' END, CASE WHEN gap > 4 * med THEN 'sampling_gap' END, CASE WHEN miss > 0.1 THEN 'missing_columns' END,
                 CASE WHEN on_pct < 0.05 OR on_pct > 0.95 THEN 'unbalanced_label' END, CASE WHEN outs > 0.01 THEN 'outliers' END], lambda x: x IS NOT NULL), ',') AS issues
        FROM l JOIN d USING (site_id) JOIN o USING (site_id)"""
)
def data_quality(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-30."""
    rows = bus(spark, sf).withColumn("patchy", F.when(F.col("d74") % 3 == 0, F.col("d73"))).withColumn("y", F.col("d73"))
    out = reports.data_quality(rows, site_events(spark, sf), ["d73", "d74", "patchy"], "y")
    shown = out.select(
        "site_id", "n_samples", "time_start", "time_end", "span_days", "dt_median_s", "dt_cv", "dt_max_gap_s", "on_pct", "outlier_share", F.array_join("issues", ",").alias("issues")
    )
    return settled(settled(rounded(shown, 6, "on_pct", "outlier_share"), 4, "dt_median_s", "dt_max_gap_s"), 6, "span_days", "dt_cv")


@query(
    f"""SELECT site_id, COUNT(*) AS n_rows, MIN(time) AS first_ts, MAX(time) AS last_ts, ROUND(COUNT(*) FILTER (WHERE p1 = 0) / COUNT(p1), 6) AS zero_share, {sql_round('AVG(p1) FILTER (WHERE p1 > 0)', 6)} AS mean_positive,
               {sql_round('MAX(p1)', 6)} AS peak, {sql_round('quantile_cont(p1, 0.5) FILTER (WHERE p1 > 0)', 6)} AS median_positive FROM ({SQL_BRANCH}) GROUP BY 1"""
)
def label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-3."""
    out = reports.label_distribution(branch(spark, sf), ["site_id"], "p1", "time")
    return settled(rounded(out, 6, "zero_share"), 6, "mean_positive", "peak", "median_positive")


@query(
    f"""WITH a AS (SELECT site_id, MIN(ts) AS b0, MAX(ts) AS b1 FROM ({SQL_HOURLY}) GROUP BY 1), b AS (SELECT site_id, MIN(time) AS l0, MAX(time) AS l1 FROM ({SQL_BRANCH}) WHERE dayofmonth(time) BETWEEN 3 AND 27 GROUP BY 1)
        SELECT site_id, GREATEST(b0, l0) AS start, LEAST(b1, l1) AS "end", {sql_round("date_diff('microsecond', GREATEST(b0, l0), LEAST(b1, l1)) / 8.64e10", 6)} AS overlap_days FROM a JOIN b USING (site_id)"""
)
def overlap_period(spark: SparkSession, sf: str) -> DataFrame:
    labels = branch(spark, sf).where(F.dayofmonth("time").between(3, 27))
    return settled(reports.overlap_period(hourly(spark, sf), labels, ["site_id"], "ts", "time"), 6, "overlap_days")


@query(
    f"""SELECT event_id, site_id, time, ROUND(y_true, 3) AS "y_true_W", {sql_round('y_pred', 3)} AS "y_pred_W", {sql_round('y_pred - y_true', 3)} AS "residual_W", state_true, state_pred, ROUND(p_on, 4) AS p_on FROM ({SQL_PRED})"""
)
def prediction_rows(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-19; the shift before rounding keeps exact halves apart from the digit edge."""
    edge = F.lit(NUDGE * 1e-3)
    rows = pred(spark, sf).withColumn("y_pred", F.col("y_pred") + edge)
    return meters.prediction_table(rows, ["event_id", "site_id"], "time", "y_true", "y_pred", state_true="state_true", state_pred="state_pred", p_on="p_on")


@query(
    f"""SELECT event_id, time, ROUND(MAX(y_true), 3) AS "y_true_W", """
    + ", ".join(f"""{sql_round(f"MAX(CASE WHEN model = '{m}' THEN y_pred END)", 3)} AS "y_pred_W_{m}", {sql_round(f"MAX(CASE WHEN model = '{m}' THEN y_pred - y_true END)", 3)} AS "residual_W_{m}" """ for m in ("main", "main_calib", "main_final"))
    + f" FROM ({SQL_TRACKS}) GROUP BY 1, 2"
)
def wide_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-20."""
    shifted = tracks(spark, sf).withColumn("y_pred", F.col("y_pred") + F.lit(NUDGE * 1e-3))
    return meters.wide_predictions(shifted, ["event_id"], "time", ["main", "main_calib", "main_final"])
