"""Start guard, label cleaning, threshold curves and sample weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.catalog.periods import sql_islands
from wattloom.catalog.registry import query
from wattloom.catalog.scores import SQL_CONF
from wattloom.catalog.views import SITE_QUARTERS, SQL_BRANCH, SQL_BUS, SQL_PRED, branch, bus, pred, rounded, settled, site_events, sql_round
from wattloom.functions.timeparse import floor_to
from wattloom.operators import guard, labels, metrics, weights
from wattloom.operators.joins import startup_as_of
from wattloom.operators.segments import filter_short_runs

# Start signal of a site: the spike column without its sentinel.
SQL_SPIKES = f"SELECT site_id, event_time, event_id, d73, d74, d87 FROM ({SQL_BUS}) WHERE d74 <> 0"
# Quarter-hour steps with a model probability and a power.
SQL_STEPS = f"""SELECT site_id, time_bucket(INTERVAL 15 MINUTE, time) AS ts, MAX(p_on) AS p_on, SUM(y_pred) AS y_pred, SUM(y_true) AS y_true, MAX(state_pred) AS state_pred, MAX(state_true) AS state_true
  FROM ({SQL_PRED}) GROUP BY 1, 2"""
STEPS = SITE_QUARTERS.renamed(ts="ts")


def spikes(spark: SparkSession, sf: str) -> DataFrame:
    return bus(spark, sf).where("d74 <> 0")


def steps(spark: SparkSession, sf: str) -> DataFrame:
    return pred(spark, sf).groupBy("site_id", floor_to(F.col("time"), 15).alias("ts")).agg(
        F.max("p_on").alias("p_on"), F.sum("y_pred").alias("y_pred"), F.sum("y_true").alias("y_true"),
        F.max("state_pred").alias("state_pred"), F.max("state_true").alias("state_true"),
    )


SQL_CLEANED = f"""
  WITH b AS (SELECT site_id, time, p1 FROM ({SQL_BRANCH})), s AS (SELECT DISTINCT site_id, event_time AS up FROM ({SQL_SPIKES}) WHERE ABS(d87) >= 192),
  p AS (SELECT b.*, s.up AS prev FROM b ASOF LEFT JOIN s ON b.site_id = s.site_id AND b.time >= s.up),
  n AS (SELECT p.*, s.up AS nxt FROM p ASOF LEFT JOIN s ON p.site_id = s.site_id AND p.time < s.up),
  f AS (SELECT site_id, time, p1, COALESCE(p1 BETWEEN 5 AND 50, FALSE) AS small, COALESCE(date_diff('microsecond', time, nxt) <= 7.2e9, FALSE) AS ahead,
               COALESCE(date_diff('microsecond', prev, time) <= 7.2e9, FALSE) AS behind FROM n)"""


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    labelled = branch(spark, sf).select("site_id", "time", "p1")
    return labels.clean_labels(labelled, spikes(spark, sf), SITE_QUARTERS, "p1", "d87", "event_time", startup_w=192.0)


@query(
    SQL_CLEANED
    + f""" SELECT site_id, time, {sql_round('p1', 6)} AS p1, small, small AND ahead AS before_startup, small AND NOT ahead AND NOT behind AS isolated,
            {sql_round('CASE WHEN small AND (ahead OR NOT behind) THEN 0 ELSE p1 END', 6)} AS cleaned_w FROM f"""
)
def clean_labels(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-5/6, SEG-12."""
    return settled(_cleaned(spark, sf), 6, "p1", "cleaned_w")


@query(
    SQL_CLEANED
    + f""", r AS (SELECT site_id, COUNT(*) FILTER (WHERE small) AS n_small_loads_total, COUNT(*) FILTER (WHERE small AND (ahead OR NOT behind)) AS n_cleaned_to_zero,
            COUNT(*) FILTER (WHERE small AND ahead) AS cleaned_in_startup_window, COUNT(*) FILTER (WHERE small AND NOT ahead AND NOT behind) AS cleaned_isolated,
            SUM(p1) * 0.25 / 1000 AS o, SUM(CASE WHEN small AND (ahead OR NOT behind) THEN 0 ELSE p1 END) * 0.25 / 1000 AS c FROM f GROUP BY 1)
          SELECT r.* EXCLUDE (o, c), {sql_round('o', 6)} AS original_kwh, {sql_round('c', 6)} AS cleaned_kwh, {sql_round('o - c', 6)} AS kwh_reduction, n_startup_points
          FROM r JOIN (SELECT site_id, COUNT(*) FILTER (WHERE ABS(d87) >= 192) AS n_startup_points FROM ({SQL_SPIKES}) GROUP BY 1) USING (site_id)"""
)
def label_cleaning_report(spark: SparkSession, sf: str) -> DataFrame:
    out = labels.cleaning_report(_cleaned(spark, sf), spikes(spark, sf), SITE_QUARTERS, "p1", "d87", 192.0)
    return settled(out, 6, "original_kwh", "cleaned_kwh", "kwh_reduction")


# Startups where the local threshold, lowered by the step's probability, is reached.
SQL_STARTUPS = f"""SELECT s.site_id, s.event_time AS up FROM ({SQL_SPIKES}) s
  LEFT JOIN (SELECT site_id, ts, p_on FROM ({SQL_STEPS})) p ON p.site_id = s.site_id AND p.ts = time_bucket(INTERVAL 15 MINUTE, s.event_time)
  WHERE ABS(d87) >= 260 * LEAST(GREATEST(1 - 0.3 * COALESCE(p_on, 0), 0.6), 1)"""
SQL_SEEN = f"""SELECT t.*, s.up FROM (SELECT *, ts + INTERVAL 15 MINUTE AS until FROM ({SQL_STEPS})) t
  ASOF LEFT JOIN (SELECT DISTINCT site_id, up FROM ({SQL_STARTUPS})) s ON s.site_id = t.site_id AND t.until >= s.up"""


def _startups(spark: SparkSession, sf: str) -> DataFrame:
    limits = bus(spark, sf).select("site_id").distinct().withColumn("guard_w", F.lit(260.0))
    return guard.startups(spikes(spark, sf), steps(spark, sf), limits, ["site_id"], "event_time", "d87", "ts")


@query(f"SELECT site_id, up AS startup_ts, COUNT(*) AS n FROM ({SQL_STARTUPS}) GROUP BY 1, 2")
def startup_events(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-8, SEG-8."""
    return _startups(spark, sf).groupBy("site_id", "startup_ts").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT site_id, ts, up AS last_startup, {sql_round("date_diff('microsecond', up, ts) / 3.6e9", 6)} AS since_h FROM ({SQL_SEEN})")
def last_startup(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-7."""
    out = startup_as_of(steps(spark, sf).select("site_id", "ts"), _startups(spark, sf), STEPS)
    return settled(out, 6, "since_h")


@query(
    f"""WITH g AS (SELECT *, up IS NULL OR date_diff('microsecond', up, ts) / 3.6e9 > 2 AS s FROM ({SQL_SEEN}))
        SELECT site_id, ts, s AS suppressed, CASE WHEN s THEN 0 ELSE state_pred END AS state_pred, CASE WHEN s THEN 0 ELSE p_on END AS p_on,
               {sql_round('CASE WHEN s THEN 0 ELSE y_pred END', 6)} AS y_pred FROM g"""
)
def guarded_steps(spark: SparkSession, sf: str) -> DataFrame:
    """SEG-7: state, probability and power are zeroed where no startup is recent enough."""
    masked = guard.guard_mask(steps(spark, sf), _startups(spark, sf), STEPS, max_on_h=2.0)
    out = guard.suppress(masked, ["state_pred", "p_on", "y_pred"])
    return settled(out.select("site_id", "ts", "suppressed", "state_pred", "p_on", "y_pred"), 6, "y_pred")


@query(
    f"""WITH g AS (SELECT site_id, ts, up IS NULL OR date_diff('microsecond', up, ts) / 3.6e9 > 2 AS s, y_pred FROM ({SQL_SEEN}))
        SELECT site_id, model, COUNT(*) AS n_steps, COUNT(*) FILTER (WHERE s) AS n_suppressed, {sql_round('SUM(CASE WHEN s THEN 0 ELSE y_pred * f END)', 5)} AS sum_w
        FROM g CROSS JOIN (VALUES ('rf', 0.9::DOUBLE), ('naive', 0.5::DOUBLE)) m(model, f) GROUP BY 1, 2"""
)
def guarded_baselines(spark: SparkSession, sf: str) -> DataFrame:
    """SEG-9: the same mask on every baseline."""
    masked = guard.guard_mask(steps(spark, sf), _startups(spark, sf), STEPS, max_on_h=2.0)
    tracks = F.array(*[F.struct(F.lit(m).alias("model"), (F.col("y_pred") * f).alias("y_base")) for m, f in (("rf", 0.9), ("naive", 0.5))])
    long = guard.suppress(masked.select("site_id", "ts", "suppressed", F.inline(tracks)), ["y_base"])
    out = long.groupBy("site_id", "model").agg(F.count(F.lit(1)).alias("n_steps"), F.count_if("suppressed").alias("n_suppressed"), F.sum("y_base").alias("sum_w"))
    return settled(out, 5, "sum_w")


SQL_CALIBRATION = f"""
  WITH b AS (SELECT site_id, time, COALESCE(p1, 0) AS p1 FROM ({SQL_BRANCH})), s AS ({SQL_SPIKES}),
  e AS (SELECT site_id, time FROM (SELECT *, lag(p1) OVER (PARTITION BY site_id ORDER BY time) AS pv FROM b) WHERE p1 > 50 AND COALESCE(pv, 0) <= 50),
  q AS (SELECT site_id, lead(time, 2) OVER w AS time, lead(time, 4) OVER w AS l4, MAX(p1) OVER (PARTITION BY site_id ORDER BY time ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS top FROM b WINDOW w AS (PARTITION BY site_id ORDER BY time)),
  c AS (SELECT site_id, time FROM q WHERE l4 IS NOT NULL AND top < 60),
  onw AS (SELECT e.site_id, e.time, MAX(ABS(d87)) AS am, MIN(d87) AS mn FROM e JOIN s ON s.site_id = e.site_id AND event_time BETWEEN time - INTERVAL 20 MINUTE AND time + INTERVAL 10 MINUTE GROUP BY 1, 2),
  offw AS (SELECT c.site_id, c.time, MAX(ABS(d87)) AS am, MIN(d87) AS mn FROM c JOIN s ON s.site_id = c.site_id AND event_time BETWEEN time - INTERVAL 15 MINUTE AND time + INTERVAL 15 MINUTE GROUP BY 1, 2),
  m AS (SELECT * FROM (SELECT site_id, COUNT(*) AS n_on_amax, quantile_cont(am, 0.1) AS on_p10_abs, quantile_cont(mn, 0.9) AS train_on_p90 FROM onw GROUP BY 1)
        JOIN (SELECT site_id, COUNT(*) AS n_off_amax, quantile_cont(am, 0.99) AS off_p99_abs, quantile_cont(mn, 0.05) AS train_off_p5 FROM offw GROUP BY 1) USING (site_id)
        JOIN (SELECT site_id, quantile_cont(d73, 0.95) AS train_d73_p95 FROM s GROUP BY 1) USING (site_id)),
  f AS (SELECT *, 0.75 + 0.15 * SQRT(LEAST(n_on_amax / 30, 1)) AS allow_factor, 1.05 + 0.25 * SQRT(LEAST(n_off_amax / 1500, 1)) AS margin_factor FROM m),
  g AS (SELECT *, on_p10_abs * allow_factor AS on_constraint, off_p99_abs * margin_factor AS off_constraint FROM f),
  h AS (SELECT *, 1 / (1 + EXP(-(ABS(on_constraint - off_constraint) - 15) / 8)) AS softmax_weight FROM g),
  meta AS (SELECT *, softmax_weight * GREATEST(on_constraint, off_constraint) + (1 - softmax_weight) * (on_constraint + off_constraint) / 2 AS threshold_abs FROM h)"""
META = ["on_p10_abs", "off_p99_abs", "train_on_p90", "train_off_p5", "train_d73_p95", "allow_factor", "margin_factor", "on_constraint", "off_constraint", "softmax_weight", "threshold_abs"]


def _meta(spark: SparkSession, sf: str) -> DataFrame:
    labelled = branch(spark, sf).withColumn("p1", F.coalesce("p1", F.lit(0.0)))
    return guard.calibrate(labelled, spikes(spark, sf), SITE_QUARTERS, "p1", "d87", "d73", "event_time", off_w=60.0)


@query(SQL_CALIBRATION + f" SELECT site_id, n_on_amax, n_off_amax, {', '.join(f'{sql_round(c, 6)} AS {c}' for c in META)}, CASE WHEN on_constraint >= off_constraint THEN 'ON' ELSE 'OFF' END AS binding FROM meta")
def guard_calibration(spark: SparkSession, sf: str) -> DataFrame:
    """SEG-10/11, JOI-9, SCL-8/9, AGG-33."""
    return settled(_meta(spark, sf).select("site_id", "n_on_amax", "n_off_amax", "binding", *META), 6, *META)


@query(
    SQL_CALIBRATION
    + f""", d AS (SELECT site_id, CAST(event_time AS DATE) AS day, MAX(ABS(d87)) AS peak FROM s GROUP BY 1, 2),
          v AS (SELECT site_id, COUNT(*) FILTER (WHERE peak >= threshold_abs) / COUNT(*) AS cover, COUNT(*) AS n_days FROM d JOIN meta USING (site_id) GROUP BY 1)
          SELECT site_id, {sql_round('threshold_abs', 6)} AS threshold_abs, GREATEST(off_p99_abs, on_p10_abs, threshold_abs) < 50 AS trigger_a, ROUND(cover, 6) AS cover_ratio, n_days, cover < 0.3 AS trigger_b,
                 NOT (GREATEST(off_p99_abs, on_p10_abs, threshold_abs) < 50 OR cover < 0.3) AS enabled FROM meta JOIN v USING (site_id)"""
)
def guard_auto_disable(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-34."""
    out = guard.auto_disable(_meta(spark, sf), spikes(spark, sf), ["site_id"], "d87", "event_time")
    shown = out.select("site_id", "threshold_abs", "trigger_a", "cover_ratio", "n_days", "trigger_b", "enabled")
    return settled(rounded(shown, 6, "cover_ratio"), 6, "threshold_abs")


@query(
    SQL_CALIBRATION
    + f""", u AS (SELECT site_id, quantile_cont(d73, 0.95) AS q FROM s WHERE dayofmonth(event_time) > 20 GROUP BY 1)
          SELECT site_id, {sql_round('q', 6)} AS user_d73_p95, {sql_round('LEAST(GREATEST(q / train_d73_p95, 0.05), 2)', 6)} AS scale,
                 {sql_round('threshold_abs * LEAST(GREATEST(q / train_d73_p95, 0.05), 2)', 6)} AS guard_w FROM meta JOIN u USING (site_id)"""
)
def guard_scaling(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-35."""
    late = spikes(spark, sf).where(F.dayofmonth("event_time") > 20)
    out = guard.scaled_threshold(_meta(spark, sf), late, ["site_id"], "d73")
    return settled(out.select("site_id", "user_d73_p95", "scale", "guard_w"), 6, "user_d73_p95", "scale", "guard_w")


def _sql_curve(grid: str, filtered: bool) -> str:
    """Every threshold applied to every row, with the run filters counted out per threshold."""
    rows = f"SELECT t.thr, p.* EXCLUDE (state_pred), CAST(p_on >= t.thr AS INT) AS s0 FROM ({SQL_PRED}) p CROSS JOIN ({grid}) t WHERE split = 'val'"
    if not filtered:
        return f"SELECT *, s0 AS state_pred FROM ({rows})"
    one = sql_islands(rows, "s0", "s1", 1, 2, "site_id, thr")
    two = sql_islands(f"SELECT * EXCLUDE (chg) FROM ({one})", "s1", "s2", 0, 2, "site_id, thr")
    return f"SELECT *, s2 AS state_pred FROM ({two})"


SQL_GRID = "SELECT i / 100.0::DOUBLE AS thr FROM (SELECT UNNEST(generate_series(2, 95)) AS i)"
SQL_SCORES = """ROUND("Precision", 6) AS "Precision", ROUND("Recall", 6) AS "Recall", ROUND("F1", 6) AS "F1", ROUND(COALESCE(1.25 * "Precision" * "Recall" / NULLIF(0.25 * "Precision" + "Recall", 0), 0), 6) AS f_beta"""
SQL_RAW_RATES = """COALESCE("TP" / NULLIF("TP" + "FP", 0), 0) AS "Precision", COALESCE("TP" / NULLIF("TP" + "FN", 0), 0) AS "Recall", COALESCE(2.0 * "TP" / NULLIF(2 * "TP" + "FP" + "FN", 0), 0) AS "F1" """


def _val_scores(spark: SparkSession, sf: str, filtered: bool = True) -> DataFrame:
    rows = pred(spark, sf).where("split = 'val'")
    if not filtered:
        return rows.withColumn("score", F.col("p_on"))
    return filter_short_runs(rows, site_events(spark, sf, "time"), "p_on", "score", 2, 1, scores=True)


@query(
    f"""WITH c AS (SELECT site_id, CAST(thr AS DOUBLE) AS threshold, {SQL_CONF} FROM ({_sql_curve(SQL_GRID, True)}) GROUP BY 1, 2), r AS (SELECT *, {SQL_RAW_RATES} FROM c)
        SELECT site_id, threshold, "TN", "FP", "FN", "TP", ROUND(("TP" + "TN") / ("TN" + "FP" + "FN" + "TP"), 6) AS "Accuracy", {SQL_SCORES} FROM r"""
)
def threshold_curve(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-31: 94 thresholds with both run filters, from one pass over the rows."""
    out = metrics.threshold_curve(_val_scores(spark, sf), ["site_id"], "score", "state_true")
    return rounded(out, 6, "Accuracy", "Precision", "Recall", "F1", "f_beta")


@query(
    f"""WITH c AS (SELECT site_id, CAST(thr AS DOUBLE) AS threshold, {SQL_CONF} FROM ({_sql_curve(SQL_GRID, True)}) GROUP BY 1, 2), r AS (SELECT *, {SQL_RAW_RATES} FROM c),
        f AS (SELECT *, COALESCE(1.25 * "Precision" * "Recall" / NULLIF(0.25 * "Precision" + "Recall", 0), 0) AS f_beta FROM r),
        k AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY f_beta DESC, threshold) AS rn FROM f)
        SELECT site_id, threshold AS best_thr, ROUND(f_beta, 6) AS best_score FROM k WHERE rn = 1"""
)
def best_threshold(spark: SparkSession, sf: str) -> DataFrame:
    curve = metrics.threshold_curve(_val_scores(spark, sf), ["site_id"], "score", "state_true")
    return rounded(metrics.best_threshold(curve, ["site_id"]), 6, "best_score")


@query(
    f"""WITH c AS (SELECT CAST(thr AS DOUBLE) AS threshold, {SQL_CONF} FROM ({_sql_curve("SELECT UNNEST([0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8])::DOUBLE AS thr", False)}) GROUP BY 1), r AS (SELECT *, {SQL_RAW_RATES} FROM c)
        SELECT threshold, "FP", "FN", ROUND("Precision", 6) AS "Precision", ROUND("Recall", 6) AS "Recall", ROUND("F1", 6) AS "F1" FROM r"""
)
def threshold_sensitivity(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-32."""
    out = metrics.threshold_curve(_val_scores(spark, sf, False), [], "score", "state_true", [0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8])
    return rounded(out.select("threshold", "FP", "FN", "Precision", "Recall", "F1"), 6, "Precision", "Recall", "F1")


@query(
    f"""WITH c AS (SELECT user_id, CAST(thr AS DOUBLE) AS threshold, {SQL_CONF} FROM ({_sql_curve("SELECT i / 100.0::DOUBLE AS thr FROM (SELECT UNNEST(generate_series(10, 90)) AS i)", False)}) GROUP BY 1, 2), r AS (SELECT *, {SQL_RAW_RATES} FROM c),
        k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "F1" DESC, threshold) AS rn FROM r)
        SELECT user_id, threshold AS best_thr, ROUND("F1", 6) AS best_score FROM k WHERE rn = 1"""
)
def best_f1_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-32: best raw F1 on 81 thresholds, per user."""
    curve = metrics.threshold_curve(_val_scores(spark, sf, False), ["user_id"], "score", "state_true", [i / 100 for i in range(10, 91)])
    return rounded(metrics.best_threshold(curve, ["user_id"], "F1"), 6, "best_score")


SQL_DENSITY = f"""
  WITH o AS (SELECT event_id, site_id, d73 AS y FROM ({SQL_BUS}) WHERE d73 >= 10), m AS (SELECT site_id, MIN(y) AS lo, (MAX(y) + 1e-6 - MIN(y)) / 20 AS wd FROM o GROUP BY 1),
  b AS (SELECT o.*, LEAST(GREATEST(FLOOR((y - lo) / wd), 0), 19) AS bin FROM o JOIN m USING (site_id)),
  d AS (SELECT *, 1.0 / COUNT(*) OVER (PARTITION BY site_id, bin) AS w FROM b),
  c AS (SELECT *, LEAST(w, quantile_cont(w, 0.95) OVER (PARTITION BY site_id)) AS w1 FROM d),
  f AS (SELECT *, GREATEST(w1, 0.1 * AVG(w1) OVER (PARTITION BY site_id)) AS w2 FROM c),
  g AS (SELECT *, w2 / AVG(w2) OVER (PARTITION BY site_id) AS weight FROM f)"""


def _weighted(spark: SparkSession, sf: str) -> DataFrame:
    on = bus(spark, sf).where("d73 >= 10").select("event_id", "site_id", F.col("d73").alias("y"))
    return weights.inverse_density(on, ["site_id"], "y")


@query(SQL_DENSITY + f" SELECT event_id, site_id, y, {sql_round('weight', 6)} AS weight FROM g")
def inverse_density_weights(spark: SparkSession, sf: str) -> DataFrame:
    """ML-11."""
    return settled(_weighted(spark, sf).select("event_id", "site_id", "y", "weight"), 6, "weight")


@query(
    SQL_DENSITY
    + f""", q AS (SELECT site_id, [quantile_cont(y, 0.0), quantile_cont(y, 0.2), quantile_cont(y, 0.4), quantile_cont(y, 0.6), quantile_cont(y, 0.8), quantile_cont(y, 1.0)] AS e FROM g GROUP BY 1),
          k AS (SELECT g.*, e, CASE WHEN y < e[2] THEN 0 WHEN y < e[3] THEN 1 WHEN y < e[4] THEN 2 WHEN y < e[5] THEN 3 ELSE 4 END AS bin_id FROM g JOIN q USING (site_id))
          SELECT site_id, bin_id, {sql_round('MAX(e[bin_id + 1])', 6)} AS low, {sql_round('MAX(e[bin_id + 2])', 6)} AS high, COUNT(*) AS n, {sql_round('AVG(weight)', 6)} AS avg_weight FROM k GROUP BY 1, 2"""
)
def weight_summary(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-37."""
    return settled(weights.weight_summary(_weighted(spark, sf), ["site_id"], "y"), 6, "low", "high", "avg_weight")


@query(
    f"""WITH o AS (SELECT event_id, site_id, d73 AS y, quantile_cont(d73, 0.5) OVER (PARTITION BY site_id) AS med FROM ({SQL_BUS})),
        a AS (SELECT *, quantile_cont(ABS(y - med), 0.5) OVER (PARTITION BY site_id) + 1e-6 AS mad FROM o),
        w AS (SELECT *, 1 + 0.25 * EXP(-POWER(ABS(1 / (1 + EXP(-(y - med) / (mad * 0.8))) - 0.5), 2) / (2 * 0.15 * 0.15)) AS w FROM a)
        SELECT event_id, {sql_round('w / AVG(w) OVER (PARTITION BY site_id)', 6)} AS weight FROM w"""
)
def boundary_weights(spark: SparkSession, sf: str) -> DataFrame:
    """ML-12 without predictions."""
    out = weights.boundary_focal(bus(spark, sf).select("event_id", "site_id", "d73"), ["site_id"], "d73")
    return settled(out.select("event_id", "weight"), 6, "weight")


@query(
    f"""WITH p AS (SELECT event_id, site_id, LEAST(GREATEST(CASE WHEN state_true >= 0.5 THEN p_on ELSE 1 - p_on END, 1e-6), 1 - 1e-6) AS pt FROM ({SQL_PRED})),
        w AS (SELECT *, 0.25 * POWER(1 - pt, 2) + 0.75 AS w FROM p)
        SELECT event_id, {sql_round('w / AVG(w) OVER (PARTITION BY site_id)', 6)} AS weight FROM w"""
)
def focal_weights(spark: SparkSession, sf: str) -> DataFrame:
    """ML-12 with predictions."""
    rows = pred(spark, sf).select("event_id", "site_id", F.col("state_true").cast("double").alias("state_true"), "p_on")
    out = weights.boundary_focal(rows, ["site_id"], "state_true", "p_on")
    return settled(out.select("event_id", "weight"), 6, "weight")


@query(
    f"""SELECT user_id, COUNT(*) AS n_rows, CASE WHEN COUNT(*) < 50 THEN 100 WHEN COUNT(*) < 150 THEN 200 ELSE 300 END AS trees, CASE WHEN COUNT(*) < 50 THEN 2 ELSE 3 END AS depth,
               CASE WHEN COUNT(*) < 50 THEN 0.08 WHEN COUNT(*) < 150 THEN 0.06 ELSE 0.05 END::DOUBLE AS rate, CASE WHEN COUNT(*) < 50 THEN 0.9 WHEN COUNT(*) < 150 THEN 0.85 ELSE 0.8 END::DOUBLE AS sample,
               CASE WHEN COUNT(*) < 50 THEN 8 WHEN COUNT(*) < 150 THEN 5 WHEN COUNT(*) < 300 THEN 3 ELSE 2 END AS min_leaf FROM ({SQL_PRED}) GROUP BY 1"""
)
def small_data_settings(spark: SparkSession, sf: str) -> DataFrame:
    """ML-15; ten-fold row counts, since users of these tables have few rows."""
    counts = pred(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("s", weights.small_data_settings(F.col("n_rows") * 10)).select("user_id", "n_rows", "s.*")

