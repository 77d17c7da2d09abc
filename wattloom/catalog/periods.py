"""Run periods, daily summaries and short-run filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.catalog.registry import query
from wattloom.catalog.views import SITE_QUARTERS, SQL_BRANCH, SQL_BUS, SQL_PRED, as_counts, branch, bus, pred, rounded, site_events, user_events
from wattloom.operators.resample import raw_daily_counts
from wattloom.operators.series import attach
from wattloom.operators.segments import daily_summary, filter_short_runs, off_centres, on_edges, on_periods, post_filter

THRESHOLD = 50

SQL_STEPS = f"""
  rows AS (SELECT site_id, event_time, event_id, d73, CAST(d73 >= {THRESHOLD} AS INT) AS state,
             date_diff('microsecond', lag(event_time) OVER (PARTITION BY site_id ORDER BY event_time, event_id), event_time) / 1e6 AS dt
           FROM ({SQL_BUS})),
  steps AS (SELECT site_id, quantile_cont(dt, 0.5) AS step_s FROM rows WHERE dt IS NOT NULL GROUP BY 1)"""


def _sql_periods(by_day: bool) -> str:
    day_cut = "OR CAST(event_time AS DATE) <> CAST(lag(event_time) OVER w AS DATE)" if by_day else ""
    off = (
        "HAVING MAX(state) = 0"
        if by_day
        else "HAVING (site_id, CAST(MIN(event_time) AS DATE)) NOT IN (SELECT (site_id, date) FROM on_runs)"
    )
    return f"""
  WITH {SQL_STEPS},
  marked AS (SELECT *, CASE WHEN lag(state) OVER w IS NULL OR state <> lag(state) OVER w {day_cut} THEN 1 ELSE 0 END AS brk
             FROM rows WINDOW w AS (PARTITION BY site_id ORDER BY event_time, event_id)),
  numbered AS (SELECT *, SUM(brk) OVER (PARTITION BY site_id ORDER BY event_time, event_id) AS run FROM marked),
  on_runs AS (SELECT site_id, run, CAST(MIN(event_time) AS DATE) AS date, 1 AS state, MIN(event_time) AS b, MAX(event_time) AS e,
               COUNT(*) AS n, SUM(d73) AS s, MIN(d73) AS lo, MAX(d73) AS hi
             FROM numbered WHERE state = 1 GROUP BY 1, 2),
  off_rows AS (SELECT site_id, -1 AS run, CAST(event_time AS DATE) AS date, 0 AS state, MIN(event_time) AS b, MAX(event_time) AS e,
               COUNT(*) AS n, SUM(d73) AS s, MIN(d73) AS lo, MAX(d73) AS hi
             FROM rows GROUP BY site_id, CAST(event_time AS DATE) {off}),
  spans AS (SELECT * FROM on_runs UNION ALL SELECT * FROM off_rows),
  periods AS (SELECT site_id, date, b AS begin_time, e AS end_time, state,
                (date_diff('microsecond', b, e) / 1e6 + step_s) / 60.0 AS duration_min, lo AS min_w, s / n AS mean_w, hi AS peak_w,
                s * (step_s / 3600.0) / 1000.0 AS energy_kwh
              FROM spans JOIN steps USING (site_id))"""


SQL_PERIOD_COLUMNS = """
  SELECT site_id, date, begin_time, end_time, state, ROUND(duration_min, 4) AS duration_min, ROUND(min_w, 3) AS min_w,
         ROUND(mean_w, 6) AS mean_w, ROUND(peak_w, 3) AS peak_w, ROUND(energy_kwh, 6) AS energy_kwh FROM periods"""


def _periods(spark: SparkSession, sf: str, **options) -> DataFrame:
    return on_periods(bus(spark, sf), site_events(spark, sf), "d73", THRESHOLD, **options)


def _shown(df: DataFrame) -> DataFrame:
    return rounded(rounded(rounded(df, 3, "min_w", "peak_w"), 6, "mean_w", "energy_kwh"), 4, "duration_min")


@query(_sql_periods(False) + SQL_PERIOD_COLUMNS)
def on_periods_whole(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_periods(spark, sf, split_by_day=False))


@query(_sql_periods(True) + SQL_PERIOD_COLUMNS)
def on_periods_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(_periods(spark, sf))


# Every site with an ON threshold of its own, five above its mean.
SQL_OWN = f"(SELECT b.*, th FROM ({SQL_BUS}) b JOIN (SELECT site_id, ROUND(AVG(d73)) + 5 AS th FROM ({SQL_BUS}) GROUP BY 1) USING (site_id))"


@query((_sql_periods(True) + SQL_PERIOD_COLUMNS).replace(f"d73 >= {THRESHOLD}", "d73 >= th").replace(f"({SQL_BUS})", SQL_OWN, 1))
def on_periods_own_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-6, SEG-2 with a threshold per site."""
    rows = bus(spark, sf)
    own = rows.groupBy("site_id").agg((F.round(F.avg("d73")) + 5).alias("on_w"))
    return _shown(on_periods(attach(rows, own, ["site_id"]), site_events(spark, sf), "d73", "on_w"))


@query((_sql_periods(True) + SQL_PERIOD_COLUMNS.replace("FROM periods", "FROM periods WHERE state = 0")).replace("site_id", "user_id").replace("event_type AS user_id, user_id,", "event_type AS site_id, user_id,"))
def off_days(spark: SparkSession, sf: str) -> DataFrame:
    """SEG-3 per user, whose sparse days often have no ON sample."""
    return _shown(on_periods(bus(spark, sf), user_events(spark, sf), "d73", THRESHOLD).where("state = 0"))


@query(
    _sql_periods(True)
    + """
  , counts AS (SELECT site_id, CAST(event_time AS DATE) AS date, COUNT(*) AS n_raw FROM rows GROUP BY 1, 2),
  branch_counts AS (SELECT site_id, CAST(time AS DATE) AS date, COUNT(*) AS n_raw FROM ("""
    + SQL_BRANCH
    + """) WHERE time >= TIMESTAMP '2024-01-03 00:00:00' GROUP BY 1, 2)
  SELECT p.site_id, p.date, COUNT(*) FILTER (WHERE state = 1) AS n_segments,
         ROUND(COALESCE(SUM(duration_min) FILTER (WHERE state = 1), 0), 4) AS total_on_min,
         ROUND(COALESCE(SUM(duration_min) FILTER (WHERE state = 1), 0) / 60.0, 5) AS total_on_hours,
         strftime(MIN(begin_time) FILTER (WHERE state = 1), '%H:%M:%S') AS first_on_time,
         strftime(MAX(end_time) FILTER (WHERE state = 1), '%H:%M:%S') AS last_off_time,
         ROUND(COALESCE(MIN(min_w) FILTER (WHERE state = 1), MIN(min_w)), 3) AS min_w,
         ROUND(COALESCE(SUM(mean_w * duration_min) FILTER (WHERE state = 1) / SUM(duration_min) FILTER (WHERE state = 1), MAX(mean_w)), 6) AS mean_w,
         ROUND(COALESCE(MAX(peak_w) FILTER (WHERE state = 1), MAX(peak_w)), 3) AS peak_w,
         ROUND(COALESCE(SUM(energy_kwh) FILTER (WHERE state = 1), MAX(energy_kwh)), 6) AS energy_kwh,
         COALESCE(MAX(c.n_raw), 0) AS n_bus_raw, COALESCE(MAX(bc.n_raw), 0) AS n_branch_raw
  FROM periods p LEFT JOIN counts c ON c.site_id = p.site_id AND c.date = p.date
       LEFT JOIN branch_counts bc ON bc.site_id = p.site_id AND bc.date = p.date
  GROUP BY 1, 2"""
)
def daily_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-6 with JOI-10: label counts start on the third day, so earlier days show the default 0."""
    labels = branch(spark, sf).where(F.col("time") >= F.lit("2024-01-03 00:00:00").cast("timestamp_ntz"))
    out = daily_summary(
        _periods(spark, sf),
        ["site_id"],
        raw_daily_counts(bus(spark, sf), ["site_id"], "event_time"),
        raw_daily_counts(labels, ["site_id"], "time"),
    )
    out = rounded(rounded(rounded(out, 3, "min_w", "peak_w"), 6, "mean_w", "energy_kwh"), 4, "total_on_min")
    return rounded(out, 5, "total_on_hours")


def sql_islands(source: str, state: str, out: str, value: int, limit: int, part: str = "site_id") -> str:
    """Flip runs of `value` shorter than `limit` by counting island rows."""
    return f"""
  SELECT * EXCLUDE (g, len), CASE WHEN {state} = {value} AND len < {limit} THEN 1 - {value} ELSE {state} END AS {out}
  FROM (SELECT *, COUNT(*) OVER (PARTITION BY {part}, g) AS len
        FROM (SELECT *, SUM(chg) OVER (PARTITION BY {part} ORDER BY time, event_id) AS g
              FROM (SELECT *, CASE WHEN lag({state}) OVER (PARTITION BY {part} ORDER BY time, event_id) = {state} THEN 0 ELSE 1 END AS chg
                    FROM ({source})) ) )"""


def _sql_filtered(min_on: int, fill: int) -> str:
    first = sql_islands(SQL_PRED, "state_pred", "s1", 1, min_on)
    # The helper leaves `chg` behind; drop it before the second pass.
    return sql_islands(f"SELECT * EXCLUDE (chg) FROM ({first})", "s1", "s2", 0, fill + 1)


@query(
    f"""SELECT event_id, site_id, time, CAST(s2 AS INT) AS state_filt,
               ROUND(CASE WHEN s2 = 1 THEN y_pred ELSE 0 END, 6) AS y_pred_filt FROM ({_sql_filtered(2, 1)})"""
)
def post_filter_states(spark: SparkSession, sf: str) -> DataFrame:
    out = post_filter(pred(spark, sf), site_events(spark, sf, "time"), "state_pred", "y_pred", 2, 1)
    return rounded(out.select("event_id", "site_id", "time", "state_filt", "y_pred_filt"), 6, "y_pred_filt")


@query(
    f"""SELECT site_id, split, COUNT(*) AS n, CAST(SUM(s2) AS BIGINT) AS n_on, CAST(SUM(state_pred) AS BIGINT) AS n_on_raw
        FROM ({_sql_filtered(3, 2)}) GROUP BY 1, 2"""
)
def post_filter_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = filter_short_runs(pred(spark, sf), site_events(spark, sf, "time"), "state_pred", "s2", 3, 2)
    return out.groupBy("site_id", "split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("s2").alias("n_on"), F.sum("state_pred").alias("n_on_raw")
    )


@query(
    f"""SELECT site_id, time, ROUND(p1, 6) AS p1 FROM (
          SELECT *, COALESCE(p1 > 50, FALSE) AS cur, COALESCE(lag(p1) OVER (PARTITION BY site_id ORDER BY time) > 50, FALSE) AS prv
          FROM ({SQL_BRANCH})) WHERE cur AND NOT prv"""
)
def start_edges(spark: SparkSession, sf: str) -> DataFrame:
    out = on_edges(branch(spark, sf), SITE_QUARTERS, "p1", 50.0)
    return rounded(out.select("site_id", "time", "p1"), 6, "p1")


@query(
    f"""SELECT site_id, lead2 AS centre_ts FROM (
          SELECT site_id, lead(time, 2) OVER w AS lead2, lead(time, 4) OVER w AS lead4,
                 MAX(p) OVER f AS top, COUNT(p) OVER f AS c
          FROM (SELECT *, COALESCE(p1, 0) AS p FROM ({SQL_BRANCH}))
          WINDOW w AS (PARTITION BY site_id ORDER BY time), f AS (PARTITION BY site_id ORDER BY time ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING))
        WHERE lead4 IS NOT NULL AND c = 4 AND top < 60"""
)
def quiet_windows(spark: SparkSession, sf: str) -> DataFrame:
    labels = branch(spark, sf).withColumn("p", F.coalesce("p1", F.lit(0.0)))
    return off_centres(labels, SITE_QUARTERS, "p", 60.0)


@query(
    f"""SELECT site_id, COUNT(*) AS n_segments, ROUND(SUM(d), 4) AS total_min FROM (
          SELECT site_id, date_diff('microsecond', MIN(event_time), MAX(event_time)) / 6e7 AS d FROM (
            SELECT *, SUM(brk) OVER (PARTITION BY site_id ORDER BY event_time, event_id) AS run FROM (
              SELECT *, CASE WHEN lag(state) OVER w IS NULL OR state <> lag(state) OVER w
                          OR date_diff('microsecond', lag(event_time) OVER w, event_time) / 1e6 > 1800 THEN 1 ELSE 0 END AS brk
              FROM (SELECT *, CAST(d73 >= {THRESHOLD} AS INT) AS state FROM ({SQL_BUS}))
              WINDOW w AS (PARTITION BY site_id ORDER BY event_time, event_id)))
          WHERE state = 1 GROUP BY site_id, run) GROUP BY 1"""
)
def on_periods_gap_limit(spark: SparkSession, sf: str) -> DataFrame:
    """SEG-1 with runs that end at a silence of more than 30 minutes."""
    on = _periods(spark, sf, split_by_day=False, max_gap_s=1800.0, off_days=False)
    minutes = (F.unix_micros(F.col("end_time").cast("timestamp")) - F.unix_micros(F.col("begin_time").cast("timestamp"))) / 6e7
    out = on.groupBy("site_id").agg(F.count(F.lit(1)).alias("n_segments"), F.sum(minutes).alias("total_min"))
    return rounded(as_counts(out, "n_segments"), 4, "total_min")
