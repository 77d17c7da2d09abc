"""Binning, grids, gap filling, weather and joins in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.catalog.registry import query
from wattloom.catalog.views import SITE_HOURS, SQL_BRANCH, SQL_BUS, SQL_HOURLY, SQL_PRED, as_counts, branch, bus, hourly, pred, rounded, site_events, table
from wattloom.functions.timeparse import floor_to
from wattloom.operators import joins, resample
from wattloom.operators.reports import monthly_weather
from wattloom.plans.align import align_meters
from wattloom.sources import weather as wx

SQL_MONTH_MEANS = "CASE month(time) " + " ".join(
    f"WHEN {m} THEN {t}" for m, t in enumerate([4.3, 6.2, 11.0, 17.2, 22.1, 26.0, 28.9, 28.5, 23.7, 17.6, 11.5, 6.3], 1)
) + " END::DOUBLE"


def sql_weather(spans: str, key: str) -> str:
    """Hourly climatology for rows (key, start, end) of dates."""
    temp = f"{SQL_MONTH_MEANS} + 5 * sin((hour(time) - 8) * 2 * pi() / 24)"
    return f"""SELECT {key}, time, ROUND({temp}, 2) AS temperature_2m, ROUND({temp} + 1.5, 2) AS apparent_temperature, 70.0::DOUBLE AS relative_humidity_2m
      FROM (SELECT {key}, UNNEST(generate_series(CAST("start" AS TIMESTAMP), CAST("end" AS TIMESTAMP), INTERVAL 1 HOUR)) AS time FROM ({spans}))"""


SQL_SITE_SPANS = """SELECT event_type AS site_id, CAST(MIN(ts) AS DATE) - 1 AS "start", CAST(MAX(ts) AS DATE) + 1 AS "end" FROM events GROUP BY 1"""
SQL_SITE_WEATHER = sql_weather(SQL_SITE_SPANS, "site_id")


def site_spans(spark: SparkSession, sf: str) -> DataFrame:
    return wx.padded_span(bus(spark, sf), ["site_id"], "event_time")


def site_weather(spark: SparkSession, sf: str) -> DataFrame:
    return wx.climatology(site_spans(spark, sf), ["site_id"])


SQL_QUARTER = f"""
  WITH h AS (SELECT *, lead(time) OVER w AS nt, lead(temperature_2m) OVER w AS nx FROM ({SQL_SITE_WEATHER}) WINDOW w AS (PARTITION BY site_id ORDER BY time)),
  q AS (SELECT *, UNNEST(generate_series(time, COALESCE(nt - INTERVAL 15 MINUTE, time + INTERVAL 45 MINUTE), INTERVAL 15 MINUTE)) AS t15 FROM h)
  SELECT site_id, t15 AS time, temperature_2m + COALESCE((nx - temperature_2m) * date_diff('second', time, t15) / date_diff('second', time, nt), 0) AS temperature_2m FROM q"""


@query(f"SELECT site_id, time_bucket(INTERVAL 15 MINUTE, event_time) AS ts, ROUND(AVG(d73), 6) AS d73, ROUND(AVG(d74), 6) AS d74 FROM ({SQL_BUS}) GROUP BY 1, 2")
def resample_mean(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(resample.tumbling_mean(bus(spark, sf), ["site_id"], "event_time", ["d73", "d74"]), 6, "d73", "d74")


@query(
    f"""SELECT site_id, time_bucket(INTERVAL 15 MINUTE, event_time) AS ts, ROUND(AVG(v), 6) AS d87, MAX(v) AS d87_max5, MIN(v) AS d87_min5, MAX(ABS(v)) AS d87_absmax5
        FROM (SELECT *, CASE WHEN d74 <> 0 THEN d87 END AS v FROM ({SQL_BUS})) GROUP BY 1, 2"""
)
def resample_extremes(spark: SparkSession, sf: str) -> DataFrame:
    readings = bus(spark, sf).withColumn("d87", F.when(F.col("d74") != 0, F.col("d87")))
    return rounded(resample.tumbling_mean(readings, ["site_id"], "event_time", [], ["d87"]), 6, "d87")


SQL_GRID = f"""
  WITH b AS ({SQL_HOURLY}), s AS (SELECT site_id, MIN(ts) AS lo, MAX(ts) AS hi FROM b GROUP BY 1),
  g AS (SELECT site_id, UNNEST(generate_series(lo, hi, INTERVAL 1 HOUR)) AS ts FROM s)"""


@query(SQL_GRID + " SELECT site_id, ts, ROUND(w, 6) AS w, ROUND(v, 6) AS v FROM g LEFT JOIN b USING (site_id, ts)")
def full_hour_grid(spark: SparkSession, sf: str) -> DataFrame:
    grid = resample.full_grid(hourly(spark, sf).select("site_id", "ts", "w", "v"), ["site_id"], "ts", 60)
    return rounded(grid, 6, "w", "v")


@query(
    SQL_GRID
    + """, f AS (SELECT site_id, ts, COALESCE(w, last_value(w IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY ts ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)) AS w FROM g LEFT JOIN b USING (site_id, ts)),
  r AS (SELECT site_id, ts, COALESCE(w, first_value(w IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING)) AS w FROM f)
  SELECT site_id, ts, ROUND(w, 6) AS w FROM r WHERE w IS NOT NULL"""
)
def bounded_gap_fill(spark: SparkSession, sf: str) -> DataFrame:
    """RES-3/4 with one step each way."""
    grid = resample.full_grid(hourly(spark, sf).select("site_id", "ts", "w"), ["site_id"], "ts", 60)
    return rounded(resample.fill_and_drop(grid, SITE_HOURS, ["w"], 1), 6, "w")


@query(
    SQL_GRID
    + """, f AS (SELECT site_id, ts, COALESCE(w, last_value(w IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY ts ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)) AS w FROM g LEFT JOIN b USING (site_id, ts)),
  r AS (SELECT site_id, ts, COALESCE(w, first_value(w IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING)) AS w FROM f)
  SELECT site_id, COUNT(*) AS n_before, COUNT(w) AS n_after, ROUND(1 - COUNT(w) / COUNT(*), 6) AS dropped_share FROM r GROUP BY 1"""
)
def gap_drop_share(spark: SparkSession, sf: str) -> DataFrame:
    grid = resample.full_grid(hourly(spark, sf).select("site_id", "ts", "w"), ["site_id"], "ts", 60)
    return rounded(resample.dropped_share(grid, resample.fill_and_drop(grid, SITE_HOURS, ["w"], 1), ["site_id"]), 6, "dropped_share")


@query(
    f"""WITH b AS (SELECT site_id, time_bucket(INTERVAL 15 MINUTE, event_time) AS ts, AVG(d73) AS d73, AVG(v) AS d87, MAX(v) AS hi, MIN(v) AS lo, MAX(ABS(v)) AS am
                   FROM (SELECT *, CASE WHEN d74 <> 0 THEN d87 END AS v FROM ({SQL_BUS})) WHERE CAST(event_time AS DATE) <> '2024-01-15' GROUP BY 1, 2),
        l AS (SELECT site_id, time AS ts, p1 + p2 AS y_ac FROM ({SQL_BRANCH}) WHERE p1 + p2 IS NOT NULL),
        j AS (SELECT * FROM b JOIN l USING (site_id, ts)),
        f AS (SELECT site_id, ts, y_ac, d73, """
    + ", ".join(f"COALESCE({c}, last_value({c} IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY ts ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)) AS {c}" for c in ("d87", "hi", "lo", "am"))
    + """ FROM j), r AS (SELECT site_id, ts, y_ac, d73, """
    + ", ".join(f"COALESCE({c}, first_value({c} IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)) AS {c}" for c in ("d87", "hi", "lo", "am"))
    + """ FROM f) SELECT site_id, ts, ROUND(y_ac, 6) AS y_ac, ROUND(d73, 6) AS load_iden_data73, ROUND(d87, 6) AS load_iden_data87,
        hi AS load_iden_data87_max5, lo AS load_iden_data87_min5, am AS load_iden_data87_absmax5 FROM r WHERE d87 IS NOT NULL"""
)
def aligned_table(spark: SparkSession, sf: str) -> DataFrame:
    """The whole alignment: day exclusion, bins with extremes, composite label, inner join, gap fill."""
    readings = bus(spark, sf).select(
        "site_id", "event_time", F.col("d73").alias("load_iden_data73"), F.when(F.col("d74") != 0, F.col("d87")).alias("load_iden_data87")
    )
    out = align_meters(readings, branch(spark, sf), ["site_id"], "p1+p2", exclude_days=["2024-01-15"])
    return rounded(out, 6, "y_ac", "load_iden_data73", "load_iden_data87")


@query(SQL_SITE_WEATHER)
def hourly_climatology(spark: SparkSession, sf: str) -> DataFrame:
    return site_weather(spark, sf)


@query(f"SELECT site_id, time, ROUND(temperature_2m, 6) AS temperature_2m FROM ({SQL_QUARTER})")
def quarter_hour_weather(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(wx.quarter_hourly(site_weather(spark, sf), ["site_id"]).select("site_id", "time", "temperature_2m"), 6, "temperature_2m")


@query(
    f"""SELECT site_id, CAST(time AS DATE) AS date, MAX(temperature_2m) AS temp_day_max, MIN(temperature_2m) AS temp_day_min, ROUND(AVG(temperature_2m), 6) AS temp_day_mean
        FROM ({SQL_SITE_WEATHER}) GROUP BY 1, 2"""
)
def daily_weather(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(resample.daily_extremes(site_weather(spark, sf), ["site_id"], "temperature_2m"), 6, "temp_day_mean")


# Places as users of the order table: a span of years each.
SQL_ORDER_SPANS = """SELECT o_custkey % 10 AS place, CAST(MIN(o_orderdate) AS DATE) AS "start", CAST(MAX(o_orderdate) AS DATE) AS "end" FROM orders GROUP BY 1"""


@query(
    f"""SELECT place, strftime(time, '%Y-%m') AS month, ROUND(AVG(temperature_2m), 5) AS mean_c, MIN(temperature_2m) AS min_c, MAX(temperature_2m) AS max_c,
               ROUND(AVG(relative_humidity_2m), 5) AS mean_humidity, COUNT(*) AS n_hours FROM ({sql_weather(SQL_ORDER_SPANS, "place")}) GROUP BY 1, 2"""
)
def monthly_weather_stats(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    spans = orders.groupBy((F.col("o_custkey") % 10).alias("place")).agg(F.to_date(F.min("o_orderdate")).alias("start"), F.to_date(F.max("o_orderdate")).alias("end"))
    return rounded(monthly_weather(wx.climatology(spans, ["place"]), ["place"]), 5, "mean_c", "mean_humidity")


# Stored readings: one row per hour with events; some places hold most hours, thinned ones do not.
SQL_STORED = f"""SELECT site_id, time_bucket(INTERVAL 1 HOUR, event_time) AS time, ROUND(AVG(d74), 6) AS temperature_2m, ROUND(AVG(d74) + 1, 6) AS apparent_temperature,
  50.0::DOUBLE AS relative_humidity_2m FROM ({SQL_BUS}) WHERE length(site_id) > 4 OR hour(event_time) % 3 = 0 GROUP BY 1, 2"""


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    kept = bus(spark, sf).where((F.length("site_id") > 4) | (F.hour("event_time") % 3 == 0))
    return kept.groupBy("site_id", floor_to(F.col("event_time"), 60).alias("time")).agg(
        F.round(F.avg("d74"), 6).alias("temperature_2m"), F.round(F.avg("d74") + 1, 6).alias("apparent_temperature"), F.lit(50.0).alias("relative_humidity_2m")
    )


SQL_COVER = f"""
  WITH st AS ({SQL_STORED}), sp AS ({SQL_SITE_SPANS}),
  c AS (SELECT sp.site_id, "start", "end", COUNT(st.time) AS n_hours, (date_diff('day', "start", "end") + 1) * 24 AS expected
        FROM sp LEFT JOIN st ON st.site_id = sp.site_id AND CAST(st.time AS DATE) BETWEEN "start" AND "end" GROUP BY 1, 2, 3)"""


@query(SQL_COVER + ' SELECT site_id, "start", "end", n_hours, CAST(expected AS BIGINT) AS expected, n_hours >= 0.5 * expected AS accepted FROM c')
def weather_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return as_counts(wx.coverage(_stored(spark, sf), site_spans(spark, sf), ["site_id"]), "expected")


@query(
    SQL_COVER
    + f""" SELECT st.* FROM st JOIN c USING (site_id) WHERE n_hours >= 0.5 * expected
       UNION ALL {sql_weather('SELECT site_id, "start", "end" FROM c WHERE n_hours < 0.5 * expected', "site_id")}"""
)
def weather_with_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return wx.weather_for_period(_stored(spark, sf), site_spans(spark, sf), ["site_id"])


@query(
    f"""WITH st AS ({SQL_STORED}), n AS ({SQL_SITE_WEATHER})
        SELECT * FROM st UNION ALL SELECT n.* FROM n ANTI JOIN st ON n.site_id = st.site_id AND n.time = st.time"""
)
def weather_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return wx.merge_weather(_stored(spark, sf), site_weather(spark, sf), ["site_id"])


@query(
    f"""WITH e AS (SELECT event_id, site_id, event_time FROM ({SQL_BUS})), w AS (SELECT site_id, time, temperature_2m FROM ({SQL_STORED})),
        p AS (SELECT event_id, e.site_id, event_time, w.time AS pt, w.temperature_2m AS px FROM e ASOF LEFT JOIN w ON e.site_id = w.site_id AND e.event_time >= w.time),
        n AS (SELECT event_id, w.time AS nt, w.temperature_2m AS nx FROM e ASOF LEFT JOIN w ON e.site_id = w.site_id AND e.event_time < w.time)
        SELECT event_id, CASE WHEN pt IS NULL OR date_diff('microsecond', event_time, nt) <= date_diff('microsecond', pt, event_time) THEN nx ELSE px END AS temperature_2m
        FROM p JOIN n USING (event_id)"""
)
def nearest_reading(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-2 on irregular times: nearest stored weather reading of every event."""
    stored = _stored(spark, sf).select("site_id", F.col("time"), "temperature_2m")
    rows = bus(spark, sf).select("event_id", "site_id", "event_time")
    return joins.nearest(rows, stored, site_events(spark, sf), ["temperature_2m"], "time").select("event_id", "temperature_2m")


@query(
    f"""WITH d AS (SELECT site_id, CAST(event_time AS DATE) AS date, MAX(d74) AS top FROM ({SQL_BUS}) GROUP BY 1, 2 HAVING COUNT(*) >= 66)
        SELECT e.event_id, d.top FROM ({SQL_BUS}) e ASOF LEFT JOIN d ON e.site_id = d.site_id AND CAST(e.event_time AS DATE) >= d.date"""
)
def daily_value_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-3: every row gets the value of the latest busy day, NULL before the first."""
    rows = bus(spark, sf)
    daily = rows.groupBy("site_id", F.to_date("event_time").alias("date")).agg(F.max("d74").alias("top"), F.count(F.lit(1)).alias("n")).where("n >= 66").drop("n")
    return joins.daily_as_of(rows, rows, daily, ["site_id"], "event_time", ["top"]).select("event_id", "top")


@query(
    f"""WITH s AS (SELECT site_id, time_bucket(INTERVAL 15 MINUTE, time) AS b, MAX(p_on) AS p FROM ({SQL_PRED}) GROUP BY 1, 2)
        SELECT e.event_id, s.p AS p_step FROM ({SQL_BUS}) e LEFT JOIN s ON s.site_id = e.site_id AND s.b = time_bucket(INTERVAL 15 MINUTE, e.event_time)"""
)
def step_probability(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-8: the probability of the step a reading falls into."""
    steps = pred(spark, sf).groupBy("site_id", floor_to(F.col("time"), 15).alias("step")).agg(F.max("p_on").alias("p_step"))
    return joins.on_bin(bus(spark, sf), steps, ["site_id"], "event_time", "step").select("event_id", "p_step")


@query(
    f"""WITH l AS (SELECT site_id, time, p1 FROM ({SQL_BRANCH}) WHERE p1 IS NOT NULL)
        SELECT site_id, time, ROUND(p1, 6) AS p1, COUNT(e.event_id) AS win_n, MIN(e.d87) AS win_min, MAX(ABS(e.d87)) AS win_absmax
        FROM l JOIN (SELECT * FROM ({SQL_BUS}) WHERE d74 <> 0) e USING (site_id) WHERE p1 > 100 AND e.event_time BETWEEN time - INTERVAL 20 MINUTE AND time + INTERVAL 10 MINUTE
        GROUP BY 1, 2, 3"""
)
def event_window_extremes(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-9: spike extremes of the readings around each strong label step."""
    strong = branch(spark, sf).where("p1 > 100").select("site_id", "time", "p1")
    windows = joins.event_windows(strong, bus(spark, sf).where("d74 <> 0"), ["site_id"], "time", "event_time", "d87", 1_200, 600)
    return rounded(strong.join(windows, ["site_id", "time"]), 6, "p1")


