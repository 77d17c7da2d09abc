"""Rolling features, scalar features and the complete feature table on hourly site series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.catalog.aligned import SQL_QUARTER, site_weather
from wattloom.catalog.registry import query
from wattloom.catalog.views import SITE_HOURS, SQL_DAY, SQL_HOURLY, day, hourly, rounded, settled, sql_round, table
from wattloom.functions import scalars
from wattloom.operators import windows as win
from wattloom.operators.reports import label_correlation, top_columns
from wattloom.operators.series import over_rows, with_position
from wattloom.plans.features import build_features
from wattloom.operators.drift import build_lut
from wattloom.plans.align import with_weather
from wattloom.session import cut_lineage
from wattloom.sources.weather import quarter_hourly

W = "(PARTITION BY site_id ORDER BY ts"


def sql_features(columns: dict[str, str], source: str = SQL_HOURLY, digits: int = 6, keep: str = "site_id, ts") -> str:
    """SELECT with rounded columns over named frames f2 … f672 of the hourly series."""
    frames = ", ".join(f"f{n} AS {W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (2, 3, 4, 12, 24, 96, 672))
    past = ", ".join(f"p{n} AS {W} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" for n in (96, 672))
    picked = ", ".join(f'{sql_round(sql, digits)} AS "{name}"' for name, sql in columns.items())
    return f"SELECT {keep}, {picked} FROM (SELECT *, row_number() OVER {W}) - 1 AS pos FROM ({source})) WINDOW w AS {W}), {frames}, {past}"


def shown(spark: SparkSession, sf: str, step, before: int, after: int = 0) -> DataFrame:
    """Run window steps on the hourly series and keep the new columns."""
    base = hourly(spark, sf)
    numbered = with_position(base, SITE_HOURS)
    out = over_rows(numbered, SITE_HOURS, step, before, after, numbered=True).drop("pos")
    new = [c for c in out.columns if c not in base.columns]
    return settled(out.select("site_id", "ts", *new), 6, *new)


COLS = ("w", "v")


@query(sql_features({f"{c}_{n}": f"COALESCE({c} - lag({c}, {k}) OVER w, 0)" for c in COLS for n, k in (("d1", 1), ("d3", 3), ("d6", 6))}))
def rolling_differences(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-1/4."""
    return shown(spark, sf, lambda w: win.differences(w, COLS, {"d1": 1, "d3": 3, "d6": 6}), 6)


@query(sql_features({k: v for c in COLS for k, v in ((f"{c}_rm4", f"AVG({c}) OVER f4"), (f"{c}_rs4", f"COALESCE(STDDEV_SAMP({c}) OVER f4, 0)"))}))
def rolling_mean_std(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-2."""
    return shown(spark, sf, lambda w: win.short_stats(w, COLS), 3)


@query(sql_features({f"{c}_lag{k}": f"COALESCE(lag({c}, {k}) OVER w, first_value({c}) OVER w)" for c in COLS for k in (1, 2)}))
def lag_values(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-3."""
    return shown(spark, sf, lambda w: win.lags(w, COLS), 2)


@query(sql_features({f"{c}_abs_d{k}": f"COALESCE(ABS({c} - lag({c}, {k}) OVER w), 0)" for c in COLS for k in (1, 3)}))
def absolute_differences(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-5."""
    return shown(spark, sf, lambda w: win.absolute_differences(w, COLS), 3)


@query(
    sql_features(
        {k: v for c in COLS for k, v in ((f"{c}_up_d1", f"CAST(COALESCE({c} - lag({c}) OVER w, 0) > 20 AS INT)"), (f"{c}_down_d1", f"CAST(COALESCE({c} - lag({c}) OVER w, 0) < -20 AS INT)"))}
    )
)
def jump_flags(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-6 with a 20 W limit, as the hourly means are smooth."""
    return shown(spark, sf, lambda w: win.jump_flags(w, COLS, 20.0), 1)


@query(sql_features({f"{c}_range_{n}": f"MAX({c}) OVER f{n} - MIN({c}) OVER f{n}" for c in COLS for n in (4, 12)}))
def rolling_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-7."""
    return shown(spark, sf, lambda w: win.ranges(w, COLS), 11)


def sql_ema(c: str, digits: int | None = None) -> str:
    """Exponential means of a column with half-lives of 2 and 24 rows, and their ratio."""
    shown = {f"{c}_ema_2": "y", f"{c}_ema_24": "z", f"{c}_ratio_ema": "y / (z + 1.0)"}
    picked = ", ".join(f"ROUND({e}, {digits}) AS {name}" if digits else f"{e} AS {name}" for name, e in shown.items())
    return f"""WITH RECURSIVE n AS (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY ts) - 1 AS pos FROM ({SQL_HOURLY})),
  e(site_id, pos, y, z) AS (SELECT site_id, pos, {c}, {c} FROM n WHERE pos = 0
    UNION ALL SELECT e.site_id, n.pos, e.y * {0.5 ** 0.5!r}::DOUBLE + n.{c} * {1 - 0.5 ** 0.5!r}::DOUBLE, e.z * {0.5 ** (1 / 24)!r}::DOUBLE + n.{c} * {1 - 0.5 ** (1 / 24)!r}::DOUBLE
              FROM e JOIN n ON n.site_id = e.site_id AND n.pos = e.pos + 1)
  SELECT n.site_id, n.ts, {picked} FROM n JOIN e USING (site_id, pos)"""


@query(sql_ema("w", 6))
def ema_scan(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-8."""
    out = win.ema_family(hourly(spark, sf), SITE_HOURS, ["w"])
    names = ["w_ema_2", "w_ema_24", "w_ratio_ema"]
    return rounded(out.select("site_id", "ts", *names), 6, *names)


@query(
    sql_features(
        {
            k: v
            for c in COLS
            for n in (4, 12, 24)
            for k, v in ((f"{c}_std_{n}", f"COALESCE(STDDEV_SAMP({c}) OVER f{n}, 0)"), (f"{c}_cv_{n}", f"COALESCE(STDDEV_SAMP({c}) OVER f{n}, 0) / GREATEST(ABS(AVG({c}) OVER f{n}), 10)"))
        }
    )
)
def rolling_texture(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-9."""
    return shown(spark, sf, lambda w: win.texture(w, COLS), 23)


@query(
    sql_features(
        {
            k: v
            for n in (4, 12)
            for k, v in (
                (f"w_p25_{n}", f"quantile_cont(w, 0.25) OVER f{n}"),
                (f"w_p75_{n}", f"quantile_cont(w, 0.75) OVER f{n}"),
                (f"w_iqr_{n}", f"quantile_cont(w, 0.75) OVER f{n} - quantile_cont(w, 0.25) OVER f{n}"),
            )
        }
    )
)
def rolling_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-10."""
    return shown(spark, sf, lambda w: win.quartiles(w, "w"), 11)


@query(
    sql_features(
        {
            f"{c}_slope_{n}": f"CASE WHEN COUNT(*) OVER f{n} >= 2 THEN COVAR_SAMP({c}, pos) OVER f{n} / ((COUNT(*) OVER f{n} * COUNT(*) OVER f{n} - 1) / 12.0) ELSE 0 END"
            for c, n in (("w", 4), ("w", 12), ("v", 4))
        }
    )
)
def rolling_slopes(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-11."""
    return shown(spark, sf, lambda w: {**win.slopes(w, "w", (4, 12)), **win.slopes(w, "v", (4,))}, 11)


@query(
    sql_features(
        {
            "w_dev_24h": "w - AVG(w) OVER f96",
            "w_dev_7d": "w - AVG(w) OVER f672",
            "w_z_24h": "COALESCE((w - AVG(w) OVER f96) / GREATEST(COALESCE(STDDEV_SAMP(w) OVER f96, 5), 5), 0)",
        }
    )
)
def baseline_deviation(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-12. The first row's deviation is 0, so its z-score is 0 under any borrowed deviation."""
    out = win.long_families(hourly(spark, sf), SITE_HOURS, "w", means=False)
    names = ["w_dev_24h", "w_dev_7d", "w_z_24h"]
    return settled(out.select("site_id", "ts", *names), 6, *names)


SQL_PAST = f"""
  WITH m AS (SELECT site_id, ts, w, CASE WHEN COUNT(*) OVER p96 >= 4 THEN AVG(w) OVER p96 END AS a, CASE WHEN COUNT(*) OVER p672 >= 16 THEN AVG(w) OVER p672 END AS b
             FROM ({SQL_HOURLY}) WINDOW p96 AS {W} ROWS BETWEEN 96 PRECEDING AND 1 PRECEDING), p672 AS {W} ROWS BETWEEN 672 PRECEDING AND 1 PRECEDING)),
  f AS (SELECT site_id, ts, w, COALESCE(a, first_value(a IGNORE NULLS) OVER g, median(w) OVER (PARTITION BY site_id)) AS a,
               COALESCE(b, first_value(b IGNORE NULLS) OVER g, median(w) OVER (PARTITION BY site_id)) AS b
        FROM m WINDOW g AS {W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


@query(
    SQL_PAST
    + """ SELECT site_id, ts, """ + f"{sql_round('a', 6)} AS power_recent_24h_mean, {sql_round('b', 6)} AS power_recent_7d_mean, {sql_round('LEAST(GREATEST(COALESCE(w / NULLIF(a, 0), 1), 0), 5)', 6)} AS power_deviation_24h," + """ CAST(hour(ts) BETWEEN 9 AND 11 AS INT) AS is_morning_peak FROM f"""
)
def past_means(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-13/14, SCL-2."""
    out = win.long_families(hourly(spark, sf), SITE_HOURS, "w", deviations=False)
    out = out.withColumn("power_deviation_24h", scalars.deviation_ratio(F.col("w"), F.col("power_recent_24h_mean")))
    out = out.withColumn("is_morning_peak", scalars.morning_peak(F.col("ts")))
    names = ["power_recent_24h_mean", "power_recent_7d_mean", "power_deviation_24h"]
    return settled(out.select("site_id", "ts", *names, "is_morning_peak"), 6, *names)


SQL_SPIKE = {
    "d87_jump_abs5": "COALESCE(d_max5 - d_min5, 0)",
    "d87_amax5": "COALESCE(GREATEST(ABS(d_max5), ABS(d_min5)), 0)",
    "d87_event_neg": "CAST(d_min5 < -50 AS INT)",
    "d87_event_pos": "CAST(d_max5 > 50 AS INT)",
    "d87_event_any": "CAST(d_min5 < -50 OR d_max5 > 50 AS INT)",
    "d87_spike_ratio": "(d_max5 - d_min5) / (ABS(d_max5) + ABS(d_min5) + 5.0)",
    "d87_event_recent_3": "MAX(CAST(d_min5 < -50 OR d_max5 > 50 AS INT)) OVER f3",
}


@query(sql_features(SQL_SPIKE))
def spike_memory(spark: SparkSession, sf: str) -> DataFrame:
    """SCL-7, WIN-15."""
    spikes = scalars.spike_features(F.col("d_min5"), F.col("d_max5"))
    return shown(spark, sf, [lambda w: spikes, lambda w: win.event_memory(w, "d87_event_any")], 2)


SQL_CALENDAR = """SELECT user_id, ts, hour(ts) AS hour, isodow(ts) - 1 AS dow, month(ts) AS month, CAST(hour(ts) >= 18 OR hour(ts) <= 1 AS INT) AS is_evening,
  CAST(isodow(ts) >= 6 AS INT) AS is_weekend, ROUND(sin(2 * pi() * hour(ts) / 24), 9) AS sin_hour, ROUND(cos(2 * pi() * hour(ts) / 24), 9) AS cos_hour,
  ROUND(sin(2 * pi() * dayofyear(ts) / 365.25), 9) AS sin_doy, ROUND(cos(2 * pi() * dayofyear(ts) / 365.25), 9) AS cos_doy,
  CASE WHEN month(ts) IN (12, 1, 2) THEN 'winter' WHEN month(ts) BETWEEN 5 AND 9 THEN 'summer' ELSE 'transition' END AS season FROM """


@query(SQL_CALENDAR.replace("user_id, ts", "event_id, ts", 1) + "events")
def calendar_events(spark: SparkSession, sf: str) -> DataFrame:
    """SCL-1/3 on intraday rows."""
    return _calendar(table(spark, sf, "events"), "event_id")


@query(SQL_CALENDAR + f"({SQL_DAY})")
def calendar_days(spark: SparkSession, sf: str) -> DataFrame:
    """SCL-1/3 over several years."""
    return _calendar(day(spark, sf), "user_id")


def _calendar(df: DataFrame, key: str) -> DataFrame:
    columns = scalars.calendar(F.col("ts"))
    waves = ("sin_hour", "cos_hour", "sin_doy", "cos_doy")
    out = df.select(key, "ts", *[c.alias(n) for n, c in columns.items()], scalars.season_by_month(F.col("ts")).alias("season"))
    return rounded(out, 9, *waves)


SQL_TEMPERED = f"""SELECT h.*, q.temperature_2m AS temp_2m FROM ({SQL_HOURLY}) h JOIN ({SQL_QUARTER}) q ON q.site_id = h.site_id AND q.time = h.ts"""
SQL_WEATHER_FEATURES = f"""
  WITH t AS ({SQL_TEMPERED}),
  d AS (SELECT site_id, CAST(time AS DATE) AS date, MAX(temperature_2m) AS hi, MIN(temperature_2m) AS lo, AVG(temperature_2m) AS mean FROM ({SQL_QUARTER}) GROUP BY 1, 2)
  SELECT t.site_id, t.ts, ROUND(temp_2m, 6) AS temp_2m, ROUND(hi, 6) AS temp_day_max, ROUND(lo, 6) AS temp_day_min, ROUND(mean, 6) AS temp_day_mean,
         ROUND(hi - lo, 6) AS temp_diurnal_range, ROUND(mean - 4.3, 6) AS temp_deviation,
         ROUND(COALESCE(temp_2m - lag(temp_2m, 12) OVER w, 0), 6) AS temp_change_3h, ROUND(COALESCE(temp_2m - lag(temp_2m, 96) OVER w, 0), 6) AS temp_change_24h,
         ROUND(GREATEST(temp_2m - 26, 0), 6) AS cooling_degree, ROUND(GREATEST(16 - temp_2m, 0), 6) AS heating_degree
  FROM t JOIN d ON d.site_id = t.site_id AND d.date = CAST(t.ts AS DATE) WINDOW w AS (PARTITION BY t.site_id ORDER BY t.ts)"""


def _weather15(spark: SparkSession, sf: str) -> DataFrame:
    return quarter_hourly(site_weather(spark, sf), ["site_id"])


@query(SQL_WEATHER_FEATURES)
def weather_features(spark: SparkSession, sf: str) -> DataFrame:
    """WIN-16, SCL-5/6, JOI-2/3 on the grid; all events lie in January (mean 4.3 °C)."""
    wide = build_features(hourly(spark, sf), SITE_HOURS, ["w", "v"], spike="d", weather=_weather15(spark, sf), place=["site_id"])
    names = ["temp_2m", "temp_day_max", "temp_day_min", "temp_day_mean", "temp_diurnal_range", "temp_deviation", "temp_change_3h", "temp_change_24h", "cooling_degree", "heating_degree"]
    return rounded(wide.select("site_id", "ts", *names), 6, *names)


@query(
    f"""SELECT o_custkey % 10 AS place, CAST(o_orderdate AS DATE) AS date, {sql_round('AVG(o_totalprice) / 10000', 6)} AS temp,
              CASE WHEN AVG(o_totalprice) / 10000 <= 12 THEN 'winter' WHEN AVG(o_totalprice) / 10000 >= 22 THEN 'summer' ELSE 'transition' END AS season,
              {sql_round('GREATEST(AVG(o_totalprice) / 10000 - 26, 0)', 6)} AS cooling_degree, {sql_round('GREATEST(16 - AVG(o_totalprice) / 10000, 0)', 6)} AS heating_degree
       FROM orders GROUP BY 1, 2"""
)
def season_by_temperature(spark: SparkSession, sf: str) -> DataFrame:
    """SCL-4/5 with order values standing in for daily temperatures."""
    daily = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 10).alias("place"), F.to_date("o_orderdate").alias("date")).agg((F.avg("o_totalprice") / 10_000).alias("temp"))
    t = F.col("temp")
    out = daily.withColumn("season", scalars.season_by_temp(t)).withColumn("cooling_degree", scalars.cooling_degree(t)).withColumn("heating_degree", scalars.heating_degree(t))
    return settled(out, 6, "temp", "cooling_degree", "heating_degree")


@query(
    f"""SELECT site_id, ts, {sql_round('COALESCE(ABS(w) / GREATEST(ABS(v), 5), 1)', 6)} AS ratio_w_over_v, {sql_round('COALESCE(ABS(d_max5) / GREATEST(ABS(w), 50), 0)', 6)} AS ratio_d87_over_main FROM ({SQL_HOURLY})"""
)
def column_ratios(spark: SparkSession, sf: str) -> DataFrame:
    """SCL-10."""
    rows = hourly(spark, sf)
    out = rows.select(
        "site_id", "ts",
        scalars.floored_ratio(F.col("w"), F.col("v"), 5.0, 1.0).alias("ratio_w_over_v"),
        scalars.floored_ratio(F.col("d_max5"), F.col("w"), 50.0, 0.0).alias("ratio_d87_over_main"),
    )
    return settled(out, 6, "ratio_w_over_v", "ratio_d87_over_main")


@query(
    " UNION ALL ".join(f"SELECT site_id, '{c}' AS \"column\", ROUND(ABS(CORR({c}, w)), 6) AS abs_corr FROM ({SQL_HOURLY}) GROUP BY 1" for c in ("v", "d_min5", "d_max5"))
)
def label_correlations(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-2, TOP-1."""
    return rounded(label_correlation(hourly(spark, sf), ["v", "d_min5", "d_max5"], "w", ["site_id"]), 6, "abs_corr")


TOP_SOURCES = ("v", "d_min5", "d_max5", "w_next", "w_half")


@query(
    f"""WITH h AS (SELECT *, w * v AS w_next, CASE WHEN hour(ts) < 12 THEN w ELSE v END AS w_half FROM ({SQL_HOURLY})),
        c AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, ABS(CORR({c}, w)) AS r FROM h" for c in TOP_SOURCES)})
        SELECT column_name AS "column", row_number() OVER (ORDER BY r DESC, column_name) AS place FROM c QUALIFY place <= 3"""
)
def top_label_columns(spark: SparkSession, sf: str) -> DataFrame:
    """TOP-1: the three columns that follow the label closest, in order."""
    rows = hourly(spark, sf).withColumns({"w_next": F.col("w") * F.col("v"), "w_half": F.when(F.hour("ts") < 12, F.col("w")).otherwise(F.col("v"))})
    names = top_columns(label_correlation(rows, TOP_SOURCES, "w"), 3)
    return spark.createDataFrame([(c, i) for i, c in enumerate(names, 1)], '"column" STRING, place BIGINT'.replace('"', "`"))


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """Every family at once. Aligned rows and weather are written once, as every later step reads them."""
    rows = cut_lineage(hourly(spark, sf))
    return feature_rows(spark, sf, rows, rows)


def feature_rows(spark: SparkSession, sf: str, rows: DataFrame, train: DataFrame) -> DataFrame:
    """All features of the rows, with the temperature table of the training rows."""
    weather = cut_lineage(_weather15(spark, sf))
    tempered = with_weather(train, weather, ["site_id"], "ts")
    lut = build_lut(tempered.select("site_id", "temp_2m", "w"), ["site_id"], "temp_2m", "w")
    return build_features(rows, SITE_HOURS, ["w", "v"], spike="d", weather=weather, place=["site_id"], lut=lut, physics=True)


@query(
    SQL_PAST
    + """ SELECT site_id, COUNT(*) AS n_rows, ROUND(SUM(w), 4) AS sum_w, ROUND(SUM(a), 4) AS sum_recent, ROUND(SUM(b), 4) AS sum_week,
               CAST(SUM(CAST(hour(ts) >= 18 OR hour(ts) <= 1 AS INT)) AS BIGINT) AS n_evening FROM f GROUP BY 1"""
)
def feature_table_sums(spark: SparkSession, sf: str) -> DataFrame:
    """SCL-15: sums over the assembled table."""
    out = feature_table(spark, sf).groupBy("site_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("w").alias("sum_w"), F.sum("power_recent_24h_mean").alias("sum_recent"),
        F.sum("power_recent_7d_mean").alias("sum_week"), F.sum("is_evening").cast("bigint").alias("n_evening"),
    )
    return rounded(out, 4, "sum_w", "sum_recent", "sum_week")
