"""The given tables seen as meters, labels and scored series, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.timeparse import floor_to
from wattloom.operators.series import DAY, Series, plan_series
from wattloom.session import configure


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def k_of(props: str = "props") -> Column:
    return F.get_json_object(props, "$.k").cast("double")


SQL_K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"

SQL_BUS = f"""
  SELECT event_id, event_type AS site_id, user_id, ts AS event_time, value AS d73, {SQL_K} AS d74,
         CASE WHEN {SQL_K} = 0 THEN -2147483648::DOUBLE ELSE ({SQL_K} - 50) * 4.0::DOUBLE END AS d87
  FROM events"""


def bus(spark: SparkSession, sf: str) -> DataFrame:
    k = k_of()
    return table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("site_id"),
        "user_id",
        F.col("ts").alias("event_time"),
        F.col("value").alias("d73"),
        k.alias("d74"),
        F.when(k == 0, F.lit(-2147483648.0)).otherwise((k - 50) * 4.0).alias("d87"),
    )


SQL_BRANCH = """
  SELECT event_type AS site_id, time_bucket(INTERVAL 15 MINUTE, ts) AS time,
         SUM(CASE WHEN user_id % 2 = 0 THEN value END) AS p1,
         SUM(CASE WHEN user_id % 2 = 1 THEN value END) AS p2
  FROM events GROUP BY 1, 2"""


def branch(spark: SparkSession, sf: str, minutes: int = 15) -> DataFrame:
    events = table(spark, sf, "events")
    return events.groupBy(F.col("event_type").alias("site_id"), floor_to(F.col("ts"), minutes).alias("time")).agg(
        F.sum(F.when(F.col("user_id") % 2 == 0, F.col("value"))).alias("p1"),
        F.sum(F.when(F.col("user_id") % 2 == 1, F.col("value"))).alias("p2"),
    )


SQL_PRED = f"""
  SELECT event_id, event_type AS site_id, user_id, ts AS time, value AS y_true,
         value * (0.5::DOUBLE + {SQL_K} / 100::DOUBLE) AS y_pred, {SQL_K} / 100::DOUBLE AS p_on,
         CAST(value >= 50 AS INT) AS state_true, CAST({SQL_K} >= 50 AS INT) AS state_pred,
         CASE WHEN dayofmonth(ts) <= 18 THEN 'train' WHEN dayofmonth(ts) <= 24 THEN 'val' ELSE 'test' END AS split
  FROM events"""


def pred(spark: SparkSession, sf: str) -> DataFrame:
    k, day = k_of(), F.dayofmonth("ts")
    return table(spark, sf, "events").select(
        "event_id",
        F.col("event_type").alias("site_id"),
        "user_id",
        F.col("ts").alias("time"),
        F.col("value").alias("y_true"),
        (F.col("value") * (0.5 + k / 100.0)).alias("y_pred"),
        (k / 100.0).alias("p_on"),
        (F.col("value") >= 50).cast("int").alias("state_true"),
        (k >= 50).cast("int").alias("state_pred"),
        F.when(day <= 18, "train").when(day <= 24, "val").otherwise("test").alias("split"),
    )


SQL_DAY = """
  SELECT o_custkey % 10 AS user_id, o_orderdate AS ts, SUM(o_totalprice) AS w, COUNT(*) AS n FROM orders GROUP BY 1, 2"""


def day(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.groupBy((F.col("o_custkey") % 10).alias("user_id"), F.col("o_orderdate").alias("ts")).agg(
        F.sum("o_totalprice").alias("w"), F.count(F.lit(1)).alias("n")
    )


SQL_HOURLY = """
  SELECT event_type AS site_id, time_bucket(INTERVAL 1 HOUR, ts) AS ts, AVG(value) AS w, AVG({k}) AS v,
         MIN(({k} - 50) * 4.0::DOUBLE) AS d_min5, MAX(({k} - 50) * 4.0::DOUBLE) AS d_max5
  FROM events GROUP BY 1, 2""".format(k=SQL_K)


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Dense hourly site series: two mean columns and the extremes of the spike column."""
    events = table(spark, sf, "events").withColumn("_k", k_of())
    spike = (F.col("_k") - 50) * 4.0
    return events.groupBy(F.col("event_type").alias("site_id"), floor_to(F.col("ts"), 60).alias("ts")).agg(
        F.avg("value").alias("w"), F.avg("_k").alias("v"), F.min(spike).alias("d_min5"), F.max(spike).alias("d_max5")
    )


_PLANS: dict[tuple[str, str], Series] = {}


def site_events(spark: SparkSession, sf: str, ts: str = "event_time") -> Series:
    """Series of raw events per site (few, dense keys). The chunk length follows the measured density."""
    key = (sf, "site")
    if key not in _PLANS:
        raw = table(spark, sf, "events").select(F.col("event_type").alias("site_id"), F.col("ts").alias("event_time"))
        _PLANS[key] = _at_most_a_day(plan_series(raw, Series(("site_id",), "event_time")))
    return _PLANS[key].renamed(ts=ts, tie=("event_id",))


def user_events(spark: SparkSession, sf: str, ts: str = "event_time") -> Series:
    key = (sf, "user")
    if key not in _PLANS:
        raw = table(spark, sf, "events").select("user_id", F.col("ts").alias("event_time"))
        _PLANS[key] = _at_most_a_day(plan_series(raw, Series(("user_id",), "event_time")), 7 * DAY)
    return _PLANS[key].renamed(ts=ts, tie=("event_id",))


def _at_most_a_day(series: Series, limit: int = DAY) -> Series:
    return series.renamed(chunk_s=limit if series.chunk_s is None else min(series.chunk_s, limit))


# Binned series have one row per bin, so a chunk is bounded by its length in time.
SITE_HOURS = Series(("site_id",), "ts", (), 7 * DAY)
SITE_QUARTERS = Series(("site_id",), "time", (), 7 * DAY)
USER_DAYS = Series(("user_id",), "ts", (), 366 * DAY)


def as_counts(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# Means of few rows often end exactly on half a unit of the last digit, where engines round apart.
# Both sides add the same small fraction of that unit first.
NUDGE = 0.037


def settled(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n) + F.lit(NUDGE * 10**-digits), digits) for n in names})


def sql_round(expression: str, digits: int) -> str:
    return f"ROUND({expression} + {NUDGE * 10**-digits:.12f}, {digits})"
