"""Streaming jobs over the events table, drained completely; the SQL twin is the batch result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.catalog.registry import query
from wattloom.catalog.views import SQL_BUS, rounded
from wattloom.session import configure
from wattloom.streaming.jobs import drain, drain_bins, read_events_stream, stream_daily_counts, stream_guard, stream_running_stats

# The watermark stays behind the newest reading, so windows that end after it are not written.
SQL_MARK = "(SELECT date_trunc('millisecond', MAX(ts)) FROM events)"


def _readings(spark: SparkSession, sf: str) -> DataFrame:
    events = read_events_stream(configure(spark), sf)
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        F.col("event_type").alias("site_id"), "user_id", "ts", F.col("value").alias("d73"),
        F.when(k != 0, (k - 50) * 4.0).alias("d87"),
    )


@query(
    """SELECT event_type AS site_id, time_bucket(INTERVAL 15 MINUTE, ts) AS ts, ROUND(AVG(value), 6) AS d73,
               MAX(value) AS d73_max5, MIN(value) AS d73_min5, MAX(ABS(value)) AS d73_absmax5
        FROM events GROUP BY 1, 2"""
)
def stream_bins_site(spark: SparkSession, sf: str) -> DataFrame:
    """STR-1: every bin, the last ones closed by a beat."""
    return rounded(drain_bins(_readings(spark, sf), ["site_id"], "ts", ["d73"], ["d73"]), 6, "d73")


@query("SELECT user_id, CAST(ts AS DATE) AS date, COUNT(*) AS n_raw FROM events GROUP BY 1, 2")
def stream_daily_counts_user(spark: SparkSession, sf: str) -> DataFrame:
    updates = drain(stream_daily_counts(_readings(spark, sf), ["user_id"], "ts"), "update")
    return updates.groupBy("user_id", "date").agg(F.max("n_raw").alias("n_raw"))


@query(
    f"""WITH steps AS (SELECT site_id, time_bucket(INTERVAL 15 MINUTE, event_time) AS ts,
                   MAX(CASE WHEN d87 > -2147483648 AND ABS(d87) >= 190 THEN event_time END) AS startup
                 FROM ({SQL_BUS}) GROUP BY 1, 2),
        seen AS (SELECT site_id, ts, last_value(startup IGNORE NULLS) OVER (PARTITION BY site_id ORDER BY ts
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM steps)
        SELECT site_id, COUNT(*) AS n_steps, COUNT(*) FILTER (WHERE s IS NULL OR date_diff('microsecond', s, ts) / 3.6e9 > 2) AS n_suppressed
        FROM seen WHERE ts + INTERVAL 15 MINUTE <= {SQL_MARK} - INTERVAL 30 MINUTE GROUP BY 1"""
)
def stream_guard_steps(spark: SparkSession, sf: str) -> DataFrame:
    steps = drain(stream_guard(_readings(spark, sf), "site_id", "ts", "d87", 190.0, max_on_h=2.0))
    return steps.groupBy(F.col("key").alias("site_id")).agg(F.count(F.lit(1)).alias("n_steps"), F.count_if("suppressed").alias("n_suppressed"))


@query(
    f"""WITH days AS (SELECT event_type AS key, CAST(ts AS DATE) AS day, COUNT(*) AS n, SUM(value) AS s1, SUM(value * value) AS s2
                 FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= {SQL_MARK} - INTERVAL 1 HOUR GROUP BY 1, 2)
        SELECT key, day, CAST(SUM(n) OVER w AS BIGINT) AS n_seen, ROUND(SUM(s1) OVER w / SUM(n) OVER w, 6) AS mean,
               ROUND(SQRT((SUM(s2) OVER w - (SUM(s1) OVER w) * (SUM(s1) OVER w) / SUM(n) OVER w) / (SUM(n) OVER w - 1)), 5) AS std,
               ROUND(list_reduce(list(s1 / n) OVER w, lambda e, x: 0.99 * e + 0.01 * x), 5) AS mean_ema
        FROM days WINDOW w AS (PARTITION BY key ORDER BY day)"""
)
def stream_running_stats_site(spark: SparkSession, sf: str) -> DataFrame:
    stats = drain(stream_running_stats(_readings(spark, sf), "site_id", "ts", "d73"))
    return rounded(rounded(stats, 6, "mean"), 5, "std", "mean_ema")


