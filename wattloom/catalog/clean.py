"""Scans, parsing, merging, filters, gates and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.catalog.registry import query
from wattloom.catalog.views import SQL_BRANCH, SQL_BUS, SQL_K, SQL_PRED, as_counts, branch, bus, k_of, pred, rounded, site_events, table, user_events
from wattloom.functions.scalars import normal_target
from wattloom.functions.timeparse import format_short, format_timestamp, parse_failures, parse_timestamp
from wattloom.operators import filters, reports
from wattloom.operators.metrics import classification_metrics
from wattloom.operators.resample import raw_daily_counts, sampling_profile
from wattloom.sources import meters

# Eight spellings of a timestamp, chosen by event number; the last one is unreadable.
SPARK_TEXTS = ("yyyy/M/d H:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy-M-d H:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/M/d", "yyyy-MM-dd")
SQL_PARSED = """CASE WHEN event_id % 8 < 5 THEN date_trunc('second', ts) WHEN event_id % 8 < 7 THEN date_trunc('day', ts) END"""


def _texts(df: DataFrame) -> DataFrame:
    text = F.lit("invalid_garbage")
    for i, layout in enumerate(SPARK_TEXTS):
        text = F.when(F.col("event_id") % 8 == i, F.date_format("ts", layout)).otherwise(text)
    return df.withColumn("text", text)


@query(f"SELECT event_id, {SQL_PARSED} AS parsed FROM events")
def parse_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    return _texts(table(spark, sf, "events")).select("event_id", parse_timestamp(F.col("text")).alias("parsed"))


@query("SELECT event_type, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE event_id % 8 < 7) AS n_parsed, COUNT(*) FILTER (WHERE event_id % 8 = 7) AS n_failed FROM events GROUP BY 1")
def parse_failure_counts(spark: SparkSession, sf: str) -> DataFrame:
    return parse_failures(_texts(table(spark, sf, "events")), "text", ["event_type"])


@query(
    """SELECT event_id, strftime(ts, '%Y/%m/%d %H:%M:%S') AS long_text,
              concat(year(ts), '/', month(ts), '/', dayofmonth(ts), ' ', hour(ts), strftime(ts, ':%M:%S')) AS short_text FROM events"""
)
def format_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf, "events").select("event_id", format_timestamp(ts).alias("long_text"), format_short(ts).alias("short_text"))


@query(
    f"""SELECT event_id, {SQL_PARSED} AS event_time, d73 AS load_iden_data73, CASE WHEN d87 <> -2147483648 THEN d87 END AS load_iden_data87
        FROM (SELECT event_id, ts, value AS d73, CASE WHEN {SQL_K} = 0 THEN -2147483648 ELSE ({SQL_K} - 50) * 4.0 END AS d87 FROM events)
        WHERE event_id % 8 < 7"""
)
def bus_scan(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1/3: text rows to typed readings, unreadable times dropped, the sentinel turned to NULL."""
    raw = _texts(table(spark, sf, "events")).withColumn("k", k_of())
    text = raw.select(
        "event_id",
        F.col("text").alias("event_time"),
        F.col("value").cast("string").alias("load_iden_data73"),
        F.when(F.col("k") == 0, F.lit("-2147483648")).otherwise(((F.col("k") - 50) * 4.0).cast("string")).alias("load_iden_data87"),
    )
    return meters.read_bus(text)


@query(f'SELECT site_id, time, ROUND(p1, 6) AS p1, ROUND(p2, 6) AS p2, ROUND(p1 + p2, 6) AS "p1+p2" FROM ({SQL_BRANCH})')
def composite_target(spark: SparkSession, sf: str) -> DataFrame:
    text = branch(spark, sf).select("site_id", format_timestamp(F.col("time")).alias("time"), F.col("p1").cast("string").alias("p1"), F.col("p2").cast("string").alias("p2"))
    return rounded(meters.read_branch(text, "P1 + p2"), 6, "p1", "p2", "p1+p2")


SQL_NAMES = f"""SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'q' || user_id % 7 WHEN event_id % 5 = 1 THEN ' P' || user_id % 7 || ' '
  ELSE 'P' || user_id % 7 || ' + p' || CAST({SQL_K} AS INT) % 7 END AS name, user_id % 7 AS a, CAST({SQL_K} AS INT) % 7 AS b FROM events"""


@query(
    f"""SELECT event_id, name, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 'p' || a WHEN a <> b THEN 'p' || a || '+p' || b END AS target
        FROM ({SQL_NAMES})"""
)
def target_names(spark: SparkSession, sf: str) -> DataFrame:
    a, b = (F.col("user_id") % 7).cast("string"), (k_of().cast("int") % 7).cast("string")
    name = (
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("q"), a))
        .when(F.col("event_id") % 5 == 1, F.concat(F.lit(" P"), a, F.lit(" ")))
        .otherwise(F.concat(F.lit("P"), a, F.lit(" + p"), b))
    )
    named = table(spark, sf, "events").select("event_id", name.alias("name"))
    return named.withColumn("target", normal_target(F.col("name")))


@query(
    f"""SELECT user_id, event_time, arg_min(d73, (f, event_id)) AS d73, arg_min(event_id, (f, event_id)) AS event_id FROM (
          SELECT 0 AS f, user_id, time_bucket(INTERVAL 1 HOUR, event_time) AS event_time, event_id, d73 FROM ({SQL_BUS}) WHERE event_id % 3 <> 0
          UNION ALL SELECT 1, user_id, time_bucket(INTERVAL 1 HOUR, event_time), event_id, d73 FROM ({SQL_BUS}) WHERE event_id % 3 <> 1) GROUP BY 1, 2"""
)
def merge_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-11, SET-1/2: two overlapping histories on their common columns, the first file wins per time."""
    hours = bus(spark, sf).withColumn("event_time", F.date_trunc("hour", "event_time").cast("timestamp_ntz"))
    first = hours.where("event_id % 3 <> 0").select("user_id", "event_time", "event_id", "d73", "d74")
    second = hours.where("event_id % 3 <> 1").select("user_id", "event_time", "event_id", "d73", "d87")
    return meters.merge_history([first, second], ["user_id"], "event_time", ["event_id"])


@query(
    f"""SELECT site_id, COUNT(*) AS n_rows, ROUND(SUM(d73), 4) AS sum_w FROM (
          SELECT site_id, d73 FROM ({SQL_BUS}) WHERE dayofmonth(event_time) <= 10
          UNION ALL SELECT site_id, d73 FROM ({SQL_BUS}) WHERE CAST(event_time AS DATE) IN ('2024-01-05', '2024-01-12')) GROUP BY 1"""
)
def add_listed_days(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-12: only the listed days of the extra table, duplicates kept."""
    all_rows = bus(spark, sf)
    base = all_rows.where(F.dayofmonth("event_time") <= 10).select("site_id", "event_time", "d73", "d74")
    merged = meters.add_days(base, [all_rows], "event_time", ["2024-01-05", "2024-01-12"])
    return rounded(merged.groupBy("site_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("d73").alias("sum_w")), 4, "sum_w")


@query("SELECT DISTINCT user_id, CAST(ts AS DATE) AS date FROM events")
def days_in_table(spark: SparkSession, sf: str) -> DataFrame:
    return meters.covered_days(table(spark, sf, "events"), ["user_id"], "ts")


@query('SELECT user_id, MIN(ts) AS start, MAX(ts) AS "end" FROM events GROUP BY 1')
def table_time_span(spark: SparkSession, sf: str) -> DataFrame:
    return meters.time_span(table(spark, sf, "events"), ["user_id"], "ts")


# Range texts made from orders: a date alone on even keys, reversed on every seventh key.
SQL_ORDER_RANGES = """
  SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL 9 DAY ELSE o_orderdate END AS a,
         CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate ELSE o_orderdate + INTERVAL 4 DAY END AS b FROM orders"""


@query(
    f"""SELECT o_orderkey, a AS start, CASE WHEN o_orderkey % 2 = 0 THEN b + INTERVAL '23:59:59' HOUR TO SECOND ELSE b + INTERVAL 12 HOUR END AS "end",
               a <= CASE WHEN o_orderkey % 2 = 0 THEN b + INTERVAL '23:59:59' HOUR TO SECOND ELSE b + INTERVAL 12 HOUR END AS valid FROM ({SQL_ORDER_RANGES})""".replace(
        "INTERVAL '23:59:59' HOUR TO SECOND", "INTERVAL 86399 SECOND"
    )
)
def range_bounds(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    late = F.col("o_orderkey") % 7 == 0
    a = F.when(late, F.col("o_orderdate") + F.expr("INTERVAL 9 DAYS")).otherwise(F.col("o_orderdate"))
    b = F.when(late, F.col("o_orderdate")).otherwise(F.col("o_orderdate") + F.expr("INTERVAL 4 DAYS"))
    texts = orders.select(
        "o_orderkey",
        F.date_format(a, "yyyy-MM-dd").alias("start_text"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format(b, "yyyy/M/d")).otherwise(F.concat(F.date_format(b, "yyyy-MM-dd"), F.lit(" 12:00"))).alias("end_text"),
    )
    return filters.parse_ranges(texts).drop("start_text", "end_text")


@query(
    """SELECT event_id, ts FROM events
       WHERE (ts BETWEEN '2024-01-03' AND '2024-01-12 23:59:59' OR ts BETWEEN '2024-01-20 06:00:00' AND '2024-01-25 18:30:00')
         AND NOT (ts BETWEEN '2024-01-07 17:45:00' AND '2024-01-07 23:59:59') AND CAST(ts AS DATE) <> '2024-01-22'"""
)
def time_filter_global(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-2/3: literal ranges reach the scan as a pushed predicate."""
    include = [("2024-01-03", "2024-01-12"), ("2024-01-20 06:00", "2024-01-25 18:30:00")]
    return filters.time_filter(
        table(spark, sf, "events").select("event_id", "ts"), "ts", include, [("2024-01-07 17:45", "2024-01-07")], ["2024-01-22"]
    )


# Each user's own ranges, derived from its first events: two includes (overlapping on some), one exclude.
SQL_USER_RANGES = """
  SELECT user_id, 'include' AS kind, CAST(d AS TIMESTAMP) AS s, CAST(d AS TIMESTAMP) + INTERVAL 518399 SECOND AS e FROM (SELECT user_id, CAST(MIN(ts) AS DATE) + CAST(user_id % 5 AS INT) AS d FROM events GROUP BY 1) WHERE user_id % 4 <> 0
  UNION ALL SELECT user_id, 'include', CAST(d AS TIMESTAMP) + INTERVAL 3 DAY, CAST(d AS TIMESTAMP) + INTERVAL 12 DAY FROM (SELECT user_id, CAST(MIN(ts) AS DATE) + CAST(user_id % 5 AS INT) AS d FROM events GROUP BY 1) WHERE user_id % 4 <> 0
  UNION ALL SELECT user_id, 'exclude', CAST(d AS TIMESTAMP) + INTERVAL 4 DAY, CAST(d AS TIMESTAMP) + INTERVAL 449999 SECOND FROM (SELECT user_id, CAST(MIN(ts) AS DATE) + CAST(user_id % 5 AS INT) AS d FROM events GROUP BY 1) WHERE user_id % 3 <> 0"""
SQL_IN_RANGES = f"""
  WITH r AS ({SQL_USER_RANGES}), e AS (SELECT event_id, user_id, ts FROM events),
  f AS (SELECT e.*, COUNT(*) FILTER (WHERE kind = 'include') AS n_inc, COUNT(*) FILTER (WHERE kind = 'include' AND ts BETWEEN s AND e) AS hit_in,
          COUNT(*) FILTER (WHERE kind = 'exclude' AND ts BETWEEN s AND e) AS hit_out
        FROM e LEFT JOIN r USING (user_id) GROUP BY ALL)"""


def user_ranges(spark: SparkSession, sf: str) -> DataFrame:
    first = table(spark, sf, "events").groupBy("user_id").agg(F.to_date(F.min("ts")).alias("d"))
    d = F.date_add("d", (F.col("user_id") % 5).cast("int")).cast("timestamp_ntz")

    def span(kind: str, start, end, wanted):
        return F.when(wanted, F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end")))

    sec = F.expr
    spans = F.array(
        span("include", d, d + sec("INTERVAL 518399 SECONDS"), F.col("user_id") % 4 != 0),
        span("include", d + sec("INTERVAL 3 DAYS"), d + sec("INTERVAL 12 DAYS"), F.col("user_id") % 4 != 0),
        span("exclude", d + sec("INTERVAL 4 DAYS"), d + sec("INTERVAL 449999 SECONDS"), F.col("user_id") % 3 != 0),
    )
    return first.select("user_id", F.inline(F.array_compact(spans)))


@query(SQL_IN_RANGES.replace("COUNT(*) FILTER (WHERE kind = 'include' AND ts BETWEEN s AND e) AS hit_in", "COUNT(*) FILTER (WHERE kind = 'include' AND ts BETWEEN s AND r.e) AS hit_in").replace("AND ts BETWEEN s AND e) AS hit_out", "AND ts BETWEEN s AND r.e) AS hit_out") + " SELECT event_id, user_id, ts FROM f WHERE (n_inc = 0 OR hit_in > 0) AND hit_out = 0")
def time_filter_per_user(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return filters.time_filter_by_key(rows, user_ranges(spark, sf), ["user_id"], "ts")


@query(
    f"""WITH r AS ({SQL_USER_RANGES}), e AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS date FROM events),
        f AS (SELECT e.user_id, e.date, COUNT(*) FILTER (WHERE kind = 'include') AS n_inc,
                COUNT(*) FILTER (WHERE kind = 'include' AND CAST(date AS TIMESTAMP) BETWEEN s AND r.e) AS hit_in,
                COUNT(*) FILTER (WHERE kind = 'exclude' AND CAST(date AS TIMESTAMP) BETWEEN s AND r.e) AS hit_out
              FROM e LEFT JOIN r USING (user_id) GROUP BY 1, 2)
        SELECT user_id, date, CASE WHEN (n_inc = 0 OR hit_in > 0) AND hit_out = 0 THEN 'used' ELSE 'excluded' END AS dataset FROM f"""
)
def infer_day_labels(spark: SparkSession, sf: str) -> DataFrame:
    days = meters.covered_days(table(spark, sf, "events"), ["user_id"], "ts")
    return filters.infer_date_labels(days, user_ranges(spark, sf), ["user_id"])


@query(
    f"""WITH d AS (SELECT DISTINCT user_id, CAST(time AS DATE) AS date FROM ({SQL_PRED})),
        s AS (SELECT user_id, CAST(time AS DATE) AS date, MAX(CASE split WHEN 'test' THEN 3 WHEN 'val' THEN 2 ELSE 1 END) AS r
              FROM ({SQL_PRED}) WHERE user_id % 3 <> 0 GROUP BY 1, 2)
        SELECT d.user_id, d.date, CASE r WHEN 3 THEN 'test' WHEN 2 THEN 'val' WHEN 1 THEN 'train' ELSE 'unused' END AS dataset FROM d LEFT JOIN s USING (user_id, date)"""
)
def train_day_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = pred(spark, sf)
    splits = rows.where("user_id % 3 <> 0").select("user_id", "split", F.to_date("time").alias("date")).distinct()
    return filters.train_date_labels(meters.covered_days(rows, ["user_id"], "time"), splits, ["user_id"])


@query(
    f"""SELECT event_id, CASE WHEN (user_id, CAST(time AS DATE)) IN (SELECT (user_id, CAST(time AS DATE)) FROM ({SQL_PRED}) WHERE split = 'train' AND state_true = 1)
               THEN 'used_leak' ELSE 'used_ood' END AS dataset FROM ({SQL_PRED})"""
)
def leak_day_labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = pred(spark, sf)
    train = meters.covered_days(rows.where("split = 'train' AND state_true = 1"), ["user_id"], "time")
    return filters.leak_labels(rows, train, "time", ["user_id"]).select("event_id", "dataset")


@query(
    f"""SELECT site_id, COUNT(*) FILTER (WHERE state_true = 1 AND state_pred = 1) AS "TP", COUNT(*) FILTER (WHERE state_true = 0 AND state_pred = 1) AS "FP",
               COUNT(*) FILTER (WHERE state_true = 1 AND state_pred = 0) AS "FN", COUNT(*) FILTER (WHERE state_true = 0 AND state_pred = 0) AS "TN"
        FROM ({SQL_PRED}) WHERE CAST(time AS DATE) IN ('2024-01-04', '2024-01-19', '2024-01-28') GROUP BY 1"""
)
def metrics_on_dates(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-4: scores of the listed days only."""
    rows = filters.on_dates(pred(spark, sf), "time", ["2024-01-04", "2024-01-19", "2024-01-28"])
    return classification_metrics(rows, ["site_id"], "state_true", "state_pred").select("site_id", "TP", "FP", "FN", "TN")


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    """Readings with a constant, an empty and a patchy column."""
    k = F.col("d74")
    return bus(spark, sf).select(
        "event_id", "site_id", "user_id", "event_time", "d73", "d74",
        F.when(k != 0, F.col("d87")).alias("d87"), F.lit(7.0).alias("flat"), F.lit(None).cast("double").alias("empty"),
        F.when(k % 3 == 0, F.col("d73")).alias("patchy"),
    )


SQL_WIDE = f"""SELECT event_id, site_id, user_id, event_time, d73, d74, CASE WHEN d74 <> 0 THEN d87 END AS d87, 7.0::DOUBLE AS flat,
  NULL::DOUBLE AS empty, CASE WHEN d74 % 3 = 0 THEN d73 END AS patchy FROM ({SQL_BUS})"""
COLUMNS = ["d73", "d74", "d87", "flat", "empty", "patchy"]


@query(
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", COUNT({c}) AS n_valid, COUNT(DISTINCT {c}) > 1 AS usable FROM ({SQL_WIDE})" for c in COLUMNS)
)
def usable_columns(spark: SparkSession, sf: str) -> DataFrame:
    return filters.column_profile_flags(_wide(spark, sf), COLUMNS)


@query(
    f"""WITH w AS ({SQL_WIDE}), c AS (
          SELECT site_id, COUNT(*) FILTER (WHERE d87 IS NULL) AS a, COUNT(*) FILTER (WHERE patchy IS NULL) AS b,
                 COUNT(*) FILTER (WHERE d87 IS NULL OR patchy IS NULL) AS n_null_rows, MIN(event_time) FILTER (WHERE d87 IS NULL) AS ta,
                 MIN(event_time) FILTER (WHERE patchy IS NULL) AS tb FROM w GROUP BY 1)
        SELECT site_id, CAST((a > 0)::INT + (b > 0)::INT AS BIGINT) AS n_null_cols, n_null_rows,
               CASE WHEN a = 0 AND b = 0 THEN NULL WHEN a >= b THEN 'd87' ELSE 'patchy' END AS first_col,
               CASE WHEN a >= b THEN ta ELSE tb END AS first_ts, n_null_rows = 0 AS passed FROM c"""
)
def feature_null_gate(spark: SparkSession, sf: str) -> DataFrame:
    return filters.null_gate(_wide(spark, sf), ["d73", "d74", "d87", "patchy"], "event_time", ["site_id"])


@query(f"SELECT event_id, d74, 0.0::DOUBLE AS d99, d73 FROM ({SQL_BUS})")
def synced_columns(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-17: trained order, an absent column filled with 0, extra ones left out."""
    return filters.sync_columns(bus(spark, sf), ["d74", "d99", "d73"], ["event_id"])[0]


@query("SELECT user_id, CAST(ts AS DATE) AS date, COUNT(*) AS n_raw FROM events GROUP BY 1, 2")
def daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    return raw_daily_counts(bus(spark, sf), ["user_id"], "event_time")


def _sql_sampling(key: str) -> str:
    return f"""
  WITH g AS (SELECT {key}, date_diff('microsecond', lag(event_time) OVER (PARTITION BY {key} ORDER BY event_time, event_id), event_time) / 1e6 AS dt FROM ({SQL_BUS})),
  m AS (SELECT {key}, quantile_cont(dt, 0.5) AS step_s FROM g WHERE dt IS NOT NULL GROUP BY 1)
  SELECT {key}, COUNT(*) AS n_steps, ROUND(MAX(step_s), 4) AS step_s, ROUND(AVG(dt), 4) AS mean_s, ROUND(MIN(dt), 4) AS min_s, ROUND(MAX(dt), 4) AS max_s,
         ROUND(STDDEV_POP(dt) / AVG(dt), 6) AS cv, STDDEV_POP(dt) / AVG(dt) > 0.10 AS uneven, COUNT(*) FILTER (WHERE dt > 2 * step_s) AS n_gaps
  FROM g JOIN m USING ({key}) WHERE dt IS NOT NULL GROUP BY 1"""


@query(_sql_sampling("site_id"))
def sampling_profile_site(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rounded(sampling_profile(bus(spark, sf), site_events(spark, sf)), 4, "step_s", "mean_s", "min_s", "max_s"), 6, "cv")


@query(_sql_sampling("user_id"))
def sampling_profile_user(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rounded(sampling_profile(bus(spark, sf), user_events(spark, sf)), 4, "step_s", "mean_s", "min_s", "max_s"), 6, "cv")


@query(
    " UNION ALL ".join(
        f"""SELECT site_id, '{c}' AS "column", MIN({c}) AS min, MAX({c}) AS max, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std,
        ROUND(100.0 * (COUNT(*) - COUNT({c})) / COUNT(*), 6) AS missing_pct, ROUND(quantile_cont({c}, 0.5), 6) AS median, COUNT(DISTINCT {c}) AS n_distinct
        FROM ({SQL_WIDE}) GROUP BY 1"""
        for c in COLUMNS
    )
)
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(reports.column_profile(_wide(spark, sf), COLUMNS, ["site_id"]), 6, "mean", "std", "missing_pct", "median")


@query(f"SELECT user_id, CAST(event_time AS DATE) AS date FROM ({SQL_BUS}) WHERE d73 >= 50 INTERSECT SELECT user_id, CAST(event_time AS DATE) FROM ({SQL_BUS}) WHERE d74 >= 50")
def shared_days(spark: SparkSession, sf: str) -> DataFrame:
    """SET-5: days on which a user has both strong readings and confident scores."""
    rows = bus(spark, sf)
    a = meters.covered_days(rows.where("d73 >= 50"), ["user_id"], "event_time")
    return a.intersect(meters.covered_days(rows.where("d74 >= 50"), ["user_id"], "event_time"))


@query(f"SELECT user_id, CAST(event_time AS DATE) AS date FROM ({SQL_BUS}) WHERE d73 >= 50 EXCEPT SELECT user_id, CAST(event_time AS DATE) FROM ({SQL_BUS}) WHERE d74 >= 50")
def unshared_days(spark: SparkSession, sf: str) -> DataFrame:
    rows = bus(spark, sf)
    a = meters.covered_days(rows.where("d73 >= 50"), ["user_id"], "event_time")
    return a.exceptAll(meters.covered_days(rows.where("d74 >= 50"), ["user_id"], "event_time"))


@query(
    f"""SELECT site_id, "column", rank, ROUND(missing_pct, 6) AS missing_pct FROM (
          SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY missing_pct DESC, "column") AS rank FROM ("""
    + " UNION ALL ".join(f"SELECT site_id, '{c}' AS \"column\", 100.0 * (COUNT(*) - COUNT({c})) / COUNT(*) AS missing_pct FROM ({SQL_WIDE}) GROUP BY 1" for c in COLUMNS)
    + ")) WHERE rank <= 5"
)
def top_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    """TOP-3."""
    long = reports.to_long(_wide(spark, sf), ["site_id"], COLUMNS)
    share = long.groupBy("site_id", "column").agg((F.count_if(F.col("value").isNull()) * 100.0 / F.count(F.lit(1))).alias("missing_pct"))
    return rounded(as_counts(meters.rank_columns(share, ["site_id"], "missing_pct", 5), "rank"), 6, "missing_pct")
