"""Per-user settings, file discovery, execution state and the all-users tables, derived from the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.catalog.registry import query
from wattloom.catalog.scores import SQL_REG, SQL_TRACKS, tracks
from wattloom.catalog.views import SQL_PRED, as_counts, pred, settled, sql_round, table
from wattloom.operators import joins, metrics
from wattloom.operators.splits import quality_gates
from wattloom.plans.batch import stage_table, user_status
from wattloom.session import checkpoint_dir, cut_lineage
from wattloom.sources import config, discovery, meters, state

# One config entry per customer, written as JSON; some values are out of range, some missing.
SQL_CUSTOMERS = """SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS user_id, c_custkey % 7 AS a, c_custkey % 5 AS b, c_custkey % 11 AS d, c_acctbal AS bal FROM customer"""


def _entry() -> Column:
    a, b, d = F.col("c_custkey") % 7, F.col("c_custkey") % 5, F.col("c_custkey") % 11
    day = F.concat(F.lit("2024-01-"), F.lpad((d + 1).cast("string"), 2, "0"))
    later = F.concat(F.lit("2024-01-"), F.lpad((d + 6).cast("string"), 2, "0"))
    pair = F.array(day, later)
    back = F.array(later, day)
    return F.to_json(
        F.struct(
            F.when(a != 0, F.concat(F.lit("P"), b.cast("string"), F.when(a > 3, F.concat(F.lit(" + p"), a.cast("string"))).otherwise(""))).alias("target_col"),
            F.when(b != 0, F.round("c_acctbal", 2)).alias("on_thr_w"),
            F.when(d > 2, F.array(a + 1, F.lit(1), b)).alias("split_ratios"),
            F.when(d % 3 == 0, "Time").when(d % 3 == 1, "random").alias("split_strategy"),
            F.when(a > 1, a - 3).alias("post_min_on"),
            F.when(b == 1, "yes").when(b == 2, "off").when(b == 3, "maybe").alias("use_weather_features"),
            F.when(d > 4, d % 2 == 0).alias("guard_enabled"),
            F.struct(F.array(pair).alias("include"), F.when(d > 5, F.array(back)).alias("exclude")).alias("train"),
            F.struct(F.struct(F.array(pair).alias("include")).alias("val")).alias("splits"),
            F.struct((a > 3).alias("physics_features"), F.when(b > 2, "on").alias("focal"), F.lit(0).alias("diag")).alias("v14"),
        )
    )


def config_text(spark: SparkSession, sf: str) -> DataFrame:
    """Config files: one root object per group of customers, with a comment, a default and a non-object."""
    extra = [
        F.when(F.col("c_custkey") % 200 == 1, F.struct(F.lit("_note").alias("k"), F.lit('"free text"').alias("v"))),
        F.when(F.col("c_custkey") % 200 == 1, F.struct(F.lit("flat").alias("k"), F.lit("12").alias("v"))),
    ]
    own = F.struct(F.col("c_custkey").cast("string").alias("k"), _entry().alias("v"))
    items = table(spark, sf, "customer").select("c_custkey", F.inline(F.array_compact(F.array(own, *extra))))
    text = F.concat(F.lit('"'), F.col("k"), F.lit('": '), F.col("v"))
    files = items.groupBy(F.floor((F.col("c_custkey") - 1) / 200).alias("file")).agg(F.sort_array(F.collect_list(text)).alias("parts"))
    return files.select(F.concat(F.lit("{"), F.array_join("parts", ", "), F.lit("}")).alias("json"))


def entries(spark: SparkSession, sf: str) -> DataFrame:
    return config.config_entries(config_text(spark, sf))


SQL_TYPED = f"""SELECT user_id, CASE WHEN a = 0 THEN NULL WHEN a <= 3 THEN 'p' || b WHEN a <> b THEN 'p' || b || '+p' || a END AS target_col,
    CASE WHEN b <> 0 AND ROUND(bal, 2) BETWEEN 0.001 AND 5000 THEN ROUND(bal, 2) END AS on_thr_w,
    CASE WHEN d > 2 AND b > 0 THEN ROUND((a + 1) / (a + 2 + b), 6) END AS train_share,
    CASE WHEN d % 3 = 0 THEN 'time' END AS split_strategy, CASE WHEN a >= 3 THEN CAST(a - 3 AS INT) END AS post_min_on,
    CASE b WHEN 1 THEN TRUE WHEN 2 THEN FALSE END AS use_weather_features, CASE WHEN d > 4 THEN d % 2 = 0 END AS guard_enabled FROM ({SQL_CUSTOMERS})"""


@query(SQL_TYPED)
def typed_settings(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-13, SRC-7/9, FIL-15, SCL-13/14: JSON text to valid typed settings, NULL where invalid."""
    out = config.typed_config(entries(spark, sf))
    return out.select(
        "user_id", "target_col", "on_thr_w", F.round(F.col("split_ratios")[0], 6).alias("train_share"), "split_strategy", "post_min_on", "use_weather_features", "guard_enabled"
    )


@query(
    f"""WITH c AS ({SQL_CUSTOMERS}) SELECT user_id, 'target_col' AS setting FROM c WHERE a > 3 AND a = b
        UNION ALL SELECT user_id, 'on_thr_w' FROM c WHERE b <> 0 AND NOT ROUND(bal, 2) BETWEEN 0.001 AND 5000 UNION ALL SELECT user_id, 'split_strategy' FROM c WHERE d % 3 = 1
        UNION ALL SELECT user_id, 'post_min_on' FROM c WHERE a = 2 UNION ALL SELECT user_id, 'use_weather_features' FROM c WHERE b = 3"""
)
def rejected_settings(spark: SparkSession, sf: str) -> DataFrame:
    return config.rejected_settings(entries(spark, sf))


@query(
    f"""WITH t AS ({SQL_TYPED}), u AS (SELECT CAST(o_custkey AS VARCHAR) AS user_id FROM orders GROUP BY 1), df AS (SELECT * FROM t WHERE user_id = '7')
        SELECT u.user_id, COALESCE(t.target_col, df.target_col, 'p1') AS target_col, COALESCE(t.on_thr_w, df.on_thr_w, 10.0) AS on_thr_w, COALESCE(t.post_min_on, df.post_min_on, 1) AS post_min_on,
               COALESCE(t.guard_enabled, df.guard_enabled, TRUE) AS guard_enabled, COALESCE(t.split_strategy, df.split_strategy, 'stratified_day') AS split_strategy
        FROM u LEFT JOIN t ON t.user_id = u.user_id AND t.user_id <> '7' CROSS JOIN df"""
)
def config_overlay(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-13: customer 7's entry plays the default; users are the customers with orders."""
    typed = config.typed_config(entries(spark, sf)).withColumn("user_id", F.when(F.col("user_id") == "7", "_default").otherwise(F.col("user_id")))
    users = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("user_id")).distinct()
    defaults = {"target_col": "p1", "on_thr_w": 10.0, "post_min_on": 1, "guard_enabled": True, "split_strategy": "stratified_day"}
    return joins.overlay(users, typed, list(defaults), defaults)


@query(
    f"""SELECT user_id, FALSE AS v14_enable, a > 3 AS physics, b > 2 AS focal, FALSE AS ensemble, FALSE AS calibrate, FALSE AS auto_config, FALSE AS health, FALSE AS diag FROM ({SQL_CUSTOMERS})"""
)
def feature_flags(spark: SparkSession, sf: str) -> DataFrame:
    """FIL-16."""
    return config.feature_flags(entries(spark, sf))


SQL_SPANS = f"""SELECT user_id, DATE '2024-01-01' + CAST(d AS INT) AS day, d FROM ({SQL_CUSTOMERS})"""


@query(
    f"""WITH s AS ({SQL_SPANS})
        SELECT user_id, 'train' AS stage, 'include' AS kind, CAST(day AS TIMESTAMP) AS start, CAST(day + 5 AS TIMESTAMP) + INTERVAL 86399 SECOND AS "end", TRUE AS valid FROM s
        UNION ALL SELECT user_id, 'train', 'exclude', CAST(day + 5 AS TIMESTAMP), CAST(day AS TIMESTAMP) + INTERVAL 86399 SECOND, FALSE FROM s WHERE d > 5"""
)
def stage_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-13, FIL-1: range rows of the stage filters."""
    return config.stage_ranges(entries(spark, sf)).drop("start_text", "end_text")


@query(f"SELECT user_id, 'val' AS split, 'include' AS kind, CAST(day AS TIMESTAMP) AS start, CAST(day + 5 AS TIMESTAMP) + INTERVAL 86399 SECOND AS \"end\", TRUE AS valid FROM ({SQL_SPANS})")
def split_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """SPL-6."""
    return config.split_ranges(entries(spark, sf)).drop("start_text", "end_text")


@query(
    f"""SELECT user_id, '{{"include":[["' || strftime(day, '%Y-%m-%d') || 'T00:00:00","' || strftime(day + 5, '%Y-%m-%d') || 'T23:59:59"]],"exclude":[]}}' AS spec, 1 AS n_include, 0 AS n_exclude FROM ({SQL_SPANS})"""
)
def range_specs(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-14: text form of the ranges, read back for the summary."""
    specs = config.ranges_to_json(config.stage_ranges(entries(spark, sf)), ["user_id"])
    back = config.range_summary(config.ranges_from_json(specs, ["user_id"]), ["user_id"])
    return as_counts(specs.join(back, "user_id"), "n_include", "n_exclude")


# File names made from orders: bus and label files of customers in both stage folders.
SQL_FILES = """SELECT CASE WHEN o_orderkey % 4 < 2 THEN 'trains' ELSE 'infers' END AS stage, o_custkey || '_' || (o_custkey % 100) AS user_id, o_orderkey % 2 AS bus, o_orderkey % 3 + 1 AS ch,
  o_custkey % 100 AS meter, strftime(d, '%y%m%d') AS s, strftime(d + 30, '%y%m%d') AS e, d, o_orderkey
  FROM (SELECT *, CAST(o_orderdate + INTERVAL 10 YEAR AS DATE) AS d FROM orders) WHERE o_custkey % 9 <> 0 OR o_orderkey % 4 >= 2"""
SQL_NAMED = f"""SELECT *, CASE WHEN bus = 1 THEN 'e241_' || o_orderkey || '_' || meter || '-Ch' || ch || '-' || s || '-' || e || '.csv' ELSE meter || '-' || s || '-' || e || '.csv' END AS file FROM ({SQL_FILES})"""


def file_list(spark: SparkSession, sf: str) -> DataFrame:
    key, cust, date = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    # Two-digit years of names are those of the 2000s, so the orders count as ten years younger.
    date = date + F.expr("INTERVAL 10 YEARS")
    span = F.concat_ws("-", F.date_format(date, "yyMMdd"), F.date_format(date + F.expr("INTERVAL 30 DAYS"), "yyMMdd"))
    meter = (cust % 100).cast("string")
    bus_name = F.concat(F.lit("e241_"), key.cast("string"), F.lit("_"), meter, F.lit("-Ch"), (key % 3 + 1).cast("string"), F.lit("-"), span, F.lit(".csv"))
    name = F.when(key % 2 == 1, bus_name).otherwise(F.concat(meter, F.lit("-"), span, F.lit(".csv")))
    stage = F.when(key % 4 < 2, "trains").otherwise("infers")
    path = F.concat_ws("/", F.lit("data"), stage, F.concat(cust.cast("string"), F.lit("_"), meter), name)
    return table(spark, sf, "orders").where((cust % 9 != 0) | (key % 4 >= 2)).select(path.alias("path"))


@query(
    f"""SELECT 'data/' || stage || '/' || user_id || '/' || file AS path, file, stage, user_id, CASE WHEN bus = 1 THEN 'bus' ELSE 'branch' END AS kind, CASE WHEN bus = 1 THEN CAST(o_orderkey AS VARCHAR) END AS device,
               CAST(meter AS VARCHAR) AS meter, CASE WHEN bus = 1 THEN CAST(ch AS INT) END AS channel, d AS start, d + 30 AS "end"
        FROM ({SQL_NAMED})"""
)
def parsed_files(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-10: names to stage, user, kind, device, channel and period."""
    return discovery.parse_files(file_list(spark, sf))


SQL_USERS = f"""SELECT user_id, MIN(file) FILTER (WHERE stage = 'trains' AND bus = 1) AS train_bus, MIN(file) FILTER (WHERE stage = 'trains' AND bus = 0) AS train_branch,
  MIN(file) FILTER (WHERE stage = 'infers' AND bus = 1) AS infer_bus, MIN(file) FILTER (WHERE stage = 'infers' AND bus = 0) AS infer_branch,
  CAST(MIN(ch) FILTER (WHERE bus = 1) AS INT) AS channel FROM ({SQL_NAMED}) GROUP BY 1"""
SQL_TARGETS = f"""SELECT *, CASE WHEN CAST(split_part(user_id, '_', 1) AS INT) % 4 = 0 THEN [] ELSE ['p1', 'p' || (CAST(split_part(user_id, '_', 1) AS INT) % 3 + 2)] END AS cols,
  CASE CAST(split_part(user_id, '_', 1) AS INT) % 5 WHEN 0 THEN 'P1+p2' WHEN 1 THEN 'p2' WHEN 2 THEN 'bad' END AS cfg FROM ({SQL_USERS})"""
SQL_CHOSEN = f"""SELECT *, CASE WHEN cfg = 'bad' THEN NULL WHEN cfg = 'p2' AND (len(cols) = 0 OR list_contains(cols, 'p2')) THEN 'p2'
    WHEN cfg = 'P1+p2' AND (len(cols) = 0 OR list_contains(cols, 'p2')) THEN 'p1+p2' END AS c1,
  CASE WHEN channel IS NOT NULL AND (len(cols) = 0 OR list_contains(cols, 'p' || channel)) THEN 'p' || channel END AS c2, cols[1] AS c3 FROM ({SQL_TARGETS})"""


def _chosen(spark: SparkSession, sf: str) -> DataFrame:
    users = discovery.discover_users(discovery.parse_files(file_list(spark, sf)))
    number = F.split("user_id", "_")[0].cast("int")
    columns = F.when(number % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("p1"), F.concat(F.lit("p"), (number % 3 + 2).cast("string"))))
    wanted = F.when(number % 5 == 0, "P1+p2").when(number % 5 == 1, "p2").when(number % 5 == 2, "bad")
    return meters.choose_target(users.withColumn("columns", columns).withColumn("config_target", wanted))


@query(
    f"""SELECT user_id, channel, COALESCE(c1, c2, c3, 'p1') AS target, CASE WHEN c1 IS NOT NULL THEN 'config' WHEN c2 IS NOT NULL THEN 'channel' WHEN c3 IS NOT NULL THEN 'first_column' ELSE 'default' END AS target_source FROM ({SQL_CHOSEN})"""
)
def chosen_targets(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-8."""
    return _chosen(spark, sf).select("user_id", "channel", "target", "target_source")


@query(
    f"""SELECT user_id, train_bus, train_branch, infer_bus, infer_branch, train_bus IS NOT NULL AND train_branch IS NOT NULL AS runnable,
               CASE WHEN train_bus IS NULL OR train_branch IS NULL THEN 'skip: no training data' WHEN infer_bus IS NULL THEN 'train only' WHEN infer_branch IS NULL THEN 'train and predict, no scores'
                    ELSE 'train, score and predict' END AS plan FROM ({SQL_USERS})"""
)
def execution_plans(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-10, FIL-14, SET-4."""
    return discovery.execution_plan(_chosen(spark, sf)).select("user_id", "train_bus", "train_branch", "infer_bus", "infer_branch", "runnable", "plan")


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 AND c_acctbal <= 5000 AND c_custkey % 3 = 0 THEN c_acctbal WHEN c_custkey % 4 = 0 THEN 25.0 WHEN c_custkey % 5 = 0 THEN 40.0 ELSE 10.0 END AS threshold FROM customer"""
)
def chosen_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-9: explicit, own, shared, built in."""
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        "c_custkey",
        meters.choose_threshold(
            F.when(key % 3 == 0, F.col("c_acctbal")),
            F.when(key % 4 == 0, "25").otherwise("none"),
            F.when(key % 5 == 0, "40").otherwise("-1"),
        ).alias("threshold"),
    )


# Run log: every order is one run of its customer; the last finished run of a customer is its state.
SQL_RUNS = """SELECT CAST(o_custkey AS VARCHAR) AS user_id, CASE o_orderstatus WHEN 'F' THEN 'fail' WHEN 'O' THEN 'ok' ELSE 'soft_skip' END AS status, o_orderstatus <> 'F' AS success,
  o_orderdate + to_seconds(o_orderkey) AS finished_at, o_totalprice / 1000 AS duration_s, CAST(o_orderkey AS VARCHAR) AS run_id FROM orders"""


def runs_log(spark: SparkSession, sf: str) -> DataFrame:
    finished = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") * 1_000_000).cast("timestamp_ntz")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.when(F.col("o_orderstatus") == "F", "fail").when(F.col("o_orderstatus") == "O", "ok").otherwise("soft_skip").alias("status"),
        (F.col("o_orderstatus") != "F").alias("success"),
        finished.alias("finished_at"),
        (F.col("o_totalprice") / 1000).alias("duration_s"),
        F.col("o_orderkey").cast("string").alias("run_id"),
    )


SQL_STATE = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY finished_at >= '1999-01-01' DESC, finished_at DESC) AS rn FROM ({SQL_RUNS})) WHERE rn = 1"


def _state(spark: SparkSession, sf: str) -> DataFrame:
    log = runs_log(spark, sf)
    edge = F.lit("1999-01-01").cast("timestamp_ntz")
    old = state.upsert(state.empty_state(spark), log.where(F.col("finished_at") < edge))
    return state.upsert(old, log.where(F.col("finished_at") >= edge))


@query(f"SELECT user_id, status, success, finished_at, {sql_round('duration_s', 5)} AS duration_s, run_id FROM ({SQL_STATE})")
def state_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-23/24: two batches of runs onto an empty state."""
    return settled(_state(spark, sf).select("user_id", "status", "success", "finished_at", "duration_s", "run_id"), 5, "duration_s")


@query(
    f"""SELECT site_id, event_id, strftime(time, '%Y/%-m/%-d %-H:%M:%S') AS time, {sql_round('y_pred', 3)} AS y_pred,
               row_number() OVER (ORDER BY site_id, time, event_id) AS place FROM ({SQL_PRED})"""
)
def report_rows(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-22, TOP-5: a report sorted by ranges into files, read back file by file; the place counts from the first file's start."""
    path = f"{checkpoint_dir(spark)}/report-{uuid.uuid4().hex}"
    rows = settled(pred(spark, sf).select("site_id", "event_id", "time", "y_pred"), 3, "y_pred")
    meters.write_report(rows, path, ["time"], short=True, order=["site_id", "time", "event_id"])
    kinds = "site_id STRING, event_id BIGINT, time STRING, y_pred DOUBLE"
    held = spark.read.schema(kinds).option("header", True).csv(path).select("*", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"))
    held = cut_lineage(held)
    files = held.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("file", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return held.join(F.broadcast(starts), "file").select("site_id", "event_id", "time", "y_pred", (F.col("start") + F.col("at") - F.col("first") + 1).alias("place"))


@query(f"SELECT user_id, status, success, finished_at, {sql_round('duration_s', 5)} AS duration_s, run_id, version FROM ({SQL_STATE}), (SELECT 2 AS version)")
def state_two_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-24: two rounds of upserts into a stored table; each is a version behind a pointer."""
    base = f"{checkpoint_dir(spark)}/state-{uuid.uuid4().hex}"
    log = runs_log(spark, sf).withColumn("started_at", F.col("finished_at"))
    edge = F.lit("1999-01-01").cast("timestamp_ntz")
    for rows in (log.where(F.col("finished_at") < edge), log.where(F.col("finished_at") >= edge)):
        version = state.store_state(rows, base)
    out = state.stored_state(spark, base).select("user_id", "status", "success", "finished_at", "duration_s", "run_id", F.lit(version).alias("version"))
    return settled(out, 5, "duration_s")


@query(
    f"""SELECT CASE WHEN CAST(run_id AS BIGINT) % 11 <> 0 THEN user_id END AS user_id, status, CASE WHEN CAST(run_id AS BIGINT) % 7 <> 0 THEN {sql_round('duration_s', 4)} END AS duration_s,
               CASE WHEN CAST(run_id AS BIGINT) % 5 <> 0 THEN finished_at END AS finished_at, run_id,
               CAST(run_id AS BIGINT) % 11 = 0 OR CAST(run_id AS BIGINT) % 7 = 0 OR CAST(run_id AS BIGINT) % 5 = 0 AS damaged FROM ({SQL_RUNS})"""
)
def state_damage(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-23: a state file with values of the wrong type, rows without a user, other columns in another order."""
    path = f"{checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}"
    number = F.col("run_id").cast("long")
    runs_log(spark, sf).select(
        "run_id", F.lit("x").alias("machine"),
        F.when(number % 7 == 0, "n/a").otherwise(F.col("duration_s").cast("string")).alias("duration_s"),
        F.when(number % 11 != 0, F.col("user_id")).alias("user_id"),
        F.when(number % 5 == 0, "yesterday").otherwise(F.col("finished_at").cast("string")).alias("finished_at"), "status",
    ).write.option("header", True).csv(path)
    seen = state.inspect_state(spark, path).select("user_id", "status", "duration_s", "finished_at", "run_id", "damaged")
    return settled(seen, 4, "duration_s")


@query(f"SELECT CAST(c_custkey AS VARCHAR) AS user_id FROM customer WHERE CAST(c_custkey AS VARCHAR) NOT IN (SELECT user_id FROM ({SQL_STATE}) WHERE status IN ('ok', 'soft_skip'))")
def resume_users(spark: SparkSession, sf: str) -> DataFrame:
    """JOI-12."""
    users = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("user_id"))
    return state.resume_set(users, _state(spark, sf))


@query(f"SELECT status, COUNT(*) AS n_users, {sql_round('SUM(duration_s)', 4)} AS total_s, {sql_round('AVG(duration_s)', 5)} AS mean_s FROM ({SQL_STATE}) GROUP BY 1")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-18."""
    return settled(settled(state.run_summary(_state(spark, sf)), 4, "total_s"), 5, "mean_s")


SQL_GATES = """SELECT CAST(user_id AS VARCHAR) AS user_id, CASE WHEN COUNT(*) < 60 THEN 'aligned_too_few' WHEN SUM(CAST(value >= 50 AS INT)) IN (0, COUNT(*)) THEN 'single_class_label' END AS skip_reason FROM events GROUP BY 1"""


def _gates(spark: SparkSession, sf: str) -> DataFrame:
    gates = quality_gates(pred(spark, sf), ["user_id"], "state_true", min_rows=60)
    return gates.select(F.col("user_id").cast("string").alias("user_id"), "skip_reason")


@query(f"SELECT skip_reason, COUNT(*) AS n_users FROM ({SQL_GATES}) WHERE skip_reason IS NOT NULL GROUP BY 1")
def skip_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-17."""
    return state.skip_distribution(_gates(spark, sf))


@query(f"SELECT s.user_id, CASE WHEN skip_reason IS NOT NULL THEN 'soft_skip' WHEN success THEN 'ok' ELSE 'fail' END AS status FROM ({SQL_STATE}) s LEFT JOIN ({SQL_GATES}) g USING (user_id)")
def user_statuses(spark: SparkSession, sf: str) -> DataFrame:
    return user_status(_gates(spark, sf), _state(spark, sf).drop("status")).select("user_id", "status")


SQL_STAGES = f"""
  WITH m AS (SELECT CAST(user_id AS VARCHAR) AS user_id, CASE WHEN split = 'train' AND user_id % 5 = 0 THEN 'inference' ELSE split END AS stage, model, {SQL_REG} FROM ({SQL_TRACKS}) WHERE user_id % 3 <> 0 OR model <> 'main' GROUP BY 1, 2, 3),
  k AS (SELECT *, row_number() OVER (PARTITION BY user_id, stage ORDER BY CASE model WHEN 'main_final' THEN 0 WHEN 'main' THEN 1 ELSE 2 END, model) AS rn FROM m),
  g AS (SELECT u.user_id, s.stage FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS user_id FROM events) u CROSS JOIN (VALUES ('train'), ('val'), ('test'), ('inference')) s(stage))
  SELECT g.user_id, g.stage, CASE WHEN skip_reason IS NOT NULL THEN 'soft_skip:' || skip_reason WHEN k.model IS NULL THEN CASE g.stage WHEN 'inference' THEN 'no_inference' ELSE 'no_' || g.stage || '_metrics' END ELSE 'ok:' || k.model END AS status,
         CASE WHEN skip_reason IS NULL THEN n END AS n_samples, {sql_round('CASE WHEN skip_reason IS NULL THEN mae END', 6)} AS "MAE_W", {sql_round('CASE WHEN skip_reason IS NULL THEN sae END', 6)} AS "SAE"
  FROM g LEFT JOIN k ON k.user_id = g.user_id AND k.stage = g.stage AND rn = 1 LEFT JOIN ({SQL_GATES}) q ON q.user_id = g.user_id"""


@query(SQL_STAGES)
def stage_summary(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-16: four rows per user."""
    rows = tracks(spark, sf).where("user_id % 3 <> 0 OR model <> 'main'")
    rows = rows.withColumn("split", F.when((F.col("split") == "train") & (F.col("user_id") % 5 == 0), "inference").otherwise(F.col("split")))
    rows = rows.withColumn("user_id", F.col("user_id").cast("string"))
    long = metrics.metric_rows(metrics.regression_metrics(rows, ["user_id", "split", "model"], "y_true", "y_pred"), ["user_id", "split", "model"])
    users = rows.select("user_id").distinct()
    out = stage_table(users, long, _gates(spark, sf))
    return settled(out.select("user_id", "stage", "status", "n_samples", "MAE_W", "SAE"), 6, "MAE_W", "SAE")


@query(
    f"""SELECT model, source, CAST(n AS BIGINT) AS n, {sql_round('total', 4)} AS total FROM (
          SELECT model, 'old' AS source, COUNT(*) AS n, SUM(y_pred) AS total FROM ({SQL_TRACKS}) WHERE split = 'train' GROUP BY 1
          UNION ALL SELECT model, NULL, COUNT(*), SUM(y_pred) FROM ({SQL_TRACKS}) WHERE split <> 'train' GROUP BY 1)"""
)
def evolving_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-21: rows of a later table that lack a column of the earlier one."""
    rows = tracks(spark, sf)
    old = rows.where("split = 'train'").select("model", F.lit("old").alias("source"), "y_pred")
    new = rows.where("split <> 'train'").select("y_pred", "model")
    both = meters.union_evolving(old, new)
    return settled(both.groupBy("model", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("y_pred").alias("total")), 4, "total")


