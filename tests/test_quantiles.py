"""Percentiles by descending histograms, and joins with a row per key under a hot key."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.operators import quantiles, series
from wattloom.operators.quantiles import auc, column_percentiles, percentiles, running_counts

POINTS = {"p0": 0.0, "p1": 0.01, "p50": 0.5, "p95": 0.95, "p100": 1.0}


def table(spark, seed=0):
    rng = np.random.default_rng(seed)
    rows = [("normal", float(v), float(v) ** 3) for v in rng.normal(0, 100, 3000)]
    rows += [("narrow", 1000 + float(v) * 1e-9, None) for v in rng.random(2000)]
    rows += [("ties", float(v), float(v % 2)) for v in rng.integers(0, 4, 1500)]
    rows += [("wide", float(s * 10.0**e), 1.0) for s, e in zip(rng.choice([-1, 1], 500), rng.integers(-300, 300, 500), strict=True)]
    rows += [("one", 5.0, None), ("none", None, 7.0), (None, 1.0, 1.0), ("zero", 0.0, 0.0), ("zero", -0.0, 0.0)]
    rows += [("odd", float("inf"), 1.0), ("odd", float("-inf"), 2.0), ("odd", 0.0, 3.0)]
    return rows, spark.createDataFrame(rows, "k string, a double, b double").repartition(4)


@pytest.mark.parametrize("crowded", [1, 50, 1_000_000])
def test_points_of_two_columns(spark, crowded):
    rows, df = table(spark)
    wanted = {"a": {f"a_{n}": q for n, q in POINTS.items()}, "b": {"b_mid": 0.5}}
    got = {r.k: r for r in column_percentiles(df, ["k"], wanted, fine=4, parts=8, crowded=crowded).collect()}
    assert set(got) == {r[0] for r in rows} - {None}
    for k, r in got.items():
        a, b = ([v[i] for v in rows if v[0] == k and v[i] is not None] for i in (1, 2))
        assert (r.n_a, r.n_b) == (len(a), len(b))
        if k != "odd":
            for name, q in POINTS.items():
                assert r[f"a_{name}"] == (pytest.approx(np.quantile(a, q), rel=1e-12, abs=1e-12) if a else None)
        assert r.b_mid == (pytest.approx(np.quantile(b, 0.5), rel=1e-12) if b else None)
    assert (got["odd"].a_p50, got["odd"].a_p0) == (0.0, pytest.approx(-math.inf, nan_ok=True)) or math.isnan(got["odd"].a_p0)


def test_one_group_and_whole_numbers(spark):
    df = spark.createDataFrame([(i * i, i) for i in range(1001)], "v long, w int")
    assert percentiles(df, [], "v", {"mid": 0.5, "q": 0.25}).collect() == [(1001, 250000.0, 62500.0)]
    got = column_percentiles(df, [], {"v": {"a": 0.5}, "w": {"b": 0.5}}).collect()
    assert got == [(1001, 1001, 250000.0, 500.0)]
    assert percentiles(df.limit(0), [], "v", {"mid": 0.5}).collect() == []
    assert percentiles(df.limit(0), ["w"], "v", {"mid": 0.5}).collect() == []


def test_buckets_rise_with_the_value(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(0, 1, 2000), 10.0 ** rng.uniform(-320, 308, 2000), -(10.0 ** rng.uniform(-320, 308, 2000)), [0.0, np.inf, -np.inf]])
    got = spark.createDataFrame([(float(v),) for v in values], "v double").withColumn("b", quantiles.bucket_of(F.col("v"))).orderBy("v").toPandas()
    assert (got.b.diff().dropna() >= 0).all()
    assert spark.sql("SELECT double('NaN') AS v").select(quantiles.bucket_of(F.col("v"))).first()[0] > got.b.max()


def test_few_rows_are_shuffled(spark):
    """The second pass moves the rows of wanted buckets only."""
    df = spark.range(200_000).select((F.col("id") % 3).alias("k"), F.sqrt("id").alias("v"))
    span = percentiles(df, ["k"], "v", {"mid": 0.5})
    assert sorted((r.k, r.n) for r in span.collect()) == [(0, 66667), (1, 66667), (2, 66666)]
    plan = span._jdf.queryExecution().executedPlan().toString()
    assert "percentile_approx" not in plan and "_salt" not in plan


def test_running_counts_and_auc(spark):
    rng = np.random.default_rng(2)
    rows = [("a" if i % 3 else "b", int(rng.random() < 0.4), float(np.round(rng.normal(), 1))) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, y int, s double")
    for r in running_counts(df, ["k"], "s").collect():
        own = [s for k, _, s in rows if k == r.k]
        assert (r.n, r.n_below, r.n_all) == (own.count(r.s), sum(s < r.s for s in own), len(own))
    for r in auc(df, ["k"], "y", "s").collect():
        pos, neg = ([s for k, y, s in rows if k == r.k and y == c] for c in (1, 0))
        assert pytest.approx(np.mean([(p > n) + (p == n) / 2 for p in pos for n in neg])) == r.AUC


@pytest.fixture
def hot(spark):
    """Nine tenths of the rows belong to one key, some to none."""
    key = F.when(F.col("id") % 10 > 0, 7).when(F.col("id") % 500 == 0, None).otherwise(F.col("id") % 1000)
    return spark.range(0, 100_000, 1, 8).select(key.cast("long").alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_attach_equals_a_join(spark, hot, how):
    per_key = spark.range(0, 1000, 2).union(spark.range(7, 8)).select(F.col("id").alias("k"), (F.col("id") * 3).alias("c"))
    want = sorted(hot.join(per_key, "k", how).collect(), key=str)
    assert sorted(series.attach(hot, per_key, ["k"], how).collect(), key=str) == want
    assert sorted(series.attach(hot, per_key, ["k"], how, most=0).select("k", "v", "c").collect(), key=str) == want


def test_small_table_moves_no_rows(spark, hot):
    per_key = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("c"))
    plan = series.attach(hot, per_key, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_hot_key_is_spread(spark, hot):
    per_key = spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("c"))
    out = series.attach(hot, per_key, ["k"], most=0).where("k IS NOT NULL")
    sizes = sorted(r["count"] for r in out.where("k = 7").groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * np.median(sizes)


def test_heavy_keys_are_counted(spark, hot):
    assert [tuple(r) for r in series.heavy_keys(hot, ["k"], 0.05).collect()] == [(7, 90_000)]
    assert series.heavy_keys(hot.limit(0), ["k"], 0.05).collect() == []
    two = hot.withColumn("j", F.col("k") * 0 + 1)
    assert [tuple(r) for r in series.heavy_keys(two, ["k", "j"], 0.05).collect()] == [(7, 1, 90_000)]
