"""Rows with NULL keys, times, seasons and sides."""

import pytest
from pyspark.sql import functions as F

from wattloom.operators.drift import blend
from wattloom.operators.series import Series, with_position
from wattloom.plans.training import season_mapped
from wattloom.sources.weather import merge_weather


@pytest.mark.parametrize("chunk_s", [None, 3600])
def test_rows_without_key_or_time_leave(spark, chunk_s):
    df = spark.sql(
        "SELECT * FROM VALUES ('a', TIMESTAMP_NTZ '2026-01-01 00:00:00', 1), ('a', TIMESTAMP_NTZ '2026-01-01 05:00:00', 2), ('a', CAST(NULL AS TIMESTAMP_NTZ), 3), "
        "(NULL, TIMESTAMP_NTZ '2026-01-01 00:00:00', 4), ('b', TIMESTAMP_NTZ '2026-01-01 00:00:00', 5) AS t(u, ts, i)"
    )
    got = with_position(df, Series(("u",), "ts", ("i",), chunk_s), total="n").collect()
    assert sorted((r.i, r.pos, r.n) for r in got) == [(1, 0, 2), (2, 1, 2), (5, 0, 1)]


def test_maps_pass_over_rows_without_a_season(spark):
    df = spark.createDataFrame([(1, "winter", 1, 10.0), (2, None, 1, 10.0), (3, "winter", None, 10.0), (4, "winter", 0, 10.0)], "i int, season string, state_pred int, y_raw double")
    got = {r.i: r.y_season for r in season_mapped(df, {"winter": (1.0, 2.0)}).collect()}
    assert got == {1: 21.0, 2: 10.0, 3: 10.0, 4: 10.0}


def test_blend_with_a_missing_side(spark):
    df = spark.createDataFrame([("full", 10.0, None), ("none", None, 4.0), ("half", 10.0, 4.0), ("free", 7.0, None), (None, 5.0, None)], "u string, main double, other double")
    decisions = spark.createDataFrame([("full", 1.0), ("none", 0.0), ("half", 0.5)], "u string, main_weight double")
    got = {r.u: r.y for r in blend(df, decisions, ["u"], "main", "other", "y").collect()}
    assert got == {"full": 10.0, "none": 4.0, "half": 7.0, "free": 7.0, None: 5.0}


def test_stored_hours_win_also_for_a_null_place(spark):
    stored = spark.createDataFrame([(None, 1.0), ("x", 2.0)], "place string, temperature_2m double").withColumn("time", F.lit("2026-01-01").cast("timestamp_ntz"))
    new = stored.withColumn("temperature_2m", F.lit(9.0)).unionByName(stored.withColumn("place", F.lit("y")).limit(1))
    got = {r.place: r.temperature_2m for r in merge_weather(stored, new, ["place"]).collect()}
    assert got[None] == 1.0 and got["x"] == 2.0 and set(got) == {None, "x", "y"}
