import pandas as pd
import pytest
from helpers import series_frame

from wattloom.operators.filters import drop_unusable_columns
from wattloom.operators.joins import overlay
from wattloom.operators.metrics import comparison_table, latest_snapshot
from wattloom.operators.reports import label_correlation, top_columns
from wattloom.sources.meters import add_days, append_metrics, overwrite_if_any, prediction_table, write_report


def test_metrics_table_grows_columns(spark, tmp_path):
    path = str(tmp_path / "m")
    append_metrics(spark.createDataFrame([("main", 1.0)], "model string, value double"), path)
    both = append_metrics(spark.createDataFrame([("main", 2.0, "x")], "model string, value double, note string"), path)
    assert sorted((r.value, r.note) for r in both.collect()) == [(1.0, None), (2.0, "x")]


def test_daily_table_is_replaced_but_not_emptied(spark, tmp_path):
    path = str(tmp_path / "d")
    df = spark.range(3)
    assert overwrite_if_any(df, path)
    assert not overwrite_if_any(df.limit(0), path)
    assert spark.read.parquet(path).count() == 3
    assert overwrite_if_any(spark.range(1), path)
    assert spark.read.parquet(path).count() == 1


def test_report_file(spark, tmp_path):
    df = series_frame(spark, pd.DataFrame({"u": ["a", "a"], "t": pd.to_datetime(["2026-05-21 10:00", "2026-05-21 09:00"])}))
    write_report(df, str(tmp_path / "r"), ["t"], short=True, order=["t"])
    rows = spark.read.option("header", True).csv(str(tmp_path / "r")).collect()
    assert [r.t for r in rows] == ["2026/5/21 9:00:00", "2026/5/21 10:00:00"]


def test_prediction_rounding(spark):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ '2026-01-01 00:00:00' AS ts, 10.12345D AS y, 12.3D AS p, 0.123456D AS q, 1 AS s")
    r = prediction_table(df, ["id"], "ts", "y", "p", p_on="q", state_pred="s").first()
    assert (r.y_true_W, r.y_pred_W, r.residual_W, r.p_on, r.state_pred) == (10.123, 12.3, 2.177, 0.1235, 1)


def test_extra_days_keep_duplicates(spark):
    base = series_frame(spark, pd.DataFrame({"t": pd.to_datetime(["2026-01-01", "2026-01-02"]), "a": [1.0, 2.0], "b": [0.0, 0.0]}))
    extra = series_frame(spark, pd.DataFrame({"t": pd.to_datetime(["2026-01-02", "2026-01-03"]), "a": [9.0, 8.0]}))
    out = add_days(base, [extra], "t", ["2026-01-02"])
    assert out.columns == ["t", "a"] and sorted(r.a for r in out.collect()) == [1.0, 2.0, 9.0]


def test_dead_columns_and_ranking(spark):
    df = spark.sql("SELECT CAST(id AS DOUBLE) AS y, id * 2.0D AS a, CAST(id % 3 AS DOUBLE) AS b, 7.0D AS c, CAST(NULL AS DOUBLE) AS d FROM range(20)")
    kept = drop_unusable_columns(df, ["a", "b", "c", "d"])
    assert kept.columns == ["y", "a", "b"]
    corr = label_correlation(df, ["a", "b", "c"], "y")
    assert top_columns(corr, 1) == ["a"] and corr.count() == 2


def test_comparison_puts_main_first(spark):
    rows = spark.createDataFrame([("rf", "MAE_W", 2.0), ("main_final", "MAE_W", 1.0), ("abc", "MAE_W", 3.0)], "model string, metric string, value double")
    rows = rows.selectExpr("*", "'regression' AS metric_type")
    out = comparison_table(rows, ["rf", "main_final", "abc"])
    assert out.columns == ["metric_type", "metric", "main_final", "abc", "rf"]
    assert tuple(out.first())[2:] == (1.0, 3.0, 2.0)


def test_snapshot_takes_last_version_and_newest_row(spark):
    rows = [("t1", "v1", "main", 1.0), ("t2", "v2", "main", 2.0), ("t3", "v2", "main", 3.0), ("t3", None, "x", 9.0)]
    df = spark.createDataFrame(rows, "timestamp string, project_version string, model string, value double").selectExpr(
        "*", "'s' AS source", "'test' AS split", "'regression' AS metric_type", "'MAE_W' AS metric"
    )
    assert [(r.project_version, r.value) for r in latest_snapshot(df).collect()] == [("v2", 3.0)]


def test_overlay_order(spark):
    users = spark.createDataFrame([("a",), ("b",)], "user_id string")
    config = spark.createDataFrame([("a", 1.0, None), ("_default", 5.0, None)], "user_id string, x double, y double")
    out = {r.user_id: (r.x, r.y) for r in overlay(users, config, ["x", "y"], {"x": 9.0, "y": 7.0}).collect()}
    assert out == {"a": (1.0, 7.0), "b": (5.0, 7.0)}


def test_score_table_needs_known_columns(spark):
    with pytest.raises(Exception):
        prediction_table(spark.range(1), ["id"], "ts", "y", "p").collect()


def test_constant_and_empty_inputs_do_not_fail(spark):
    from wattloom.operators.metrics import model_consistency
    from wattloom.operators.reports import label_distribution, missed_on, power_profile

    flat = spark.sql("SELECT 'a' AS u, TIMESTAMP_NTZ '2026-01-01 00:00:00' AS ts, 0.0D AS y, 0.0D AS p, 1 AS s, 0 AS sp FROM range(3)")
    assert model_consistency(flat, ["u"], "y", "p").first().Pearson_vs_main is None
    assert missed_on(flat, ["u"], "y", "s", "sp").first().lost_share is None
    empty = flat.selectExpr("u", "ts", "CAST(NULL AS DOUBLE) AS y")
    assert label_distribution(empty, ["u"], "y", "ts").first().zero_share is None
    assert power_profile(empty, ["u"], "y").count() == 0
