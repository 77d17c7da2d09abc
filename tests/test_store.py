"""A two-stage model that is saved, read in again and scores the same."""

from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.operators.series import Series
from wattloom.plans import store, training

SERIES = Series(("u",), "ts", ())
SMALL = training.Settings(trees=3, depth=2, forest_trees=3, forest_depth=3, correction_trees=2, band_trees=5, band_depth=3, ensemble=True, probability_calibration="isotonic", season_calibration="isotonic")


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    out = []
    for i in range(900):
        ts = datetime(2025, 1, 1) + timedelta(hours=8 * i)
        on = int(rng.random() < 0.5)
        out.append(("a", ts, on * float(400 + 200 * rng.random()) + float(rng.random()), on, on * 3.0 + float(rng.normal()), float(rng.normal()), float(ts.hour)))
    df = spark.createDataFrame(out, "u string, ts timestamp_ntz, y double, state int, x double, temp_2m double, hour double")
    return training.with_season(df, "ts").cache()


@pytest.mark.parametrize("season", ["isotonic", "linear"])
def test_saved_model_scores_the_same(spark, rows, tmp_path, season):
    settings = replace(SMALL, season_calibration=season, ensemble=season == "linear", probability_calibration="isotonic" if season == "linear" else "platt")
    features = ["x", "temp_2m", "hour"]
    model = training.fit(rows.where("ts < '2025-08-01'"), rows.where("ts >= '2025-08-01'"), features, SERIES, settings)
    path = str(tmp_path / "model")
    loaded = store.load_model(spark, store.save_model(model, path, spark))
    assert (loaded.features, loaded.threshold, loaded.correction_cap, set(loaded.experts), set(loaded.season_maps)) == (features, model.threshold, model.correction_cap, set(model.experts), set(model.season_maps))
    first, second = (training.score(rows, m, SERIES, settings).toPandas().sort_values("ts").reset_index(drop=True) for m in (model, loaded))
    for c in ("p_on", "state_pred", "y_raw", "y_low", "y_high", "y_calib", "y_season", "y_rf", "y_fallback"):
        assert first[c].tolist() == pytest.approx(second[c].tolist()), c
    on = first[first.state_pred == 1]
    assert (on.y_low <= on.y_high).all()
    assert on.assign(width=on.y_high - on.y_low).groupby("season").width.nunique().max() > 1  # bands differ within a season


def test_unfinished_folder_is_no_model(spark, rows, tmp_path):
    with pytest.raises(Exception, match="about"):
        store.load_model(spark, str(tmp_path))
    assert rows.where(F.col("season").isNull()).count() == 0


def test_settings_follow_the_number_of_rows(spark):
    got = {n: training.adapted(training.Settings(), n, spark) for n in (100, 1000, 2000, 9000)}
    assert {n: (s.trees, s.depth, s.rate, s.sample, s.min_leaf) for n, s in got.items()} == {
        100: (100, 2, 0.08, 0.9, 8), 1000: (200, 3, 0.06, 0.85, 5), 2000: (300, 3, 0.05, 0.8, 3), 9000: (300, 3, 0.05, 0.8, 2),
    }
    assert got[100].forest_trees == training.Settings().forest_trees
