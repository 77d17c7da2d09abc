"""Fits that do not need each other run side by side and give what they give alone."""

import threading
import time
from datetime import datetime, timedelta

import numpy as np
import pytest

from wattloom.operators.series import Series
from wattloom.plans import training


def test_jobs_meet():
    meeting = threading.Barrier(3, timeout=30)
    assert training.at_once({c: lambda c=c: (meeting.wait(), c)[1] for c in "abc"}) == {"a": "a", "b": "b", "c": "c"}


def test_a_failure_is_raised():
    with pytest.raises(ZeroDivisionError):
        training.at_once({"good": lambda: 1, "bad": lambda: 1 // 0})


def test_fit_overlaps(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [("a", datetime(2025, 1, 1) + timedelta(hours=8 * i), i % 2 * 400.0 + float(rng.random()), i % 2, i % 2 + float(rng.normal()), float(i % 24)) for i in range(400)]
    df = training.with_season(spark.createDataFrame(rows, "u string, ts timestamp_ntz, y double, state int, x double, hour double"), "ts").cache()
    spans = []
    for name in ("_classifier", "_regressor"):
        made = getattr(training, name)

        def timed(*args, made=made, **options):
            estimator = made(*args, **options)
            fit = estimator.fit

            def run(rows):
                start = time.time()
                model = fit(rows)
                spans.append((start, time.time()))
                return model

            estimator.fit = run
            return estimator

        monkeypatch.setattr(training, name, timed)
    settings = training.Settings(trees=4, depth=2, forest_trees=3, forest_depth=3, correction_trees=2, band_trees=3, band_depth=2)
    training.fit(df.where("ts < '2025-04-01'"), df.where("ts >= '2025-04-01'"), ["x", "hour"], Series(("u",), "ts", ()), settings)
    first, second = sorted(spans)[:2]
    assert second[0] < first[1]
