import numpy as np
import pandas as pd
import pytest
from helpers import series_frame, sorted_pandas
from pyspark.sql import functions as F

from wattloom.operators.guard import auto_disable, calibrate, guard_mask, scaled_threshold, startups, suppress, threshold_columns
from wattloom.operators.labels import clean_labels, cleaning_report
from wattloom.operators.metrics import best_threshold, threshold_curve
from wattloom.operators.segments import filter_short_runs, off_centres, on_edges
from wattloom.operators.series import Series
from wattloom.operators.weights import boundary_focal, inverse_density

S = Series(("u",), "ts", ())


def formula(on_p10, off_p99, n_on, n_off):
    allow = 0.75 + 0.15 * np.sqrt(min(n_on / 30, 1))
    margin = 1.05 + 0.25 * np.sqrt(min(n_off / 1500, 1))
    a, b = on_p10 * allow, off_p99 * margin
    w = 1 / (1 + np.exp(-(abs(a - b) - 15) / 8))
    return w * max(a, b) + (1 - w) * (a + b) / 2


def test_threshold_formula(spark):
    cases = [(144.0, 35.0, 80, 4800), (60.0, 100.0, 7, 694), (127.0, 100.0, 30, 1500), (50.0, 50.0, 1, 0), (0.0, 0.0, 0, 0), (200.0, 0.0, 100, 10_000)]
    df = spark.createDataFrame(cases, "a double, b double, n int, m int")
    out = df.withColumns(threshold_columns(F.col("a"), F.col("b"), F.col("n"), F.col("m"))).collect()
    for r, c in zip(out, cases, strict=True):
        assert np.isfinite(r.threshold_abs)
        assert r.threshold_abs == pytest.approx(formula(*c))
        assert 0.75 <= r.allow_factor <= 0.9 and 1.05 <= r.margin_factor <= 1.3


def test_edges_and_quiet_windows(spark):
    pdf = pd.DataFrame({"u": "a", "ts": pd.date_range("2026-01-01", periods=12, freq="15min"), "w": [60.0, 60, 0, 5, 5, 5, 0, 80, 40, 90, 0, 0]})
    df = series_frame(spark, pdf)
    assert sorted_pandas(on_edges(df, S.renamed(chunk_s=1_800), "w"), "ts").w.tolist() == [60.0, 80.0, 90.0]
    # Rows 2-5 and 3-6 are quiet; row 2 and 3 start them and the third row of each is the centre.
    assert [r.centre_ts for r in off_centres(df, S.renamed(chunk_s=1_800), "w").orderBy("centre_ts").collect()] == [pdf.ts[4].to_pydatetime(), pdf.ts[5].to_pydatetime()]


def guard_data(n=600, seed=4):
    rng = np.random.default_rng(seed)
    bus = pd.DataFrame({"u": "a", "event_time": pd.date_range("2026-01-01", periods=n * 3, freq="5min")})
    bus["d87"] = np.round(rng.normal(0, 8, n * 3), 2)
    bus["d73"] = np.round(rng.uniform(100, 900, n * 3), 1)
    branch = pd.DataFrame({"u": "a", "ts": pd.date_range("2026-01-01", periods=n, freq="15min"), "p1": 0.0})
    for start in range(20, n - 20, 60):
        branch.loc[start : start + 10, "p1"] = 300.0
        bus.loc[start * 3 - 1, "d87"] = -150.0 - start % 7
    return bus, branch


def test_calibration_and_auto_disable(spark):
    bus, branch = guard_data()
    b, l = series_frame(spark, bus), series_frame(spark, branch)
    meta = calibrate(l, b, S, "p1", "d87", "d73", "event_time")
    r = meta.collect()[0]
    on, off, on_state = [], [], (branch.p1 > 50).to_numpy()
    for i in range(len(branch)):
        if on_state[i] and (i == 0 or not on_state[i - 1]):
            t = branch.ts[i]
            on.append(bus[(bus.event_time >= t - pd.Timedelta("20min")) & (bus.event_time <= t + pd.Timedelta("10min"))].d87.abs().max())
    for i in range(len(branch) - 4):
        if (branch.p1[i : i + 4] < 10).all():
            t = branch.ts[i + 2]
            off.append(bus[(bus.event_time >= t - pd.Timedelta("15min")) & (bus.event_time <= t + pd.Timedelta("15min"))].d87.abs().max())
    assert (r.n_on_amax, r.n_off_amax) == (len(on), len(off))
    assert r.on_p10_abs == pytest.approx(np.quantile(on, 0.1))
    assert r.off_p99_abs == pytest.approx(np.quantile(off, 0.99))
    assert r.threshold_abs == pytest.approx(formula(r.on_p10_abs, r.off_p99_abs, len(on), len(off)))
    flags = auto_disable(meta, b, ["u"], "d87", "event_time").collect()[0]
    daily = bus.assign(day=bus.event_time.dt.date).groupby("day").d87.apply(lambda x: x.abs().max())
    assert flags.cover_ratio == pytest.approx((daily >= r.threshold_abs).mean())
    assert flags.enabled == (flags.cover_ratio >= 0.3)
    half = series_frame(spark, bus.assign(d73=bus.d73 / 2))
    assert scaled_threshold(meta, half, ["u"], "d73").collect()[0].scale == pytest.approx(0.5)


def test_calibration_without_events(spark):
    bus, branch = guard_data(40)
    branch["p1"] = 20.0
    r = calibrate(series_frame(spark, branch), series_frame(spark, bus), S, "p1", "d87", "d73", "event_time").collect()[0]
    assert (r.on_p10_abs, r.off_p99_abs, r.threshold_abs) == (0.0, 0.0, 0.0)


def test_guard_mask(spark):
    bus, branch = guard_data(300)
    bus.loc[bus.event_time > pd.Timestamp("2026-01-02"), "d87"] = 0.0
    steps = branch.assign(p_on=0.5, state_pred=1, y_pred=100.0)
    limit = spark.createDataFrame([("a", 150.0)], "u string, guard_w double")
    starts = startups(series_frame(spark, bus), series_frame(spark, steps), limit, ["u"], "event_time", "d87", "ts")
    seen = bus[bus.d87.abs() >= 150.0 * 0.85].event_time
    assert starts.count() == len(seen)
    out = sorted_pandas(suppress(guard_mask(series_frame(spark, steps), starts, S, max_on_h=3.0), ["state_pred", "y_pred", "p_on"]), "ts")
    for r in out.itertuples():
        past = seen[seen <= r.ts + pd.Timedelta("15min")]
        quiet = past.empty or (r.ts - past.iloc[-1]).total_seconds() / 3600 > 3.0
        assert r.suppressed == quiet
        assert (r.state_pred, r.y_pred, r.p_on) == ((0, 0.0, 0.0) if quiet else (1, 100.0, 0.5))


def test_label_cleaning_brute_force(spark):
    rng = np.random.default_rng(8)
    branch = pd.DataFrame({"u": "a", "ts": pd.date_range("2026-01-01", periods=400, freq="15min"), "p1": rng.choice([0.0, 20.0, 50.0, 5.0, 300.0, np.nan], 400)})
    bus = pd.DataFrame({"u": "a", "event_time": pd.date_range("2026-01-01", periods=1200, freq="5min"), "d87": 0.0})
    bus.loc[rng.choice(1200, 12, replace=False), "d87"] = -60.0
    starts = bus[bus.d87.abs() >= 50].event_time.to_numpy()
    cleaned = clean_labels(series_frame(spark, branch), series_frame(spark, bus), S.renamed(chunk_s=7_200), "p1", "d87", "event_time")
    out = sorted_pandas(cleaned, "ts")
    back = np.timedelta64(120, "m")
    for r in out.itertuples():
        small = 5 <= r.p1 <= 50
        t = np.datetime64(r.ts)
        before = small and ((starts > t) & (starts <= t + back)).any()
        alone = small and not ((starts >= t - back) & (starts <= t + back)).any()
        assert (r.before_startup, r.isolated) == (before, alone)
        if before or alone:
            assert r.cleaned_w == 0.0
    report = cleaning_report(cleaned, series_frame(spark, bus), S, "p1", "d87").collect()[0]
    assert report.n_cleaned_to_zero == int((out.before_startup | out.isolated).sum())
    assert report.kwh_reduction == pytest.approx((branch.p1.sum() - out.cleaned_w.sum()) * 0.25 / 1000)


def test_threshold_search_equals_one_by_one(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"u": "a", "ts": pd.date_range("2026-01-01", periods=200, freq="15min"), "p": np.round(rng.random(200), 3)})
    pdf["y"] = (pdf.p + rng.normal(0, 0.3, 200) > 0.5).astype(int)
    rows = filter_short_runs(series_frame(spark, pdf), S, "p", "score", 2, 1, scores=True)
    curve = sorted_pandas(threshold_curve(rows, ["u"], "score", "y"), "threshold")
    assert len(curve) == 94
    for thr in (0.02, 0.33, 0.5, 0.95):
        one = filter_short_runs(series_frame(spark, pdf.assign(s=(pdf.p >= thr).astype(int))), S, "s", "s2", 2, 1).toPandas()
        r = curve[np.isclose(curve.threshold, thr)].iloc[0]
        assert (r.TP, r.FP) == (((one.s2 == 1) & (one.y == 1)).sum(), ((one.s2 == 1) & (one.y == 0)).sum())
    best = best_threshold(threshold_curve(rows, ["u"], "score", "y"), ["u"]).collect()[0]
    assert best.best_thr == pytest.approx(curve.threshold[curve.f_beta.idxmax()])


def test_weights(spark):
    rng = np.random.default_rng(2)
    y = np.round(np.r_[rng.normal(700, 30, 500), rng.uniform(100, 400, 40)], 2)
    out = inverse_density(series_frame(spark, pd.DataFrame({"u": "a", "y": y})), ["u"], "y").toPandas()
    hist, edges = np.histogram(y, bins=np.linspace(y.min(), y.max() + 1e-6, 21))
    w = 1.0 / hist[np.clip(np.digitize(out.y, edges) - 1, 0, 19)]
    w = np.minimum(w, np.quantile(w, 0.95))
    w = np.maximum(w, w.mean() * 0.1)
    assert np.allclose(out.weight, w / w.mean())
    flat = inverse_density(series_frame(spark, pd.DataFrame({"u": "a", "y": [5.0] * 7})), ["u"], "y").toPandas()
    assert flat.weight.tolist() == [1.0] * 7
    focal = boundary_focal(series_frame(spark, pd.DataFrame({"u": "a", "y": y})), ["u"], "y").toPandas()
    assert focal.weight.mean() == pytest.approx(1.0)
