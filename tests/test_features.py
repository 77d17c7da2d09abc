import numpy as np
import pandas as pd
import pytest
from helpers import series_frame, sorted_pandas

from wattloom.operators import windows as win
from wattloom.operators.series import Series
from wattloom.plans.align import align_meters
from wattloom.plans.features import build_features, feature_names

S = Series(("u",), "ts", ())


def long_series(n, users=("a",), seed=0):
    rng = np.random.default_rng(seed)
    parts = []
    for u in users:
        parts.append(pd.DataFrame({"u": u, "ts": pd.date_range("2026-01-01", periods=n, freq="15min"), "w": np.round(rng.normal(100, 40, n), 3), "v": np.round(rng.normal(20, 5, n), 3)}))
    return pd.concat(parts, ignore_index=True)


@pytest.mark.parametrize("chunk", [None, 5 * 86_400])
def test_ema_matches_pandas(spark, chunk):
    pdf = long_series(1_300, ("a", "b"))
    out = sorted_pandas(win.ema_family(series_frame(spark, pdf), S.renamed(chunk_s=chunk), ["w"]), "u", "ts")
    for h in (2, 24):
        want = pdf.groupby("u").w.transform(lambda x, h=h: x.ewm(halflife=h, adjust=False).mean())
        assert np.allclose(out[f"w_ema_{h}"], want, rtol=0, atol=1e-9)


def test_long_families_match_pandas(spark):
    pdf = long_series(7_000)
    out = sorted_pandas(win.long_families(series_frame(spark, pdf), S.renamed(chunk_s=30 * 86_400), "w"), "ts")
    w = pdf.w
    day, week = w.rolling(96, min_periods=1), w.rolling(672, min_periods=1)
    assert np.allclose(out.w_dev_24h, w - day.mean(), atol=1e-8)
    assert np.allclose(out.w_dev_7d, w - week.mean(), atol=1e-8)
    assert np.allclose(out.w_z_24h, ((w - day.mean()) / day.std().bfill().clip(lower=5.0)).fillna(0), atol=1e-8)
    for name, (n, least) in {"power_recent_24h_mean": (96, 4), "power_recent_7d_mean": (672, 16)}.items():
        want = w.rolling(n, min_periods=least, closed="left").mean().bfill()
        assert np.allclose(out[name], want, atol=1e-8)


def test_short_series_takes_its_median(spark):
    pdf = pd.concat([long_series(3, ("a",)), long_series(12, ("b",), 4)], ignore_index=True)
    out = sorted_pandas(win.long_families(series_frame(spark, pdf), S, "w", deviations=False), "u", "ts")
    for u, g in pdf.groupby("u"):
        mine = out[out.u == u]
        for name, (n, least) in {"power_recent_24h_mean": (96, 4), "power_recent_7d_mean": (672, 16)}.items():
            want = g.w.rolling(n, min_periods=least, closed="left").mean().bfill().fillna(g.w.median())
            assert np.allclose(mine[name], want)


def test_slope_keeps_sample_over_population_ratio(spark):
    pdf = pd.DataFrame({"u": "a", "ts": pd.date_range("2026-01-01", periods=8, freq="15min"), "w": np.arange(8) * 3.0, "v": 0.0})
    out = sorted_pandas(build_features(series_frame(spark, pdf), S, ["w", "v"], spike="d", physics=True), "ts")
    assert out.w_slope_4.tolist()[4:] == pytest.approx([4.0] * 4)
    assert out.w_slope_4[0] == 0.0


def test_feature_table_matches_pandas(spark):
    pdf = long_series(400)
    pdf["d_min5"] = np.where(np.arange(400) % 50 == 0, -80.0, -3.0)
    pdf["d_max5"] = 4.0
    out = sorted_pandas(build_features(series_frame(spark, pdf), S.renamed(chunk_s=86_400), ["w", "v"], spike="d", physics=True), "ts")
    w, v = pdf.w, pdf.v
    want = {
        "w_d1": w.diff().fillna(0), "w_d6": w.diff(6).fillna(0), "v_abs_d3": v.diff(3).abs().fillna(0), "w_rm4": w.rolling(4, min_periods=1).mean(),
        "w_rs4": w.rolling(4, min_periods=1).std().fillna(0), "w_lag2": w.shift(2).bfill(), "w_up_d1": (w.diff().fillna(0) > 50).astype(float),
        "w_range_12": w.rolling(12, min_periods=1).max() - w.rolling(12, min_periods=1).min(), "w_std_24": w.rolling(24, min_periods=1).std().fillna(0),
        "w_p25_12": w.rolling(12, min_periods=1).quantile(0.25), "w_iqr_4": w.rolling(4, min_periods=1).quantile(0.75) - w.rolling(4, min_periods=1).quantile(0.25),
        "d87_event_recent_3": (pdf.d_min5 < -50).astype(float).rolling(3, min_periods=1).max(), "ratio_w_over_v": w.abs() / v.abs().clip(lower=5),
        "sin_doy": np.sin(2 * np.pi * pdf.ts.dt.dayofyear / 365.25), "dow": pdf.ts.dt.dayofweek.astype(float),
    }
    for name, series in want.items():
        assert np.allclose(out[name], series, atol=1e-9), name
    assert not out.drop(columns=["u", "ts"]).isna().any().any()
    assert out.columns.tolist()[2:] == feature_names(pdf.columns, ["w", "v"], "d", weather=False, drift=False, physics=True)


def test_feature_counts():
    top = [f"load_iden_data{i}" for i in range(25)]
    assert len(feature_names(top, top, weather=False, drift=False)) == 25 + 10 + 10 + 6 + 20 + 10 + 6 + 6 + 9 + 9
    assert len(feature_names(top, top)) == len(feature_names(top, top, weather=False, drift=False)) + 12 + 5


def test_alignment(spark):
    bus = pd.DataFrame({"u": "a", "event_time": pd.date_range("2026-01-01", periods=20, freq="5min"), "load_iden_data0": np.r_[np.arange(10.0), np.arange(10.0)]})
    branch = pd.DataFrame({"u": "a", "time": pd.date_range("2026-01-01", periods=4, freq="15min"), "p1": [24.0, 16, 16, 16], "p2": [8.0, 0, 0, 8]})
    out = sorted_pandas(align_meters(series_frame(spark, bus), series_frame(spark, branch), ["u"], "p1+p2"), "ts")
    assert out.y_ac.tolist() == [32.0, 16.0, 16.0, 24.0]
    assert out.load_iden_data0.tolist() == [1.0, 4.0, 7.0, pytest.approx(10 / 3)]


def test_alignment_without_labels_keeps_the_grid(spark):
    times = list(pd.date_range("2026-01-01 00:00", periods=3, freq="15min")) + [pd.Timestamp("2026-01-01 03:00")]
    bus = pd.DataFrame({"u": "a", "event_time": times, "load_iden_data0": [1.0, 2.0, 3.0, 9.0]})
    out = sorted_pandas(align_meters(series_frame(spark, bus), None, ["u"]), "ts")
    assert out.load_iden_data0.tolist() == [1, 2, 3, 3, 3, 9, 9, 9]
