import numpy as np
import pandas as pd
import pytest
from helpers import series_frame

from wattloom.operators import drift
from wattloom.operators.joins import lookup_bins
from wattloom.operators.metrics import all_metrics, daily_metrics, leak_ood_metrics
from wattloom.plans.training import sanity
from wattloom.sources import weather as wx


def report(spark, rows):
    return spark.createDataFrame([("a", *r) for r in rows], "u string, dimension string, drift_ratio double, level string")


def test_switch(spark):
    calm = drift.switch_decision(report(spark, [("concept/x", 0.05, "NORMAL")]), ["u"]).collect()[0]
    assert (calm.mode, calm.main_weight, calm.use_fallback) == ("NORMAL", 1.0, False)
    hot = report(spark, [("concept/x", 0.3, "ALERT"), ("concept/y", 0.4, "ALERT"), ("concept/z", 0.6, "ALERT")])
    assert [(r.mode, r.main_weight) for r in drift.switch_decision(hot, ["u"]).collect()] == [("ALERT", 0.0)]
    assert [(r.mode, r.main_weight) for r in drift.switch_decision(hot, ["u"], calibrated=True).collect()] == [("ALERT", 0.5)]
    assert [(r.mode, r.main_weight) for r in drift.switch_decision(hot, ["u"], has_fallback=False).collect()] == [("ALERT", 1.0)]
    warm = report(spark, [("concept/x", 0.21, "WARN"), ("time/hour_skew", 0.9, "NORMAL")])
    assert [(r.mode, r.main_weight) for r in drift.switch_decision(warm, ["u"]).collect()] == [("WARN", 0.6)]


def lut_brute(temp, w):
    edges = np.unique(np.quantile(temp, np.linspace(0, 1, 21)))
    rows = []
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        m = (temp >= lo) & (temp <= hi)
        if m.sum() >= 5:
            rows.append((lo, hi, int(m.sum()), np.median(w[m])))
    return rows


def test_lut_and_lookup(spark):
    rng = np.random.default_rng(3)
    temp = np.round(rng.normal(15, 6, 500))
    w = np.round(300 + 20 * np.abs(temp - 18) + rng.normal(0, 10, 500), 2)
    df = series_frame(spark, pd.DataFrame({"u": "a", "t": temp, "w": w}))
    lut = drift.build_lut(df, ["u"], "t", "w")
    got = [(r.temp_lo, r.temp_hi, r.n_samples, r.expected_signal) for r in lut.where("bin_id >= 0").orderBy("bin_id").collect()]
    assert [g[:3] for g in got] == [b[:3] for b in lut_brute(temp, w)]
    assert [g[3] for g in got] == pytest.approx([b[3] for b in lut_brute(temp, w)])
    out = lookup_bins(df, lut, ["u"], "t", "e").toPandas()
    for r in out.itertuples():
        want = np.median(w)
        for lo, hi, _, med in lut_brute(temp, w):
            if lo <= r.t <= hi:
                want = med
        assert r.e == pytest.approx(want)
    cold = series_frame(spark, pd.DataFrame({"u": ["a"], "t": [-40.0], "w": [1.0]}))
    assert lookup_bins(cold, lut, ["u"], "t", "e").first().e == pytest.approx(np.median(w))


def test_running_stats(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"u": "a", "d": np.repeat(pd.date_range("2026-01-01", periods=30), 20), "x": rng.normal(50, 5, 600)})
    out = drift.running_stats(series_frame(spark, pdf), ["u"], "d", "x").orderBy("d").toPandas()
    assert out["mean"].tolist() == pytest.approx([pdf.x[: 20 * (i + 1)].mean() for i in range(30)])
    assert out["std"].tolist() == pytest.approx([pdf.x[: 20 * (i + 1)].std() for i in range(30)])
    ema = None
    for m, got in zip(pdf.groupby("d").x.mean(), out.mean_ema, strict=True):
        ema = m if ema is None else 0.99 * ema + 0.01 * m
        assert got == pytest.approx(ema)


def scored():
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"u": "a", "ts": pd.date_range("2026-01-01", periods=192, freq="15min"), "y": np.where(rng.random(192) < 0.5, 0.0, 500.0)})
    pdf["p"] = pdf.y * rng.uniform(0.8, 1.2, 192)
    pdf["s"], pdf["sp"] = (pdf.y >= 10).astype(int), (rng.random(192) < 0.5).astype(int)
    pdf["model"] = "main"
    return pdf


def test_metrics(spark):
    pdf = scored()
    r = all_metrics(series_frame(spark, pdf), ["u"], "y", "p", "s", "sp").collect()[0]
    tp, fp = ((pdf.s == 1) & (pdf.sp == 1)).sum(), ((pdf.s == 0) & (pdf.sp == 1)).sum()
    assert (r.TP, r.FP) == (tp, fp)
    assert r.Precision == pytest.approx(tp / (tp + fp))
    assert r.SAE == pytest.approx(abs(pdf.p.sum() - pdf.y.sum()) / pdf.y.sum())
    assert r.NDE == pytest.approx(np.sqrt(((pdf.p - pdf.y) ** 2).sum() / (pdf.y**2).sum()))
    assert r.kWh_true == pytest.approx(pdf.y.sum() * 0.25 / 1000)


def test_zero_division_and_daily_sae(spark):
    pdf = scored().assign(y=0.0, p=5.0, s=0, sp=0)
    r = daily_metrics(series_frame(spark, pdf), ["u"], "ts", "y", "p", "s", "sp").collect()
    assert len(r) == 2 and all(x.SAE is None and x.F1 == 0.0 and x.Accuracy == 1.0 for x in r)


def test_leak_rows_only_for_leaking_users(spark):
    pdf = pd.concat([scored(), scored().assign(u="b")], ignore_index=True)
    days = spark.sql("SELECT 'a' AS u, DATE '2026-01-01' AS date")
    out = leak_ood_metrics(series_frame(spark, pdf), days, ["u"], "ts", "y", "p", "s", "sp").collect()
    assert {(r.u, r.split, r.n_samples) for r in out} == {("a", "inference_leak", 96), ("a", "inference_ood", 96)}


def test_sanity(spark):
    bad = scored().assign(p=np.nan, sp=2)
    r = sanity(series_frame(spark, bad), ["u"], "y", "p", "s", "sp").collect()[0]
    assert not r.passed and {"too_few_rows", "bad_state", "bad_power", "low_f1"} <= set(r.failed)


def test_weather_fallback_and_upsert(spark, tmp_path):
    spans = spark.sql("SELECT 'x' AS place, DATE '2026-07-01' AS start, DATE '2026-07-02' AS end UNION ALL SELECT 'y', DATE '2026-07-01', DATE '2026-07-02'")
    clim = wx.climatology(spans, ["place"])
    noon = clim.where("place = 'x' AND time = TIMESTAMP_NTZ '2026-07-01 14:00:00'").first()
    assert noon.temperature_2m == pytest.approx(33.9) and noon.apparent_temperature == pytest.approx(35.4)
    stored = clim.where("place = 'x'").withColumn("temperature_2m", clim.temperature_2m + 100)
    used = wx.weather_for_period(stored, spans, ["place"]).groupBy("place").agg({"temperature_2m": "max"}).collect()
    top = {r[0]: r[1] for r in used}
    assert top["x"] > 100 > top["y"]
    merged = wx.merge_weather(stored, clim, ["place"])
    assert merged.count() == clim.count()
    assert merged.where("place = 'x'").agg({"temperature_2m": "min"}).first()[0] > 100
    base = str(tmp_path / "w")
    assert wx.stored_weather(spark, base) is None
    assert [wx.save_weather(stored, base), wx.save_weather(clim, base)] == [1, 2]
    columns = merged.columns
    assert sorted(wx.stored_weather(spark, base).select(columns).collect()) == sorted(merged.collect())
    sites = clim.withColumnRenamed("place", "site")
    wx.save_weather(sites, str(tmp_path / "s"), keys=("site",))
    assert wx.stored_weather(spark, str(tmp_path / "s")).where("site = 'y'").count() == sites.where("site = 'y'").count()
