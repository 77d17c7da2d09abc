import numpy as np
import pandas as pd
import pytest
from helpers import series_frame, sorted_pandas
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattloom.operators.joins import event_windows, nearest, startup_as_of
from wattloom.operators.quantiles import auc, percentiles
from wattloom.operators.resample import bounded_fill, hourly_to_quarter
from wattloom.operators.segments import filter_short_runs
from wattloom.operators.series import Series, attach, events_around, over_rows, plan_series, row_gaps, with_position

S = Series(("u",), "ts", ("i",))


def sample(n=300, seed=1, days=4):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"u": rng.choice(["a", "a", "a", "b"], n), "ts": pd.Timestamp("2026-01-01") + pd.to_timedelta(np.sort(rng.integers(0, days * 86_400, n)), unit="s"), "i": range(n)})
    pdf["x"] = np.round(rng.normal(50, 20, n), 2)
    return pdf


@pytest.mark.parametrize("chunk", [None, 1_800, 86_400])
def test_positions(spark, chunk):
    pdf = sample()
    out = sorted_pandas(with_position(series_frame(spark, pdf), S.renamed(chunk_s=chunk), total="n"), "i")
    assert out.pos.tolist() == pdf.groupby("u").cumcount().tolist()
    assert out.n.tolist() == pdf.groupby("u").u.transform("size").tolist()


@pytest.mark.parametrize("block", [8, 40, 1_000])
def test_blocks_equal_whole_windows(spark, block):
    pdf = sample()

    def step(w):
        return {"back": F.sum("x").over(w.rowsBetween(-5, 0)), "ahead": F.max("x").over(w.rowsBetween(0, 3)), "lag": F.lag("x", 4).over(w)}

    out = sorted_pandas(over_rows(series_frame(spark, pdf), S, step, 5, 3, block), "i")
    assert len(out) == len(pdf)
    g = pdf.groupby("u").x
    assert np.allclose(out.back, g.transform(lambda x: x.rolling(6, min_periods=1).sum()))
    assert np.allclose(out.ahead, g.transform(lambda x: x[::-1].rolling(4, min_periods=1).max()[::-1]))
    assert np.allclose(out.lag.astype(float), g.shift(4), equal_nan=True)


def test_gaps(spark):
    pdf = sample()
    out = sorted_pandas(row_gaps(series_frame(spark, pdf), S.renamed(chunk_s=3_600)), "i")
    assert np.allclose(out.dt_s.astype(float), pdf.groupby("u").ts.diff().dt.total_seconds(), equal_nan=True)


@pytest.mark.parametrize("chunk", [None, 3_600, 86_400])
def test_events_around(spark, chunk):
    pdf = sample()
    ev = sample(40, 2)[["u", "ts", "x"]].rename(columns={"ts": "at", "x": "load"}).drop_duplicates(["u", "at"])
    out = sorted_pandas(events_around(series_frame(spark, pdf), series_frame(spark, ev), S.renamed(chunk_s=chunk), ["load"], "at"), "i")
    for r in out.itertuples():
        mine = ev[ev.u == r.u]
        past, future = mine[mine["at"] <= r.ts], mine[mine["at"] > r.ts]
        assert (r.prev_event is None) == past.empty
        if not past.empty:
            assert (r.prev_event["at"], r.prev_event["load"]) == (past["at"].iloc[-1], past.load.iloc[-1])
        assert (r.next_event is None) == future.empty
        if not future.empty:
            assert r.next_event["at"] == future["at"].iloc[0]


def test_nearest_takes_the_later_on_ties(spark):
    rows = series_frame(spark, pd.DataFrame({"u": "a", "ts": pd.to_datetime(["2026-01-01 00:30", "2026-01-01 00:29", "2026-01-01 01:00"]), "i": [0, 1, 2]}))
    readings = series_frame(spark, pd.DataFrame({"u": "a", "t": pd.to_datetime(["2026-01-01 00:00", "2026-01-01 01:00"]), "temp": [1.0, 2.0]}))
    assert sorted_pandas(nearest(rows, readings, S, ["temp"], "t"), "i").temp.tolist() == [2.0, 1.0, 2.0]


def test_startup_lookahead(spark):
    steps = series_frame(spark, pd.DataFrame({"u": "a", "ts": pd.date_range("2026-01-01", periods=6, freq="15min"), "i": range(6)}))
    starts = series_frame(spark, pd.DataFrame({"u": ["a"], "startup_ts": pd.to_datetime(["2026-01-01 00:30"])}))
    out = sorted_pandas(startup_as_of(steps, starts, S), "i")
    assert out.last_startup.isna().tolist() == [True, False, False, False, False, False]
    assert out.since_h.tolist()[1:] == [-0.25, 0.0, 0.25, 0.5, 0.75]


def test_event_windows(spark):
    bus = sample(500, 3)
    ev = sample(30, 4)[["u", "ts"]].rename(columns={"ts": "e"}).drop_duplicates()
    out = event_windows(series_frame(spark, ev), series_frame(spark, bus.drop(columns="i")), ["u"], "e", "ts", "x", 1_200, 600).toPandas()
    want = {}
    for r in ev.itertuples():
        w = bus[(bus.u == r.u) & (bus.ts >= r.e - pd.Timedelta("20min")) & (bus.ts <= r.e + pd.Timedelta("10min"))]
        if len(w):
            want[(r.u, r.e)] = (w.x.min(), w.x.abs().max(), len(w))
    assert {(r.u, r.e): (r.win_min, r.win_absmax, r.win_n) for r in out.itertuples()} == want


@pytest.mark.parametrize("before, after", [(0, 0), (1_200, 600), (7_200, 86_400)])
def test_dense_event_windows(spark, before, after):
    """Windows that overlap by the hundred, events on readings, repeated events, no readings at all."""
    bus, ev = sample(400, 5), sample(150, 6)[["u", "ts"]].rename(columns={"ts": "e"})
    ev = pd.concat([ev, ev.head(5), bus[["u", "ts"]].rename(columns={"ts": "e"}).head(40), pd.DataFrame({"u": ["lonely"], "e": ev.e[:1].to_numpy()})])
    frame = series_frame(spark, bus.drop(columns="i"))
    out = event_windows(series_frame(spark, ev), frame, ["u"], "e", "ts", "x", before, after).toPandas()
    want = {}
    for r in ev.itertuples():
        w = bus[(bus.u == r.u) & (bus.ts >= r.e - pd.Timedelta(seconds=before)) & (bus.ts <= r.e + pd.Timedelta(seconds=after))]
        if len(w):
            want[(r.u, r.e)] = (w.x.min(), w.x.abs().max(), len(w))
    assert len(out) == len(want)
    assert {(r.u, r.e): (r.win_min, r.win_absmax, r.win_n) for r in out.itertuples()} == want
    assert event_windows(series_frame(spark, ev), frame.limit(0), ["u"], "e", "ts", "x", before, after).count() == 0
    assert event_windows(series_frame(spark, ev).limit(0), frame, ["u"], "e", "ts", "x", before, after).count() == 0


def test_attach_keeps_hot_key_rows(spark):
    big = spark.range(2_000).withColumn("k", F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")))
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = attach(big, small, ["k"])
    assert out.count() == 2_000
    assert out.where("k = 'hot'").agg(F.max("n")).first()[0] == 1_333


def test_chunk_plan_follows_density(spark):
    df = series_frame(spark, pd.DataFrame({"u": "a", "ts": pd.date_range("2026-01-01", periods=1_000, freq="1min")}))
    assert plan_series(df, Series(("u",), "ts"), 10_000).chunk_s is None
    assert plan_series(df, Series(("u",), "ts"), 120).chunk_s == 7_200


@pytest.mark.parametrize("seed", [0, 1])
def test_percentiles_are_exact(spark, seed):
    rng = np.random.default_rng(seed)
    n = 3_000
    pdf = pd.DataFrame({"k": rng.choice(["hot", "hot", "hot", "cold"], n), "v": np.where(rng.random(n) < 0.6, 0.0, np.round(rng.lognormal(3, 1, n), 2))})
    pdf = pd.concat([pdf, pd.DataFrame({"k": ["one"], "v": [5.0]})])
    points = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    out = percentiles(series_frame(spark, pdf), ["k"], "v", points).toPandas().set_index("k")
    for k, g in pdf.groupby("k"):
        assert out.loc[k, "n"] == len(g)
        for name, q in points.items():
            assert out.loc[k, name] == pytest.approx(np.quantile(g.v, q))
    assert percentiles(series_frame(spark, pdf), [], "v", {"m": 0.5}).first()["m"] == pytest.approx(np.median(pdf.v))


def test_auc_counts_ties_half(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b"], 400), "y": rng.integers(0, 2, 400), "p": np.round(rng.random(400), 1)})
    pdf = pd.concat([pdf, pd.DataFrame({"k": "c", "y": [1, 1], "p": [0.1, 0.2]})])
    out = auc(series_frame(spark, pdf), ["k"], "y", "p").toPandas().set_index("k").AUC
    for k in "ab":
        g = pdf[pdf.k == k]
        a, b = g[g.y == 1].p.to_numpy()[:, None], g[g.y == 0].p.to_numpy()[None, :]
        assert out[k] == pytest.approx(((a > b) + 0.5 * (a == b)).mean())
    assert pd.isna(out["c"])


def test_bounded_fill(spark):
    rng = np.random.default_rng(3)
    pdf = sample(200, 6)
    pdf["x"] = np.where(rng.random(200) < 0.5, np.nan, pdf.x)
    for k in (1, 2, 4):
        out = sorted_pandas(bounded_fill(series_frame(spark, pdf), S, ["x"], k), "i")
        want = pdf.groupby("u").x.transform(lambda x, k=k: x.ffill(limit=k).bfill(limit=k))
        assert np.allclose(out.x.astype(float), want, equal_nan=True)


def test_quarter_hour_interpolation(spark):
    hours = pd.DataFrame({"p": "x", "time": pd.date_range("2026-01-01", periods=4, freq="1h"), "t": [0.0, 4.0, 2.0, 8.0]})
    out = sorted_pandas(hourly_to_quarter(series_frame(spark, hours), ["p"], ["t"]), "time")
    idx = pd.date_range("2026-01-01", periods=16, freq="15min")
    want = hours.set_index("time").t.reindex(idx).interpolate("time", limit_direction="both")
    assert out.time.tolist() == idx.tolist()
    assert np.allclose(out.t, want)


def brute_filter(states, min_on, fill):
    def drop_short(s, value, limit):
        s, i = list(s), 0
        while i < len(s):
            j = i
            while j < len(s) and s[j] == s[i]:
                j += 1
            if s[i] == value and j - i < limit:
                s[i:j] = [1 - value] * (j - i)
            i = j
        return s

    out = drop_short(states, 1, min_on)
    return drop_short(out, 0, fill + 1) if fill > 0 else out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.integers(0, 1), min_size=1, max_size=25), min_size=3, max_size=12), st.integers(0, 4), st.integers(0, 3))
def test_short_run_filter(spark, many, min_on, fill):
    rows = [(f"s{k}", t, s) for k, states in enumerate(many) for t, s in enumerate(states)]
    pdf = pd.DataFrame(rows, columns=["u", "i", "state"])
    pdf["ts"] = pd.Timestamp("2026-01-01") + pd.to_timedelta(pdf.i * 900, unit="s")
    once = filter_short_runs(series_frame(spark, pdf), S.renamed(chunk_s=3_600), "state", "out", min_on, fill)
    out = sorted_pandas(once, "u", "i")
    for k, states in enumerate(many):
        assert out[out.u == f"s{k}"].out.tolist() == brute_filter(states, min_on, fill)


def test_score_filter_commutes_with_thresholds(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"u": "a", "i": range(120), "p": np.round(rng.random(120), 2)})
    pdf["ts"] = pd.Timestamp("2026-01-01") + pd.to_timedelta(pdf.i * 900, unit="s")
    out = sorted_pandas(filter_short_runs(series_frame(spark, pdf), S, "p", "score", 3, 2, scores=True), "i")
    for thr in (0.1, 0.35, 0.5, 0.8):
        assert (out.score >= thr).astype(int).tolist() == brute_filter((pdf.p >= thr).astype(int).tolist(), 3, 2)
