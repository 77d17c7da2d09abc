import numpy as np
import pandas as pd
import pytest
from helpers import series_frame, sorted_pandas

from wattloom.operators.resample import raw_daily_counts, sampling_profile
from wattloom.operators.segments import daily_summary, on_periods, rounded_periods, rounded_summary
from wattloom.operators.series import Series

S = Series(("u",), "ts", ("i",))


def frame(spark, times, watts, user="a"):
    return series_frame(spark, pd.DataFrame({"u": user, "ts": pd.to_datetime(times), "i": range(len(times)), "w": [float(x) for x in watts]}))


def quarter(start, n):
    return pd.date_range(start, periods=n, freq="15min")


def test_one_run(spark):
    df = frame(spark, quarter("2026-05-21 09:00", 4), [30, 100, 80, 50])
    out = rounded_periods(on_periods(df, S, "w")).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.min_w, r.mean_w, r.peak_w, r.duration_min, r.energy_kwh) == (30.0, 65.0, 100.0, 60.0, 0.065)


def test_two_runs_and_daily_minimum(spark):
    df = frame(spark, quarter("2026-05-21 09:00", 12), [20, 80, 60, 40, 0, 0, 0, 0, 100, 150, 200, 120])
    periods = on_periods(df, S, "w")
    assert [r.min_w for r in periods.orderBy("begin_time").collect()] == [20.0, 100.0]
    day = rounded_summary(daily_summary(periods, ["u"])).collect()[0]
    assert (day.n_segments, day.min_w, day.peak_w, day.total_on_min) == (2, 20.0, 200.0, 120.0)
    assert (day.first_on_time, day.last_off_time) == ("09:00:00", "11:45:00")


def test_off_day_reports_whole_day(spark):
    times = list(quarter("2026-05-21 09:00", 8)) + list(quarter("2026-05-22", 96))
    periods = on_periods(frame(spark, times, [60] * 4 + [0] * 4 + [5] * 96), S, "w")
    days = sorted_pandas(daily_summary(periods, ["u"]), "date")
    assert days.n_segments.tolist() == [1, 0]
    assert days.min_w.tolist() == [60.0, 5.0]
    assert days.total_on_min.tolist()[1] == 0.0
    assert pd.isna(days.first_on_time[1])
    assert days.energy_kwh[1] == pytest.approx(96 * 5 * 0.25 / 1000)


def test_irregular_step(spark):
    df = frame(spark, ["2026-01-01 05:00", "2026-01-01 05:15", "2026-01-01 05:20", "2026-01-01 06:00"], [100] * 4)
    r = on_periods(df, S, "w").collect()[0]
    assert r.duration_min == pytest.approx(75.0)
    assert r.energy_kwh == pytest.approx(0.1)
    assert sampling_profile(df, S).collect()[0].uneven


def test_bridged_gap(spark):
    df = frame(spark, ["2026-01-01 08:00", "2026-01-01 12:00", "2026-01-01 12:15"], [100] * 3)
    step = spark.createDataFrame([("a", 900.0)], "u string, step_s double")
    r = on_periods(df, S, "w", step=step).collect()[0]
    assert r.duration_min == pytest.approx(270.0)
    assert r.energy_kwh == pytest.approx(0.075)
    assert len(on_periods(df, S, "w", max_gap_s=3600.0, step=step).collect()) == 2


def test_single_row_uses_default_step(spark):
    r = on_periods(frame(spark, ["2026-01-01 08:00"], [100]), S, "w").collect()[0]
    assert r.duration_min == pytest.approx(15.0)


def test_run_over_midnight(spark):
    df = frame(spark, quarter("2026-01-01 23:00", 8), [100] * 8)
    split = sorted_pandas(on_periods(df, S, "w"), "begin_time")
    whole = on_periods(df, S, "w", split_by_day=False).collect()
    assert split.duration_min.tolist() == [60.0, 60.0]
    # The second day has only the tail of a run that started the day before: it is reported as a day row.
    assert sorted((r.state, r.duration_min) for r in whole) == [(0, 60.0), (1, 120.0)]
    assert split.energy_kwh.sum() == pytest.approx([r.energy_kwh for r in whole if r.state == 1][0])


def brute_runs(pdf, by_day):
    out = []
    for _, g in pdf.dropna(subset=["w"]).sort_values(["ts", "i"]).groupby("u"):
        state = (g.w >= 10).to_numpy()
        key = np.cumsum(np.r_[True, (state[1:] != state[:-1]) | (by_day & (g.ts.dt.date.to_numpy()[1:] != g.ts.dt.date.to_numpy()[:-1]))])
        for _, r in g.groupby(key):
            if r.w.iloc[0] >= 10:
                out.append((r.u.iloc[0], r.ts.iloc[0], r.ts.iloc[-1], round(r.w.sum(), 6), r.w.min(), r.w.max()))
    return sorted(out)


@pytest.mark.parametrize("chunk", [None, 3_600, 86_400, 10 * 86_400])
@pytest.mark.parametrize("by_day", [True, False])
def test_runs_do_not_depend_on_chunks(spark, chunk, by_day):
    rng = np.random.default_rng(7)
    n = 400
    pdf = pd.DataFrame({"u": rng.choice(["a", "a", "a", "b"], n), "ts": pd.Timestamp("2026-01-01") + pd.to_timedelta(np.sort(rng.integers(0, 5 * 86_400, n)), unit="s"), "i": range(n)})
    pdf["w"] = np.where(rng.random(n) < 0.85, np.repeat(rng.choice([0.0, 50.0], 40), 10), np.nan)
    pdf["w"] += np.where(pdf.w > 0, np.arange(n) % 7, 0)
    out = on_periods(series_frame(spark, pdf), S.renamed(chunk_s=chunk), "w", split_by_day=by_day, off_days=False)
    got = sorted((r.u, pd.Timestamp(r.begin_time), pd.Timestamp(r.end_time), round(r.mean_w * 1, 6), r.min_w, r.peak_w) for r in out.collect())
    want = brute_runs(pdf, by_day)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]


def test_daily_counts(spark):
    times = list(pd.date_range("2026-01-01", periods=288, freq="5min")) + list(pd.date_range("2026-01-02", periods=200, freq="5min")) + list(pd.date_range("2026-01-03", periods=288, freq="5min"))
    df = frame(spark, times, [1] * len(times))
    assert [r.n_raw for r in raw_daily_counts(df, ["u"], "ts").orderBy("date").collect()] == [288, 200, 288]
    assert raw_daily_counts(df, ["u"], "missing").count() == 0
    counts = raw_daily_counts(df.where("to_date(ts) <> DATE '2026-01-02'"), ["u"], "ts")
    day = sorted_pandas(daily_summary(on_periods(df, S, "w"), ["u"], counts, counts), "date")
    assert day.n_bus_raw.tolist() == [288, 0, 288]
