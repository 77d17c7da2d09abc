import pandas as pd
import pytest
from helpers import series_frame

from wattloom.streaming.jobs import drain, drain_bins, drain_late, stream_bins, stream_daily_counts, stream_guard, stream_running_stats


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    """Two files, one per day, read one per micro-batch."""
    folder = tmp_path_factory.mktemp("readings")
    frames = []
    for day in (1, 2):
        t = pd.date_range(f"2026-01-0{day}", periods=288, freq="5min")
        pdf = pd.DataFrame({"u": "a", "ts": t, "w": [float(i % 50) for i in range(288)], "d87": 0.0})
        if day == 1:
            pdf.loc[280, "d87"] = -90.0
        frames.append(pdf)
        df = series_frame(spark, pdf)
        df.coalesce(1).write.parquet(f"{folder}/day{day}")
    schema = df.schema
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(folder))
    return stream, pd.concat(frames)


def test_bins_equal_the_batch_result(two_days):
    stream, pdf = two_days
    out = drain(stream_bins(stream(), ["u"], "ts", ["w"], ["w"])).toPandas().sort_values("ts").reset_index(drop=True)
    want = pdf.set_index("ts").w.resample("15min").agg(["mean", "max"])
    closed = want[want.index + pd.Timedelta("15min") <= pdf.ts.max() - pd.Timedelta("30min")]
    assert out.ts.tolist() == closed.index.tolist()
    assert out.w.tolist() == pytest.approx(closed["mean"].tolist())
    assert out.w_max5.tolist() == closed["max"].tolist()


def test_daily_counts_grow_to_the_total(two_days):
    out = drain(stream_daily_counts(two_days[0](), ["u"], "ts"), "update").groupBy("date").max("n_raw").toPandas()
    assert sorted(out["max(n_raw)"]) == [288, 288]


def test_guard_state_survives_batches(two_days):
    out = drain(stream_guard(two_days[0](), "u", "ts", "d87", 50.0, max_on_h=3.0)).toPandas().sort_values("ts")
    startup = pd.Timestamp("2026-01-01 23:20")
    for r in out.itertuples():
        seen = startup < r.ts + pd.Timedelta("15min")
        assert r.suppressed == (not seen or (r.ts - startup).total_seconds() > 3 * 3600)
    assert (out.ts > pd.Timestamp("2026-01-02")).any() and (~out.suppressed).sum() > 4


def test_running_stats_merge_days(two_days):
    stream, pdf = two_days
    out = drain(stream_running_stats(stream(), "u", "ts", "w")).toPandas()
    first = pdf[pdf.ts < pd.Timestamp("2026-01-02")].w
    assert out.n_seen.tolist() == [288]
    assert out["mean"].tolist() == pytest.approx([first.mean()])
    assert out["std"].tolist() == pytest.approx([first.std()])


def test_idle_source_closes_its_last_bins(two_days):
    stream, pdf = two_days
    out = drain_bins(stream(), ["u"], "ts", ["w"], ["w"]).toPandas().sort_values("ts").reset_index(drop=True)
    want = pdf.set_index("ts").w.resample("15min").agg(["mean", "max"])
    assert out.u.eq("a").all() and out.ts.tolist() == want.index.tolist()
    assert out.w.tolist() == pytest.approx(want["mean"].tolist())
    assert out.w_max5.tolist() == want["max"].tolist()


def test_late_readings_are_kept_apart(spark, tmp_path):
    """Three batches; the second holds readings from before the watermark that the first one set."""
    times = [["10:00", "10:20", "12:00"], ["11:10", "11:16", "11:31", "12:05", "10:01"], ["11:45", "13:00"]]
    for i, batch in enumerate(times):
        pdf = pd.DataFrame({"u": "a", "ts": pd.to_datetime([f"2026-01-01 {t}" for t in batch]), "w": 1.0})
        df = series_frame(spark, pdf)
        df.coalesce(1).write.parquet(f"{tmp_path}/{i}")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).option("recursiveFileLookup", True).parquet(str(tmp_path))
    late = drain_late(stream, "ts").toPandas().sort_values("ts")
    # 12:00 less 30 minutes: bins that end by 11:30 are over, the one of 11:31 is not. Nothing of the third batch is late.
    assert late.ts.dt.strftime("%H:%M").tolist() == ["10:01", "11:10", "11:16"]
    assert late.batch.nunique() == 1
