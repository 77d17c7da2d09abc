import pandas as pd
import pytest
from helpers import series_frame
from pyspark.sql import functions as F

from wattloom.functions.scalars import normal_ratios, normal_target, parse_bool, parse_count, parse_number
from wattloom.functions.timeparse import floor_to, format_short, format_timestamp, parse_timestamp, require_parsed
from wattloom.operators.filters import null_gate, parse_ranges, sync_columns, time_filter, time_filter_by_key
from wattloom.sources.meters import choose_target, merge_history, read_branch, read_bus, with_target


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_composite_sum(spark):
    df = spark.createDataFrame([(24.0, 8.0), (16.0, 0.0), (16.0, 0.0), (16.0, 8.0)], "p1 double, p2 double")
    out = with_target(df, "P1 + p2")
    assert [r["p1+p2"] for r in out.collect()] == [32.0, 16.0, 16.0, 24.0]
    assert with_target(out, "p1+p2").columns == out.columns


def test_three_parts_and_nulls(spark):
    three = spark.createDataFrame([(10.0, 20.0, 30.0), (5.0, 15.0, 25.0)], "p1 double, p2 double, p3 double")
    assert [r[-1] for r in with_target(three, "p1+p2+p3").collect()] == [60.0, 45.0]
    gaps = spark.createDataFrame([("10", "20"), (None, "5"), ("15", None), ("x", "1")], "p1 string, p2 string")
    assert [r[-1] for r in with_target(gaps, "p1+p2").collect()] == [30.0, None, None, None]


def test_bad_targets(spark):
    df = spark.createDataFrame([(1.0,)], "p1 double")
    with pytest.raises(KeyError):
        with_target(df, "p1+p9")
    for name in ("p1+", "+p1", "p1++p2", "p1+q2", "p1+p1"):
        with pytest.raises(ValueError):
            with_target(df, name)


def test_target_names(spark):
    names = ["p1", "P1+P2", " p1 + p2 ", "p0+p5+p10", "p1+", "+p1", "p1++p2", "p1+q2", "p1+p1", None]
    assert column(spark, names, normal_target) == ["p1", "p1+p2", "p1+p2", "p0+p5+p10", None, None, None, None, None, None]


def test_target_choice(spark):
    rows = [
        ("a", "p2", 1, ["time", "p1", "p2"]),
        ("b", "p1+p9", 2, ["p1", "p2"]),
        ("c", None, 7, ["p4", "p5"]),
        ("d", None, 3, []),
        ("e", None, None, []),
    ]
    df = spark.createDataFrame(rows, "user_id string, config_target string, channel int, columns array<string>")
    out = {r.user_id: (r.target, r.target_source) for r in choose_target(df).collect()}
    assert out == {"a": ("p2", "config"), "b": ("p2", "channel"), "c": ("p4", "first_column"), "d": ("p3", "channel"), "e": ("p1", "default")}
    assert {r.target for r in choose_target(df, "P7").collect()} == {"p7"}


def test_eight_time_texts(spark):
    texts = ["2026/3/18 0:00:00", "2026/03/18 00:00:00", "2026-3-18 0:00:00", "2026-03-18 00:00:00", "2026-03-18T00:00:00", "2026/3/18", "2026-03-18", "invalid_garbage"]
    out = column(spark, texts, parse_timestamp)
    assert out[:7] == [pd.Timestamp("2026-03-18").to_pydatetime()] * 7
    assert out[7] is None


def test_unreadable_time_can_fail_the_job(spark):
    df = spark.createDataFrame([("2026-01-01",), ("nonsense",)], "t string").withColumn("at", parse_timestamp(F.col("t")))
    with pytest.raises(Exception, match="unreadable timestamp"):
        require_parsed(df, "t", "at").collect()


def test_time_output(spark):
    assert column(spark, ["2026-05-21 09:05:03"], lambda c: format_short(parse_timestamp(c))) == ["2026/5/21 9:05:03"]
    assert column(spark, ["2026-5-2 9:05"], lambda c: format_timestamp(parse_timestamp(c))) == ["2026/05/02 09:05:00"]
    assert column(spark, ["2026-05-21 09:59:59"], lambda c: floor_to(parse_timestamp(c), 15)) == [pd.Timestamp("2026-05-21 09:45").to_pydatetime()]


def test_config_words(spark):
    assert column(spark, ["True", " yes ", "off", "0", "2", "maybe", None], parse_bool) == [True, True, False, False, True, None, None]
    assert column(spark, ["10", "0", "5001", "x"], lambda c: parse_number(c, 0.001, 5000)) == [10.0, None, None, None]
    assert column(spark, ["3", "-1", "x"], parse_count) == [3, None, None]
    ratios = column(spark, [["7", "1.5", "1.5"], ["0.6", "0.2", "0.2"], ["1", "0", "1"], ["1", "1"]], normal_ratios, "array<string>")
    assert ratios[0] == pytest.approx([0.7, 0.15, 0.15])
    assert ratios[1] == pytest.approx([0.6, 0.2, 0.2])
    assert ratios[2:] == [None, None]


def five_days(spark):
    return series_frame(spark, pd.DataFrame({"u": "a", "ts": pd.date_range("2026-01-01", periods=480, freq="15min")}))


def test_time_filter_counts(spark):
    df = five_days(spark)
    assert time_filter(df, "ts", exclude=[("2026-01-03", "2026-01-03")]).count() == 480 - 96
    assert time_filter(df, "ts", exclude=[("2026-01-03 17:45", "2026-01-03")]).count() == 480 - 25
    assert time_filter(df, "ts", [("2026-01-02", "2026-01-04")], [("2026-01-03", "2026-01-03")]).count() == 192
    assert time_filter(df, "ts", days=["2026-01-05"]).count() == 384
    assert time_filter(df, "ts").count() == 480


def test_time_filter_by_key_keeps_rows_once(spark):
    df = five_days(spark)
    rows = [("a", "include", "2026-01-01", "2026-01-03"), ("a", "include", "2026-01-02", "2026-01-04"), ("a", "exclude", "2026-01-02 12:00", "2026-01-02")]
    ranges = parse_ranges(spark.createDataFrame(rows, "u string, kind string, start_text string, end_text string"))
    out = time_filter_by_key(df, ranges, ["u"], "ts")
    assert out.count() == 4 * 96 - 48
    assert out.distinct().count() == out.count()


def test_reversed_range_is_invalid(spark):
    df = parse_ranges(spark.createDataFrame([("2026-01-02", "2026-01-01"), ("x", "2026-01-01"), ("2026-01-01", "2026-01-01")], "start_text string, end_text string"))
    assert [r.valid for r in df.collect()] == [False, False, True]


def test_text_scans(spark):
    bus = spark.createDataFrame([("2026/1/1 0:00:00", "-2147483648", "5"), ("bad", "1", "2"), ("2026-01-01 00:05", "7", "")], "event_time string, load_iden_data0 string, load_iden_data1 string")
    out = read_bus(bus).orderBy("event_time").collect()
    assert [(r.load_iden_data0, r.load_iden_data1) for r in out] == [(None, 5.0), (7.0, None)]
    branch = spark.createDataFrame([("2026-01-01", "10", "20"), ("2026-01-02", "5", None)], "time string, p1 string, p2 string")
    assert [r["p1+p2"] for r in read_branch(branch, "p1+p2").orderBy("time").collect()] == [30.0, None]


def test_merge_keeps_first_file(spark):
    a = spark.createDataFrame([("u", 1, 10.0, 0), ("u", 2, 20.0, 0)], "k string, t int, w double, extra int")
    b = spark.createDataFrame([("u", 2, 99.0), ("u", 3, 30.0)], "k string, t int, w double")
    out = merge_history([a, b], ["k"], "t").orderBy("t")
    assert out.columns == ["k", "t", "w"]
    assert [r.w for r in out.collect()] == [10.0, 20.0, 30.0]


def test_null_gate_and_sync(spark):
    df = spark.createDataFrame([("u", 1, 1.0, None, None), ("u", 2, None, None, 2.0), ("u", 3, 1.0, 3.0, 2.0)], "k string, ts int, a double, b double, c double")
    r = null_gate(df, ["a", "b", "c"], "ts", ["k"]).collect()[0]
    assert (r.n_null_cols, r.n_null_rows, r.first_col, r.first_ts, r.passed) == (3, 2, "b", 1, False)
    out, missing, extra = sync_columns(df, ["b", "z"], ["k", "ts"])
    assert (out.columns, missing, extra) == (["k", "ts", "b", "z"], ["z"], ["a", "c"])
    assert {r.z for r in out.collect()} == {0.0}
