from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from helpers import series_frame
from pyspark.sql import functions as F

from wattloom.operators.filters import parse_ranges
from wattloom.operators.series import Series
from wattloom.operators.splits import check_ratios, day_quota, make_split, per_split_filter, quality_gates
from wattloom.sources import config, discovery, state

S = Series(("u",), "ts", ())


def twelve_days(spark):
    pdf = pd.DataFrame({"u": "a", "ts": pd.date_range("2026-06-01", periods=12 * 96, freq="15min")})
    day = pdf.ts.dt.day
    pdf["split"] = np.where(day <= 6, "train", np.where(day <= 9, "val", "test"))
    return series_frame(spark, pdf)


def run(spark, rows):
    ranges = parse_ranges(spark.createDataFrame([("a", *r) for r in rows], "u string, split string, kind string, start_text string, end_text string"))
    out = per_split_filter(twelve_days(spark), ranges, S).withColumn("day", F.dayofmonth("ts"))
    sizes = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    return out, sizes


def test_pinned_day_keeps_sizes(spark):
    out, sizes = run(spark, [("train", "include", "2026-06-10", "2026-06-10")])
    assert sizes == {"train": 576, "val": 288, "test": 288}
    assert {r["split"] for r in out.where("day = 10").select("split").distinct().collect()} == {"train"}
    # The earliest unpinned train rows make room.
    assert {r["split"] for r in out.where("day = 1").select("split").distinct().collect()} == {"test"}


def test_expelled_day_swaps_places(spark):
    out, sizes = run(spark, [("val", "exclude", "2026-06-08", "2026-06-08")])
    assert sizes == {"train": 576, "val": 288, "test": 288}
    assert {r["split"] for r in out.where("day = 8").select("split").distinct().collect()} == {"train"}
    assert {r["split"] for r in out.where("day = 1").select("split").distinct().collect()} == {"val"}


def test_day_excluded_everywhere_is_dropped(spark):
    out, sizes = run(spark, [(s, "exclude", "2026-06-05", "2026-06-05") for s in ("train", "val", "test")])
    assert out.where("day = 5").count() == 0
    assert sizes == {"train": 480, "val": 288, "test": 288}


def test_pins_prefer_train(spark):
    out, _ = run(spark, [("train", "include", "2026-06-10", "2026-06-10"), ("test", "include", "2026-06-10", "2026-06-11")])
    assert {(r["day"], r["split"]) for r in out.where("day IN (10, 11)").select("day", "split").distinct().collect()} == {(10, "train"), (11, "test")}


@pytest.mark.parametrize("ratios", [(0.6, 0.2, 0.2), (0.7, 0.15, 0.15), (0.98, 0.01, 0.01), (0.05, 0.9, 0.05)])
def test_day_quotas(spark, ratios):
    """Every split has a day from three days on; train is the half-even rounding where no split had to be given one."""
    for r in day_quota(spark.range(3, 40).withColumnRenamed("id", "n"), "n", check_ratios(ratios)).collect():
        test = r.n - r._train - r._val
        assert min(r._train, r._val, test) >= 1, r
        if min(r._val, test) > 1 and r._train > 1:
            assert r._train == round(r.n * ratios[0]), r


def test_day_quotas_by_hand(spark):
    got = day_quota(spark.createDataFrame([(3,), (10,), (20,)], "n long"), "n", check_ratios((0.7, 0.15, 0.15)))
    assert {r.n: (r._train, r._val, r.n - r._train - r._val) for r in got.collect()} == {3: (1, 1, 1), 10: (7, 2, 1), 20: (14, 3, 3)}


@pytest.mark.parametrize("strategy", ["stratified_day", "global_stratified", "time", "stratified"])
def test_split_invariants(spark, strategy):
    pdf = pd.DataFrame({"u": "a", "ts": pd.date_range("2025-07-01", "2025-10-31 23:45", freq="15min")})
    pdf = pdf[~((pdf.ts.dt.day == 3) & (pdf.ts.dt.hour > 12))]
    out = make_split(series_frame(spark, pdf), S, strategy, (0.7, 0.15, 0.15)).toPandas()
    assert len(out) == len(pdf)
    shares = out.split.value_counts(normalize=True)
    assert shares["train"] == pytest.approx(0.7, abs=0.03)
    if "day" in strategy or "global" in strategy:
        assert (out.groupby(out.ts.dt.date).split.nunique() == 1).all()
        assert set(out[out.ts.dt.day == 3].split) == {"train"}


def test_ratios():
    assert check_ratios((7, 1.5, 1.5)) == pytest.approx((0.7, 0.15, 0.15))
    with pytest.raises(ValueError):
        check_ratios((0.7, -0.1, 0.4))


def test_gates(spark):
    rows = [("few", 1, "train")] * 5 + [("off", 0, "train")] * 100 + [("on", 1, "val")] * 100 + [("nosplit", i % 2, "train") for i in range(100)]
    rows += [("good", i % 2, ("train", "val", "test")[i % 3]) for i in range(120)]
    df = spark.createDataFrame(rows, "u string, state int, split string")
    out = {r.u: (r.skip_reason, r.detail) for r in quality_gates(df, ["u"], "state", "split").collect()}
    assert out == {
        "few": ("aligned_too_few", None), "off": ("single_class_label", "all_off"), "on": ("single_class_label", "all_on"),
        "nosplit": ("split_empty_val_test", None), "good": (None, None),
    }


def state_rows(spark, rows):
    full = [(u, s, s == "ok", datetime(2026, 1, 1, 0, i), datetime(2026, 1, 1, 1, i), float(i), "m", "p1", f"r{i}") for i, (u, s) in enumerate(rows)]
    return spark.createDataFrame(full, state.SCHEMA)


def test_state_upsert_and_resume(spark):
    first = state.upsert(state.empty_state(spark), state_rows(spark, [("a", "ok"), ("b", "fail"), ("c", "soft_skip"), ("a", "fail")]))
    assert {r.user_id: r.status for r in first.collect()} == {"a": "fail", "b": "fail", "c": "soft_skip"}
    second = state.upsert(first, state_rows(spark, [("b", "ok")]))
    assert {r.user_id: r.status for r in second.collect()} == {"a": "fail", "b": "ok", "c": "soft_skip"}
    users = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "user_id string")
    assert {r.user_id for r in state.resume_set(users, second).collect()} == {"a", "d"}
    assert {r.user_id for r in state.resume_set(users, second, with_failed=True).collect()} == {"d"}


def test_state_file_repair(spark, tmp_path):
    assert state.load_state(spark, str(tmp_path / "none")).count() == 0
    old = tmp_path / "old.csv"
    old.write_text("user_id,status\nu1,ok\n,ok\n")
    loaded = state.load_state(spark, str(old))
    assert loaded.columns == state.SCHEMA.names
    assert [(r.user_id, r.status, r.run_id) for r in loaded.collect()] == [("u1", "ok", None)]
    saved = state.save_state(state.upsert(loaded, state_rows(spark, [("u2", "ok")])), str(tmp_path / "gen2"))
    assert {r.user_id for r in state.load_state(spark, saved).collect()} == {"u1", "u2"}
    other = tmp_path / "other.csv"
    other.write_text("x,y\n1,2\n")
    assert state.load_state(spark, str(other)).count() == 0


CONFIG = """{
 "_comment": "text", "plain": 3,
 "_default": {"on_thr_w": 25, "target_col": "P2", "split_ratios": [8, 1, 1]},
 "800_1": {"on_thr_w": 9000, "target_col": "p1 + p2", "guard_enabled": "no", "v14": {"physics_features": true, "diag": 1},
   "train": {"include": [["2026-06-01", "2026-06-10"]], "exclude": [["2026-06-03 08:00", "2026-06-03 12:00"]]},
   "splits": {"train": {"include": [["2026-06-01", "2026-06-10"]]}, "test": {"exclude": [["2026-06-15", "2026-06-15"]]}}}
}"""


def test_config(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text(CONFIG)
    entries = config.config_entries(config.read_config_text(spark, str(path)))
    assert {r.user_id for r in entries.collect()} == {"_default", "800_1"}
    typed = {r.user_id: r for r in config.typed_config(entries).collect()}
    assert typed["800_1"].on_thr_w is None and typed["800_1"].target_col == "p1+p2" and typed["800_1"].guard_enabled is False
    assert typed["_default"].split_ratios == pytest.approx([0.8, 0.1, 0.1])
    flags = config.feature_flags(entries).collect()[0]
    assert (flags.physics, flags.diag, flags.focal) == (True, True, False)
    spans = config.split_ranges(entries).orderBy("split").collect()
    assert [(r.split, r.kind, r.end) for r in spans] == [("test", "exclude", datetime(2026, 6, 15, 23, 59, 59)), ("train", "include", datetime(2026, 6, 10, 23, 59, 59))]
    stage = config.stage_ranges(entries)
    back = config.ranges_from_json(config.ranges_to_json(stage, ["user_id"]), ["user_id"])
    assert {(r.kind, r.start, r.end) for r in back.collect()} == {(r.kind, r.start, r.end) for r in stage.collect()}


def test_default_ranges_for_other_users(spark):
    entries = spark.createDataFrame([("_default", "{}"), ("a", "{}")], "user_id string, body string")
    ranges = spark.createDataFrame([("_default", "exclude", 1), ("a", "include", 2)], "user_id string, kind string, start int")
    users = spark.createDataFrame([("a",), ("b",)], "user_id string")
    assert {(r.user_id, r.start) for r in config.ranges_for_users(users, ranges, entries).collect()} == {("a", 2), ("b", 1)}


def test_discovery(spark, tmp_path):
    names = ["trains/800_4/e241_800_4-Ch2-250101-250201.csv", "trains/800_4/4-250101-250201.csv", "trains/800_4/4-250301-250401.csv", "infers/801_5/e241_801_5-Ch1-250101-250201-infer.csv", "trains/800_4/notes.txt"]
    for n in names:
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_text("x\n")
    users = discovery.discover_users(discovery.parse_files(discovery.list_files(spark, str(tmp_path))))
    out = {r.user_id: r for r in discovery.execution_plan(users.withColumn("target", F.lit("p1"))).collect()}
    assert out["800_4"].train_branch == "4-250101-250201.csv" and out["800_4"].channel == 2 and out["800_4"].plan == "train only"
    assert out["801_5"].runnable is False and out["801_5"].infer_bus.endswith("-infer.csv")
