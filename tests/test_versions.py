"""Tables behind a pointer, and state files with damaged lines."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wattloom.sources import state, versions

TABLE = "k string, t int, v double"


def rows_of(spark, base):
    return sorted(map(tuple, versions.read_version(spark, base).select("k", "t", "v").collect()), key=str)


def test_two_rounds(spark, tmp_path):
    base = str(tmp_path / "t")
    assert versions.read_version(spark, base) is None
    first = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0), (None, 1, 3.0), ("b", 1, 4.0)], TABLE)
    assert versions.upsert_version(first, base, ["k"], ["t"]) == 1
    assert rows_of(spark, base) == [("a", 2, 2.0), ("b", 1, 4.0), (None, 1, 3.0)]
    assert versions.upsert_version(spark.createDataFrame([("a", 0, 9.0), (None, 5, None)], TABLE), base, ["k"], ["t"]) == 2
    assert rows_of(spark, base) == [("a", 0, 9.0), ("b", 1, 4.0), (None, 5, None)]
    assert versions.upsert_version(spark.createDataFrame([("a", 7, 7.0), ("c", 2, 1.0), ("c", 1, 0.0)], TABLE), base, ["k"], ["t"], keep="old") == 3
    assert rows_of(spark, base) == [("a", 0, 9.0), ("b", 1, 4.0), ("c", 1, 0.0), (None, 5, None)]


def test_more_columns_and_keys(spark, tmp_path):
    base = str(tmp_path / "t")
    versions.upsert_version(spark.createDataFrame([("a", 1, 1.0)], TABLE), base, ["k", "t"], [])
    versions.upsert_version(spark.createDataFrame([("a", 2, 2.0, "n")], TABLE + ", note string"), base, ["k", "t"], [])
    assert sorted((r.t, r.note) for r in versions.read_version(spark, base).collect()) == [(1, None), (2, "n")]


def test_failure_while_writing(spark, tmp_path):
    """A job that dies half-way leaves no version."""
    base = str(tmp_path / "t")
    versions.write_version(spark.createDataFrame([("a", 1, 1.0)], TABLE), base)
    bad = spark.range(0, 8, 1, 8).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("t"), F.when(F.col("id") == 6, F.raise_error(F.lit("lost"))).otherwise(F.lit(1.0)).cast("double").alias("v"))
    with pytest.raises(PySparkException):
        versions.upsert_version(bad, base, ["k"], ["t"])
    assert rows_of(spark, base) == [("a", 1, 1.0)]
    assert versions.upsert_version(spark.createDataFrame([("b", 1, 1.0)], TABLE), base, ["k"], ["t"]) == 2


def test_failure_between_write_and_swap(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    versions.write_version(spark.createDataFrame([("a", 1, 1.0)], TABLE), base)

    def lost(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "point_to", lost)
        with pytest.raises(OSError):
            versions.upsert_version(spark.createDataFrame([("a", 2, 2.0)], TABLE), base, ["k"], ["t"])
    assert rows_of(spark, base) == [("a", 1, 1.0)]
    assert versions.upsert_version(spark.createDataFrame([("b", 1, 1.0)], TABLE), base, ["k"], ["t"]) == 2
    assert rows_of(spark, base) == [("a", 1, 1.0), ("b", 1, 1.0)]


def test_damaged_lines_beside_good_ones(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("status,user_id,duration_s,_raw,finished_at\nok,u1,1.5,x,2026-01-01T01:02:03\nok,u2,abc,x,2026-01-01T01:02:03\nfail,,2.0,y,\nok,u3\nok,u4,1,x,2026-01-01 05:00:00,more\nok,u5,,,\nok,u6,3,z,notatime\n")
    seen = {r.user_id: r for r in state.inspect_state(spark, str(path)).collect()}
    assert {u: r.damaged for u, r in seen.items()} == {"u1": False, "u2": True, None: True, "u3": True, "u4": True, "u5": False, "u6": True}
    assert (seen["u2"].duration_s, seen["u2"].raw) == (None, "ok,u2,abc,x,2026-01-01T01:02:03")
    assert (seen["u4"].duration_s, seen["u1"].raw, seen["u1"].run_id) == (1.0, None, None)
    loaded = state.load_state(spark, str(path))
    assert loaded.columns == state.SCHEMA.names and sorted(r.user_id for r in loaded.collect()) == ["u1", "u2", "u3", "u4", "u5", "u6"]


def test_stored_state(spark, tmp_path):
    base = str(tmp_path / "state")
    assert state.stored_state(spark, base).count() == 0
    rows = spark.createDataFrame([("u", "fail", False, None, None, 1.0, "m", "p1", "r1")], state.SCHEMA)
    state.store_state(rows, base)
    state.store_state(rows.withColumn("status", F.lit("ok")), base)
    assert [r.status for r in state.stored_state(spark, base).collect()] == ["ok"]
