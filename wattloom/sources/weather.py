"""Weather tables: climatology, coverage check with fallback, and upsert."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.scalars import month_mean_temp
from wattloom.operators.resample import hourly_to_quarter
from wattloom.sources.meters import first_per_key
from wattloom.sources.versions import read_version, upsert_version

COLUMNS = ("temperature_2m", "apparent_temperature", "relative_humidity_2m")
MIN_COVERAGE = 0.5


def climatology(spans: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """Hourly long-term weather from the first to the last day of each span (both at 00:00)."""
    first, last = F.to_date(start).cast("timestamp_ntz"), F.to_date(end).cast("timestamp_ntz")
    hours = spans.select(*keys, F.explode(F.sequence(first, last, F.expr("INTERVAL 1 HOUR"))).alias("time"))
    wave = F.sin((F.hour("time") - 8) * F.lit(2 * math.pi / 24))
    temp = month_mean_temp(F.month("time")) + 5 * wave
    return hours.select(
        *keys,
        "time",
        F.round(temp, 2).alias("temperature_2m"),
        F.round(temp + 1.5, 2).alias("apparent_temperature"),
        F.lit(70.0).alias("relative_humidity_2m"),
    )


def padded_span(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Period of each key, one day wider on both sides."""
    return df.groupBy(*keys).agg(
        F.date_sub(F.to_date(F.min(ts)), 1).alias("start"), F.date_add(F.to_date(F.max(ts)), 1).alias("end")
    )


def coverage(weather: DataFrame, spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hours present in the span against hours expected."""
    held = spans.join(weather.select(*keys, "time"), list(keys), "left").where(
        F.col("time").isNull() | F.to_date("time").between(F.col("start"), F.col("end"))
    )
    present = held.groupBy(*keys).agg(F.countDistinct("time").alias("n_hours"))
    expected = (F.datediff("end", "start") + 1) * 24
    return spans.join(present, list(keys), "left").select(
        *keys, "start", "end", F.coalesce("n_hours", F.lit(0)).alias("n_hours"), expected.alias("expected"),
        (F.coalesce("n_hours", F.lit(0)) >= expected * MIN_COVERAGE).alias("accepted"),
    )


def weather_for_period(stored: DataFrame, spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored hours where enough of the period is covered, the climatology elsewhere."""
    checked = coverage(stored, spans, keys)
    good = checked.where("accepted").select(*keys, "start", "end")
    used = stored.join(good, list(keys)).where(F.to_date("time").between(F.col("start"), F.col("end")))
    used = first_per_key(used.select(*keys, "time", *COLUMNS), [*keys, "time"], list(COLUMNS))
    return used.unionByName(climatology(checked.where("NOT accepted"), keys))


def quarter_hourly(weather: DataFrame, keys: Sequence[str]) -> DataFrame:
    return hourly_to_quarter(weather, keys, COLUMNS)


def merge_weather(stored: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New hours are added, stored ones keep their values."""
    both = stored.withColumn("_age", F.lit(0)).unionByName(new.withColumn("_age", F.lit(1)))
    return first_per_key(both, [*keys, "time"], ["_age"]).drop("_age")


def save_weather(new: DataFrame, path: str, keys: Sequence[str] = ("place",)) -> int:
    """Add new hours to the stored table, whose hours keep their values, as its next version; partitioned by the keys and year.

    Replaced as a whole behind a pointer: a reader sees the old hours or all of the new ones.
    """
    dated = new.withColumn("year", F.year("time"))
    return upsert_version(dated, path, [*keys, "time"], [], keep="old", partition_by=[*keys, "year"])


def stored_weather(spark: SparkSession, path: str) -> DataFrame | None:
    held = read_version(spark, path)
    return None if held is None else held.drop("year")
