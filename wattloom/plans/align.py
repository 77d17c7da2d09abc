"""Raw meters and labels of all users to one aligned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.filters import time_filter, time_filter_by_key
from wattloom.operators.joins import on_bin
from wattloom.operators.resample import align, fill_and_drop, full_grid, spike_sources, tumbling_mean
from wattloom.operators.series import DAY, Series
from wattloom.sources.meters import with_target

SPIKE = "load_iden_data87"


def align_meters(
    bus: DataFrame,
    branch: DataFrame | None,
    keys: Sequence[str],
    target: str = "p1",
    columns: Sequence[str] | None = None,
    ranges: DataFrame | None = None,
    exclude_days: Sequence[str] = (),
    max_gap_steps: int = 2,
    minutes: int = 15,
    bus_ts: str = "event_time",
    branch_ts: str = "time",
) -> DataFrame:
    """Filter, bin, join labels, fill short gaps and drop the rest; keyed by (keys, ts).

    Filters run before binning. Without labels the full grid is kept, so a gap counts in steps of
    time; with labels it counts in joined rows.
    """
    columns = list(columns or [c for c in bus.columns if c.startswith("load_iden_data")])
    suffixes = ("_max5", "_min5", "_absmax5")
    spikes = spike_sources(columns, bus.columns, [SPIKE])
    means = [c for c in columns if not c.endswith(suffixes) and c in bus.columns]
    readings = time_filter(bus, bus_ts, days=exclude_days)
    if ranges is not None:
        readings = time_filter_by_key(readings, ranges, keys, bus_ts)
    bins = tumbling_mean(readings, keys, bus_ts, means, spikes, minutes)
    values = [c for c in bins.columns if c not in (*keys, "ts")]
    series = Series(tuple(keys), "ts", (), 30 * DAY)
    if branch is None:
        return fill_and_drop(full_grid(bins, keys, "ts", minutes), series, values, max_gap_steps)
    labels = with_target(time_filter(branch, branch_ts, days=exclude_days), target)
    joined = align(bins, labels, keys, "".join(target.split()).lower(), branch_ts)
    return fill_and_drop(joined, series, values, max_gap_steps)


def with_weather(df: DataFrame, weather: DataFrame, place: Sequence[str], ts: str = "ts") -> DataFrame:
    """Quarter-hour weather of each row's place: both sides share the grid, so an equi-join."""
    renamed = weather.select(
        *place,
        F.col("time"),
        F.col("temperature_2m").alias("temp_2m"),
        F.col("apparent_temperature").alias("apparent_temp"),
        F.col("relative_humidity_2m").alias("humidity"),
    )
    return on_bin(df, renamed, place, ts, "time", 15)
