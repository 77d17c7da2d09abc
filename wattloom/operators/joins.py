"""Joins in time: as-of, range and event-window joins, and lookups with defaults."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.timeparse import floor_to, shift
from wattloom.operators.series import Series, attach, events_around, seconds_between, with_position
from wattloom.session import cut_lineage


def nearest(rows: DataFrame, readings: DataFrame, series: Series, columns: Sequence[str], reading_ts: str) -> DataFrame:
    """Nearest reading in time for each row; equal distances take the later reading."""
    around = events_around(rows, readings, series, columns, reading_ts)
    back = seconds_between(F.col("prev_event.at"), F.col(series.ts))
    ahead = seconds_between(F.col(series.ts), F.col("next_event.at"))
    chosen = F.when(back.isNull() | (ahead <= back), F.col("next_event")).otherwise(F.col("prev_event"))
    picked = around.withColumn("_picked", chosen)
    return picked.withColumns({c: F.col(f"_picked.{c}") for c in columns}).drop("_picked", "prev_event", "next_event")


def on_bin(rows: DataFrame, readings: DataFrame, keys: Sequence[str], ts: str, reading_ts: str, minutes: int = 15) -> DataFrame:
    """Reading of the bin a row falls into: an equi-join when both sides sit on the same grid."""
    grid = readings.withColumnRenamed(reading_ts, "_bin")
    return rows.withColumn("_bin", floor_to(F.col(ts), minutes)).join(grid, [*keys, "_bin"], "left").drop("_bin")


def daily_as_of(
    rows: DataFrame, dated: DataFrame, daily: DataFrame, place: Sequence[str], ts: str, columns: Sequence[str]
) -> DataFrame:
    """Latest daily value at or before each row's day; NULL before the first day.

    The forward fill runs on the distinct days of a place (taken from `dated`, a narrow table with
    the same places and times), never on rows.
    """
    days = dated.select(*place, F.to_date(ts).alias("date")).distinct()
    both = days.join(daily, [*place, "date"], "full")
    w = Window.partitionBy(*place).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    filled = both.select(*place, "date", *[F.last(c, True).over(w).alias(c) for c in columns])
    return rows.withColumn("date", F.to_date(ts)).join(filled, [*place, "date"], "left").drop("date")


def bins_per_key(lut: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lookup table rows (lo, hi, expected per bin) to one array per key, ordered by bin."""
    entry = F.struct("bin_id", "temp_lo", "temp_hi", "expected_signal")
    return lut.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.when(F.col("bin_id") >= 0, entry))).alias("_bins"),
        F.max(F.when(F.col("bin_id") < 0, F.col("expected_signal"))).alias("_global"),
    )


def hit_bins(temp: Column, bins: Column) -> Column:
    """All bins that hold a temperature; both ends are closed, so an edge hits two."""
    return F.filter(bins, lambda b: (temp >= b["temp_lo"]) & (temp <= b["temp_hi"]))


def lookup_bins(rows: DataFrame, lut: DataFrame, keys: Sequence[str], temp: str, out: str) -> DataFrame:
    """Expected signal of the last bin that holds the temperature, else the key's global median."""
    joined = attach(rows, bins_per_key(lut, keys), keys)
    hits = hit_bins(F.col(temp), F.col("_bins"))
    last = F.try_element_at(hits, F.lit(-1))["expected_signal"]
    return joined.withColumn(out, F.coalesce(last, F.col("_global"))).drop("_bins", "_global")


def startup_as_of(steps: DataFrame, startups: DataFrame, series: Series, lookahead_s: int = 900) -> DataFrame:
    """Latest startup at or before ts + lookahead, and hours since it (`since_h`)."""
    moved = series.renamed(ts="_until", tie=(series.ts, *series.tie))
    late = steps.withColumn("_until", shift(F.col(series.ts), F.lit(lookahead_s * 1_000_000)))
    around = events_around(late, startups, moved, (), "startup_ts")
    last = F.col("prev_event.at")
    return (
        around.withColumn("last_startup", last)
        .withColumn("since_h", seconds_between(last, F.col(series.ts)) / 3600.0)
        .drop("_until", "prev_event", "next_event")
    )


def event_windows(
    events: DataFrame,
    readings: DataFrame,
    keys: Sequence[str],
    event_ts: str,
    reading_ts: str,
    value: str,
    before_s: int,
    after_s: int,
) -> DataFrame:
    """Minimum and largest magnitude of `value` in [event − before, event + after] per distinct event.

    No reading meets an event. The edges of all windows of a key cut time into intervals; readings find their interval
    by an as-of join and are aggregated per interval. A tree over the intervals, each level with half the nodes of the
    one below, then answers a window from at most two nodes a level, however many readings or windows overlap.
    Events without a reading in their window, and rows without a key, a time or a value, are left out.
    """
    keys = list(keys)
    spans = events.select(*keys, event_ts).distinct().withColumns(
        {"_low": shift(F.col(event_ts), F.lit(-before_s * 1_000_000)), "_end": shift(F.col(event_ts), F.lit(after_s * 1_000_000 + 1))}
    )
    edges = spans.select(*keys, F.explode(F.array("_low", "_end")).alias("_edge")).distinct()
    numbered = cut_lineage(with_position(edges, Series(tuple(keys), "_edge"), "_no"))
    for edge, no in (("_low", "_from"), ("_end", "_to")):
        spans = spans.join(numbered.withColumnsRenamed({"_edge": edge, "_no": no}), [*keys, edge])
    spans = cut_lineage(spans.select(*keys, event_ts, "_from", "_to"))
    widest = spans.agg(F.max(F.col("_to") - F.col("_from"))).first()[0] or 0
    levels = list(range(max(1, widest.bit_length())))

    held = readings.where(F.col(value).isNotNull()).select(*keys, F.col(reading_ts).alias("_at"), F.col(value).alias("_v"))
    placed = events_around(held, numbered, Series(tuple(keys), "_at"), ("_no",), "_edge").select(*keys, F.col("prev_event._no").alias("_no"), "_v")
    leaves = placed.where("_no IS NOT NULL").groupBy(*keys, "_no").agg(
        F.min("_v").alias("_min"), F.max(F.abs("_v")).alias("_max"), F.count(F.lit(1)).alias("_n")
    )
    combined = [F.min("_min").alias("_min"), F.max("_max").alias("_max"), F.sum("_n").alias("_n")]
    raised = F.array(*(F.struct(F.lit(k).alias("_level"), F.shiftright("_no", k).alias("_node")) for k in levels))
    nodes = leaves.select(*keys, F.inline(raised), "_min", "_max", "_n").groupBy(*keys, "_level", "_node").agg(*combined)
    cover = F.array_compact(F.array(*(n for k in levels for n in cover_at(F.col("_from"), F.col("_to"), k))))
    asked = spans.select(*keys, event_ts, F.inline(cover))
    met = asked.join(nodes, [*keys, "_level", "_node"]).groupBy(*keys, event_ts).agg(*combined)
    return met.withColumnsRenamed({"_min": "win_min", "_max": "win_absmax", "_n": "win_n"})


def cover_at(start: Column, end: Column, level: int) -> list[Column]:
    """Tree nodes of one level in the smallest cover of the intervals [start, end): none, one or two."""
    left, right = F.shiftright(start + F.lit((1 << level) - 1), level), F.shiftright(end, level)
    return [
        F.when((left < right) & (left % 2 == 1), F.struct(F.lit(level).alias("_level"), left.alias("_node"))),
        F.when((left < right) & (right % 2 == 1), F.struct(F.lit(level).alias("_level"), (right - 1).alias("_node"))),
    ]


def overlay(users: DataFrame, config: DataFrame, fields: Sequence[str], defaults: dict, key: str = "user_id") -> DataFrame:
    """Field by field: the user's own value, else the `_default` row's, else the global default."""
    own = config.where(F.col(key) != "_default").select(key, *fields)
    shared = config.where(F.col(key) == "_default")
    joined = users.join(own, key, "left")
    values = [F.coalesce(F.col(f), shared.agg(F.max(f)).scalar(), F.lit(defaults.get(f))).alias(f) for f in fields]
    return joined.select(key, *values)
