"""Ordered time series at scale: positions, blocks with halo rows, and values carried across chunks.

A series is all rows of one key in time order. One key may hold a large share of a table, so no
operator here sorts or collects a whole series in one task:

* `Series.chunk_s` cuts a series into time chunks; everything row-level is grouped by (key, chunk);
* cross-chunk facts travel through a summary of one row per (key, chunk), which is tiny;
* bounded ROWS frames run on fixed-size position blocks that carry `before`/`after` halo rows.

`chunk_s=None` keeps one window per key (a single shuffle). `plan_series` picks that form only after
it has counted the largest key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wattloom.session import cut_lineage

DAY = 86_400
BLOCK_ROWS = 4_096
# A table with a row per key goes to all tasks up to this size; above it, keys with a larger share of rows are apart.
MOST_BYTES, HEAVY = 16_000_000, 0.005


@dataclass(frozen=True)
class Series:
    """How rows form series: key columns, time column, unique tie-break columns, chunk length."""

    key: tuple[str, ...]
    ts: str
    tie: tuple[str, ...] = ()
    chunk_s: int | None = DAY

    @property
    def order(self) -> list[str]:
        return [self.ts, *self.tie]

    @property
    def chunk_key(self) -> list[str]:
        return [*self.key, "_chunk"]

    def with_chunk(self, df: DataFrame) -> DataFrame:
        """Rows without key or time belong to no series. The explicit test keeps both sides of a
        summary join on the same filters, so their exchange is shared."""
        for c in (*self.key, self.ts):
            df = df.where(F.col(c).isNotNull())
        chunk = F.lit(0).cast("long") if self.chunk_s is None else chunk_of(F.col(self.ts), self.chunk_s)
        return df.withColumn("_chunk", chunk).where(F.col("_chunk").isNotNull())

    def chunk_window(self) -> WindowSpec:
        return Window.partitionBy(*self.chunk_key).orderBy(*self.order)

    def across_chunks(self) -> WindowSpec:
        return Window.partitionBy(*self.key).orderBy("_chunk")

    def renamed(self, **changes) -> Series:
        return replace(self, **changes)


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a naive timestamp (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def seconds(ts: Column) -> Column:
    return micros(ts) / F.lit(1_000_000.0)


def seconds_between(earlier: Column, later: Column) -> Column:
    return (micros(later) - micros(earlier)) / F.lit(1_000_000.0)


def chunk_of(ts: Column, chunk_s: int) -> Column:
    return F.floor(micros(ts) / F.lit(chunk_s * 1_000_000)).cast("long")


def plan_series(df: DataFrame, series: Series, chunk_rows: int = 1_000_000) -> Series:
    """Measure the densest hour of any key and choose the chunk length from it.

    One narrow scan with a map-side combined count. If the largest key fits in one chunk the series
    stays whole; otherwise chunks are cut so that none is expected to exceed `chunk_rows`.
    """
    hourly = (
        df.groupBy(*series.key, chunk_of(F.col(series.ts), 3_600).alias("_hour"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_key = hourly.groupBy(*series.key).agg(F.sum("n").alias("rows"), F.max("n").alias("peak"))
    worst = per_key.agg(F.max("rows").alias("rows"), F.max("peak").alias("peak")).first()
    if worst is None or worst["rows"] is None or worst["rows"] <= chunk_rows:
        return series.renamed(chunk_s=None)
    length = int(3_600 * chunk_rows / worst["peak"])
    return series.renamed(chunk_s=max(1, min(length, 30 * DAY)))


def bytes_of(df: DataFrame) -> Column:
    """About how many bytes a row takes: fixed-width values by 16, texts by their length, arrays by 48 an element."""
    parts: list[Column] = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        parts.append(F.octet_length(f.name) + 16 if kind in ("string", "binary") else F.size(f.name) * 48 + 16 if kind in ("array", "map") else F.lit(16))
    return sum((F.coalesce(p, F.lit(16)) for p in parts), F.lit(0)).cast("long")


def heavy_keys(df: DataFrame, keys: Sequence[str], share: float, tracked: int = 4_096) -> DataFrame:
    """Keys that hold more than `share` of the rows, with their counts `_n`.

    A mergeable sketch of frequent items names the candidates, each of which is then counted exactly: the sketch
    never misses a key above one in `tracked` * 3 / 4 of the rows. At most 1 / share keys are left.
    """
    of_key = F.xxhash64(*keys)
    whole = df.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))
    top = min(tracked // 4, int(2 / share) + 1)
    seen = whole.select(of_key.alias("_h")).agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(_h, {top}, {tracked})").alias("top")).first()
    names = [r["item"] for r in seen["top"] or [] if r["count"] > share * seen["rows"]]
    candidates = whole.where(of_key.isin(names)) if names else whole.limit(0)
    return candidates.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > share * seen["rows"])


def attach(df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left", most: int = MOST_BYTES, share: float = HEAVY) -> DataFrame:
    """Join a table with one row per key to a table where one key may dominate.

    The small side is written and measured. Up to `most` bytes it goes to every task and the large side does not
    move. Beyond that, keys with more than `share` of the large side's rows, of which there are few, get their rows
    that way, and all other keys meet by a plain shuffle. Rows without a key match nothing and do not move either.
    """
    if df.isStreaming:
        return df.join(per_key, list(keys), how)
    held = cut_lineage(per_key)
    size = held.agg(F.sum(bytes_of(held))).first()[0] or 0
    if size <= most:
        return df.join(F.broadcast(held), list(keys), how)
    heavy = cut_lineage(heavy_keys(df, keys, share).select(*keys, F.lit(True).alias("_heavy")))
    marked = df.join(F.broadcast(heavy), list(keys), "left")
    stays = F.coalesce("_heavy", reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys)))
    near = marked.where(stays).drop("_heavy").join(F.broadcast(held.join(F.broadcast(heavy), list(keys), "left_semi")), list(keys), how)
    far = marked.where(~stays).drop("_heavy").join(held.hint("shuffle_hash"), list(keys), how)
    return near.unionByName(far)


def with_position(df: DataFrame, series: Series, out: str = "pos", total: str | None = None) -> DataFrame:
    """Zero-based row position inside each series, optionally with the series length.

    Rows without key or time belong to no series and leave, whole or cut into chunks alike.
    """
    if series.chunk_s is None:
        df = series.with_chunk(df).drop("_chunk")
        whole = Window.partitionBy(*series.key)
        df = df.withColumn(out, F.row_number().over(whole.orderBy(*series.order)).cast("long") - 1)
        return df.withColumn(total, F.count(F.lit(1)).over(whole)) if total else df
    chunked = series.with_chunk(df)
    counts = chunked.groupBy(*series.chunk_key).agg(F.count(F.lit(1)).alias("_n"))
    before = series.across_chunks().rowsBetween(Window.unboundedPreceding, -1)
    offsets = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")]
    if total:
        offsets.append(F.sum("_n").over(Window.partitionBy(*series.key)).alias(total))
    starts = counts.select(*series.chunk_key, *offsets)
    numbered = chunked.withColumn("_rn", F.row_number().over(series.chunk_window()))
    joined = numbered.join(starts, series.chunk_key)
    return joined.withColumn(out, F.col("_off") + F.col("_rn") - 1).drop("_off", "_rn", "_chunk")


def with_halo(
    df: DataFrame, series: Series, before: int, after: int = 0, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, WindowSpec]:
    """Cut numbered series (`pos`) into blocks and add the halo rows bounded frames need.

    Returns the frame (with `_core`, false on halo copies) and the window to run frames over. Each
    row is copied at most into the two neighbouring blocks, whatever the key sizes are.
    """
    window = Window.partitionBy(*series.key, "_blk").orderBy("pos")
    if series.chunk_s is None:
        return df.withColumn("_blk", F.lit(0).cast("long")).withColumn("_core", F.lit(True)), window
    size = max(block_rows, before, after)
    block = F.floor(F.col("pos") / F.lit(size)).cast("long")
    offset = F.col("pos") - block * F.lit(size)
    homes = [F.struct(block.alias("b"), F.lit(True).alias("core"))]
    if before:
        homes.append(F.when(offset >= size - before, F.struct((block + 1).alias("b"), F.lit(False).alias("core"))))
    if after:
        homes.append(
            F.when((offset < after) & (block > 0), F.struct((block - 1).alias("b"), F.lit(False).alias("core")))
        )
    spread = df.withColumn("_home", F.explode(F.filter(F.array(*homes), lambda h: h.isNotNull())))
    spread = spread.withColumn("_blk", F.col("_home.b")).withColumn("_core", F.col("_home.core")).drop("_home")
    return spread, window


def over_rows(
    df: DataFrame,
    series: Series,
    columns,
    before: int,
    after: int = 0,
    block_rows: int = BLOCK_ROWS,
    numbered: bool = False,
) -> DataFrame:
    """Add columns that look at most `before` rows back and `after` rows ahead.

    `columns` is a list of steps; each step maps a window to {name: Column}. All steps share one
    exchange and one sort. `pos` must exist already when `numbered` is set, and is dropped otherwise.
    """
    placed = df if numbered else with_position(df, series)
    placed, window = with_halo(placed, series, before, after, block_rows)
    for step in columns if isinstance(columns, (list, tuple)) else [columns]:
        placed = placed.withColumns(step(window))
    placed = placed.where("_core").drop("_blk", "_core")
    return placed if numbered else placed.drop("pos")


def events_around(
    rows: DataFrame,
    events: DataFrame,
    series: Series,
    payload: Sequence[str] = (),
    event_ts: str | None = None,
) -> DataFrame:
    """Attach to each row the latest event at or before it and the first event strictly after it.

    A tagged union is sorted inside (key, chunk); events of other chunks arrive through the chunk
    summary. Adds structs `prev_event` and `next_event` with fields `at` and the payload columns.
    """
    event_ts = event_ts or series.ts
    event = F.struct(F.col(event_ts).alias("at"), *[F.col(c) for c in payload])
    left = rows.withColumn("_tag", F.lit(1))
    right = events.where(F.col(event_ts).isNotNull()).select(
        *series.key, F.col(event_ts).alias(series.ts), event.alias("_event"), F.lit(0).alias("_tag")
    )
    tagged = series.with_chunk(left.unionByName(right, allowMissingColumns=True))
    order = [series.ts, "_tag", *series.tie]
    inside = Window.partitionBy(*series.chunk_key).orderBy(*order)
    first_key = F.struct("_event.at")
    summary = tagged.groupBy(*series.chunk_key).agg(
        F.max_by("_event", F.when(F.col("_event").isNotNull(), first_key)).alias("_last"),
        F.min_by("_event", F.when(F.col("_event").isNotNull(), first_key)).alias("_first"),
    )
    # Looking ahead means looking back in reversed order: a running frame costs one step per row,
    # a frame that is open towards the end would be evaluated anew for every row.
    backward = Window.partitionBy(*series.key).orderBy(F.desc("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *series.chunk_key,
        F.last("_last", True).over(series.across_chunks().rowsBetween(Window.unboundedPreceding, -1)).alias("_carry_prev"),
        F.last("_first", True).over(backward).alias("_carry_next"),
    )
    reverse = Window.partitionBy(*series.chunk_key).orderBy(*[F.desc(c) for c in order])
    local = tagged.withColumns(
        {
            "prev_event": F.last("_event", True).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
            "next_event": F.last("_event", True).over(reverse.rowsBetween(Window.unboundedPreceding, -1)),
        }
    ).where("_tag = 1")
    return (
        local.join(carried, series.chunk_key)
        .withColumn("prev_event", F.coalesce("prev_event", "_carry_prev"))
        .withColumn("next_event", F.coalesce("next_event", "_carry_next"))
        .drop("_carry_prev", "_carry_next", "_event", "_tag", "_chunk")
    )


def row_gaps(df: DataFrame, series: Series, out: str = "dt_s") -> DataFrame:
    """Seconds since the previous row of the series (NULL on its first row)."""
    chunked = series.with_chunk(df)
    ends = chunked.groupBy(*series.chunk_key).agg(F.max(series.ts).alias("_end"))
    previous = ends.select(*series.chunk_key, F.lag("_end").over(series.across_chunks()).alias("_prev_end"))
    inside = chunked.withColumn("_prev", F.lag(series.ts).over(series.chunk_window()))
    joined = inside.join(previous, series.chunk_key)
    gap = seconds_between(F.coalesce("_prev", "_prev_end"), F.col(series.ts))
    return joined.withColumn(out, gap).drop("_prev", "_prev_end", "_chunk")


def runs(
    df: DataFrame,
    series: Series,
    state: str,
    value: str,
    split_day: bool = False,
    max_gap_s: float | None = None,
) -> DataFrame:
    """Maximal runs of equal state, one row per run, with mergeable statistics of `value`.

    Runs are cut inside chunks first; only the first and last piece of a chunk can touch a
    neighbour, so only those are compared across chunks, and a run of any length is combined by its
    start from partial aggregates. With `split_day` midnight ends a run; with `max_gap_s` a longer silence ends it.
    """
    chunked = series.with_chunk(df.where(F.col(state).isNotNull()))
    w = series.chunk_window()
    day = F.to_date(series.ts)

    def breaks(prev_state: Column, prev_ts: Column) -> Column:
        cut = F.col(state) != prev_state
        if split_day:
            cut = cut | (day != F.to_date(prev_ts))
        if max_gap_s is not None:
            cut = cut | (seconds_between(prev_ts, F.col(series.ts)) > max_gap_s)
        return cut

    prev_state, prev_ts = F.lag(state).over(w), F.lag(series.ts).over(w)
    starts = F.coalesce(breaks(prev_state, prev_ts), F.lit(True)).cast("long")
    cut = chunked.withColumn("_start", starts).withColumn(
        "_run", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    place = F.struct(*series.order)
    pieces = cut.groupBy(*series.chunk_key, "_run").agg(
        F.max(state).alias(state),
        F.min(place).alias("_first"),
        F.max(place).alias("_last"),
        F.count(F.lit(1)).alias("n"),
        F.sum(value).alias("sum_v"),
        F.min(value).alias("min_v"),
        F.max(value).alias("max_v"),
    )
    # Pieces at a chunk border (two per chunk) share one lane per key; inner pieces stay in their chunk.
    last_run = F.max("_run").over(Window.partitionBy(*series.chunk_key))
    border = (F.col("_run") == 1) | (F.col("_run") == last_run)
    laned = pieces.withColumn("_border", border).withColumn(
        "_lane", F.when(F.col("_border"), F.lit(None).cast("long")).otherwise(F.col("_chunk"))
    )
    lane = Window.partitionBy(*series.key, "_lane").orderBy("_first")
    before_state, before_last = F.lag(state).over(lane), F.lag(f"_last.{series.ts}").over(lane)
    other_chunk = F.lag("_chunk").over(lane) != F.col("_chunk")
    here = F.col(f"_first.{series.ts}")
    joins = F.col("_border") & other_chunk & (F.col(state) == before_state)
    if split_day:
        joins = joins & (F.to_date(here) == F.to_date(before_last))
    if max_gap_s is not None:
        joins = joins & (seconds_between(before_last, here) <= max_gap_s)
    opened = laned.withColumn("_own", F.when(F.coalesce(joins, F.lit(False)), F.lit(None)).otherwise(F.col("_first")))
    placed = opened.withColumn(
        "_run_start",
        F.when(F.col("_border"), F.last("_own", True).over(lane.rowsBetween(Window.unboundedPreceding, 0))).otherwise(
            F.col("_first")
        ),
    )
    return (
        placed.groupBy(*series.key, "_run_start")
        .agg(
            F.max(state).alias(state),
            F.min(f"_first.{series.ts}").alias("start"),
            F.max(f"_last.{series.ts}").alias("end"),
            F.sum("n").alias("n"),
            F.sum("sum_v").alias("sum_v"),
            F.min("min_v").alias("min_v"),
            F.max("max_v").alias("max_v"),
        )
        .drop("_run_start")
    )
