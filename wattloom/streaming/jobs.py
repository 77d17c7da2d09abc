"""The streaming forms of binning, daily counts, the start guard and running statistics."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, StructField, StructType

from wattloom.functions.timeparse import floor_to, shift
from wattloom.session import checkpoint_dir


def with_beats(readings: DataFrame, beats: DataFrame, ts: str) -> DataFrame:
    """The readings and, beside them, rows of a time alone, marked `_beat`: a beat moves the watermark of an idle source."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in readings.schema.fields if f.name != ts]
    times = beats.select(F.col("at").cast(readings.schema[ts].dataType).alias(ts), *nulls, F.lit(True).alias("_beat"))
    return readings.withColumn("_beat", F.lit(False)).unionByName(times)


def stream_bins(
    readings: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], spikes: Sequence[str] = (), minutes: int = 15,
    delay: str = "30 minutes", beats: DataFrame | None = None,
) -> DataFrame:
    """Tumbling bins in append mode: a bin is written once the watermark has passed its end.

    The last bins of a source that falls silent stay open, until a row of the stream `beats` (see `close_bins`) carries a
    later time. Beats open no bin.
    """
    if beats is not None:
        readings = with_beats(readings, beats, ts)
    aggs = [F.avg(c).alias(c) for c in columns]
    for c in spikes:
        aggs += [F.max(c).alias(f"{c}_max5"), F.min(c).alias(f"{c}_min5"), F.max(F.abs(c)).alias(f"{c}_absmax5")]
    marked = readings.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    only_beats = [F.min("_beat").alias("_beat")] if beats is not None else []
    binned = marked.groupBy(*keys, F.window(ts, f"{minutes} minutes").alias("_win")).agg(*aggs, *only_beats)
    if beats is not None:
        binned = binned.where(~F.col("_beat")).drop("_beat")
    names = [c for c in binned.columns if c not in (*keys, "_win")]
    return binned.select(*keys, F.col("_win.start").cast("timestamp_ntz").alias("ts"), *names)


def stream_daily_counts(readings: DataFrame, keys: Sequence[str], ts: str, delay: str = "1 day") -> DataFrame:
    """Readings per day in update mode; a day's row grows until the watermark passes it."""
    marked = readings.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    counted = marked.groupBy(*keys, F.window(ts, "1 day").alias("_win")).agg(F.count(F.lit(1)).alias("n_raw"))
    return counted.select(*keys, F.to_date("_win.start").alias("date"), "n_raw")


GUARD_OUT = "key STRING, ts TIMESTAMP, last_startup TIMESTAMP, suppressed BOOLEAN"


class GuardProcessor(StatefulProcessor):
    """State of a key: its latest startup. A timer drops it `max_on_h` after that startup."""

    def __init__(self, max_on_h: float):
        self.max_on_h = max_on_h

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last_startup", "at TIMESTAMP")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        stored = self.last.get()
        last = pd.NaT if stored is None else pd.Timestamp(stored[0])
        steps = pd.concat(list(rows)).sort_values("ts")
        seen = steps["startup"].ffill()
        seen = seen if pd.isna(last) else seen.fillna(last)
        age = (steps["ts"] - seen).dt.total_seconds() / 3600.0
        yield pd.DataFrame(
            {"key": str(key[0]), "ts": steps["ts"], "last_startup": seen, "suppressed": (seen.isna() | (age > self.max_on_h)).astype(bool)}
        )
        newest = seen.iloc[-1]
        if not pd.isna(newest) and newest is not last:
            self.last.update((newest.to_pydatetime(),))
            self.handle.registerTimer(int(newest.timestamp() * 1000) + int(self.max_on_h * 3_600_000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        stored = self.last.get()
        if stored is not None:
            due = int(pd.Timestamp(stored[0]).timestamp() * 1000) + int(self.max_on_h * 3_600_000)
            if due <= expiredTimerInfo.getExpiryTimeInMs():
                self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


def stream_guard(
    readings: DataFrame, key: str, ts: str, spike: str, threshold: float, max_on_h: float = 12.0, minutes: int = 15, delay: str = "30 minutes"
) -> DataFrame:
    """Per step: is the latest startup, up to the end of the step, recent enough?

    Readings are first reduced to one row per (key, step) by a windowed aggregate, so the keyed state
    sees a series bounded by the clock, whatever a key's share of the readings.
    """
    marked = readings.select(F.col(key).cast("string").alias("key"), F.col(ts).cast("timestamp").alias("at"), spike).withWatermark("at", delay)
    startup = F.max(F.when(F.abs(spike) >= threshold, F.col("at"))).alias("startup")
    steps = marked.groupBy("key", F.window("at", f"{minutes} minutes").alias("_win")).agg(startup)
    timed = steps.select("key", F.col("_win.start").alias("ts"), "startup", F.window_time("_win").alias("until"))
    return timed.groupBy("key").transformWithStateInPandas(GuardProcessor(max_on_h), GUARD_OUT, "append", "eventTime")


STATS_OUT = "key STRING, day DATE, n_seen BIGINT, mean DOUBLE, std DOUBLE, mean_ema DOUBLE"


class StatsProcessor(StatefulProcessor):
    """State of a key: count, mean, squared distance and EMA of daily means."""

    def __init__(self, alpha: float):
        self.alpha = alpha

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stats = handle.getValueState("stats", "n BIGINT, mean DOUBLE, m2 DOUBLE, ema DOUBLE")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, mean, m2, ema = self.stats.get() or (0, 0.0, 0.0, None)
        out = []
        for day in pd.concat(list(rows)).sort_values("day").itertuples(index=False):
            delta, total = day.m - mean, n + day.n
            m2 += day.v * day.n + delta * delta * n * day.n / total
            mean += delta * day.n / total
            n = total
            ema = day.m if ema is None else (1 - self.alpha) * ema + self.alpha * day.m
            out.append((str(key[0]), day.day, int(n), mean, (m2 / (n - 1)) ** 0.5 if n > 1 else 1.0, ema))
        self.stats.update((int(n), float(mean), float(m2), float(ema)))
        yield pd.DataFrame(out, columns=["key", "day", "n_seen", "mean", "std", "mean_ema"])

    def close(self) -> None:
        pass


def stream_running_stats(readings: DataFrame, key: str, ts: str, value: str, alpha: float = 0.01, delay: str = "1 hour") -> DataFrame:
    """Running mean, deviation and EMA of daily means after each finished day.

    A windowed aggregate reduces a day to its moments; the keyed state merges one row per day.
    """
    marked = readings.select(F.col(key).cast("string").alias("key"), F.col(ts).cast("timestamp").alias("at"), value).withWatermark("at", delay)
    moments = marked.where(F.col(value).isNotNull()).groupBy("key", F.window("at", "1 day").alias("_win")).agg(
        F.count(value).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v")
    )
    days = moments.select("key", F.to_date("_win.start").alias("day"), "n", "m", "v")
    return days.groupBy("key").transformWithStateInPandas(StatsProcessor(alpha), STATS_OUT, "append", "none")


def read_events_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a file stream."""
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


# Keyed processors keep their state on disk, not on the heap.
STATE_STORE = (
    "spark.sql.streaming.stateStore.providerClass",
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
)


BEATS = "at TIMESTAMP_NTZ"
MARKS = "number BIGINT, seen TIMESTAMP_NTZ"


def beat_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The beats written to a folder, which is made if it is not there."""
    spark.createDataFrame([], BEATS).write.mode("append").parquet(folder)
    return spark.readStream.schema(BEATS).parquet(folder)


def close_bins(spark: SparkSession, folder: str, after: Column) -> None:
    """Write a beat: once read, all bins that end before `after` less the delay are closed. The caller decides that a source
    is idle; readings older than that count as late from then on."""
    spark.range(1).select(after.cast("timestamp_ntz").alias("at")).write.mode("append").parquet(folder)


def drain_bins(readings: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], spikes: Sequence[str] = (), minutes: int = 15, delay: str = "30 minutes") -> DataFrame:
    """All bins of the available input, the last ones too: the stream is drained, told that its source is idle, and drained again."""
    spark = readings.sparkSession
    base = f"{checkpoint_dir(spark)}/bins-{uuid.uuid4().hex}"
    stream = stream_bins(readings, keys, ts, columns, spikes, minutes, delay, beat_stream(spark, f"{base}/beats"))
    drain(stream, base=base)
    close_bins(spark, f"{base}/beats", F.lit("9999-01-01"))
    return drain(stream, base=base)


def drain_late(readings: DataFrame, ts: str, minutes: int = 15, delay_s: int = 1_800) -> DataFrame:
    """The readings that came too late for their bin, with the number of their batch: the side table of `stream_bins`.

    A reading is late if its bin had ended by the watermark of its batch: the latest time of the batches before, less the
    delay. The windowed aggregate itself goes by the watermark of one batch earlier, so it may still count a reading that is
    named here. The latest time of each batch is a row of a small table; a batch that is run again writes the same rows.
    """
    spark = readings.sparkSession
    base = f"{checkpoint_dir(spark)}/late-{uuid.uuid4().hex}"

    def save(batch: DataFrame, number: int) -> None:
        here = batch.sparkSession
        marks = here.read.option("recursiveFileLookup", True).schema(MARKS).parquet(f"{base}/marks")
        mark = marks.where(F.col("number") < number).agg(F.max("seen")).first()[0]
        end = shift(floor_to(F.col(ts), minutes), F.lit(minutes * 60_000_000))
        late = batch.where(F.lit(False) if mark is None else end <= shift(F.lit(mark).cast("timestamp_ntz"), F.lit(-delay_s * 1_000_000)))
        late.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{base}/late/_batch={number}")
        batch.agg(F.lit(number).cast("long").alias("number"), F.max(F.col(ts).cast("timestamp_ntz")).alias("seen")).write.mode("overwrite").parquet(f"{base}/marks/n{number}")

    spark.createDataFrame([], MARKS).write.parquet(f"{base}/marks/none")
    readings.writeStream.option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).foreachBatch(save).start().awaitTermination()
    schema = StructType([*readings.schema.fields, StructField("batch", IntegerType())])
    return spark.read.option("recursiveFileLookup", True).schema(schema).parquet(f"{base}/late")


def drain(stream: DataFrame, mode: str = "append", base: str | None = None) -> DataFrame:
    """Run a stream over all available input into a table in the shared folder and read it back.

    Update-mode rows carry their batch number (`_batch`), the later one replaces the earlier. With the `base` of an earlier
    call the stream goes on where that one ended.
    """
    spark = stream.sparkSession
    spark.conf.set(*STATE_STORE)
    base = base or f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    out, progress = f"{base}/out", f"{base}/progress"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", progress).trigger(availableNow=True)
    if mode == "append":
        running = writer.format("parquet").option("path", out).start()
    else:

        def save(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/_batch={number}")

        running = writer.foreachBatch(save).start()
    running.awaitTermination()
    written = spark.read.schema(stream.schema).option("basePath", out)
    return written.parquet(out) if mode == "append" else spark.read.option("basePath", out).parquet(f"{out}/_batch=*")

