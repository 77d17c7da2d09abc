"""Timestamp text in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accepted layouts after '-' became '/' and 'T' became a blank, first match wins.
LAYOUTS = (
    "yyyy/M/d H:m:s",
    "yyyy/M/d H:m",
    "yyyy/M/d",
    "yyyy/M/d H:m:s.SSSSSS",
    "yyyy/M/d H:m:s.SSS",
    "yyyyMMdd",
    "M/d/yyyy H:m:s",
    "M/d/yyyy H:m",
    "M/d/yyyy",
)


def parse_timestamp(text: Column) -> Column:
    """Parse mixed timestamp text to TIMESTAMP_NTZ; unreadable text gives NULL."""
    plain = F.translate(F.trim(text), "-T", "/ ")
    tried = [F.try_to_timestamp(plain, F.lit(layout)) for layout in LAYOUTS]
    return F.coalesce(*tried, F.trim(text).try_cast("timestamp")).cast("timestamp_ntz")


def require_parsed(df: DataFrame, text: str, parsed: str) -> DataFrame:
    """Fail the job on the first row whose text could not be parsed."""
    bad = F.col(text).isNotNull() & F.col(parsed).isNull()
    message = F.concat(F.lit("unreadable timestamp: "), F.col(text))
    checked = F.when(bad, F.raise_error(message).cast("timestamp_ntz")).otherwise(F.col(parsed))
    return df.withColumn(parsed, checked)


def parse_failures(df: DataFrame, text: str, keys: list[str] | None = None) -> DataFrame:
    """Rows read, parsed and rejected."""
    parsed = parse_timestamp(F.col(text))
    return df.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(parsed).alias("n_parsed"),
        F.count_if(F.col(text).isNotNull() & parsed.isNull()).alias("n_failed"),
    )


def format_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy/MM/dd HH:mm:ss")


def format_short(ts: Column) -> Column:
    return F.date_format(ts, "yyyy/M/d H:mm:ss")


def floor_to(ts: Column, minutes: int) -> Column:
    """Start of the left-closed bin that holds the timestamp."""
    return F.window(ts, f"{minutes} minutes").getField("start") if minutes >= 1_440 else _floor_micros(ts, minutes)


def _floor_micros(ts: Column, minutes: int) -> Column:
    width = minutes * 60_000_000
    at = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_micros(at - F.pmod(at, F.lit(width))).cast("timestamp_ntz")


def shift(ts: Column, micros: Column) -> Column:
    """The naive timestamp moved by a number of microseconds."""
    return F.timestamp_micros(F.unix_micros(ts.cast("timestamp")) + micros.cast("long")).cast("timestamp_ntz")


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")
