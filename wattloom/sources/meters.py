"""Meter and label files: scan, target columns, merging, and report sinks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.functions.scalars import TARGET_PATTERN, normal_target, parse_number, sentinel_to_null
from wattloom.functions.timeparse import format_short, format_timestamp, parse_timestamp, require_parsed

DATA_PREFIX = "load_iden_data"


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """Header of the files, read as text so nothing is inferred."""
    return spark.read.option("header", True).csv(path).columns


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).option("encoding", "UTF-8").csv(path)


def read_bus(df: DataFrame, ts: str = "event_time", prefix: str = DATA_PREFIX, strict: bool = False) -> DataFrame:
    """Text readings to typed ones: time parsed, unreadable rows dropped, sentinel to NULL."""
    parsed = df.withColumn("_text", F.col(ts)).withColumn(ts, parse_timestamp(F.col(ts).cast("string")))
    if strict:
        parsed = require_parsed(parsed, "_text", ts)
    data = [c for c in df.columns if c.startswith(prefix)]
    typed = parsed.where(F.col(ts).isNotNull()).drop("_text")
    return typed.withColumns({c: sentinel_to_null(F.col(c).try_cast("double")) for c in data})


def read_branch(df: DataFrame, target: str | None = None, ts: str = "time") -> DataFrame:
    """Text label rows to typed ones, with the composite column when the target has several parts."""
    parsed = df.withColumn(ts, parse_timestamp(F.col(ts).cast("string"))).where(F.col(ts).isNotNull())
    powers = [c for c in df.columns if re.fullmatch(r"p\d+", c.strip())]
    typed = parsed.withColumns({c: F.col(c).try_cast("double") for c in powers})
    return with_target(typed, target) if target else typed


def check_target(name: str) -> str:
    """Normalised target name; raises on a malformed one."""
    plain = "".join(name.split()).lower()
    parts = plain.split("+")
    if not re.fullmatch(TARGET_PATTERN, plain) or len(set(parts)) != len(parts):
        raise ValueError(f"target must look like p1 or p1+p2, got {name!r}")
    return plain


def with_target(df: DataFrame, target: str) -> DataFrame:
    """Add the composite column: the row sum, NULL if any part is; a second call changes nothing."""
    plain = check_target(target)
    parts = plain.split("+")
    if len(parts) == 1 or plain in df.columns:
        return df
    missing = [p for p in parts if p not in df.columns]
    if missing:
        raise KeyError(f"target {target!r} needs columns {missing}, found {df.columns}")
    total = F.col(parts[0]).try_cast("double")
    for part in parts[1:]:
        total = total + F.col(part).try_cast("double")
    return df.withColumn(plain, total)


def choose_target(users: DataFrame, explicit: str | None = None) -> DataFrame:
    """Target per user: explicit → configured (if its parts exist) → channel number → first pN → p1.

    Input columns: user_id, config_target STRING, channel INT, columns ARRAY<STRING>. Adds `target`
    and `target_source`.
    """
    powers = F.filter("columns", lambda c: c.rlike(r"^p\d+$"))
    configured = normal_target(F.col("config_target"))
    parts = F.split(configured, r"\+")
    known = (F.size(powers) == 0) | (F.size(F.array_except(parts, powers)) == 0)
    from_config = F.when(known, configured)
    by_channel = F.concat(F.lit("p"), F.col("channel").cast("string"))
    from_channel = F.when((F.size(powers) == 0) | F.array_contains(powers, by_channel), by_channel)
    first = F.try_element_at(powers, F.lit(1))
    given = F.lit(check_target(explicit)) if explicit else F.lit(None).cast("string")
    source = (
        F.when(given.isNotNull(), "explicit")
        .when(from_config.isNotNull(), "config")
        .when(from_channel.isNotNull(), "channel")
        .when(first.isNotNull(), "first_column")
        .otherwise("default")
    )
    target = F.coalesce(given, from_config, from_channel, first, F.lit("p1"))
    return users.withColumn("target", target).withColumn("target_source", source)


def choose_threshold(explicit: Column, own: Column, shared: Column, default: float = 10.0) -> Column:
    """ON threshold: explicit in (0, 5000], then the user's, the shared and the built-in value."""
    given = F.when((explicit > 0) & (explicit <= 5_000), explicit)
    return F.coalesce(given, parse_number(own, 0.001, 5_000.0), parse_number(shared, 0.001, 5_000.0), F.lit(default))


def union_common(frames: Sequence[DataFrame]) -> DataFrame:
    """Union on the columns all tables share, in the order of the first."""
    common = [c for c in frames[0].columns if all(c in f.columns for f in frames)]
    out = frames[0].select(*common)
    for f in frames[1:]:
        out = out.unionByName(f.select(*common))
    return out


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Keep the first row per key. An aggregate, so a heavily repeated key is combined map-side."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def merge_history(frames: Sequence[DataFrame], keys: Sequence[str], ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """Common columns of all files; of rows with the same key and time the earliest file's is kept."""
    ranked = [f.withColumn("_file", F.lit(i)) for i, f in enumerate(frames)]
    merged = union_common(ranked)
    return first_per_key(merged.where(F.col(ts).isNotNull()), [*keys, ts], ["_file", *tie]).drop("_file")


def add_days(base: DataFrame, extra: Sequence[DataFrame], ts: str, days: Sequence[str]) -> DataFrame:
    """Append the listed days of further files, without removing duplicates."""
    wanted = [F.to_date(F.lit(d)) for d in days]
    return union_common([base, *[f.where(F.to_date(ts).isin(wanted)) for f in extra]])


def covered_days(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Distinct days; only the time column is read."""
    return df.select(*keys, F.to_date(ts).alias("date")).distinct()


def time_span(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias("start"), F.max(ts).alias("end"))


PREDICTION_DIGITS = {
    "y_true_W": 3, "y_pred_W": 3, "residual_W": 3, "p_on": 4, "y_pred_low_W": 3, "y_pred_high_W": 3,
}


def prediction_table(df: DataFrame, keys: Sequence[str], ts: str, y_true: str, y_pred: str, **optional: str) -> DataFrame:
    """Report columns of scored rows; the residual is taken before rounding."""
    columns = {
        "y_true_W": F.col(y_true),
        "y_pred_W": F.col(y_pred),
        "residual_W": F.col(y_pred) - F.col(y_true),
        **{name: F.col(c) for name, c in optional.items()},
    }
    rounded = [
        (F.round(c, PREDICTION_DIGITS[name]) if name in PREDICTION_DIGITS else c.cast("int")).alias(name)
        for name, c in columns.items()
    ]
    return df.select(*keys, F.col(ts).alias("time"), *rounded)


def wide_predictions(long: DataFrame, keys: Sequence[str], ts: str, models: Sequence[str], y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """One row per time with a prediction and a residual column per model."""
    wide = long.groupBy(*keys, ts).agg(
        F.round(F.max(y_true), 3).alias("y_true_W"),
        *[
            F.round(F.max(F.when(F.col("model") == m, value)), 3).alias(f"{name}_{m}")
            for m in models
            for name, value in (("y_pred_W", F.col(y_pred)), ("residual_W", F.col(y_pred) - F.col(y_true)))
        ],
    )
    return wide.withColumnRenamed(ts, "time")


def write_report(df: DataFrame, path: str, ts_columns: Sequence[str] = (), short: bool = False, order: Sequence[str] = ()) -> None:
    """CSV at the edge: times as text, sorted only here."""
    text = format_short if short else format_timestamp
    out = df.withColumns({c: text(F.col(c)) for c in ts_columns})
    if order:
        out = df.orderBy(*order).withColumns({c: text(F.col(c)) for c in ts_columns})
    out.write.mode("overwrite").option("header", True).csv(path)


def append_metrics(rows: DataFrame, path: str) -> DataFrame:
    """Append metric rows; later writes may bring new columns, old rows read them as NULL."""
    rows.write.mode("append").option("mergeSchema", True).parquet(path)
    return rows.sparkSession.read.option("mergeSchema", True).parquet(path)


def union_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old columns in their order, new ones last, gaps NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def overwrite_if_any(df: DataFrame, path: str) -> bool:
    """Replace a table, unless there is nothing to write."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def rank_columns(df: DataFrame, keys: Sequence[str], by: str, k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(by), "column")
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

