"""Per-user settings from JSON: typed values, range rows and their text form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.scalars import normal_ratios, normal_target, parse_bool, parse_count, parse_number
from wattloom.operators.filters import parse_ranges

RANGES = "include ARRAY<ARRAY<STRING>>, exclude ARRAY<ARRAY<STRING>>"
STRATEGIES = ("stratified_day", "stratified", "time", "global_stratified")
NUMBERS = {"on_thr_w": (0.001, 5000.0), "weather_latitude": (-90.0, 90.0), "weather_longitude": (-180.0, 180.0)}
COUNTS = ("post_min_on", "post_fill_short_off")
SWITCHES = ("use_weather_features", "use_temp_based_season", "guard_enabled")
# Flag name -> other accepted names.
FLAGS = {
    "v14_enable": ("v14_enabled",),
    "physics": ("physics_features",),
    "focal": (),
    "ensemble": (),
    "calibrate": (),
    "auto_config": (),
    "health": ("health_report",),
    "diag": ("data_diag",),
}
FLAG_NAMES = [n for name, others in FLAGS.items() for n in (name, *others)]
BODY = (
    "target_col STRING, split_ratios ARRAY<STRING>, split_strategy STRING, "
    + ", ".join(f"{n} STRING" for n in (*NUMBERS, *COUNTS, *SWITCHES))
    + f", train STRUCT<{RANGES.replace(' ARRAY', ': ARRAY')}>, infer STRUCT<{RANGES.replace(' ARRAY', ': ARRAY')}>"
    + ", splits STRUCT<"
    + ", ".join(f"{s}: STRUCT<{RANGES.replace(' ARRAY', ': ARRAY')}>" for s in ("train", "val", "test"))
    + ">, v14 STRUCT<"
    + ", ".join(f"{n}: STRING" for n in FLAG_NAMES)
    + ">"
)
OVERRIDES = ["on_thr_w", "split_ratios", "split_strategy", *COUNTS, "weather_latitude", "weather_longitude", *SWITCHES]


def read_config_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per config file with its whole text."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("json"))


def config_entries(text: DataFrame, json: str = "json") -> DataFrame:
    """Entries of a root object: user and body; comments and entries that are no objects are left out."""
    root = F.from_json(F.col(json), "MAP<STRING, STRING>")
    entries = text.select(F.explode(root).alias("user_id", "body"))
    wanted = (F.col("user_id") == "_default") | ~F.col("user_id").startswith("_")
    return entries.where(wanted & F.trim("body").startswith("{"))


def typed_config(entries: DataFrame) -> DataFrame:
    """Valid settings as typed columns; an invalid value is NULL and falls back later."""
    parsed = entries.withColumn("c", F.from_json("body", BODY))
    strategy = F.lower(F.trim("c.split_strategy"))
    values = [
        normal_target(F.col("c.target_col")).alias("target_col"),
        normal_ratios(F.col("c.split_ratios")).alias("split_ratios"),
        F.when(strategy.isin(*STRATEGIES), strategy).alias("split_strategy"),
        *[parse_number(F.col(f"c.{n}"), low, high).alias(n) for n, (low, high) in NUMBERS.items()],
        *[parse_count(F.col(f"c.{n}")).alias(n) for n in COUNTS],
        *[parse_bool(F.col(f"c.{n}")).alias(n) for n in SWITCHES],
    ]
    return parsed.select("user_id", *values)


def rejected_settings(entries: DataFrame) -> DataFrame:
    """Settings that are present in the text but not valid."""
    raw = entries.withColumn("c", F.from_json("body", BODY))
    good = typed_config(entries)
    names = ["target_col", "split_strategy", *NUMBERS, *COUNTS, *SWITCHES]
    given = raw.select("user_id", *[F.col(f"c.{n}").alias(f"_{n}") for n in names])
    both = given.join(good, "user_id")
    bad = F.array_compact(F.array(*[F.when(F.col(f"_{n}").isNotNull() & F.col(n).isNull(), F.lit(n)) for n in names]))
    return both.select("user_id", F.explode(bad).alias("setting"))


def feature_flags(entries: DataFrame) -> DataFrame:
    """Switches of the user's own entry; a missing one is looked up under its other name, else false."""
    parsed = entries.withColumn("c", F.from_json("body", BODY))
    values = [
        F.coalesce(*[parse_bool(F.col(f"c.v14.{n}")) for n in (name, *others)], F.lit(False)).alias(name)
        for name, others in FLAGS.items()
    ]
    return parsed.where("user_id <> '_default'").select("user_id", *values)


def _spans(column: str, kind: str, **labels: str) -> Column:
    pairs = F.transform(
        F.coalesce(F.col(f"{column}.{kind}"), F.array().cast("array<array<string>>")),
        lambda p: F.struct(
            *[F.lit(v).alias(k) for k, v in labels.items()],
            F.lit(kind).alias("kind"),
            F.try_element_at(p, F.lit(1)).alias("start_text"),
            F.try_element_at(p, F.lit(2)).alias("end_text"),
        ),
    )
    return pairs


def stage_ranges(entries: DataFrame, stages: Sequence[str] = ("train", "infer")) -> DataFrame:
    """Range rows (user, stage, kind, start, end) of the stage filters; invalid ranges are flagged."""
    parsed = entries.withColumn("c", F.from_json("body", BODY))
    spans = F.concat(*[_spans(f"c.{s}", k, stage=s) for s in stages for k in ("include", "exclude")])
    return parse_ranges(parsed.select("user_id", F.inline(spans)))


def split_ranges(entries: DataFrame) -> DataFrame:
    """Range rows (user, split, kind, start, end) of the per-split filters."""
    parsed = entries.withColumn("c", F.from_json("body", BODY))
    spans = F.concat(*[_spans(f"c.splits.{s}", k, split=s) for s in ("train", "val", "test") for k in ("include", "exclude")])
    return parse_ranges(parsed.select("user_id", F.inline(spans)))


def ranges_for_users(users: DataFrame, ranges: DataFrame, entries: DataFrame) -> DataFrame:
    """A user without an entry of its own gets the `_default` ranges."""
    own = users.join(entries.select("user_id"), "user_id", "left_semi").withColumn("_source", F.col("user_id"))
    rest = users.join(entries.select("user_id"), "user_id", "left_anti").withColumn("_source", F.lit("_default"))
    chosen = own.unionByName(rest)
    return chosen.join(ranges.withColumnRenamed("user_id", "_source"), "_source").drop("_source")


def ranges_to_json(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range rows to one JSON text per key, ISO times."""
    pair = F.array(F.date_format("start", "yyyy-MM-dd'T'HH:mm:ss"), F.date_format("end", "yyyy-MM-dd'T'HH:mm:ss"))

    def side(kind: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("kind") == kind, pair))).alias(kind)

    grouped = ranges.where("valid").groupBy(*keys).agg(side("include"), side("exclude"))
    return grouped.select(*keys, F.to_json(F.struct("include", "exclude")).alias("spec"))


def ranges_from_json(specs: DataFrame, keys: Sequence[str], spec: str = "spec") -> DataFrame:
    parsed = specs.withColumn("c", F.from_json(spec, RANGES))
    spans = F.concat(_spans("c", "include"), _spans("c", "exclude"))
    return parse_ranges(parsed.select(*keys, F.inline(spans)))


def range_summary(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    return ranges.where("valid").groupBy(*keys).agg(
        F.count_if(F.col("kind") == "include").alias("n_include"), F.count_if(F.col("kind") == "exclude").alias("n_exclude")
    )
