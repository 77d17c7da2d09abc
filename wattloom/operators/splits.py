"""Train / validation / test splits by position, by month, and by whole days."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.scalars import round_even
from wattloom.operators.filters import hit
from wattloom.operators.series import Series, attach, with_position
from wattloom.session import cut_lineage

DEFAULT_RATIOS = (0.60, 0.20, 0.20)
FULL_DAY_ROWS = 80
MIN_MONTH_ROWS = 10
SEED = 42
NAMES = ("train", "val", "test")


def check_ratios(ratios: Sequence[float]) -> tuple[float, float, float]:
    """Three positive shares scaled to sum 1."""
    if len(ratios) != 3 or any(r <= 0 for r in ratios):
        raise ValueError(f"three positive split ratios are needed, got {tuple(ratios)}")
    total = sum(ratios)
    return tuple(r / total for r in ratios) if abs(total - 1.0) > 1e-6 else tuple(float(r) for r in ratios)


def _by_position(pos: Column, n: Column, ratios: tuple[float, float, float]) -> Column:
    first = F.floor(n * F.lit(ratios[0]))
    second = F.floor(n * F.lit(ratios[0] + ratios[1]))
    return F.when(pos < first, "train").when(pos < second, "val").otherwise("test")


def split_by_time(df: DataFrame, series: Series, ratios: Sequence[float] = DEFAULT_RATIOS) -> DataFrame:
    placed = with_position(df, series, total="_n")
    return placed.withColumn("split", _by_position(F.col("pos"), F.col("_n"), check_ratios(ratios))).drop("pos", "_n")


def split_by_month(df: DataFrame, series: Series, ratios: Sequence[float] = DEFAULT_RATIOS) -> DataFrame:
    """The time split inside every month; months below ten rows go to train."""
    monthly = series.renamed(key=(*series.key, "_month"))
    placed = with_position(df.withColumn("_month", F.date_trunc("month", series.ts)), monthly, total="_n")
    split = F.when(F.col("_n") < MIN_MONTH_ROWS, "train").otherwise(_by_position(F.col("pos"), F.col("_n"), check_ratios(ratios)))
    return placed.withColumn("split", split).drop("pos", "_n", "_month")


def day_quota(df: DataFrame, n: str, ratios: tuple[float, float, float]) -> DataFrame:
    """Adds `_train` and `_val` days out of n full days: train rounded first, the rest shared, one day each.

    Staged columns: as one nested expression the steps would repeat each other many times over.
    """
    _, val, test = ratios
    one = F.lit(1).cast("long")
    out = df.withColumn("_rest", F.col(n) - round_even(F.col(n) * F.lit(ratios[0])))
    out = out.withColumn("_v", round_even(F.col("_rest") * F.lit(val) / F.lit(val + test)))
    out = out.withColumn("_t", F.col("_rest") - F.col("_v")).withColumn("_v", F.greatest("_v", one))
    out = out.withColumn("_left", F.col(n) - F.col("_v") - F.col("_t"))
    # A test set without a day takes one from train, or from a validation set of several days.
    out = out.withColumn("_give", (F.col("_t") < 1) & (F.col("_left") <= 1) & (F.col("_v") > 1))
    out = out.withColumn("_t", F.when((F.col("_t") < 1) & ((F.col("_left") > 1) | F.col("_give")), one).otherwise(F.col("_t")))
    out = out.withColumn("_v", F.when(F.col("_give"), F.col("_v") - 1).otherwise(F.col("_v")))
    # Train keeps at least one day: first test, then validation gives way.
    out = out.withColumn("_over", F.greatest(F.col("_v") + F.col("_t") - (F.col(n) - 1), F.lit(0)))
    out = out.withColumn("_cut", F.least(F.col("_over"), F.greatest(F.col("_t") - 1, F.lit(0))))
    out = out.withColumn("_t", F.col("_t") - F.col("_cut"))
    out = out.withColumn("_val", F.col("_v") - F.least(F.col("_over") - F.col("_cut"), F.greatest(F.col("_v") - 1, F.lit(0))))
    out = out.withColumn("_train", F.col(n) - F.col("_val") - F.col("_t"))
    return out.drop("_rest", "_v", "_t", "_left", "_give", "_over", "_cut")


def day_split_table(
    days: DataFrame, keys: Sequence[str], ratios: Sequence[float] = DEFAULT_RATIOS, by_month: bool = True,
    full_day_rows: int = FULL_DAY_ROWS, seed: int = SEED,
) -> DataFrame:
    """Split of every (key, date): full days are shuffled by a seeded hash, partial days go to train.

    Input is the day table (keys, date, n). The hash order depends only on seed, key and date, so a
    recomputed partition gives the same split.
    """
    ratios = check_ratios(ratios)
    group = [*keys, "_month"] if by_month else list(keys)
    marked = days.withColumn("_full", F.col("n") >= full_day_rows).withColumn("_month", F.date_trunc("month", "date"))
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys], F.date_format("date", "yyyy-MM-dd"))
    order = Window.partitionBy(*group, "_full").orderBy(F.md5(text), "date")
    ranked = marked.withColumn("_rank", F.row_number().over(order)).withColumn(
        "_k", F.count(F.lit(1)).over(Window.partitionBy(*group, "_full")).cast("long")
    )
    ranked = day_quota(ranked, "_k", ratios)
    split = (
        F.when(~F.col("_full") | (F.col("_k") < 3), "train")
        .when(F.col("_rank") <= F.col("_train"), "train")
        .when(F.col("_rank") <= F.col("_train") + F.col("_val"), "val")
        .otherwise("test")
    )
    return ranked.select(*keys, "date", "n", F.col("_full").alias("full_day"), split.alias("split"))


def split_by_day(
    df: DataFrame, keys: Sequence[str], ts: str, ratios: Sequence[float] = DEFAULT_RATIOS, by_month: bool = True,
    full_day_rows: int = FULL_DAY_ROWS, seed: int = SEED,
) -> DataFrame:
    """Whole days per split. Only the day table is ranked; rows get their split by (key, date)."""
    dated = df.withColumn("_date", F.to_date(ts))
    days = dated.groupBy(*keys, F.col("_date").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    table = day_split_table(days, keys, ratios, by_month, full_day_rows, seed).select(*keys, F.col("date").alias("_date"), "split")
    return dated.join(table, [*keys, "_date"]).drop("_date")


def make_split(df: DataFrame, series: Series, strategy: str = "stratified_day", ratios: Sequence[float] = DEFAULT_RATIOS, **options) -> DataFrame:
    if strategy == "time":
        return split_by_time(df, series, ratios)
    if strategy == "stratified":
        return split_by_month(df, series, ratios)
    if strategy in ("stratified_day", "global_stratified"):
        return split_by_day(df, series.key, series.ts, ratios, strategy == "stratified_day", **options)
    raise ValueError(f"unknown split strategy {strategy!r}")


def split_dates(df: DataFrame, keys: Sequence[str], ts: str, split: str = "split") -> DataFrame:
    return df.select(*keys, split, F.to_date(ts).alias("date")).distinct()


def split_range_arrays(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range rows (keys, split, kind, start, end) to one row per key with six arrays."""
    span = F.struct("start", "end")
    return ranges.groupBy(*keys).agg(
        *[
            F.sort_array(F.collect_set(F.when((F.col("split") == s) & (F.col("kind") == k), span))).alias(f"_{s}_{k}")
            for s in NAMES
            for k in ("include", "exclude")
        ]
    )


def per_split_filter(df: DataFrame, ranges: DataFrame, series: Series, split: str = "split") -> DataFrame:
    """Include ranges pin rows to a split, exclude ranges expel them; split sizes are then restored.

    A row excluded from all three splits is dropped. Splits above their old size first hand unpinned rows to the first
    split below its own, as long as these may enter it; then the expelled rows are handed out the same way. Where none
    of them may enter, one goes to another split that is not above its size, whose earliest unpinned row that may enter
    takes the place. Rows that find no place are dropped. All choices go by time.

    Moving rows one by one comes down to a few steps, each taking the earliest so many rows of one kind per key: the
    amount follows from counts per key, the rows from their rank. Steps that move nothing anywhere are passed over.
    Rows without a key or a time belong to no series and leave.
    """
    keys = list(series.key)
    slim = df.select(*keys, *series.order, split)
    joined = attach(slim, split_range_arrays(ranges, keys), keys)
    ts = F.col(series.ts)
    pinned = F.coalesce(*[F.when(hit(ts, F.col(f"_{s}_include")), F.lit(s)) for s in NAMES])
    flagged = joined.withColumns({f"_no_{s}": hit(ts, F.col(f"_{s}_exclude")) for s in NAMES}).withColumn("_pin", pinned)
    flagged = flagged.drop(*[f"_{s}_{k}" for s in NAMES for k in ("include", "exclude")])
    start = F.coalesce("_pin", split)
    lost = F.col("_no_train") & F.col("_no_val") & F.col("_no_test")
    expelled = reduce(lambda a, b: a | b, ((start == s) & F.col(f"_no_{s}") for s in NAMES))
    # Only keys, times and flags are carried.
    rows = cut_lineage(flagged.withColumn("_at", F.when(lost, "lost").when(expelled, "none").otherwise(start)))
    steps = transport_steps()
    nth = 0
    while nth < len(steps):
        amounts = cut_lineage(step_amounts(rows, keys, split, steps))
        most = amounts.agg(*[F.max(f"_m{i}") for i in range(nth, len(steps))]).first()
        nth = next((i for i, m in enumerate(most, nth) if m), len(steps))
        if nth < len(steps):
            rows = cut_lineage(moved(rows, amounts.select(*keys, F.col(f"_m{nth}").alias("_m")).where("_m > 0"), series, steps[nth]))
            nth += 1
    chosen = rows.where(F.col("_at").isin(*NAMES)).select(*keys, *series.order, F.col("_at").alias(split))
    return df.drop(split).join(chosen, [*keys, *series.order])


@dataclass(frozen=True)
class Step:
    """Rows that are `giving` go to split `to`; with `via`, as many expelled rows take their places there."""

    giving: Column
    to: str
    source: str
    via: str | None = None


def may_enter(s: str) -> Column:
    return ~F.col(f"_no_{s}")


def transport_steps() -> list[Step]:
    """Surplus of each split to each other one, then expelled rows, directly and by way of another split."""
    free = F.col("_pin").isNull()
    steps = [Step((F.col("_at") == j) & free & may_enter(k), k, j) for j in NAMES for k in NAMES if j != k]
    for k in NAMES:
        steps.append(Step((F.col("_at") == "none") & may_enter(k), k, "none"))
        steps += [Step((F.col("_at") == j) & free & may_enter(k), k, "none", j) for j in NAMES if j != k]
    return steps


def step_amounts(rows: DataFrame, keys: Sequence[str], split: str, steps: Sequence[Step]) -> DataFrame:
    """Per key: how many rows each step would move now. Only the first split below its old size receives."""
    counts = rows.groupBy(*keys).agg(
        *[F.count_if(F.col(split) == s).alias(f"_goal_{s}") for s in NAMES],
        *[F.count_if(F.col("_at") == s).alias(f"_have_{s}") for s in NAMES],
        *[F.count_if((F.col("_at") == "none") & may_enter(s)).alias(f"_waits_{s}") for s in NAMES],
        *[F.count_if(step.giving).alias(f"_n{i}") for i, step in enumerate(steps)],
    )
    short = {s: F.col(f"_goal_{s}") - F.col(f"_have_{s}") for s in NAMES}

    def amount(i: int, step: Step) -> Column:
        first = reduce(lambda a, b: a & b, (short[s] <= 0 for s in NAMES[: NAMES.index(step.to)]), F.lit(True))
        limits = [short[step.to], F.col(f"_n{i}")]
        if step.via:
            # A swap keeps the size of the other split, which must not be above its own.
            first, limits = first & (short[step.via] >= 0), [*limits, F.col(f"_waits_{step.via}")]
        elif step.source != "none":
            limits.append(-short[step.source])
        return F.when(first, F.greatest(F.least(*limits), F.lit(0))).otherwise(0)

    return counts.select(*keys, *[amount(i, step).alias(f"_m{i}") for i, step in enumerate(steps)])


def moved(rows: DataFrame, amounts: DataFrame, series: Series, step: Step) -> DataFrame:
    """The rows after one step: the first `_m` of each kind, by time, go where the step sends them."""
    kind = F.when(step.giving, F.lit("give"))
    if step.via:
        kind = kind.when((F.col("_at") == "none") & may_enter(step.via), F.lit("take"))
    ranked = with_position(rows.withColumn("_kind", F.coalesce(kind, F.lit("stay"))), series.renamed(key=(*series.key, "_kind")), "_rank")
    due = attach(ranked, amounts, list(series.key))
    goes = F.coalesce(F.col("_rank") < F.col("_m"), F.lit(False))
    place = F.when(goes & (F.col("_kind") == "give"), F.lit(step.to)).when(goes & (F.col("_kind") == "take"), F.lit(step.via)).otherwise(F.col("_at"))
    return due.withColumn("_at", place).select(*rows.columns)


def quality_gates(
    aligned: DataFrame, keys: Sequence[str], state: str, split: str | None = None, users: DataFrame | None = None, min_rows: int = 96
) -> DataFrame:
    """Status per key: enough rows, both classes, and (with splits) rows in val and test; first failure wins."""
    counts = [F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(state), F.lit(0)).cast("long").alias("n_on")]
    if split is not None:
        counts += [F.count_if(F.col(split) == s).alias(f"n_{s}") for s in NAMES]
    stats = aligned.groupBy(*keys).agg(*counts)
    if users is not None:
        stats = users.select(*keys).distinct().join(stats, list(keys), "left").fillna(0)
    reason = (
        F.when(F.col("n_rows") < min_rows, "aligned_too_few")
        .when((F.col("n_on") == 0) | (F.col("n_on") == F.col("n_rows")), "single_class_label")
    )
    if split is not None:
        reason = reason.when((F.col("n_val") == 0) | (F.col("n_test") == 0), "split_empty_val_test")
    detail = F.when(F.col("n_rows") < min_rows, F.lit(None)).when(F.col("n_on") == 0, "all_off").when(F.col("n_on") == F.col("n_rows"), "all_on")
    return stats.withColumn("skip_reason", reason).withColumn("detail", detail)
