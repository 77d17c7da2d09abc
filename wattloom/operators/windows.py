"""Rolling, lag and decay features per series. Every family is a dict of columns over one shared window."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wattloom.functions.scalars import over
from wattloom.operators.series import Series, over_rows, with_position

DAY_ROWS = 96
WEEK_ROWS = 672
JUMP_W = 50.0
EMA_ROWS = 256
EMA_HALF_LIVES = 64


def back(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def differences(w: WindowSpec, columns: Sequence[str], steps: Mapping[str, int]) -> dict[str, Column]:
    """c − c[k rows back], 0 at the head."""
    return {
        f"{c}_{name}": F.coalesce(F.col(c) - F.lag(c, k).over(w), F.lit(0.0)) for c in columns for name, k in steps.items()
    }


def absolute_differences(w: WindowSpec, columns: Sequence[str]) -> dict[str, Column]:
    return {
        f"{c}_abs_d{k}": F.coalesce(F.abs(F.col(c) - F.lag(c, k).over(w)), F.lit(0.0)) for c in columns for k in (1, 3)
    }


def jump_flags(w: WindowSpec, columns: Sequence[str], limit: float = JUMP_W) -> dict[str, Column]:
    out = {}
    for c in columns:
        step = F.coalesce(F.col(c) - F.lag(c, 1).over(w), F.lit(0.0))
        out[f"{c}_up_d1"] = (step > limit).cast("int")
        out[f"{c}_down_d1"] = (step < -limit).cast("int")
    return out


def short_stats(w: WindowSpec, columns: Sequence[str]) -> dict[str, Column]:
    out = {}
    for c in columns:
        out[f"{c}_rm4"] = F.avg(c).over(back(w, 4))
        out[f"{c}_rs4"] = F.coalesce(F.stddev_samp(c).over(back(w, 4)), F.lit(0.0))
    return out


def lags(w: WindowSpec, columns: Sequence[str]) -> dict[str, Column]:
    """Lags 1 and 2; the head takes the first value of the series (blocks start there)."""
    head = w.rowsBetween(-2, 0)
    return {f"{c}_lag{k}": F.coalesce(F.lag(c, k).over(w), F.first(c, True).over(head)) for c in columns for k in (1, 2)}


def ranges(w: WindowSpec, columns: Sequence[str]) -> dict[str, Column]:
    return {
        f"{c}_range_{n}": F.coalesce(F.max(c).over(back(w, n)) - F.min(c).over(back(w, n)), F.lit(0.0))
        for c in columns
        for n in (4, 12)
    }


def texture(w: WindowSpec, columns: Sequence[str]) -> dict[str, Column]:
    """Rolling deviation and its ratio to the level (floor 10)."""
    out = {}
    for c in columns:
        for n in (4, 12, 24):
            deviation = F.coalesce(F.stddev_samp(c).over(back(w, n)), F.lit(0.0))
            out[f"{c}_std_{n}"] = deviation
            out[f"{c}_cv_{n}"] = F.coalesce(deviation / F.greatest(F.abs(F.avg(c).over(back(w, n))), F.lit(10.0)), F.lit(0.0))
    return out


def quartiles(w: WindowSpec, column: str) -> dict[str, Column]:
    out = {}
    for n in (4, 12):
        low = F.percentile(column, 0.25).over(back(w, n))
        high = F.percentile(column, 0.75).over(back(w, n))
        out[f"{column}_p25_{n}"] = F.coalesce(low, F.lit(0.0))
        out[f"{column}_p75_{n}"] = F.coalesce(high, F.lit(0.0))
        out[f"{column}_iqr_{n}"] = F.coalesce(high - low, F.lit(0.0))
    return out


def slopes(w: WindowSpec, column: str, widths: Sequence[int]) -> dict[str, Column]:
    """Sample covariance with the row number over the population variance of the row number."""
    out = {}
    for n in widths:
        frame = back(w, n)
        rows = F.count(column).over(frame)
        spread = (rows * rows - 1) / 12.0
        rise = F.covar_samp(column, F.col("pos").cast("double")).over(frame)
        out[f"{column}_slope_{n}"] = F.when(rows >= 2, rise / spread).otherwise(F.lit(0.0))
    return out


def event_memory(w: WindowSpec, flag: str, rows: int = 3) -> dict[str, Column]:
    return {f"{flag.removesuffix('_any')}_recent_{rows}": F.max(flag).over(back(w, rows))}


def prefix_sums(w: WindowSpec, column: str) -> dict[str, Column]:
    """Running sums inside a block, relative to its first value so long frames keep their precision."""
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    base = F.first(column, True).over(frame)
    shifted = F.col(column) - base
    return {"_base": base, "_x": shifted, "_x2": shifted * shifted}


def _running(w: WindowSpec) -> dict[str, Column]:
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    return {"_cn": F.count("_x").over(frame), "_cx": F.coalesce(F.sum("_x").over(frame), F.lit(0.0)), "_cx2": F.coalesce(F.sum("_x2").over(frame), F.lit(0.0))}


def _frame(w: WindowSpec, rows: int, ending: int = 0) -> tuple[Column, Column, Column]:
    """Count of values, sum and square sum of the frame of `rows` rows that ends `ending` rows back.

    A difference of two running sums: the cost per row does not depend on the frame length.
    """
    def part(c: str) -> Column:
        upper = F.col(c) if ending == 0 else F.lag(c, ending).over(w)
        return upper - F.coalesce(F.lag(c, rows + ending).over(w), F.lit(0.0))

    n = part("_cn")
    return F.when(n > 0, n), part("_cx"), part("_cx2")


def baseline_deviation(w: WindowSpec, column: str) -> dict[str, Column]:
    """Distance to the day and week mean, and the day distance in standard deviations (floor 5)."""
    n, s, s2 = _frame(w, DAY_ROWS)
    day_mean = F.col("_base") + s / n
    variance = F.when(n >= 2, F.greatest((s2 - s * s / n) / (n - 1), F.lit(0.0)))
    n7, s7, _ = _frame(w, WEEK_ROWS)
    return {
        f"{column}_dev_24h": F.col(column) - day_mean,
        f"{column}_dev_7d": F.col(column) - (F.col("_base") + s7 / n7),
        "_day_std": F.sqrt(variance),
    }


def z_score(w: WindowSpec, column: str) -> dict[str, Column]:
    """The first row has no deviation yet and takes the next row's."""
    deviation = F.coalesce(F.col("_day_std"), F.lead("_day_std", 1).over(w))
    return {f"{column}_z_24h": F.coalesce(F.col(f"{column}_dev_24h") / F.greatest(deviation, F.lit(5.0)), F.lit(0.0))}


RECENT = {"power_recent_24h_mean": (DAY_ROWS, 4), "power_recent_7d_mean": (WEEK_ROWS, 16)}


def past_means(w: WindowSpec) -> dict[str, Column]:
    """Mean of the 96 / 672 rows before each row, once 4 / 16 of them exist."""
    out = {}
    for name, (rows, least) in RECENT.items():
        n, s, _ = _frame(w, rows, ending=1)
        out[name] = F.when(n >= least, F.col("_base") + s / n)
    return out


def head_fill(w: WindowSpec, column: str, total: str = "_len") -> dict[str, Column]:
    """Head rows take the first defined mean. A series too short for one takes its median: at most 16
    rows, which all lie in its first block."""
    block = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    median = F.percentile(F.when(F.col(total) <= 16, F.col(column)), 0.5).over(block)
    return {
        name: F.coalesce(name, F.first(name, True).over(w.rowsBetween(0, least)), median)
        for name, (_, least) in RECENT.items()
    }


def long_steps(column: str, deviations: bool, means: bool) -> list:
    """Window steps of the day / week families of one column; they share its running sums."""
    steps = [lambda w: prefix_sums(w, column), _running]
    if deviations:
        steps += [lambda w: baseline_deviation(w, column), lambda w: z_score(w, column)]
    if means:
        steps += [past_means, lambda w: head_fill(w, column)]
    return steps


def long_families(df: DataFrame, series: Series, column: str, deviations: bool = True, means: bool = True) -> DataFrame:
    """Day / week deviation, z-score and past means of one column."""
    numbered = with_position(df, series, total="_len")
    steps = long_steps(column, deviations, means)
    wide = over_rows(numbered, series, steps, WEEK_ROWS + 1, 16, 8 * WEEK_ROWS, numbered=True)
    return wide.drop(*HELPERS, "pos", "_len")


HELPERS = ("_base", "_x", "_x2", "_cn", "_cx", "_cx2", "_day_std")


def decay(halflife: float) -> float:
    return 0.5 ** (1.0 / halflife)


def ema(df: DataFrame, series: Series, wanted: Mapping[str, tuple[str, float]], numbered: bool = False) -> DataFrame:
    """Exponential means y = (1−a)·y + a·x with a = 1 − 0.5^(1/halflife), first row weight 1.

    Position blocks of 256 rows: inside a block the mean is a scaled running sum; the value carried
    into a block is the decayed sum of the ends of the blocks before it, as far back as 64 half-lives
    (beyond that the weight is below double precision). Keys are (series, block) throughout, so the
    length of a series does not matter.
    """
    placed = df if numbered else with_position(df, series)
    rank = F.pmod("pos", F.lit(EMA_ROWS))
    placed = placed.withColumn("_sub", F.floor(F.col("pos") / F.lit(EMA_ROWS)).cast("long")).withColumn("_r", rank)
    reach = max(math.ceil(EMA_HALF_LIVES * h / EMA_ROWS) + 1 for _, h in wanted.values())

    def gain(column: str, halflife: float) -> Column:
        return F.when(F.col("pos") == 0, F.col(column)).otherwise(F.col(column) * F.lit(1.0 - decay(halflife)))

    block = [*series.key, "_sub"]
    ends = placed.groupBy(*block).agg(
        *[
            F.sum(gain(c, h) * F.pow(F.lit(decay(h)), F.lit(EMA_ROWS - 1) - F.col("_r"))).alias(f"_end_{name}")
            for name, (c, h) in wanted.items()
        ]
    )
    sent = ends.withColumn("_m", F.explode(F.sequence(F.lit(1), F.lit(reach)))).select(
        *series.key,
        (F.col("_sub") + F.col("_m")).alias("_sub"),
        *[
            (F.col(f"_end_{name}") * F.pow(F.lit(decay(h) ** EMA_ROWS), F.col("_m") - 1)).alias(f"_in_{name}")
            for name, (_, h) in wanted.items()
        ],
    )
    carried = sent.groupBy(*block).agg(*[F.sum(f"_in_{name}").alias(f"_in_{name}") for name in wanted])
    inside = Window.partitionBy(*block).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumns(
        {
            f"_own_{name}": F.sum(gain(c, h) * F.pow(F.lit(decay(h)), -F.col("_r"))).over(inside)
            for name, (c, h) in wanted.items()
        }
    )
    joined = local.join(carried, block, "left")
    out = joined.withColumns(
        {
            name: F.pow(F.lit(decay(h)), F.col("_r")) * F.col(f"_own_{name}")
            + F.pow(F.lit(decay(h)), F.col("_r") + 1) * F.coalesce(f"_in_{name}", F.lit(0.0))
            for name, (_, h) in wanted.items()
        }
    ).drop("_sub", "_r", *[f"_own_{n}" for n in wanted], *[f"_in_{n}" for n in wanted])
    return out if numbered else out.drop("pos")


def ema_family(df: DataFrame, series: Series, columns: Sequence[str], numbered: bool = False) -> DataFrame:
    """Fast (2 rows) and slow (24 rows) means and their ratio."""
    wanted = {f"{c}_ema_{h}": (c, float(h)) for c in columns for h in (2, 24)}
    out = ema(df, series, wanted, numbered)
    return out.withColumns({f"{c}_ratio_ema": F.coalesce(over(F.col(f"{c}_ema_2"), F.col(f"{c}_ema_24") + 1.0), F.lit(1.0)) for c in columns})


def temperature_changes(w: WindowSpec, temp: str = "temp_2m") -> dict[str, Column]:
    return {
        "temp_change_3h": F.coalesce(F.col(temp) - F.lag(temp, 12).over(w), F.lit(0.0)),
        "temp_change_24h": F.coalesce(F.col(temp) - F.lag(temp, DAY_ROWS).over(w), F.lit(0.0)),
    }
