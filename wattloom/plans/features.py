"""The feature table: every family over one position-blocked window, in a fixed column order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.functions.scalars import (
    calendar,
    cooling_degree,
    deviation_ratio,
    floored_ratio,
    heating_degree,
    month_mean_temp,
    morning_peak,
    spike_features,
)
from wattloom.operators import windows as win
from wattloom.operators.joins import daily_as_of, lookup_bins
from wattloom.operators.resample import daily_extremes
from wattloom.operators.series import Series, over_rows, with_position
from wattloom.plans.align import SPIKE, with_weather

SUFFIXES = ("_max5", "_min5", "_absmax5")
WEATHER = (
    "temp_2m", "apparent_temp", "humidity", "temp_day_max", "temp_day_min", "temp_day_mean", "temp_diurnal_range",
    "temp_deviation", "temp_change_3h", "temp_change_24h", "cooling_degree", "heating_degree",
)
DRIFT = ("power_recent_24h_mean", "power_recent_7d_mean", "power_deviation_24h", "temp_power_residual", "is_morning_peak")
CALENDAR = ("hour", "dow", "is_evening", "is_weekend", "sin_hour", "cos_hour", "month", "sin_doy", "cos_doy")


def feature_names(columns: Sequence[str], top: Sequence[str], spike: str = SPIKE, weather: bool = True, drift: bool = True, physics: bool = False) -> list[str]:
    """Names in training order for an aligned table with the given columns."""
    names = list(top) + [c for c in columns if c.endswith(SUFFIXES) and c not in top]
    if f"{spike}_min5" in columns and f"{spike}_max5" in columns:
        names += ["d87_jump_abs5", "d87_amax5", "d87_event_neg", "d87_event_pos", "d87_event_any", "d87_event_recent_3", "d87_spike_ratio"]
    names += [f"{c}_d1" for c in top[:10]]
    names += [f"{c}_{s}" for c in top[:5] for s in ("rm4", "rs4")]
    names += [f"{c}_lag{k}" for c in top[:3] for k in (1, 2)]
    names += [f"{c}_d{k}" for c in top[:10] for k in (3, 6)]
    names += [f"{c}_abs_d{k}" for c in top[:5] for k in (1, 3)]
    names += [f"{c}_{s}_d1" for c in top[:3] for s in ("up", "down")]
    names += [f"{c}_range_{n}" for c in top[:3] for n in (4, 12)]
    names += [f"{c}_{s}" for c in top[:3] for s in ("ema_2", "ema_24", "ratio_ema")]
    if physics:
        names += physics_names(columns, top, spike)
    names += CALENDAR
    if weather:
        names += WEATHER
    return names + list(DRIFT) if drift else names


def physics_names(columns: Sequence[str], top: Sequence[str], spike: str = SPIKE) -> list[str]:
    main = top[0]
    names = [f"{c}_{s}_{n}" for c in top[:3] for n in (4, 12, 24) for s in ("std", "cv")]
    names += [f"{main}_{s}_{n}" for n in (4, 12) for s in ("p25", "p75", "iqr")]
    names += [f"{main}_slope_4", f"{main}_slope_12"] + ([f"{top[1]}_slope_4"] if len(top) > 1 else [])
    names += [f"{main}_dev_24h", f"{main}_dev_7d", f"{main}_z_24h"]
    names += [f"ratio_{main}_over_{c}" for c in top[1:3]]
    return names + (["ratio_d87_over_main"] if spike in columns else [])


def build_features(
    df: DataFrame,
    series: Series,
    top: Sequence[str],
    spike: str = SPIKE,
    weather: DataFrame | None = None,
    place: Sequence[str] = (),
    lut: DataFrame | None = None,
    physics: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Feature columns for all series at once.

    `weather` is quarter-hourly per `place` (columns of df); `lut` is a temperature table per key
    and switches the drift family on. Rolling sums over 96 / 672 rows are differences of running
    sums inside a block; only the temperature lookup and the short-series median need other tables.
    """
    keys, ts = list(series.key), series.ts
    main = top[0]
    drift = lut is not None
    has_spike = f"{spike}_min5" in df.columns and f"{spike}_max5" in df.columns
    # Positions and decayed means come first, so their narrow second pass does not repeat the joins.
    wide = win.ema_family(with_position(df, series, total="_len"), series, top[:3], numbered=True)
    if has_spike:
        wide = wide.withColumns(spike_features(F.col(f"{spike}_min5"), F.col(f"{spike}_max5")))
    wide = wide.withColumns(calendar(F.col(ts)))
    if weather is not None:
        wide = with_weather(wide, weather, place, ts)
        daily = daily_extremes(weather, place, "temperature_2m")
        wide = daily_as_of(wide, df, daily, place, ts, ["temp_day_max", "temp_day_min", "temp_day_mean"])
        wide = wide.withColumns(
            {
                "temp_diurnal_range": F.col("temp_day_max") - F.col("temp_day_min"),
                "temp_deviation": F.col("temp_day_mean") - month_mean_temp(F.month(ts)),
                "cooling_degree": cooling_degree(F.col("temp_2m")),
                "heating_degree": heating_degree(F.col("temp_2m")),
            }
        )

    def short(w):
        out = {
            **win.differences(w, top[:10], {"d1": 1, "d3": 3, "d6": 6}),
            **win.short_stats(w, top[:5]),
            **win.lags(w, top[:3]),
            **win.absolute_differences(w, top[:5]),
            **win.jump_flags(w, top[:3]),
            **win.ranges(w, top[:3]),
        }
        if has_spike:
            out |= win.event_memory(w, "d87_event_any")
        if weather is not None:
            out |= win.temperature_changes(w)
        if physics:
            out |= {**win.texture(w, top[:3]), **win.quartiles(w, main), **win.slopes(w, main, (4, 12))}
            if len(top) > 1:
                out |= win.slopes(w, top[1], (4,))
        return out

    steps, before, after, block = [short], win.DAY_ROWS, 0, 4_096
    if physics or drift:
        steps += win.long_steps(main, physics, drift)
        before, after, block = win.WEEK_ROWS + 1, 16, 8 * win.WEEK_ROWS
    table = over_rows(wide, series, steps, before, after, block, numbered=True)
    if physics:
        ratios = {f"ratio_{main}_over_{c}": floored_ratio(F.col(main), F.col(c), 5.0, 1.0) for c in top[1:3]}
        if spike in df.columns:
            ratios["ratio_d87_over_main"] = floored_ratio(F.col(spike), F.col(main), 50.0, 0.0)
        table = table.withColumns(ratios)
    if drift:
        table = table.withColumn("power_deviation_24h", deviation_ratio(F.col(main), F.col("power_recent_24h_mean")))
        table = table.withColumn("is_morning_peak", morning_peak(F.col(ts)))
        if weather is not None:
            table = lookup_bins(table, lut, keys, "temp_2m", "_expected")
            table = table.withColumn("temp_power_residual", F.col(main) - F.col("_expected"))
        else:
            table = table.withColumn("temp_power_residual", F.lit(0.0))
    names = feature_names(df.columns, top, spike, weather is not None, drift, physics)
    return table.select(*keys, *series.order, *keep, *[F.col(c).cast("double").alias(c) for c in names])

