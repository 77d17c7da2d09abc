"""Column expressions shared by features, guards and reports."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MISSING_SENTINEL = -2147483648
ON_THRESHOLD_W = 10.0
SEASONS = ("summer", "transition", "winter")
SUMMER_FROM_C = 22.0
WINTER_TO_C = 12.0
# Month -> long-term mean temperature (°C).
MONTH_MEAN_C = {
    1: 4.3, 2: 6.2, 3: 11.0, 4: 17.2, 5: 22.1, 6: 26.0,
    7: 28.9, 8: 28.5, 9: 23.7, 10: 17.6, 11: 11.5, 12: 6.3,
}
TRUE_WORDS = ("true", "1", "yes", "y", "on")
FALSE_WORDS = ("false", "0", "no", "n", "off")


def over(a: Column, b: Column) -> Column:
    """a / b, NULL where b is 0 (plain division by zero fails a job in ANSI mode)."""
    return a / F.when(b != 0, b)


def pearson(a: Column, b: Column) -> Column:
    """Correlation of the rows that have both values; NULL when one side is constant."""
    both_a, both_b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return over(F.covar_pop(a, b), F.stddev_pop(both_a) * F.stddev_pop(both_b))


def clip(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(float(low))), F.lit(float(high))))


def sentinel_to_null(x: Column, sentinel: float = MISSING_SENTINEL) -> Column:
    return F.when((x != F.lit(sentinel)) & ~F.isnan(x.cast("double")), x)


def on_state(power: Column, threshold=ON_THRESHOLD_W) -> Column:
    threshold = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (power >= threshold).cast("int")


def month_mean_temp(month: Column) -> Column:
    pairs = [F.lit(v) for item in MONTH_MEAN_C.items() for v in item]
    return F.create_map(*pairs)[month]


def season_by_month(ts: Column) -> Column:
    month = F.month(ts)
    return (
        F.when(month.between(5, 9), "summer")
        .when(month.isin(12, 1, 2), "winter")
        .when(month.isNotNull(), "transition")
    )


def season_by_temp(day_mean: Column, summer_from: float = SUMMER_FROM_C, winter_to: float = WINTER_TO_C) -> Column:
    return F.when(day_mean <= winter_to, "winter").when(day_mean >= summer_from, "summer").otherwise("transition")


def calendar(ts: Column) -> dict[str, Column]:
    hour, dow, doy = F.hour(ts), F.weekday(ts), F.dayofyear(ts)
    day_angle = hour * F.lit(2 * math.pi / 24)
    year_angle = doy * F.lit(2 * math.pi / 365.25)
    return {
        "hour": hour,
        "dow": dow,
        "is_evening": ((hour >= 18) | (hour <= 1)).cast("int"),
        "is_weekend": (dow >= 5).cast("int"),
        "sin_hour": F.sin(day_angle),
        "cos_hour": F.cos(day_angle),
        "month": F.month(ts),
        "sin_doy": F.sin(year_angle),
        "cos_doy": F.cos(year_angle),
    }


def morning_peak(ts: Column) -> Column:
    return F.hour(ts).between(9, 11).cast("int")


def cooling_degree(temp: Column) -> Column:
    return F.when(temp.isNotNull(), F.greatest(temp - 26.0, F.lit(0.0)))


def heating_degree(temp: Column) -> Column:
    return F.when(temp.isNotNull(), F.greatest(16.0 - temp, F.lit(0.0)))


def spike_features(low: Column, high: Column, event_w: float = 50.0) -> dict[str, Column]:
    """Start-up spike features from the extremes of one bin."""
    jump = F.coalesce(high - low, F.lit(0.0))
    down = F.coalesce(low < -event_w, F.lit(False))
    up = F.coalesce(high > event_w, F.lit(False))
    return {
        "d87_jump_abs5": jump,
        "d87_amax5": F.coalesce(F.greatest(F.abs(high), F.abs(low)), F.lit(0.0)),
        "d87_event_neg": down.cast("int"),
        "d87_event_pos": up.cast("int"),
        "d87_event_any": (down | up).cast("int"),
        "d87_spike_ratio": jump / F.coalesce(F.abs(high) + F.abs(low) + 5.0, F.lit(5.0)),
    }


def floored_ratio(a: Column, b: Column, floor: float, default: float) -> Column:
    return F.coalesce(F.abs(a) / F.greatest(F.abs(b), F.lit(float(floor))), F.lit(float(default)))


def deviation_ratio(signal: Column, baseline: Column) -> Column:
    safe = F.when(baseline != 0, baseline)
    return clip(F.coalesce(signal / safe, F.lit(1.0)), 0.0, 5.0)


def sqrt_interp(n: Column, n_ref: int, low: float, high: float) -> Column:
    share = clip(n / F.lit(float(max(1, n_ref))), 0.0, 1.0)
    return F.lit(low) + F.lit(high - low) * F.sqrt(share)


def soft_max_weight(a: Column, b: Column, pivot: float = 15.0, temperature: float = 8.0) -> Column:
    return 1.0 / (1.0 + F.exp(-(F.abs(a - b) - pivot) / temperature))


def soft_max(a: Column, b: Column, pivot: float = 15.0, temperature: float = 8.0) -> Column:
    """Between the mean of two bounds (small gap) and the larger one (wide gap)."""
    w = soft_max_weight(a, b, pivot, temperature)
    return w * F.greatest(a, b) + (1.0 - w) * (a + b) / 2.0


def energy_kwh(sum_w: Column, step_h) -> Column:
    return sum_w * step_h / 1000.0


def drift_level(ratio: Column, warn: float = 0.10, alert: float = 0.25) -> Column:
    return F.when(F.abs(ratio) >= alert, "ALERT").when(F.abs(ratio) >= warn, "WARN").otherwise("NORMAL")


def lut_flag(ratio: Column, warn: float = 0.15, alert: float = 0.30) -> Column:
    return (
        F.when(ratio.isNull(), "NO_DATA")
        .when(F.abs(ratio) >= alert, "ALERT")
        .when(F.abs(ratio) >= warn, "WARN")
        .otherwise("OK")
    )


def parse_bool(text: Column) -> Column:
    """Config words to BOOLEAN; other numbers are true when non-zero, other text is NULL."""
    word = F.lower(F.trim(text))
    return (
        F.when(word.isin(*TRUE_WORDS), True)
        .when(word.isin(*FALSE_WORDS), False)
        .otherwise(word.try_cast("double") != 0)
    )


def parse_number(text: Column, low: float, high: float) -> Column:
    value = F.trim(text).try_cast("double")
    return F.when(value.between(low, high), value)


def parse_count(text: Column) -> Column:
    value = F.trim(text).try_cast("double").cast("long")
    return F.when(value >= 0, value.cast("int"))


def normal_ratios(ratios: Column) -> Column:
    """Three positive numbers scaled to sum 1; NULL when they are not that."""
    numbers = F.transform(ratios, lambda r: r.try_cast("double"))
    total = F.aggregate(numbers, F.lit(0.0), lambda acc, r: acc + r)
    valid = (F.size(numbers) == 3) & F.forall(numbers, lambda r: r.isNotNull() & (r > 0))
    scaled = F.when(F.abs(total - 1.0) > 1e-6, F.transform(numbers, lambda r: r / total)).otherwise(numbers)
    return F.when(valid, scaled)


TARGET_PATTERN = r"^p\d+(\+p\d+)*$"


def normal_target(name: Column) -> Column:
    """`p1`, `P1 + p2` … without blanks, lower case; NULL if malformed or with a repeated part."""
    plain = F.lower(F.regexp_replace(name, r"\s+", ""))
    parts = F.split(plain, r"\+")
    return F.when(plain.rlike(TARGET_PATTERN) & (F.size(F.array_distinct(parts)) == F.size(parts)), plain)


def round_even(x: Column) -> Column:
    """Nearest integer, halves to the even one."""
    return F.rint(x).cast("long")
