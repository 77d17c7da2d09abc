"""The complete feature table and its SQL twin, put together from the twins of the feature families."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from wattloom.catalog.aligned import SQL_QUARTER
from wattloom.catalog.drifts import SQL_LUT, SQL_TEMPS
from wattloom.catalog.features import COLS, SQL_CALENDAR, SQL_TEMPERED, SQL_WEATHER_FEATURES, feature_table, sql_ema, sql_features
from wattloom.catalog.registry import ORACLE, query
from wattloom.catalog.views import SQL_HOURLY, settled, sql_round
from wattloom.plans.features import feature_names

FEATURES = feature_names(["site_id", "ts", "w", "v", "d_min5", "d_max5"], list(COLS), "d", True, True, True)
FAMILIES = (
    "spike_memory", "rolling_differences", "rolling_mean_std", "lag_values", "absolute_differences", "rolling_ranges", "rolling_texture",
    "rolling_quartiles", "rolling_slopes", "baseline_deviation", "past_means",
)
SQL_JUMPS = sql_features({f"{c}_{way}_d1": f"CAST(COALESCE({c} - lag({c}) OVER w, 0) {sign} AS INT)" for c in COLS for way, sign in (("up", "> 50"), ("down", "< -50"))})


def unrounded(sql: str, digits: int) -> str:
    """The same columns without their rounding, which is done once at the end."""
    return re.sub(rf"ROUND\(((?:[^()]|\((?:[^()]|\([^()]*\))*\))*), {digits}\) AS", r"(\1) AS", sql)


SQL_WEATHER = unrounded(SQL_WEATHER_FEATURES, 6)
SQL_TIMES = unrounded(SQL_CALENDAR.replace("user_id, ts", "site_id, ts", 1), 9) + f"({SQL_HOURLY})"
SQL_AIR = f"SELECT h.site_id, h.ts, temperature_2m + 1.5 AS apparent_temp, 70.0::DOUBLE AS humidity FROM ({SQL_HOURLY}) h JOIN ({SQL_QUARTER}) q ON q.site_id = h.site_id AND q.time = h.ts"
SQL_RATIOS = f"SELECT site_id, ts, w, v, d_min5, d_max5, COALESCE(ABS(w) / GREATEST(ABS(v), 5), 1) AS ratio_w_over_v FROM ({SQL_HOURLY})"
SQL_RESIDUAL = (
    SQL_LUT.replace(SQL_TEMPS, f"SELECT site_id, ts, w, temp_2m AS temp, TRUE AS train FROM ({SQL_TEMPERED})")
    + """, h AS (SELECT t.site_id, t.ts, arg_max(expected_signal, bin_id) AS e FROM t JOIN lut ON lut.site_id = t.site_id AND temp BETWEEN temp_lo AND temp_hi GROUP BY 1, 2)
  SELECT t.site_id, t.ts, w - COALESCE(h.e, med) AS temp_power_residual FROM t JOIN gl USING (site_id) LEFT JOIN h USING (site_id, ts)"""
)
PARTS = [SQL_RATIOS, *(ORACLE[f] for f in FAMILIES), SQL_JUMPS, *(sql_ema(c) for c in COLS), SQL_WEATHER, SQL_TIMES, SQL_AIR, SQL_RESIDUAL]
SQL_TABLE = f"""SELECT site_id, ts, {", ".join(f'{sql_round(c, 6)} AS "{c}"' for c in FEATURES)}
  FROM {" JOIN ".join(f"(SELECT * FROM ({part}))" + (" USING (site_id, ts)" if i else "") for i, part in enumerate(PARTS))}"""


@query(SQL_TABLE)
def feature_table_rows(spark: SparkSession, sf: str) -> DataFrame:
    """SCL-15: all rows and columns of the feature table."""
    return settled(feature_table(spark, sf), 6, *FEATURES)
