"""Tables that are replaced as a whole: every version is a folder of its own, a pointer to it is written last.

Readers follow the newest pointer, so a write that fails, or an executor lost in it, leaves the old version as it was.
Pointers are rows of a small table, added by one committed file each. Old versions are not removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.sources.meters import first_per_key, last_per_key

POINTERS = "number BIGINT, folder STRING"


def pointers(spark: SparkSession, base: str) -> DataFrame:
    try:
        return spark.read.schema(POINTERS).json(f"{base}/_versions")
    except AnalysisException:
        return spark.createDataFrame([], POINTERS)


def current(spark: SparkSession, base: str) -> tuple[int, str] | None:
    """Number and folder of the newest version; of two that were written at once, the one whose folder sorts last."""
    row = pointers(spark, base).orderBy(F.desc("number"), F.desc("folder")).first()
    return None if row is None else (row["number"], row["folder"])


def read_version(spark: SparkSession, base: str) -> DataFrame | None:
    """The newest version, or None where none was finished."""
    newest = current(spark, base)
    return None if newest is None else spark.read.parquet(f"{base}/{newest[1]}")


def write_version(df: DataFrame, base: str, partition_by: Sequence[str] = ()) -> int:
    """Write a version and then the pointer to it; returns its number."""
    spark = df.sparkSession
    newest = current(spark, base)
    number = 1 if newest is None else newest[0] + 1
    folder = f"v{number:08d}-{uuid.uuid4().hex[:12]}"
    df.write.mode("error").partitionBy(*partition_by).parquet(f"{base}/{folder}")
    point_to(spark, base, number, folder)
    return number


def point_to(spark: SparkSession, base: str, number: int, folder: str) -> None:
    spark.createDataFrame([(number, folder)], POINTERS).coalesce(1).write.mode("append").json(f"{base}/_versions")


def upsert_version(rows: DataFrame, base: str, keys: Sequence[str], order: Sequence[str], keep: str = "new", partition_by: Sequence[str] = ()) -> int:
    """Merge rows into the table: one row per key, NULL keys included.

    `keep="new"`: the new row replaces the stored one, and the last of several new ones by `order` stays. `keep="old"`:
    a stored row stays and of several new ones the first by `order` is added. Columns that one side lacks are NULL there.
    """
    stored = read_version(rows.sparkSession, base)
    marked = rows.withColumn("_round", F.lit(1))
    both = marked if stored is None else stored.withColumn("_round", F.lit(0)).unionByName(marked, allowMissingColumns=True)
    pick = last_per_key if keep == "new" else first_per_key
    return write_version(pick(both, list(keys), ["_round", *order]).drop("_round"), base, partition_by)
