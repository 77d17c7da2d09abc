"""Execution state of batch users: repair, upsert, resume."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from wattloom.sources.meters import last_per_key
from wattloom.sources.versions import read_version, upsert_version

SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("success", T.BooleanType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("finished_at", T.TimestampNTZType()),
        T.StructField("duration_s", T.DoubleType()),
        T.StructField("message", T.StringType()),
        T.StructField("target_col", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)
DONE = ("ok", "soft_skip")


def empty_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def inspect_state(spark: SparkSession, path: str) -> DataFrame:
    """Every line of a stored state file: the state columns, `raw`, and `damaged`.

    Columns are known by the header, in any order; missing ones are NULL, others are passed over. `raw` is the line as it
    was where a value does not have its type (then NULL) or the line has too few or too many values. Such lines and those
    without a user are damaged. A file without a user column holds no state: all its lines are damaged.
    """
    names = spark.read.option("header", True).csv(path).columns
    kinds = {f.name: f.dataType for f in SCHEMA}
    raw = free_name("_raw", names)
    schema = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names]).add(raw, T.StringType())
    # Without pruning: how many values a line has must not depend on the columns that are read.
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnPruning", False)
    lines = reader.option("columnNameOfCorruptRecord", raw).csv(path)
    columns = {f.name: F.col(f.name) if f.name in names else F.lit(None).cast(f.dataType) for f in SCHEMA}
    damaged = F.col(raw).isNotNull() | columns["user_id"].isNull()
    return lines.select(*[c.alias(n) for n, c in columns.items()], F.col(raw).alias("raw"), damaged.alias("damaged"))


def free_name(name: str, taken: Sequence[str]) -> str:
    while name in taken:
        name += "_"
    return name


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a stored state that name a user, damaged values NULL; a missing or unreadable file counts as empty."""
    try:
        return inspect_state(spark, path).where("user_id IS NOT NULL").drop("raw", "damaged")
    except AnalysisException:
        return empty_state(spark)


def upsert(state: DataFrame, rows: DataFrame, key: str = "user_id") -> DataFrame:
    """New rows replace the stored row of their user; of several the latest finished one stays."""
    both = state.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return last_per_key(both, [key], ["_new", "finished_at", "started_at"]).drop("_new")


def save_state(state: DataFrame, path: str) -> str:
    """Write the state as a CSV folder that must not exist, and return its path."""
    state.write.mode("error").option("header", True).csv(path)
    return path


def store_state(rows: DataFrame, base: str) -> int:
    """Upsert the rows of a run into the stored table; returns the number of its new version."""
    return upsert_version(rows, base, ["user_id"], ["finished_at", "started_at"])


def stored_state(spark: SparkSession, base: str) -> DataFrame:
    held = read_version(spark, base)
    return empty_state(spark) if held is None else held


def completed(state: DataFrame, with_failed: bool = False) -> DataFrame:
    wanted: Sequence[str] = (*DONE, "fail") if with_failed else DONE
    return state.where(F.col("status").isin(*wanted)).select("user_id")


def resume_set(users: DataFrame, state: DataFrame, with_failed: bool = False) -> DataFrame:
    """Users that still have to run."""
    return users.join(completed(state, with_failed), "user_id", "left_anti")


def run_summary(state: DataFrame) -> DataFrame:
    return state.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_users"), F.sum("duration_s").alias("total_s"), F.avg("duration_s").alias("mean_s")
    )


def skip_distribution(status: DataFrame) -> DataFrame:
    return status.where("skip_reason IS NOT NULL").groupBy("skip_reason").agg(F.count(F.lit(1)).alias("n_users"))
