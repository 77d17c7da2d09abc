"""Users and their files, from file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Meter and label file names.
BUS_NAME = r"^e241_([^_]+)_([^-]+)-Ch(\d+)-(\d{6})-(\d{6})(-1|-infer)?\.csv$"
BRANCH_NAME = r"^([^-]+)-(\d{6})-(\d{6})(-1|-infer)?\.csv$"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths below `<root>/{trains,infers}/<user>/`; file contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(root)
    return files.select("path")


def parse_files(files: DataFrame, path: str = "path") -> DataFrame:
    """Stage, user, kind, device, channel and period of every file; other names get a NULL kind."""
    pieces = F.split(path, "/")
    name = F.element_at(pieces, -1)
    folder, stage = F.try_element_at(pieces, F.lit(-2)), F.try_element_at(pieces, F.lit(-3))
    is_bus, is_branch = name.rlike(BUS_NAME), name.rlike(BRANCH_NAME)

    def part(bus_group: int, branch_group: int | None) -> Column:
        value = F.when(is_bus, F.regexp_extract(name, BUS_NAME, bus_group))
        return value if branch_group is None else value.when(is_branch, F.regexp_extract(name, BRANCH_NAME, branch_group))

    return files.select(
        F.col(path).alias("path"),
        name.alias("file"),
        stage.alias("stage"),
        folder.alias("user_id"),
        F.when(is_bus, "bus").when(is_branch, "branch").alias("kind"),
        part(1, None).alias("device"),
        part(2, 1).alias("meter"),
        part(3, None).try_cast("int").alias("channel"),
        F.try_to_date(part(4, 2), "yyMMdd").alias("start"),
        F.try_to_date(part(5, 3), "yyMMdd").alias("end"),
    )


def discover_users(parsed: DataFrame) -> DataFrame:
    """One row per user of either stage folder; the first file by name wins per stage and kind."""
    usable = parsed.where(F.col("user_id").contains("_"))

    def first(stage: str, kind: str) -> Column:
        wanted = (F.col("stage") == stage) & (F.col("kind") == kind)
        return F.min(F.when(wanted, F.col("file"))).alias(f"{stage.removesuffix('s')}_{kind}")

    return usable.groupBy("user_id").agg(
        first("trains", "bus"), first("trains", "branch"), first("infers", "bus"), first("infers", "branch"),
        F.min("channel").alias("channel"),
    )


def execution_plan(users: DataFrame, target: str = "target") -> DataFrame:
    """`runnable` and what can be run for each user."""
    runnable = F.col("train_bus").isNotNull() & F.col("train_branch").isNotNull() & F.col(target).isNotNull()
    plan = (
        F.when(~F.col("runnable"), "skip: no training data")
        .when(F.col("infer_bus").isNull(), "train only")
        .when(F.col("infer_branch").isNull(), "train and predict, no scores")
        .otherwise("train, score and predict")
    )
    return users.withColumn("runnable", runnable).withColumn("plan", plan)
