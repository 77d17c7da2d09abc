"""Session settings the library relies on, and the shared folder for checkpoints."""

from __future__ import annotations

import re
import tempfile
import threading
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Meter timestamps are naive local time (TIMESTAMP_NTZ); a UTC session keeps second arithmetic exact.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Python workers get texts in pieces of this size, whatever their lengths.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else created; its Python workers find this package."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parent.parent))
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """Small session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wattloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


_LOCAL: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names. Only a session on one machine may do without and gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="wattloom-")
        folder = _LOCAL[app]
    return folder


_FOLDER = threading.Lock()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    context = df.sparkSession.sparkContext
    with _FOLDER:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint(eager=True)
