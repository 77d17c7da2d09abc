"""What the operators of this subpackage share: reading, staging, words, held-out rows, connected groups."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Shuffle files otherwise stay on disk until the driver's JVM happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, **options) -> DataFrame:
    """Write to the shared folder and read again: the lineage ends here and survives lost executors.

    The shuffle files of the write go with its end, as no later job reads them.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def removed(*tables: DataFrame) -> None:
    """Delete staged tables, once what was made of them is staged itself."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.rsplit("/", 1)[1].startswith("llm-"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free(name: str, columns: list[str]) -> str:
    """A column name that the input does not use."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text; a null id counts as remainder -1, which is neither held out nor learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % modulus, F.lit(-1))


def words(text: str | None) -> list[bytes]:
    """Maximal runs without 0x20 and 0x09-0x0D, which are just the bytes that bytes.split() splits on."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def chunks(batches, size: int = 8_000_000, text: str = "text"):
    """Record batches cut so that each holds about `size` bytes of text, or one longer row."""
    for b in batches:
        lengths = pc.binary_length(b.column(text)).fill_null(0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > size:
                yield b.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield b.slice(start)


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(a, b) links to (node, component), the component being the smallest node that can be reached.

    Each round every node takes its smallest neighbour, chains of these are cut short, and the links are read between what
    is left, so that links inside of a group are met once. All is staged, nothing but one count reaches the driver. Minima
    are combined before the shuffle, so a hub with most links is no hot task.
    """
    between = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    links = staged(links.select(*between("a", "b")).where("a <> b").distinct())
    label = None
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = shortened(staged(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component"))), most_rounds)
        label = step if label is None else staged(label.join(small(step.select(F.col("node").alias("component"), F.col("component").alias("further")), 16), "component", "left").select("node", F.coalesce("further", "component").alias("component")))
        side = lambda c, to: small(step.select(F.col("node").alias(c), F.col("component").alias(to)), 16)  # noqa: B023, E731
        links = staged(links.join(side("a", "x"), "a").join(side("b", "y"), "b").where("x <> y").select(*between("x", "y")).distinct())
        if links.limit(1).count() == 0:
            return label
    raise RuntimeError(f"groups still grow after {most_rounds} rounds")


def shortened(step: DataFrame, most_rounds: int) -> DataFrame:
    """(node, component) with the end of the chain that each node begins; each round halves the chains."""
    for _ in range(most_rounds):
        further = step.select(F.col("node").alias("component"), F.col("component").alias("end"))
        moved = staged(step.join(small(further, 16), "component").select("node", F.col("component").alias("old"), F.col("end").alias("component")))
        step = moved.select("node", "component")
        if moved.where("component <> old").limit(1).count() == 0:
            return step
    raise RuntimeError(f"chains are longer than 2^{most_rounds}")


# A table is only broadcast after its rows have been counted and found to take less than this.
MOST_BROADCAST = 32_000_000


def small(df: DataFrame, row_bytes: int, most: int = MOST_BROADCAST) -> DataFrame:
    """`df`, which must be cheap to count, marked for broadcast if its rows of about `row_bytes` stay below `most` bytes;
    otherwise as it is, and Spark shuffles the join."""
    return F.broadcast(df) if df.count() * row_bytes <= most else df
