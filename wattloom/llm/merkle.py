"""Merkle manifest of a dataset: levels built bottom up and stored as parent-linked rows, proofs by a recursive query."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import small, staged

ARITY = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The root belongs to no language.
ROOT = -1
# Leaves below one copy of a node, and the most copies of a node: see `copies`.
BLOCK, MOST_COPIES = 64, 4096


@dataclass(frozen=True)
class Manifest:
    """`leaves`: a row per document with its link to its parent. `nodes`: a row per copy of an inner node with the digests
    of its children and its link to its own parent; the root's link is null. `subroots`: a row per language."""

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame


def field(value: Column) -> Column:
    """`-` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(text: str | Column = "text") -> Column:
    values = [F.col(c) for c in FIELDS[:-1]] + [F.col(text) if isinstance(text, str) else text]
    return F.unhex(F.sha2(F.concat(*map(field, values)).cast("binary"), 256))


def joint(digests: Column) -> Column:
    """The digest of digests: sha256 of their hex texts one after the other."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)).cast("binary"), 256))


def copies(level: int) -> int:
    """How many copies of a node of this level are stored. Every leaf climbs through the root; as each block of leaves asks
    its own copy, no copy is asked by more than BLOCK leaves, or by more than the MOST_COPIES-th part of the leaves below."""
    return min(MOST_COPIES, max(1, ARITY**level // BLOCK))


def tampered(text: str = "text", doc_id: str = "doc_id") -> Column:
    """The text in lower case (A-Z alone) where 3 divides the crc32 of the id; else as it is."""
    return F.when(F.crc32(F.col(doc_id).cast("string")) % 3 == 0, F.translate(F.col(text), UPPER, LOWER)).otherwise(F.col(text))


def placed(docs: DataFrame, change: Column) -> DataFrame:
    """lang_no, place among the rows of the language by doc_id, n of the language, doc_id, leaf, changed leaf.

    Rows are sorted by range, so a language of any size is spread over tasks; places come from counts per range.
    """
    leaf = docs.select("doc_id", "lang", leaf_digest().alias("leaf"), F.when(change.eqNullSafe(F.col("text")), None).otherwise(leaf_digest(change)).alias("changed"), F.monotonically_increasing_id().alias("tie"))
    order = ("lang", "doc_id", "leaf", "tie")
    rows = staged(leaf.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie").withColumn("n", F.monotonically_increasing_id()).withColumn("slice", F.shiftright("n", 33)))
    runs = staged(rows.groupBy("lang", "slice").agg(F.min("n").alias("first"), F.count("*").alias("held")))
    langs = runs.groupBy("lang").agg(F.sum("held").alias("of_lang")).withColumn("lang_no", F.row_number().over(Window.orderBy(F.col("lang").asc_nulls_first())) - 1)
    before = Window.partitionBy("lang").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("start", F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("r")
    runs = runs.join(langs.alias("l"), F.col("r.lang").eqNullSafe(F.col("l.lang"))).select("r.lang", "slice", "start", "of_lang", "lang_no")
    runs = staged(runs).alias("r")
    near = rows.alias("d").join(small(runs, 100), F.col("d.lang").eqNullSafe(F.col("r.lang")) & (F.col("d.slice") == F.col("r.slice")))
    return near.select("lang_no", (F.col("n") + F.col("start")).alias("pos"), "of_lang", "doc_id", "d.lang", "leaf", F.coalesce("changed", "leaf").alias("changed"))


def linked(df: DataFrame, level: int) -> DataFrame:
    """Adds the link of nodes of `level`: parent (up_lang, up_level, up_pos), its number of copies, the slot below it.
    The last node of a language hangs below the root."""
    top = F.col("n") == 1
    return df.select(
        "*",
        F.when(top, ROOT).otherwise(F.col("lang_no")).alias("up_lang"),
        F.when(top, 0).otherwise(level + 1).alias("up_level"),
        F.when(top, 0).otherwise(F.floor(F.col("pos") / ARITY)).cast("long").alias("up_pos"),
        F.when(top, MOST_COPIES).otherwise(copies(level + 1)).cast("long").alias("up_copies"),
        F.when(top, F.col("lang_no")).otherwise(F.col("pos") % ARITY).cast("int").alias("slot"),
    )


def build(docs: DataFrame, change: Column | None = None) -> Manifest:
    """The manifest of the documents; each leaf also holds the digest of the row with its text changed by `change`.

    Any column of a row may be null (a null language is one of its own, the first); leaves of one doc_id are ordered
    by their digests, so repeated rows are leaves side by side. Other columns are not read. An empty table has no rows.
    One short job per level; each level is written before the next reads it.
    """
    rows = placed(docs.select(*FIELDS), F.col("text") if change is None else change)
    leaves = staged(linked(rows.withColumnRenamed("of_lang", "n"), 0))
    most = leaves.agg(F.max("n")).first()[0] or 0
    below, stored, tops = leaves.select("lang_no", "lang", "pos", "n", F.col("leaf").alias("digest")), [], []
    level = 0
    while True:
        tops.append(below.where("n = 1").select("lang_no", "lang", "digest"))
        if most <= 1:
            break
        level += 1
        run = F.transform(F.sort_array(F.collect_list(F.struct("pos", "digest"))), lambda c: c.digest)
        up = below.where("n > 1").groupBy("lang_no", F.floor(F.col("pos") / ARITY).cast("long").alias("pos")).agg(F.first("lang").alias("lang"), F.first("n").alias("n"), F.array_join(F.transform(run, lambda d: F.hex(d)), "").alias("hex"))
        up = up.select("lang_no", "lang", "pos", F.ceil(F.col("n") / ARITY).cast("long").alias("n"), F.unhex("hex").alias("children"))
        written = staged(linked(up.withColumn("digest", joint(F.col("children"))), level))
        stored.append(written.withColumn("level", F.lit(level)))
        below, most = written.select("lang_no", "lang", "pos", "n", "digest"), -(-most // ARITY)
    subroots = tops[0]
    for t in tops[1:]:
        subroots = subroots.unionByName(t)
    subroots = staged(subroots)
    every = F.transform(F.sort_array(F.collect_list(F.struct("lang_no", "digest"))), lambda c: F.hex(c.digest))
    root = subroots.agg(F.unhex(F.array_join(every, "")).alias("children")).withColumn("digest", joint(F.col("children")))
    root = staged(root)
    columns = ["lang_no", "level", "pos", "copy", "children", "up_lang", "up_level", "up_pos", "up_copies", "slot"]
    nodes = root.select(F.lit(ROOT).alias("lang_no"), F.lit(0).alias("level"), F.lit(0).cast("long").alias("pos"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(MOST_COPIES - 1).cast("long"))).alias("copy"), "children")
    for name, kind in zip(columns[5:], ("int", "int", "long", "long", "int"), strict=True):
        nodes = nodes.withColumn(name, F.lit(None).cast(kind))
    for height, one in enumerate(stored, 1):
        copy = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies(height) - 1).cast("long")))
        nodes = nodes.unionByName(one.withColumn("copy", copy).select(columns))
    return Manifest(leaves, staged(nodes), subroots.withColumn("root", F.lit(bytes(root.first()["digest"]))))


CLIMB = f"""
WITH RECURSIVE climb AS (
  SELECT lang_no, pos, doc_id, leaf, up_lang, up_level, up_pos, up_copies, slot, changed AS folded, CAST(NULL AS BINARY) AS siblings, 0 AS height
  FROM {{leaves}}
  UNION ALL
  SELECT c.lang_no, c.pos, CAST(NULL AS BIGINT), CAST(NULL AS BINARY), n.up_lang, n.up_level, n.up_pos, n.up_copies, n.slot,
    unhex(sha2(CAST(concat(lower(hex(substring(n.children, 1, 32 * c.slot))), lower(hex(c.folded)), lower(hex(substring(n.children, 32 * c.slot + 33)))) AS BINARY), 256)),
    concat(substring(n.children, 1, 32 * c.slot), substring(n.children, 32 * c.slot + 33)),
    c.height + 1
  FROM climb c JOIN {{nodes}} n ON n.lang_no = c.up_lang AND n.level = c.up_level AND n.pos = c.up_pos AND n.copy = (c.pos DIV {BLOCK}) % c.up_copies
)
SELECT lang_no, pos, doc_id, leaf, up_lang, folded, siblings, height FROM climb
"""


def climb(manifest: Manifest) -> DataFrame:
    """Every step of every leaf to the root: the siblings met there, and the changed leaf folded with them.

    The recursive query joins the leaves' links with the stored nodes, one level a round; a row that reached the root has
    no link left. Each round carries one digest per leaf and not the proof, whose parts stay in the rounds' rows.
    """
    spark = manifest.leaves.sparkSession
    # The bounds of rows and rounds are meant for runaway recursion; here links end at the root.
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    leaves = manifest.leaves.select("lang_no", "pos", "doc_id", "leaf", "changed", "up_lang", "up_level", "up_pos", "up_copies", "slot")
    return spark.sql(CLIMB, leaves=leaves, nodes=manifest.nodes)


def proofs(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (digests of all siblings, level by level, left to right), folded_root, verified."""
    steps = climb(manifest)
    whole = steps.groupBy("lang_no", "pos").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("leaf").alias("leaf"),
        F.max(F.when(F.col("up_lang").isNull(), F.col("folded"))).alias("folded"),
        F.sort_array(F.collect_list(F.struct("height", F.coalesce("siblings", F.lit(b"")).alias("siblings")))).alias("steps"),
    )
    got = whole.join(small(manifest.subroots.select("lang_no", F.col("digest").alias("subroot"), "root"), 200), "lang_no")
    proof = F.unhex(F.array_join(F.transform("steps", lambda s: F.hex(s.siblings)), ""))
    return got.select("doc_id", "leaf", "subroot", "root", proof.alias("proof"), F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def verified_proofs(docs: DataFrame) -> DataFrame:
    """Proof digests and the roots that tampered rows fold to, as hex."""
    got = proofs(build(docs, tampered()))

    def text(name):
        return F.lower(F.hex(name)).alias(name)

    return got.select("doc_id", text("leaf"), text("subroot"), text("root"), F.sha2(F.lower(F.hex("proof")).cast("binary"), 256).alias("proof_sha256"), text("folded_root"), "verified")
