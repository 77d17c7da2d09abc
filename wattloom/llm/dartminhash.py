"""Near duplicates by DartMinHash: hashed darts in weighted element regions, the earliest per coordinate."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import batch, chunks, components, small, staged
from wattloom.llm.exchange import pack, pack_sorted, unpack, unpack_sorted, window_hashes
from wattloom.llm.tiling import token_hashes

ROWS, BANDS = 6, 40
COORDINATES = ROWS * BANDS
SHINGLE = 5
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = x + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def weighted_shingles(flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, weight) sorted by text and hash, from the token hashes and the number of tokens of each
    text: runs of SHINGLE words with their number of occurrences; a shorter text is one shingle, one without words has none."""
    row = np.repeat(np.arange(len(counts)), counts)
    got = window_hashes(flat, SHINGLE)
    own = row[: len(got)] == row[SHINGLE - 1 :] if len(got) else np.zeros(0, bool)
    keys, rows = got[own], row[: len(got)][own]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        first = np.cumsum(counts) - counts
        keys = np.concatenate([keys, np.concatenate([window_hashes(flat[first[r] : first[r] + counts[r]], int(counts[r])) for r in short])])
        rows = np.concatenate([rows, short])
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    start = np.flatnonzero(np.r_[True, (np.diff(rows) != 0) | (keys[1:] != keys[:-1])]) if len(keys) else np.zeros(0, np.int64)
    return rows[start], keys[start], np.diff(start, append=len(keys))


def signatures(rows: np.ndarray, keys: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """n x COORDINATES: an id of the earliest dart for each coordinate.

    An element of weight w owns w unit regions (element, 1..w). Darts fall on a region as a Poisson process
    over rank whose gaps come from hashes of the region, so equal regions get equal darts in every text. Only
    ranks up to a bound are thrown: the bound makes about k (ln k + 4) darts whatever the size of the set,
    and is doubled for texts with a coordinate left empty.
    """
    best = np.full((n, COORDINATES), np.iinfo(np.uint64).max, np.uint64)
    total = np.bincount(rows, weights, n)
    cell_row = np.repeat(rows, weights)
    number = np.arange(len(cell_row)) - np.repeat(np.cumsum(weights) - weights, weights)
    cells = mixed(np.repeat(keys, weights) + number.astype(np.uint64) * _B, 0)
    bound = np.where(total > 0, COORDINATES * (np.log(COORDINATES) + 4) / np.maximum(total, 1), 0)
    todo = np.ones(n, bool)
    while todo.any():
        use = todo[cell_row]
        cell, row = cells[use], cell_row[use]
        rank = np.zeros(len(cell))
        dart = 0
        while len(cell):
            dart += 1
            h = mixed(cell, dart)
            rank = rank - np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53))
            inside = rank <= bound[row]
            cell, row, rank, h = cell[inside], row[inside], rank[inside], h[inside]
            h = mixed(h, 1)
            at = row * COORDINATES + (h >> np.uint64(32)).astype(np.int64) % COORDINATES
            # Ranks are positive, so the bits of a 32-bit float sort as the rank does; the id breaks ties.
            value = rank.astype(np.float32).view(np.uint32).astype(np.uint64) << np.uint64(32) | (h & np.uint64(0xFFFFFFFF))
            np.minimum.at(best.reshape(-1), at, value)
        todo = (best == np.iinfo(np.uint64).max).any(1) & (total > 0)
        bound = bound * 2
    return (best & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """n x BANDS keys of ROWS coordinates each."""
    got = np.zeros((len(signature), BANDS), np.uint64)
    for r in range(ROWS):
        got = mixed(got ^ signature[:, r::ROWS].astype(np.uint64), r)
    return mixed(got + np.arange(BANDS, dtype=np.uint64) * _A, ROWS).view(np.int64)


SIGNED = pa.schema([("doc_id", pa.int64()), ("content", pa.int64()), ("content2", pa.int64()), ("signature", pa.binary()), ("keys", pa.list_(pa.int64()))])


def content_of(hashes: np.ndarray) -> np.ndarray:
    """128 bits that stand for the tokens of a text."""
    return np.frombuffer(xxhash.xxh3_128_digest(hashes.tobytes()), np.int64)


def signed(docs: DataFrame) -> DataFrame:
    """Documents with an id and a token: 128 bits of the tokens, the signature and its band keys."""

    def run(batches):
        for b in chunks(batches, 4_000_000):
            flat, counts = token_hashes(b.column("text"))
            got = signatures(*weighted_shingles(flat, counts), len(counts))
            keys = band_keys(got)
            out = []
            for i, (doc_id, own) in enumerate(zip(b.column("doc_id").to_pylist(), np.split(flat, np.cumsum(counts)[:-1]), strict=True)):
                if doc_id is not None and len(own):
                    digest = content_of(own)
                    out.append((doc_id, int(digest[0]), int(digest[1]), got[i].tobytes(), keys[i]))
            if out:
                yield batch(SIGNED, *zip(*out, strict=True))

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, content bigint, content2 bigint, signature binary, keys array<bigint>")


def estimated(pairs: DataFrame, one: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose signatures agree on the share `least` of the coordinates or more."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for b in batches:
            if b.num_rows:
                left, right = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint32).reshape(b.num_rows, -1) for c in ("left", "right"))
                near = (left == right).mean(1) >= least
                yield batch(schema, *[b.column(c).filter(pa.array(near)) for c in ("a", "b")])

    sides = pairs.join(one.select(F.col("rep").alias("b"), F.col("signature").alias("right")), "b").join(one.select(F.col("rep").alias("a"), F.col("signature").alias("left")), "a")
    return sides.select("a", "b", "left", "right").mapInArrow(run, "a bigint, b bigint")


def near_enough(x: tuple, y: tuple, similarity: float) -> bool:
    """Whether the weighted Jaccard similarity of two (shingles, weights) reaches the threshold."""
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(x[1][i], y[1][j]).sum())
    return both >= similarity * (int(x[1].sum()) + int(y[1].sum()) - both)


def opened(keys: bytes, weights: bytes) -> tuple:
    return unpack_sorted(keys), unpack(weights).astype(np.int64)


def shingled(asked: DataFrame, docs: DataFrame, one: DataFrame) -> DataFrame:
    """doc_id, keys and weights: all shingles of the whole texts of the asked ids."""
    asked = small(staged(asked.distinct()), 8)
    shingles = pa.schema([("doc_id", pa.int64()), ("content", pa.int64()), ("keys", pa.binary()), ("weights", pa.binary())])

    def emit(batches):
        for b in chunks(batches, 4_000_000):
            flat, counts = token_hashes(b.column("text"))
            rows, keys, weights = weighted_shingles(flat, counts)
            cuts = np.searchsorted(rows, np.arange(len(counts) + 1))
            for i, (doc_id, own) in enumerate(zip(b.column("doc_id").to_pylist(), np.split(flat, np.cumsum(counts)[:-1]), strict=True)):
                part = slice(cuts[i], cuts[i + 1])
                if len(own):
                    digest = content_of(own)
                    yield batch(shingles, [doc_id], [int(digest[0])], [pack_sorted(keys[part])], [pack(weights[part])])

    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(asked, "doc_id", "left_semi")
    # A repeated id can stand for several texts; the one that was signed is compared.
    sets = read.mapInArrow(emit, "doc_id bigint, content bigint, keys binary, weights binary").dropDuplicates(["doc_id", "content"])
    return staged(sets.join(one.select(F.col("rep").alias("doc_id"), "content"), ["doc_id", "content"], "left_semi").select("doc_id", "keys", "weights"))


def verified(pairs: DataFrame, docs: DataFrame, one: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose weighted Jaccard similarity over all shingles reaches the threshold, from the whole texts."""
    pairs = staged(pairs)
    sets = shingled(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), docs, one)
    side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("keys").alias(f"{c}_keys"), F.col("weights").alias(f"{c}_weights"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for t in batches:
            near = [near_enough(opened(ak, aw), opened(bk, bw), similarity) for ak, aw, bk, bw in zip(*[t.column(c).to_pylist() for c in ("a_keys", "a_weights", "b_keys", "b_weights")], strict=True)]
            yield batch(schema, *[t.column(c).filter(pa.array(near, pa.bool_())) for c in ("a", "b")])

    return staged(pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "a_keys", "a_weights", "b_keys", "b_weights").mapInArrow(run, "a bigint, b bigint"))


# Whole texts of a block, as packed shingles.
BLOCK_BYTES = 8_000_000


def in_blocks(crowded: DataFrame, docs: DataFrame, one: DataFrame, similarity: float, least: float, block: int) -> DataFrame:
    """Links that join the components of crowded buckets (key, rep, component) as all their similar pairs would.

    Pairs are never rows: a task holds two blocks of a bucket with their signatures and shingles, compares the pairs of
    different components by signature, then by whole text, and joins components as it goes, so that it gives fewer links
    than it has members. Buckets that share members are one where that makes fewer pairs, so near copies that meet in many
    buckets meet once; elsewhere a pair is compared in the first bucket that it shares.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    crowded = staged(crowded.select("key", "rep", "component"))
    sizes = staged(crowded.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").cast("double").alias("n")))
    joined = components(crowded.join(sizes, "key").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct())
    area = sizes.join(joined.withColumnRenamed("node", "hub"), "hub").select("key", F.col("component").alias("area"), "n")
    pays = joined.groupBy(F.col("component").alias("area")).agg(F.count("*").cast("double").alias("all")).join(area.groupBy("area").agg(F.sum(F.col("n") * F.col("n")).alias("apart")), "area").select("area", (F.col("all") * F.col("all") <= F.col("apart")).alias("whole"))
    place = F.when(F.col("whole"), F.col("area")).otherwise(F.col("key"))
    member = crowded.join(area.join(pays, "area").select("key", "whole", place.alias("place")), "key").select("whole", "place", F.when(~F.col("whole"), F.col("key")).alias("key"), "rep", "component").distinct()
    sets = shingled(crowded.select(F.col("rep").alias("doc_id")), docs, one).join(one.select(F.col("rep").alias("doc_id"), "signature", F.col("keys").alias("buckets")), "doc_id")
    full = staged(member.join(sets.withColumnRenamed("doc_id", "rep").withColumnRenamed("keys", "shingles"), "rep"))
    # The place of a merged area and a bucket's key can be the same number.
    here = ["whole", "place"]
    blocks = full.groupBy(*here).agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum(F.octet_length("shingles") + F.octet_length("weights")) / BLOCK_BYTES)).cast("int").alias("blocks"))
    dealt = full.join(blocks, here).withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(*here, "key", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "mine", "rep", "component", "signature", "buckets", "shingles", "weights")

    def run(t: pa.Table) -> pa.Table:
        rep, group, mine = (t.column(c).to_numpy() for c in ("rep", "component", "mine"))
        sig = np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint32).reshape(len(rep), -1)
        buckets = t.column("buckets").combine_chunks().flatten().to_numpy().reshape(len(rep), -1)
        keys, weights, key = t.column("shingles"), t.column("weights"), t.column("key")[0].as_py()
        p, q = t.column("p")[0].as_py(), t.column("q")[0].as_py()
        _, group = np.unique(group, return_inverse=True)
        held: dict[int, tuple] = {}
        found = []
        open_at = lambda i: held[i] if i in held else held.setdefault(i, opened(keys[i].as_py(), weights[i].as_py()))
        for i in np.flatnonzero(mine == p).tolist():
            others = np.flatnonzero((mine == q) & (group != group[i]) & (rep > rep[i] if p == q else True))
            others = others[(sig[others] == sig[i]).mean(1) >= least]
            if key is not None and len(others):
                shared = buckets[others] == buckets[i]
                others = others[buckets[i][shared.argmax(1)] == key]
            for j in others.tolist():
                if group[i] != group[j] and near_enough(open_at(i), open_at(j), similarity):
                    found.append((min(rep[i], rep[j]), max(rep[i], rep[j])))
                    group[group == group[j]] = group[i]
        return pa.Table.from_batches([batch(schema, *zip(*found, strict=True))] if found else [], schema)

    return staged(dealt.groupBy(*here, "p", "q").applyInArrow(run, "a bigint, b bigint").distinct())


def near_duplicates(docs: DataFrame, similarity: float = 0.8, crowd: int = 8, block: int = 1000) -> DataFrame:
    """doc_id, class_id (smallest id of the group) and kept (doc_id = class_id), one row for each row with an id.

    Weighted sets of runs of five words; groups are connected by pairs of a weighted Jaccard similarity of
    `similarity` or more. Equal texts are one from the start. A band key (ROWS coordinates, BANDS bands;
    a pair at 0.8 is missed by all bands with probability 5e-6) brings candidates together. First every
    member meets the smallest id of its bucket, which joins most groups with few pairs; buckets that still
    hold several groups are then compared pair by pair between groups: in a join if small, inside of tasks, block by
    block, if crowded. Signatures must agree on about four standard deviations less than the similarity
    before whole texts are compared. Texts without a word are in no group. A null id gives a null class
    and is kept; rows with equal ids are one document. Other columns are not read.
    """
    table = staged(signed(docs))
    groups = staged(table.groupBy("content", "content2").agg(F.min("doc_id").alias("rep")))
    member = table.select("doc_id", "content", "content2").join(groups, ["content", "content2"]).select("doc_id", "rep")
    one = staged(table.join(groups, ["content", "content2"]).where("doc_id = rep").dropDuplicates(["content", "content2"]).select("rep", "content", "signature", "keys"))
    keys = one.select("rep", F.explode("keys").alias("key"))
    hubs = staged(keys.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("n")).where("n > 1"))
    held = staged(keys.join(small(hubs, 24), "key"))
    least = similarity - 4 * (similarity * (1 - similarity) / COORDINATES) ** 0.5
    links = verified(estimated(held.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), one, least), docs, one, similarity)
    # Copies of one id with different texts are one document: member rows link their representatives.
    twice = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b").select("a", "b")
    links = links.unionByName(twice)
    label = components(links)
    grouped = held.join(label.withColumnRenamed("node", "rep"), "rep", "left").select("key", "rep", "n", F.coalesce("component", "rep").alias("component"))
    mixed_up = grouped.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("key")
    rest = staged(grouped.join(small(staged(mixed_up), 8), "key"))
    few, many = rest.where(F.col("n") <= crowd), rest.where(F.col("n") > crowd)
    other = few.select("key", F.col("rep").alias("b"), F.col("component").alias("second"))
    across = few.select("key", F.col("rep").alias("a"), F.col("component").alias("first")).join(other, "key").where("a < b AND first <> second").select("a", "b").distinct()
    links = links.unionByName(verified(estimated(across, one, least), docs, one, similarity))
    if many.limit(1).count():
        links = links.unionByName(in_blocks(many, docs, one, similarity, least, block))
    label = components(links)
    classes = member.join(label.withColumnRenamed("node", "rep"), "rep", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("class_id"))
    every = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).join(classes, "doc_id", "left")
    return every.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows, with all their columns, of the document that each group keeps. Of rows with one id the smallest stays."""
    classes = near_duplicates(docs, **options)
    gone = staged(classes.where("NOT kept").select("doc_id").distinct())
    left = docs.join(small(gone, 8), "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])
    twice = staged(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if twice.limit(1).count() == 0:
        return left
    single = left.join(small(twice, 8), "doc_id", "left_anti")
    copies = left.join(small(twice, 8), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*[f"`{c}`" for c in docs.columns if c != "doc_id"])).alias("x")).select("doc_id", "x.*")
    return single.unionByName(copies).select(*[f"`{c}`" for c in docs.columns])
