"""Hard negatives by Fagin's threshold algorithm over blocks of candidate rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import MOST_BROADCAST, batch, staged

# Components are floors of 256 x, held to this size so that an inner product of 127 of them always fits a long.
MOST_COMPONENT = 1 << 28
# Candidate rows of a block, which has its own sorted lists; anchors of a packed row.
BLOCK, GROUP = 32_768, 512
# Depth of the first round of sorted access, and the growth from round to round.
FIRST, GROWTH = 32, 1.4


def rows_of(embeddings: DataFrame) -> DataFrame:
    """vec_id, label, vec array<int> of the rows that take part.

    A null id, label or vector, or a component that is null, NaN or infinite, leaves the row out.
    """
    vec = F.col("embedding")
    real = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(vec, lambda x: F.least(F.greatest(F.floor(x.cast("double") * 256), F.lit(-MOST_COMPONENT)), F.lit(MOST_COMPONENT)).cast("int"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vec.isNotNull() & real).select("vec_id", label.cast("long").alias("label"), whole.alias("vec"))


def matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    lengths = column.value_lengths().to_numpy()
    got = np.zeros((len(lengths), width), kind)
    got[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths]) if len(lengths) else []] = column.flatten().to_numpy()
    return got


def packed(rows: DataFrame, width: int, size: int, extra: dict[str, int]) -> DataFrame:
    """Rows as blocks of up to `size`: vectors and ids as bytes; also the `extra` columns, longs (0) or arrays of so many longs."""
    names = ["vec_id", "label", *extra]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def block():
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns], names=[*names, "vec"])

        for b in batches:
            one = [matrix(b.column(n), extra[n], np.int64) if extra.get(n) else b.column(n).to_numpy() for n in names]
            one.append(matrix(b.column("vec"), width, np.int32))
            at = 0
            while at < b.num_rows:
                room = size - sum(len(h[0]) for h in held)
                held.append([c[at : at + room] for c in one])
                at += room
                if sum(len(h[0]) for h in held) == size:
                    yield block()
                    held = []
        if held:
            yield block()

    return rows.select(*names, "vec").mapInArrow(pack, ", ".join(f"{n} binary" for n in [*names, "vec"]))


@dataclass
class Lists:
    """Candidates with a list per dimension that is sorted by component; read from the front for a positive component
    of the anchor and from the back for a negative one, it goes from the best contribution to the worst."""

    vec: np.ndarray
    order: np.ndarray
    value: np.ndarray
    typed: dict

    @classmethod
    def of(cls, vec: np.ndarray) -> Lists:
        order = np.argsort(-vec.T, axis=1, kind="stable").astype(np.int32)
        return cls(vec, order, np.take_along_axis(vec.T, order, 1), {})

    def rows(self, kind: type) -> np.ndarray:
        if kind not in self.typed:
            self.typed[kind] = self.vec.astype(kind)
        return self.typed[kind]

    def depths(self) -> list[int]:
        """Ends of the rounds of sorted access."""
        n, got = len(self.vec), [0]
        while got[-1] < n:
            got.append(min(n, max(got[-1] + FIRST, int(got[-1] * GROWTH))))
        return got

    def thresholds(self, anchors: np.ndarray, depths: list[int]) -> np.ndarray:
        """Per anchor and round: the most that a row can score which no list has shown before the round's end."""
        last = np.array(depths[1:]) - 1
        front, back = self.value[:, last].astype(anchors.dtype), self.value[:, len(self.vec) - 1 - last].astype(anchors.dtype)
        return np.maximum(anchors, 0) @ front + np.minimum(anchors, 0) @ back


def exact(vec: np.ndarray, anchors: np.ndarray) -> type:
    """The narrowest type in which inner products, thresholds included, are exact."""
    most = int(np.abs(vec).max(initial=0)) * int(np.abs(anchors).max(initial=0)) * max(1, vec.shape[1])
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


@dataclass
class Best:
    """The first k of the rows seen so far whose score lies in [low, high]; higher scores first, then smaller ids."""

    k: int
    low: int
    high: int
    score: np.ndarray
    vec_id: np.ndarray

    @classmethod
    def empty(cls, k: int, low: int, high: int) -> Best:
        return cls(k, low, high, np.zeros(0, np.int64), np.zeros(0, np.int64))

    def least(self) -> int:
        return max(self.low, int(self.score[-1])) if len(self.score) == self.k else self.low

    def add(self, score: np.ndarray, vec_id: np.ndarray) -> None:
        fit = np.flatnonzero((score >= self.least()) & (score <= self.high))
        if not len(fit):
            return
        if len(fit) > self.k:  # whatever is below the k-th best of the new rows is out
            fit = fit[score[fit] >= np.partition(score[fit], len(fit) - self.k)[len(fit) - self.k]]
        both, ids = np.concatenate([self.score, score[fit].astype(np.int64)]), np.concatenate([self.vec_id, vec_id[fit]])
        first = np.lexsort((ids, -both))[: self.k]
        self.score, self.vec_id = both[first], ids[first]

    def closed(self, threshold: float) -> bool:
        """No row that scores at most the threshold can enter: strictly below the k-th score, or below the window."""
        return threshold < self.low or (len(self.score) == self.k and threshold < self.score[-1])


def search(lists: Lists, anchors: np.ndarray, windows: list[list[Best]], ids: np.ndarray, allowed: Callable[[int], np.ndarray]) -> None:
    """Fills the windows of each anchor from the candidates: rounds of sorted access show rows, each new row that is
    allowed is scored whole once, and an anchor is done as soon as the threshold closes all its windows."""
    kind = exact(lists.vec, anchors)
    vec, probes, depths = lists.rows(kind), anchors.astype(kind), lists.depths()
    bound = lists.thresholds(anchors.astype(np.int64 if kind is np.int64 else np.float64), depths)
    for i, (probe, best) in enumerate(zip(probes, windows, strict=True)):
        front, back = np.flatnonzero(probe > 0), np.flatnonzero(probe < 0)
        unseen, n = allowed(i).copy(), len(vec)
        still = [b for b in best if b.low <= b.high]
        for r, (a, z) in enumerate(zip(depths[:-1], depths[1:], strict=True)):
            shown = np.zeros(n, bool)
            shown[lists.order[front, a:z]] = True
            shown[lists.order[back, n - z : n - a]] = True
            if not len(front) + len(back):  # all scores are zero, the lists say nothing
                shown[:] = True
            shown &= unseen
            new = np.flatnonzero(shown)
            unseen[new] = False
            score = vec[new] @ probe
            some = np.flatnonzero(score >= min((b.least() for b in still), default=0))
            score, own = score[some], ids[new[some]]
            for b in still:
                b.add(score, own)
            still = [b for b in still if not b.closed(bound[i, r])]
            if not still or not unseen.any():
                break


def unpacked(raw: bytes, kind: type = np.int64) -> np.ndarray:
    return np.frombuffer(raw, kind)


FOUND = pa.schema([("key", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("vec_id", pa.int64())])
OPEN = 1 << 62


def mined(blocks: DataFrame, groups: DataFrame, width: int, per_anchor: int, k: int, same_label: bool) -> DataFrame:
    """key, slot, score, vec_id: of every anchor window the first k rows of each task.

    Every block meets every group of anchors. A task keeps the best rows over its blocks, so windows that one block
    filled close sooner in the next. A window is the score range (low, high) that the packed anchor row holds; with
    `same_label` the lists hold rows of the anchor's label alone, else rows of its label are passed over.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[Best]] = {}
        last, cache = None, {}
        for b in batches:
            for row in b.to_pylist():
                key = (row["vec_id"], row["vec"])
                if key != last:
                    last, cache = key, {}
                    ids, label = unpacked(row["vec_id"]), unpacked(row["label"])
                    vec = unpacked(row["vec"], np.int32).reshape(len(ids), width)
                anchor_key, anchor_id, anchor_label = (unpacked(row[n]) for n in ("a_key", "a_id", "a_label"))
                anchors = unpacked(row["a_vec"], np.int32).reshape(len(anchor_key), width)
                ranges = unpacked(row["a_range"]).reshape(len(anchor_key), per_anchor, 2).tolist()
                for one, rs in zip(anchor_key.tolist(), ranges, strict=True):
                    if one not in kept:
                        kept[one] = [Best.empty(k, low, high) for low, high in rs]
                for value in np.unique(anchor_label).tolist() if same_label else [None]:
                    of = np.flatnonzero(anchor_label == value) if same_label else np.arange(len(anchor_key))
                    if value not in cache:
                        at = np.flatnonzero(label == value) if same_label else np.arange(len(ids))
                        cache[value] = (ids[at], label[at], Lists.of(vec[at]))
                    own, own_label, lists = cache[value]
                    if len(own):
                        if same_label:
                            allowed = [own != anchor_id[i] for i in of]
                        else:
                            other = {v: own_label != v for v in np.unique(anchor_label[of]).tolist()}
                            allowed = [other[int(anchor_label[i])] for i in of]
                        search(lists, anchors[of], [kept[int(anchor_key[i])] for i in of], own, allowed.__getitem__)
        out = [(key, slot, score, vec_id) for key, windows in kept.items() for slot, w in enumerate(windows) for score, vec_id in zip(w.score.tolist(), w.vec_id.tolist(), strict=True)]
        for i in range(0, len(out), 100_000):
            yield batch(FOUND, *zip(*out[i : i + 100_000], strict=True))

    asked = groups.select(*(F.col(c).alias(f"a_{c}" if c != "vec_id" else "a_id") for c in groups.columns))
    got = blocks.join(F.broadcast(asked), F.lit(True)).mapInArrow(run, "key bigint, slot int, score bigint, vec_id bigint")
    best = Window.partitionBy("key", "slot").orderBy(F.desc("score"), "vec_id")
    return got.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, block: int = BLOCK, most: int = MOST_BROADCAST
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id `every` divides. A null id, label or vector, or a component that is not finite, leaves
    a row out. Vectors of different lengths meet as if the shorter one ended in zeros; components beyond 2^28 count as
    2^28. Repeated rows each count as a row; another row is one with another id, and ties go to the smaller id. A positive
    with a negative score has an empty window. An empty table has no rows.

    The anchors are the query set and meet all rows, in blocks: packed anchors are broadcast, in as many passes as
    keep each broadcast below `most` bytes.
    """
    rows = rows_of(embeddings)
    width = max(1, embeddings.agg(F.max(F.size("embedding"))).first()[0] or 0)
    blocks = staged(packed(rows, width, block, {}))
    anchors = staged(rows.where(F.col("vec_id") % every == 0).withColumn("key", F.monotonically_increasing_id()))
    each = 4 * width + 32 + 16 * positives
    passes = max(1, -(-anchors.count() * each // most))

    def all_of(asked: DataFrame, per_anchor: int, k: int, same_label: bool) -> DataFrame:
        """All anchors against all rows, each pass with a slice of the anchors."""
        mine = [asked.where(F.pmod(F.xxhash64("key"), F.lit(passes)) == i) if passes > 1 else asked for i in range(passes)]
        groups = [packed(m, width, GROUP, {"key": 0, "range": 2 * per_anchor}) for m in mine]
        return reduce(DataFrame.unionByName, [mined(blocks, g, width, per_anchor, k, same_label) for g in groups])

    near = staged(all_of(anchors.withColumn("range", F.array(F.lit(-OPEN), F.lit(OPEN))), 1, positives, True))
    # 50 p <= 100 n <= 95 p in whole numbers; the window of a positive that is not there is empty.
    p = "cast(score as decimal(20, 0))"
    own = F.expr(f"CASE WHEN score < 0 THEN array(1L, 0L) ELSE array(({p} * {low} + 99) div 100, ({p} * {high}) div 100) END")
    slots = near.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct((F.col("rank") - 1).alias("slot"), own.alias("own")))).alias("own"))
    empty = F.array(F.lit(1).cast("long"), F.lit(0).cast("long"))
    ranges = F.flatten(F.array(*(F.coalesce(F.element_at("own", F.lit(i)), empty) for i in range(positives))))
    windows = staged(anchors.join(slots, "key").withColumn("range", ranges).drop("own"))
    got = all_of(windows, positives, negatives, False).alias("n")
    pairs = got.join(near.alias("p"), (F.col("n.key") == F.col("p.key")) & (F.col("n.slot") == F.col("p.rank") - 1))
    ids = anchors.select("key", F.col("vec_id").alias("anchor_id")).alias("a")
    return pairs.join(ids, F.col("a.key") == F.col("n.key")).select(
        "anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("n.rank").cast("int").alias("rank"), F.col("n.vec_id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score")
    )
