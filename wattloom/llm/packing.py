"""Best-fit packing of token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import batch, chunks, partitions, staged
from wattloom.llm.wordcache import WordCache, split_words

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
class WordIds(WordCache):
    """Ids of the word-end vocabulary: its pre-tokeniser drops white space and never joins across it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.ends = np.array([t.endswith("</w>") for t, _ in sorted(self.tokenizer.get_vocab().items(), key=lambda x: x[1])])

    def learn(self, new: list[bytes]) -> None:
        """A word that ends with one comma or full stop after letters has the ids of the rest, then that of the mark."""
        marked = {w for w in new if w[-1] in b",." and w[:-1].decode("utf-8", "replace").isalpha()}
        rest = [w for w in new if w not in marked]
        stems = set(rest)
        super().learn(rest + [w for w in {*(w[:-1] for w in marked), *(w[-1:] for w in marked)} if w not in self.index and w not in stems])
        if marked:
            order = list(marked)
            stem = np.fromiter((self.index[w[:-1]] for w in order), np.int64, len(order))
            mark = np.fromiter((self.index[w[-1:]] for w in order), np.int64, len(order))
            ids, ends = self.gathered(np.stack([stem, mark], 1).ravel())
            self._keep(order, ids, self.count[stem] + self.count[mark])

    def ids_of(self, new: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        texts = [w.decode("utf-8", "replace") for w in new]
        plain = [i for i, t in enumerate(texts) if t.isalpha()]
        # A word of letters alone is one piece and ends with its first token that carries the end mark.
        groups = [plain[i : i + 200] for i in range(0, len(plain), 200)]
        odd = [i for i, t in enumerate(texts) if not t.isalpha()]
        order, ids, counts = [], [], []
        for group, got in zip(groups, self.tokenizer.encode_batch_fast([" ".join(texts[i] for i in g) for g in groups], add_special_tokens=False), strict=True):
            own = np.array(got.ids, np.int32)
            ends = np.flatnonzero(self.ends[own]) if len(own) else np.zeros(0, np.int64)
            if len(ends) == len(group) and ends[-1] == len(own) - 1:
                order += group
                ids.append(own)
                counts.append(np.diff(ends, prepend=-1))
            else:
                odd += group
        got = [e.ids for e in self.tokenizer.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False)]
        ids.append(np.array([x for g in got for x in g], np.int32))
        counts.append(np.array([len(g) for g in got], np.int64))
        return [new[i] for i in order + odd], np.concatenate(ids), np.concatenate(counts)


@lru_cache(1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Token pieces of every document: its ids, then the end id; cut only where longer than the capacity.

    A null or empty text is the end id alone; a null doc_id stays null. Repeated rows give repeated
    pieces; further columns of the input are not read. keep_ids adds the ids themselves.
    """
    columns = PIECES + (", ids array<int>" if keep_ids else "")
    kinds = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(kinds + ([("ids", pa.list_(pa.int32()))] if keep_ids else []))

    def cut(batches):
        encoder = word_ids(vocabulary)
        for b in chunks(batches, 4_000_000):
            out = []
            distinct, at, counts = split_words(b.column("text"), lower=True, spare_marks=True)
            ids_all, ends = encoder.gathered(encoder.numbers(distinct, at))
            cuts = ends[np.concatenate([[0], np.cumsum(counts)])].tolist()
            for doc_id, a, z in zip(b.column("doc_id").to_pylist(), cuts[:-1], cuts[1:], strict=True):
                ids = np.append(ids_all[a:z], end_id).astype("<u4")
                for i, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    out.append((doc_id, i, at, len(part), zlib.crc32(part.tobytes()), *([part.astype(np.int32)] if keep_ids else [])))
            yield batch(schema, *zip(*out, strict=True))

    return docs.select("doc_id", "text").mapInArrow(cut, columns)


def best_fit(sizes: np.ndarray, order: np.ndarray, room: list[int], capacity: int) -> dict[int, int]:
    """Item -> bin for the items in `order`: the fullest bin that still takes the item, else a new one.

    `room` holds the free space of each bin and grows in place. A bit mask over free space finds the bin.
    """
    free: dict[int, list[int]] = {}
    mask = 0
    for i, r in enumerate(room):
        if r > 0:
            free.setdefault(r, []).append(i)
            mask |= 1 << r
    got = {}
    for item in order.tolist():
        size = int(sizes[item])
        above = mask >> size
        if above:
            r = size + (above & -above).bit_length() - 1
            at = free[r].pop()
            if not free[r]:
                mask ^= 1 << r
        else:
            at, r = len(room), capacity
            room.append(capacity)
        left = r - size
        room[at] = left
        if left:
            rest = free.setdefault(left, [])
            if not rest:
                mask |= 1 << left
            rest.append(at)
        got[item] = at
    return got


def least_bins(sizes: np.ndarray, capacity: int) -> int:
    """A lower bound: the sum, and for each limit k the items over capacity - k, which take a bin each,
    with what items of k and more need beyond the room left beside the larger half."""
    most = -(-int(sizes.sum()) // capacity)
    for k in np.unique(sizes[sizes <= capacity // 2]).tolist():
        alone, half = sizes > capacity - k, (sizes <= capacity - k) & (sizes > capacity // 2)
        small = (sizes <= capacity // 2) & (sizes >= k)
        rest = int(sizes[small].sum()) - (int(half.sum()) * capacity - int(sizes[half].sum()))
        most = max(most, int(alone.sum()) + int(half.sum()) + max(0, -(-rest // capacity)))
    return most


def fitness(assign: np.ndarray, sizes: np.ndarray, capacity: int) -> float:
    """Fewer bins first, then uneven filling, which leaves room to empty a bin."""
    fill = np.bincount(assign, sizes)
    return -len(fill) + float(np.mean((fill / capacity) ** 2))


def crossover(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Inject a part of the well-filled bins of `a` whole into `b`; bins of `b` with a doubled item go,
    and their displaced items are put back by best fit, largest first."""
    fill = np.bincount(a, sizes)
    good = np.flatnonzero(fill >= np.quantile(fill, rng.uniform(0.3, 0.8)))
    taken = np.zeros(len(fill), bool)
    taken[good[rng.random(len(good)) < rng.uniform(0.3, 0.9)]] = True
    inside = taken[a]
    gone = np.zeros(b.max() + 1, bool)
    gone[b[inside]] = True
    # The emptiest bins of `b` are opened too, so that their items look for better places.
    filled = np.bincount(b, sizes)
    gone[np.argsort(filled)[: max(1, len(filled) // 50)]] = True
    loose = np.flatnonzero(gone[b] & ~inside)
    child = np.full(len(a), -1, np.int64)
    number = np.cumsum(taken) - 1
    child[inside] = number[a[inside]]
    stay = ~gone[b] & ~inside
    after = np.cumsum(~gone) - 1 + int(taken.sum())
    child[stay] = after[b[stay]]
    bins = int(taken.sum()) + int((~gone).sum())
    room = (capacity - np.bincount(child[child >= 0], sizes[child >= 0], minlength=bins)).astype(int).tolist()
    order = loose[np.argsort(-sizes[loose], kind="stable")]
    for item, at in best_fit(sizes, order, room, capacity).items():
        child[item] = at
    return np.unique(child, return_inverse=True)[1]


def evolve(sizes: np.ndarray, capacity: int, seed: int, migrants: list[np.ndarray], population: int, generations: int) -> np.ndarray:
    """Best packing of one island; migrants are the elite of other islands and of earlier rounds."""
    rng = np.random.default_rng(seed)
    least = least_bins(sizes, capacity)

    def fresh(noise: float) -> np.ndarray:
        order = np.argsort(-(sizes * (1 + noise * rng.random(len(sizes)))), kind="stable")
        got = best_fit(sizes, order, [], capacity)
        assign = np.empty(len(sizes), np.int64)
        assign[list(got)] = list(got.values())
        return assign

    herd = [*migrants] or [fresh(0.0)]
    best = max(herd, key=lambda x: fitness(x, sizes, capacity))
    if best.max() + 1 <= least:
        return best
    herd += [fresh(0.02 * i) for i in range(1, population - len(herd) + 1)]
    for _ in range(generations):
        for _ in range(population // 2):
            score = [fitness(x, sizes, capacity) for x in herd]
            pick = lambda s=score: max(rng.integers(0, len(herd), 2).tolist(), key=lambda i: s[i])
            herd[int(np.argmin(score))] = crossover(herd[pick()], herd[pick()], sizes, capacity, rng)
        best = max([best, *herd], key=lambda x: fitness(x, sizes, capacity))
        if best.max() + 1 <= least:
            break
    return best


ITEMS = ["doc_id", "piece", "start", "length", "ids_crc32"]


def pack(cut: DataFrame, capacity: int = 2048, group: int = 4096, islands: int = 3, rounds: int = 2, population: int = 6, generations: int = 6, seed: int = 0) -> DataFrame:
    """Place pieces (doc_id, piece, start, length, ids_crc32) in sequences of at most `capacity` tokens.

    Pieces of full length are sequences of their own. The others are dealt by hash into groups of about
    `group` pieces, whose number grows with the input. Each group is packed by several islands at once;
    after a round the elite of every island migrates to the next one of its group. The best island wins;
    an island that meets the lower bound stops. Adds sequence_id and offset. An empty input gives no rows.
    """
    cut = staged(cut.select(*ITEMS))
    full = cut.where(F.col("length") >= capacity).withColumn("sequence_id", F.monotonically_increasing_id() * 2 + 1).withColumn("offset", F.lit(0).cast("bigint"))
    part = cut.where(F.col("length") < capacity)
    n = part.count()
    if n == 0:
        return full
    groups = -(-n // group)
    part = part.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    first = part.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct(F.col("length"), "doc_id", "piece", "start", "ids_crc32")), asc=False).alias("items"))
    spread = min(groups * islands, max(partitions(cut.sparkSession), groups * islands // 4))
    def turn(number: int):
        def run(frames):
            for f in frames:
                best = []
                for r in f.itertuples(index=False):
                    sizes = np.array([x["length"] for x in r.items], np.int64)
                    migrants = [np.asarray(x, np.int64) for x in r.elite]
                    island_seed = hash((seed, int(r.bucket), int(r.island), number)) & 0x7FFFFFFF
                    best.append(evolve(sizes, capacity, island_seed, migrants, population, generations).astype(np.int32))
                yield pd.DataFrame({"bucket": f["bucket"], "island": f["island"], "best": best, "bins": [int(x.max()) + 1 for x in best]})

        return run

    held, best = staged(first), None
    for number in range(rounds):
        every = held.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
        if best is None:
            state = every.withColumn("elite", F.array().cast("array<array<int>>"))
        else:
            moved = best.select("bucket", F.explode(F.array(F.col("island"), F.pmod(F.col("island") + 1, F.lit(islands)))).alias("island"), "best")
            state = every.join(moved.groupBy("bucket", "island").agg(F.collect_list("best").alias("elite")), ["bucket", "island"])
        state = state.select("bucket", "island", F.transform("items", lambda x: F.struct(x["length"].alias("length"))).alias("items"), "elite")
        best = staged(state.repartition(spread, "bucket", "island").mapInPandas(turn(number), "bucket bigint, island int, best array<int>, bins int"))
    won = best.groupBy("bucket").agg(F.min_by("best", F.struct("bins", "island")).alias("best"))
    placed = held.join(won, "bucket").select("bucket", F.explode(F.arrays_zip("items", "best")).alias("x")).select("bucket", "x.items.*", F.col("x.best").alias("bin"))
    return placed.groupBy("bucket", "bin").agg(F.sort_array(F.collect_list(F.struct("doc_id", "piece", "start", "length", "ids_crc32"))).alias("row")).select(
        ((F.col("bucket") * F.lit(1 << 20) + F.col("bin")) * 2).alias("sequence_id"), F.posexplode("row").alias("at", "x"), "row"
    ).select("x.*", "sequence_id", F.coalesce(F.aggregate(F.slice("row", F.lit(1), F.col("at")), F.lit(0).cast("bigint"), lambda s, r: s + r["length"]), F.lit(0)).alias("offset")).unionByName(full)
