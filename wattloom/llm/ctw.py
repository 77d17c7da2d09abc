"""Context-tree weighting of text bytes, each split into eight binary decisions.

A node is a context (the last 0 to DEPTH bytes) with the bits of the byte known so far. Its Krichevsky-
Trofimov estimate from the training counts is mixed with that of the longer contexts below it:
P_w = 1/2 P_kt + 1/2 product of P_w of the children. A prediction follows the path of the context
and mixes the estimates of all depths with the weights that training gave them.
"""

from __future__ import annotations

from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import batch, partitions, remainder, staged
from wattloom.llm.exchange import by_shard, pack, pack_sorted, unpack, unpack_sorted
from wattloom.llm.wordcache import as_list, split_words

DEPTH = 7  # with the byte itself a context fills 64 bits
TOP = 2  # contexts of TOP bytes and more lie whole in one shard; the nodes above them number 65,280 at most
HALF = np.log(0.5)
MODEL = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("slice", pa.int64()), ("keys", pa.binary()), ("values", pa.binary()), ("words", pa.binary()), ("counts", pa.binary())])
MODEL_SQL = "shard int, kind int, slice bigint, keys binary, values binary, words binary, counts binary"
NODES, ASKS, TEXTS = 0, 1, 2
MOST_KEYS = 1_000_000
END = b"\n"


def byte_streams(texts: pa.Array) -> list[bytes]:
    """What is scored: words with A-Z in lower case, one space between them, and an end mark."""
    return [b" ".join(w.split()) + END for w in as_list(pc.ascii_lower(texts.fill_null("")))]


def grams(streams: list[bytes]) -> np.ndarray:
    """For each byte of each stream the key (last byte, the one before, ..., the byte itself); zeros stand before a stream."""
    raw = bytes(DEPTH) + bytes(DEPTH).join(streams)
    # Eight bytes from each place on, the byte itself highest; turned by a byte it is lowest and the last byte highest.
    keys = np.ndarray((len(raw) - DEPTH,), "<u8", raw, strides=(1,)).copy()
    keys = (keys << np.uint64(8)) | (keys >> np.uint64(56))
    sizes = np.array([len(s) for s in streams], np.int64)
    starts = np.cumsum(sizes + DEPTH) - sizes - DEPTH
    own = np.ones(len(keys), bool)
    for pad in range(DEPTH):
        own[(starts + sizes + pad)[:-1]] = False
    return keys[own]


def gram_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    near = (keys >> np.uint64(8 * (DEPTH + 1 - TOP))) * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)
    return (near * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every, weight = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    if not len(every):
        return every, weight
    order = np.argsort(every, kind="stable")
    every = every[order]
    start = np.flatnonzero(np.diff(every, prepend=~every[:1]))
    return every[start], np.add.reduceat(weight[order], start)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by eight; exact to about 1e-14 for x > 0."""
    shift = np.ones_like(x)
    for i in range(8):
        shift *= x + i
    y = x + 8
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the KT block probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1) - np.log(np.pi)


class Level:
    """Counts and weights of the nodes of one depth, from distinct (context, byte) keys and their counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """The keys rise, so the keys of a node follow one another whatever the number of known bits."""
        self.keys, self.node, self.zeros, self.ones, self.first = keys, [], [], [], []
        symbol = keys & np.uint64(255)
        for i in range(8):
            # Context and known bits of the byte, as one number.
            start = np.r_[True, np.diff(keys >> np.uint64(8 - i)) != 0] if len(keys) else np.zeros(0, bool)
            first, bit = np.flatnonzero(start), ((symbol >> np.uint64(7 - i)) & np.uint64(1)).astype(np.int64)
            total, one = np.add.reduceat(counts, first), np.add.reduceat(counts * bit, first)
            self.node.append((np.cumsum(start) - 1).astype(np.int32))
            self.zeros.append((total - one).astype(np.float64))
            self.ones.append(one.astype(np.float64))
            self.first.append(first)
        self.kt = [log_kt(a, b) for a, b in zip(self.zeros, self.ones, strict=True)]

    def weigh(self, below: list[np.ndarray] | None) -> None:
        """Block probabilities from those of the children, summed in the log domain per node (None: leaves)."""
        self.block = self.kt if below is None else [np.logaddexp(HALF + k, HALF + b) for k, b in zip(self.kt, below, strict=True)]

    def stop(self, i: int) -> np.ndarray:
        """Weight of the node's own estimate against those of the longer contexts."""
        return np.exp(np.minimum(HALF + self.kt[i] - self.block[i], 0))

    def estimate(self, i: int, symbol: np.ndarray) -> np.ndarray:
        """KT probability of the bit that the symbol has at this node."""
        bit = (symbol >> np.uint64(7 - i)) & np.uint64(1)
        n = self.node[i]
        return (np.where(bit == 1, self.ones[i][n], self.zeros[i][n]) + 0.5) / (self.zeros[i][n] + self.ones[i][n] + 1)


def subtree(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, Level]:
    """Bit probabilities (8 x keys) mixed over the depths DEPTH to TOP, and the level TOP itself."""
    symbol = keys & np.uint64(255)
    levels, maps = [Level(keys, counts)], []
    for _ in range(DEPTH - TOP):
        upper = levels[-1]
        # The farthest context byte stands next to the symbol and goes.
        short = (upper.keys >> np.uint64(16) << np.uint64(8)) | (upper.keys & np.uint64(255))
        own, back = np.unique(short, return_inverse=True)
        counts = np.bincount(back, counts, len(own)).astype(np.int64)
        level = Level(own, counts)
        levels.append(level)
        maps.append(back)
    levels[0].weigh(None)
    for lower, level, back in zip(levels, levels[1:], maps, strict=False):
        sums = []
        for i in range(8):
            parent = level.node[i][back[lower.first[i]]]
            sums.append(np.bincount(parent, lower.block[i], len(level.kt[i])))
        level.weigh(sums)
    # Down to up again: mix along the path of each full key.
    mixed = np.empty((8, len(keys)))
    for i in range(8):
        mixed[i] = levels[0].estimate(i, symbol)
    to = np.arange(len(keys))
    for level, back in zip(levels[1:], maps, strict=True):
        to = back[to]
        for i in range(8):
            stop, own = level.stop(i)[level.node[i]][to], level.estimate(i, level.keys & np.uint64(255))[to]
            mixed[i] = stop * own + (1 - stop) * mixed[i]
    return mixed, levels[-1]


class Top:
    """Depths 0 to TOP - 1, from the sums over shards of what the nodes of depth TOP hold."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        # Depth 1: index = last byte * 256 + node; depth 0: index = node.
        z1, o1, b1 = (np.zeros(1 << 16) for _ in range(3))
        z1[nodes], o1[nodes], b1[nodes] = zeros, ones, below
        z0, o0 = z1.reshape(256, 256).sum(0), o1.reshape(256, 256).sum(0)
        k1, k0 = log_kt(z1, o1), log_kt(z0, o0)
        w1 = np.logaddexp(HALF + k1, HALF + b1)
        w0 = np.logaddexp(HALF + k0, HALF + w1.reshape(256, 256).sum(0))
        self.stop = np.exp(np.minimum(HALF + k0 - w0, 0)), np.exp(np.minimum(HALF + k1 - w1, 0))
        self.one = (o0 + 0.5) / (z0 + o0 + 1), (o1 + 0.5) / (z1 + o1 + 1)

    def log10(self, keys: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """Logarithm of the byte's probability from its mixed bit probabilities of the depths below."""
        symbol, last = keys & np.uint64(255), (keys >> np.uint64(8 * DEPTH)).astype(np.int64)
        total = np.zeros(len(keys))
        for i in range(8):
            node = ((1 << i) | (symbol >> np.uint64(8 - i)).astype(np.int64))
            bit = ((symbol >> np.uint64(7 - i)) & np.uint64(1)).astype(bool)
            p = mixed[i]
            for stop, one, at in ((self.stop[1], self.one[1], last * 256 + node), (self.stop[0], self.one[0], node)):
                own = np.where(bit, one[at], 1 - one[at])
                p = stop[at] * own + (1 - stop[at]) * p
            total += np.log10(p)
        return total


def rows_of(b: pa.RecordBatch):
    return zip(*[b.column(c).to_pylist() for c in MODEL.names], strict=True)


def by_group(batches, at: int):
    """(value, rows) for each run of equal values in column `at`; rows are packed arrays, a shard's or slice's at a time."""
    value, held = None, []
    for b in batches:
        for row in rows_of(b):
            if held and row[at] != value:
                yield value, held
                held = []
            value = row[at]
            held.append(row)
    if held:
        yield value, held


def counted(held: list) -> tuple[np.ndarray, np.ndarray]:
    return merge([unpack_sorted(r[3]) for r in held], [unpack(r[4]) for r in held])


def top_sums(asks: DataFrame, shards: int) -> DataFrame:
    """What each shard adds to the nodes above depth TOP, and the number of its trained words and their tokens."""

    def run(batches):
        for shard, held in by_group(batches, 0):
            keys, counts = counted(held)
            seen: Counter = Counter()
            for r in held:
                for w, n in zip(r[5].split(), unpack(r[6]).tolist(), strict=True):
                    seen[w] += n
            known = [n for n in seen.values() if n]
            ids, sums = np.zeros(0, np.int64), np.zeros((3, 0))
            if len(keys):
                top = subtree(keys, counts)[1]
                data = []
                for i in range(8):
                    at = top.keys[top.first[i]]
                    node = (at >> np.uint64(8 * TOP)).astype(np.int64) * 256 + (1 << i) + ((at & np.uint64(255)) >> np.uint64(8 - i)).astype(np.int64)
                    data.append(np.array([node, top.zeros[i], top.ones[i], top.block[i]]))
                node, *sums = np.concatenate(data, 1)
                ids, back = np.unique(node.astype(np.int64), return_inverse=True)
                sums = np.array([np.bincount(back, x) for x in sums])
            yield batch(MODEL, [shard], [NODES], [None], [pack(ids)], [sums.tobytes()], [None], [pack(np.array([len(known), sum(known)], np.int64))])

    return by_shard(asks, shards, "slice").mapInArrow(run, MODEL_SQL)


def packed(rows: DataFrame) -> DataFrame:
    """Texts with their flags, those of a batch and slice together as one compressed value."""

    def run(batches):
        for b in batches:
            number = b.column("slice").to_numpy(zero_copy_only=False)
            order = np.argsort(number, kind="stable")
            some, start = np.unique(number[order], return_index=True)
            for s, part in zip(some.tolist(), np.split(order, start[1:]), strict=True):
                sink = pa.BufferOutputStream()
                own = b.select(["doc_id", "held_out", "learn", "text"]).take(pa.array(part))
                with pa.ipc.new_stream(sink, own.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(own)
                yield batch(MODEL, [-1], [TEXTS], [s], [sink.getvalue().to_pybytes()], [None], [None], [None])

    return rows.mapInArrow(run, MODEL_SQL)


def unpacked(raw: bytes, rows: int = 1000):
    for b in pa.ipc.open_stream(raw):
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def by_slice(df: DataFrame, parts: int) -> DataFrame:
    return df.repartition(parts, "slice").sortWithinPartitions("slice", "kind", "shard")


def ask(texts: DataFrame, shards: int) -> DataFrame:
    """Per slice and shard: distinct keys and words with their training counts, which may be 0."""

    def run(batches):
        keys, counts, seen, number = [], [], {}, None
        for b in batches:
            for row in rows_of(b):
                if number is not None and row[2] != number:
                    yield from finish(number, keys, counts, seen)
                    keys, counts, seen = [], [], {}
                number = row[2]
                for part in unpacked(row[3]):
                    learn = part.column("learn").to_numpy(zero_copy_only=False).astype(bool)
                    distinct, at, sizes = split_words(part.column("text"), lower=True)
                    trained = np.bincount(at[np.repeat(learn, sizes)], minlength=len(distinct))
                    for w, n in zip(distinct, trained.tolist(), strict=True):
                        seen[w] = seen.get(w, 0) + n
                    streams = byte_streams(part.column("text"))
                    for own, weight in ((learn, 1), (~learn, 0)):
                        if own.any():
                            got, n = np.unique(grams([streams[i] for i in np.flatnonzero(own).tolist()]), return_counts=True)
                            keys.append(got)
                            counts.append(n * weight)
                    if sum(map(len, keys[1:])) > 2 * MOST_KEYS:
                        got, n = merge(keys, counts)
                        keys, counts = [got], [n]
        if number is not None:
            yield from finish(number, keys, counts, seen)

    def finish(number, keys, counts, seen):
        got, n = merge(keys, counts)
        where = gram_shard(got, shards)
        order = np.argsort(where, kind="stable")
        got, n, cuts = got[order], n[order], np.searchsorted(where[order], np.arange(shards + 1))
        lists: list[list[bytes]] = [[] for _ in range(shards)]
        for w in seen:
            lists[crc32(w) % shards].append(w)
        for s in range(shards):
            part = slice(cuts[s], cuts[s + 1])
            yield batch(MODEL, [s], [ASKS], [number], [pack_sorted(got[part])], [pack(n[part])], [b" ".join(lists[s])], [pack(np.array([seen[w] for w in lists[s]], np.int64))])

    return by_slice(texts, partitions(texts.sparkSession)).mapInArrow(run, MODEL_SQL)


def answered(asks: DataFrame, top: Top, shards: int) -> DataFrame:
    """Per slice and shard: log10 of each requested key's probability and each word's training count."""

    def run(batches):
        for shard, held in by_group(batches, 0):
            keys, counts = counted(held)
            logs = top.log10(keys, subtree(keys, counts)[0]).astype(np.float32) if len(keys) else np.zeros(0, np.float32)
            seen: Counter = Counter()
            for r in held:
                for w, n in zip(r[5].split(), unpack(r[6]).tolist(), strict=True):
                    seen[w] += n
            for r in held:
                asked = unpack_sorted(r[3])
                known = np.array([seen[w] for w in r[5].split()], np.int64)
                yield batch(MODEL, [shard], [ASKS], [r[2]], [r[3]], [pack(logs[np.searchsorted(keys, asked)])], [r[5]], [pack(known)])

    return by_shard(asks, shards, "slice").mapInArrow(run, MODEL_SQL)


SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64()), ("bits_per_byte", pa.float64())])
SCORES_SQL = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, n_bytes bigint, bits_per_byte double"


def language_scores(docs: DataFrame, modulus: int = 10, held: int = 0, slice_bytes: int = 64_000_000) -> DataFrame:
    """Scores of every text under a byte model learned from the rows that are not held out.

    Texts are normalised to lower-case words with one space between them and an end mark. Slices of about
    `slice_bytes` of text, by hash of the row, send the keys and words they hold to shards of the context
    tree, which count, weigh and answer; nothing that grows with the corpus is broadcast or collected (the
    nodes above depth TOP are 65,280 at most). base_score is the add-0.1 unigram score of the tokens. Null
    or empty texts have the end token alone. Rows with a null id are scored and never learned
    from; repeated rows count as often as they occur. Other columns are not read.
    """
    rest = remainder("doc_id", modulus)
    shards = partitions(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (rest == held).alias("held_out"), ((rest != held) & (rest >= 0)).alias("learn"), "text")
    size = rows.agg(F.sum(F.octet_length("text")), F.sum(F.col("learn").cast("int")), F.count("*")).first()
    if not size[2]:
        return docs.sparkSession.createDataFrame([], SCORES_SQL)
    slices = -(-(size[0] or 1) // slice_bytes)
    texts = packed(rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(slices))))
    asks = staged(ask(texts, shards))
    # At most 65,280 nodes above depth TOP: every last byte with the bits known.
    sums = staged(top_sums(asks, shards))
    top = merged_nodes(sums)
    ends = int(size[1] or 0)
    words = sums.select("counts").mapInArrow(word_sums, "words bigint, tokens bigint").agg(F.sum("words"), F.sum("tokens")).first()
    distinct, tokens = (words[0] or 0) + (ends > 0), (words[1] or 0) + ends
    spread = np.log10(tokens + 0.1 * (distinct + 1))

    def run(batches):
        number, held, keys, logs, seen = None, [], None, None, {}
        for b in batches:
            for row in rows_of(b):
                if row[2] != number:
                    number, held, keys = row[2], [], None
                if row[1] == ASKS:
                    held.append(row)
                    continue
                if keys is None:
                    keys, logs = np.concatenate([unpack_sorted(r[3]) for r in held]), np.concatenate([unpack(r[4]) for r in held])
                    order = np.argsort(keys)
                    keys, logs = keys[order], logs[order].astype(np.float64)
                    seen = {w: n for r in held for w, n in zip(r[5].split(), unpack(r[6]).tolist(), strict=True)}
                    held = []
                # The keys of a few texts are put in order within the processor's cache.
                for part in unpacked(row[3], 250):
                    yield scored(part, keys, logs, seen)

    def scored(b: pa.RecordBatch, keys: np.ndarray, logs: np.ndarray, seen: dict) -> pa.RecordBatch:
        streams = byte_streams(b.column("text"))
        # Looked up in rising order: the places then lie next to each other in memory.
        wanted = grams(streams)
        order = np.argsort(wanted)
        own = np.empty(len(wanted))
        wanted = wanted[order]
        start = np.flatnonzero(np.diff(wanted, prepend=~wanted[:1]))
        own[order] = np.repeat(logs[np.searchsorted(keys, wanted[start])], np.diff(start, append=len(wanted)))
        sizes = np.fromiter(map(len, streams), np.int64, len(streams))
        scores = np.add.reduceat(own, np.cumsum(sizes) - sizes)
        own_words, at, tokens_in = split_words(b.column("text"), lower=True)
        # The end token follows the words of each text.
        begin = np.concatenate([[0], np.cumsum(tokens_in + 1)])
        counts = np.full(begin[-1], ends)
        inner = np.ones(begin[-1], bool)
        inner[begin[1:] - 1] = False
        counts[inner] = np.fromiter(map(seen.__getitem__, own_words), np.int64, len(own_words))[at]
        base = np.add.reduceat(np.log10(counts + 0.1) - spread, begin[:-1])
        known = np.add.reduceat((counts > 0).astype(np.int64), begin[:-1])
        n = np.diff(begin)
        return batch(SCORES, b.column("doc_id"), b.column("held_out"), n, known, np.full(len(n), tokens), base, scores, sizes, -scores / np.log10(2) / sizes)

    return by_slice(answered(asks, top, shards).unionByName(texts), shards).mapInArrow(run, SCORES_SQL)


def word_sums(batches):
    schema = pa.schema([("words", pa.int64()), ("tokens", pa.int64())])
    for b in batches:
        for c in b.column("counts").to_pylist():
            yield batch(schema, *[[x] for x in unpack(c).tolist()])


def merged_nodes(sums: DataFrame) -> Top:
    def spread(batches):
        schema = pa.schema([("node", pa.int64()), ("zeros", pa.float64()), ("ones", pa.float64()), ("below", pa.float64())])
        for b in batches:
            for k, v in zip(b.column("keys").to_pylist(), b.column("values").to_pylist(), strict=True):
                yield batch(schema, unpack(k).astype(np.int64), *np.frombuffer(v, np.float64).reshape(3, -1))

    rows = sums.select("keys", "values").mapInArrow(spread, "node bigint, zeros double, ones double, below double")
    got = rows.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")]).toPandas()
    return Top(got["node"].to_numpy(np.int64), *[got[c].to_numpy(np.float64) for c in ("zeros", "ones", "below")])
