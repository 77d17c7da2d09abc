"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import batch, chunks, free
from wattloom.llm.exchange import hashes_of, window_hashes
from wattloom.llm.wordcache import split_words

# ASCII punctuation parts words as white space does.
_PARTS = bytes(32 if chr(i) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else i for i in range(128)) + bytes(range(128, 256))
VERDICT = pa.schema([("n_items", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("items", pa.list_(pa.int64())), ("contaminated", pa.bool_())])
VERDICT_SQL = "n_items:bigint,item_id:bigint,coverage:double,items:array<bigint>,contaminated:boolean"


def tokens_of(word: bytes) -> list[bytes]:
    return word.decode("utf-8", "replace").lower().encode().translate(_PARTS).split()


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each token of the texts in order, and the number of tokens of each text. Tokens are
    lower-case, parted by white space and ASCII punctuation; each distinct word is taken apart once."""
    distinct, at, counts = split_words(texts)
    parts = [tokens_of(w) for w in distinct]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    hashes = hashes_of([t for p in parts for t in p])
    first, own = np.cumsum(sizes) - sizes, sizes[at]
    ends = np.concatenate([[0], np.cumsum(own)])
    got = hashes[np.repeat(first[at] - ends[:-1], own) + np.arange(ends[-1])]
    return got, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])


def diagonals(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Maximal matches (length, place in item, place in doc) of at least `least` words, by equal hashes of
    `least` words that follow one another on a diagonal."""
    a, b = window_hashes(item, least), window_hashes(doc, least)
    order = np.argsort(a, kind="stable")
    low, high = np.searchsorted(a[order], b, "left"), np.searchsorted(a[order], b, "right")
    j = np.repeat(np.arange(len(b)), high - low)
    i = order[np.repeat(low, high - low) + np.arange(len(j)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)]
    if not len(j):
        return []
    rank = np.lexsort((i, j - i))
    i, j = i[rank], j[rank]
    start = np.flatnonzero(np.r_[True, (np.diff(j - i) != 0) | (np.diff(i) != 1)])
    runs = np.diff(start, append=len(i)) + least - 1
    return list(zip(runs.tolist(), i[start].tolist(), j[start].tolist(), strict=True))


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: the longest match of unmarked words is marked first, in item order on ties; what a
    mark leaves of a longer match stays in the running while it has `least` words."""
    heap = [(-n, i, j) for n, i, j in diagonals(item, doc, least)]
    heapq.heapify(heap)
    in_item, in_doc, got = np.zeros(len(item), bool), np.zeros(len(doc), bool), []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = ~(in_item[i : i + n] | in_doc[j : j + n])
        if free.all():
            in_item[i : i + n] = in_doc[j : j + n] = True
            got.append((n, i, j))
            continue
        edges = np.flatnonzero(np.diff(np.r_[False, free, False].astype(np.int8)))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if hi - lo >= least:
                heapq.heappush(heap, (lo - hi, i + lo, j + lo))
    return got


class Items:
    """Benchmark items with the seeds they contain."""

    def __init__(self, rows: list[tuple[int, str]], least: int):
        self.least = least
        got = [(i, token_hashes(pa.array([t]))[0]) for i, t in rows]
        got = [(i, h) for i, h in got if len(h) >= least]
        self.ids, self.hashes = [i for i, _ in got], [h for _, h in got]
        seeds = [window_hashes(h, least) for h in self.hashes]
        flat = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(got)), [len(s) for s in seeds])
        order = np.argsort(flat, kind="stable")
        self.seeds, self.owner = flat[order], owner[order]
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.seeds & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def verdicts(self, texts: pa.Array, threshold: float):
        """(items that share a seed, best item, its coverage, items at or over the threshold) for each text."""
        hashes, counts = token_hashes(texts)
        first = np.cumsum(counts) - counts
        got = window_hashes(hashes, self.least)
        row = np.repeat(np.arange(len(counts)), counts)
        n = len(got)
        hit = np.flatnonzero(self.bits[(got & np.uint64((1 << 20) - 1)).astype(np.int64)] & (row[:n] == row[self.least - 1 :])) if n else np.zeros(0, np.int64)
        low, high = np.searchsorted(self.seeds, got[hit], "left"), np.searchsorted(self.seeds, got[hit], "right")
        pairs: dict[int, set[int]] = {}
        for r, a, b in zip(row[hit].tolist(), low.tolist(), high.tolist(), strict=True):
            if b > a:
                pairs.setdefault(r, set()).update(self.owner[a:b].tolist())
        for r in range(len(counts)):
            doc = hashes[first[r] : first[r] + counts[r]]
            covered = sorted((-sum(t[0] for t in tiles(self.hashes[k], doc, self.least)) / len(self.hashes[k]), self.ids[k]) for k in pairs.get(r, ()))
            yield (len(covered), covered[0][1] if covered else None, -covered[0][0] if covered else 0.0, sorted(i for c, i in covered if -c >= threshold))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_items, item_id, coverage, items and contaminated of every document row; see judged()."""
    return judged(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), benchmark, **options).select("doc_id", "_tiling.*")


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows that are not contaminated, with all their columns."""
    name = free("_tiling", docs.columns)
    return judged(docs, benchmark, name=name, **options).where(~F.col(f"{name}.contaminated")).select(*[f"`{c}`" for c in docs.columns])


def judged(docs: DataFrame, benchmark: DataFrame, least: int = 5, threshold: float = 0.6, most_bytes: int = 32_000_000, name: str = "_tiling") -> DataFrame:
    """All columns of `docs` and a struct `name`: n_items, item_id, coverage, items, contaminated.

    Documents and items meet by a shared run of `least` words (case and punctuation aside). Greedy string
    tiling then covers the item with non-overlapping matches, wherever they stand in the document, so
    reordered passages count in full. A document is contaminated if the covered share of an item's words
    reaches the threshold. item_id is the best item, the smallest id on ties; items are all at or over the
    threshold, n_items those that share a run. The items travel to every task while the table has at most `most_bytes` of
    text, which is counted first; a larger one is joined by seeds. Items with fewer words than `least`,
    null items and null texts match nothing. Null ids and repeated rows of documents stay as they are, a
    repeated item row counts once.
    """
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("bigint").alias("item_id"), "text").distinct()
    if (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > most_bytes:
        return _joined(docs, items, least, threshold, name)
    known = docs.sparkSession.sparkContext.broadcast(sorted((r.item_id, r.text) for r in items.collect()))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches):
        own = Items(known.value, least)
        for b in chunks(batches, 4_000_000):
            got = list(own.verdicts(b.column("text"), threshold))
            parts = batch(VERDICT, *zip(*[(*v, bool(v[3])) for v in got], strict=True))
            struct = pa.StructArray.from_arrays(parts.columns, fields=list(VERDICT))
            yield pa.RecordBatch.from_arrays([*b.columns, struct], names=[*b.schema.names, name])

    return docs.mapInArrow(run, f"{kinds}, {name} struct<{VERDICT_SQL}>")


def _joined(docs: DataFrame, items: DataFrame, least: int, threshold: float, name: str) -> DataFrame:
    """The same for a benchmark of any size: seeds are joined by a shuffle, then each pair meets once."""
    seeds = pa.schema([("seed", pa.int64()), ("key", pa.int64())])

    def emit(batches):
        for b in batches:
            hashes, counts = token_hashes(b.column("text"))
            for key, own in zip(b.column("key").to_pylist(), np.split(hashes, np.cumsum(counts)[:-1]), strict=True):
                got = np.unique(window_hashes(own, least)).view(np.int64)
                if len(got):
                    yield batch(seeds, got, np.full(len(got), key))

    # Equal texts share a key; the key stands for the text in the join.
    own, found_as = free("_key", docs.columns), free("_best", docs.columns)
    keyed = docs.withColumn(own, F.xxhash64("text"))
    texts = keyed.where("text IS NOT NULL").select(F.col(own).alias("key"), "text").dropDuplicates(["key"])
    named = items.withColumn("key", F.xxhash64("item_id", "text"))
    left = texts.mapInArrow(emit, "seed bigint, key bigint")
    right = named.select("key", "text").mapInArrow(emit, "seed bigint, key bigint").withColumnRenamed("key", "item_key")
    pairs = left.join(right, "seed").select("key", "item_key").distinct()
    both = pairs.join(texts, "key").join(named.select(F.col("key").alias("item_key"), "item_id", F.col("text").alias("item")), "item_key")
    covered = pa.schema([("key", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64())])

    def cover(batches):
        for b in batches:
            share = []
            for text, item in zip(b.column("text").to_pylist(), b.column("item").to_pylist(), strict=True):
                p = token_hashes(pa.array([item]))[0]
                share.append(sum(t[0] for t in tiles(p, token_hashes(pa.array([text]))[0], least)) / len(p))
            yield batch(covered, b.column("key"), b.column("item_id"), share)

    found = both.select("key", "item_id", "text", "item").mapInArrow(cover, "key bigint, item_id bigint, coverage double")
    at = F.col("coverage") >= threshold
    best = found.groupBy(F.col("key").alias(own)).agg(
        F.count("*").alias("n"), F.min(F.struct((-F.col("coverage")).alias("less"), "item_id")).alias("best"), F.sort_array(F.collect_list(F.when(at, F.col("item_id")))).alias("all")
    )
    verdict = F.struct(
        F.coalesce(F.col(f"{found_as}.n"), F.lit(0)).cast("bigint").alias("n_items"), F.col(f"{found_as}.best.item_id").alias("item_id"), F.coalesce(-F.col(f"{found_as}.best.less"), F.lit(0.0)).alias("coverage"),
        F.coalesce(F.col(f"{found_as}.all"), F.array().cast("array<bigint>")).alias("items"), F.coalesce(F.size(f"{found_as}.all") > 0, F.lit(False)).alias("contaminated"),
    )
    got = keyed.join(best.select(own, F.struct("n", "best", "all").alias(found_as)), own, "left")
    return got.select(*[f"`{c}`" for c in docs.columns], verdict.alias(name))
