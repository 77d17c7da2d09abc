"""Repeated word windows over a corpus, found at difference-cover positions and then extended."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import batch, chunks, partitions, words
from wattloom.llm.exchange import by_shard, pack, pack_sorted, shard_of, unpack, unpack_sorted, window_hashes, word_hashes

# Every difference modulo 7 is the difference of two members of {0, 1, 3}.
PERIOD, COVER = 7, (0, 1, 3)
LAST_ID = (1 << 63) - 1  # stands for a null id while keys travel
ASKED = pa.schema([("block", pa.int64()), ("shard", pa.int32()), ("hashes", pa.binary()), ("places", pa.binary()), ("marks", pa.binary())])
ASKED_SQL = "block bigint, shard int, hashes binary, places binary, marks binary"
FOUND = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("places", pa.binary())])
FOUND_SQL = "doc_id bigint, text_hash bigint, places binary"
INDEX = -1


def block_words(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, the row it is in, and its position there."""
    hashes, counts = word_hashes(b.column("text"))
    first = np.repeat(np.cumsum(counts) - counts, counts)
    return hashes, np.repeat(np.arange(len(counts)), counts), np.arange(len(hashes)) - first


def asked(block: int, b: pa.RecordBatch, counts: np.ndarray, hashes: np.ndarray, places: np.ndarray, marks: np.ndarray, shards: int):
    """Rows of a block: one for each shard with its hashes in rising order, their places in the block and a
    mark each, and one that tells which rows the block has."""
    order = np.argsort(hashes, kind="stable")
    hashes, places, marks = hashes[order], places[order], marks[order]
    cuts = np.searchsorted(shard_of(hashes, shards), np.arange(shards + 1))
    ids = b.column("doc_id").fill_null(LAST_ID).to_numpy(zero_copy_only=False)
    rows = [(block, INDEX - block % shards, pack(ids.astype(np.int64)), pack(counts), b.column("text_hash").to_numpy(zero_copy_only=False).tobytes())]
    for s in np.flatnonzero(np.diff(cuts)).tolist():
        part = slice(cuts[s], cuts[s + 1])
        rows.append((block, s, pack_sorted(hashes[part]), pack(places[part]), pack(marks[part])))
    return batch(ASKED, *zip(*rows, strict=True))


def numbered(batches, size: int):
    """Blocks with an id each that is the same in every attempt of the task: input order is fixed by the scan or a sort."""
    for i, b in enumerate(chunks(batches, size)):
        yield (TaskContext.get().partitionId() << 24) | i, b


def ask_anchors(docs: DataFrame, shards: int, size: int) -> DataFrame:
    """Hashes of PERIOD-word windows at cover positions; the mark says that another row of the block has it too."""

    def run(batches):
        for block, b in numbered(batches, size):
            hashes, row, at = block_words(b)
            got = window_hashes(hashes, PERIOD)
            n = len(got)
            use = np.flatnonzero((row[:n] == row[PERIOD - 1 :]) & np.isin(at[:n] % PERIOD, COVER)) if n else np.zeros(0, np.int64)
            keys, rows = got[use], row[use]
            order = np.argsort(keys, kind="stable")
            start = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[:1]])) if n and len(use) else np.zeros(0, np.int64)
            shared = np.zeros(len(use), bool)
            if len(start):
                ranked = rows[order]
                several = np.minimum.reduceat(ranked, start) < np.maximum.reduceat(ranked, start)
                shared[order] = np.repeat(several, np.diff(start, append=len(use)))
            yield asked(block, b, np.bincount(row, minlength=b.num_rows), keys, use, shared.astype(np.uint8), shards)

    return docs.mapInArrow(run, ASKED_SQL)


def ask_windows(docs: DataFrame, shards: int, size: int, length: int) -> DataFrame:
    """Hashes of the whole windows around anchors that several rows share; the mark is the document's id."""

    def run(batches):
        for block, b in numbered(batches, size):
            hashes, row, at = block_words(b)
            got = window_hashes(hashes, length)
            n = len(got)
            counts = np.bincount(row, minlength=b.num_rows)
            first = np.cumsum(counts) - counts
            candidate = np.zeros(len(row) + length, np.int64)
            for i, raw in enumerate(b.column("places").to_pylist()):
                if raw is not None:
                    anchor = unpack(raw).astype(np.int64) + first[i]
                    # The anchor lies inside windows that start up to length - PERIOD words before it.
                    np.add.at(candidate, np.maximum(anchor - (length - PERIOD), first[i]), 1)
                    np.add.at(candidate, anchor + 1, -1)
            use = np.flatnonzero((np.cumsum(candidate)[:n] > 0) & (row[:n] == row[length - 1 :])) if n else np.zeros(0, np.int64)
            ids = b.column("doc_id").fill_null(LAST_ID).to_numpy(zero_copy_only=False)
            yield asked(block, b, counts, got[use], use, ids[row[use]], shards)

    return docs.mapInArrow(run, ASKED_SQL)


def answer(requests: DataFrame, shards: int, repeated) -> DataFrame:
    """Places for which `repeated(marks by block, group of each)` holds, as (doc_id, text_hash, places in the text).

    A shard's requests are merged by one sort of their hashes; its size is the input's over the shards.
    """

    def resolve(held):
        parts = [(unpack_sorted(r[1]), unpack(r[2]), unpack(r[3])) for r in held]
        sizes = [len(p[0]) for p in parts]
        keys, marks = np.concatenate([p[0] for p in parts]), np.concatenate([p[2].astype(np.int64) for p in parts])
        owner = np.repeat(np.arange(len(parts)), sizes)
        order = np.argsort(keys, kind="stable")
        start = np.flatnonzero(np.diff(keys[order], prepend=~keys[order[:1]]))
        hit = np.empty(len(keys), bool)
        hit[order] = repeated(marks[order], owner[order], start)
        for (block, *_), part, mine in zip(held, parts, np.split(hit, np.cumsum(sizes)[:-1]), strict=True):
            if mine.any():
                yield (block, 0, None, pack(np.sort(part[1][mine])), None)

    def run(batches):
        shard, held = None, []
        for b in batches:
            for block, at, *raw in zip(*[b.column(c).to_pylist() for c in ASKED.names], strict=True):
                if at < 0:
                    yield batch(ASKED, [block], [INDEX], *[[x] for x in raw])
                    continue
                if at != shard and held:
                    yield batch(ASKED, *zip(*got, strict=True)) if (got := list(resolve(held))) else batch(ASKED, [], [], [], [], [])
                    held = []
                shard = at
                held.append((block, *raw))
        if held and (got := list(resolve(held))):
            yield batch(ASKED, *zip(*got, strict=True))

    def gather(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        index = next(r for r in rows if r["shard"] == INDEX)
        parts = [unpack(r["places"]).astype(np.int64) for r in rows if r["shard"] != INDEX]
        places = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)
        ids, counts, texts = unpack(index["hashes"]).astype(np.int64), unpack(index["places"]).astype(np.int64), np.frombuffer(index["marks"], np.int64)
        first = np.cumsum(counts) - counts
        cuts = np.searchsorted(places, np.append(first, counts.sum()))
        out = [(None if i == LAST_ID else i, h, pack(places[a:z] - f)) for i, h, f, a, z in zip(ids.tolist(), texts.tolist(), first.tolist(), cuts[:-1], cuts[1:], strict=True) if z > a]
        return pa.Table.from_batches([batch(FOUND, *zip(*out, strict=True))] if out else [], FOUND)

    answers = by_shard(requests, shards, "block").mapInArrow(run, ASKED_SQL)
    return answers.groupBy("block").applyInArrow(gather, FOUND_SQL)


def in_several(marks: np.ndarray, owner: np.ndarray, start: np.ndarray) -> np.ndarray:
    several = (np.minimum.reduceat(owner, start) < np.maximum.reduceat(owner, start)) | (np.maximum.reduceat(marks, start) > 0)
    return np.repeat(several, np.diff(start, append=len(marks)))


def in_earlier(marks: np.ndarray, owner: np.ndarray, start: np.ndarray) -> np.ndarray:
    return np.repeat(np.minimum.reduceat(marks, start), np.diff(start, append=len(marks))) < marks


def repeated_windows(docs: DataFrame, length: int = 13, size: int = 16_000_000) -> tuple[DataFrame, DataFrame]:
    """Documents with a hash of their text, and for each (doc_id, text_hash) the window starts seen in a smaller id."""
    shards = partitions(docs.sparkSession)
    if length < 2 * PERIOD - 1:
        raise ValueError(f"windows of {length} words need not hold an aligned anchor of {PERIOD}")
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    anchors = answer(ask_anchors(keyed, shards, size), shards, in_several)
    return keyed, answer(ask_windows(matched(keyed, anchors), shards, size, length), shards, in_earlier)


def matched(keyed: DataFrame, found: DataFrame) -> DataFrame:
    """The documents with their places; equal rows have equal places, so one of them is enough.

    Both joins of the operator deal the texts by the same keys, so that Spark shuffles them once.
    """
    one = found.dropDuplicates(["doc_id", "text_hash"]).select(F.col("doc_id").alias("d"), F.col("text_hash").alias("h"), "places")
    return keyed.join(one, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left").drop("d", "h")


def remove_repeats(docs: DataFrame, length: int = 13, size: int = 16_000_000) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words that stay, joined by one space) for every row.

    A word goes if a window of `length` words that covers it also starts in a document with a smaller id.
    Windows are judged on the input. Candidates come from anchors of PERIOD words at positions whose
    remainder is in the difference cover, so any two equal windows share an aligned anchor; windows around
    shared anchors are then compared whole, by a 64-bit hash within a shard of its range. Null or empty
    texts have no words. A null id counts as larger than any other; rows with equal ids are one document
    to the rule and rows of their own in the result. Other columns are not read.
    """
    keyed, found = repeated_windows(docs, length, size)
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(batches):
        for b in chunks(batches):
            out = []
            for doc_id, text, raw in zip(*[b.column(c).to_pylist() for c in ("doc_id", "text", "places")], strict=True):
                split = words(text)
                stay = split
                if raw is not None:
                    at = unpack(raw).astype(np.int64)
                    steps = np.zeros(len(split) + 1, np.int64)
                    steps[at] += 1
                    np.add.at(steps, at + length, -1)
                    gone = np.cumsum(steps)[:-1] > 0
                    stay = [w for w, g in zip(split, gone.tolist(), strict=True) if not g]
                out.append((doc_id, len(split), len(split) - len(stay), b" ".join(stay).decode("utf-8", "replace")))
            yield batch(schema, *zip(*out, strict=True))

    return matched(keyed, found).select("doc_id", "text", "places").mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def kept_digest(removed: DataFrame) -> DataFrame:
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

