"""Blocks of documents ask shards of keys: packed arrays travel instead of a row per word or window."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame

from wattloom.llm.wordcache import split_words

_MIX = np.uint64(0x9E3779B97F4A7C15)


def pack(values: np.ndarray) -> bytes:
    """An array as bytes: narrowed where its values allow, its byte planes apart, compressed."""
    values = np.ascontiguousarray(values)
    if values.dtype.kind in "iu" and len(values) and values.min() >= 0:
        values = values.astype(np.min_scalar_type(values.max()))
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return values.dtype.str[1:].encode() + zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(raw: bytes) -> np.ndarray:
    kind = np.dtype(raw[:2].decode())
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[2:]), np.uint8)
    return np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """A rising array of unsigned 64-bit values by its steps."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw).astype(np.uint64), dtype=np.uint64)


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of the texts in order, and the number of words of each text."""
    distinct, at, counts = split_words(texts)
    return hashes_of(distinct)[at], counts


def window_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of `length` word hashes; empty if there are fewer."""
    n = max(0, len(hashes) - length + 1)
    got = np.zeros(n, np.uint64)
    for i in range(length if n else 0):
        got = got * _MIX + hashes[i : n + i]
        got ^= got >> np.uint64(29)
    got *= np.uint64(0xBF58476D1CE4E5B9)
    return got ^ (got >> np.uint64(32))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of the hash, so that a shard's hashes lie close together."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def by_shard(df: DataFrame, shards: int, *order: str) -> DataFrame:
    return df.repartition(shards, "shard").sortWithinPartitions("shard", *order)
