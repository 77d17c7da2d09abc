"""Words of a column of texts, and ids of texts by way of their words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MOST_WORDS = 1_000_000
_MARKS = "[\u0300-\u036f]"


def as_list(values: pa.Array) -> list[bytes]:
    """A string array without nulls as bytes."""
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].tolist()
    raw = values.buffers()[2].to_pybytes() if values.buffers()[2] else b""
    return [raw[a:z] for a, z in zip(ends[:-1], ends[1:], strict=True)]


def split_words(texts: pa.Array, lower: bool = False, spare_marks: bool = False) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of the texts, the place of each word among them, and the number of words of each text.

    Words are runs without 0x20 and 0x09-0x0D; a null text has none. `lower` turns A-Z to lower case, except,
    with `spare_marks`, in texts with a combining mark, which could compose with the letter.
    """
    texts = texts.fill_null("")
    if lower:
        small = pc.ascii_lower(texts)
        texts = pc.if_else(pc.match_substring_regex(texts, _MARKS), texts, small) if spare_marks else small
    if not len(texts):
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts = pc.ascii_split_whitespace(texts)
    counts = pc.list_value_length(parts).to_numpy().astype(np.int64)
    held = parts.flatten().dictionary_encode()
    at, distinct = held.indices.to_numpy().astype(np.int64), as_list(held.dictionary)
    if b"" in distinct:  # white space at the ends, or an empty text
        empty = distinct.index(b"")
        real = at != empty
        counts = np.bincount(np.repeat(np.arange(len(counts)), counts)[real], minlength=len(counts))
        at = at[real]
        at -= at > empty
        del distinct[empty]
    return distinct, at, counts


class WordCache:
    """Each word is encoded once and kept; beyond MOST_WORDS words the cache starts anew."""

    def __init__(self):
        self.clear()

    def ids_of(self, new: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The words in any order, all their ids one after the other, and the number of ids of each."""
        raise NotImplementedError

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 20, np.int32), 0
        self.first, self.count = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int64)

    def _keep(self, new: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        n, at = len(self.index), self.used
        while at + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while n + len(new) > len(self.first):
            self.first, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.first, self.count))
        self.flat[at : at + len(ids)] = ids
        self.first[n : n + len(new)] = at + np.cumsum(counts) - counts
        self.count[n : n + len(new)] = counts
        self.used += len(ids)
        self.index.update(zip(new, range(n, n + len(new)), strict=True))

    def learn(self, new: list[bytes]) -> None:
        if new:
            self._keep(*self.ids_of(new))

    def numbers(self, distinct: list[bytes], at: np.ndarray) -> np.ndarray:
        """A number for each word, which holds until the next call."""
        new = [w for w in distinct if w not in self.index]
        if len(self.index) + len(new) > MOST_WORDS:
            self.clear()
            new = distinct
        self.learn(new)
        return np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))[at]

    def gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all these words in order, and where the ids of each word begin (one more at the end)."""
        counts = self.count[at]
        ends = np.concatenate([[0], np.cumsum(counts)])
        return self.flat[np.repeat(self.first[at] - ends[:-1], counts) + np.arange(ends[-1])], ends
