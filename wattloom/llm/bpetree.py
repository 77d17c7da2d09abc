"""BPE ids of whole texts by tree concatenation: halves are encoded apart and joined where both sides agree."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from wattloom.llm.common import chunks, free, staged
from wattloom.llm.exchange import pack, unpack
from wattloom.llm.wordcache import WordCache, split_words

# A text of more characters is cut in halves until no part has more; parts are rows of their own.
LEAF = 32_768
# Characters on either side of a join that are encoded first; doubled until both sides agree.
WINDOW = 32
# Spans of a part's tokens are known at least this many characters from either end.
EDGE = 512
# Words that a worker remembers.
MOST_WORDS = 300_000
BLANK = re.compile("[\t-\r ]")


@dataclass
class Part:
    """A stretch of text and its tokens: ids, and the characters [start, end) each of them comes from.

    A token far from both ends may have an empty span, which no seam runs along.
    """

    text: str
    ids: np.ndarray
    start: np.ndarray
    end: np.ndarray


def encoded(tokenizer, text: str) -> Part:
    got = tokenizer.encode(text, add_special_tokens=False)
    spans = np.array(got.offsets, np.int64).reshape(-1, 2)
    return Part(text, np.array(got.ids, np.int64), spans[:, 0], spans[:, 1])


def seams(part: Part, low: int, high: int, shift: int = 0) -> dict[tuple, int]:
    """Places between two tokens of the part that lie in [low, high], each known by both tokens and their spans.

    A place counts only where a character ends, so that it is never inside a character of several byte tokens.
    """
    first, last = np.searchsorted(part.end, low - shift), np.searchsorted(part.start, high - shift, "right")
    got = {}
    ids, start, end = (x[first:last].tolist() for x in (part.ids, part.start, part.end))
    for i in range(len(ids) - 1):
        if start[i] < end[i] <= start[i + 1] < end[i + 1]:
            got[ids[i], start[i] + shift, end[i] + shift, ids[i + 1], start[i + 1] + shift, end[i + 1] + shift] = int(first) + i + 1
    return got


def joined(left: Part, right: Part, encode: Callable[[str], Part], window: int = WINDOW) -> Part:
    """Tokens of both texts as one. A window around the join is encoded and grows until it agrees with the left part
    on two tokens in a row, and with the right part on two others.

    That is exact: pre-tokens are found from left to right without looking back, so equal places stay equal, and
    a row of BPE tokens is the encoding of its text just if every two neighbours encode to themselves; each
    neighbouring pair of the result stands in one of the three encodings.
    """
    text, at = left.text + right.text, len(left.text)
    while True:
        low, high = max(0, at - window), min(len(text), at + window)
        mid = encode(text[low:high])
        found = seams(mid, low, high, low)
        before = [(found[k], i) for k, i in seams(left, low, at).items() if k in found] if low else [(0, 0)]
        after = [(found[k], i) for k, i in seams(right, at, high, at).items() if k in found] if high < len(text) else [(len(mid.ids), len(right.ids))]
        if before and after and min(before)[0] <= max(after)[0]:
            (m, i), (n, j) = min(before), max(after)
            return Part(
                text,
                np.concatenate([left.ids[:i], mid.ids[m:n], right.ids[j:]]),
                np.concatenate([left.start[:i], mid.start[m:n] + low, right.start[j:] + at]),
                np.concatenate([left.end[:i], mid.end[m:n] + low, right.end[j:] + at]),
            )
        window *= 2


def halves(text: str, leaf: int) -> list[str]:
    """The text cut in the middle, its halves again, until none is longer than `leaf`; all are cut equally often."""
    times = max(0, -(-len(text) // leaf) - 1).bit_length()
    cuts = [len(text) * i >> times for i in range((1 << times) + 1)]
    return [text[a:z] for a, z in zip(cuts[:-1], cuts[1:], strict=True)]


class Tree:
    """Joins the parts of one text as they come, equal heights first."""

    def __init__(self, encode: Callable[[str], Part]):
        self.encode, self.open = encode, []

    def add(self, part: Part) -> None:
        height = 0
        while self.open and self.open[-1][0] == height:
            part = joined(self.open.pop()[1], part, self.encode)
            height += 1
        self.open.append((height, part))

    def whole(self) -> Part:
        while len(self.open) > 1:
            (_, right), (height, left) = self.open.pop(), self.open.pop()
            self.open.append((height, joined(left, right, self.encode)))
        return self.open[0][1]


def tree_encode(tokenizer, text: str, leaf: int = LEAF) -> np.ndarray:
    """Ids of one text by the tree, in one process."""
    tree = Tree(lambda part: encoded(tokenizer, part))
    for part in halves(text, leaf):
        tree.add(encoded(tokenizer, part))
    return tree.whole().ids


def one_run(word: str) -> bool:
    """Whether the word stays letters alone when it is composed and put in lower case."""
    return word.isalpha() and (word.isascii() or (unicodedata.is_normalized("NFC", word) and word.lower().isalpha()))


class Words(WordCache):
    """Ids of words for a vocabulary whose pre-tokeniser drops white space; special tokens are found as the library does."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.marks = {m: tokenizer.encode(m, add_special_tokens=False).ids for m in ".,"}
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(1 + max(vocabulary.values(), default=0), bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True

    def numbers(self, distinct: list[bytes], at: np.ndarray) -> np.ndarray:
        if len(self.index) > MOST_WORDS:
            self.clear()
        return super().numbers(distinct, at)

    def ids_of(self, new: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Words of letters are encoded many at a time, told apart by their end marks, and with them the stems of
        words that end with a comma or a full stop, which is a run of its own; the others one by one."""
        texts = [w.decode("utf-8", "replace") for w in new]
        stems: dict[str, list[tuple[int, str]]] = {}
        odd = []
        for i, t in enumerate(texts):
            stem, mark = (t[:-1], t[-1]) if t[-1:] in self.marks else (t, "")
            if one_run(stem):
                stems.setdefault(stem, []).append((i, mark))
            else:
                odd.append(i)
        ids: list = [None] * len(new)
        runs = list(stems)
        groups = [runs[i : i + 200] for i in range(0, len(runs), 200)]
        for group, got in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            row = got.ids  # makes a list each time it is read
            own = np.array(row, np.int64)
            ends = np.flatnonzero(self.ends[own]) + 1
            whole = len(ends) == len(group) and ends[-1] == len(own)
            for stem, a, z in zip(group, [0, *ends[:-1].tolist()], ends.tolist(), strict=True) if whole else ():
                for i, mark in stems[stem]:
                    ids[i] = row[a:z] + self.marks[mark] if mark else row[a:z]
            odd += [] if whole else [i for stem in group for i, _ in stems[stem]]
        for i, got in zip(odd, self.tokenizer.encode_batch_fast([texts[i] for i in odd], add_special_tokens=False), strict=True):
            ids[i] = got.ids
        return new, np.array([x for one in ids for x in one], np.int32), np.array([len(one) for one in ids], np.int64)


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        plain = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in ("a b", "a", "b", "a\n\t b ")]
        # Only where white space leaves no trace may words be encoded apart.
        lower = self.tokenizer.encode("A", add_special_tokens=False).ids == plain[1]
        self.words = Words(self.tokenizer) if plain[0] == plain[1] + plain[2] == plain[3] and lower and self.tokenizer.get_vocab().get("a</w>") is not None else None

    def short(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self.words is None:
            return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts.fill_null("").to_pylist(), add_special_tokens=False)]
        # A-Z is put in lower case here, as fewer words are then new; not where a mark could compose with the letter, or
        # where it could make a special token.
        as_given = pc.match_substring_regex(texts.fill_null(""), "[\u0300-\u036f]|<\\|")
        distinct, at, counts = split_words(pc.if_else(as_given, texts, pc.ascii_lower(texts)))
        ids, ends = self.words.gathered(self.words.numbers(distinct, at))
        raw = memoryview(ids.astype("<u4").tobytes())
        cuts = (ends[np.concatenate([[0], np.cumsum(counts)])] * 4).tolist()
        return [bytes(raw[a:z]) for a, z in zip(cuts[:-1], cuts[1:], strict=True)]


    def parts(self, texts: list[str]) -> list[Part]:
        """Each text with its tokens; what lies between two blanks far from its ends is encoded by words."""
        cuts = []
        for t in texts:
            first = BLANK.search(t, EDGE) if self.words is not None else None
            last = max(t.rfind(c, 0, max(0, len(t) - EDGE)) for c in "\t\n\x0b\x0c\r ") if first else -1
            cuts.append((first.start(), last) if first and first.start() < last else None)
        between = [t[c[0] : c[1]] for t, c in zip(texts, cuts, strict=True) if c]
        inner = iter(self.short(pa.array(between, pa.string())) if between else ())
        got = []
        for t, c in zip(texts, cuts, strict=True):
            if c is None:
                got.append(encoded(self.tokenizer, t))
                continue
            head, tail, ids = encoded(self.tokenizer, t[: c[0]]), encoded(self.tokenizer, t[c[1] :]), np.frombuffer(next(inner), "<u4").astype(np.int64)
            empty = np.full(len(ids), c[0])
            columns = (head.ids, ids, tail.ids), (head.start, empty, tail.start + c[1]), (head.end, empty, tail.end + c[1])
            got.append(Part(t, *(np.concatenate(x) for x in columns)))
        return got


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", leaf: int = LEAF) -> DataFrame:
    """Every row with the ids of its whole text, as the tokenizers library gives them without special tokens added:
    binary, little-endian unsigned 32-bit integers.

    A null or empty text has no ids. Repeated rows stay repeated; all other columns stay, whatever their names; `ids`
    gets underscores where the name is taken. A text of up to `leaf` characters is encoded where it is. Longer ones
    are cut in halves at any character; the parts, rows of their own, are encoded by whichever task gets them, and
    joined pairwise. A task holds one text and its tokens at a time.
    """
    ids = free(ids, docs.columns)
    schema = StructType([*docs.schema.fields, StructField(ids, BinaryType(), False)])

    def here(batches):
        to_ids = encoder(vocabulary)
        for b in chunks(batches, 2_000_000, text):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(to_ids.short(b.column(text)), pa.binary())], names=[*b.schema.names, ids])

    long_text = F.coalesce(F.length(text), F.lit(0)) > leaf
    return docs.where(~long_text).mapInArrow(here, schema).unionByName(in_parts(docs.where(long_text), vocabulary, text, ids, leaf))


PART = StructType([StructField("key", LongType()), StructField("part", IntegerType()), StructField("text", StringType())])
TOKENS = StructType([*PART.fields, StructField("ids", BinaryType()), StructField("start", BinaryType()), StructField("end", BinaryType())])
WHOLE = StructType([StructField("key", LongType()), StructField("ids", BinaryType())])


def in_parts(docs: DataFrame, vocabulary: str, text: str, ids: str, leaf: int) -> DataFrame:
    """The rows with the ids of their texts, by way of parts."""
    key = free("key", [*docs.columns, ids])
    # Written first: the numbers of the rows hold even if a task runs again.
    held = staged(docs.withColumn(key, F.monotonically_increasing_id()))

    def cut(batches):
        for b in chunks(batches):
            rows = [(k, i, part) for k, t in zip(b.column("key").to_pylist(), b.column("text").to_pylist(), strict=True) for i, part in enumerate(halves(t, leaf))]
            for i in range(0, len(rows), 64):
                numbers, at, parts = zip(*rows[i : i + 64], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(at, pa.int32()), pa.array(parts, pa.string())], names=PART.names)

    def tokens(batches):
        for b in chunks(batches, 2_000_000):
            got = encoder(vocabulary).parts(b.column("text").to_pylist())
            sides = [pa.array([pack(getattr(p, side)) for p in got], pa.binary()) for side in ("ids", "start", "end")]
            yield pa.RecordBatch.from_arrays([*b.columns, *sides], names=TOKENS.names)

    def climb(batches):
        tokenizer = encoder(vocabulary).tokenizer
        key, tree = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([tree.whole().ids.astype("<u4").tobytes()], pa.binary())], names=WHOLE.names)

        for b in batches:
            for row in b.to_pylist():
                if row["key"] != key:
                    if tree:
                        yield done()
                    key, tree = row["key"], Tree(lambda part: encoded(tokenizer, part))
                tree.add(Part(row["text"], *(unpack(row[side]).astype(np.int64) for side in ("ids", "start", "end"))))
        if tree:
            yield done()

    parts = held.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(cut, PART).repartition("key", "part").mapInArrow(tokens, TOKENS)
    whole = parts.repartition("key").sortWithinPartitions("key", "part").mapInArrow(climb, WHOLE)
    return held.join(whole.select(F.col("key").alias(key), F.col("ids").alias(ids)), key).drop(key)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Every row with the text of its ids, as the library's decode(ids, skip_special_tokens=False) gives it: a null row
    of ids is empty, unknown ids are passed over. All columns stay; `decoded` gets underscores where the name is taken."""
    decoded = free(decoded, df.columns)

    def texts(batches):
        tokenizer = encoder(vocabulary).tokenizer
        known = tokenizer.get_vocab(with_added_tokens=True)
        tokens = [tokenizer.id_to_token(i) for i in range(1 + max(known.values(), default=0))]
        table, there = pa.array(tokens, pa.string()), np.array([t is not None for t in tokens])
        for b in chunks(batches, 2_000_000, ids):
            rows = [np.frombuffer(r or b"", "<u4").astype(np.int64) for r in b.column(ids).to_pylist()]
            if tokenizer.decoder is None:
                rows = [r[there[np.minimum(r, len(there) - 1)] & (r < len(there))] for r in rows]
                flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
                ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
                got = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), table.take(pa.array(flat))), " ")
            else:
                got = pa.array(tokenizer.decode_batch([r.tolist() for r in rows], skip_special_tokens=False), pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, got], names=[*b.schema.names, decoded])

    return df.mapInArrow(texts, StructType([*df.schema.fields, StructField(decoded, StringType(), False)]))


def round_trip(docs: DataFrame, vocabulary: str, leaf: int = LEAF) -> DataFrame:
    """doc_id, number of ids, and digests of the ids and of the decoded text of every row."""
    got = decode(encode(docs.select("doc_id", "text"), vocabulary, leaf=leaf).drop("text"), vocabulary)
    n = F.octet_length("ids").cast("long")
    return got.select("doc_id", (n / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
