"""Tokeniser fertility: how a public vocabulary splits a text tells prose from noise."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import batch, chunks, staged
from wattloom.llm.wordcache import WordCache, split_words

# First code points of script ranges and the script of each range.
RANGES = [
    (0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"), (0x590, "hebrew"), (0x600, "arabic"), (0x780, "other"),
    (0x900, "indic"), (0xE00, "thai"), (0xE80, "other"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"), (0x40000, "other"),
]
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
MEASURES = {"chars_per_token": 100, "byte_share": 1000, "token_entropy": 50}
FIRST = np.array([a for a, _ in RANGES])
NAMES = sorted({b for _, b in RANGES})
SCRIPT_AT = np.array([NAMES.index(b) for _, b in RANGES])


class PieceIds(WordCache):
    """Ids of the vocabulary with byte fallback, a word at a time."""

    def __init__(self, path: str):
        import sentencepiece

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.get_piece_size())])

    def ids_of(self, new: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        got = self.model.encode([w.decode("utf-8", "replace") for w in new], num_threads=1)
        return new, np.array([x for g in got for x in g], np.int32), np.array([len(g) for g in got], np.int64)


@lru_cache(1)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


def script_of(text: str) -> str:
    """Script with most letters; `latin` for ASCII, `other` without a letter outside ASCII's."""
    if text.isascii():
        return "latin"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    letters = points[(points > 0x7F) | ((points | 32) - 97 < 26)]
    got = np.bincount(SCRIPT_AT[np.searchsorted(FIRST, letters, "right") - 1], minlength=len(NAMES))
    return NAMES[int(got.argmax())]


def repeated_words(at: np.ndarray) -> int:
    """Words inside a window of three words that the text holds twice or more, the first window included."""
    if len(at) < 4:
        return 0
    keys = (at[:-2] << 42) | (at[1:-1] << 21) | at[2:]
    ranked = np.sort(keys)
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    if not len(twice):
        return 0
    hit = np.isin(keys, twice)
    covered = np.zeros(len(at), bool)
    for shift in range(3):
        covered[shift : shift + len(hit)] |= hit
    return int(covered.sum())


def text_measures(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per document: counts of words, symbols and repeats, and how the vocabulary splits the words."""
    kinds = {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint", "n_repeat_words": "bigint", "n_tokens": "bigint"}
    kinds |= {"script": "string"} | dict.fromkeys(MEASURES, "double")
    arrow = {"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}
    schema = pa.schema([(k, arrow[v]) for k, v in kinds.items()])

    def measure(batches):
        cache = piece_ids(vocabulary)
        for b in chunks(batches, 4_000_000):
            texts = [t or "" for t in b.column("text").to_pylist()]
            distinct, at, counts = split_words(b.column("text"))
            at = cache.numbers(distinct, at)
            ids, starts = cache.gathered(at)
            cuts = np.cumsum([0, *counts]).tolist()
            out = []
            for doc_id, text, a, z in zip(b.column("doc_id").to_pylist(), texts, cuts[:-1], cuts[1:], strict=True):
                lines = [x for x in text.split("\n") if x.strip(SPACES)]
                own = ids[starts[a] : starts[z]]
                n, chars = len(own), len(text) - sum(map(text.count, SPACES))
                counts = np.bincount(np.unique(own, return_inverse=True)[1]) if n else np.ones(1)
                entropy = float(np.log2(n) - (counts * np.log2(counts)).sum() / n) if n else 0.0
                byte = float(cache.is_byte[own].mean()) if n else 0.0
                out.append((doc_id, z - a, chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(at[a:z]), n, script_of(text), chars / n if n else 0.0, byte, max(entropy, 0.0)))
            yield batch(schema, *zip(*out, strict=True))

    return docs.select("doc_id", "text").mapInArrow(measure, ", ".join(f"{k} {v}" for k, v in kinds.items()))


def bands(measured: DataFrame, width: float) -> DataFrame:
    """Per script and measure: the median, less or more `width` times the way from it to the 5 % and 95 % points.

    Quantiles come from counts per rounded value over all rows, so they are exact at that rounding and
    the same in any order; the counted table has a bounded number of rows per script.
    """
    long = measured.select("script", F.explode(F.map_from_arrays(F.array(*map(F.lit, MEASURES)), F.array(*[F.round(F.col(m) * scale).cast("bigint") for m, scale in MEASURES.items()]))).alias("measure", "bin"))
    counted = long.groupBy("script", "measure", "bin").count()
    by = Window.partitionBy("script", "measure")
    ranked = counted.withColumn("share", F.sum("count").over(by.orderBy("bin")) / F.sum("count").over(by))
    scale = F.create_map(*[F.lit(x) for m, s in MEASURES.items() for x in (m, float(s))])
    point = lambda q: F.min(F.when(F.col("share") >= q, F.col("bin")))
    points = ranked.groupBy("script", "measure").agg(point(0.05).alias("low"), point(0.5).alias("mid"), point(0.95).alias("high"))
    # A band is never narrower than a tenth of the median and 0.02 on either side.
    spread = lambda x: F.greatest(x * width, F.abs(F.col("mid")) * 0.1, 0.02 * scale[F.col("measure")])
    points = points.withColumn("least", (F.col("mid") - spread(F.col("mid") - F.col("low"))) / scale[F.col("measure")]).withColumn("most", (F.col("mid") + spread(F.col("high") - F.col("mid"))) / scale[F.col("measure")])
    pick = [F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{c}_{m}") for m in MEASURES for c in ("least", "most")]
    return points.groupBy("script").agg(*pick)


def fertility_rules(docs: DataFrame, vocabulary: str, width: float = 2.0, least_words: int = 50) -> DataFrame:
    """Measures, base rules and verdict for every document.

    A document stays if it has at least `least_words` words, at most half of them repeated, and if its
    characters per token, byte-fallback share and token entropy lie inside the bands of its script. Too
    few characters per token, too many byte pieces and too little entropy reject it; so does an excess of
    characters per token. Bands are learned from all documents that pass the base rules. A null or empty
    text has no words and fails the base rules; null ids are kept as null; repeated rows are rows of their
    own; other columns are not read.
    """
    measured = staged(text_measures(docs, vocabulary))
    failed = (F.col("n_words") < least_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    measured = measured.withColumn("base_failed", failed)
    # One row per script of the fixed list above: safe to broadcast at any size.
    known = F.broadcast(staged(bands(measured.where(~failed), width)))
    inside = F.col("chars_per_token").between(F.col("least_chars_per_token"), F.col("most_chars_per_token")) & (F.col("byte_share") <= F.col("most_byte_share")) & (F.col("token_entropy") >= F.col("least_token_entropy"))
    return measured.join(known, "script", "left").withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
