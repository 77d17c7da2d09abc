"""Language by compression: the dictionary that makes a text smallest names its language."""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import batch, chunks, remainder

MOST_MODEL = 64_000_000
_NO_LETTER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """Lower-case letters with one space for anything else, so that case, digits and symbols tell nothing."""
    return f" {_NO_LETTER.sub(' ', text.lower())} ".encode("utf-8", "surrogatepass")


def dictionaries(docs: DataFrame, slots: int = 64, piece: int = 2048) -> dict[str, bytes]:
    """Raw content per language from a bounded sample of labelled rows.

    Each language gives at most one row for each of `slots` hash classes of its ids, of at most `piece`
    characters; which rows does not depend on their order. Bound: languages * slots * piece, checked here.
    """
    learned = docs.where(F.col("lang").isNotNull() & (F.length("text") > 0))
    hashed = learned.select("lang", F.xxhash64(F.col("doc_id").cast("string")).alias("h"), "text")
    chosen = hashed.groupBy("lang", F.pmod("h", F.lit(slots)).alias("slot")).agg(F.min("h").alias("h")).select("lang", "h")
    # At most `slots` rows for each language.
    texts = hashed.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min(F.substring("text", 1, piece)).alias("text"))
    got: dict[str, list] = {}
    held = 0
    for r in texts.toLocalIterator():
        raw = letters(r.text)
        held += len(raw)
        if held > MOST_MODEL:
            raise ValueError(f"the dictionaries exceed {MOST_MODEL} bytes: too many languages")
        got.setdefault(r.lang, []).append((r.h, raw))
    return {lang: b"\n".join(x for _, x in sorted(parts)) for lang, parts in sorted(got.items())}


def classify(docs: DataFrame, known: dict[str, bytes], piece: int = 4096, levels: tuple = (3, 6), closer: tuple = (12, 19), near: float = 0.05, margin: float = 0.01) -> DataFrame:
    """Adds lang_pred, score, margin and accepted to doc_id and the other given columns but text.

    The letters of the whole text are compressed in pieces with each dictionary in turn; sizes are summed
    over pieces and levels. A lead of the smallest over the second under the share `near` is measured again
    with the `closer` levels too, which break the ties of short texts. The lead is `margin`; one under the parameter is not
    accepted, though the best guess is still named. A null text or one without a letter is `und` with
    score 0, as is any text if nothing was learned. Ties go to the first language in alphabetical order. Rows are
    independent: null ids and repeated rows stay as they are.
    """
    keep = [c for c in docs.columns if c != "text"]
    kinds = [f for f in docs.schema.fields if f.name != "text"]
    columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kinds] + ["lang_pred string", "score double", "margin double", "accepted boolean"])

    def run(batches):
        import zstandard

        packers = {}
        for level in (*levels, *closer):
            for lang, raw in known.items():
                held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                held.precompute_compress(level=level)
                packers.setdefault(level, []).append((lang, zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_dict_id=False)))

        def judge(text: str):
            raw = letters(text)
            parts = [raw[i : i + piece] for i in range(0, len(raw), piece)]
            sizes = dict.fromkeys(known, 0.0)
            used = 0
            for group in (levels, closer):
                for level in group:
                    for lang, z in packers[level]:
                        sizes[lang] += sum(len(z.compress(p)) for p in parts)
                used += len(group)
                ranked = sorted((n / used, lang) for lang, n in sizes.items())
                lead = 1 - ranked[0][0] / ranked[1][0] if len(ranked) > 1 else 1.0
                if lead >= near:
                    break
            best = ranked[0][0]
            # Sizes as code lengths, softened by a fiftieth of the size, since bytes are not independent.
            return ranked[0][1], 1 / sum(math.exp((best - n) / (1 + best / 50)) for n, _ in ranked), lead, lead >= margin

        for b in chunks(batches):
            out = [judge(t) if t and known and any(map(str.isalpha, t)) else ("und", 0.0, 0.0, False) for t in b.column("text").to_pylist()]
            given = [b.column(c) for c in keep]
            schema = pa.schema([*[pa.field(c, x.type) for c, x in zip(keep, given, strict=True)], ("lang_pred", pa.string()), ("score", pa.float64()), ("margin", pa.float64()), ("accepted", pa.bool_())])
            yield batch(schema, *given, *zip(*out, strict=True))

    return docs.mapInArrow(run, columns)


def language_id(docs: DataFrame, modulus: int = 4, held: int = 2, **options) -> DataFrame:
    """Learn from the rows that are not held out, predict every row from its text alone."""
    rest = remainder("doc_id", modulus)
    known = dictionaries(docs.where((rest != held) & (rest >= 0)).select("doc_id", "lang", "text"))
    return classify(docs.select("doc_id", (rest == held).alias("held_out"), "text"), known, **options)
