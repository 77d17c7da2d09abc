"""Tree concatenation, the threshold algorithm and the Merkle manifest against plain versions."""

import hashlib
import random
import struct
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.llm import bpetree, merkle, threshold
from wattloom.llm.queries import OP12_SQL, OP13_SQL

public_tokenizers = pytest.importorskip("public_tokenizers")
Tokenizer = pytest.importorskip("tokenizers").Tokenizer
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a", "B", "é", "é", " ", "  \n", "'s", "'", "'re", "!", "...", "1", "22", "中", "文字", "😀", "́", "İ", "क़", "क़", " ", " ", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "aaaa", "ab", "ing", "ﬁ", "Å", "\x1c", "\x00"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(VOCABULARY)


def odd_text(rng, n, pieces=ODD):
    return "".join(rng.choice(pieces) for _ in range(n))


def test_tree_equals_the_library(tokenizer):
    rng = random.Random(1)
    for i in range(600):
        pieces = rng.sample(ODD, rng.randint(1, len(ODD)))
        text = odd_text(rng, rng.randint(0, 150), pieces)
        assert bpetree.tree_encode(tokenizer, text, rng.choice([1, 3, 8, 40])).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, (i, text)


def test_tree_on_one_long_word(tokenizer):
    rng = random.Random(2)
    for text in ("a" * 5000, "ab" * 3000, "".join(rng.choice("abcdeinrst") for _ in range(20000)), "中文" * 2000, "!?" * 3000):
        assert bpetree.tree_encode(tokenizer, text, 512).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_join_reads_little_of_long_parts(tokenizer):
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdeinrst") for _ in range(rng.randint(1, 12))) for _ in range(20000))
    seen = []

    def encode(part):
        seen.append(len(part))
        return bpetree.encoded(tokenizer, part)

    left, right = (bpetree.encoded(tokenizer, t) for t in (text[:60001], text[60001:]))
    assert bpetree.joined(left, right, encode).ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert sum(seen) < 1000


def test_words_equal_the_library(tokenizer):
    rng, words = random.Random(4), bpetree.encoder(VOCABULARY)
    texts = [None, "", " \t\n "] + [odd_text(rng, rng.randint(1, 60)) for _ in range(1500)] + [w + m for w in ("İ", "क़", "Haus", "É", "é") for m in (",", ".", ".,", "")]
    import pyarrow as pa

    got = [np.frombuffer(r, "<u4").tolist() for r in words.short(pa.array(texts, pa.string()))]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_parts_by_words(tokenizer):
    """Parts whose inner tokens come from the word cache join to the ids of the whole."""
    rng, to_parts = random.Random(5), bpetree.encoder(VOCABULARY)
    for pieces in (ODD, ["a", "b ", "ing", "'s", "é", "中", "1"], ["ab", "c"]):
        text = odd_text(rng, 9000, pieces)
        tree = bpetree.Tree(lambda t: bpetree.encoded(tokenizer, t))
        for part in to_parts.parts(bpetree.halves(text, 2500)):
            tree.add(part)
        assert tree.whole().ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_round_trip_of_awkward_rows(spark, rows, docs, tokenizer, none):
    for leaf in (100, 2000):
        got = sorted(map(tuple, bpetree.round_trip(docs, VOCABULARY, leaf).collect()), key=str)
        want = []
        for r in rows:
            ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids
            want.append((r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
        assert got == sorted(want, key=str)
    assert bpetree.round_trip(none, VOCABULARY).collect() == []


def test_encode_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b " * 300, 7, "x"), (2, None, 8, "y")], "key long, text string, ids int, decoded string")
    got = bpetree.decode(bpetree.encode(df, VOCABULARY, leaf=200), VOCABULARY, "ids_")
    assert got.columns == ["key", "text", "ids", "decoded", "ids_", "decoded_"]
    assert {r.key: (r.ids, r.decoded, len(r.ids_), r.decoded_[:12]) for r in got.collect()} == {1: (7, "x", 2400, "a</w> b</w> "), 2: (8, "y", 0, "")}


def test_other_vocabulary(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    other = Tokenizer.from_file(path)
    texts = ["", "Hello  world \n\n  x", "é中" * 400, "word " * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = bpetree.decode(bpetree.encode(df, path, leaf=150), path)
    assert {r.doc_id: (np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in got.collect()} == {i: (other.encode(t, add_special_tokens=False).ids, t) for i, t in enumerate(texts)}


def plain_negatives(rows):
    rows = [(i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(x))) for x in v]) for i, label, v in rows if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, label, v in (r for r in rows if r[0] % 50 == 0):
        scored = sorted(((-sum(x * y for x, y in zip(v, w, strict=False)), i, other) for i, other, w in rows if i != a))
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            found = [(-s, i) for s, i, other in scored if other != label and 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(a, positive, k, i, -p, s) for k, (s, i) in enumerate(found, 1)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int, key string, slot int, score double"


def vectors(seed, n=400, width=6):
    rng = random.Random(seed)
    rows = [[i, [rng.gauss(0, 1) for _ in range(width)], rng.randint(0, 4)] for i in range(n)]
    for i in range(100, 160):  # one very common vector
        rows[i][1] = rows[50][1]
    rows += [[50, rows[3][1], 2], [7, rows[7][1], 1], [350, rows[9][1], 0], [None, rows[0][1], 1], [500, None, 1], [501, [1.0, None] + [0.0] * (width - 2), 1], [502, [float("nan")] * width, 1], [503, [float("inf")] * width, 1], [504, rows[1][1], None], [550, [0.0] * width, 3], [551, [0.5] * (width - 2), 3], [600, [], 2]]
    return [(*r[:3], "k", 1, 2.0) for r in rows]


@pytest.mark.parametrize("block", [17, 1000])
def test_negatives_equal_brute_force(spark, block):
    rows = [(i, [float(np.float32(x)) if x is not None else None for x in v] if v is not None else None, *rest) for i, v, *rest in vectors(block)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    want = plain_negatives([(r[0], r[2], r[1]) for r in rows])
    assert len(want) > 50
    assert sorted(map(tuple, threshold.hard_negatives(df, block=block).collect())) == want
    # several passes over slices of the anchors
    assert sorted(map(tuple, threshold.hard_negatives(df, block=block, most=400).collect())) == want


def test_negatives_of_nothing(spark):
    assert threshold.hard_negatives(spark.createDataFrame([], VECTORS)).collect() == []
    assert threshold.hard_negatives(spark.createDataFrame([(50, None, 1, "k", 1, 2.0)], VECTORS)).collect() == []


def test_threshold_stops_early():
    """Rows that no list shows before the threshold closes the window are never scored."""
    rng = np.random.default_rng(0)
    vec = np.rint(rng.normal(0, 50, (20_000, 3))).astype(np.int32)
    lists, anchor = threshold.Lists.of(vec), np.array([[90, -40, 5]], np.int32)
    scores = vec.astype(np.int64) @ anchor[0]
    best = threshold.Best.empty(5, -threshold.OPEN, threshold.OPEN)
    seen = []

    class Spy(np.ndarray):
        def __getitem__(self, at):
            seen.append(at)
            return np.asarray(self)[at]

    threshold.search(lists, anchor, [[best]], np.arange(len(vec)).view(Spy), lambda i: np.ones(len(vec), bool))
    assert best.score.tolist() == np.sort(scores)[::-1][:5].tolist()
    bound = lists.thresholds(anchor.astype(float), lists.depths())[0]
    assert next(d for d, b in zip(lists.depths()[1:], bound, strict=True) if b < best.score[-1]) < 2_000


def test_large_components(spark):
    rows = [(i, [float(1 << 18 + i % 3), -float(1 << 19), 1e30 if i == 11 else 3.0], i % 2, "k", 1, 2.0) for i in range(0, 60)]
    df = spark.createDataFrame(rows, VECTORS)
    held = [(r[0], r[2], [max(-(2.0**20), min(2.0**20, x)) for x in r[1]]) for r in rows]
    assert sorted(map(tuple, threshold.hard_negatives(df).collect())) == plain_negatives(held)


def test_negatives_equal_sql(spark):
    rows = [r for r in vectors(9) if r[1] is None or len(r[1]) == 6]
    rows = list({r[0]: r for r in rows}.values())
    df = spark.createDataFrame(rows, VECTORS)
    db = duckdb.connect()
    db.register("embeddings", df.toArrow())
    assert sorted(map(tuple, threshold.hard_negatives(df).collect())) == sorted(db.sql(OP12_SQL).fetchall())


def sized(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    def leaf(r, text):
        return h(*(sized(v) for v in (r[0], r[3], r[2], r[4], text)))

    def lowered(r):
        bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]) if bad else r[1]

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    leaves = {lang: sorted(((r[0] is not None, r[0] or 0, leaf(r, r[1])), r) for r in rows if r[2] == lang) for lang in langs} if rows else {}
    trees = {}
    for lang in langs:
        level = [k[2] for k, _ in leaves[lang]]
        trees[lang] = [level]
        while len(level) > 1:
            level = [h(*level[i : i + 8]) for i in range(0, len(level), 8)]
            trees[lang].append(level)
    subroots = [trees[lang][-1][0] for lang in langs]
    root = h(*subroots)
    out = []
    for at, lang in enumerate(langs):
        for pos, (key, r) in enumerate(leaves[lang]):
            proof, folded, p = [], leaf(r, lowered(r)), pos
            for level in trees[lang][:-1]:
                run = level[p // 8 * 8 : p // 8 * 8 + 8]
                proof += run[: p % 8] + run[p % 8 + 1 :]
                folded, p = h(*run[: p % 8], folded, *run[p % 8 + 1 :]), p // 8
            proof += subroots[:at] + subroots[at + 1 :]
            folded = h(*subroots[:at], folded, *subroots[at + 1 :])
            out.append((r[0], key[2], subroots[at], root, h(*proof), folded, folded == root))
    return sorted(out, key=str)


def test_manifest_equals_plain_version(spark, rows, docs, none):
    for of, df in ((rows, docs), (rows[:1], spark.createDataFrame(rows[:1], docs.schema))):
        assert sorted(map(tuple, merkle.verified_proofs(df).collect()), key=str) == plain_manifest(of)
    assert merkle.verified_proofs(none).collect() == []


def test_manifest_of_a_tall_tree(spark):
    """More than one copy of inner nodes, a null language, a language of one leaf, repeated rows."""
    rows = [(i // 2 if i < 40 else i, f"Text {i // 2 if i < 40 else i}", "en" if i % 9 else None, "s", i // 2 if i < 40 else None) for i in range(1400)] + [(5000, "A", "ä", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = sorted(map(tuple, merkle.verified_proofs(df).collect()), key=str)
    assert got == plain_manifest(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got)
    nodes = merkle.build(df).nodes
    assert nodes.where("level = 3").groupBy("lang_no", "pos").count().agg(F.min("count")).first()[0] == 8


def test_manifest_equals_sql(spark, docs):
    db = duckdb.connect()
    some = docs.where("doc_id < 103").dropDuplicates(["doc_id"]).select("doc_id", "text", "lang", "source", "n_chars")
    db.register("documents", some.toArrow())
    assert sorted(map(tuple, merkle.verified_proofs(some).collect())) == sorted(db.sql(OP13_SQL).fetchall())


def test_rows_of_a_changed_manifest_differ(spark):
    df = spark.createDataFrame([(i, f"text {i}", "en", "s", i) for i in range(70)], "doc_id long, text string, lang string, source string, n_chars long")
    one = merkle.build(df).subroots.first()["root"]
    assert one == merkle.build(df.repartition(7)).subroots.first()["root"]
    assert one != merkle.build(df.withColumn("text", F.when(F.col("doc_id") == 33, "other").otherwise(F.col("text")))).subroots.first()["root"]
