"""Counts, scales and models are those of all rows, whatever the size of a block."""

import numpy as np
import pytest

from wattloom.llm import fuzzylines, pulearn


def frame(spark, n=600):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        good = i % 2 == 0
        rows.append((i, " ".join(rng.choice(["word", "river", "stone", "light"] if good else ["#$%", "|||", "9", "&"]) for _ in range(20 + i % 7))))
    labels = [(i, int(i % 2 == 0)) for i in range(0, n, 3)]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int"), rows


def test_scale_comes_from_all_rows(spark):
    docs, _, rows = frame(spark)
    want = np.array([pulearn.features(t) for _, t in rows], np.float32).astype(float)
    for groups in (1, 9):
        got = pulearn.dealt(pulearn.measured(docs), groups)
        assert got.agg({"n": "sum"}).first()[0] == len(rows)
        for a, b in zip(pulearn.overall(got), (want.mean(0), want.std(0)), strict=True):
            assert a == pytest.approx(b, abs=1e-9)


def test_every_row_is_in_a_block(spark):
    docs, _, rows = frame(spark)
    measures = pulearn.measured(docs)
    positive, unlabelled = pulearn.dealt(measures.where("doc_id < 100"), 3), pulearn.dealt(measures.where("doc_id >= 100"), 5)
    blocks, n = pulearn.blocks_of(positive, unlabelled)
    got = blocks.collect()
    assert len(got) == n == 5 and len({b.p for b in got}) == 3 and sum(len(b.u) for b in got) == (len(rows) - 100) * 4 * len(pulearn.FEATURES)


def test_blocks_teach_one_net(spark):
    docs, labels, _ = frame(spark)
    first, second = (sorted((x.doc_id, x.score) for x in pulearn.quality_scores(docs, labels, block_rows=60).collect()) for _ in range(2))
    assert first == second
    assert np.mean([(score > 0.5) == (i % 2 == 0) for i, score in first]) > 0.9


def test_words_are_counted_in_all_documents(spark):
    docs = spark.createDataFrame([(i, i, "rare" if i else "x") for i in range(8)], "doc bigint, version bigint, text string")
    at = docs.sparkSession.range(1).selectExpr(f"int(xxhash64('rare') & {fuzzylines.GROUPS - 1}L) AS at").first().at
    levels = spark.range(1).select(fuzzylines.commonness(docs).alias("x")).first().x
    assert bin(int.from_bytes(levels[4 * at : 4 * at + 4], "big")).count("1") == int(np.log2(7) + 1)
