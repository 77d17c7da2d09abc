"""Crowded buckets: classes equal brute force, no pair is a row."""

import random

import pytest

from wattloom.llm import dartminhash


def shingles(text):
    w = text.split()
    out = {}
    for i in range(max(1, len(w) - 4)):
        k = tuple(w[i : i + 5])
        out[k] = out.get(k, 0) + 1
    return out


def jaccard(a, b):
    both = sum(min(n, b.get(k, 0)) for k, n in a.items())
    return both / (sum(a.values()) + sum(b.values()) - both)


@pytest.fixture(scope="module")
def crowd():
    """Copies of one text with one to four replaced words each, so that some pairs reach 0.8 and most do not."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(90):
        w = base[:]
        for at in rng.sample(range(120), 1 + i % 4):
            w[at] = f"x{i}q{at}"
        texts.append(" ".join(w))
    return texts


def classes(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize(("size", "block"), [(4, 1000), (4, 20), (64, 1000)])
def test_crowded_buckets_equal_brute_force(spark, crowd, size, block):
    docs = spark.createDataFrame(list(enumerate(crowd)), "doc_id bigint, text string")
    got = {x.doc_id: x.class_id for x in dartminhash.near_duplicates(docs, crowd=size, block=block).collect()}
    assert [got[i] for i in range(len(crowd))] == classes(crowd)


@pytest.mark.parametrize("whole", [True, False])
def test_links_stay_below_members(spark, crowd, whole):
    docs = spark.createDataFrame(list(enumerate(crowd)), "doc_id bigint, text string")
    table = dartminhash.signed(docs)
    one = table.withColumnRenamed("doc_id", "rep").select("rep", "content", "signature", "keys").cache()
    key = "0L" if whole else "explode(keys)"
    crowded = one.selectExpr("rep", f"{key} AS key", "rep AS component")
    # Every member is a component of its own here.
    links = dartminhash.in_blocks(crowded, docs, one, 0.8, 0.7, 1000)
    n = links.count()
    assert 0 < n < len(crowd) if whole else n > 0
    assert links.join(links.select("a", "b"), ["a", "b"]).count() == n
