"""Connected groups equal brute force; links and pairs are met a bounded number of times for each member."""

import random

import pytest

from wattloom.llm import common, dartminhash


def smallest(links):
    parent = {x: x for pair in links for x in pair if None not in pair and pair[0] != pair[1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def graphs():
    rng = random.Random(3)
    path = [(i, i + 1) for i in range(70)]
    mixed = rng.sample(range(70), 70)
    return [path, list(zip(mixed, mixed[1:], strict=False)), [(99, i) for i in range(50)], [(rng.randrange(90), rng.randrange(90)) for _ in range(60)], [(1, 1), (None, 2), (3, None), (5, 4), (4, 5), (5, 4)]]


@pytest.mark.parametrize("at", range(5))
def test_components_equal_brute_force(spark, at):
    links = graphs()[at]
    got = common.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert len(got) == len({x.node for x in got})
    assert {x.node: x.component for x in got} == smallest(links)


def test_links_inside_of_a_group_are_met_once(spark, monkeypatch):
    written = []
    staged = common.staged

    def counting(df, **options):
        out = staged(df, **options)
        if set(out.columns) == {"a", "b"}:
            written.append(out.count())
        return out

    monkeypatch.setattr(common, "staged", counting)
    assert common.components(spark.createDataFrame([(0, i) for i in range(1, 200)], "a bigint, b bigint")).count() == 200
    assert written == [199, 0]


def test_pairs_of_a_bucket_are_few_rows(spark, monkeypatch):
    """Forty near copies that the first of them does not join are compared inside of tasks."""
    rng = random.Random(11)
    texts = []
    for i in range(40):
        w = [f"w{k}" for k in range(120)]
        for at in rng.sample(range(120), 4):
            w[at] = f"x{i}q{at}"
        texts.append(" ".join(w))
    rows = []
    estimated = dartminhash.estimated

    def counting(pairs, *rest):
        rows.append(pairs.count())
        return estimated(pairs, *rest)

    monkeypatch.setattr(dartminhash, "estimated", counting)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert dartminhash.near_duplicates(docs).count() == 40
    keys = dartminhash.signed(docs).selectExpr("explode(keys) AS key").groupBy("key").count().where("count > 1").agg({"count": "sum"}).first()[0]
    assert sum(rows[1:]) <= min(3.5 * keys, 40 * 39 / 2 / 2)
