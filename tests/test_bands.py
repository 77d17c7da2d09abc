"""Bands from tree leaves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.plans.bands import banded, fit_leaf_bands, grid_points, leaf_table, leaf_union


def noisy(spark, n, seed):
    """A residual whose spread grows with x; z says nothing."""
    rng = np.random.default_rng(seed)
    x = rng.random(n)
    rows = zip(x.tolist(), rng.random(n).tolist(), (rng.normal(size=n) * (1 + 4 * x)).tolist(), strict=True)
    return spark.createDataFrame(list(rows), "x double, z double, res double")


def test_coverage_where_noise_grows(spark):
    bands = fit_leaf_bands(noisy(spark, 12_000, 1), "res", ["x", "z"], trees=20, depth=4)
    got = banded(noisy(spark, 8_000, 2), bands, {"low": 0.1, "high": 0.9}).toPandas()
    assert abs((got.res < got.low).mean() - 0.1) < 0.02
    assert abs((got.res < got.high).mean() - 0.9) < 0.02
    # within narrow stretches of x too, for the bands follow the spread
    for a in np.arange(0, 1, 0.25):
        part = got[(got.x >= a) & (got.x < a + 0.25)]
        assert abs(((part.res >= part.low) & (part.res <= part.high)).mean() - 0.8) < 0.05
    assert got.high[got.x > 0.9].mean() > 2.5 * got.high[got.x < 0.1].mean()


def test_leaf_table_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = [([int(a), int(b)], float(v)) for a, b, v in zip(rng.integers(0, 3, 500), rng.integers(0, 2, 500), rng.normal(size=500), strict=True)]
    df = spark.createDataFrame([*rows, ([0, None], 4.0), ([0, 0], None), (None, 1.0)], "leaves array<int>, v double")
    for r in leaf_table(df, "leaves", "v", 7).collect():
        own = [v for leaves, v in [*rows, ([0, None], 4.0)] if leaves[r.tree] == r.leaf]
        assert r.n == len(own)
        assert np.allclose(r.grid, np.quantile(own, grid_points(7)))


def test_union_of_leaves(spark):
    table = spark.createDataFrame([(0, 1, [1.0, 2.0, 3.0]), (0, 2, [7.0, 8.0, 9.0]), (1, 1, [2.5, 10.0, 20.0])], "tree int, leaf int, grid array<double>")
    df = spark.createDataFrame([(1, [1, 1]), (2, [2, 5]), (3, [5, 5]), (4, None), (5, [2, None]), (6, []), (7, [-1, 1])], "id int, leaves array<int>")
    got = {r.id: (r.low, r.mid) for r in leaf_union(df, "leaves", table, {"low": 0.1, "mid": 0.5}).collect()}
    union = [1, 2, 3, 2.5, 10, 20]
    assert got[1] == pytest.approx(tuple(np.quantile(union, [0.1, 0.5])))
    assert got[2] == got[5] == pytest.approx((7.2, 8.0))
    assert got[3] == got[4] == got[6] == (None, None)
    assert got[7] == pytest.approx((4.0, 10.0))


def test_nothing_known(spark):
    empty = leaf_table(spark.createDataFrame([], "leaves array<int>, v double"), "leaves", "v")
    df = spark.createDataFrame([([1],)], "leaves array<int>")
    assert leaf_union(df, "leaves", empty, {"low": 0.1}).select(F.col("low").isNull()).first()[0]
