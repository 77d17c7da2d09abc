"""Power bands from tree leaves: a row's band is the union of the training residuals that share its leaves.

The leaves of one forest stand for the neighbourhoods. Every (tree, leaf) keeps a grid of exact residual
percentiles, so the table is bounded by trees x leaves x grid whatever the number of training rows. At scoring
the grids of a row's leaves, one of each tree and all of the same mass, are united, and any percentile of the
union can be read from it.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.operators.quantiles import percentiles
from wattloom.session import cut_lineage

GRID = 41
# The largest leaf table that may be sent to the workers: trees x leaves x grid.
MOST_CELLS = 4_000_000


def grid_points(grid: int = GRID) -> list[float]:
    """Middles of `grid` equal shares of the mass."""
    return [(i + 0.5) / grid for i in range(grid)]


def leaf_table(df: DataFrame, leaves: str, value: str, grid: int = GRID) -> DataFrame:
    """tree, leaf, n, grid: exact percentiles of `value` in each leaf of each tree.

    `leaves` is an array with one leaf number per tree. Rows without a value, and null leaves, are left out.
    """
    long = df.where(F.col(value).isNotNull()).select(F.col(value).alias("_v"), F.posexplode(leaves).alias("tree", "leaf"))
    points = {f"_g{i}": q for i, q in enumerate(grid_points(grid))}
    table = percentiles(long.select("tree", F.col("leaf").cast("int").alias("leaf"), F.col("_v").cast("double").alias("_v")), ["tree", "leaf"], "_v", points)
    return table.select("tree", "leaf", "n", F.array(*points).alias("grid"))


def leaf_union(df: DataFrame, leaves: str, table: DataFrame, points: Mapping[str, float]) -> DataFrame:
    """One column per point: the percentile of the united grids of the row's leaves, linear between neighbours.

    Leaves that the table does not know add nothing; a row of which it knows none gets NULL. The table is counted
    before it is sent to the workers.
    """
    size = table.agg(F.sum(F.size("grid"))).first()[0] or 0
    if size > MOST_CELLS:
        raise ValueError(f"a leaf table holds at most {MOST_CELLS} cells, this one {size}: fewer trees, less depth or a coarser grid")
    rows = table.select("tree", "leaf", "grid").collect()
    trees = 1 + max((r["tree"] for r in rows), default=-1)
    width = max((len(r["grid"]) for r in rows), default=1)
    number = {(r["tree"], r["leaf"]): i for i, r in enumerate(rows)}
    # The last row stands for unknown leaves; NaN sorts behind everything.
    cells = np.full((len(rows) + 1, width), np.nan)
    for i, r in enumerate(rows):
        cells[i, : len(r["grid"])] = r["grid"]
    span = 1 + max((leaf for _, leaf in number), default=0)
    at = np.full((max(trees, 1), span + 1), len(rows))
    for (tree, leaf), i in number.items():
        at[tree, leaf] = i
    shares = list(points.values())
    shared = df.sparkSession.sparkContext.broadcast((cells, at))

    @F.pandas_udf("array<double>")
    def united(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cells, at = shared.value
        unknown = at.shape[1] - 1
        for batch in batches:
            ids = np.full((len(batch), at.shape[0]), unknown)
            for i, row in enumerate(batch):
                if row is not None:
                    own = np.asarray(row, float)[: at.shape[0]]
                    ids[i, : len(own)] = np.where((own >= 0) & (own < unknown), own, unknown)
            out = []
            for a in range(0, len(ids), 1024):
                part = np.sort(cells[at[np.arange(at.shape[0]), ids[a : a + 1024]]].reshape(len(ids[a : a + 1024]), -1), axis=1)
                known = part.shape[1] - np.isnan(part).sum(axis=1)
                place = np.outer(np.maximum(known - 1, 0), shares)
                low = np.floor(place).astype(int)
                lower = np.take_along_axis(part, low, 1)
                upper = np.take_along_axis(part, np.minimum(low + 1, np.maximum(known - 1, 0)[:, None]), 1)
                got = lower + (upper - lower) * (place - low)
                out += [list(g) if k else None for g, k in zip(got, known, strict=True)]
            yield pd.Series(out)

    wide = df.withColumn("_united", united(F.col(leaves)))
    return wide.withColumns({name: F.col("_united")[i] for i, name in enumerate(points)}).drop("_united")


@dataclass
class LeafBands:
    """A fitted forest with its leaf table."""

    forest: Transformer
    inputs: list[str]
    table: DataFrame


def inputs_of(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(inputs), outputCol="_bandin", handleInvalid="keep").transform(df)


def with_leaves(df: DataFrame, bands: LeafBands) -> DataFrame:
    scored = bands.forest.transform(inputs_of(df, bands.inputs))
    return scored.withColumn("_leaves", vector_to_array("_leafv").cast("array<int>")).drop("_bandin", "_leafv", "_size")


def fit_leaf_bands(rows: DataFrame, residual: str, inputs: Sequence[str], trees: int = 50, depth: int = 5, least: int = 20, seed: int = 42, grid: int = GRID) -> LeafBands:
    """A forest that parts the rows by the size of their residuals, and the residual percentiles of its leaves.

    Give it a written table. `inputs` are numeric or vector columns; `least` is the fewest rows of a leaf.
    """
    ready = inputs_of(rows, inputs).withColumn("_abs", F.abs(F.col(residual)))
    forest = RandomForestRegressor(
        featuresCol="_bandin", labelCol="_abs", predictionCol="_size", leafCol="_leafv", numTrees=trees, maxDepth=depth, minInstancesPerNode=least, seed=seed,
    ).fit(ready)
    bands = LeafBands(forest, list(inputs), rows)
    bands.table = cut_lineage(leaf_table(with_leaves(rows, bands), "_leaves", residual, grid))
    return bands


def banded(df: DataFrame, bands: LeafBands, points: Mapping[str, float]) -> DataFrame:
    """Residual percentiles of every row under the names of `points`."""
    return leaf_union(with_leaves(df, bands), "_leaves", bands.table, points).drop("_leaves")
