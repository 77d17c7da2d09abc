"""A fitted two-stage model as a folder: every part by its own writer, the description last."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import SparkSession

from wattloom.plans.bands import LeafBands
from wattloom.plans.training import TwoStageModel

FORMAT = 1


def parts(model: TwoStageModel) -> Iterator[tuple[str, Transformer]]:
    """Names and transformers of the fitted parts."""
    for name in ("prepare", "classifier", "second_classifier", "probability", "fallback", "forest", "correction"):
        part = getattr(model, name)
        if part is not None:
            yield name, part
    yield from ((f"expert-{season}", expert) for season, expert in model.experts.items())
    yield from ((f"map-{season}", m) for season, m in model.season_maps.items() if not isinstance(m, tuple))
    yield "bands", model.bands.forest


def save_model(model: TwoStageModel, path: str, spark: SparkSession) -> str:
    """Write the model below `path`, which must not hold one. Without its description, written last, a folder is no model."""
    names = []
    for name, part in parts(model):
        part.write().save(f"{path}/{name}")
        names.append(name)
    model.bands.table.write.parquet(f"{path}/leaf-table")
    about = {
        "format": FORMAT,
        "parts": names,
        "features": model.features,
        "band_inputs": model.bands.inputs,
        "threshold": model.threshold,
        "naive_mean": model.naive_mean,
        "correction_cap": model.correction_cap,
        "lines": {season: list(m) for season, m in model.season_maps.items() if isinstance(m, tuple)},
    }
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/about")
    return path


def load_model(spark: SparkSession, path: str) -> TwoStageModel:
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    if about["format"] != FORMAT:
        raise ValueError(f"model format {about['format']} is not known here")
    held = {name: PipelineModel.load(f"{path}/{name}") if name == "prepare" else DefaultParamsReader.loadParamsInstance(f"{path}/{name}", spark) for name in about["parts"]}

    def named(prefix: str) -> dict[str, Transformer]:
        return {name.removeprefix(prefix): part for name, part in held.items() if name.startswith(prefix)}

    lines = {season: tuple(line) for season, line in about["lines"].items()}
    return TwoStageModel(
        features=about["features"],
        prepare=held["prepare"],
        classifier=held["classifier"],
        second_classifier=held.get("second_classifier"),
        probability=held.get("probability"),
        threshold=about["threshold"],
        experts=named("expert-"),
        fallback=held["fallback"],
        bands=LeafBands(held["bands"], about["band_inputs"], spark.read.parquet(f"{path}/leaf-table")),
        forest=held.get("forest"),
        naive_mean=about["naive_mean"],
        correction=held.get("correction"),
        correction_cap=about["correction_cap"],
        season_maps=named("map-") | lines,
    )
