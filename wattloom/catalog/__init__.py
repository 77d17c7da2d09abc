"""All registered queries."""

from wattloom.catalog import aligned, batches, clean, drifts, feature_twin, features, guards, models, periods, scores, streams
from wattloom.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "aligned", "batches", "clean", "drifts", "feature_twin", "features", "guards", "models", "periods", "scores", "streams"]
