"""The registry that maps a route to its model: a table with a row for each route and family."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.sources import versions

REGISTRY_SCHEMA = "route string, model_type string, path string, tau double, features array<string>"
MODEL_TYPES = {1: "one_class_svm", 2: "isolation_forest", 3: "logistic", 4: "random_forest", 5: "reconstruction"}


class ModelNotFound(KeyError):
    """The registry has no model for a route."""


@dataclass(frozen=True)
class Entry:
    route: str
    model_type: str
    path: str
    tau: float
    features: Sequence[str]


def entries(trained: DataFrame, model_type: str, path: str, features: Sequence[str] | Column) -> DataFrame:
    """Registry rows of trained routes (route, ``tau``); the tasks write them, the driver sees none."""
    named = features if isinstance(features, Column) else F.array(*[F.lit(c) for c in features])
    return trained.select(
        F.col(S.ROUTE).alias("route"), F.lit(model_type).alias("model_type"), F.lit(path).alias("path"), F.col("tau").cast("double").alias("tau"), named.alias("features")
    )


def given(spark: SparkSession, rows: Sequence[Entry]) -> DataFrame:
    """Registry rows of models that are stated by hand."""
    return spark.createDataFrame([(*astuple(e)[:4], list(e.features)) for e in rows], REGISTRY_SCHEMA)


def save_registry(rows: DataFrame, path: str) -> DataFrame:
    """A new version of the registry, in which ``rows`` replace those of their route and family; all others stay. Returns ``rows``."""
    versions.upsert(rows, path, ["route", "model_type"], ["model_type"])
    return rows


def load_registry(spark: SparkSession, path: str, model_type: str) -> DataFrame:
    return versions.read(spark, path).where(F.col("model_type") == model_type).select("route", "model_type", "path", "tau", "features")


def find(registry: DataFrame, route: str) -> Entry:
    """The entry of a route; a missing route is an error."""
    rows = registry.filter(F.col("route") == route).limit(1).collect()
    if not rows:
        raise ModelNotFound(f"route {route} has no registered model")
    return Entry(**rows[0].asDict())


def feature_sets(registry: DataFrame) -> list[tuple[str, ...]]:
    """The feature lists in use: one for most families, one more for each route with features of its own."""
    return sorted(tuple(r["features"]) for r in registry.select("features").distinct().collect())
