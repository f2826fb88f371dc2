"""Scoring any number of trips with the registered models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.ml import forest, isolation, logistic, oneclass, reconstruct, scaling
from wakeline.operators import sequences
from wakeline.operators.features import point_layout
from wakeline.operators.layout import join_group_values
from wakeline.plans import features as features_plan
from wakeline.sources import registry as reg
from wakeline.sources import tables, versions


def require_models(points: DataFrame, registry: DataFrame) -> None:
    """A route without a model is an error, as for a single trip."""
    missing = points.join(registry.select(F.col("route").alias(S.ROUTE)), S.ROUTE, "left_anti").select(S.ROUTE).limit(1).collect()
    if missing:
        raise reg.ModelNotFound(f"route {missing[0][0]} has no registered model")


def by_model(points: DataFrame, model_dir: str, family: str) -> tuple[DataFrame, DataFrame]:
    """The points whose route has a model, and those whose route is unknown or has none."""
    routes = reg.load_registry(points.sparkSession, f"{model_dir}/registry", family).select(F.col("route").alias(S.ROUTE))
    return points.join(routes, S.ROUTE, "left_semi"), points.join(routes, S.ROUTE, "left_anti")


def score_points(points: DataFrame, model_dir: str, family: str, check: bool = True) -> DataFrame:
    """``score`` and ``is_anomaly_pred`` for points with features, by their route's model.

    Models are tables, and all routes are scored in one pass for each list of features in use. ``check`` looks for routes without a model
    first, which are an error; without it their points are left out.
    """
    registry = reg.load_registry(points.sparkSession, f"{model_dir}/registry", family)
    if check:
        require_models(points, registry)
    scorer = {
        "logistic": _logistic,
        "random_forest": _random_forest,
        "isolation_forest": _isolation,
        "one_class_svm": _one_class,
        "reconstruction": _reconstruction,
    }[family]
    parts = []
    for columns in reg.feature_sets(registry):
        taus = registry.where(F.col("features") == F.array(*[F.lit(c) for c in columns])).select(F.col("route").alias(S.ROUTE), F.col("tau").alias("_tau"))
        known = join_group_values(points, taus, [S.ROUTE], how="inner")
        parts.append(scorer(known, columns, model_dir))
    if not parts:
        return points.withColumns({"score": F.lit(None).cast("double"), "is_anomaly_pred": F.lit(None).cast("int")}).limit(0)
    return reduce(DataFrame.unionByName, parts).withColumn("is_anomaly_pred", (F.col("score") > F.col("_tau")).cast("int")).drop("_tau")


def _logistic(points, features, model_dir):
    return logistic.score(points, versions.read(points.sparkSession, f"{model_dir}/logistic"), features)


def _random_forest(points, features, model_dir):
    return forest.score(points, versions.read(points.sparkSession, f"{model_dir}/random_forest"), features)


def _scaled_inputs(points, stats, features, centre):
    """Scaled copies of the features, so that the points keep their own values."""
    copies = points.withColumns({f"_in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    renamed = stats.withColumnsRenamed({f"{c}_{s}": f"_in_{c}_{s}" for c in features for s in ("mean", "std")})
    inputs = [f"_in_{c}" for c in features]
    return scaling.standardise(copies, renamed, inputs, centre=centre), inputs


def _isolation(points, features, model_dir):
    spark = points.sparkSession
    nodes = versions.read(spark, f"{model_dir}/isolation_forest")
    offsets = nodes.groupBy(S.ROUTE).agg(F.max("offset").alias("_offset"))
    scaled, inputs = _scaled_inputs(points, versions.read(spark, f"{model_dir}/isolation_forest_scale"), features, centre=False)
    raw = join_group_values(isolation.raw_scores(scaled, nodes, inputs, [0]), offsets, [S.ROUTE], source=points)
    return raw.withColumn("score", F.col("raw")[0] - F.col("_offset")).drop("raw", "_offset", *inputs)


def _one_class(points, features, model_dir):
    spark = points.sparkSession
    models = versions.read(spark, f"{model_dir}/one_class_svm").withColumn("cell", F.lit(0))
    marks = versions.read(spark, f"{model_dir}/one_class_svm_landmarks")
    scaled, inputs = _scaled_inputs(points, versions.read(spark, f"{model_dir}/one_class_svm_scale"), features, centre=True)
    dense = oneclass.densities(scaled, marks, models.drop("rho"), inputs, [0])
    out = join_group_values(dense, models.select(S.ROUTE, F.col("rho").alias("_rho")), [S.ROUTE], source=points)
    return out.withColumn("score", F.col("_rho") - F.col("density")[0]).drop("density", "_rho", *inputs)


def _reconstruction(points, features, model_dir, length: int = sequences.LENGTH, step: int = sequences.STEP, legacy_offset: bool = False):
    models = versions.read(points.sparkSession, f"{model_dir}/reconstruction")
    layout = point_layout(points)
    placed = sequences.with_positions(layout.mark(points), layout)
    inputs = placed.withColumns({f"_in_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    windows = sequences.build_windows(inputs, [f"_in_{c}" for c in features], None, length, step, inclusive=True, pad_short=True)
    errors = reconstruct.window_errors(scaling.scale_windows(windows, models.select(S.ROUTE, "lows", "spans")), models)
    scored = sequences.point_scores(placed, errors, length=length, step=step, legacy_offset=legacy_offset)
    return scored.drop("pos", "n_points", "_chunk")


def score_cleaned(cleaned: DataFrame, model_dir: str, family: str) -> DataFrame:
    """Features by the stored route statistics, then scores: reads only the given trips."""
    routes = versions.read(cleaned.sparkSession, f"{model_dir}/routes")
    return score_points(features_plan.feature_points(cleaned, routes), model_dir, family)


def score_trips(points: DataFrame, model_dir: str, family: str, out: str) -> DataFrame:
    """Scored points of all given trips as JSON lines; the trip's id leads every point. Returns the points that stay unscored,
    as their route is unknown or has no model."""
    known, unscored = by_model(points, model_dir, family)
    scored = score_points(known, model_dir, family, check=False)
    tables.write_json(tables.scored_points(scored, keep=[S.TRIP]), out)
    return unscored
