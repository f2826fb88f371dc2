"""The feature table for all routes, and the tables built from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.operators import features as ft
from wakeline.operators import labels, sequences, split, trips
from wakeline.operators.layout import Layout, join_values


def prepare(df: DataFrame, excluded: Sequence = ()) -> DataFrame:
    """Trips and rows used for training, with target and route."""
    return trips.add_target(trips.drop_unknown_type(trips.exclude_trips(df, excluded)))


def feature_points(
    df: DataFrame, routes: DataFrame | None = None, layout: Layout | None = None, one_hot: bool = True, wrap: bool = True
) -> DataFrame:
    """All point features of all routes in one job.

    Points are shuffled once, by trip. ``routes`` is a stored route table (``route_statistics``);
    without one it is derived from the same points.
    """
    layout = layout or ft.point_layout(df)
    moved = ft.motion_features(layout.mark(df), layout, wrap)
    if routes is None:
        routes = route_statistics(df, layout)
    out = ft.add_route_features(ft.add_zone(moved, one_hot), routes, source=df)
    return out.drop(*ft.SCAN_COLUMNS)


def route_statistics(df: DataFrame, layout: Layout | None = None) -> DataFrame:
    """Centre and average path per route, reading only positions."""
    layout = layout or ft.point_layout(df)
    slim = df.select(S.TRIP, S.TIME, S.POINT, S.ROUTE, "latitude", "longitude")
    marked = layout.mark(slim)
    return ft.route_table(ft.add_distance(ft.add_steps(marked, layout), layout))


def label_table(df: DataFrame, intervals: DataFrame | None = None, layout: Layout | None = None, **limits) -> DataFrame:
    """Rule labels for every point of every trip."""
    layout = layout or ft.point_layout(df)
    marked = layout.pin(layout.mark(df))
    return labels.label_points(marked, layout, intervals, **limits).drop("_chunk")


def sequence_sets(
    df: DataFrame,
    features: Sequence[str],
    length: int = sequences.LENGTH,
    step: int = sequences.STEP,
    validation: float = 0.1,
    layout: Layout | None = None,
) -> DataFrame:
    """Windows of the labelled, complete points with their set: ``train`` and ``validation`` hold
    the normal windows of disjoint trips, ``anomaly`` all anomalous windows."""
    complete = trips.complete_rows(df, features)
    layout = layout or ft.point_layout(complete)
    # The split is drawn among the trips long enough for a window and joined on the trip
    # partitioning of the points, so the windows themselves are not shuffled for it.
    sizes = complete.groupBy(S.ROUTE, S.TRIP).agg(F.count("*").alias("n"))
    held = split.trip_holdout(sizes.filter(F.col("n") > length + 1), S.ROUTE, S.TRIP, validation)
    placed = sequences.with_positions(layout.mark(complete), layout)
    assigned = join_values(placed, held.select(S.TRIP, "is_test"), layout)
    windows = sequences.build_windows(assigned, features, length=length, step=step, keep=["is_test"])
    part = F.when(F.col("label") == 1, "anomaly").when(F.col("is_test"), "validation").otherwise("train")
    return windows.withColumn("part", part).drop("is_test")
