"""Selecting trips, labels and features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema as S


class TripNotFound(LookupError):
    """No point of the trip is in the table."""


def select_trip(df: DataFrame, trip_id, check: bool = False) -> DataFrame:
    """The points of one trip; the id is cast to the column's type so the filter reaches the scan."""
    wanted = F.lit(trip_id).cast(df.schema[S.TRIP].dataType)
    trip = df.filter(F.col(S.TRIP) == wanted)
    if check and trip.isEmpty():
        raise TripNotFound(f"Trip '{trip_id}' not found in dataset")
    return trip


def keep_trips(df: DataFrame, trips: DataFrame, trip: str = S.TRIP) -> DataFrame:
    return df.join(trips.select(trip).distinct(), trip, "left_semi")


def exclude_trips(df: DataFrame, trips: DataFrame | Sequence, trip: str = S.TRIP) -> DataFrame:
    if isinstance(trips, DataFrame):
        return df.join(trips.select(trip), trip, "left_anti")
    return df.filter(~F.col(trip).isin(list(trips))) if trips else df


def drop_unknown_type(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["ship_type"])


def add_target(df: DataFrame) -> DataFrame:
    """``y_true`` 1/0/null from the anomaly flag, ``route_id`` from the start port."""
    return df.withColumns({"y_true": F.col("is_anomaly").cast("int"), "route_id": F.col(S.ROUTE)})


def select_route(df: DataFrame, route: str) -> DataFrame:
    return df.filter(F.col(S.ROUTE) == route)


def complete_rows(df: DataFrame, features: Sequence[str], label: str = "y_true") -> DataFrame:
    return df.dropna(subset=[*features, label])


def feature_matrix(df: DataFrame, features: Sequence[str] = S.POINT_FEATURES, keep: Sequence[str] = ()) -> DataFrame:
    """The model inputs as doubles, nulls as 0."""
    return df.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])


def chart_series(df: DataFrame, metric: str, flag: str = "is_anomaly_pred") -> DataFrame:
    """One metric per point, as drawn against time."""
    return df.select(S.TRIP, S.TIME, F.col(metric).cast("double").alias("value"), flag)


def chart_long(df: DataFrame, metrics: Sequence[str], flag: str = "is_anomaly_pred") -> DataFrame:
    """All metrics of all points in long form."""
    wide = df.select(S.TRIP, S.TIME, flag, *[F.col(m).cast("double").alias(m) for m in metrics])
    return wide.unpivot([S.TRIP, S.TIME, flag], list(metrics), "metric", "value")


def trip_list(df: DataFrame, trip: str = S.TRIP) -> DataFrame:
    return df.select(trip).distinct()


def union_frames(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Union by column name, missing columns null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def sort_points(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Total order for output; range-partitioned, so no single task sorts the table."""
    return df.orderBy(*order)
