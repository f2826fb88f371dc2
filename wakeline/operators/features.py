"""Motion and route features of trip points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.functions import geo
from wakeline.functions.scalar import angle_change
from wakeline.operators.layout import CHUNK, Layout, detect, join_group_values
from wakeline.operators.scan import previous, running_sum, scan, total

NODES = 100
_LAST = 1 - 1e-12  # running sums may end a rounding error short of 1


def point_layout(df: DataFrame, **options) -> Layout:
    return detect(df, [S.TRIP], [S.TIME, S.POINT], **options)


def add_deltas(df: DataFrame, layout: Layout, wrap: bool = True) -> DataFrame:
    """``dv``, ``dcourse``, ``ddraft``: absolute change since the trip's previous point, else 0.

    ``wrap=False`` leaves course changes above 180 degrees unfolded.
    """
    stepped = scan(
        df, layout, _sog=previous("speed_over_ground"), _cog=previous("course_over_ground"), _draught=previous("draught")
    )
    turn = F.abs(F.col("course_over_ground") - F.col("_cog"))
    return stepped.withColumns(
        {
            "dv": _or_zero(F.abs(F.col("speed_over_ground") - F.col("_sog"))),
            "dcourse": _or_zero(angle_change(turn) if wrap else turn),
            "ddraft": _or_zero(F.abs(F.col("draught") - F.col("_draught"))),
        }
    ).drop("_sog", "_cog", "_draught")


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def add_steps(df: DataFrame, layout: Layout) -> DataFrame:
    """Previous position and the distance from it (null on a trip's first point)."""
    out = scan(df, layout, prev_lat=previous("latitude"), prev_lon=previous("longitude"))
    step = geo.haversine_km(F.col("latitude"), F.col("longitude"), F.col("prev_lat"), F.col("prev_lon"))
    return out.withColumn("step_km", step)


def add_distance(df: DataFrame, layout: Layout) -> DataFrame:
    """Distance travelled up to each point and its share of the trip, now and one point before."""
    out = scan(
        df,
        layout,
        _cum=running_sum("step_km"),
        _before=running_sum("step_km", before=True),
        _total=total("step_km"),
    )
    length = F.when(F.col("_total") > 0, F.col("_total")).otherwise(1.0)
    return out.withColumns(
        {
            "cum_km": _or_zero(F.col("_cum")),
            "trip_km": _or_zero(F.col("_total")),
            "frac": _or_zero(F.col("_cum")) / length,
            "prev_frac": _or_zero(F.col("_before")) / length,
        }
    ).drop("_cum", "_before", "_total")


def resample(df: DataFrame, nodes: int = NODES) -> DataFrame:
    """Each moving trip at ``nodes`` equal fractions of its distance, by linear interpolation.

    Works segment by segment: the step from the previous point to this one owns the nodes whose
    fraction lies in it, so every trip yields exactly ``nodes`` rows and no trip is collected.
    """
    last = nodes - 1
    f0, f1 = F.col("prev_frac"), F.col("frac")
    moving = df.filter((F.col("trip_km") > 0) & F.col("prev_lat").isNotNull() & (f1 > f0) & (f0 < _LAST))
    low = F.ceil(f0 * last).cast("int")
    high = F.when(f1 >= _LAST, last).otherwise(F.ceil(f1 * last).cast("int") - 1)
    owned = moving.withColumn("_low", low).withColumn("_high", high).filter("_low <= _high")
    share = (F.col("k") / last - f0) / (f1 - f0)
    return owned.withColumn("k", F.explode(F.sequence("_low", "_high"))).select(
        S.ROUTE,
        S.TRIP,
        "k",
        (F.col("prev_lat") + (F.col("latitude") - F.col("prev_lat")) * share).alias("lat"),
        (F.col("prev_lon") + (F.col("longitude") - F.col("prev_lon")) * share).alias("lon"),
    )


def average_path(resampled: DataFrame) -> DataFrame:
    """Mean position per route and node."""
    return resampled.groupBy(S.ROUTE, "k").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))


def route_centroids(df: DataFrame) -> DataFrame:
    return df.groupBy(S.ROUTE).agg(F.avg("latitude").alias("lat0"), F.avg("longitude").alias("lon0"))


def first_port_position(df: DataFrame) -> DataFrame:
    """First known start position per port, in time order."""
    order = F.struct(S.TIME, S.POINT)
    picks = [
        F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in ("start_latitude", "start_longitude")
    ]
    return df.groupBy(S.ROUTE).agg(*picks)


def route_table(points: DataFrame, nodes: int = NODES) -> DataFrame:
    """One row per route: centre and average path as two arrays. ``points`` carry distances."""
    node = F.struct("k", "lat", "lon")
    paths = average_path(resample(points, nodes)).groupBy(S.ROUTE).agg(F.array_sort(F.collect_list(node)).alias("_path"))
    return (
        route_centroids(points)
        .join(paths, S.ROUTE, "left")
        .select(S.ROUTE, "lat0", "lon0", F.col("_path.lat").alias("path_lat"), F.col("_path.lon").alias("path_lon"))
    )


def join_routes(points: DataFrame, routes: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Route columns onto points; ``source`` is a cheap frame with the same routes, to count them."""
    return join_group_values(points, routes, [S.ROUTE], source)


def add_route_features(points: DataFrame, routes: DataFrame, source: DataFrame | None = None, nodes: int = NODES) -> DataFrame:
    """``x_km``, ``y_km`` around the route centre and the distance to the average path at the same
    share of the trip."""
    joined = join_routes(points, routes, source)
    k = path_node(F.col("frac"), nodes) + 1
    ref = geo.haversine_km(F.col("latitude"), F.col("longitude"), F.get("path_lat", k - 1), F.get("path_lon", k - 1))
    return joined.withColumns(
        {
            "x_km": geo.local_x_km(F.col("longitude"), F.col("lat0"), F.col("lon0")),
            "y_km": geo.local_y_km(F.col("latitude"), F.col("lat0")),
            "dist_to_ref": F.when(F.col("path_lat").isNull(), 0.0).otherwise(ref),
            "route_dummy": F.lit(1.0),
        }
    ).drop("lat0", "lon0", "path_lat", "path_lon")


def path_node(frac: Column, nodes: int = NODES) -> Column:
    """Node at or before a fraction; the guard keeps rounding errors from dropping a node."""
    return F.least(F.floor(frac * (nodes - 1) + 1e-9), F.lit(nodes - 1)).cast("int")


def add_zone(df: DataFrame, one_hot: bool = True) -> DataFrame:
    zone = geo.zone_label(F.col("latitude"), F.col("longitude"))
    out = df.withColumn("zone", zone)
    if one_hot:
        out = out.withColumns({"zone_0": F.col("zone") == 0, "zone_1": F.col("zone") == 1})
    return out


def motion_features(df: DataFrame, layout: Layout, wrap: bool = True) -> DataFrame:
    """All per-trip features in two scans that share one shuffle and one sort."""
    stepped = scan(
        df,
        layout,
        prev_lat=previous("latitude"),
        prev_lon=previous("longitude"),
        _sog=previous("speed_over_ground"),
        _cog=previous("course_over_ground"),
        _draught=previous("draught"),
    )
    turn = F.abs(F.col("course_over_ground") - F.col("_cog"))
    stepped = stepped.withColumns(
        {
            "dv": _or_zero(F.abs(F.col("speed_over_ground") - F.col("_sog"))),
            "dcourse": _or_zero(angle_change(turn) if wrap else turn),
            "ddraft": _or_zero(F.abs(F.col("draught") - F.col("_draught"))),
            "step_km": geo.haversine_km(F.col("latitude"), F.col("longitude"), F.col("prev_lat"), F.col("prev_lon")),
        }
    ).drop("_sog", "_cog", "_draught")
    return add_distance(stepped, layout)


SCAN_COLUMNS = ("prev_lat", "prev_lon", "step_km", "cum_km", "trip_km", "frac", "prev_frac", CHUNK)
