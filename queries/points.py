"""Queries over trip points: features, labels, windows, splits, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import fixtures as fx
from queries.cleaning import INTERVAL_TEXT, _both
from queries.registry import query, rounded
from wakeline import schema as S
from wakeline.functions import geo, scalar
from wakeline.ml import scaling
from wakeline.operators import evaluate as ev
from wakeline.operators import features as ft
from wakeline.operators import labels as lb
from wakeline.operators import profile, sequences, split, trips
from wakeline.operators.layout import detect, join_values
from wakeline.operators.zones import zone_labels
from wakeline.operators.scan import group_percentiles, position, previous, running_sum, scan
from wakeline.plans import features as plan

KM = "2 * 6371.0::DOUBLE * asin(sqrt(power(sin((radians({1}) - radians({0})) / 2), 2) + cos(radians({0})) * cos(radians({1})) * power(sin((radians({3}) - radians({2})) / 2), 2)))"


def km(lat1, lon1, lat2, lon2):
    return KM.format(lat1, lat2, lon1, lon2)


W = "(PARTITION BY trip_id ORDER BY time_stamp, point_id)"
IN_ZONE = "(" + " OR ".join(
    f"(latitude BETWEEN {b}::DOUBLE AND {a}::DOUBLE AND longitude BETWEEN {d}::DOUBLE AND {c}::DOUBLE)" for a, b, c, d in geo.ZONES
) + ")"
STEPS = f"""steps AS (SELECT *, lag(latitude) OVER {W} AS plat, lag(longitude) OVER {W} AS plon,
    coalesce(abs(speed_over_ground - lag(speed_over_ground) OVER {W}), 0) AS dv,
    abs(course_over_ground - lag(course_over_ground) OVER {W}) AS turn,
    coalesce(abs(draught - lag(draught) OVER {W}), 0) AS ddraft FROM traj),
  kms AS (SELECT *, coalesce(CASE WHEN turn <= 180 THEN turn ELSE 360 - turn END, 0) AS dcourse, {km('latitude', 'longitude', 'plat', 'plon')} AS step_km FROM steps),
  cums AS (SELECT *, coalesce(sum(step_km) OVER (PARTITION BY trip_id ORDER BY time_stamp, point_id ROWS UNBOUNDED PRECEDING), 0) AS cum_km,
    coalesce(sum(step_km) OVER (PARTITION BY trip_id), 0) AS trip_km FROM kms),
  fracs AS (SELECT *, cum_km / CASE WHEN trip_km > 0 THEN trip_km ELSE 1 END AS frac FROM cums),
  segs AS (SELECT *, coalesce(lag(frac) OVER {W}, 0) AS pfrac FROM fracs)"""
NODES = f"""{STEPS},
  owned AS (SELECT *, unnest(range(CAST(ceil(pfrac * 99) AS BIGINT), CASE WHEN frac >= 1 - 1e-12 THEN 100 ELSE CAST(ceil(frac * 99) AS BIGINT) END)) AS k
    FROM segs WHERE trip_km > 0 AND plat IS NOT NULL AND frac > pfrac AND pfrac < 1 - 1e-12),
  nodes AS (SELECT start_port, trip_id, CAST(k AS INT) AS k, plat + (latitude - plat) * ((k / 99 - pfrac) / (frac - pfrac)) AS lat,
    plon + (longitude - plon) * ((k / 99 - pfrac) / (frac - pfrac)) AS lon FROM owned),
  path AS (SELECT start_port, k, avg(lat) AS lat, avg(lon) AS lon FROM nodes GROUP BY start_port, k),
  centre AS (SELECT start_port, avg(latitude) AS lat0, avg(longitude) AS lon0 FROM traj GROUP BY start_port)"""
FEATURES = f"""{NODES},
  feats AS (SELECT s.trip_id, s.point_id, s.start_port, s.time_stamp, s.latitude, s.longitude, s.speed_over_ground, s.course_over_ground, s.draught,
    dv, dcourse, ddraft, CASE WHEN {IN_ZONE} THEN 0 ELSE 1 END AS zone, (s.longitude - lon0) * 111.320::DOUBLE * cos(radians(lat0)) AS x_km,
    (s.latitude - lat0) * 110.574::DOUBLE AS y_km, {km('s.latitude', 's.longitude', 'p.lat', 'p.lon')} AS dist_to_ref, CAST(1 AS DOUBLE) AS route_dummy
    FROM fracs s JOIN centre c ON c.start_port = s.start_port
    LEFT JOIN path p ON p.start_port = s.start_port AND p.k = least(floor(s.frac * 99 + 1e-9), 99))"""


def _points(spark, sf, **options):
    points = fx.traj(spark, sf)
    return points, ft.point_layout(points, **options)


@query(
    "j10_tied_order_split",
    """WITH tied AS (SELECT trip_id, point_id, speed_over_ground, date_trunc('month', time_stamp) AS t, CAST(point_id % 3 AS VARCHAR) AS name FROM traj)
    SELECT point_id, CAST(row_number() OVER w AS BIGINT) AS pos, round(sum(speed_over_ground) OVER (w ROWS UNBOUNDED PRECEDING), 4) AS upto,
      lag(point_id) OVER w AS before, first_value(point_id) OVER w AS first_point FROM tied WINDOW w AS (PARTITION BY trip_id ORDER BY t, name, point_id)""",
)
def j10_tied(spark, sf):
    """Equal times, then a text, then the key: trips are cut inside equal values."""
    tied = fx.traj(spark, sf).select("trip_id", "point_id", "speed_over_ground", F.date_trunc("month", "time_stamp").alias("t"), (F.col("point_id") % 3).cast("string").alias("name"))
    layout = detect(tied, ["trip_id"], ["t", "name", "point_id"], chunk_rows=10)
    out = scan(tied, layout, pos=position(), upto=running_sum("speed_over_ground"), before=previous("point_id"))
    first = out.where("pos = 1").select("trip_id", F.col("point_id").alias("first_point"))
    return rounded(join_values(out, first, layout).select("point_id", "pos", "upto", "before", "first_point"), 4)


# ---------------------------------------------------------------- geometry and motion


@query("f7_haversine", f"SELECT point_id, round({km('latitude', 'longitude', '54.33::DOUBLE', '10.15::DOUBLE')}, 6) AS km FROM traj")
def f7(spark, sf):
    d = geo.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(54.33), F.lit(10.15))
    return rounded(fx.traj(spark, sf).select("point_id", d.alias("km")))


ZONE_ROWS = """SELECT latitude + 0.0004 * (point_id % 250) AS lat_max, latitude - 0.0002 * (point_id % 190) AS lat_min,
    longitude + 0.0005 * (point_id % 310) AS lon_max, longitude - 0.0003 * (point_id % 170) AS lon_min FROM {traj} WHERE point_id % 3 = 0"""


@query(
    "j5_zone_table",
    f"""WITH zones AS ({ZONE_ROWS.format(traj='traj')}), moved AS (SELECT point_id, latitude + 0.003 AS lat, longitude - 0.002 AS lon FROM traj)
    SELECT point_id, CASE WHEN EXISTS (SELECT 1 FROM zones WHERE lat BETWEEN lat_min AND lat_max AND lon BETWEEN lon_min AND lon_max) THEN 0 ELSE 1 END AS zone FROM moved""",
)
def j5_table(spark, sf):
    """A third of the points have a rectangle of their own, from a point to some twentieths of a degree."""
    points = fx.traj(spark, sf)
    zones = spark.sql(ZONE_ROWS.format(traj="{traj}"), traj=points)
    moved = points.select("point_id", (F.col("latitude") + 0.003).alias("lat"), (F.col("longitude") - 0.002).alias("lon"))
    return zone_labels(moved, zones, "lat", "lon").select("point_id", "zone")


@query("f8_zone", f"SELECT point_id, CASE WHEN {IN_ZONE} THEN 0 ELSE 1 END AS zone FROM traj")
def f8(spark, sf):
    return fx.traj(spark, sf).select("point_id", geo.zone_label(F.col("latitude"), F.col("longitude")).alias("zone"))


@query("j5_points_in_zones", f"SELECT trip_id, point_id FROM traj WHERE {IN_ZONE}")
def j5(spark, sf):
    return fx.traj(spark, sf).filter(geo.in_zones(F.col("latitude"), F.col("longitude"))).select("trip_id", "point_id")


@query("u6_one_hot", f"SELECT point_id, {IN_ZONE} AS zone_0, NOT {IN_ZONE} AS zone_1 FROM traj")
def u6(spark, sf):
    return ft.add_zone(fx.traj(spark, sf)).select("point_id", "zone_0", "zone_1")


@query(
    "f9_local_projection",
    f"""WITH centre AS (SELECT start_port, avg(latitude) AS lat0, avg(longitude) AS lon0 FROM traj GROUP BY start_port)
    SELECT point_id, round((longitude - lon0) * 111.320::DOUBLE * cos(radians(lat0)), 6) AS x_km, round((latitude - lat0) * 110.574::DOUBLE, 6) AS y_km
    FROM traj JOIN centre USING (start_port)""",
)
def f9(spark, sf):
    points = fx.traj(spark, sf)
    joined = ft.join_routes(points, ft.route_centroids(points))
    x = geo.local_x_km(F.col("longitude"), F.col("lat0"), F.col("lon0"))
    y = geo.local_y_km(F.col("latitude"), F.col("lat0"))
    return rounded(joined.select("point_id", x.alias("x_km"), y.alias("y_km")))


@query(
    "f11_planar_distance",
    f"WITH {STEPS} SELECT point_id, round(sqrt(power(latitude - plat, 2) + power(longitude - plon, 2)), 6) AS degrees FROM steps",
)
def f11(spark, sf):
    points, layout = _points(spark, sf)
    d = geo.planar_degrees(F.col("latitude"), F.col("longitude"), F.col("prev_lat"), F.col("prev_lon"))
    return rounded(ft.add_steps(points, layout).select("point_id", d.alias("degrees")))


@query("f16_route_dummy", "SELECT point_id, CAST(1 AS DOUBLE) AS route_dummy FROM traj")
def f16(spark, sf):
    return fx.traj(spark, sf).select("point_id", F.lit(1.0).alias("route_dummy"))


@query(
    "a9_route_centroid",
    "SELECT start_port, round(avg(latitude), 6) AS lat0, round(avg(longitude), 6) AS lon0 FROM traj GROUP BY start_port",
)
def a9(spark, sf):
    return rounded(ft.route_centroids(fx.traj(spark, sf)))


@query(
    "a10_first_port_position",
    """SELECT start_port, arg_min(draught, (time_stamp, point_id)) FILTER (draught IS NOT NULL) AS start_latitude,
       arg_min(longitude, (time_stamp, point_id)) AS start_longitude FROM traj GROUP BY start_port""",
)
def a10(spark, sf):
    points = fx.traj(spark, sf).withColumns({"start_latitude": F.col("draught"), "start_longitude": F.col("longitude")})
    return ft.first_port_position(points)


@_both("w5_deltas", f"WITH {STEPS} SELECT point_id, round(dv, 6) AS dv, round(ddraft, 6) AS ddraft FROM steps")
def w5(spark, sf, **options):
    points, layout = _points(spark, sf, **options)
    return rounded(ft.add_deltas(points, layout).select("point_id", "dv", "ddraft"))


@_both("w6_dcourse", f"WITH {STEPS} SELECT point_id, dcourse, coalesce(turn, 0) AS dcourse_unwrapped FROM kms")
def w6(spark, sf, **options):
    points, layout = _points(spark, sf, **options)
    both = ft.add_deltas(points, layout).withColumnRenamed("dcourse", "wrapped").drop("dv", "ddraft")
    return ft.add_deltas(both, layout, wrap=False).select("point_id", F.col("wrapped").alias("dcourse"), F.col("dcourse").alias("dcourse_unwrapped"))


@_both("w7_cumulative_distance", f"WITH {STEPS} SELECT point_id, round(cum_km, 6) AS cum_km, round(trip_km, 6) AS trip_km FROM cums")
def w7(spark, sf, **options):
    points, layout = _points(spark, sf, **options)
    return rounded(ft.add_distance(ft.add_steps(points, layout), layout).select("point_id", "cum_km", "trip_km"))


@_both("w8_distance_fraction", f"WITH {STEPS} SELECT point_id, round(frac, 6) AS frac, round(pfrac, 6) AS prev_frac FROM segs")
def w8(spark, sf, **options):
    points, layout = _points(spark, sf, **options)
    return rounded(ft.add_distance(ft.add_steps(points, layout), layout).select("point_id", "frac", "prev_frac"))


@_both("w9_resample", f"WITH {NODES} SELECT start_port, trip_id, k, round(lat, 6) AS lat, round(lon, 6) AS lon FROM nodes")
def w9(spark, sf, **options):
    points, layout = _points(spark, sf, **options)
    return rounded(ft.resample(ft.add_distance(ft.add_steps(points, layout), layout)))


@query("a15_average_path", f"WITH {NODES} SELECT start_port, k, round(lat, 6) AS lat, round(lon, 6) AS lon FROM path")
def a15(spark, sf):
    points, layout = _points(spark, sf)
    return rounded(ft.average_path(ft.resample(ft.add_distance(ft.add_steps(points, layout), layout))))


@query(
    "j4_path_node",
    f"""WITH {NODES} SELECT s.point_id, p.k, round(p.lat, 6) AS lat, round(p.lon, 6) AS lon FROM fracs s
    JOIN path p ON p.start_port = s.start_port AND p.k = least(floor(s.frac * 99 + 1e-9), 99)""",
)
def j4(spark, sf):
    points, layout = _points(spark, sf)
    moved = ft.add_distance(ft.add_steps(points, layout), layout)
    joined = ft.join_routes(moved, plan.route_statistics(points, layout), points).withColumn("k", ft.path_node(F.col("frac")))
    return rounded(joined.select("point_id", "k", F.get("path_lat", "k").alias("lat"), F.get("path_lon", "k").alias("lon")))


@query("f10_distance_to_path", f"WITH {FEATURES} SELECT point_id, round(dist_to_ref, 6) AS dist_to_ref FROM feats")
def f10(spark, sf):
    return rounded(plan.feature_points(fx.traj(spark, sf)).select("point_id", "dist_to_ref"))


FEATURE_SQL = f"""WITH {FEATURES} SELECT point_id, start_port, round(dv, 6) AS dv, dcourse, round(ddraft, 6) AS ddraft, zone, zone = 0 AS zone_0, zone = 1 AS zone_1,
    round(x_km, 6) AS x_km, round(y_km, 6) AS y_km, round(dist_to_ref, 6) AS dist_to_ref, route_dummy FROM feats"""


@_both("b6_feature_points", FEATURE_SQL)
def b6(spark, sf, **options):
    points, layout = _points(spark, sf, **options)
    out = plan.feature_points(points, layout=layout)
    return rounded(out.select("point_id", "start_port", "dv", "dcourse", "ddraft", "zone", "zone_0", "zone_1", "x_km", "y_km", "dist_to_ref", "route_dummy"))


@query("u2_union_routes", "SELECT point_id, start_port FROM traj WHERE start_port IN ('KIEL', 'BREMERHAVEN')")
def u2(spark, sf):
    points = fx.traj(spark, sf).select("point_id", "start_port")
    return trips.union_frames(*[trips.select_route(points, r) for r in S.SPLIT_PORTS])


# ---------------------------------------------------------------- labels

SPANS = f"""texts AS (SELECT trip_id, point_id, {INTERVAL_TEXT} FROM traj),
  spans AS (SELECT trip_id, least(CAST(split_part(interval, '-', 1) AS INT), CAST(split_part(interval, '-', 2) AS INT)) AS start_pos,
    greatest(CAST(split_part(interval, '-', 1) AS INT), CAST(split_part(interval, '-', 2) AS INT)) AS end_pos
    FROM texts WHERE point_id % 10 = 0 AND regexp_matches(interval, '^\\d+-\\d+$')),
  numbered AS (SELECT *, CAST(row_number() OVER {W} AS INT) AS entry FROM traj)"""


def _spans(spark, sf):
    texts = fx.traj(spark, sf).filter("point_id % 10 = 0").selectExpr("trip_id", INTERVAL_TEXT)
    return lb.parse_intervals(texts)


@_both("w14_entry_number", f"SELECT point_id, CAST(row_number() OVER {W} AS INT) AS entry FROM traj")
def w14(spark, sf, **options):
    points, layout = _points(spark, sf, **options)
    return lb.number_points(points, layout).select("point_id", "entry")


@_both(
    "j6_points_in_intervals",
    f"""WITH {SPANS} SELECT point_id, EXISTS (SELECT 1 FROM spans s WHERE s.trip_id = n.trip_id AND n.entry BETWEEN s.start_pos AND s.end_pos) AS manual FROM numbered n""",
)
def j6(spark, sf, **options):
    points, layout = _points(spark, sf, **options)
    numbered = lb.number_points(points, layout)
    return lb.flag_intervals(numbered, layout, _spans(spark, sf)).select("point_id", "manual")


FLAGS = f"""{SPANS}, {STEPS},
  flags AS (SELECT k.trip_id, k.point_id, k.start_port, EXISTS (SELECT 1 FROM spans s WHERE s.trip_id = n.trip_id AND n.entry BETWEEN s.start_pos AND s.end_pos) AS manual,
    coalesce(dv > 3 AND plat IS NOT NULL, false) OR coalesce(CASE WHEN turn <= 180 THEN turn ELSE 360 - turn END > 30, false) AS by_delta,
    coalesce({IN_ZONE.replace('latitude', 'k.latitude').replace('longitude', 'k.longitude')}, false) AS in_zone FROM kms k JOIN numbered n ON n.point_id = k.point_id)"""


@query(
    "u5_flag_algebra",
    f"WITH {FLAGS} SELECT point_id, manual, by_delta, in_zone, (manual OR by_delta) AND NOT in_zone AS flag FROM flags",
)
def u5(spark, sf):
    points, layout = _points(spark, sf)
    return lb.rule_flags(points, layout, _spans(spark, sf)).select("point_id", "manual", "by_delta", "in_zone", "flag")


@query(
    "b1_label_counts",
    f"""WITH {FLAGS} SELECT start_port, count(*) AS points, count(*) FILTER (WHERE manual) AS manual_points, count(*) FILTER (WHERE by_delta) AS delta_points,
    count(*) FILTER (WHERE manual OR by_delta) AS combined_points, count(*) FILTER (WHERE (manual OR by_delta) AND in_zone) AS overridden_points,
    count(*) FILTER (WHERE (manual OR by_delta) AND NOT in_zone) AS final_points, round(count(*) FILTER (WHERE (manual OR by_delta) AND NOT in_zone) / count(*), 6) AS anomaly_share
    FROM flags GROUP BY start_port""",
)
def b1_counts(spark, sf):
    points, layout = _points(spark, sf)
    return rounded(lb.flag_counts(lb.rule_flags(points, layout, _spans(spark, sf)), "start_port"))


@_both("b1_labels", f"WITH {FLAGS} SELECT point_id, (manual OR by_delta) AND NOT in_zone AS is_anomaly FROM flags")
def b1(spark, sf, **options):
    points, layout = _points(spark, sf, **options)
    return plan.label_table(points, _spans(spark, sf), layout).select("point_id", "is_anomaly")


@query(
    "j9_write_back",
    f"""WITH {FLAGS} SELECT t.point_id, CASE WHEN t.trip_id = 8 THEN (manual OR by_delta) AND NOT in_zone ELSE is_anomaly END AS is_anomaly,
    CASE WHEN t.trip_id = 8 THEN CAST((manual OR by_delta) AND NOT in_zone AS INT) ELSE CAST(is_anomaly AS INT) END AS y_true
    FROM traj t JOIN flags f ON f.point_id = t.point_id""",
)
def j9(spark, sf):
    points = trips.add_target(fx.traj(spark, sf))
    trip = trips.select_trip(points, 8)
    flags = lb.rule_flags(trip, ft.point_layout(trip), _spans(spark, sf))
    return lb.write_back(points, flags).select("point_id", "is_anomaly", "y_true")


@query(
    "e6_anomaly_share",
    "SELECT trip_id, count(*) AS points, count(*) FILTER (WHERE is_anomaly) AS anomalies, round(count(*) FILTER (WHERE coalesce(is_anomaly, false)) / count(*), 6) AS share FROM traj GROUP BY trip_id",
)
def e6(spark, sf):
    return rounded(ev.anomaly_share(fx.traj(spark, sf), ["trip_id"]))


# ---------------------------------------------------------------- windows

# Whole trips are anomalous here, so that some windows are too.
SEQ = f"""labelled AS (SELECT * REPLACE (CASE WHEN point_id % 41 = 0 THEN NULL ELSE trip_id % 5 = 0 END AS is_anomaly) FROM traj),
  complete AS (SELECT *, CAST(is_anomaly AS INT) AS y_true FROM labelled WHERE draught IS NOT NULL AND is_anomaly IS NOT NULL),
  placed AS (SELECT *, row_number() OVER {W} - 1 AS pos, count(*) OVER (PARTITION BY trip_id) AS n FROM complete),
  sizes AS (SELECT DISTINCT start_port, trip_id, n FROM placed),
  starts AS (SELECT start_port, trip_id, n, unnest(range(0, n - 16, 7)) AS s FROM sizes WHERE n > 16),
  wins AS (SELECT s.start_port, s.trip_id, s.s, min(y_true) AS label, list([speed_over_ground, draught] ORDER BY pos) AS features,
    max(speed_over_ground) AS error FROM starts s JOIN placed p ON p.trip_id = s.trip_id AND p.pos BETWEEN s.s AND s.s + 14 GROUP BY ALL)"""
WINDOW_FEATURES = ["speed_over_ground", "draught"]


def _sequence_points(spark, sf):
    flag = F.when(F.col("point_id") % 41 != 0, F.col("trip_id") % 5 == 0)
    return trips.add_target(fx.traj(spark, sf).withColumn("is_anomaly", flag))


def _placed(spark, sf, **options):
    complete = trips.complete_rows(_sequence_points(spark, sf), WINDOW_FEATURES)
    layout = ft.point_layout(complete, **options)
    return sequences.with_positions(complete, layout)


@_both("w10_window_starts", f"WITH {SEQ} SELECT trip_id, CAST(s AS INT) AS start_pos, CAST(n AS INT) AS n_points FROM starts")
def w10(spark, sf, **options):
    return sequences.window_starts(_placed(spark, sf, **options)).drop("start_port")


@query(
    "w10_window_values",
    f"WITH {SEQ} SELECT trip_id, CAST(s AS INT) AS start_pos, CAST(list_position(list_transform(features, lambda x: x[1]), error) AS INT) AS peak, CAST(len(features) AS INT) AS size, label FROM wins",
)
def w10_values(spark, sf):
    windows = sequences.build_windows(_placed(spark, sf), WINDOW_FEATURES)
    speeds = F.transform("features", lambda x: x[0])
    peak = F.array_position(speeds, F.array_max(speeds)).cast("int")
    return windows.select("trip_id", "start_pos", peak.alias("peak"), F.size("features").alias("size"), "label")


@query("w11_window_labels", f"WITH {SEQ} SELECT start_port, label, count(*) AS windows FROM wins GROUP BY ALL")
def w11(spark, sf):
    windows = sequences.build_windows(_placed(spark, sf), WINDOW_FEATURES)
    return windows.groupBy("start_port", "label").agg(F.count("*").alias("windows"))


PADDED = f"""{SEQ}, padded AS (SELECT trip_id, list(speed_over_ground ORDER BY pos) AS v, max(n) AS n FROM placed GROUP BY trip_id),
  long AS (SELECT *, unnest(range(0, greatest(n - 70, 0) + 1, 7)) AS s FROM padded)"""


@query(
    "w12_padding",
    f"WITH {PADDED} SELECT trip_id, CAST(s AS INT) AS start_pos, round(list_sum(list_resize(v[s + 1:s + 70], 70, v[len(v)])), 4) AS padded_sum, CAST(70 AS INT) AS size FROM long",
)
def w12(spark, sf):
    windows = sequences.build_windows(_placed(spark, sf), ["speed_over_ground"], length=70, inclusive=True, pad_short=True)
    sums = F.aggregate("features", F.lit(0.0), lambda a, x: a + x[0])
    return rounded(windows.select("trip_id", "start_pos", sums.alias("padded_sum"), F.size("features").alias("size")), 4)


@_both(
    "w13_point_scores",
    f"""WITH {SEQ} SELECT p.point_id, coalesce(max(w.error), 0) AS score FROM placed p
    LEFT JOIN wins w ON w.trip_id = p.trip_id AND p.pos BETWEEN w.s AND w.s + 14 GROUP BY p.point_id""",
)
def w13(spark, sf, **options):
    placed = _placed(spark, sf, **options)
    windows = sequences.build_windows(placed, ["speed_over_ground"])
    errors = windows.withColumn("error", F.array_max(F.transform("features", lambda x: x[0])))
    return sequences.point_scores(placed, errors).select("point_id", "score")


HELD = """sized AS (SELECT start_port, trip_id, row_number() OVER (PARTITION BY start_port ORDER BY md5(CAST(trip_id AS VARCHAR) || '-42')) AS r,
    count(*) OVER (PARTITION BY start_port) AS n FROM (SELECT DISTINCT start_port, trip_id FROM {source})),
  held AS (SELECT start_port, trip_id, r <= greatest(1, ceil(n * 0.1 - 1e-9)) AS is_test FROM sized)"""


@query(
    "b9_sequence_sets",
    f"""WITH {SEQ}, {HELD.format(source='wins')} SELECT start_port, CASE WHEN label = 1 THEN 'anomaly' WHEN is_test THEN 'validation' ELSE 'train' END AS part, count(*) AS windows
    FROM wins JOIN held USING (start_port, trip_id) GROUP BY ALL""",
)
def b9(spark, sf):
    sets = plan.sequence_sets(_sequence_points(spark, sf), WINDOW_FEATURES)
    return sets.groupBy("start_port", "part").agg(F.count("*").alias("windows"))


@query("u4_normal_windows", f"WITH {SEQ} SELECT trip_id, CAST(s AS INT) AS start_pos FROM wins WHERE label = 0")
def u4(spark, sf):
    windows = sequences.build_windows(_placed(spark, sf), WINDOW_FEATURES)
    return windows.filter("label = 0").select("trip_id", "start_pos")


@query(
    "k4_min_max",
    f"""WITH {SEQ}, cells AS (SELECT start_port, trip_id, s, label, unnest(features) AS f FROM wins),
    ranges AS (SELECT start_port, min(f[1]) AS lo1, max(f[1]) AS hi1, min(f[2]) AS lo2, max(f[2]) AS hi2 FROM cells WHERE label = 0 GROUP BY start_port)
    SELECT trip_id, CAST(s AS INT) AS start_pos, round(sum((f[1] - lo1) / (hi1 - lo1)), 4) AS speed_sum, round(sum((f[2] - lo2) / (hi2 - lo2)), 4) AS draught_sum
    FROM cells JOIN ranges USING (start_port) GROUP BY trip_id, s""",
)
def k4(spark, sf):
    windows = sequences.build_windows(_placed(spark, sf), WINDOW_FEATURES)
    ranges = scaling.window_ranges(windows.filter("label = 0"), len(WINDOW_FEATURES))
    scaled = scaling.scale_windows(windows, ranges)

    def summed(i):
        return F.aggregate("features", F.lit(0.0), lambda a, x: a + x[i])

    return rounded(scaled.select("trip_id", "start_pos", summed(0).alias("speed_sum"), summed(1).alias("draught_sum")), 4)


@query(
    "j1_features_and_labels",
    """SELECT t.trip_id, count(*) AS points, count(*) FILTER (WHERE is_anomaly) AS anomalies, round(sum(speed_over_ground), 4) AS speed_sum FROM traj t
       WHERE draught IS NOT NULL AND is_anomaly IS NOT NULL GROUP BY t.trip_id""",
)
def j1(spark, sf):
    points = fx.traj(spark, sf)
    features = points.filter("draught IS NOT NULL").select("trip_id", "point_id", "speed_over_ground")
    labels = points.filter("is_anomaly IS NOT NULL").select("trip_id", "point_id", "is_anomaly")
    joined = features.join(labels, ["trip_id", "point_id"])
    return rounded(
        joined.groupBy("trip_id").agg(
            F.count("*").alias("points"), F.count_if("is_anomaly").alias("anomalies"), F.sum("speed_over_ground").alias("speed_sum")
        ),
        4,
    )


# ---------------------------------------------------------------- splits

RANKED = """ranked AS (SELECT start_port, point_id, CAST(is_anomaly AS INT) AS y_true,
    row_number() OVER (PARTITION BY start_port, is_anomaly ORDER BY md5(CAST(point_id AS VARCHAR) || '-42')) AS r,
    count(*) OVER (PARTITION BY start_port, is_anomaly) AS n FROM traj WHERE is_anomaly IS NOT NULL)"""


def _targets(spark, sf):
    return trips.add_target(fx.traj(spark, sf)).filter("y_true IS NOT NULL").select("start_port", "point_id", "y_true")


@_both("g1_holdout", f"WITH {RANKED} SELECT point_id, r <= greatest(1, floor(n * 0.1 + 1e-9)) AS is_test FROM ranked")
def g1(spark, sf, **options):
    return split.holdout(_targets(spark, sf), ["start_port", "y_true"], 0.1, "point_id", **options).select("point_id", "is_test")


@query(
    "g2_one_class_holdout",
    f"""WITH {RANKED} SELECT start_port, y_true, CASE WHEN y_true = 1 OR r <= greatest(1, floor(n * 0.125 + 1e-9)) THEN 'test' ELSE 'train' END AS part,
    count(*) AS points, CAST(sum(point_id) AS BIGINT) AS ids FROM ranked GROUP BY ALL""",
)
def g2(spark, sf):
    parts = split.one_class_holdout(_targets(spark, sf), "start_port", "y_true", 0.125, "point_id")
    return parts.groupBy("start_port", "y_true", "part").agg(F.count("*").alias("points"), F.sum("point_id").alias("ids"))


@query("g3_trip_holdout", f"WITH {HELD.format(source='traj')} SELECT start_port, trip_id, is_test FROM held")
def g3(spark, sf):
    return split.trip_holdout(fx.traj(spark, sf), "start_port", "trip_id").select("start_port", "trip_id", "is_test")


@_both("g4_folds", f"WITH {RANKED} SELECT point_id, CAST((r - 1) % 5 AS INT) AS fold FROM ranked")
def g4(spark, sf, **options):
    return split.folds(_targets(spark, sf), ["start_port", "y_true"], 5, "point_id", **options).select("point_id", "fold")


@query("j3_train_rows", f"WITH {RANKED} SELECT point_id FROM ranked WHERE r > greatest(1, floor(n * 0.1 + 1e-9))")
def j3(spark, sf):
    targets = _targets(spark, sf)
    held = split.holdout(targets, ["start_port", "y_true"], 0.1, "point_id").filter("is_test")
    return trips.exclude_trips(targets, held, "point_id").select("point_id")


@query("u3_test_rows", f"WITH {RANKED} SELECT point_id, y_true FROM ranked WHERE y_true = 1 OR r <= greatest(1, floor(n * 0.125 + 1e-9))")
def u3(spark, sf):
    parts = split.one_class_holdout(_targets(spark, sf), "start_port", "y_true", 0.125, "point_id")
    return parts.filter("part = 'test'").select("point_id", "y_true")


# ---------------------------------------------------------------- metrics

EVALS = """evals AS (SELECT point_id AS id, start_port, CASE WHEN is_anomaly IS NULL THEN -1 ELSE CAST(is_anomaly AS INT) END AS y, speed_over_ground / 50 AS score,
    CASE WHEN speed_over_ground > 30 THEN 1 ELSE 0 END AS pred FROM traj),
  cm AS (SELECT start_port, count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp,
    count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = -1) AS unlabeled FROM evals GROUP BY start_port)"""


def _evals(spark, sf):
    points = fx.traj(spark, sf)
    return points.select(
        F.col("point_id").alias("id"),
        "start_port",
        F.coalesce(F.col("is_anomaly").cast("int"), F.lit(-1)).alias("y"),
        (F.col("speed_over_ground") / 50).alias("score"),
        F.when(F.col("speed_over_ground") > 30, 1).otherwise(0).alias("pred"),
    )


@query("e1_confusion", f"WITH {EVALS} SELECT * FROM cm")
def e1(spark, sf):
    return ev.confusion(_evals(spark, sf), ["start_port"])


@query(
    "e2_class_report",
    f"""WITH {EVALS}, c AS (SELECT start_port, CAST(tp AS DOUBLE) AS tp, CAST(tn AS DOUBLE) AS tn, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn FROM cm),
    per AS (SELECT start_port, '0' AS row, tn / (tn + fn) AS p, tn / (tn + fp) AS r, 2 * tn / (2 * tn + fp + fn) AS f, tn + fp AS s FROM c
      UNION ALL SELECT start_port, '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM c),
    report AS (SELECT * FROM per UNION ALL SELECT start_port, 'macro avg', avg(p), avg(r), avg(f), sum(s) FROM per GROUP BY start_port
      UNION ALL SELECT start_port, 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) FROM per GROUP BY start_port
      UNION ALL SELECT start_port, 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM c)
    SELECT start_port, row, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(s AS BIGINT) AS support FROM report""",
)
def e2(spark, sf):
    return rounded(ev.class_report(ev.confusion(_evals(spark, sf), ["start_port"]), ["start_port"]))


@query(
    "e3_binary_metrics",
    f"""WITH {EVALS} SELECT cm.*, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
    round(tn / (tn + fp), 6) AS specificity, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
    round((CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn) / sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS mcc FROM cm""",
)
def e3(spark, sf):
    return rounded(ev.binary_metrics(ev.confusion(_evals(spark, sf), ["start_port"])))


@_both(
    "e4_roc_auc",
    f"""WITH {EVALS}, ranks AS (SELECT start_port, y, rank() OVER (PARTITION BY start_port ORDER BY score) +
      (count(*) OVER (PARTITION BY start_port, score) - 1) / 2 AS r FROM evals WHERE y >= 0)
    SELECT start_port, round((sum(CASE WHEN y = 1 THEN r END) - CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * (count(*) FILTER (WHERE y = 1) + 1) / 2) / (CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * count(*) FILTER (WHERE y = 0)), 6) AS auc
    FROM ranks GROUP BY start_port""",
)
def e4(spark, sf, **options):
    return rounded(ev.roc_auc(_evals(spark, sf).filter("y >= 0"), ["start_port"], **options))


@query(
    "e5_r_squared",
    """SELECT start_port, round(1 - sum(power(draught - speed_over_ground, 2)) / sum(power(draught - m, 2)), 6) AS r2 FROM traj
       JOIN (SELECT start_port AS p, avg(draught) AS m FROM traj GROUP BY start_port) ON p = start_port WHERE draught IS NOT NULL GROUP BY start_port""",
)
def e5(spark, sf):
    known = fx.traj(spark, sf).filter("draught IS NOT NULL")
    return rounded(ev.r_squared(known, "draught", "speed_over_ground", ["start_port"]))


TAUS = """taus AS (SELECT CAST(i AS INT) AS tau_index, CASE WHEN i = 100 THEN 1 ELSE i * CAST(0.01 AS DOUBLE) END AS tau FROM range(0, 101) g(i)),
  swept AS (SELECT start_port, tau_index, tau, count(*) FILTER (WHERE y = 1 AND score > tau) AS tp, count(*) FILTER (WHERE y = 0 AND score > tau) AS fp,
    count(*) FILTER (WHERE y = 1 AND score <= tau) AS fn, count(*) FILTER (WHERE y = 0 AND score <= tau) AS tn FROM evals, taus WHERE y >= 0 GROUP BY ALL),
  scored AS (SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END AS f1 FROM swept)"""


@query("k11_threshold_scan", f"WITH {EVALS}, {TAUS} SELECT * REPLACE (round(tau, 6) AS tau, round(f1, 6) AS f1) FROM scored")
def k11(spark, sf):
    return rounded(ev.threshold_scan(_evals(spark, sf).filter("y >= 0"), scalar.even_grid(0, 1, 101), ["start_port"]))


@query(
    "l4_best_threshold",
    f"""WITH {EVALS}, {TAUS} SELECT start_port, round(tau, 6) AS tau, round(f1, 6) AS f1 FROM
    (SELECT *, row_number() OVER (PARTITION BY start_port ORDER BY f1 DESC, tau_index) AS r FROM scored) WHERE r = 1""",
)
def l4(spark, sf):
    scanned = ev.threshold_scan(_evals(spark, sf).filter("y >= 0"), scalar.even_grid(0, 1, 101), ["start_port"])
    return rounded(ev.best_threshold(scanned, ["start_port"]))


@query(
    "f15_percentile_grid",
    f"""WITH {EVALS}, grid AS (SELECT CAST(i AS INT) AS i, 60 + i * (CAST(39.9 AS DOUBLE) / 79) AS percent FROM range(0, 80) g(i)),
    stats AS (SELECT start_port, quantile_cont(score, [{', '.join(f'{(60 + i * 39.9 / 79) / 100!r}::DOUBLE' for i in range(80))}]) AS q FROM evals GROUP BY start_port)
    SELECT start_port, i AS tau_index, round(percent, 6) AS percent, round(q[i + 1], 6) AS tau FROM grid, stats""",
)
def f15(spark, sf):
    percents = scalar.even_grid(60, 99.9, 80)
    names = [f"t{i}" for i in range(80)]
    grid = group_percentiles(_evals(spark, sf), ["start_port"], "score", [p / 100 for p in percents], names)
    entries = F.array(*[F.struct(F.lit(i).alias("tau_index"), F.lit(p).alias("percent"), F.col(n).alias("tau")) for i, (p, n) in enumerate(zip(percents, names, strict=True))])
    return rounded(grid.select("start_port", F.inline(entries)))


@_both(
    "a16_percentiles",
    f"WITH {EVALS} SELECT start_port, round(quantile_cont(score, 0.94::DOUBLE), 6) AS p94, round(quantile_cont(score, 0.95::DOUBLE), 6) AS p95 FROM evals GROUP BY start_port",
)
def a16(spark, sf, **options):
    return rounded(group_percentiles(_evals(spark, sf), ["start_port"], "score", [0.94, 0.95], ["p94", "p95"], **options))


@query(
    "a17_histogram",
    f"""WITH {EVALS}, ranges AS (SELECT y, min(score) AS lo, max(score) AS hi FROM evals GROUP BY y)
    SELECT y, CAST(least(99, floor((score - lo) * 100 / (hi - lo))) AS INT) AS bin, count(*) AS rows FROM evals JOIN ranges USING (y) GROUP BY ALL""",
)
def a17(spark, sf):
    return profile.histogram(_evals(spark, sf), "score", "y")


@query(
    "a17_box_quantiles",
    f"""WITH {EVALS}, q AS (SELECT y, quantile_cont(score, [0::DOUBLE, 0.25::DOUBLE, 0.5::DOUBLE, 0.75::DOUBLE, 1::DOUBLE]) AS q FROM evals GROUP BY y)
    SELECT y, round(q[1], 6) AS low, round(q[2], 6) AS q1, round(q[3], 6) AS median, round(q[4], 6) AS q3, round(q[5], 6) AS high FROM q""",
)
def a17_box(spark, sf):
    return rounded(profile.box_quantiles(_evals(spark, sf), "score", "y"))


@query("e1_label_scores", "SELECT count(*) FILTER (WHERE y = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y = 0 AND pred = 0) AS tn, count(*) FILTER (WHERE y = 0 AND pred = 1) AS fp, count(*) FILTER (WHERE y = 1 AND pred = 0) AS fn, count(*) FILTER (WHERE y = -1) AS unlabeled FROM scores")
def e1_scores(spark, sf):
    return ev.confusion(fx.scores(spark, sf))


@query(
    "k3_standardise",
    """SELECT t.point_id, round((speed_over_ground - m1) / s1, 6) AS speed_over_ground, round((course_over_ground - m2) / s2, 6) AS course_over_ground, CAST(0 AS DOUBLE) AS one
       FROM traj t JOIN (SELECT start_port, avg(speed_over_ground) AS m1, stddev_pop(speed_over_ground) AS s1, avg(course_over_ground) AS m2, stddev_pop(course_over_ground) AS s2
         FROM traj GROUP BY start_port) USING (start_port)""",
)
def k3(spark, sf):
    points = fx.traj(spark, sf).withColumn("one", F.lit(1.0))
    columns = ["speed_over_ground", "course_over_ground", "one"]
    stats = scaling.moments(points, columns, ["start_port"])
    return rounded(scaling.standardise(points, stats, columns, ["start_port"]).select("point_id", *columns))


@query(
    "k3_scale_vectors",
    """WITH cells AS (SELECT vec_id, start_port, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM vectors),
    stats AS (SELECT start_port, i, avg(v::DOUBLE) AS m, stddev_pop(v::DOUBLE) AS s FROM cells GROUP BY ALL)
    SELECT vec_id, CAST(i - 1 AS INT) AS i, round((v::DOUBLE - m) / CASE WHEN s > 0 THEN s ELSE 1 END, 6) AS value FROM cells JOIN stats USING (start_port, i)""",
)
def k3_vectors(spark, sf):
    vectors = fx.vectors(spark, sf)
    cells = vectors.select("vec_id", "start_port", F.posexplode("embedding").alias("i", "v")).withColumn("value", F.col("v").cast("double"))
    stats = scaling.moments(cells, ["value"], ["start_port", "i"])
    return rounded(scaling.standardise(cells, stats, ["value"], ["start_port", "i"]).select("vec_id", "i", "value"))
