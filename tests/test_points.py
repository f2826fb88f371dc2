"""Features, windows, labels and metrics against brute force."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wakeline.functions import geo
from wakeline.functions.scalar import even_grid
from wakeline.operators import zones as zones_of
from wakeline.operators import evaluate as ev
from wakeline.operators import features as ft
from wakeline.operators import labels as lb
from wakeline.operators import sequences, split
from wakeline.plans import features as plan

SCHEMA = "trip_id long, point_id long, start_port string, time_stamp timestamp_ntz, latitude double, longitude double, speed_over_ground double, course_over_ground double, draught double, is_anomaly boolean"


def trips(sizes, seed=2):
    rnd = random.Random(seed)
    out, pid = [], 0
    for trip, n in enumerate(sizes):
        for k in range(n):
            t = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k)
            out.append((trip, pid, "KIEL" if trip % 2 else "BREMERHAVEN", t, 54 + rnd.random(), 9 + rnd.random(), rnd.random() * 20, rnd.random() * 360, None if rnd.random() < 0.2 else 5.0 + rnd.random(), trip % 3 == 0))
            pid += 1
    return out


def km(a, b, c, d):
    a, b, c, d = map(np.radians, (a, b, c, d))
    h = np.sin((c - a) / 2) ** 2 + np.cos(a) * np.cos(c) * np.sin((d - b) / 2) ** 2
    return 2 * 6371.0 * np.arcsin(np.sqrt(h))


@pytest.mark.parametrize("chunk_rows", [1_000_000, 6])
def test_path_distance_equals_numpy(spark, chunk_rows):
    rows = trips([40, 1, 25, 30, 2, 60])
    rows += [(9, 10_000 + k, "KIEL", dt.datetime(2024, 1, 2) + dt.timedelta(minutes=k), 54.5, 10.0, 1.0, 1.0, 1.0, False) for k in range(4)]  # never moves
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["point_id"]: r for r in plan.feature_points(df, layout=ft.point_layout(df, chunk_rows=chunk_rows)).collect()}
    for route in ("KIEL", "BREMERHAVEN"):
        of_route = [r for r in rows if r[2] == route]
        lat0, lon0 = np.mean([r[4] for r in of_route]), np.mean([r[5] for r in of_route])
        paths, fracs = [], {}
        for trip in sorted({r[0] for r in of_route}):
            pts = sorted((r for r in of_route if r[0] == trip), key=lambda r: (r[3], r[1]))
            lat, lon = np.array([r[4] for r in pts]), np.array([r[5] for r in pts])
            cum = np.concatenate([[0], np.cumsum(km(lat[1:], lon[1:], lat[:-1], lon[:-1]))])
            frac = cum / (cum[-1] if cum[-1] > 0 else 1)
            fracs.update({r[1]: f for r, f in zip(pts, frac)})
            if cum[-1] > 0:
                grid = np.linspace(0, 1, 100)
                paths.append(np.stack([np.interp(grid, frac, lat), np.interp(grid, frac, lon)], axis=1))
        path = np.mean(paths, axis=0)
        for r in of_route:
            node = path[min(int(fracs[r[1]] * 99 + 1e-9), 99)]
            assert got[r[1]]["dist_to_ref"] == pytest.approx(km(r[4], r[5], *node), abs=1e-6)
            assert got[r[1]]["x_km"] == pytest.approx((r[5] - lon0) * 111.320 * np.cos(np.radians(lat0)), abs=1e-6)
            assert got[r[1]]["y_km"] == pytest.approx((r[4] - lat0) * 110.574, abs=1e-6)


def test_stored_route_statistics_give_the_same_features(spark):
    df = spark.createDataFrame(trips([20, 30]), SCHEMA)
    routes = spark.createDataFrame(plan.route_statistics(df).collect(), plan.route_statistics(df).schema)
    one_trip = df.filter("trip_id = 1")
    got = {r["point_id"]: r["dist_to_ref"] for r in plan.feature_points(one_trip, routes).collect()}
    want = {r["point_id"]: r["dist_to_ref"] for r in plan.feature_points(df).filter("trip_id = 1").collect()}
    assert got == pytest.approx(want)


def _windows(df, **options):
    layout = ft.point_layout(df, chunk_rows=options.pop("chunk_rows", 1_000_000))
    placed = sequences.with_positions(df, layout)
    return placed, sequences.build_windows(placed, ["speed_over_ground"], "is_anomaly", **options)


@pytest.mark.parametrize("n, starts", [(14, []), (15, []), (16, []), (17, [0]), (30, [0, 7])])
def test_window_starts(spark, n, starts):
    df = spark.createDataFrame(trips([n]), SCHEMA)
    placed, windows = _windows(df)
    assert sorted(r["start_pos"] for r in windows.collect()) == starts
    assert sorted(r["start_pos"] for r in sequences.window_starts(placed).collect()) == starts


@pytest.mark.parametrize("chunk_rows", [1_000_000, 5])
def test_window_contents(spark, chunk_rows):
    rows = trips([17, 33, 50])
    _, windows = _windows(spark.createDataFrame(rows, SCHEMA), chunk_rows=chunk_rows)
    for w in windows.collect():
        speeds = [r[6] for r in rows if r[0] == w["trip_id"]]
        assert [v[0] for v in w["features"]] == speeds[w["start_pos"] : w["start_pos"] + 15]
        assert w["label"] == int(w["trip_id"] % 3 == 0)


def test_short_trips_are_padded_and_scored(spark):
    rows = trips([4, 15, 16, 40])
    placed, windows = _windows(spark.createDataFrame(rows, SCHEMA), inclusive=True, pad_short=True)
    collected = {(r["trip_id"], r["start_pos"]): r["features"] for r in windows.collect()}
    assert set(collected) == {(0, 0), (1, 0), (2, 0), (3, 0), (3, 7), (3, 14), (3, 21)}
    assert all(len(f) == 15 for f in collected.values())
    assert collected[(0, 0)][3:] == [collected[(0, 0)][3]] * 12
    errors = windows.withColumn("error", F.col("start_pos") + 1.0)
    scores = {(r["trip_id"], r["pos"]): r["score"] for r in sequences.point_scores(placed, errors).collect()}
    assert all(scores[(0, p)] == 1 for p in range(4)) and scores[(2, 15)] == 0
    assert [scores[(3, p)] for p in (0, 7, 14, 21, 35, 36)] == [1, 8, 15, 22, 22, 0]
    legacy = {(r["trip_id"], r["pos"]): r["score"] for r in sequences.point_scores(placed, errors, legacy_offset=True).collect()}
    assert [legacy[(3, p)] for p in (0, 1, 3, 17, 18)] == [1, 8, 22, 22, 0]


@pytest.mark.parametrize("chunk_rows", [1_000_000, 6])
def test_manual_intervals(spark, chunk_rows):
    df = spark.createDataFrame(trips([30, 12]), SCHEMA)
    spans = [(0, 3, 5), (0, 4, 9), (0, 25, 99), (1, 0, 2), (1, -4, -1), (1, 12, 12)]
    intervals = spark.createDataFrame(spans, "trip_id long, start_pos int, end_pos int")
    layout = ft.point_layout(df, chunk_rows=chunk_rows)
    flags = lb.flag_intervals(lb.number_points(df, layout), layout, intervals).collect()
    assert len(flags) == 42
    for r in flags:
        assert r["manual"] == any(t == r["trip_id"] and a <= r["entry"] <= b for t, a, b in spans)


def test_holdout_counts_and_stability(spark):
    df = spark.createDataFrame([(i, "a" if i % 3 else "b", i % 2) for i in range(200)], "id long, r string, y int")
    parts = split.holdout(df, ["r", "y"], 0.1, "id")
    for r in parts.groupBy("r", "y").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r["t"] == max(1, int(r["n"] * 0.1))
    again = split.holdout(df.repartition(5), ["r", "y"], 0.1, "id", chunk_rows=10)
    assert {r["id"] for r in parts.filter("is_test").collect()} == {r["id"] for r in again.filter("is_test").collect()}
    sizes = [r["n"] for r in split.folds(df, ["y"], 5, "id").groupBy("y", "fold").agg(F.count("*").alias("n")).collect()]
    assert sizes == [20] * 10
    held = split.trip_holdout(df.withColumn("t", F.col("id") % 15), "y", "t", 0.1)
    assert held.filter("is_test AND y = 0").count() == 2  # 15 trips, rounded up


def _scores(spark, n=400, seed=9):
    rnd = random.Random(seed)
    rows = [(i, int(rnd.random() < 0.3), round(rnd.random(), 2)) for i in range(n)]
    rows = [(i, y, min(1.0, s + 0.2 * y)) for i, y, s in rows]
    return rows, spark.createDataFrame(rows, "id long, y int, score double")


def f1_of(rows, tau):
    tp = sum(y and s > tau for _, y, s in rows)
    fp = sum((not y) and s > tau for _, y, s in rows)
    fn = sum(y and s <= tau for _, y, s in rows)
    return 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0


def test_threshold_scan_equals_brute_force(spark):
    rows, df = _scores(spark)
    taus = even_grid(0, 1, 101)
    scanned = ev.threshold_scan(df, taus)
    got = {r["tau_index"]: r["f1"] for r in scanned.collect()}
    want = {i: f1_of(rows, t) for i, t in enumerate(taus)}
    assert got == pytest.approx(want)
    best = ev.best_threshold(scanned).first()
    assert best["f1"] == pytest.approx(max(want.values())) and best["tau"] == taus[max(want, key=lambda i: (want[i], -i))]
    own = ev.threshold_scan(df.withColumn("g", F.lit("a")).withColumn("taus", F.array(F.lit(0.2), F.lit(0.5), F.lit(0.9))), "taus", ["g"], size=3)
    assert [r["f1"] for r in own.orderBy("tau_index").collect()] == pytest.approx([f1_of(rows, t) for t in (0.2, 0.5, 0.9)])


@pytest.mark.parametrize("options", [{}, {"chunk_rows": 7}])
def test_auc_equals_brute_force(spark, options):
    rows, df = _scores(spark)
    pos = np.array([s for _, y, s in rows if y])
    neg = np.array([s for _, y, s in rows if not y])
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert ev.roc_auc(df, **options).first()["auc"] == pytest.approx(want)
    assert ev.roc_auc(df.filter("y = 1"), **options).first()["auc"] == 0


def test_metrics_of_empty_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, pred int")
    m = ev.binary_metrics(ev.confusion(df)).first()
    assert (m["f1"], m["mcc"], m["precision"], m["specificity"], m["accuracy"]) == (0, 0, 0, 1, 1)
    report = {r["row"]: r for r in ev.class_report(ev.confusion(df)).collect()}
    assert report["1"]["f1"] == 0 and report["0"]["support"] == 2


def test_first_best_takes_the_first_of_equals(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.9), (2, 0.9)], "cell int, f1 double")
    assert ev.first_best(df, "f1", "cell").first()["cell"] == 1


def test_zone_table_against_all_pairs(spark):
    rnd = random.Random(8)
    zones = [(a + h, a, b + w, b) for a, b, h, w in ((rnd.uniform(-80, 80), rnd.uniform(-170, 170), rnd.choice([0, 0.001, 0.3, 5]), rnd.choice([0, 0.02, 1, 40])) for _ in range(3000))]
    zones += [(1.0, 2.0, 3.0, 0.0), (None, 0.0, 1.0, 0.0), zones[0], (90.0, -90.0, -179.0, -180.0)]
    corners = [(z[rnd.randrange(2)], z[2 + rnd.randrange(2)]) for z in zones[:200]]
    spots = corners + [(rnd.uniform(-85, 85), rnd.uniform(-175, 175)) for _ in range(300)] + [(None, 1.0), (0.5, None), (0.5, -179.5)]
    spots += spots[:5]
    table = spark.createDataFrame(zones, "lat_max double, lat_min double, lon_max double, lon_min double")
    points = spark.createDataFrame([(i, *s, 7) for i, s in enumerate(spots)], "i int, latitude double, longitude double, level int")
    inside = lambda s: None not in s and any(z[0] is not None and z[1] <= s[0] <= z[0] and z[3] <= s[1] <= z[2] for z in zones)
    got = zones_of.zone_labels(points, table)
    assert got.columns == ["i", "latitude", "longitude", "level", "zone"]
    assert {r["i"]: r["zone"] for r in got.collect()} == {i: 0 if inside(s) else 1 for i, s in enumerate(spots)}
    assert zones_of.zone_labels(points, table.limit(0)).where("zone = 1").count() == len(spots)


def test_zone_table_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(zones_of, "BROADCAST_RECTANGLES", 0)
    fixed = spark.createDataFrame([tuple(map(float, z)) for z in geo.ZONES], "lat_max double, lat_min double, lon_max double, lon_min double")
    points = spark.createDataFrame([(53 + i % 40 / 20, 8 + i % 113 / 10) for i in range(900)], "latitude double, longitude double")
    both = zones_of.zone_labels(points, fixed).withColumn("chain", geo.zone_label(F.col("latitude"), F.col("longitude")))
    assert both.where("zone <> chain").isEmpty() and both.where("zone = 0").count() > 0 and both.count() == 900


@pytest.mark.parametrize("growth", [16, 1])
def test_piled_rectangles_keep_lists_short(spark, monkeypatch, growth):
    monkeypatch.setattr(zones_of, "LIST", 8)
    monkeypatch.setattr(zones_of, "GROWTH", growth)
    rnd = random.Random(5)
    centre = lambda: (rnd.uniform(-1.2, 1.2), rnd.uniform(-1.2, 1.2))
    zones = [(a + h, a, b + w, b) for (a, b), h, w in ((centre(), rnd.uniform(0.05, 0.2), rnd.uniform(0.05, 0.2)) for _ in range(1500))]
    zones += [(a + 1e-5, a, b, b) for a, b in ((3.0 + rnd.random() / 500, -7.0 - rnd.random() / 500) for _ in range(300))]  # below the finest level
    zones += [(5.0 + i / 100, 5.0 + i / 100, 10.9, 10.1) for i in range(60)]  # lines cover no cell
    spots = [centre() for _ in range(1200)] + [(3.0 + rnd.random() / 500, -7.0 - rnd.random() / 500) for _ in range(200)]
    spots += [(z[rnd.randrange(2)], z[2 + rnd.randrange(2)]) for z in zones[::4]] + [(5.0 + i / 200, 10.5) for i in range(120)]
    table = spark.createDataFrame(zones + zones[:50], "lat_max double, lat_min double, lon_max double, lon_min double")
    points = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "id long, latitude double, longitude double")
    got = {r["id"]: r["zone"] for r in zones_of.zone_labels(points, table).collect()}
    assert got == {i: int(not any(z[1] <= a <= z[0] and z[3] <= b <= z[2] for z in zones)) for i, (a, b) in enumerate(spots)}
    if growth == 16:
        assert zones_of.cells(table).agg(F.max(F.size("rectangles"))).first()[0] <= 8


def test_labels_find_chunks_once(spark):
    df = spark.createDataFrame(trips([40, 3]), SCHEMA)
    spans = spark.createDataFrame([(0, 3, 9)], "trip_id long, start_pos int, end_pos int")
    files = plan.label_table(df, spans, ft.point_layout(df, chunk_rows=8)).inputFiles()
    assert files and any("/pinned-" in f for f in files) and not any("/fine-" in f for f in files)
