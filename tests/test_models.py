"""Model families on small separable sets."""

import datetime as dt

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.ml import forest, importance, isolation, logistic, oneclass, reconstruct, scaling, tiles, trees
from wakeline.operators import evaluate as ev
from wakeline.plans import scoring, training
from wakeline.sources import registry as reg

FEATURES = list(S.POINT_FEATURES)


@pytest.fixture(scope="module")
def points(spark):
    """Two routes of Gaussian points with far outliers labelled as anomalies."""
    rnd = np.random.default_rng(4)
    rows, pid = [], 0
    for route in S.SPLIT_PORTS:
        for k in range(700):
            far = k % 10 == 0
            x = rnd.normal(size=8) + (rnd.choice([-1, 1], size=8) * 6 if far else 0)
            t = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k)
            rows.append((pid // 100, pid, route, t, 54.0, 10.0, int(far), *[float(v) for v in x], 1.0))
            pid += 1
    names = ", ".join(f"{c} double" for c in FEATURES)
    return spark.createDataFrame(rows, f"trip_id long, point_id long, start_port string, time_stamp timestamp_ntz, latitude double, longitude double, y_true int, {names}").persist()


def auc(scored):
    return ev.roc_auc(scored, [S.ROUTE], "y_true").agg(F.min("auc")).first()[0]


def test_logistic_learns_a_separable_rule(spark, points, tmp_path):
    labelled = points.withColumn("y_true", (F.col("dv") + F.col("x_km") > 1).cast("int"))
    grid = [logistic.Cell(1.0, "l2", None), logistic.Cell(10.0, "l1", "balanced")]
    registry = training.train_family("logistic", labelled, str(tmp_path), grid=grid)
    assert registry.count() == 2
    scored = scoring.score_points(labelled, str(tmp_path), "logistic")
    f1 = ev.binary_metrics(ev.confusion(scored, [], "y_true", "is_anomaly_pred")).first()["f1"]
    assert f1 > 0.9 and scored.count() == points.count()
    with pytest.raises(reg.ModelNotFound):
        scoring.score_points(labelled.withColumn("start_port", F.lit("LUEBECK")), str(tmp_path), "logistic")
    with pytest.raises(reg.ModelNotFound):
        reg.find(reg.load_registry(spark, f"{tmp_path}/registry", "logistic"), "LUEBECK")
    assert reg.find(reg.load_registry(spark, f"{tmp_path}/registry", "logistic"), "KIEL").features == FEATURES


def test_a_route_without_a_class_is_skipped(points, tmp_path):
    labelled = points.withColumn("y_true", F.when(F.col("start_port") == "KIEL", F.col("y_true")).otherwise(0))
    registry = training.train_family("logistic", labelled, str(tmp_path), grid=[logistic.Cell(1.0, "l2", None)])
    assert [r["route"] for r in registry.collect()] == ["KIEL"]


def test_random_forest(points, tmp_path):
    grid = [forest.Cell(10, 5, 1, "sqrt"), forest.Cell(10, None, 5, "log2")]
    training.train_family("random_forest", points, str(tmp_path), grid=grid, folds=2)
    scored = scoring.score_points(points, str(tmp_path), "random_forest")
    assert ev.binary_metrics(ev.confusion(scored, [], "y_true", "is_anomaly_pred")).first()["f1"] > 0.9


def test_isolation_forest(points, tmp_path):
    grid = [isolation.Cell(40, "auto", 1.0), isolation.Cell(20, 0.75, 0.6)]
    entries, results = training.train_isolation(training.training_table(points), str(tmp_path), grid=grid)
    assert {e["route"] for e in entries.collect()} == set(S.SPLIT_PORTS)
    assert results.count() == 4 and results.agg(F.min("auc")).first()[0] > 0.9
    reg.save_registry(entries, f"{tmp_path}/registry")
    assert auc(scoring.score_points(points, str(tmp_path), "isolation_forest")) > 0.9


def test_isolation_samples_and_trees(points):
    cells = [isolation.Cell(7, "auto", 1.0), isolation.Cell(5, 0.5, 0.5), isolation.Cell(3, 1.0, 1.0)]
    train = points.filter("y_true = 0")
    samples = isolation.draw_samples(train, FEATURES, cells, S.POINT)
    per_tree = samples.groupBy(S.ROUTE, "cell", "tree").agg(F.count("*").alias("n"), F.count_distinct("x").alias("d"), F.max("psi").alias("psi")).collect()
    assert {(r["cell"], r["tree"]) for r in per_tree} == {(c, t) for c, n in ((0, 7), (1, 5), (2, 3)) for t in range(n)}
    assert all(r["n"] == r["d"] and abs(r["n"] - r["psi"]) < 5 * r["psi"] ** 0.5 for r in per_tree)
    assert all(r["n"] == 630 for r in per_tree if r["cell"] == 2)
    check_trees(isolation.grow(train, FEATURES, cells, S.POINT).toPandas())
    # the same with nodes split by jobs before tasks finish them
    check_trees(isolation.grow(train, FEATURES, cells, S.POINT, small=100).toPandas())


def check_trees(nodes):
    assert {(r.cell, r.tree) for r in nodes[nodes["node"] == 1].itertuples()} == {(c, t) for c, n in ((0, 7), (1, 5), (2, 3)) for t in range(n)}
    for _, tree in nodes.groupby([S.ROUTE, "cell", "tree"]):
        size = dict(zip(tree["node"], tree["size"]))
        inner = tree[tree["feature"].notna()]
        assert len(size) == len(tree) == 2 * len(inner) + 1
        assert all(size[n] == size[2 * n] + size[2 * n + 1] for n in inner["node"])
    split_on = nodes[nodes["feature"].notna()].groupby([S.ROUTE, "cell", "tree"])["feature"].nunique()
    assert split_on.xs(1, level="cell").max() <= 4  # half of the nine features per tree
    # the constant column never splits
    assert not (nodes["feature"] == FEATURES.index("route_dummy")).any()


def walk(tree, x):
    """The leaf that a row meets, by a loop; ``tree`` maps node numbers to (feature, threshold, value)."""
    node = 1
    while tree[node][0] is not None:
        node = 2 * node + (x[tree[node][0]] > tree[node][1])
    return tree[node][2]


def random_nodes(rnd, width, routes, trees, deepest):
    rows = []
    for route in routes:
        for cell, count in enumerate(trees):
            for tree in range(count):
                open_nodes = [(1, 0)]
                while open_nodes:
                    node, depth = open_nodes.pop()
                    if depth < deepest and (depth == 0 or rnd.random() < 0.8):
                        rows.append((route, cell, tree, node, int(rnd.integers(width)), float(rnd.normal()), None))
                        open_nodes += [(2 * node, depth + 1), (2 * node + 1, depth + 1)]
                    else:
                        rows.append((route, cell, tree, node, None, None, float(rnd.random())))
    return rows


def test_trees_of_any_size_give_the_same_values_in_any_blocks(spark):
    rnd = np.random.default_rng(0)
    nodes = random_nodes(rnd, 3, "AB", (3, 4), 7)
    table = spark.createDataFrame(nodes, "start_port string, cell int, tree int, node long, feature int, threshold double, value double")
    names = ["A", "B", "C", None]
    rows = [(names[i % 4], i, *map(float, rnd.normal(size=3))) for i in range(300)] + [("A", 7, 0.1, 0.2, None)] * 3
    points = spark.createDataFrame(rows, "start_port string, point_id long, a double, b double, c double")
    trees_of = {}
    for route, cell, tree, node, *rest in nodes:
        trees_of.setdefault((route, cell), {}).setdefault(tree, {})[node] = rest
    want = []
    for route, i, *x in rows:
        x = [v or 0.0 for v in x]
        means = [np.mean([walk(t, x) for t in trees_of[route, cell].values()]) for cell in (0, 1)] if route in ("A", "B") else None
        want.append((route, i, means))
    for levels, chunk_rows in ((16, 1 << 16), (2, 7), (1, 50)):
        got = trees.mean_values(points, tiles.inputs(["a", "b", "c"]), table, [0, 1], "m", levels, chunk_rows).select("start_port", "point_id", "m").collect()
        assert len(got) == len(want)
        for g, w in zip(sorted(map(tuple, got), key=str), sorted(want, key=str), strict=True):
            assert g[:2] == w[:2] and (g[2] is None) == (w[2] is None) and (w[2] is None or g[2] == pytest.approx(w[2]))
    other = trees.mean_values(points, tiles.inputs(["a", "b", "c"]), table, [9, 1], "m").where("start_port = 'A'").first()["m"]
    assert other[0] is None and other[1] is not None


def test_isolation_scores_do_not_depend_on_blocks(points):
    cells = [isolation.Cell(6, "auto", 1.0), isolation.Cell(4, 0.5, 1.0)]
    nodes = isolation.grow(points.filter("y_true = 0"), FEATURES, cells, S.POINT, small=64).persist()
    some = points.filter("point_id % 9 = 0")
    direct = {r["point_id"]: r["raw"] for r in isolation.raw_scores(some, nodes, FEATURES, [0, 1]).collect()}
    blocks = {r["point_id"]: r["raw"] for r in isolation.raw_scores(some, nodes, FEATURES, [0, 1], levels=3, chunk_rows=11).collect()}
    assert direct.keys() == blocks.keys() and all(0 < v < 1 for raw in direct.values() for v in raw)
    assert all(blocks[k] == pytest.approx(direct[k]) for k in direct)


def test_forest_nodes_score_as_the_fitted_models(spark, points, tmp_path):
    labelled = points.withColumn("y_true", (F.col("dv") * F.col("x_km") + F.col("ddraft") > 0.3).cast("int"))
    models = {}
    for i, route in enumerate(S.SPLIT_PORTS):
        vectors = forest._vectors(labelled.where(F.col(S.ROUTE) == route), FEATURES, "y_true", S.POINT)
        models[route] = forest._fit(vectors, forest.Cell(7, (None, 4)[i], 3, "sqrt"), 5)
        models[route].write().save(f"{tmp_path}/{i}")
    names = spark.createDataFrame([(str(i), r) for i, r in enumerate(S.SPLIT_PORTS)], "position string, start_port string")
    nodes = forest.node_table(spark, str(tmp_path)).join(names, "position").persist()
    assert nodes.where("node = 1").count() == 14 and nodes.where("feature IS NULL AND value IS NULL").isEmpty()
    got = {r["point_id"]: r["score"] for r in forest.score(labelled, nodes, FEATURES, levels=2, chunk_rows=100).collect()}
    assert len(got) == points.count()
    for route, model in models.items():
        for r in forest._scored(model, forest._vectors(labelled.where(F.col(S.ROUTE) == route), FEATURES, "y_true", S.POINT), S.POINT).collect():
            assert got[r[S.POINT]] == pytest.approx(r["score"])


def test_one_class_machine(points, tmp_path):
    grid = [oneclass.Cell(0.03, g) for g in ("scale", "auto", 0.01, 0.1, 1.0)]
    entries, results = training.train_one_class(training.training_table(points), str(tmp_path), grid=grid, marks_per_route=300)
    assert results.count() == 10 and results.agg(F.min("auc")).first()[0] > 0.9
    reg.save_registry(entries, f"{tmp_path}/registry")
    assert auc(scoring.score_points(points, str(tmp_path), "one_class_svm")) > 0.9


def test_one_class_weights_are_feasible_and_optimal():
    x = np.random.default_rng(0).normal(size=(120, 3))
    kernel = np.exp(-0.3 * oneclass.squared_distances(x, x))
    alpha = oneclass.solve(kernel, 0.1, tolerance=1e-6)
    assert alpha.min() >= 0 and alpha.max() <= 1 and alpha.sum() == pytest.approx(12)
    gradient = kernel @ alpha
    assert gradient[alpha > 1e-9].max() - gradient[alpha < 1 - 1e-9].min() < 1e-5


def test_one_class_densities_in_tiles(points, monkeypatch):
    train = points.filter("y_true = 0")
    marks = oneclass.landmarks(train, FEATURES, S.POINT, count=40).persist()
    assert {r["n"] for r in marks.groupBy(S.ROUTE).agg(F.count("*").alias("n")).collect()} == {40}
    cells = [oneclass.Cell(0.1, 0.1), oneclass.Cell(0.2, "auto"), oneclass.Cell(0.3, 0.1)]
    models = oneclass.fit(marks, cells).persist()
    some = points.filter("point_id % 20 = 0")
    x_of = {r: np.array([m["x"] for m in sorted(marks.where(F.col(S.ROUTE) == r).collect(), key=lambda m: m["position"])]) for r in S.SPLIT_PORTS}
    model_of = {(m[S.ROUTE], m["cell"]): m for m in models.collect()}
    for options in ({}, {"chunk_rows": 5}):
        got = oneclass.densities(some, marks, models, FEATURES, [2, 0, 1], **options).collect()
        assert len(got) == some.count()
        for r in got:
            d = oneclass.squared_distances(np.array([[r[c] for c in FEATURES]]), x_of[r[S.ROUTE]])[0]
            want = [np.exp(-model_of[r[S.ROUTE], c]["gamma"] * d) @ model_of[r[S.ROUTE], c]["alpha"] for c in (2, 0, 1)]
            assert r["density"] == pytest.approx(want)
    sums = oneclass.KernelSums(np.zeros((3, 2)), 2)
    monkeypatch.setattr(oneclass, "TILE", 2)
    sums.add(pa.array([{"x": [0.0, float(i)], "weights": [1.0, 0.0], "gammas": [1.0, float("nan")]} for i in range(5)]))
    assert sums.result()[:, 0] == pytest.approx([sum(np.exp(-(i**2)) for i in range(5))] * 3) and np.isnan(sums.result()[:, 1]).all()


def test_a_step_without_effect_ends_the_search_for_weights():
    kernel = np.full((40, 40), 1e17) + np.diag(np.linspace(0, 1e3, 40))
    assert np.isfinite(oneclass.solve(kernel, 0.3)).all()


def test_logistic_fits_agree_with_spark_ml(points):
    """All routes and cells at once against one fit of the library for each."""
    labelled = points.withColumn("y_true", (F.col("dv") + F.col("x_km") * F.col("y_km") > 0.5).cast("int"))
    grid = [logistic.Cell(c, p, w) for c, p, w in ((0.01, "l1", None), (1.0, "l1", "balanced"), (0.1, "l2", 3.0), (10.0, "l2", None))]
    got = {(r[S.ROUTE], r["cell"]): r for r in logistic.fit(labelled, FEATURES, grid).collect()}
    assert len(got) == 8
    for route in S.SPLIT_PORTS:
        rows = labelled.where(F.col(S.ROUTE) == route)
        stats = scaling.moments(rows, FEATURES, []).first()
        one, n = rows.where("y_true = 1").count(), rows.count()
        scaled = [((F.col(c) - stats[f"{c}_mean"]) / stats[f"{c}_std"]).alias(c) for c in FEATURES]
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="x").transform(rows.select(*scaled, F.col("y_true").cast("double").alias("y"))).persist()
        for i, cell in enumerate(grid):
            c0, c1 = (n / (2 * (n - one)), n / (2 * one)) if cell.anomaly_weight == "balanced" else (1.0, float(cell.anomaly_weight or 1))
            model = LogisticRegression(
                featuresCol="x", labelCol="y", weightCol="w", regParam=1 / (cell.strength * (c0 * (n - one) + c1 * one)), tol=1e-10, maxIter=500,
                elasticNetParam=float(cell.penalty == "l1"), standardization=False,
            ).fit(vectors.withColumn("w", F.when(F.col("y") == 1, c1).otherwise(c0)))
            mine = np.array(got[route, i]["coefficients"]) * [stats[f"{c}_std"] for c in FEATURES]
            shift = sum(w * stats[f"{c}_mean"] for w, c in zip(got[route, i]["coefficients"], FEATURES, strict=True))
            assert mine == pytest.approx(model.coefficients.toArray(), abs=1e-3) and got[route, i]["intercept"] + shift == pytest.approx(model.intercept, abs=1e-3)


def test_logistic_needs_few_passes_where_a_plane_nearly_parts_the_classes(spark, monkeypatch):
    monkeypatch.setattr(logistic, "START_BLOCKS", 1)  # a part of the rows to start from
    columns = [F.randn(i).alias(c) for i, c in enumerate("abc", 1)]
    drawn = spark.range(24_000, numPartitions=4).select(F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias(S.ROUTE), *columns, F.rand(9).alias("u"))
    rows = drawn.withColumn("y_true", (F.col("a") + 0.5 * F.col("b") + 0.1 * F.col("u") > 1.5).cast("int")).persist()
    grid = [logistic.Cell(0.1, "l2", None), logistic.Cell(10.0, "l2", 3.0), logistic.Cell(1.0, "l1", None)]
    fitted = logistic.fit(rows, list("abc"), grid, max_iter=8).collect()
    assert len(fitted) == 6
    table = rows.toPandas()
    for model in fitted:
        own, cell = table[table[S.ROUTE] == model[S.ROUTE]], grid[model["cell"]]
        x, y, std = own[list("abc")].to_numpy(), own["y_true"].to_numpy(), own[list("abc")].to_numpy().std(axis=0)
        w = np.array(model["coefficients"])
        off = np.where(y == 1, cell.anomaly_weight or 1.0, 1.0) * (1 / (1 + np.exp(-(x @ w + model["intercept"]))) - y)
        slope = off @ ((x - x.mean(axis=0)) / std)
        pull = np.where(w == 0, -np.clip(slope, -1, 1), np.sign(w)) if cell.penalty == "l1" else w * std
        assert slope + pull / cell.strength == pytest.approx(0, abs=1e-3) and off.sum() == pytest.approx(0, abs=1e-3)  # the slope at the least loss


def test_rows_go_down_a_tree_in_blocks():
    rnd = np.random.default_rng(7)
    x = rnd.normal(size=(2 * trees.BLOCK + 3, 4))
    x[0, 1], x[1, 2], x[2, 0] = np.nan, np.inf, -np.inf
    nodes, table, open_nodes = [], {}, [1]
    while open_nodes:
        node = open_nodes.pop()
        inner = node < 4 or (node < 64 and rnd.random() < 0.7)
        table[node] = (int(rnd.integers(4)), float(rnd.normal()), 0.0) if inner else (None, 0.0, float(rnd.random()))
        open_nodes += [2 * node, 2 * node + 1] if inner else []
    for levels in (16, 2):
        tiers = {n: (n.bit_length() - 1) // levels for n in table}
        nodes = [{"cell": 0, "tree": 0, "tier": t, "top": n >> (n.bit_length() - 1 - t * levels), "node": n, "feature": table[n][0], "threshold": table[n][1], "value": table[n][2]} for n, t in tiers.items()]
        nodes.sort(key=lambda r: (r["tier"], r["top"], r["node"]))
        walker = trees.TreeWalk(x, [0])
        walker.add(pa.array(nodes))
        assert walker.result()[:, 0].tolist() == [walk(table, row) for row in x]


def test_a_chunk_of_windows_holds_few_numbers(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(tiles, "score", lambda rows, x, models, scorer, order, out, chunk_rows=tiles.CHUNK_ROWS: sizes.append(chunk_rows) or rows.withColumn(out, F.array(F.lit(0.0))))
    windows = spark.createDataFrame([("A", [[1.0]])], "start_port string, features array<array<double>>")
    models = spark.createDataFrame([("A", [0.0], [[1.0]])], reconstruct.DIRECTIONS_SCHEMA)
    reconstruct.window_errors(windows, models)
    assert sizes[0] * 15 <= 2 * tiles.CHUNK_ROWS


def test_main_directions_of_all_routes(spark):
    rnd = np.random.default_rng(2)
    windows = {r: rnd.normal(size=(n, 4, 2)) * [1.0, 3.0] + k for k, (r, n) in enumerate((("A", 50), ("B", 7), ("C", 1)))}
    df = spark.createDataFrame([(r, i, w.tolist()) for r, all_ in windows.items() for i, w in enumerate(all_)], "start_port string, i int, features array<array<double>>")
    models = reconstruct.fit(df.repartition(5), code=3).persist()
    got = {m[S.ROUTE]: m for m in models.collect()}
    for route, all_ in windows.items():
        flat = all_.reshape(len(all_), -1)
        assert got[route]["mean"] == pytest.approx(flat.mean(axis=0))
        if len(flat) > 1:
            _, _, directions = np.linalg.svd(flat - flat.mean(axis=0))
            components = np.array(got[route]["components"])
            assert components.shape == (3, 8) and components.T @ components == pytest.approx(directions[:3].T @ directions[:3], abs=1e-6)
    assert got["C"]["components"] == []
    for options in ({}, {"chunk_rows": 4}):
        for r in reconstruct.window_errors(df, models, **options).collect():
            x = np.array(r["features"]).ravel() - got[r[S.ROUTE]]["mean"]
            components = np.array(got[r[S.ROUTE]]["components"]).reshape(-1, 8)
            assert r["error"] == pytest.approx(((x - x @ components.T @ components) ** 2).max())


def test_reconstruction_finds_strange_windows(spark, tmp_path):
    rnd = np.random.default_rng(1)
    rows, pid = [], 0
    for trip in range(60):
        strange = trip % 6 == 0
        phase = rnd.random() * 6
        for k in range(50):
            a = np.sin(phase + k / 4) + (rnd.normal() * 2 if strange else rnd.normal() * 0.05)
            b = np.cos(phase + k / 4) + rnd.normal() * 0.05
            rows.append((trip, pid, "KIEL", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=k), float(a), float(b), int(strange)))
            pid += 1
    df = spark.createDataFrame(rows, "trip_id long, point_id long, start_port string, time_stamp timestamp_ntz, a double, b double, y_true int")
    entries, errors = training.train_reconstruction(df, str(tmp_path), {"KIEL": ("a", "b")}, code=8)
    assert ev.roc_auc(errors, [], "label", "error").first()["auc"] > 0.9
    reg.save_registry(entries, f"{tmp_path}/registry")
    scored = scoring.score_points(df, str(tmp_path), "reconstruction")
    assert scored.count() == len(rows) and auc(scored.filter("score > 0")) > 0.9


def test_scaling_keeps_constant_columns(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("a", 3.0, 5.0)], "start_port string, x double, c double")
    out = scaling.standardise(df, scaling.moments(df, ["x", "c"]), ["x", "c"]).orderBy("x").collect()
    assert [(r["x"], r["c"]) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]


def test_permutation_importance_finds_the_used_feature(points):
    rows = points.filter("start_port = 'KIEL'").withColumn("y_true", (F.col("dv") > 0).cast("int"))
    out = importance.permutation_importance(rows, lambda df: df.withColumn("score", F.col("dv")), ["dv", "x_km"], repeats=2)
    got = {r["feature"]: r["importance"] for r in out.collect()}
    assert got["dv"] > 0.3 and got["x_km"] == pytest.approx(0.0)


def test_shuffled_trials_are_written_once_and_not_broadcast(spark, monkeypatch):
    rows = spark.range(60).selectExpr("id AS point_id", "'A' AS start_port", "cast(id % 2 AS int) AS y_true", "cast(id % 2 AS double) AS a", "cast(id % 7 AS double) AS b")
    plans, given, keep = [], [], importance.stored
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(importance, "stored", lambda df, label: (plans.append(plan(df)), keep(df, label))[1])

    def score(df):
        given.append(plan(df))
        return df.withColumn("score", F.col("a"))

    got = importance.permutation_importance(rows, score, ["a", "b"], repeats=3, keys=["start_port"])
    assert {r["feature"]: round(r["importance"], 6) for r in got.collect()}["b"] == 0.0
    assert "Join" not in given[0] and "Window" not in given[0]
    assert "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
