"""Training one model family for every route, and scoring trips with what was trained."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.ml import forest, importance, isolation, logistic, oneclass, reconstruct, scaling
from wakeline.operators import evaluate as ev
from wakeline.operators import split, trips
from wakeline.operators.features import point_layout
from wakeline.operators.layout import Layout, join_group_values
from wakeline.operators.scan import group_percentiles
from wakeline.session import scratch_path, short_lived, stored
from wakeline.plans import features as features_plan
from wakeline.sources import registry as reg
from wakeline.sources import versions

# Held-out shares per family, and how many routes are fitted at the same time.
TEST_SHARE = {"logistic": 0.1, "random_forest": 0.1, "isolation_forest": 0.125, "one_class_svm": 0.1}
ROUTES_AT_ONCE = 2
# Scores of grid cells, one for each row and cell, whose percentiles and ranks are found at once: about a gigabyte of shuffled rows.
SCORES_AT_ONCE = 16_000_000


def training_table(points: DataFrame, features: Sequence[str] = S.POINT_FEATURES) -> DataFrame:
    """Route, key, target and model inputs of all points, stored once for all fits of a run."""
    return stored(trips.feature_matrix(points, features, keep=[S.ROUTE, S.POINT, "y_true"]), "training")


def class_sizes(table: DataFrame) -> dict[str, tuple[int, int]]:
    """Labelled normals and anomalies per route: two numbers for each model that the driver is about to fit."""
    counts = table.groupBy(S.ROUTE).agg(F.count_if(F.col("y_true") == 0).alias("normal"), F.count_if(F.col("y_true") == 1).alias("anomaly"))
    rows = counts.filter(F.col(S.ROUTE).isNotNull()).orderBy(S.ROUTE).toLocalIterator()
    return {r[S.ROUTE]: (r["normal"], r["anomaly"]) for r in rows}


def supervised_split(table: DataFrame, family: str) -> DataFrame:
    """Labelled rows, dealt into training and test rows; a folder for each route, so that its fits read nothing else."""
    labelled = table.filter("y_true IS NOT NULL")
    return stored(split.holdout(labelled, [S.ROUTE, "y_true"], TEST_SHARE[family], S.POINT), "split", by=S.ROUTE)


def _per_route(parts: DataFrame, fit) -> dict:
    """``fit(route, train, test)`` for every route with both classes, a few routes at a time."""
    routes = [r for r, (normal, anomaly) in class_sizes(parts.filter("NOT is_test")).items() if normal and anomaly]

    def run(route: str):
        rows = parts.filter(F.col(S.ROUTE) == route)
        return fit(route, rows.filter("NOT is_test"), rows.filter("is_test"))

    with ThreadPoolExecutor(ROUTES_AT_ONCE) as pool:
        return dict(zip(routes, pool.map(run, routes)))


def _both_classes(train: DataFrame) -> DataFrame:
    """The routes whose rows have both classes; others are not trained."""
    sizes = train.groupBy(S.ROUTE).agg(F.count_if(F.col("y_true") == 0).alias("n0"), F.count_if(F.col("y_true") == 1).alias("n1"))
    return sizes.where("n0 > 0 AND n1 > 0").select(S.ROUTE)


def train_logistic(table: DataFrame, out: str, features: Sequence[str] = S.POINT_FEATURES, grid=None, **options) -> tuple[DataFrame, DataFrame]:
    """All routes and cells at once; the best cell and threshold by F1 on the test rows. A route without both classes is skipped."""
    parts = supervised_split(table, "logistic")
    train = parts.filter("NOT is_test").join(_both_classes(parts.filter("NOT is_test")), S.ROUTE, "left_semi")
    models = stored(logistic.fit(train, features, list(grid or logistic.full_grid()), **options), "models")
    results = stored(logistic.grid_results(parts.filter("is_test"), models, features), "results")
    best = stored(ev.first_best(results, "f1", "cell", [S.ROUTE]), "best")
    versions.upsert(models.join(best.select(S.ROUTE, "cell"), [S.ROUTE, "cell"]).drop("cell"), f"{out}/logistic", [S.ROUTE])
    return reg.entries(best, "logistic", f"{out}/logistic", features), results


def train_random_forest(table: DataFrame, out: str, features: Sequence[str] = S.POINT_FEATURES, grid=None, **options) -> tuple[DataFrame, DataFrame]:
    """Forests are fitted route by route; all their nodes make one table, by which all routes are scored at once."""
    spark = table.sparkSession
    fitted = _per_route(
        supervised_split(table, "random_forest"),
        lambda route, train, test: forest.fit_route(train, test, features, S.POINT, grid, **options),
    )
    fits = scratch_path(spark, "fits")
    rows, results = [], []
    for position, (route, (model, tau, _, _, cells)) in enumerate(fitted.items()):
        model.write().save(f"{fits}/{position}")
        rows.append((str(position), route, float(tau)))
        results += [(route, i, float(f1)) for i, (_, f1) in enumerate(cells)]
    best = spark.createDataFrame(rows, f"position string, {S.ROUTE} string, tau double")  # one row for each forest that was fitted here
    if rows:
        nodes = forest.node_table(spark, fits).join(best.select("position", S.ROUTE), "position").drop("position")
        versions.upsert(nodes, f"{out}/random_forest", [S.ROUTE])
    return reg.entries(best, "random_forest", f"{out}/random_forest", features), spark.createDataFrame(results, f"{S.ROUTE} string, cell int, f1 double")


def _one_class_parts(table: DataFrame, family: str, features: Sequence[str], centre: bool) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, scaled by the training rows of their route; and the scaling."""
    parts = stored(split.one_class_holdout(table, S.ROUTE, "y_true", TEST_SHARE[family], S.POINT), "parts")
    stats = stored(scaling.moments(parts.filter("part = 'train'"), features), "moments")
    return stored(scaling.standardise(parts, stats, features, centre=centre), "scaled"), stats


def _by_cell(df: DataFrame, values: str, cells: Sequence[int]) -> DataFrame:
    """An array with one score for each of ``cells`` to (cell, score) rows."""
    each = F.array(*[F.struct(F.lit(c).alias("cell"), F.col(values)[i].alias("score")) for i, c in enumerate(cells)])
    return df.select(S.ROUTE, "y_true", F.inline(each)).filter("score IS NOT NULL")


def _in_turns(rows: DataFrame, cells: Sequence, work) -> DataFrame:
    """``work(cells)`` for as many cells at a time as SCORES_AT_ONCE allows; what a turn leaves on the disk goes but for its result."""
    turn = max(1, SCORES_AT_ONCE // max(1, rows.count()))
    parts = []
    for i in range(0, len(cells), turn):
        with short_lived(rows.sparkSession) as kept:
            parts.append(kept(work(cells[i : i + turn]), "results"))
    return reduce(DataFrame.unionAll, parts)


def train_isolation(
    table: DataFrame, out: str, features: Sequence[str] = S.POINT_FEATURES, grid: Sequence[isolation.Cell] | None = None, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """All routes and cells: forests are grown and score all rows, and metrics are found, for some cells at a time. The best cell's forest is grown again to be kept."""
    cells = list(grid or isolation.full_grid())
    scaled, stats = _one_class_parts(table, "isolation_forest", features, centre=False)
    keys = [S.ROUTE, "cell"]

    def results_of(ids: Sequence[int]) -> DataFrame:
        scored = stored(isolation.grid_scores(scaled, features, cells, ids, S.POINT, seed), "raw")
        # Raw scores are shifted so that the contaminated share of the training points lies above 0.
        offsets = stored(_offsets(scored.filter("part = 'train'"), keys), "offsets")
        tested = join_group_values(scored.filter("part = 'test'").drop("part"), offsets, keys).withColumn("score", F.col("score") - F.col("offset"))
        return _one_tau_results(tested, offsets, keys)

    results = _in_turns(scaled, range(len(cells)), results_of)
    best = stored(ev.first_best(results, "f1", "cell", [S.ROUTE]), "best")
    nodes = isolation.grow(scaled.filter("part = 'train'"), features, cells, S.POINT, seed, chosen=best.select(*keys))
    kept = nodes.join(best.select(*keys, "offset"), keys)  # one row per route; Spark broadcasts it if it is small
    versions.upsert(kept.withColumn("cell", F.lit(0)), f"{out}/isolation_forest", [S.ROUTE])
    versions.upsert(stats, f"{out}/isolation_forest_scale", [S.ROUTE])
    return reg.entries(best, "isolation_forest", f"{out}/isolation_forest", features), results


def _offsets(train: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per route and cell: the raw score that the contaminated share exceeds, and tau above it."""
    shares = sorted({*isolation.CONTAMINATION.values(), isolation.CONTAMINATION_ELSE})
    names = [f"_at{i}" for i in range(len(shares))]
    points = group_percentiles(train, keys, "score", [*(1 - s for s in shares), isolation.TAU_PERCENTILE / 100], [*names, "_tau"])
    share = isolation.contamination(F.col(S.ROUTE))
    offset = F.coalesce(*[F.when(share == s, F.col(n)) for s, n in zip(shares, names)])
    return points.select(*keys, offset.alias("offset"), (F.col("_tau") - offset).alias("tau"))


def _one_tau_results(tested: DataFrame, taus: DataFrame, keys: Sequence[str]) -> DataFrame:
    flagged = tested.withColumn("pred", (F.col("score") > F.col("tau")).cast("int"))
    metrics = ev.binary_metrics(ev.confusion(flagged, keys, "y_true", "pred"))
    auc = ev.roc_auc(tested, keys, "y_true")
    return metrics.join(auc, list(keys)).join(taus, list(keys))


def train_one_class(
    table: DataFrame, out: str, features: Sequence[str] = S.POINT_FEATURES, grid: Sequence[oneclass.Cell] | None = None, marks_per_route: int | None = None,
    importance_repeats: int = importance.REPEATS,
) -> tuple[DataFrame, DataFrame]:
    """All routes and cells, on all training points (``marks_per_route``: on that many); the threshold is the best of the percentile grid by F1. The
    chosen machines' permutation importance on the test rows is stored with them (0 repeats: not)."""
    cells = list(grid or oneclass.full_grid())
    scaled, stats = _one_class_parts(table, "one_class_svm", features, centre=True)
    train_rows = scaled.filter("part = 'train'")
    marks = oneclass.train_landmarks(train_rows, features, S.POINT, count=marks_per_route)
    models = stored(oneclass.fit(marks, cells), "models")
    keys = [S.ROUTE, "cell"]

    def results_of(ids: Sequence[int]) -> DataFrame:
        dense = oneclass.densities(scaled, marks, models, features, ids).select(S.ROUTE, "part", "y_true", "density")
        return _one_class_results(stored(dense, "density"), ids, cells, keys)

    results = _in_turns(scaled, range(len(cells)), results_of)
    best = stored(ev.first_best(results, "f1", "cell", [S.ROUTE]), "best")
    chosen = stored(models.join(best.select(*keys, "rho"), keys), "chosen")
    weighted = chosen.select(S.ROUTE, F.posexplode("alpha").alias("_i", "_weight")).where("_weight != 0")
    kept = stored(marks.join(weighted.select(S.ROUTE, (F.col("_i") + 1).alias("position")), [S.ROUTE, "position"], "left_semi"), "marks")
    versions.upsert(chosen, f"{out}/one_class_svm", [S.ROUTE])
    versions.upsert(kept, f"{out}/one_class_svm_landmarks", [S.ROUTE])
    versions.upsert(stats, f"{out}/one_class_svm_scale", [S.ROUTE])
    if importance_repeats:
        drops = _one_class_importance(scaled.filter("part = 'test'"), kept, chosen.withColumn("cell", F.lit(0)), features, importance_repeats)
        versions.upsert(drops, f"{out}/one_class_svm_importance", [S.ROUTE])
    return reg.entries(best, "one_class_svm", f"{out}/one_class_svm", features), results


def _one_class_results(scored: DataFrame, ids: Sequence[int], cells: Sequence[oneclass.Cell], keys: Sequence[str]) -> DataFrame:
    each = {part: _by_cell(scored.filter(F.col("part") == part), "density", ids) for part in ("train", "test")}
    rho = _rho(each["train"], keys, cells)
    # score = rho - density falls with density, so its percentiles are mirrored density percentiles.
    names = [f"_p{i}" for i in range(len(oneclass.TAU_PERCENTS))]
    points = group_percentiles(each["train"], keys, "score", [1 - p / 100 for p in oneclass.TAU_PERCENTS], names)
    grids = points.join(rho, keys).select(*keys, F.array(*[F.col("rho") - F.col(n) for n in names]).alias("taus"))
    test = join_group_values(each["test"], rho.join(grids, keys), keys).withColumn("score", F.col("rho") - F.col("score"))
    swept = ev.threshold_scan(test, "taus", keys, "y_true", size=len(names))
    return ev.best_threshold(swept, keys).join(ev.roc_auc(test, keys, "y_true"), keys).join(rho, keys)


def _one_class_importance(test: DataFrame, marks: DataFrame, chosen: DataFrame, features: Sequence[str], repeats: int) -> DataFrame:
    """``feature, importance`` per route: the drop of F1 when a feature is shuffled among the route's test rows."""

    def score(rows: DataFrame) -> DataFrame:
        dense = oneclass.densities(rows, marks, chosen, features, [0])
        offsets = chosen.select(S.ROUTE, F.col("rho").alias("_rho"))
        return join_group_values(dense, offsets, [S.ROUTE], source=rows).withColumn("score", F.col("_rho") - F.col("density")[0]).drop("_rho", "density")

    return importance.permutation_importance(test, score, list(features), row_key=S.POINT, repeats=repeats, keys=[S.ROUTE])


def _rho(train: DataFrame, keys: Sequence[str], cells: Sequence[oneclass.Cell]) -> DataFrame:
    """Offset per route and cell: the share nu of the training points lies outside."""
    nus = sorted({c.nu for c in cells})
    names = [f"_nu{i}" for i in range(len(nus))]
    points = group_percentiles(train, keys, "score", nus, names)
    pick = F.coalesce(*[F.when(F.col("cell") == i, F.col(names[nus.index(c.nu)])) for i, c in enumerate(cells)])
    return points.select(*keys, pick.alias("rho"))


def train_reconstruction(
    points: DataFrame, out: str, features: dict[str, Sequence[str]] = S.SEQUENCE_FEATURES, default: Sequence[str] = S.POINT_FEATURES, **options
) -> tuple[DataFrame, DataFrame]:
    """One model per route of ``points``: with the route's own features where ``features`` names them, else with ``default``. Also the test window errors.

    A route without a normal window to train on, or without one to set the threshold by, has no model.
    """
    sets = [(trips.select_route(points, route), columns) for route, columns in features.items()]
    others = points.filter(F.col(S.ROUTE).isNotNull() & ~F.col(S.ROUTE).isin(list(features)))
    if not others.isEmpty():
        sets.append((others, default))
    rows, all_errors, models = [], [], []
    for part, columns in sets:
        table, errors = reconstruct.train(part, columns, **options)
        table = stored(table.filter("tau IS NOT NULL"), "models")
        models.append(table)
        all_errors.append(errors.select(S.ROUTE, S.TRIP, "start_pos", "label", "error"))
        rows.append(reg.entries(table, "reconstruction", f"{out}/reconstruction", columns))
    versions.upsert(reduce(DataFrame.unionAll, models), f"{out}/reconstruction", [S.ROUTE])
    return reduce(DataFrame.unionAll, rows), reduce(DataFrame.unionAll, all_errors)


TRAINERS = {
    "logistic": train_logistic,
    "random_forest": train_random_forest,
    "isolation_forest": train_isolation,
    "one_class_svm": train_one_class,
    "reconstruction": train_reconstruction,
}


def save_routes(cleaned: DataFrame, out: str, layout: Layout | None = None) -> DataFrame:
    """Route centres and average paths, stored with the models: the same ones place points in
    training and in scoring, and scoring need not read the whole table for them."""
    return versions.commit(features_plan.route_statistics(cleaned, layout), f"{out}/routes")


def train_from_cleaned(family: str, cleaned: DataFrame, out: str, excluded: Sequence = (), **options) -> DataFrame:
    """Labelled cleaned points to registered models: route statistics, features, training."""
    prepared = features_plan.prepare(cleaned, excluded)
    layout = point_layout(prepared)
    routes = save_routes(prepared, out, layout)
    points = stored(features_plan.feature_points(prepared, routes, layout), "features")
    return train_family(family, points, out, **options)


def train_family(family: str, points: DataFrame, out: str, **options) -> DataFrame:
    """Train one family for every route and register the models; those of other routes and families stay. ``points`` carry all features."""
    source = points if family == "reconstruction" else training_table(points)
    return reg.save_registry(stored(TRAINERS[family](source, out, **options)[0], "registered"), f"{out}/registry")
