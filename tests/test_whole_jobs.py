"""Whole grids and whole training sets, in memory and disk that stay bounded."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from queries import models
from wakeline import schema as S
from wakeline.ml import importance, isolation, oneclass, tiles
from wakeline.plans import training
from wakeline.session import short_lived, stored

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """Two routes of Gaussian points, a few of them labelled as anomalies; one route without training rows and one row without a route."""
    names = F.element_at(F.array(*[F.lit(r) for r in ("A", "B", "C")]), F.when(F.col("id") % 50 == 7, 3).otherwise(F.col("id") % 2 + 1).cast("int"))
    part = F.when((F.col("id") % 50 == 7) | (F.col("id") % 5 == 0), "test").otherwise("train")
    columns = [F.randn(i).alias(c) for i, c in enumerate(FEATURES, 1)]
    table = spark.range(800, numPartitions=2).select(F.when(F.col("id") != 11, names).alias(S.ROUTE), F.col("id").alias("point_id"), part.alias("part"), *columns)
    return table.withColumn("y_true", (F.col("a") > 1.5).cast("int")).localCheckpoint()


def test_queries_of_whole_families_have_no_smaller_grid(spark, monkeypatch):
    assert models.GRIDS.get("isolation_forest", {}) == {}
    given = []

    def trainer(family):
        def train(table, out, **options):
            given.append((family, options))
            return None, spark.createDataFrame([("A", 0, 0.5)], f"{S.ROUTE} string, cell int, f1 double")

        return train

    monkeypatch.setattr(models, "_features", lambda spark, sf: None)
    monkeypatch.setattr(training, "training_table", lambda points: None)
    monkeypatch.setattr(training, "TRAINERS", {f: trainer(f) for f in training.TRAINERS})
    assert models.k10(spark, "").count() == 4
    assert [options for _, options in given] == [{}] * 4


def test_grown_trees_split_all_rows():
    rnd = np.random.default_rng(3)
    x = np.ascontiguousarray(np.column_stack([rnd.normal(size=300), rnd.integers(0, 2, 300), np.ones(300), rnd.normal(size=300)]).T)
    x = np.concatenate([x, x[:, :20]], axis=1)  # some rows come twice
    nodes = isolation.grown(x, 12, np.array([0, 1, 2]), np.random.default_rng(1))
    place = {n: i for i, n in enumerate(nodes["node"])}
    assert nodes["size"][0] == 320 and len(place) == len(nodes["node"]) and nodes["depth"].max() <= 12
    assert set(nodes["feature"]) <= {-1, 0, 1}
    at = np.zeros(320, dtype=int)
    for _ in range(12):
        f = nodes["feature"][at]
        upper = x[np.maximum(f, 0), np.arange(320)] > nodes["threshold"][at]
        at = np.where(f >= 0, nodes["left"][at] + upper, at)
    assert (nodes["feature"][at] < 0).all()
    found = np.bincount(at, minlength=len(nodes["node"]))
    leaf = nodes["feature"] < 0
    assert (found[leaf] == nodes["size"][leaf]).all()
    for i in np.flatnonzero(~leaf):
        left = nodes["left"][i]
        assert nodes["node"][left] == 2 * nodes["node"][i] and nodes["size"][left] + nodes["size"][left + 1] == nodes["size"][i]
        assert min(nodes["size"][left], nodes["size"][left + 1]) > 0


@pytest.mark.parametrize("small", [isolation.TASK_ROWS, 330, 100])
def test_scores_of_the_grid_are_those_of_the_forests_that_are_kept(spark, rows, small):
    """In one task a route, in several chunks (of 100 rows, where routes are also grown by jobs)."""
    cells = [isolation.Cell(4, "auto", 1.0), isolation.Cell(5, 0.5, 0.8), isolation.Cell(3, 1.0, 0.6), isolation.Cell(2, 0.75, 1.0)]
    ids = [2, 0, 1]
    known = rows.where(F.col(S.ROUTE).isNotNull())
    got = isolation.grid_scores(rows, FEATURES, cells, ids, S.POINT, small=small).collect()
    nodes = stored(isolation.grow(rows.where("part = 'train'"), FEATURES, cells, S.POINT, small=small), "nodes")
    want = isolation.raw_scores(known, nodes, FEATURES, ids).where("raw IS NOT NULL").collect()
    line = lambda r, cell, score: (r[S.ROUTE], cell, r["part"], r["y_true"], round(score, 9))
    assert sorted(line(r, r["cell"], r["score"]) for r in got) == sorted(line(r, c, s) for r in want for c, s in zip(ids, r["raw"], strict=True))
    assert {r[S.ROUTE] for r in got} == {"A", "B"}
    chosen = spark.createDataFrame([("A", 2), ("B", 1)], f"{S.ROUTE} string, cell int")
    kept = isolation.grow(rows.where("part = 'train'"), FEATURES, cells, S.POINT, small=small, chosen=chosen)
    plain = lambda df: sorted(map(str, df.collect()))
    assert plain(kept) == plain(nodes.join(chosen, [S.ROUTE, "cell"]).select(kept.columns))


def test_a_machine_is_the_optimum_of_all_training_points(monkeypatch):
    monkeypatch.setattr(oneclass, "WHOLE", 60)
    monkeypatch.setattr(oneclass, "WORKING", 40)
    x = np.random.default_rng(0).normal(size=(700, 3))
    for gamma, nu in ((0.3, 0.1), (3.0, 0.01), (0.01, 0.03)):
        kernel = np.exp(-gamma * oneclass.squared_distances(x, x))
        alpha = oneclass.solve_rows(x, gamma, nu, tolerance=1e-5)
        gradient = kernel @ alpha
        assert alpha.min() >= 0 and alpha.max() <= 1 and alpha.sum() == pytest.approx(nu * 700)
        assert gradient[alpha > 0].max() - gradient[alpha < 1].min() < 2e-5
        assert gradient == pytest.approx(kernel @ oneclass.solve(kernel, nu, 1e-6), abs=1e-3)


def test_all_training_points_are_landmarks(spark):
    many = spark.range(4500).select(F.when(F.col("id") < 2300, "A").otherwise("B").alias(S.ROUTE), F.col("id").alias("point_id"), F.rand(1).alias("a"))
    counts = {r[S.ROUTE]: (r["n"], r["top"]) for r in oneclass.landmarks(many, ["a"], "point_id").groupBy(S.ROUTE).agg(F.count("*").alias("n"), F.max("position").alias("top")).collect()}
    assert counts == {"A": (2300, 2300), "B": (2200, 2200)}


def test_widths_in_turns_give_the_same_machines(rows, monkeypatch):
    marks = oneclass.landmarks(rows.where("part = 'train'"), FEATURES, "point_id").persist()
    cells = [oneclass.Cell(nu, g) for nu in (0.03, 0.1) for g in ("scale", 0.5)]
    plain = lambda: sorted(map(tuple, oneclass.fit(marks, cells).collect()))
    once = plain()
    monkeypatch.setattr(oneclass, "COPIED", 10)
    assert plain() == once and len(once) == 8


def test_trials_in_turns_give_the_same_importance_and_leave_no_files(spark, rows, monkeypatch):
    known = rows.where(F.col(S.ROUTE).isNotNull())
    score = lambda df: df.withColumn("score", F.col("a") + 0.3 * F.col("b"))
    found = lambda: sorted(map(tuple, importance.permutation_importance(known, score, ["a", "b"], repeats=2, keys=[S.ROUTE]).collect()))
    once = found()
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    monkeypatch.setattr(importance, "TRIAL_ROWS", 1)
    assert found() == once
    assert not [n for n in os.listdir(folder) if n.startswith(("trials-", "shuffled-"))]


def test_what_is_stored_in_a_turn_goes_with_it(spark):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with short_lived(spark) as kept:
        stored(spark.range(3), "passing")
        with short_lived(spark) as inner:
            result = inner(spark.range(4), "inner")
        result = kept(result, "staying")
    assert result.count() == 4 and spark.conf.get(key, None) == before
    assert not [n for n in os.listdir(folder) if n.startswith(("passing-", "inner-"))]


def test_rows_for_python_have_no_null_arrays(spark):
    """Spark passes over all nulls of an array at every row of a batch, in time that grows with the square of its rows."""
    blank = tiles._blank(spark.createDataFrame([], "route string, x array<double>, cells array<int>, n int").schema)
    row = spark.range(1).select(blank.alias("r")).first()["r"]
    assert row["x"] == [] and row["cells"] == [] and row["n"] is None and row["route"] is None
