"""Logistic regressions of all routes and grid cells, fitted in the same jobs.

A pass over the rows gives, for every route and cell, the loss, its gradient and its Hessian at one point; a task then takes a Newton
step there (for l1, the proximal one: coordinate descent on the quadratic model). A step that gains too little is damped in the next pass. The
searches begin where tasks find the optimum of some blocks of the route, so that few passes over all rows are left, also for classes that a plane
nearly parts. The number of jobs is that of the longest search, and does not grow with routes or cells.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.functions.scalar import even_grid
from wakeline.ml import tiles
from wakeline.ml.scaling import moments, standardise
from wakeline.operators import evaluate as ev
from wakeline.operators.layout import join_group_values
from wakeline.session import stored

# Regularisation strengths, penalties, weights of the anomaly class, thresholds, most steps of the solver.
STRENGTHS = (0.01, 0.1, 1.0, 10.0)
PENALTIES = ("l2", "l1")
CLASS_WEIGHTS = (None, 2.0, 3.0, 4.0, 5.0, "balanced")
TAUS = even_grid(0.0, 1.0, 101)
ITERATIONS = 100
TOLERANCE = 1e-9
"""Share of the loss that a step must promise to be looked at."""
START_BLOCKS = 32
"""Blocks of a route, some 130,000 rows and 12 MB, that the searches' first points are found on."""

MODEL_SCHEMA = f"{S.ROUTE} string, coefficients array<double>, intercept double"
_STATE = f"{S.ROUTE} string, cell int, c0 double, c1 double, penalty double, l1 boolean, w array<double>, d array<double>, damp double, base array<double>, value double, promise double, done boolean"


@dataclass(frozen=True)
class Cell:
    strength: float
    penalty: str
    anomaly_weight: float | str | None


def full_grid() -> list[Cell]:
    return [Cell(c, p, w) for c, p, w in product(STRENGTHS, PENALTIES, CLASS_WEIGHTS)]


@dataclass(frozen=True)
class Linear:
    """Coefficients on raw features; the scaling is folded in."""

    coefficients: tuple[float, ...]
    intercept: float


# ---------------------------------------------------------------- one pass over the rows


def _sums(x: np.ndarray, y: np.ndarray, cells: list[dict]) -> np.ndarray:
    """A line for each cell: loss, gradient and upper half of the Hessian of its weighted loss at its point."""
    z = np.column_stack([x, np.ones(len(x))])
    margin = z @ np.array([c["at"] for c in cells]).T
    weight = np.where(y[:, None] > 0, [c["c1"] for c in cells], [c["c0"] for c in cells])
    p = 0.5 * (1 + np.tanh(0.5 * margin))
    i, j = np.triu_indices(z.shape[1])
    loss = (weight * (np.logaddexp(0, margin) - y[:, None] * margin)).sum(axis=0)
    return np.column_stack([loss, (weight * (p - y[:, None])).T @ z, (weight * p * (1 - p)).T @ (z[:, i] * z[:, j])])


def _pass(blocks: DataFrame, search: DataFrame) -> DataFrame:
    """``sums`` per route and cell of ``search`` at the point it asks for."""
    at = F.zip_with("w", "d", lambda w, d: w + d)
    asked = search.groupBy(S.ROUTE).agg(F.collect_list(F.struct("cell", "c0", "c1", at.alias("at"))).alias("_cells"))  # the grid's cells, no more

    def run(batches):
        sums: dict = {}
        for batch in batches:
            for route, x, y, cells in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                y = np.frombuffer(y)
                found = _sums(np.frombuffer(x).reshape(len(y), -1), y, cells)
                for c, line in zip(cells, found, strict=True):
                    key = (route, c["cell"])
                    sums[key] = sums[key] + line if key in sums else line
                if len(sums) > 50_000:
                    yield _lines(sums)
                    sums = {}
        yield _lines(sums)

    parts = blocks.join(asked, S.ROUTE).select(S.ROUTE, "x", "y", "_cells").mapInArrow(run, f"{S.ROUTE} string, cell int, line array<double>")
    return tiles.sum_arrays(parts, [S.ROUTE, "cell"], "line")


def _lines(sums: dict) -> pa.RecordBatch:
    routes, cells = zip(*sums, strict=True) if sums else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(routes, pa.string()), pa.array(cells, pa.int32()), pa.array(list(sums.values()), pa.list_(pa.float64()))], [S.ROUTE, "cell", "line"])


# ---------------------------------------------------------------- one step of every search


def _direction(w: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, penalty: float, l1: bool) -> tuple[np.ndarray, float]:
    """The Newton step, and the change of the objective that its first order promises (not above 0). The last weight, the intercept, is free."""
    bound = np.r_[np.full(len(w) - 1, penalty), 0.0]
    if not l1:
        slope = gradient + bound * w
        step = -np.linalg.lstsq(hessian + np.diag(bound), slope, rcond=None)[0]
        return step, float(slope @ step)
    step = _lasso(hessian, gradient - hessian @ w, bound, w) - w
    return step, float(gradient @ step + bound @ (abs(w + step) - abs(w)))


def _lasso(h: np.ndarray, q: np.ndarray, bound: np.ndarray, u: np.ndarray) -> np.ndarray:
    """The ``u`` of least ``u h u / 2 + q u + bound |u|``, by the feature-sign search (Lee et al. 2007): the signs of a few weights are settled, the rest is a linear system."""
    u, free = u.copy(), bound == 0
    sign, active = np.sign(u), (u != 0) | free
    for _ in range(50 * len(u)):
        a = np.flatnonzero(active)
        there = np.linalg.lstsq(h[np.ix_(a, a)], -(q + bound * sign)[a], rcond=None)[0]
        cross = ~free[a] & (u[a] * there < 0)
        shares = np.unique(np.r_[u[a][cross] / (u[a] - there)[cross], 1.0])
        points = np.array([u[a] + s * (there - u[a]) for s in shares])
        points[abs(points) < 1e-12 * abs(u[a] - there)] = 0.0
        costs = 0.5 * ((points @ h[np.ix_(a, a)]) * points).sum(axis=1) + points @ q[a] + abs(points) @ bound[a]
        best = int(np.argmin(costs))
        u[a] = points[best]
        sign = np.where(free, 0.0, np.sign(u))
        active = (u != 0) | free
        if best < len(shares) - 1 or cross.any():
            continue  # on with the signs found
        slope = h @ u + q
        over = np.where(active, -np.inf, abs(slope) - bound)
        j = int(np.argmax(over))
        if not over[j] > 1e-9 * (1 + bound[j]):
            break
        active[j], sign[j] = True, -np.sign(slope[j])
    return u


def _advance(row) -> tuple:
    """Weights, step, damping, sums, objective, promise and end of one search, after the point ``w + d`` was looked at.

    A step that gains too little is taken again with more damping, which shortens it where the loss is nearly flat; steps that keep their promise lower it.
    """
    w, d, sums = (np.asarray(v, dtype=float) for v in (row.w, row.d, row.sums))
    at, damp = w + d, row.damp
    value = sums[0] + row.penalty * (abs(at[:-1]).sum() if row.l1 else 0.5 * (at[:-1] ** 2).sum())
    if value <= row.value + 1e-4 * row.promise:
        if np.isfinite(row.value):
            kept = (row.value - value) / max(-row.promise, 1e-300)  # a half, where the loss is a parabola
            damp = damp / 4 if kept > 0.4 else damp * 4 if kept < 0.1 else damp
            damp = damp if damp > 1e-6 else 0.0
    else:
        at, sums, value = w, np.asarray(row.base, dtype=float), row.value
        damp = max(4 * damp, -row.promise / max(d @ d, 1e-300))
    n = len(at)
    gradient, hessian = sums[1 : n + 1], np.zeros((n, n))
    hessian[np.triu_indices(n)] = sums[n + 1 :]
    hessian = hessian + np.triu(hessian, 1).T
    step, promise = _direction(at, gradient, hessian, row.penalty, row.l1)
    if not -promise > TOLERANCE * (1 + abs(value)):
        return at + step, step, damp, sums, value, promise, True  # so near the end a full step is sure to gain
    if damp:
        step, promise = _direction(at, gradient, hessian + damp * np.eye(n), row.penalty, row.l1)
    return at, step, damp, sums, value, promise, bool(abs(step).max() < 1e-13 * (1 + abs(at).max()))


def _step(search: DataFrame, sums: DataFrame) -> DataFrame:
    def run(frames):
        for frame in frames:
            moved = pd.DataFrame([_advance(r) for r in frame.itertuples()], columns=["w", "d", "damp", "base", "value", "promise", "done"], index=frame.index)
            yield frame.drop(columns="sums").assign(**{c: moved[c] for c in moved})[[f.split()[0] for f in _STATE.split(", ")]]

    # The steps of all searches are a few rows, but work for many tasks.
    return search.join(sums, [S.ROUTE, "cell"]).repartition(_tasks(search), S.ROUTE, "cell").mapInPandas(run, _STATE)


def _tasks(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def _solved(x: np.ndarray, y: np.ndarray, cell: SimpleNamespace, w: np.ndarray, max_iter: int) -> np.ndarray:
    """The weights at the end of one search over rows that a task holds; ``x`` ends with ones."""
    at = SimpleNamespace(w=w, d=np.zeros_like(w), damp=0.0, base=None, value=float("inf"), promise=0.0, penalty=cell.penalty, l1=cell.l1)
    weight, upper = np.where(y > 0, cell.c1, cell.c0), np.triu_indices(x.shape[1])
    for _ in range(max_iter):
        margin = x @ (at.w + at.d)
        p = 0.5 * (1 + np.tanh(0.5 * margin))
        loss = weight @ (np.logaddexp(0, margin) - y * margin)
        at.sums = np.concatenate([[loss], (weight * (p - y)) @ x, (x.T @ ((weight * p * (1 - p))[:, None] * x))[upper]])
        at.w, at.d, at.damp, at.base, at.value, at.promise, done = _advance(at)
        if done:
            break
    return at.w


def _begun(search: DataFrame, blocks: DataFrame, max_iter: int) -> DataFrame:
    """``search``, begun at the optimum of START_BLOCKS blocks of each route instead of at zero, with losses weighed up to those of all its rows.

    This only saves passes: a search ends where the passes over all rows say so. Cells that differ in strength alone are one task, each begun at the one before.
    """
    marked = blocks.withColumn("_hash", F.xxhash64("x"))
    sizes = marked.groupBy(S.ROUTE).agg(F.sum(F.length("y") / 8).alias("_rows"), F.count("*").alias("_blocks"))
    draw = F.shiftrightunsigned("_hash", 11) / float(1 << 53)
    some = marked.select(S.ROUTE, "_hash").join(sizes, S.ROUTE).where(draw * F.col("_blocks") < 4 * START_BLOCKS)
    least = some.groupBy(S.ROUTE).agg(F.first("_rows").alias("_rows"), F.slice(F.array_sort(F.collect_set("_hash")), 1, START_BLOCKS).alias("_least"))
    sample = marked.join(least, S.ROUTE).where(F.array_contains("_least", F.col("_hash"))).select(S.ROUTE, "x", "y", "_rows")
    path = [S.ROUTE, "l1", "c0", "c1"]
    paths = search.groupBy(*path).agg(F.sort_array(F.collect_list(F.struct("penalty", "cell")), asc=False).alias("_cells"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[0]
        y = np.concatenate([np.frombuffer(v) for v in group["y"]])
        if min(y.sum(), len(y) - y.sum()) < 10:  # too few of a class to tell anything
            return pd.DataFrame([], columns=[S.ROUTE, "cell", "_w"])
        x = np.concatenate([np.frombuffer(v) for v in group["x"]]).reshape(len(y), -1)
        x, share, w, found = np.column_stack([x, np.ones(len(x))]), first["_rows"] / len(y), np.zeros(x.shape[1] + 1), []
        for c in first["_cells"]:
            cell = SimpleNamespace(c0=first["c0"] * share, c1=first["c1"] * share, penalty=c["penalty"], l1=first["l1"])
            w = _solved(x, y, cell, w, max_iter)
            found.append((first[S.ROUTE], c["cell"], w.tolist()))
        return pd.DataFrame(found, columns=[S.ROUTE, "cell", "_w"])

    together = paths.join(sample, S.ROUTE).repartition(_tasks(search), *path)
    starts = together.groupBy(*path).applyInPandas(run, f"{S.ROUTE} string, cell int, _w array<double>")
    return search.join(starts, [S.ROUTE, "cell"], "left").withColumn("w", F.coalesce("_w", "w")).drop("_w")


# ---------------------------------------------------------------- fits


def fit(train: DataFrame, features: Sequence[str], grid: Sequence[Cell], max_iter: int = ITERATIONS) -> DataFrame:
    """``cell, coefficients, intercept`` per route of ``train`` (features, and ``y_true`` of 0 and 1). The penalty weighs against the sum of the losses,
    on features scaled by the route's rows. A search that is not at its end after ``max_iter`` passes gives what it has.
    """
    features = list(features)
    stats = stored(moments(train, features), "moments")
    scaled = standardise(train.select(S.ROUTE, "y_true", *features), stats, features)
    blocks = stored(tiles.blocks(scaled, {"x": tiles.inputs(features), "y": F.array(F.col("y_true").cast("double"))}), "blocks")
    sizes = train.groupBy(S.ROUTE).agg(F.count_if(F.col("y_true") == 1).alias("one"), F.count_if(F.col("y_true") == 0).alias("zero"))
    nothing = F.array_repeat(F.lit(0.0), len(features) + 1)
    search = stored(
        sizes.select("*", F.inline(_options(grid))).select(
            S.ROUTE, "cell", "c0", "c1", "penalty", "l1", nothing.alias("w"), nothing.alias("d"), F.lit(0.0).alias("damp"),
            F.array().cast("array<double>").alias("base"), F.lit(float("inf")).alias("value"), F.lit(0.0).alias("promise"), F.lit(False).alias("done"),
        ), "search",
    )
    search = stored(_begun(search, blocks, ITERATIONS), "begun")
    ended = []
    for _ in range(max_iter):
        search = stored(_step(search, _pass(blocks, search)), "search")
        ended.append(search.where("done"))
        search = search.where("NOT done")
        if search.isEmpty():
            break
    else:
        ended.append(search)
    fitted = reduce(DataFrame.unionAll, ended)
    mean, std = (F.array(*[F.col(f"{c}_{s}") for c in features]) for s in ("mean", "std"))
    raw = fitted.join(stats.select(S.ROUTE, mean.alias("_mean"), std.alias("_std")), S.ROUTE).withColumn("coefficients", F.zip_with(F.slice("w", 1, len(features)), "_std", lambda w, s: w / s))
    shift = F.aggregate(F.zip_with("coefficients", "_mean", lambda w, m: w * m), F.lit(0.0), lambda a, b: a + b)
    return raw.select(S.ROUTE, "cell", "coefficients", (F.col("w")[len(features)] - shift).alias("intercept"))


def _options(grid: Sequence[Cell]):
    """Class weights and penalty of every cell, from a route's class sizes."""
    rows = F.col("one") + F.col("zero")
    cells = []
    for i, c in enumerate(grid):
        balanced = c.anomaly_weight == "balanced"
        zero = rows / (2 * F.col("zero")) if balanced else F.lit(1.0)
        one = rows / (2 * F.col("one")) if balanced else F.lit(float(c.anomaly_weight or 1.0))
        cells.append(F.struct(F.lit(i).alias("cell"), zero.alias("c0"), one.alias("c1"), F.lit(1.0 / c.strength).alias("penalty"), F.lit(c.penalty == "l1").alias("l1")))
    return F.array(*cells)


def grid_results(test: DataFrame, models: DataFrame, features: Sequence[str]) -> DataFrame:
    """Best threshold and F1 per route and cell on ``test``; every row is scored by all cells of its route at once."""
    cells = models.groupBy(S.ROUTE).agg(F.collect_list(F.struct("cell", "coefficients", "intercept")).alias("_cells"))
    joined = join_group_values(test.select(S.ROUTE, F.col("y_true").alias("y"), tiles.inputs(features).alias("_x")), cells, [S.ROUTE], how="inner")
    scores = joined.select(S.ROUTE, "y", F.inline(F.transform("_cells", lambda m: F.struct(m["cell"].alias("cell"), _probability(m["coefficients"], m["intercept"]).alias("score")))))
    keys = [S.ROUTE, "cell"]
    return ev.best_threshold(ev.threshold_scan(scores, TAUS, keys), keys)


def _probability(coefficients, intercept):
    margin = F.aggregate(F.zip_with(coefficients, F.col("_x"), lambda w, x: w * x), intercept, lambda a, b: a + b)
    return 1 / (1 + F.exp(-margin))


def model_table(spark, models: dict[str, Linear]) -> DataFrame:
    return spark.createDataFrame([(r, list(m.coefficients), m.intercept) for r, m in models.items()], MODEL_SCHEMA)


def score(points: DataFrame, models: DataFrame, features: Sequence[str]) -> DataFrame:
    """Probability of an anomaly for points of all routes at once."""
    joined = join_group_values(points, models.select(S.ROUTE, "coefficients", "intercept"), [S.ROUTE], how="inner")
    margin = F.col("intercept")
    for i, c in enumerate(features):
        margin = margin + F.get("coefficients", F.lit(i)) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return joined.withColumn("score", 1 / (1 + F.exp(-margin))).drop("coefficients", "intercept")
