"""One-class machines with a Gaussian kernel (Schoelkopf et al. 2001) for all routes and grid cells.

Each route's dual problem is set on all its training points (or, if a number is asked for, on that many in hash
order). Its kernel grows with the square of the points and is never held: a task has the points of one route, and
solves its cells of one width by working sets of the points that break the optimum most. Points that end with a
weight are the machine; all training points set the offset, and all points are scored against those with a weight.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.functions.scalar import even_grid
from wakeline.ml import tiles
from wakeline.operators.layout import join_group_values
from wakeline.operators.scan import group_rank
from wakeline.operators.split import hash_text
from wakeline.session import short_lived, stored

# Outlier shares, kernel widths, percentiles tried as thresholds.
NUS = (0.001, 0.003, 0.01, 0.03)
GAMMAS = ("scale", "auto", 0.001, 0.01, 0.1, 1.0)
TAU_PERCENTS = even_grid(60.0, 99.9, 80)

# Points whose problem is solved with its whole kernel, and points of a working set.
WHOLE = 2000
WORKING = 1000
# Rows and landmarks whose distances are held at once.
TILE = 1024
# Training points, counted once for each kernel width, that are shuffled to tasks at once: about a gigabyte.
COPIED = 10_000_000
MODEL_SCHEMA = f"{S.ROUTE} string, cell int, gamma double, alpha array<double>"


@dataclass(frozen=True)
class Cell:
    nu: float
    gamma: float | str


def full_grid() -> list[Cell]:
    return [Cell(*c) for c in product(NUS, GAMMAS)]


def solve(kernel: np.ndarray, nu: float, tolerance: float = 1e-3) -> np.ndarray:
    """Weights of min a'Ka/2 with 0 <= a <= 1 and sum a = nu * m, by pairwise steps until no pair gains ``tolerance``, or rounding leaves
    a step without effect."""
    m = len(kernel)
    alpha = _first_of(np.arange(m), nu)
    _balance(kernel, alpha, kernel @ alpha, tolerance)
    return alpha


def _first_of(order: np.ndarray, nu: float) -> np.ndarray:
    """The weights that give the whole budget to the first points of ``order``."""
    budget = nu * len(order)
    alpha = np.zeros(len(order))
    alpha[order[: int(budget)]] = 1.0
    if int(budget) < len(order):
        alpha[order[int(budget)]] = budget - int(budget)
    return alpha


def _balance(kernel: np.ndarray, alpha: np.ndarray, gradient: np.ndarray, tolerance: float) -> None:
    """Moves weight between pairs, in place."""
    while True:
        rising, falling = np.where(alpha < 1, gradient, np.inf), np.where(alpha > 0, gradient, -np.inf)
        up, down = int(np.argmin(rising)), int(np.argmax(falling))
        gap = falling[down] - rising[up]
        if not gap >= tolerance:  # also if nothing can move
            return
        curve = max(kernel[up, up] + kernel[down, down] - 2 * kernel[up, down], 1e-12)
        step = min(gap / curve, 1 - alpha[up], alpha[down])
        if alpha[up] + step == alpha[up] and alpha[down] - step == alpha[down]:
            return
        alpha[up] += step
        alpha[down] -= step
        gradient += step * (kernel[:, up] - kernel[:, down])


def solve_rows(x: np.ndarray, gamma: float, nu: float, tolerance: float = 1e-3) -> np.ndarray:
    """:func:`solve` for the Gaussian kernel of any number of points, in memory that grows with them in proportion.

    The first WHOLE points guess which points lie outermost; these get the budget. Then the points that break the optimum most are balanced
    among each other, until no pair of all points gains ``tolerance``.
    """
    some = x[:WHOLE]
    guess = solve(np.exp(-gamma * squared_distances(some, some)), nu, tolerance)
    if len(x) <= WHOLE:
        return guess
    alpha = _first_of(np.argsort(_densities(x, some, guess, gamma), kind="stable"), nu)
    gradient = _densities(x, x, alpha, gamma)
    half = WORKING // 2
    while True:
        rising, falling = np.where(alpha < 1, gradient, np.inf), np.where(alpha > 0, gradient, -np.inf)
        if not falling.max() - rising.min() >= tolerance:
            return alpha
        at = np.union1d(np.argpartition(rising, half - 1)[:half], np.argpartition(-falling, half - 1)[:half])
        moved = alpha[at]
        _balance(np.exp(-gamma * squared_distances(x[at], x[at])), moved, gradient[at], tolerance / 2)
        change = moved - alpha[at]
        if not change.any():  # rounding leaves steps without effect
            return alpha
        alpha[at] = moved
        gradient += _densities(x, x[at], change, gamma)


def _densities(x: np.ndarray, marks: np.ndarray, weights: np.ndarray, gamma: float) -> np.ndarray:
    """Weighted kernel sums of ``marks`` at ``x``, a tile of distances at a time."""
    own, sums = np.flatnonzero(weights), np.zeros(len(x))
    for at in range(0, len(own), TILE):
        part = own[at : at + TILE]
        for low in range(0, len(x), TILE):
            sums[low : low + TILE] += np.exp(-gamma * squared_distances(x[low : low + TILE], marks[part])) @ weights[part]
    return sums


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0.0)


def landmarks(train: DataFrame, features: Sequence[str], row_key: str, count: int | None = None, seed: int = 42) -> DataFrame:
    """(route, position, x): the points of each route in hash order, or the first ``count`` of them.

    Hashes are uniform, so with a count all but about twice the wanted points are dropped before the ranking,
    by a threshold from the route's size; only these few are shuffled.
    """
    hashed = train.withColumn("_md5", hash_text(F.col(row_key), seed))
    hashed = hashed.withColumn("_hash", F.conv(F.substring("_md5", 1, 15), 16, 10).cast("bigint"))
    rows = hashed.select(S.ROUTE, "_hash", "_md5", F.array(*features).alias("x"))
    if count is not None:
        sizes = train.groupBy(S.ROUTE).agg(F.count("*").alias("_n"))
        rows = join_group_values(rows, sizes, [S.ROUTE], source=train).filter(F.col("_hash") / float(1 << 60) * F.col("_n") < 2 * count + 100)
    ranked = group_rank(rows, [S.ROUTE], ["_hash", "_md5"], "position")
    wanted = F.col("position").isNotNull() if count is None else F.col("position") <= count
    return ranked.filter(wanted).select(S.ROUTE, "position", "x")


def fit(marks: DataFrame, cells: Sequence[Cell]) -> DataFrame:
    """One row per (route, cell) with the landmark weights, in landmark order; most are 0.

    A task has all landmarks of a route, once for each kernel width. Widths take turns where their copies would be many rows.
    """
    widths = list(dict.fromkeys(c.gamma for c in cells))
    turn = max(1, COPIED // max(1, marks.count()))
    if turn >= len(widths):
        return _fit(marks, cells, widths)
    parts = []
    for i in range(0, len(widths), turn):
        with short_lived(marks.sparkSession) as kept:
            parts.append(kept(_fit(marks, cells, widths[i : i + turn]), "machines"))
    return reduce(DataFrame.unionAll, parts)


def _fit(marks: DataFrame, cells: Sequence[Cell], widths: Sequence[float | str]) -> DataFrame:
    def solve_width(key: tuple, group: pa.Table) -> pa.Table:
        route, rule = key[0].as_py(), widths[key[1].as_py()]
        group = group.sort_by("position")
        x = group.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(group), -1)
        gamma = 1.0 / x.shape[1] if rule == "auto" else 1.0 / (x.shape[1] * (x.var() or 1.0)) if rule == "scale" else float(rule)
        own = [i for i, c in enumerate(cells) if c.gamma == rule]
        alphas = [solve_rows(x, gamma, cells[i].nu) for i in own]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * len(x), pa.int32()), pa.array(np.concatenate(alphas)))
        columns = [pa.array([route] * len(own), pa.string()), pa.array(own, pa.int32()), pa.array([gamma] * len(own)), lists]
        return pa.Table.from_arrays(columns, [S.ROUTE, "cell", "gamma", "alpha"])

    dealt = marks.select("*", F.explode(F.array(*[F.lit(i) for i in range(len(widths))])).alias("_width"))
    # With as many tasks few widths meet in one.
    spread = dealt.repartition(16 * len(widths), S.ROUTE, "_width")
    return spread.groupBy(S.ROUTE, "_width").applyInArrow(solve_width, MODEL_SCHEMA)


class KernelSums:
    """Weighted kernel sums of a chunk's rows over landmarks as they come, for every cell."""

    def __init__(self, x: np.ndarray, cells: int):
        self._x, self._sums, self._met = x, np.zeros((len(x), cells)), np.zeros(cells, dtype=bool)

    def add(self, marks: pa.StructArray) -> None:
        for at in range(0, len(marks), TILE):
            part = marks.slice(at, TILE)
            x, weights, gammas = (part.field(c).flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1) for c in ("x", "weights", "gammas"))
            widths = gammas[0]  # a route's cell has one width for all its landmarks
            self._met |= ~np.isnan(widths)
            for low in range(0, len(self._x), TILE):
                distances = squared_distances(self._x[low : low + TILE], x)
                for gamma in np.unique(widths[~np.isnan(widths)]):
                    cells = np.flatnonzero(widths == gamma)
                    used = np.flatnonzero((weights[:, cells] != 0).any(axis=1))  # those of other widths add nothing
                    added = np.exp(-gamma * distances[:, used]) @ weights[np.ix_(used, cells)]
                    self._sums[low : low + len(added), cells] += added

    def result(self) -> np.ndarray:
        return np.where(self._met, self._sums, np.nan)


def densities(points: DataFrame, marks: DataFrame, models: DataFrame, features: Sequence[str], cells: Sequence[int], **options) -> DataFrame:
    """``density``: per cell, the weighted kernel sum of the route's landmarks around each point; null where the route has no such model.

    Points meet landmarks in tiles (:mod:`wakeline.ml.tiles`), so neither all landmarks nor a route's points have to fit a task.
    """
    count = len(cells)
    place = F.array_position(F.array(*[F.lit(c) for c in cells]), F.col("cell")).cast("int")
    own = models.withColumn("_place", place).where("_place > 0")
    weights = own.select(S.ROUTE, "_place", F.posexplode("alpha").alias("_i", "_weight")).where("_weight != 0")
    by_place = lambda value: F.map_from_entries(F.collect_list(F.struct("_place", value)))  # noqa: E731  (one entry a cell)
    per_mark = weights.groupBy(S.ROUTE, (F.col("_i") + 1).alias("position")).agg(by_place(F.col("_weight")).alias("_weights"))
    of = lambda values, missing: F.transform(F.sequence(F.lit(1), F.lit(count)), lambda i: F.coalesce(F.col(values)[i], F.lit(missing)))
    widths = own.groupBy(S.ROUTE).agg(by_place(F.col("gamma")).alias("_gammas"))
    weighted = join_group_values(marks.join(per_mark, [S.ROUTE, "position"]), widths, [S.ROUTE], source=models)
    rows = weighted.select(S.ROUTE, "position", "x", of("_weights", 0.0).alias("weights"), of("_gammas", float("nan")).alias("gammas"))
    return tiles.score(points, tiles.inputs(features), rows, lambda x: KernelSums(x, count), ["position"], "density", **options)


def train_landmarks(train: DataFrame, features: Sequence[str], row_key: str, **options) -> DataFrame:
    return stored(landmarks(train, features, row_key, **options), "landmarks")
