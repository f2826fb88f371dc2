"""Sequence reconstruction: how far a window is from the windows normal trips make.

A window is scaled, flattened and rebuilt from the main directions of the normal windows (a linear
autoencoder in closed form). This is another model than a recurrent autoencoder; windows, error
(largest squared deviation in the window) and threshold (percentile of the held-out normal
errors) are the same.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.ml import scaling, tiles
from wakeline.operators.scan import group_percentiles
from wakeline.plans.features import sequence_sets
from wakeline.session import stored

# Size of the code, percentile of the normal errors used as threshold.
CODE = 16
TAU_PERCENTILE = 95.0
CHUNK_WINDOWS = 1 << 13
"""Windows that a task scores together: a window is as many numbers as 15 points, and a task holds a chunk several times over."""
DIRECTIONS_SCHEMA = f"{S.ROUTE} string, mean array<double>, components array<array<double>>"


def fit(normal: DataFrame, code: int = CODE) -> DataFrame:
    """``mean, components`` per route of scaled normal windows: the ``code`` directions of largest variance, found for all routes in one pass.

    Windows are summed up as they lie, per route: count, sums and products. A task then has one route's matrix of products, whatever the
    number of windows. Directions without variance are left out; a single window has none.
    """
    blocks = tiles.blocks(normal, {"x": F.flatten("features"), "one": F.array(F.lit(1.0))})

    def run(batches):
        sums: dict = {}
        for batch in batches:
            for route, x, one in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                x = np.frombuffer(x).reshape(len(one) // 8, -1)
                line = np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x)[np.triu_indices(x.shape[1])]])
                sums[route] = sums[route] + line if route in sums else line
                if len(sums) > 500:
                    yield _lines(sums)
                    sums = {}
        yield _lines(sums)

    def solve(frames):
        for frame in frames:
            found = [_directions(np.asarray(sums), code) for sums in frame["sums"]]
            yield pd.DataFrame({S.ROUTE: frame[S.ROUTE], "mean": [m.tolist() for m, _ in found], "components": [c.tolist() for _, c in found]})

    parts = blocks.mapInArrow(run, f"{S.ROUTE} string, line array<double>")
    return tiles.sum_arrays(parts, [S.ROUTE], "line").mapInPandas(solve, DIRECTIONS_SCHEMA)


def _lines(sums: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.float64()))], [S.ROUTE, "line"])


def _directions(sums: np.ndarray, code: int) -> tuple[np.ndarray, np.ndarray]:
    width = int((np.sqrt(8 * len(sums) + 1) - 3) / 2)  # 1 + width + width * (width + 1) / 2 sums
    n, mean = sums[0], sums[1 : width + 1] / sums[0]
    if n < 2:
        return mean, np.zeros((0, width))
    products = np.zeros((width, width))
    products[np.triu_indices(width)] = sums[width + 1 :]
    products += np.triu(products, 1).T
    variance, vectors = np.linalg.eigh((products - n * np.outer(mean, mean)) / (n - 1))
    wanted = np.argsort(-variance, kind="stable")[:code]
    wanted = wanted[variance[wanted] > 1e-12 * max(variance.max(), 1e-300)]
    return mean, vectors[:, wanted].T


class Deviations:
    """The largest squared deviation of each flat window from its rebuilding by the one model of its route."""

    def __init__(self, x: np.ndarray):
        self._x, self._out = x, np.full((len(x), 1), np.nan)

    def add(self, models: pa.StructArray) -> None:
        model = models[len(models) - 1].as_py()
        rest = self._x - np.asarray(model["mean"])
        components = np.asarray(model["components"], dtype=float).reshape(-1, self._x.shape[1])
        rest = rest - (rest @ components.T) @ components
        self._out[:, 0] = (rest * rest).max(axis=1)

    def result(self) -> np.ndarray:
        return self._out


def window_errors(windows: DataFrame, models: DataFrame, chunk_rows: int = CHUNK_WINDOWS) -> DataFrame:
    """``error``: largest squared deviation between a scaled window and its reconstruction by its route's row of ``models``; null without one."""
    rows = models.select(S.ROUTE, "mean", "components")
    return tiles.score(windows, F.flatten("features"), rows, Deviations, [], "_error", chunk_rows).withColumn("error", F.col("_error")[0]).drop("_error")


def train(points: DataFrame, features: Sequence[str], code: int = CODE, length: int = 15, step: int = 7) -> tuple[DataFrame, DataFrame]:
    """Models of all routes in ``points`` (``mean, components, lows, spans, tau``) and their errors on the held-out and anomalous windows.

    Each route's windows are scaled by its normal training windows. A route without a held-out normal window has no ``tau``.
    """
    sets = stored(sequence_sets(points, features, length, step), "windows")
    ranges = stored(scaling.window_ranges(sets.filter("part = 'train'"), len(features)), "ranges")
    scaled = stored(scaling.scale_windows(sets, ranges), "scaled")
    models = stored(fit(scaled.filter("part = 'train'"), code), "directions")
    errors = stored(window_errors(scaled.filter("part <> 'train'"), models), "errors")
    taus = group_percentiles(errors.filter("part = 'validation'"), [S.ROUTE], "error", [TAU_PERCENTILE / 100], ["tau"])
    return models.join(ranges, S.ROUTE).join(taus.select(S.ROUTE, "tau"), S.ROUTE, "left"), errors
