"""Walks down decision trees that are kept as a node table.

A node has a number: the root 1, the children of n 2n (up to the threshold) and 2n + 1 (above it). ``feature`` is null for a leaf, whose
``value`` is what the tree gives. Trees arrive in parts of LEVELS levels, the top first, so that a task holds one part, however large the tree.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.ml import tiles

LEVELS = 16
"""Levels of a part: 65,535 nodes at most."""

BLOCK = 4096
"""Rows that go down a tree together: what they need stays in a core's cache."""

_PART = ("cell", "tree", "tier", "top")


def _row_blocks(x: np.ndarray, rows: np.ndarray):
    for i in range(0, len(rows), BLOCK):
        own = rows[i : i + BLOCK]
        yield own, x[own].T.copy()


def descend(blocks, column: np.ndarray, bound: np.ndarray, child: np.ndarray, steps: int):
    """``rows, values, size, place`` of each block: where its rows stand ``steps`` steps below the first node. ``child`` is the place of a node's lower
    child, which the upper one follows; a node without children has itself, and an infinite bound."""
    for rows, x in blocks:
        flat, size = x.ravel(), x.shape[1]
        start, offset = np.arange(size), column * size
        place, at = np.zeros(size, dtype=np.intp), np.empty(size, dtype=np.intp)
        value, limit = np.empty(size), np.empty(size)
        for _ in range(steps):  # "clip" spares numpy a copy; nothing is out of bounds
            np.take(offset, place, out=at, mode="clip")
            at += start
            np.take(flat, at, out=value, mode="clip")
            np.take(bound, place, out=limit, mode="clip")
            np.take(child, place, out=at, mode="clip")
            np.add(at, value > limit, out=place)
        yield rows, flat, size, place


class TreeWalk:
    """Sums of the leaf values that each row meets, per cell; :meth:`result` gives the means over the trees."""

    def __init__(self, x: np.ndarray, cells: Sequence[int]):
        self._x, self._column = x, {c: i for i, c in enumerate(cells)}
        self._sums, self._trees = np.zeros((len(x), len(cells))), np.zeros(len(cells))
        self._rest: dict[str, np.ndarray] | None = None
        self._at, self._open = np.empty(0, dtype=np.int64), None
        self._blocks = [(slice(i, i + BLOCK), x[i : i + BLOCK].T.copy()) for i in range(0, len(x), BLOCK)]

    def add(self, nodes: pa.StructArray) -> None:
        new = {c: nodes.field(c).to_numpy(zero_copy_only=False) for c in ("cell", "tree", "tier", "top", "node", "threshold", "value")}
        new["feature"] = nodes.field("feature").fill_null(-1).to_numpy(zero_copy_only=False)
        if self._rest is not None:
            new = {c: np.concatenate([self._rest[c], v]) for c, v in new.items()}
        marks = np.stack([new[c] for c in _PART])
        starts = np.flatnonzero(np.r_[True, (marks[:, 1:] != marks[:, :-1]).any(axis=0)])
        for low, high in zip(starts[:-1], starts[1:], strict=True):
            self._walk({c: v[low:high] for c, v in new.items()})
        self._rest = {c: v[starts[-1] :] for c, v in new.items()}  # the last part may go on

    def _walk(self, part: dict[str, np.ndarray]) -> None:
        column = self._column[int(part["cell"][0])]
        top = int(part["top"][0])
        if top == 1:
            self._trees[column] += 1
            self._at = np.ones(len(self._x), dtype=np.int64)
            self._open = None
        elif self._open is None or self._open[0] != part["tier"][0]:
            order = np.argsort(self._at, kind="stable")
            self._open = part["tier"][0], order, self._at[order]
        if top == 1:
            blocks = self._blocks
        else:  # the rows that stand at the part's top
            _, order, at = self._open
            rows = order[np.searchsorted(at, top) : np.searchsorted(at, top, side="right")]
            blocks = _row_blocks(self._x, rows)
        node, feature, threshold, given = (part[c] for c in ("node", "feature", "threshold", "value"))
        left = np.searchsorted(node, 2 * node)
        inside = (feature >= 0) & (left < len(node)) & (node[np.minimum(left, len(node) - 1)] == 2 * node)
        # Every row goes down as many steps as the part is deep; where it has come to an end it steps on the spot.
        column_of, bound, child = np.where(inside, feature, 0).astype(np.intp), np.where(inside, threshold, np.inf), np.where(inside, left, np.arange(len(node)))
        steps = int(node[-1]).bit_length() - top.bit_length()
        leaf, ends = feature < 0, bool((feature[~inside] < 0).all())
        gain = np.where(leaf, given, 0.0)
        for rows, flat, size, place in descend(blocks, column_of, bound, child, steps):
            self._sums[rows, column] += gain[place]
            if ends:
                self._at[rows] = 0
            else:  # some go on in a lower part
                right = flat[np.maximum(feature, 0)[place] * size + np.arange(size)] > threshold[place]
                self._at[rows] = np.where(leaf[place], 0, 2 * node[place] + right)

    def result(self) -> np.ndarray:
        if self._rest is not None:
            self._walk(self._rest)
            self._rest = None
        with np.errstate(invalid="ignore"):
            return self._sums / np.where(self._trees > 0, self._trees, np.nan)


def mean_values(points: DataFrame, x: Column, nodes: DataFrame, cells: Sequence[int], out: str, levels: int = LEVELS, chunk_rows: int = tiles.CHUNK_ROWS) -> DataFrame:
    """``out``: per cell, the mean leaf value over the trees of the point's route. ``nodes`` has ``cell, tree, node, feature, threshold,
    value`` and the route."""
    wanted = list(cells)
    depth = F.length(F.bin("node")) - 1
    table = nodes.where(F.col("cell").isin(wanted)).select(
        S.ROUTE, F.col("cell").cast("int").alias("cell"), F.col("tree").cast("int").alias("tree"), F.col("node").cast("long").alias("node"),
        F.col("feature").cast("int").alias("feature"), F.coalesce(F.col("threshold").cast("double"), F.lit(0.0)).alias("threshold"),
        F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("value"), F.floor(depth / levels).cast("int").alias("tier"),
    )
    parts = table.withColumn("top", F.call_function("shiftright", F.col("node"), depth - F.col("tier") * levels))
    return tiles.score(points, x, parts, lambda matrix: TreeWalk(matrix, wanted), [*_PART, "node"], out, chunk_rows)
