"""Isolation forests (Liu, Ting and Zhou 2008) for all routes and grid cells in the same jobs.

A task holds the training rows of a route, draws the samples of its trees from them and grows them level by level, all nodes of a level at once.
While cells are compared it also sends rows down each tree as soon as that is grown: forests whose samples are all rows have about as many nodes as
samples have rows, and are never written. Only the chosen cell's forest is.

A route with more than ``TASK_ROWS`` training rows is no task's work. Its samples are dealt out by a join, and nodes with more rows than that are
split level by level: one aggregate finds size and ranges of every such node, one join sends the rows to the children. Once a node's rows
fit a task, its subtree is finished there.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.ml import tiles, trees
from wakeline.operators.layout import join_group_values
from wakeline.session import short_lived, stored

# Trees, sample sizes (shares of the rows, or 256 rows), feature shares, contamination,
# percentile of the training scores used as threshold.
TREES = (80, 100, 120, 140, 200)
SAMPLES = (0.5, 0.75, 1.0, "auto")
FEATURE_SHARES = (1.0, 0.8, 0.6)
AUTO_SAMPLE = 256
CONTAMINATION = {"BREMERHAVEN": 0.02}
CONTAMINATION_ELSE = 0.008
TAU_PERCENTILE = 94.0

_NODE = [S.ROUTE, "cell", "tree", "node"]
NODE_SCHEMA = f"{S.ROUTE} string, cell int, tree int, node bigint, depth int, size bigint, psi double, feature int, threshold double"
# Training rows that a task holds, and rows that it sends down the trees: some 100 MB each.
TASK_ROWS = 1_500_000
# Sampled rows of large routes that are written at once.
SAMPLED_ROWS = 20_000_000


@dataclass(frozen=True)
class Cell:
    trees: int = 100
    sample: float | str = "auto"
    feature_share: float = 1.0


def full_grid() -> list[Cell]:
    return [Cell(*c) for c in product(TREES, SAMPLES, FEATURE_SHARES)]


def _uniform(*parts) -> Column:
    """Repeatable value in [0, 1) from column values."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / float(1 << 53)


def draw_samples(train: DataFrame, features: Sequence[str], cells: Sequence[Cell], row_key: str, seed: int = 42, part: Column | None = None) -> DataFrame:
    """(route, cell, tree, node, psi, limit, allowed, x): the sampled rows of every tree, or of those that meet ``part``.

    Rows are dealt like cards: one pass gives each of ``n // psi`` trees about ``psi`` rows without
    replacement, and there are as many passes as the trees need. So the output is trees * psi rows,
    with one hash per row and pass.
    """
    route_sizes = train.groupBy(S.ROUTE).agg(F.count("*").alias("_n"))
    rows = train.select(S.ROUTE, F.col(row_key).alias("_key"), F.array(*features).alias("x"))
    sized = join_group_values(rows, route_sizes, [S.ROUTE], source=train, how="inner")
    options = F.array(
        *[
            F.struct(
                F.lit(i).alias("cell"),
                F.lit(c.trees).alias("trees"),
                (F.least(F.lit(AUTO_SAMPLE), F.col("_n")) if c.sample == "auto" else F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(float(c.sample)))))
                .cast("double")
                .alias("psi"),
            )
            for i, c in enumerate(cells)
        ]
    )
    dealt = sized.select("*", F.inline(options))
    per_pass = F.floor(F.col("_n") / F.col("psi")).cast("int")
    passes = F.ceil(F.col("trees") / per_pass).cast("int")
    dealt = dealt.withColumn("_pass", F.explode(F.sequence(F.lit(0), passes - 1)))
    hand = F.floor(_uniform("_key", "cell", "_pass", F.lit(seed)) * F.col("_n") / F.col("psi")).cast("int")
    dealt = dealt.withColumn("_hand", hand).filter(F.col("_hand") < per_pass)
    dealt = dealt.withColumn("tree", F.col("_pass") * per_pass + F.col("_hand")).filter(F.col("tree") < F.col("trees"))
    dealt = dealt if part is None else dealt.filter(part)
    limit = F.ceil(F.log2(F.greatest(F.col("psi"), F.lit(2.0)))).cast("int")
    return dealt.select(
        S.ROUTE, "cell", "tree", F.lit(1).cast("bigint").alias("node"), "psi", limit.alias("limit"), _tree_features(len(features), cells, seed).alias("allowed"), "x"
    )


def _tree_features(width: int, cells: Sequence[Cell], seed: int) -> Column:
    """The features a tree may split on, drawn once per tree."""
    wanted = F.lit(width)
    for i, c in enumerate(cells):
        wanted = F.when(F.col("cell") == i, max(1, int(c.feature_share * width))).otherwise(wanted)
    drawn = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.struct(F.xxhash64(S.ROUTE, "cell", "tree", i, F.lit(seed)).alias("h"), i.alias("i"))
    )
    return F.slice(F.transform(F.array_sort(drawn), lambda s: s["i"]), F.lit(1), wanted)


def _split_nodes(rows: DataFrame, width: int, depth: int, seed: int) -> DataFrame:
    """Size and random split of every node in ``rows``; a node that cannot or may not split is a leaf."""
    ranges = rows.groupBy(*_NODE).agg(
        F.count("*").alias("size"),
        F.max("psi").alias("psi"),
        F.max("limit").alias("limit"),
        F.max("allowed").alias("allowed"),
        F.array(*[F.min(F.col("x")[i]) for i in range(width)]).alias("_low"),
        F.array(*[F.max(F.col("x")[i]) for i in range(width)]).alias("_high"),
    )
    usable = F.filter("allowed", lambda i: F.get(F.col("_high"), i) > F.get(F.col("_low"), i))
    with_usable = ranges.withColumn("_usable", usable)
    pick = F.floor(_uniform(*_NODE, F.lit(seed + 1)) * F.size("_usable")).cast("int")
    grows = (F.col("size") > 1) & (F.lit(depth) < F.col("limit")) & (F.size("_usable") > 0)
    chosen = with_usable.withColumn("feature", F.when(grows, F.get(F.col("_usable"), pick)))
    low, high = F.get("_low", F.col("feature")), F.get("_high", F.col("feature"))
    threshold = low + _uniform(*_NODE, F.lit(seed + 2)) * (high - low)
    return chosen.select(*_NODE, F.lit(depth).alias("depth"), "size", "psi", "feature", F.when(threshold < high, threshold).otherwise(low).alias("threshold"))


# ---------------------------------------------------------------- trees of a task


def grown(x: np.ndarray, limit: int, allowed: np.ndarray, draw: np.random.Generator) -> dict[str, np.ndarray]:
    """The tree over the sample ``x`` (a line for each feature), its nodes level by level: ``node, depth, size, feature`` (-1 for a leaf), ``threshold``
    and ``left``, the place of the lower child, which the upper one follows (a leaf has its own).

    A node tries its features in a random order until one has a range, so it splits on each of those that have one with equal chances.
    """
    rows, starts, nodes, levels, first = np.arange(x.shape[1]), np.zeros(1, dtype=np.intp), np.ones(1, dtype=np.int64), [], 0
    for depth in range(limit + 1):
        count = len(starts)
        sizes = np.diff(np.append(starts, len(rows)))
        feature, threshold, left = np.full(count, -1, dtype=np.int32), np.zeros(count), np.arange(first, first + count)
        trying = np.flatnonzero(sizes > 1) if depth < limit else np.empty(0, dtype=np.intp)
        order, share = np.argsort(draw.random((count, len(allowed))), axis=1), draw.random(count)
        owner = np.repeat(np.arange(count), sizes)
        some, of = rows, owner  # the rows of the nodes that still look for a feature
        for attempt in range(len(allowed)):
            if not len(trying):
                break
            if len(trying) < count or attempt:
                wanted = np.zeros(count, dtype=bool)
                wanted[trying] = True
                own = wanted[of]
                some, of = some[own], of[own]
            at = allowed[order[trying, attempt]]
            value = x[np.repeat(at, sizes[trying]), some]
            begin = np.cumsum(sizes[trying]) - sizes[trying]
            low, high = np.minimum.reduceat(value, begin), np.maximum.reduceat(value, begin)
            found = high > low
            cut = low + share[trying] * (high - low)
            feature[trying[found]], threshold[trying[found]] = at[found], np.where(cut < high, cut, low)[found]
            trying = trying[~found]
        inner = feature >= 0
        left[inner] = first + count + 2 * np.arange(inner.sum())
        levels.append((nodes, np.full(count, depth, dtype=np.int32), sizes, feature, threshold, left))
        if not inner.any():
            break
        stays = inner[owner]
        rows, owner = rows[stays], owner[stays]
        upper = x[feature[owner], rows] > threshold[owner]
        child = 2 * (np.cumsum(inner) - 1)[owner] + upper
        # Lower rows of a node come before its upper ones.
        lower_before = np.cumsum(~upper) - ~upper
        begin = np.cumsum(sizes[inner]) - sizes[inner]
        lowers = np.add.reduceat(~upper, begin, dtype=np.intp)
        parent = child >> 1
        rank = lower_before - lower_before[begin][parent]
        place = np.where(upper, begin[parent] + lowers[parent] + (np.arange(len(rows)) - begin[parent] - rank), begin[parent] + rank)
        moved = np.empty_like(rows)
        moved[place] = rows
        rows, starts = moved, np.column_stack([begin, begin + lowers]).ravel()
        nodes = np.column_stack([2 * nodes[inner], 2 * nodes[inner] + 1]).ravel()
        first += count
    return dict(zip(("node", "depth", "size", "feature", "threshold", "left"), map(np.concatenate, zip(*levels, strict=True)), strict=True))


def _psi(cell: Cell, rows: int) -> int:
    return min(AUTO_SAMPLE, rows) if cell.sample == "auto" else max(1, int(rows * cell.sample))


def _depth_limit(psi: int) -> int:
    return (max(psi, 2) - 1).bit_length()


def _hash(values: np.ndarray) -> np.ndarray:
    """Splitmix64."""
    z = values + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def forest_trees(route: str, number: int, cell: Cell, x: np.ndarray, keys: np.ndarray, seed: int, only=None):
    """``tree, psi, nodes`` of a route's trees in cell ``number``; ``x`` are the training rows, a line for each feature. Rows are dealt as in
    :func:`draw_samples`, by their ``keys``. ``only`` leaves out the trees for which it is false."""
    rows = x.shape[1]
    psi = _psi(cell, rows)
    per_pass, hands, wanted = rows // psi, None, max(1, int(cell.feature_share * len(x)))
    for tree in range(cell.trees):
        turn, hand = divmod(tree, per_pass)
        if only is not None and not only(tree):
            continue
        if hands is None or hands[0] != turn:
            mixed = _hash(keys ^ _hash(np.array([zlib.crc32(f"{number} {turn} {seed}".encode())], dtype=np.uint64)))
            hands = turn, ((mixed >> np.uint64(11)) / float(1 << 53) * rows / psi).astype(np.int64)
        draw = np.random.default_rng([seed, zlib.crc32(str(route).encode()), number, tree])
        allowed = np.sort(draw.permutation(len(x))[:wanted])
        own = np.flatnonzero(hands[1] == hand)
        if len(own):
            yield tree, psi, grown(np.take(x, own, axis=1), _depth_limit(psi), allowed, draw)


def _paths(nodes: dict[str, np.ndarray], psi: int) -> np.ndarray:
    n = np.maximum(nodes["size"], 1).astype(float)
    return (nodes["depth"] + _mean_path(n)) / (_mean_path(np.array([float(psi)]))[0] if psi > 2 else 1.0)


def _mean_path(n: np.ndarray) -> np.ndarray:
    m = np.maximum(n, 3.0)
    return np.where(n > 2, 2 * (np.log(m - 1) + np.euler_gamma) - 2 * (m - 1) / m, np.where(n == 2, 1.0, 0.0))


def _node_batch(route: str, number: int, tree: int, psi: int, nodes: dict[str, np.ndarray]) -> pa.RecordBatch:
    leaf, count = nodes["feature"] < 0, len(nodes["node"])
    columns = [
        pa.repeat(pa.scalar(route, pa.string()), count), pa.array(np.full(count, number, dtype=np.int32)), pa.array(np.full(count, tree, dtype=np.int32)), pa.array(nodes["node"]),
        pa.array(nodes["depth"]), pa.array(nodes["size"].astype(np.int64)), pa.array(np.full(count, float(psi))), pa.array(nodes["feature"], mask=leaf), pa.array(nodes["threshold"], mask=leaf),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in NODE_SCHEMA.split(", ")])


class _Unit:
    """The work of one task: training rows of a route, and rows to be scored."""

    def __init__(self, key: tuple[str, int]):
        self.key, self._x, self._keys, self._blocks, self._given, self._rows = key, [], [], [], [], 0

    def hold(self, part: pa.RecordBatch) -> None:
        x = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
        if part.column(4).null_count:
            self._x.append(x.T.copy())
            self._keys.append(part.column(3).to_numpy().view(np.uint64))
            return
        self._blocks += [(slice(self._rows + i, self._rows + min(i + trees.BLOCK, len(x))), x[i : i + trees.BLOCK].T.copy()) for i in range(0, len(x), trees.BLOCK)]
        self._given.append(part.column(4))
        self._rows += len(x)

    def train(self) -> tuple[np.ndarray, np.ndarray]:
        x, self._x = np.concatenate(self._x, axis=1), []
        keys, self._keys = np.concatenate(self._keys), []
        return x, keys

    def scored(self, cells: Sequence[tuple[int, Cell]], seed: int):
        if not self._x or not self._rows:  # no training rows, no forest
            return
        x, keys = self.train()
        given = pa.concat_arrays(self._given)
        route = pa.repeat(pa.scalar(self.key[0], pa.string()), self._rows)
        for number, cell in cells:
            sums, count = np.zeros(self._rows), 0
            for _, psi, nodes in forest_trees(self.key[0], number, cell, x, keys, seed):
                leaf, gain = nodes["feature"] < 0, _paths(nodes, psi)
                column, bound = np.where(leaf, 0, nodes["feature"]).astype(np.intp), np.where(leaf, np.inf, nodes["threshold"])
                for rows, _, _, place in trees.descend(self._blocks, column, bound, nodes["left"], int(nodes["depth"][-1])):
                    sums[rows] += gain[place]
                count += 1
            if not count:
                continue
            score = pa.array(np.exp2(-sums / count))
            yield pa.RecordBatch.from_arrays([route, pa.array(np.full(self._rows, number, dtype=np.int32)), *given.flatten(), score], [S.ROUTE, "cell", "part", "y_true", "score"])

    def nodes(self, cells: Sequence[tuple[int, Cell]], seed: int, only):
        if self._x:
            x, keys = self.train()
            for number, cell in cells:
                for tree, psi, found in forest_trees(self.key[0], number, cell, x, keys, seed, only):
                    yield _node_batch(self.key[0], number, tree, psi, found)


def _units(rows: DataFrame, work: Callable, schema: str, units: int) -> DataFrame:
    """``work`` of every (route, unit) of ``rows`` (route, ``_unit``, ``_x``, ``_key``, ``_row``: null for a training row)."""
    dealt = rows.repartition(8 * units, S.ROUTE, "_unit").sortWithinPartitions(S.ROUTE, "_unit", F.col("_row").isNotNull())

    def run(batches):
        unit = None
        for batch in batches:
            for key, at, size in tiles.stretches(batch, batch.column(4).is_null().to_numpy(zero_copy_only=False)):
                if unit is None or unit.key != key:
                    if unit is not None:
                        yield from work(unit)
                    unit = _Unit(key)
                unit.hold(batch.slice(at, size))
        if unit is not None:
            yield from work(unit)

    return dealt.mapInArrow(run, schema)


def _sizes(rows: DataFrame, train: Column, small: int) -> DataFrame:
    """Per route, ``_train`` and ``_chunks``: training rows, and how many tasks' rows all its rows are."""
    known = rows.where(F.col(S.ROUTE).isNotNull())
    return stored(known.groupBy(S.ROUTE).agg(F.count_if(train).alias("_train"), F.ceil(F.count("*") / small).cast("int").alias("_chunks")), "sizes")


def _copied(rows: DataFrame, features: Sequence[str], row_key: str, sizes: DataFrame, copies: Column, given: Column) -> DataFrame:
    """Rows for :func:`_units`, one copy for each number in the array ``copies``."""
    joined = join_group_values(rows, sizes, [S.ROUTE], source=rows, how="inner")
    return joined.select(S.ROUTE, F.explode(copies).alias("_unit"), tiles.inputs(features).alias("_x"), F.xxhash64(row_key).alias("_key"), given.alias("_row"))


def _shares(cells: Sequence[tuple[int, Cell]], slots: int) -> list[list[tuple[int, Cell]]]:
    """The cells dealt out evenly: a step down a tree costs much the same, and trees of all rows are about twice as deep."""
    shares, load = [[] for _ in range(slots)], [0.0] * slots
    cost = {number: cell.trees * (8 if cell.sample == "auto" else 16 + 8 * cell.sample) for number, cell in cells}
    for number, cell in sorted(cells, key=lambda c: -cost[c[0]]):
        least = load.index(min(load))
        shares[least].append((number, cell))
        load[least] += cost[number]
    return shares


def _tasks(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def grid_scores(rows: DataFrame, features: Sequence[str], cells: Sequence[Cell], ids: Sequence[int], row_key: str, seed: int = 42, small: int = TASK_ROWS) -> DataFrame:
    """``part, y_true, score`` for every row (with ``part`` and ``y_true``) and cell of ``ids``: the raw score of the route's forest, as :func:`grow`
    and :func:`raw_scores` give it. Routes without training rows have no forest, and no scores."""
    own = [(i, cells[i]) for i in ids]
    is_train = F.col("part") == "train"
    sizes = _sizes(rows, is_train, small)
    # So many tasks share the cells of a route that all cores have work.
    slots = max(1, min(len(own), math.ceil(2 * _tasks(rows) / max(1, sizes.agg(F.sum("_chunks")).first()[0] or 1))))
    fits = sizes.where(f"_train BETWEEN 1 AND {small}")
    given = F.struct(F.col("part"), F.col("y_true"))
    chunk = F.pmod(F.xxhash64(row_key, *features), F.col("_chunks")).cast("int")
    each = _copied(rows, features, row_key, fits, F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), lambda s: s + chunk * slots), given)
    train = _copied(rows.where(is_train), features, row_key, fits, F.sequence(F.lit(0), F.col("_chunks") * slots - 1), F.lit(None).cast(each.schema["_row"].dataType))
    shares = _shares(own, slots)
    schema = f"{S.ROUTE} string, cell int, part string, y_true {rows.schema['y_true'].dataType.simpleString()}, score double"
    units = slots * max(1, fits.agg(F.sum("_chunks")).first()[0] or 1)
    scores = _units(each.unionAll(train), lambda unit: unit.scored(shares[unit.key[1] % slots], seed), schema, units)
    large = sizes.where(F.col("_train") > small).select(S.ROUTE)
    if large.isEmpty():
        return scores
    parts, points = [scores], rows.join(F.broadcast(large), S.ROUTE, "left_semi")
    for number, _ in own:
        nodes = stored(grow(points.where(is_train), features, cells, row_key, seed, small, chosen=large.withColumn("cell", F.lit(number))), "nodes")
        raw = raw_scores(points, nodes, features, [number])
        parts.append(raw.select(S.ROUTE, F.lit(number).alias("cell"), "part", "y_true", F.col("raw")[0].alias("score")).where("score IS NOT NULL"))
    return reduce(DataFrame.unionAll, parts)


# ---------------------------------------------------------------- forests that are kept


def _finish(rows: DataFrame, depth: int, seed: int) -> DataFrame:
    """The whole subtrees of nodes whose rows fit a task, one node per group."""

    def subtree(key: tuple, group: pa.Table) -> pa.Table:
        route, cell, tree, top = (k.as_py() for k in key)
        x = group.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(group), -1).T.copy()
        draw = np.random.default_rng([seed, zlib.crc32(str(route).encode()), cell, tree, top])
        psi, limit, allowed = (group.column(c)[0].as_py() for c in ("psi", "limit", "allowed"))
        nodes = grown(x, max(0, limit - depth), np.asarray(allowed), draw)
        below = nodes["depth"].astype(np.int64)
        nodes["node"] += (top - 1) << below  # numbered below ``top``
        nodes["depth"] += np.int32(depth)
        return pa.Table.from_batches([_node_batch(route, cell, tree, psi, nodes)])

    return rows.groupBy(*_NODE).applyInArrow(subtree, NODE_SCHEMA)


def grow(
    train: DataFrame, features: Sequence[str], cells: Sequence[Cell], row_key: str, seed: int = 42, small: int = TASK_ROWS, chosen: DataFrame | None = None
) -> DataFrame:
    """The node table of all forests, or of those of the routes and cells in ``chosen``.

    Routes of up to ``small`` rows are grown in tasks. For others the rows of large nodes and their splits are written to the shared folder level by level,
    for some trees at a time, which keeps the plan short and lets the job survive lost executors.
    """
    own = list(enumerate(cells))
    if chosen is not None:
        chosen = stored(chosen.select(S.ROUTE, F.col("cell").cast("int").alias("cell")), "chosen")
        wanted = {r["cell"] for r in chosen.select("cell").distinct().collect()}  # cells of the grid
        own = [(i, c) for i, c in own if i in wanted]
        train = train.join(chosen.select(S.ROUTE).distinct(), S.ROUTE, "left_semi")
    sizes = _sizes(train, F.lit(True), small)
    routes = max(1, sizes.count())
    slots = max(1, min(max((c.trees for _, c in own), default=1), math.ceil(2 * _tasks(train) / (routes * max(1, len(own))))))
    fits = sizes.where(F.col("_train") <= small)
    # A unit is a cell and a share of its trees.
    if chosen is None:
        units = fits.withColumn("_cells", F.array(*[F.lit(i).cast("int") for i, _ in own]))
    else:
        units = fits.join(chosen.groupBy(S.ROUTE).agg(F.collect_set("cell").alias("_cells")), S.ROUTE)
    copies = F.flatten(F.transform("_cells", lambda c: F.sequence(c * slots, c * slots + slots - 1)))
    rows = _copied(train, features, row_key, units, copies, F.lit(None).cast("struct<part: string>"))
    by_number = dict(own)

    def work(unit: _Unit):
        number, share = divmod(unit.key[1], slots)
        return unit.nodes([(number, by_number[number])], seed, lambda tree: tree % slots == share)

    nodes = _units(rows, work, NODE_SCHEMA, routes * slots * max(1, len(own)))
    large = sizes.where(F.col("_train") > small)
    most = large.agg(F.max("_train")).first()[0]
    if most is None:
        return nodes
    hot = train.join(F.broadcast(large.select(S.ROUTE)), S.ROUTE, "left_semi")
    parts, turn = [nodes], max(1, SAMPLED_ROWS // most)
    for low in range(0, max(c.trees for _, c in own), turn):
        part = F.col("tree").between(low, low + turn - 1) & F.col("cell").isin([i for i, _ in own])
        with short_lived(train.sparkSession) as kept:
            samples = draw_samples(hot, features, cells, row_key, seed, part)
            samples = samples if chosen is None else samples.join(F.broadcast(chosen), [S.ROUTE, "cell"], "left_semi")
            parts.append(kept(_grown_by_levels(samples, len(features), seed, small), "forest"))
    return reduce(DataFrame.unionAll, parts)


def _grown_by_levels(samples: DataFrame, width: int, seed: int, small: int) -> DataFrame:
    rows = stored(samples, "samples")
    parts, depth = [], 0
    while True:
        sizes = stored(rows.groupBy(*_NODE).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > small).select(*_NODE), "large")
        if sizes.isEmpty():
            return reduce(DataFrame.unionAll, [*parts, _finish(rows, depth, seed)])
        parts.append(_finish(rows.join(sizes, _NODE, "left_anti"), depth, seed))
        large = rows.join(sizes, _NODE, "left_semi")
        nodes = stored(_split_nodes(large, width, depth, seed), "nodes")
        parts.append(nodes)
        inner = nodes.filter(F.col("feature").isNotNull()).select(*_NODE, "feature", "threshold")
        right = (F.get("x", F.col("feature")) > F.col("threshold")).cast("bigint")
        rows = stored(large.join(inner, _NODE).withColumn("node", F.col("node") * 2 + right).drop("feature", "threshold"), "rows")
        depth += 1


def average_path(n: Column) -> Column:
    """Mean depth of an unsuccessful search among n keys."""
    return F.when(n > 2, 2 * (F.log(n - 1) + float(np.euler_gamma)) - 2 * (n - 1) / n).when(n == 2, 1.0).otherwise(0.0)


def raw_scores(points: DataFrame, nodes: DataFrame, features: Sequence[str], cells: Sequence[int], **options) -> DataFrame:
    """``raw``: one score in 0..1 per cell, high for points that are isolated early; null where the point's route has no such forest.

    The forests of any number and size meet the points of their routes in chunks (:mod:`wakeline.ml.trees`, which takes ``options``).
    """
    scale = F.when(F.col("psi") > 2, average_path(F.col("psi"))).otherwise(1.0)
    path = (F.col("depth") + average_path(F.col("size").cast("double"))) / scale
    walked = trees.mean_values(points, tiles.inputs(features), nodes.withColumn("value", path), cells, "raw", **options)
    return walked.withColumn("raw", F.transform("raw", lambda depth: F.pow(F.lit(2.0), -depth)))


def contamination(route: Column) -> Column:
    value = F.lit(CONTAMINATION_ELSE)
    for name, share in CONTAMINATION.items():
        value = F.when(route == name, share).otherwise(value)
    return value

