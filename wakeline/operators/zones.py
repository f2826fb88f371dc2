"""Points in a table of rectangles: an equi-join through grid cells, with the exact test behind it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.session import stored

FINEST, COARSEST = -8, 9
"""Sides of grid cells are powers of two, of a 256th degree to 512 degrees; only cells that are split are finer."""
DEEPEST, STEP = -32, 2
"""No cell is split on this level or below; a cell is split into those two levels finer."""
LIST = 64
"""Rectangles a cell may list before it is split."""
GROWTH = 16
"""Entries that splitting may make of an entry, over the whole table."""
CELL, BOUNDS = ["level", "x", "y"], ["lat_max", "lat_min", "lon_max", "lon_min"]
BROADCAST_RECTANGLES = 200_000
"""Rectangles and cells of some 50 bytes that may be broadcast: some 10 MB."""


def _side(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def cells(zones: DataFrame) -> DataFrame:
    """``level, x, y, rectangles``: the rectangles to test in each cell; a point lies in one of ``zones`` if a rectangle of the cells it lies in holds it.

    A rectangle lies on the level whose cells are as long as its longer side, so it touches four cells at most. A cell that one rectangle covers is itself its only rectangle,
    and nothing is kept of the cells within it. A cell with more than LIST rectangles, none of which covers it, is split: its rectangles go on to
    the sixteen cells within that they touch. So lists stay short where rectangles pile up. Splitting ends at the DEEPEST level, or when there
    would be more than GROWTH entries a rectangle (long thin ones, which cover no cell): then lists are longer, and results the same.
    """
    longer = F.greatest(F.col("lat_max") - F.col("lat_min"), F.col("lon_max") - F.col("lon_min"))
    level = F.when(longer > 0, F.ceil(F.log2(longer))).otherwise(FINEST)
    level = F.greatest(F.lit(FINEST), F.least(F.lit(COARSEST), level)).cast("int")
    known = zones.where("lat_max >= lat_min AND lon_max >= lon_min").select(*BOUNDS).distinct().withColumn("level", level)
    spread = known.withColumn("y", F.explode(_touched("lat_min", "lat_max"))).withColumn("x", F.explode(_touched("lon_min", "lon_max")))
    entries, most = stored(spread.select(*CELL, *BOUNDS), "entries"), None
    kept, covers = [], []
    while True:
        counts = stored(entries.groupBy(*CELL).agg(F.count("*").alias("_n"), F.max(_covers()).alias("_covered")), "counts")
        exact = F.greatest(F.abs(F.col("x").cast("double")), F.abs(F.col("y").cast("double"))) < 2.0**50
        split = (F.col("_n") > LIST) & ~F.col("_covered") & (F.col("level") > DEEPEST) & exact
        size = counts.agg(F.sum("_n").alias("all"), F.sum(F.when(split, F.col("_n"))).alias("split"), F.count_if("_covered").alias("covers")).first()
        most = most or GROWTH * (size["all"] or 0)
        if size["covers"]:
            covers.append(counts.where("_covered").select(*CELL, *[b.alias(name) for b, name in zip(_sides(), BOUNDS, strict=True)]))
        open_cells = counts.where("NOT _covered").select(*CELL, split.alias("_split"))
        open_entries = entries.join(open_cells, CELL)
        parts = None
        if size["split"]:
            parts = stored(_split(open_entries.where("_split")).select(*CELL, *BOUNDS), "entries")
            if parts.count() + (size["all"] - size["split"]) > most:
                parts = None
        kept.append((open_entries if parts is None else open_entries.where(~F.col("_split"))).select(*CELL, *BOUNDS))
        if parts is None:
            break
        entries = parts
    placed = reduce(DataFrame.unionAll, [*kept, *covers])
    if covers:
        placed = _uncovered(placed, reduce(DataFrame.unionAll, covers).select(*CELL).distinct())
    return placed.groupBy(*CELL).agg(F.collect_set(F.struct(*BOUNDS)).alias("rectangles"))


def _touched(low: str, high: str) -> Column:
    return F.sequence(F.floor(F.col(low) / _side(F.col("level"))), F.floor(F.col(high) / _side(F.col("level"))))


def _sides() -> list[Column]:
    """The bounds of the cell itself, in the order of BOUNDS."""
    x, y, side = F.col("x").cast("double"), F.col("y").cast("double"), _side(F.col("level"))
    return [(y + 1) * side, y * side, (x + 1) * side, x * side]


def _covers() -> Column:
    """Whether the rectangle holds all of the cell."""
    top, bottom, right, left = _sides()
    return (F.col("lat_max") >= top) & (F.col("lat_min") <= bottom) & (F.col("lon_max") >= right) & (F.col("lon_min") <= left)


def _split(entries: DataFrame) -> DataFrame:
    """Each entry in the cells of ``STEP`` levels below, within its own cell, that its rectangle touches."""
    fan = 1 << STEP

    def within(low: str, high: str, cell: str) -> Column:
        side = _side(F.col("level") - STEP)
        first, last = F.floor(F.col(low) / side), F.floor(F.col(high) / side)
        return F.explode(F.sequence(F.greatest(first, F.col(cell) * fan), F.least(last, F.col(cell) * fan + fan - 1)))

    rows = entries.withColumn("_y", within("lat_min", "lat_max", "y")).withColumn("_x", within("lon_min", "lon_max", "x"))
    return rows.select((F.col("level") - STEP).cast("int").alias("level"), F.col("_x").alias("x"), F.col("_y").alias("y"), *BOUNDS)


def _uncovered(placed: DataFrame, covered: DataFrame) -> DataFrame:
    """The entries of cells that lie in no larger covered cell."""
    covered = stored(covered, "covered")
    levels = sorted(r["level"] for r in covered.select("level").distinct().collect())
    above = F.explode(F.filter(F.array(*[F.lit(v) for v in levels]), lambda k: k > F.col("level")))
    up = placed.select(*CELL).distinct().withColumn("_level", above)
    power = _side(F.col("_level") - F.col("level"))
    up = up.select(*CELL, "_level", F.floor(F.col("x") / power).alias("_x"), F.floor(F.col("y") / power).alias("_y"))
    larger = covered.select(F.col("level").alias("_level"), F.col("x").alias("_x"), F.col("y").alias("_y"))
    hidden = up.join(larger, ["_level", "_x", "_y"], "left_semi").select(*CELL).distinct()
    return placed.join(hidden, CELL, "left_anti")


def zone_labels(points: DataFrame, zones: DataFrame, lat: str = "latitude", lon: str = "longitude", name: str = "zone") -> DataFrame:
    """``name``: 0 inside any rectangle of ``zones`` (``lat_max, lat_min, lon_max, lon_min``, bounds included), 1 outside all; unknown coordinates are outside.

    For every level in use a point looks into the one cell it lies in, and is tested against the rectangles there. The cells are broadcast if
    a count of their rectangles proves them small; else the adaptive skew join splits a cell with many points. No point is multiplied.
    """
    table = stored(cells(zones), "cells")
    levels = sorted(r["level"] for r in table.select("level").distinct().collect())
    # What one cell holds is not bounded by the number of cells: rectangles are counted.
    few = (table.agg(F.sum(F.size("rectangles") + 1)).first()[0] or 0) <= BROADCAST_RECTANGLES
    inside = F.lit(False)
    out = points.select(F.struct(*points.columns).alias("_point"), F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
    for i, level in enumerate(levels):
        side = 2.0**level
        own = table.where(F.col("level") == level).select(F.col("x").alias(f"_x{i}"), F.col("y").alias(f"_y{i}"), F.col("rectangles").alias(f"_r{i}"))
        here = (F.floor(F.col("_lon") / side) == F.col(f"_x{i}")) & (F.floor(F.col("_lat") / side) == F.col(f"_y{i}"))
        out = out.join(F.broadcast(own) if few else own, here, "left")
        hit = F.exists(f"_r{i}", lambda r: F.col("_lat").between(r["lat_min"], r["lat_max"]) & F.col("_lon").between(r["lon_min"], r["lon_max"]))
        out = out.withColumn(f"_in{i}", F.coalesce(hit, F.lit(False))).drop(f"_x{i}", f"_y{i}", f"_r{i}")
        inside = inside | F.col(f"_in{i}")
    return out.select("_point.*", F.when(inside, 0).otherwise(1).alias(name))
