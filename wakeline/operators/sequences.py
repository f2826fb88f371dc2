"""Sliding windows over trips and the way back from window errors to point scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.operators.layout import Layout
from wakeline.operators.scan import position, scan, total

LENGTH, STEP = 15, 7


def with_positions(df: DataFrame, layout: Layout) -> DataFrame:
    """0-based position ``pos`` and trip size ``n_points``."""
    out = scan(df, layout, _pos=position(), n_points=total(F.lit(1)))
    return out.withColumn("pos", (F.col("_pos") - 1).cast("int")).withColumn("n_points", F.col("n_points").cast("int")).drop("_pos")


def last_start(size: Column, length: int, inclusive: bool, pad_short: bool) -> Column:
    """Largest possible window start of a trip, negative if it has no window.

    The training rule stops one window early (``range(0, n - length - 1)``); ``inclusive``
    also uses the windows up to the trip's end. ``pad_short`` gives trips shorter than a
    window one window at 0.
    """
    last = size - length if inclusive else size - length - 2
    return F.when(size < length, 0).otherwise(last) if pad_short else last


def window_starts(positioned: DataFrame, length: int = LENGTH, step: int = STEP, inclusive: bool = False, pad_short: bool = False) -> DataFrame:
    """(trip, start) of every window, from the rows that start one."""
    last = last_start(F.col("n_points"), length, inclusive, pad_short)
    starts = positioned.filter((F.col("pos") % step == 0) & (F.col("pos") <= last))
    return starts.select(S.ROUTE, S.TRIP, F.col("pos").alias("start_pos"), "n_points")


def build_windows(
    positioned: DataFrame,
    features: Sequence[str],
    label: str | None = "y_true",
    length: int = LENGTH,
    step: int = STEP,
    inclusive: bool = False,
    pad_short: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per window: ``features`` as array<array<double>> and ``label`` 1 if all points are.

    Each point goes to the at most ``ceil(length / step)`` windows that cover it, and a window
    groups at most ``length`` points; so no trip is ever collected as a whole. Where rows are
    already hashed by trip, the grouping needs no further shuffle. ``keep`` names columns that are
    the same on all points of a trip.
    """
    last = last_start(F.col("n_points"), length, inclusive, pad_short)
    first_index = F.greatest(F.lit(0), F.ceil((F.col("pos") - length + 1) / step).cast("int"))
    last_index = F.floor(F.least(F.col("pos"), last) / step).cast("int")
    covered = positioned.withColumn("_first", first_index).withColumn("_last", last_index)
    covered = covered.filter((last >= 0) & (F.col("_first") <= F.col("_last")))
    values = F.array(*[F.col(c).cast("double") for c in features])
    cells = covered.select(
        S.ROUTE,
        S.TRIP,
        "n_points",
        *keep,
        F.explode(F.sequence(F.col("_first") * step, F.col("_last") * step, F.lit(step))).alias("start_pos"),
        F.struct("pos", values.alias("values")).alias("_cell"),
        (F.coalesce(F.col(label).cast("int"), F.lit(0)) if label else F.lit(0)).alias("_label"),
    )
    windows = cells.groupBy(S.TRIP, "start_pos").agg(
        F.max(S.ROUTE).alias(S.ROUTE),
        F.max("n_points").alias("n_points"),
        *[F.max(c).alias(c) for c in keep],
        F.array_sort(F.collect_list("_cell")).alias("_cells"),
        F.min("_label").alias("label"),
    )
    return windows.select(S.ROUTE, S.TRIP, "start_pos", "n_points", pad(F.col("_cells.values"), length).alias("features"), "label", *keep)


def pad(cells: Column, length: int) -> Column:
    """Repeat the last row until the window is full."""
    lacking = F.lit(length) - F.size(cells)
    return F.when(lacking > 0, F.concat(cells, F.array_repeat(F.element_at(cells, -1), lacking))).otherwise(cells)


def point_scores(
    positioned: DataFrame, window_errors: DataFrame, error: str = "error", length: int = LENGTH, step: int = STEP, legacy_offset: bool = False
) -> DataFrame:
    """Each point takes the largest error of the windows covering it, uncovered points 0.

    ``legacy_offset`` writes the i-th window at positions i.. instead of i * step...
    """
    start = F.floor(F.col("start_pos") / step).cast("int") if legacy_offset else F.col("start_pos")
    spread = window_errors.select(
        S.TRIP, F.col(error).alias("_error"), F.explode(F.sequence(start, start + length - 1)).alias("pos")
    )
    best = spread.groupBy(S.TRIP, "pos").agg(F.max("_error").alias("score"))
    return positioned.join(best, [S.TRIP, "pos"], "left").fillna(0.0, ["score"])
