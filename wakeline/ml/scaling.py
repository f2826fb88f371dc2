"""Scaling as aggregates: standard score per group, min-max over windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline import schema as S
from wakeline.operators.layout import join_group_values


def moments(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (S.ROUTE,)) -> DataFrame:
    """Mean and population standard deviation per group; a constant column scales by 1."""
    stats = []
    for c in columns:
        deviation = F.stddev_pop(c)
        # Rounding can leave a tiny deviation for a constant column.
        constant = F.min(c) == F.max(c)
        stats += [F.avg(c).alias(f"{c}_mean"), F.when(constant, 1.0).otherwise(deviation).alias(f"{c}_std")]
    return df.groupBy(*keys).agg(*stats)


def standardise(
    df: DataFrame, stats: DataFrame, columns: Sequence[str], keys: Sequence[str] = (S.ROUTE,), centre: bool = True
) -> DataFrame:
    """(x - mean) / std, or x / std without centring."""
    joined = join_group_values(df, stats, keys)
    scaled = {}
    for c in columns:
        shifted = F.col(c) - F.col(f"{c}_mean") if centre else F.col(c)
        scaled[c] = shifted / F.col(f"{c}_std")
    return joined.withColumns(scaled).drop(*[f"{c}_{s}" for c in columns for s in ("mean", "std")])


def window_ranges(windows: DataFrame, width: int) -> DataFrame:
    """Per route, the smallest and largest value of each window feature."""
    cells = windows.select(S.ROUTE, F.explode("features").alias("v"))
    lows = [F.min(F.col("v")[i]).alias(f"lo{i}") for i in range(width)]
    highs = [F.max(F.col("v")[i]).alias(f"hi{i}") for i in range(width)]
    ranges = cells.groupBy(S.ROUTE).agg(*lows, *highs)
    return ranges.select(
        S.ROUTE,
        F.array(*[f"lo{i}" for i in range(width)]).alias("lows"),
        F.array(*[F.when(F.col(f"hi{i}") > F.col(f"lo{i}"), F.col(f"hi{i}") - F.col(f"lo{i}")).otherwise(1.0) for i in range(width)]).alias("spans"),
    )


def scale_windows(windows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Window features to 0..1 of the fitted ranges; values outside them go beyond."""
    scaled = F.transform(
        "features", lambda row: F.transform(row, lambda x, i: (x - F.get(F.col("lows"), i)) / F.get(F.col("spans"), i))
    )
    return join_group_values(windows, ranges, [S.ROUTE], how="inner").withColumn("features", scaled).drop("lows", "spans")
