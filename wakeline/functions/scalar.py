"""Small column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTERVAL = r"^\s*(\d+)\s*-\s*(\d+)\s*$"


def angle_change(change: Column) -> Column:
    """Fold an absolute course difference to 0..180 degrees."""
    return F.when(change <= 180, change).otherwise(360 - change)


def iso_text(ts: Column) -> Column:
    """ISO text of a timestamp; microseconds only when there are any."""
    micros = F.date_format(ts, "SSSSSS")
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(micros == "000000", seconds).otherwise(F.concat(seconds, F.lit("."), micros))


def interval_bounds(text: Column) -> Column:
    """``"20-10"`` -> struct(10, 20); anything else -> null."""
    a = F.regexp_extract(text, _INTERVAL, 1).try_cast("int")
    b = F.regexp_extract(text, _INTERVAL, 2).try_cast("int")
    bounds = F.struct(F.least(a, b).alias("start_pos"), F.greatest(a, b).alias("end_pos"))
    return F.when(a.isNotNull() & b.isNotNull(), bounds)


def even_grid(low: float, high: float, points: int) -> list[float]:
    """``points`` evenly spaced values, both ends included."""
    step = (high - low) / (points - 1)
    return [low + i * step for i in range(points - 1)] + [high]


def nan_to_null(c: Column) -> Column:
    """Spark compares NaN as larger than any number, so missing values must be null."""
    return F.when(~F.isnan(c), c)


def half_even(c: Column, decimals: int = 0) -> Column:
    """Round halves to the even neighbour, on the scaled double (not on its decimal text)."""
    scale = F.lit(10.0**decimals)
    return F.rint(c * scale) / scale


def row_id(*columns: str) -> Column:
    """128-bit key of a row's content; 64 bits would meet collisions in a table of 10^12 rows.

    Each column goes in behind a flag for null, as the hash itself skips nulls.
    """
    marked = [x for c in columns for x in (F.isnull(c), F.col(c))]
    return F.concat(F.hex(F.xxhash64(*marked)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), *marked)))
