"""Cleaning operators: typing, impossible values, duplicates, trip-wise fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wakeline import schema as S
from wakeline.functions import geo, scalar, text
from wakeline.operators.layout import CHUNK, Layout, detect, join_values
from wakeline.operators.scan import Agg, group_percentiles, last_known, next_known, position, running_max, scan

TRIP_ORDER = ("time",)


# ---------------------------------------------------------------- projections and casts


def drop_columns(df: DataFrame, columns: Sequence[str] = S.UNUSED_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def cast_times(df: DataFrame, columns: Sequence[str] = S.TIME_COLUMNS) -> DataFrame:
    """Time texts to timestamps without a zone; unreadable texts become null."""
    return df.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in columns if c in df.columns})


def time_cast_report(df: DataFrame, columns: Sequence[str] = S.TIME_COLUMNS) -> DataFrame:
    """Per time column: values read and values lost by the cast."""
    present = [c for c in columns if c in df.columns]
    stats = df.agg(
        *[F.count(F.col(c).try_cast("timestamp_ntz")).alias(f"{c}_valid") for c in present],
        *[F.count(c).alias(f"{c}_all") for c in present],
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"{c}_valid").alias("valid"), (F.col(f"{c}_all") - F.col(f"{c}_valid")).alias("lost"))
        for c in present
    ]
    return stats.select(F.inline(F.array(*entries)))


def cast_categories(df: DataFrame, columns: Sequence[str] = S.CATEGORY_COLUMNS) -> DataFrame:
    """Ports and destination as text, ship type as a nullable whole number."""
    casts = {c: F.col(c).cast("string") for c in columns if c in df.columns}
    if "shiptype" in df.columns:
        casts["shiptype"] = F.col("shiptype").try_cast("double").try_cast("int")
    return df.withColumns(casts)


def cast_measures(df: DataFrame) -> DataFrame:
    """Raw texts to the raw schema's numbers; columns the schema does not know pass through."""
    known = {f.name: f.dataType for f in S.RAW_SCHEMA if isinstance(f.dataType, (T.DoubleType, T.LongType))}
    casts = {}
    for c in df.columns:
        if isinstance(known.get(c), T.DoubleType):
            casts[c] = scalar.nan_to_null(F.col(c).try_cast("double"))
        elif isinstance(known.get(c), T.LongType):
            casts[c] = F.col(c).try_cast("bigint")
    return df.withColumns(casts)


def uppercase_text(df: DataFrame, skip: Sequence[str] = ()) -> DataFrame:
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]
    return df.withColumns({c: F.upper(c) for c in names})


def null_invalid_destinations(df: DataFrame, column: str = "Destination") -> DataFrame:
    return df.withColumn(column, F.when(~text.is_invalid_destination(F.col(column)), F.col(column)))


def clean_destinations(df: DataFrame, column: str = "Destination") -> DataFrame:
    return df.withColumn(column, text.route_target(text.clean_destination(F.col(column))))


def code_destinations(df: DataFrame, column: str = "Destination") -> DataFrame:
    return df.withColumn(column, text.port_code(F.col(column)))


def _kept(c: str, valid: Column) -> Column:
    return F.when(valid, F.col(c))


def null_impossible(df: DataFrame) -> DataFrame:
    """Physically impossible measures become null."""
    rules = {c: F.col(c) > 0 for c in ("Length", "Breadth", "Draught", "shiptype")}
    rules["TH"] = F.col("TH").between(0, 360) | (F.col("TH") == 511)
    rules["COG"] = F.col("COG").between(0, 360)
    return df.withColumns({c: _kept(c, valid) for c, valid in rules.items() if c in df.columns})


def drop_fast_points(df: DataFrame, limit: float = 30.0) -> DataFrame:
    """Keep speeds below the limit; an unknown speed drops the row."""
    return df.filter(F.col("SOG") < limit)


def fill_course(df: DataFrame) -> DataFrame:
    return df.fillna({"COG": 0.0})


def fill_remaining(df: DataFrame, keys: Sequence[str] = ("TripID", "StartPort")) -> DataFrame:
    """Numbers left null become 0, texts become ``'null'``; times, flags and ``keys`` keep their nulls: a row without a trip or a route
    belongs to none, and is not gathered with others into one."""
    filled = [c for c in df.columns if c not in keys]
    return df.fillna(0, filled).fillna("null", filled)


def rename_columns(df: DataFrame) -> DataFrame:
    """Cleaned column names, plus the unlabelled anomaly flag."""
    present = {old: new for old, new in S.RENAMES.items() if old in df.columns}
    return df.withColumnsRenamed(present).withColumn("is_anomaly", F.lit(None).cast("boolean"))


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One of each set of fully equal rows. Copies collapse before the shuffle."""
    return df.dropDuplicates()


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows before and after duplicate removal, with the removed share in percent."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    sums = copies.agg(F.sum("_copies").alias("rows_before"), F.count("*").alias("rows_after"))
    removed = F.col("rows_before") - F.col("rows_after")
    return sums.select("rows_before", "rows_after", removed.alias("removed"), (removed / F.col("rows_before") * 100).alias("removed_percent"))


# ---------------------------------------------------------------- fills inside trips


def trip_layout(df: DataFrame, trip: str = "TripID", order: Sequence[str] = TRIP_ORDER, **options) -> Layout:
    return detect(df, [trip], order, **options)


def fill_ship_type(df: DataFrame, layout: Layout, column: str = "shiptype") -> DataFrame:
    """Forward fill inside the trip; nulls before the first known value stay."""
    return scan(df, layout, _filled=last_known(column)).withColumn(column, F.coalesce("_filled", column)).drop("_filled")


def fill_mode(df: DataFrame, layout: Layout, columns: Sequence[str]) -> DataFrame:
    """Every row of a trip takes the trip's most frequent value (smallest on ties).

    For a trip with one value or none this changes nothing, so only trips with mixed values
    are affected.
    """
    return fill_trip_values(df, layout, modes=columns)


def fill_median(df: DataFrame, layout: Layout, column: str = "Draught") -> DataFrame:
    """Nulls take the median of the trip, where the trip has any value."""
    return fill_trip_values(df, layout, medians=[column])


def fill_trip_values(df: DataFrame, layout: Layout, modes: Sequence[str] = (), medians: Sequence[str] = ()) -> DataFrame:
    """Mode and median fills together.

    Trips that fit a task use window aggregates. With cut trips the values come from (trip, value)
    counts, and one join brings them all to the rows.
    """
    if layout.hot is None:
        by, in_trip = Window.partitionBy(*layout.keys), F.col(layout.keys[0]).isNotNull()
        fills = {c: F.coalesce(F.when(in_trip, F.mode(F.col(c), True).over(by)), F.col(c)) for c in modes}
        fills |= {c: F.coalesce(F.col(c), F.when(in_trip, F.median(c).over(by))) for c in medians}
        return df.withColumns(fills)
    values = df.select(*layout.keys).distinct()
    for c in modes:
        counts = df.filter(F.col(c).isNotNull()).groupBy(*layout.keys, c).agg(F.count("*").alias("_n"))
        best = counts.groupBy(*layout.keys).agg(F.min_by(c, F.struct(-F.col("_n"), F.col(c))).alias(f"_mode_{c}"))
        values = values.join(best, list(layout.keys), "left")
    for c in medians:
        values = values.join(group_percentiles(df, layout.keys, c, [0.5], [f"_median_{c}"]), list(layout.keys), "left")
    filled = join_values(df, values, layout).withColumns(
        {c: F.coalesce(f"_mode_{c}", c) for c in modes} | {c: F.coalesce(c, f"_median_{c}") for c in medians}
    )
    return filled.drop(*[f"_mode_{c}" for c in modes], *[f"_median_{c}" for c in medians])


def fill_destination(
    df: DataFrame, layout: Layout, dest: str = "Destination", lat: str = "Latitude", lon: str = "Longitude", **riding: Agg
) -> DataFrame:
    """Fill unknown destinations from the nearer neighbour, walking each trip in order.

    A row without a destination compares two points: the nearest earlier row that has one,
    counting rows filled on the way, and the next row that knows one. The nearer wins, the
    earlier on a tie. Rows without coordinates are left alone.

    Once a row takes the later neighbour's value, every following unknown row up to that
    neighbour has it on both sides. So inside a gap the walk is decided by the first row that
    prefers the later side, and both questions ("which row is before me", "has any row of my gap
    switched") are running aggregates. Further aggregates of the same trips can ride on the scan.
    """
    known = F.col(dest).isNotNull()
    located = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    here = F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon"))
    value = F.struct(F.col(lat).alias("lat"), F.col(lon).alias("lon"), F.col(dest).alias("dest"))
    neighbours = scan(
        df,
        layout,
        _above=last_known(F.when(known, value), before=True),
        _below=next_known(F.when(known, value)),
        _prev=last_known(F.when(known | located, here), before=True),
        _pos=position(),
        **riding,
    )
    to_prev = geo.planar_degrees(F.col(lat), F.col(lon), F.col("_prev.lat"), F.col("_prev.lon"))
    to_below = geo.planar_degrees(F.col(lat), F.col(lon), F.col("_below.lat"), F.col("_below.lon"))
    switches = ~known & located & F.coalesce(to_prev > to_below, F.lit(False))
    walked = scan(
        neighbours.withColumn("_switch", switches),
        layout,
        _switched=running_max(F.when(F.col("_switch"), F.col("_pos"))),
        _anchor=running_max(F.when(known, F.col("_pos"))),
    )
    in_switched_gap = F.coalesce(F.col("_switched") > F.coalesce("_anchor", F.lit(0)), F.lit(False))
    filled = (
        F.when(known, F.col(dest))
        .when(~located, F.lit(None))
        .when(F.col("_above").isNull(), F.col("_below.dest"))
        .when(F.col("_below").isNull(), F.col("_above.dest"))
        .when(in_switched_gap, F.col("_below.dest"))
        .otherwise(F.col("_above.dest"))
    )
    return walked.withColumn(dest, filled).drop("_above", "_below", "_prev", "_pos", "_switch", "_switched", "_anchor")


def fill_in_trips(df: DataFrame, layout: Layout) -> DataFrame:
    """All trip-wise fills of the noise stage in one pass over the trips: destination, ship type,
    draught median, length and breadth modes. The columns do not depend on each other."""
    df = layout.pin(layout.mark(df))
    df = layout.pin(fill_trip_values(df, layout, modes=["Length", "Breadth"], medians=["Draught"]))
    df = fill_destination(df, layout, _ship=last_known("shiptype"))
    return df.withColumn("shiptype", F.coalesce("_ship", "shiptype")).drop("_ship", CHUNK)
