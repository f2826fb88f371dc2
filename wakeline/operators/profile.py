"""Profiling operators: missing values, distinct values, consistency of trips, distributions."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wakeline.operators.layout import join_group_values
from wakeline.operators.scan import group_percentiles


def _long(stats: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    """One aggregate row, one column each -> (column, value) rows."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias(value)) for c in columns]
    return stats.select(F.inline(F.array(*entries)))


def missing_percent(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls per column in percent, 5 decimals; an unknown column warns and counts 0."""
    columns = list(columns or df.columns)
    for c in columns:
        if c not in df.columns:
            warnings.warn(f"Column '{c}' not found in dataframe")

    def share(c: str) -> Column:
        if c not in df.columns:
            return F.lit(0.0)
        return F.round(F.count_if(F.col(c).isNull()) / F.count("*") * 100, 5)

    return _long(df.agg(*[share(c).alias(c) for c in columns]), columns, "missing_percent")


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, counted exactly in one run of the input, whatever the number of columns."""
    columns = list(columns or df.columns)
    if approximate:
        return _long(df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]), columns, "distinct_values")
    values = _cells(df, columns).groupBy("column", "value").agg(F.count("*").alias("rows"))
    return values.groupBy("column").agg(F.count("value").alias("distinct_values"))


def _cells(df: DataFrame, columns: Sequence[str], *extra: Column) -> DataFrame:
    """``column, value`` of every cell, so that all columns are counted in one run of the input. Values are told apart by their texts."""

    def text(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
            return F.to_json(F.struct(c))
        return (F.col(c) + F.lit(0).cast(kind) if isinstance(kind, T.FractionalType) else F.col(c)).cast("string")  # -0 is 0

    entries = [F.struct(F.lit(c).alias("column"), F.when(F.col(c).isNotNull(), text(c)).alias("value")) for c in columns]
    return df.select(*extra, F.inline(F.array(*entries)))


def changed_columns(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns of both frames whose number of distinct values differs; each frame is run once, and their values meet in one aggregation."""
    columns = [c for c in before.columns if c in after.columns]
    sides = (_cells(df, columns, F.lit(side).alias("side")) for side, df in enumerate((before, after)))
    values = reduce(DataFrame.unionAll, sides).groupBy("column", "value").agg(F.count_if(F.col("side") == 0).alias("n0"), F.count_if(F.col("side") == 1).alias("n1"))
    known = F.col("value").isNotNull()
    counts = values.groupBy("column").agg(F.count_if(known & (F.col("n0") > 0)).alias("distinct_before"), F.count_if(known & (F.col("n1") > 0)).alias("distinct_after"))
    return counts.filter(F.col("distinct_before") != F.col("distinct_after"))


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values with count and share in percent (share of all rows)."""
    rows = df.agg(F.count("*").alias("n")).scalar()
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    top = counts.orderBy(F.desc("rows"), F.asc(column)).limit(k)
    return top.withColumn("share_percent", F.col("rows") / rows * 100)


def first_values(df: DataFrame, column: str, k: int = 10, where: Column | None = None) -> DataFrame:
    """The k smallest distinct values, as examples for an audit."""
    values = df.filter(F.col(column).isNotNull()).select(column)
    if where is not None:
        values = values.filter(where)
    return values.distinct().orderBy(column).limit(k)


def _trip_values(df: DataFrame, column: str, trip: str) -> DataFrame:
    """(trip, value, rows): the one small shuffle all trip consistency checks share."""
    return df.groupBy(trip, column).agg(F.count("*").alias("rows"))


def trip_consistency(df: DataFrame, column: str, trip: str = "TripID") -> DataFrame:
    """Per trip: distinct values, rows with and without a value, and whether they are mixed."""
    per_trip = _trip_values(df, column, trip).groupBy(trip).agg(
        F.count(column).alias("distinct_values"),
        F.sum(F.when(F.col(column).isNull(), F.col("rows")).otherwise(0)).alias("null_rows"),
        F.sum(F.when(F.col(column).isNotNull(), F.col("rows")).otherwise(0)).alias("value_rows"),
    )
    mixed = (F.col("null_rows") > 0) & (F.col("distinct_values") > 0)
    return per_trip.withColumn("mixed", mixed).withColumn("inconsistent", mixed | (F.col("distinct_values") > 1))


def inconsistent_trips(df: DataFrame, column: str, trip: str = "TripID") -> DataFrame:
    """Trips with several values, or with a value and a gap."""
    return trip_consistency(df, column, trip).filter("inconsistent").select(trip)


def mixed_trips(df: DataFrame, column: str, trip: str = "TripID") -> DataFrame:
    """Trips with both a value and a gap."""
    return trip_consistency(df, column, trip).filter("mixed").select(trip)


def known_trips(df: DataFrame, column: str, trip: str = "TripID") -> DataFrame:
    """Trips with any value."""
    return trip_consistency(df, column, trip).filter(F.col("value_rows") > 0).select(trip)


def values_of_gappy_trips(df: DataFrame, column: str, trip: str = "TripID") -> DataFrame:
    """The distinct values (null included) of each trip with a missing value, one row per value.

    Long form: no trip's value list has to fit one row.
    """
    values = _trip_values(df, column, trip).select(trip, column)
    gappy = df.filter(F.col(column).isNull()).select(trip).distinct()
    return values.join(gappy, trip, "left_semi")


def trip_modes(df: DataFrame, column: str, trip: str = "TripID") -> DataFrame:
    """Most frequent value per trip, the smallest on ties."""
    counts = _trip_values(df, column, trip).filter(F.col(column).isNotNull())
    return counts.groupBy(trip).agg(F.min_by(column, F.struct(-F.col("rows"), F.col(column))).alias("mode"))


def trip_medians(df: DataFrame, column: str, trip: str = "TripID") -> DataFrame:
    return group_percentiles(df, [trip], column, [0.5], ["median"])


def fill_report(before: DataFrame, after: DataFrame, column: str, trip: str = "TripID") -> DataFrame:
    """Missing percent and inconsistent trips of a column, before and after a fill."""

    def stage(df: DataFrame, label: str) -> DataFrame:
        trips = trip_consistency(df, column, trip)
        return trips.agg(
            F.lit(label).alias("stage"),
            F.round(F.sum("null_rows") / F.sum(F.col("null_rows") + F.col("value_rows")) * 100, 5).alias("missing_percent"),
            F.count_if("inconsistent").alias("inconsistent_trips"),
        )

    return stage(before, "before").unionByName(stage(after, "after"))


_BUCKETS = 1024


def _smallest(df: DataFrame, keys: Sequence[str], value: str, k: int) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(value)
    return df.withColumn("_rank", F.row_number().over(by)).filter(F.col("_rank") <= k).drop("_rank")


def mixed_type_audit(df: DataFrame, columns: Sequence[str] | None = None, examples: int = 5) -> DataFrame:
    """Per text column: how many values read as numbers, how many do not, and sample texts."""
    columns = list(columns or df.columns)
    # One row per distinct (column, text): examples and counts come from these, not from all rows.
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text")) for c in columns]))
    texts = df.select(pairs.alias("p")).filter(F.col("p.text").isNotNull())
    counted = texts.groupBy("p.column", "p.text").agg(F.count("*").alias("rows"))
    is_number = F.col("text").try_cast("double").isNotNull()
    counted = counted.withColumn("is_number", is_number)
    sums = counted.groupBy("column").agg(
        F.sum(F.when(F.col("is_number"), F.col("rows")).otherwise(0)).alias("numbers"),
        F.sum(F.when(~F.col("is_number"), F.col("rows")).otherwise(0)).alias("texts"),
    )
    # The smallest texts of each of many buckets, then the smallest of those: no task sorts a column.
    bucketed = counted.filter(~F.col("is_number")).withColumn("_bucket", F.pmod(F.xxhash64("text"), F.lit(_BUCKETS)))
    few = _smallest(bucketed, ["column", "_bucket"], "text", examples)
    ranked = _smallest(few, ["column"], "text", examples)
    shown = ranked.groupBy("column").agg(F.concat_ws("|", F.array_sort(F.collect_list("text"))).alias("examples"))
    return (
        sums.join(F.broadcast(shown), "column", "left")  # at most `examples` texts per column
        .withColumn("examples", F.coalesce("examples", F.lit("")))
        .withColumn("mixed", (F.col("numbers") > 0) & (F.col("texts") > 0))
    )


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson correlation per pair over the rows where both are known."""
    stats = df.agg(*[F.corr(a, b).alias(f"{a}_{b}") for a, b in pairs])
    entries = [F.struct(F.lit(f"{a}-{b}").alias("pair"), F.col(f"{a}_{b}").alias("correlation")) for a, b in pairs]
    return stats.select(F.inline(F.array(*entries)))


def missing_map(df: DataFrame, bucket: Column, columns: Sequence[str]) -> DataFrame:
    """Nulls per row bucket and column: the data of a missing-value heat map."""
    per_bucket = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns]
    return per_bucket.select("bucket", "rows", F.inline(F.array(*entries)))


def histogram(df: DataFrame, value: str, group: str, bins: int = 100) -> DataFrame:
    """Counts per equal-width bin, bins spread over the group's own value range."""
    ranges = df.groupBy(group).agg(F.min(value).alias("_min"), F.max(value).alias("_max"))
    # Collapse equal values first: a hot group then joins as its distinct values.
    counts = df.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("_n"))
    binned = join_group_values(counts, ranges, [group], source=df).withColumn(
        "bin",
        F.when(F.col("_max") == F.col("_min"), bins // 2)
        .otherwise(F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("_min")) * bins / (F.col("_max") - F.col("_min")))))
        .cast("int"),
    )
    return binned.groupBy(group, "bin").agg(F.sum("_n").alias("rows"))


def box_quantiles(df: DataFrame, value: str, group: str) -> DataFrame:
    """Minimum, quartiles and maximum per group."""
    return group_percentiles(df, [group], value, [0.0, 0.25, 0.5, 0.75, 1.0], ["low", "q1", "median", "q3", "high"])


def table_counts(df: DataFrame, trip: str = "TripID", start: str = "StartPort", end: str = "EndPort") -> DataFrame:
    """Rows, trips and ports of a table, in one run of it."""
    names = {trip: "trips", start: "start_ports", end: "end_ports"}
    values = _cells(df, list(names)).groupBy("column", "value").agg(F.count("*").alias("rows"))
    counts = values.groupBy("column").agg(F.sum("rows").alias("rows"), F.count("value").alias("distinct"))
    whole = counts.agg(F.max("rows").alias("rows"), *[F.max(F.when(F.col("column") == c, F.col("distinct"))).alias(n) for c, n in names.items()])
    entries = [F.struct(F.lit(n).alias("what"), F.coalesce(F.col(n), F.lit(0).cast("long")).alias("n")) for n in ("rows", *names.values())]
    return whole.select(F.inline(F.array(*entries)))
