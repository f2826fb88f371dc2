"""The cleaning run: merge and type, normalise destinations, handle noise."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from wakeline import schema as S
from wakeline.functions.scalar import row_id
from wakeline.operators import clean
from wakeline.operators.layout import Layout
from wakeline.sources import tables, versions

ORDER = ("time",)
_CONTENT = "_content"
Imputer = Callable[[DataFrame], DataFrame]


def merge_reports(spark: SparkSession, paths: str | Sequence[str], drop: Sequence[str] = S.UNUSED_COLUMNS) -> DataFrame:
    """Stage 1: read all files of a folder (or the listed files), unite by name, drop unused columns, type."""
    raw = tables.read_report_files(spark, paths)
    return tables.type_reports(clean.drop_columns(raw, drop))


def normalise_destinations(df: DataFrame) -> DataFrame:
    """Stage 2: upper-case plain texts, code the destinations, drop duplicates.

    Everything up to the duplicate removal is one map-side projection.
    """
    upper = clean.uppercase_text(df, skip=S.CATEGORY_COLUMNS)
    coded = clean.code_destinations(clean.clean_destinations(clean.null_invalid_destinations(upper)))
    return clean.drop_duplicates(coded)


def handle_noise(
    df: DataFrame,
    impute: Imputer | None = None,
    order: Sequence[str] = ORDER,
    layout: Layout | None = None,
) -> DataFrame:
    """Stage 3: impossible values, trip-wise fills, ship dimensions, final table.

    ``impute`` fills the ship dimensions that no report of the trip knows (see
    ``wakeline.ml.impute``). The trip-wise fills share the trip partitioning. Large trips are
    found on the table as given: later steps only remove rows.
    """
    layout = layout or clean.trip_layout(df, order=order)
    df = clean.drop_duplicates(clean.drop_columns(df, ["AisSourcen"]))
    df = clean.drop_fast_points(clean.null_impossible(df))
    # Reports of one time are ordered by their content as it is before the fills, not as it happens to arrive.
    df = df.withColumn(_CONTENT, row_id(*sorted(df.columns)))
    layout = replace(layout, order=(*layout.order, _CONTENT))
    df = clean.fill_course(clean.fill_in_trips(df, layout)).drop(_CONTENT)
    if impute is not None:
        df = impute(df)
    return finish(df)


def finish(df: DataFrame) -> DataFrame:
    """Final duplicate removal, cleaned names, remaining nulls filled, empty anomaly flag."""
    return clean.rename_columns(clean.fill_remaining(clean.drop_duplicates(df)))


def clean_reports(spark: SparkSession, paths: str | Sequence[str], impute: Imputer | None = None, **options) -> DataFrame:
    """All three stages as one plan, no stage files.

    Large trips are looked for in the typed input, before any shuffle, so the check reads two
    columns and not the whole chain.
    """
    merged = merge_reports(spark, paths)
    layout = clean.trip_layout(merged, order=ORDER, **options)
    return handle_noise(normalise_destinations(merged), impute, layout=layout)


def write_cleaned(df: DataFrame, path: str, splits_path: str | None = None) -> None:
    """The cleaned table, and one folder per start port for manual labelling."""
    written = versions.commit(df, path)
    if splits_path:
        tables.write_port_splits(written, splits_path)


def ingest(spark: SparkSession, paths: str | Sequence[str], out: str, impute: Imputer | None = None) -> DataFrame:
    """A new delivery replaces the cleaned table, once all of it is written: a run that fails half-way leaves the table before it."""
    write_cleaned(clean_reports(spark, paths, impute), out)
    return versions.read(spark, out)


def cleaned_or_built(spark: SparkSession, paths: str | Sequence[str], out: str, impute: Imputer | None = None) -> DataFrame:
    """The cleaned table, built now if it is not there yet."""
    return versions.read(spark, out) if versions.current(spark, out) else ingest(spark, paths, out, impute)


def with_point_id(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A row key from the row's content, for tables that carry none (rows are distinct after
    duplicate removal)."""
    return df.withColumn(S.POINT, row_id(*(columns or df.columns)))
