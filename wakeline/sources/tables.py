"""Reading and writing tables: raw CSV reports, parquet, split outputs and JSON feeds."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline import schema as S
from wakeline.functions.scalar import iso_text
from wakeline.operators import clean, trips
from wakeline.session import stored

_RAW = "_raw"
_MARK = "\u0001end\u0001"


def read_reports(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, pattern: str | None = None) -> DataFrame:
    """Raw position reports as text columns; a path may be a file or a folder of files.

    All files of one call must have the same header (:func:`read_report_files` takes mixed ones);
    ``columns`` skips the look at the first line. Rows with too many fields, blank or not, are skipped, rows with too few
    are padded with nulls, missing-value texts are null.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("header", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    names = list(columns or reader.csv(paths).columns)
    # Rows with another number of fields than the header keep their raw line. With a mark as one more field, the line is
    # too short if the mark still falls into the header's columns. Pruned columns would hide the number of fields.
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _RAW]])
    reader = reader.schema(text).option("enforceSchema", True).option("mode", "PERMISSIVE").option("escape", '"')
    rows = reader.option("columnNameOfCorruptRecord", _RAW).option("columnPruning", False).csv(paths)
    fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]).simpleString()
    marked = F.from_csv(F.concat(F.col(_RAW), F.lit("," + _MARK)), fields, {"escape": '"'})
    short = F.coalesce(F.array_contains(F.array(*(marked[f"c{i}"] for i in range(len(names)))), _MARK), F.lit(False))
    kept = rows.filter(F.col(_RAW).isNull() | short).drop(_RAW)
    return kept.select(*[F.when(~F.col(c).isin(*S.NA_TEXTS), F.col(c)).alias(c) for c in names])


def read_report_files(spark: SparkSession, paths: str | Sequence[str], pattern: str | None = None) -> DataFrame:
    """Files with different headers, united by column name, in one scan; a path may be a file or a folder of files.

    Every file's first line that is not blank is its header, and is found in one job. Only the different headers come to the driver, for the columns of
    the result; a table of files with the numbers of their headers joins the lines, and one expression parses a line by its header's number. So neither
    jobs nor plan grow with files. Lines with too many fields are skipped, lines with too few are padded with nulls, as are columns that a file does not
    have; missing-value texts are null; lines like their file's header are no rows. Empty files have no rows.
    """
    reader = spark.read.option("pathGlobFilter", pattern) if pattern else spark.read
    text = reader.text([paths] if isinstance(paths, str) else list(paths))
    lines = text.select(F.col("value").alias(_RAW), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start")).filter(F.trim(_RAW) != "")
    first = lines.filter("_start = 0").withColumn("_at", F.monotonically_increasing_id()).groupBy("_file").agg(F.min_by(_RAW, "_at").alias("_header"))
    found = stored(first, "headers")
    headers = [r["_header"] for r in found.groupBy("_header").agg(F.min("_file").alias("f")).orderBy("f").toLocalIterator()]
    names = [next(csv.reader([h.removeprefix("\ufeff")])) for h in headers]
    columns = list(dict.fromkeys(c for n in names for c in n))
    if not columns:
        return spark.createDataFrame([], T.StructType([]))
    number = reduce(lambda rest, i: F.when(F.col("_header") == headers[i], i).otherwise(rest), range(len(headers)), F.lit(None).cast("int"))
    numbered = lines.join(found.select("_file", "_header", number.alias("_kind")), "_file").filter(F.col(_RAW) != F.col("_header"))
    return _parsed(numbered, names, columns)


def _parsed(numbered: DataFrame, names: Sequence[Sequence[str]], columns: Sequence[str]) -> DataFrame:
    """Lines with the numbers of their headers, ``names``, as rows of all ``columns``; lines with too many fields are left out.

    A mark is written behind the line: it is the last field of a whole line, an earlier one of a short line, and beyond the fields of a long one.
    A line is parsed once, as wide as the widest header, in a generator: its fields are columns from there on, and no later step copies the parser into its own expressions.
    """
    cells = [f"_c{i}" for i in range(max(map(len, names)) + 1)]
    fields = T.StructType([T.StructField(c, T.StringType()) for c in cells]).simpleString()
    row = F.from_csv(F.concat(F.col(_RAW), F.lit("," + _MARK)), fields, {"escape": '"'})
    split = numbered.select("_kind", F.inline(F.array(row)))
    mark = F.array_position(F.array(*cells), _MARK)
    kept = split.filter((mark > 0) & (mark <= _by_kind({i: F.lit(len(n) + 1) for i, n in enumerate(names)})))
    values = {c: _by_kind({i: F.col(f"_c{n.index(c)}") for i, n in enumerate(names) if c in n}) for c in columns}
    named = kept.select(*[v.alias(c) for c, v in values.items()])
    return named.select(*[F.when(~F.col(f"`{c}`").isin(*S.NA_TEXTS, _MARK), F.col(f"`{c}`")).alias(c) for c in columns])


def _by_kind(values: dict[int, Column]) -> Column:
    """The value of a line's kind."""
    return reduce(lambda rest, i: F.when(F.col("_kind") == i, values[i]).otherwise(rest), values, F.lit(None))


def type_reports(raw: DataFrame) -> DataFrame:
    """Texts to the raw schema's types."""
    return clean.cast_categories(clean.cast_times(clean.cast_measures(raw)))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def port_splits(df: DataFrame, ports: Sequence[str] = S.SPLIT_PORTS) -> DataFrame:
    return df.filter(F.col(S.ROUTE).isin(*ports))


def write_port_splits(df: DataFrame, path: str, ports: Sequence[str] = S.SPLIT_PORTS) -> None:
    """One folder per start port; a port without rows leaves no folder. One pass for all ports."""
    port_splits(df, ports).write.mode("overwrite").partitionBy(S.ROUTE).parquet(path)


def write_trip_list(df: DataFrame, path: str) -> None:
    trips.trip_list(df).write.mode("overwrite").json(path)


def scored_points(df: DataFrame, metrics: Sequence[str] = S.POINT_METRICS, keep: Sequence[str] = ()) -> DataFrame:
    """The feed of a scored trip: position, ISO time, score, flag and the metrics present."""
    present = [F.col(m) for m in metrics if m in df.columns]
    return df.select(
        *keep,
        "latitude",
        "longitude",
        iso_text(F.col(S.TIME)).alias("time_stamp"),
        "score",
        "is_anomaly_pred",
        F.struct(*present).alias("data"),
    )


def label_preview(numbered: DataFrame, flag: Column) -> DataFrame:
    """The labeller's preview: position, flag and the entry's number."""
    return numbered.select(
        "latitude",
        "longitude",
        flag.cast("int").alias("is_anomaly_pred"),
        F.concat(F.lit("Entry number "), F.col("entry")).alias("comment"),
    )


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
