"""Tables that are replaced as a whole: each version has a folder of its own, and the last one that was finished counts.

Spark marks a folder when all of it is written. A reader takes the highest-numbered folder with that mark, so a job that is killed half-way
leaves the version before it, and readers that have begun keep the files they read. Two writers at a time both finish; the later one counts.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

KEPT = 2
"""Finished versions that stay: the current one, and that before it for readers that have begun."""
_NAME = re.compile(r"v(\d{12})-[0-9a-f]+$")


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _finished(spark: SparkSession, path: str) -> list[str]:
    """Names of the finished versions, in their order."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    names = sorted(s.getPath().getName() for s in files.listStatus(folder) if _NAME.match(s.getPath().getName()))
    marks = (spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS") for n in names)
    return [n for n, mark in zip(names, marks, strict=True) if files.exists(mark)]


def current(spark: SparkSession, path: str) -> str | None:
    """The folder that counts; None if there is none."""
    names = _finished(spark, path)
    return f"{path}/{names[-1]}" if names else None


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``; a table without versions is read as it lies there."""
    return spark.read.parquet(current(spark, path) or path)


def commit(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``df`` as the new version of the table at ``path``. ``df`` may read the version before."""
    spark = df.sparkSession
    names = _finished(spark, path)
    number = int(_NAME.match(names[-1]).group(1)) + 1 if names else 1
    new = f"{path}/v{number:012d}-{uuid.uuid4().hex[:12]}"
    df.write.partitionBy(*partition_by).parquet(new)
    for old in _finished(spark, path)[:-KEPT]:
        folder, files = _folder(spark, f"{path}/{old}")
        files.delete(folder, True)
    return spark.read.parquet(new)


def upsert(new: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = ()) -> DataFrame:
    """Rows of ``new`` take the place of all rows with their ``keys``; the others stay."""
    spark = new.sparkSession
    if current(spark, path) is None:
        return commit(new, path, partition_by)
    kept = read(spark, path).join(new.select(*keys).distinct(), list(keys), "left_anti")
    return commit(kept.unionByName(new, allowMissingColumns=True), path, partition_by)
