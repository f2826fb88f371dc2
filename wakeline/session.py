"""Session helpers: local sessions for tests and the shared scratch folder for jobs."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, name: str = "wakeline") -> SparkSession:
    """A local session for tests and benches. Clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="wakeline-ckpt-"))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session may fall back to a temporary folder; on a cluster an unset
    folder is an error, because executors cannot see the driver's disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder(spark.sparkContext.applicationId)


@functools.cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="wakeline-ckpt-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_SHORT_LIVED = threading.local()


@contextlib.contextmanager
def short_lived(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """What this thread stores within goes when the block ends, as do the shuffle files of a query when the query ends. So a loop over parts of a job
    needs the disk of one part. The function it gives stores a table that stays."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, outer = spark.conf.get(key, None), getattr(_SHORT_LIVED, "paths", None)
    _SHORT_LIVED.paths = paths = []

    def kept(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        if outer is not None:
            outer.append(path)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    spark.conf.set(key, "true")
    try:
        yield kept
    finally:
        _SHORT_LIVED.paths = outer
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    With ``by``, a text column, every value has a folder of its own, so that a filter on it reads nothing else; the rows are
    dealt out evenly first, so that a hot value takes several files and a rare one a single file.
    """
    path = scratch_path(df.sparkSession, label)
    if getattr(_SHORT_LIVED, "paths", None) is not None:
        _SHORT_LIVED.paths.append(path)
    if by is None:
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)
    df.hint("rebalance", by).write.partitionBy(by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(df.columns)
