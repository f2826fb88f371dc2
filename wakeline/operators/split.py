"""Deterministic splits by hash order: hold-outs, trip splits, folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.operators.scan import group_rank

SEED = 42


def hash_text(key: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat_ws("-", key.cast("string"), F.lit(str(seed))))


def _ranked(df: DataFrame, keys: Sequence[str], row_key: str, seed: int, **options) -> DataFrame:
    """Rank by md5 inside each group; the leading digits as a number let large groups be cut."""
    hashed = df.withColumn("_md5", hash_text(F.col(row_key), seed))
    hashed = hashed.withColumn("_hash", F.conv(F.substring("_md5", 1, 15), 16, 10).cast("bigint"))
    return group_rank(hashed, keys, ["_hash", "_md5"], "_rank", "_size", **options).drop("_md5", "_hash")


def holdout(
    df: DataFrame, keys: Sequence[str], fraction: float, row_key: str, seed: int = SEED, round_up: bool = False, **options
) -> DataFrame:
    """``is_test``: a fraction of every group, at least one row of each."""
    ranked = _ranked(df, keys, row_key, seed, **options)
    wanted = F.col("_size") * F.lit(float(fraction))
    wanted = F.ceil(wanted - 1e-9) if round_up else F.floor(wanted + 1e-9)
    return ranked.withColumn("is_test", F.col("_rank") <= F.greatest(F.lit(1), wanted)).drop("_rank", "_size")


def one_class_holdout(df: DataFrame, route: str, label: str, fraction: float, row_key: str, seed: int = SEED, **options) -> DataFrame:
    """``part``: ``test`` for all anomalies and a fraction of the normals, ``train`` for the other normals."""
    split = holdout(df.filter(F.col(label).isNotNull()), [route, label], fraction, row_key, seed, **options)
    is_test = (F.col(label) == 1) | F.col("is_test")
    return split.withColumn("part", F.when(is_test, "test").otherwise("train")).drop("is_test")


def trip_holdout(df: DataFrame, route: str, trip: str, fraction: float = 0.1, seed: int = SEED, **options) -> DataFrame:
    """(route, trip, is_test): whole trips held out, the count rounded up."""
    return holdout(df.select(route, trip).distinct(), [route], fraction, trip, seed, round_up=True, **options)


def folds(df: DataFrame, keys: Sequence[str], k: int, row_key: str, seed: int = SEED, **options) -> DataFrame:
    """``fold`` 0..k-1, dealt out in hash order inside each group."""
    ranked = _ranked(df, keys, row_key, seed, **options)
    return ranked.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_size")
