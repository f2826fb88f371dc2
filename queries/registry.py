"""Registration of the queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queries import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VIEWS = f"traj AS ({fx.TRAJ}), raw AS ({fx.RAW}), scores AS ({fx.SCORES}), vectors AS ({fx.VECTORS})"


def query(name: str, sql: str | None = None):
    """Register a query. ``sql`` may use the fixture views; ``WITH RECURSIVE`` or further CTEs go
    before the final SELECT, after ``@``-free text: ``cte AS (...), ... SELECT ...``."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register


def with_views(sql: str) -> str:
    text = sql.strip()
    if text.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {VIEWS}, {text[len('WITH RECURSIVE '):]}"
    if text.upper().startswith("WITH "):
        return f"WITH {VIEWS}, {text[len('WITH '):]}"
    return f"WITH {VIEWS} {text}"


def rounded(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Doubles to a fixed number of decimals, so that summation order does not show."""
    doubles = {f.name: F.round(f.name, decimals) + 0.0 for f in df.schema if isinstance(f.dataType, T.DoubleType)}
    return df.withColumns(doubles) if doubles else df
