"""Scoring rows with the model rows of their route, whatever the size of either side.

The rows of a route are dealt into chunks that fit a task; every chunk meets its route's model rows as a stream, in a stated order, and
adds up what they contribute. So neither a model nor a route has to fit a task or a broadcast, all routes are scored in one shuffle, a hot
route is spread over many tasks, and the result does not depend on the size of a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline import schema as S
from wakeline.operators.layout import join_group_values

CHUNK_ROWS = 1 << 16
"""Rows that a task scores together, about: some tens of megabytes."""


def score(rows: DataFrame, x: Column, models: DataFrame, scorer: Callable, order: Sequence[str], out: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``rows`` with the array ``out``: what the models of their route make of the vectors ``x`` (arrays of doubles of one length).

    ``scorer(x)`` takes the matrix of a chunk; its ``add`` takes struct arrays of model rows, all of the route, in ``order``; its
    ``result()`` is a matrix with a line for each row (NaN becomes null). Rows whose route is null, or has no model rows, get a null.
    """
    numbers = rows.groupBy(S.ROUTE).agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("_chunks"))
    packed = rows.select(F.col(S.ROUTE).alias(S.ROUTE), F.struct(*rows.columns).alias("_row"), x.alias("_x"))
    dealt = join_group_values(packed, numbers, [S.ROUTE], source=rows)
    chunk = F.pmod(F.xxhash64("_row"), F.coalesce(F.col("_chunks"), F.lit(1024))).cast("int")  # rows without a route meet no model
    left = dealt.select(S.ROUTE, chunk.alias("_chunk"), "_row", "_x", _blank(models.schema).alias("_model"), F.lit(False).alias("_is_model"))
    copies = models.join(numbers, S.ROUTE).withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    none = F.array().cast("array<double>")
    right = copies.select(S.ROUTE, "_chunk", _blank(rows.schema).alias("_row"), none.alias("_x"), F.struct(*models.columns).alias("_model"), F.lit(True).alias("_is_model"))
    met = left.unionAll(right).repartition(S.ROUTE, "_chunk").sortWithinPartitions(S.ROUTE, "_chunk", "_is_model", *(f"_model.{c}" for c in order))

    def run(batches):
        chunk = None
        for batch in batches:
            is_model = batch.column(5).to_numpy(zero_copy_only=False)
            for key, at, size in stretches(batch, is_model):
                if chunk is None or chunk.key != key:
                    if chunk is not None:
                        yield from chunk.scored()
                    chunk = _Chunk(key, scorer)
                part = batch.slice(at, size)
                if is_model[at]:
                    chunk.add(part.column(4))
                else:
                    chunk.hold(part)
                if key[0] is None:
                    yield from chunk.scored()
                    chunk = None
        if chunk is not None:
            yield from chunk.scored()

    schema = T.StructType([T.StructField("_row", rows.schema), T.StructField("_out", T.ArrayType(T.DoubleType()))])
    return met.mapInArrow(run, schema).select("_row.*", F.col("_out").alias(out))


def _blank(schema: T.StructType) -> Column:
    """A row without values, but with empty arrays: Spark measures a batch for Python at every row, and each time passes over all its nulls of an array."""
    return F.struct(*[(F.array() if isinstance(f.dataType, T.ArrayType) else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def stretches(batch: pa.RecordBatch, kind: np.ndarray):
    """``(route, chunk), start, size`` of the stretches of a batch with one route, chunk and kind of row."""
    if not batch.num_rows:
        return
    routes = batch.column(0).dictionary_encode()
    code = np.nan_to_num(routes.indices.to_numpy(zero_copy_only=False).astype(float), nan=-1.0)
    marks = np.stack([code, batch.column(1).to_numpy(), kind])
    starts = np.flatnonzero(np.r_[True, (marks[:, 1:] != marks[:, :-1]).any(axis=0)])
    for start, end in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
        yield (batch.column(0)[start].as_py(), int(marks[1, start])), start, end - start


class _Chunk:
    """The rows of one chunk, and what its model rows have added so far."""

    def __init__(self, key, scorer: Callable):
        self.key, self._make, self._scorer, self._rows, self._x = key, scorer, None, [], []

    def hold(self, part: pa.RecordBatch) -> None:
        self._rows.append(part.column(2))
        self._x.append(part.column(3))

    def add(self, models: pa.StructArray) -> None:
        if not self._rows:
            return
        if self._scorer is None:
            flat = np.concatenate([x.flatten().to_numpy(zero_copy_only=False) for x in self._x])
            self._scorer = self._make(flat.reshape(sum(map(len, self._x)), -1))
        self._scorer.add(models)

    def scored(self):
        if not self._rows:
            return
        rows = pa.concat_arrays(self._rows)
        if self._scorer is None:
            out = pa.nulls(len(rows), pa.list_(pa.float64()))
        else:
            matrix = np.ascontiguousarray(self._scorer.result(), dtype=float)
            values = pa.array(matrix.ravel(), mask=np.isnan(matrix.ravel()))
            out = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * matrix.shape[1], pa.int32()), values)
        yield pa.RecordBatch.from_arrays([rows, out], ["_row", "_out"])


def inputs(features: Sequence[str]) -> Column:
    """Features as one vector; a missing value counts as 0."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])


BLOCK_ROWS = 4096
"""Rows of a block."""


def blocks(rows: DataFrame, columns: dict[str, Column], chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The rows of each route in blocks of up to BLOCK_ROWS, dealt and ordered by a hash of their values, so that any block is a fair sample: every
    array column becomes the bytes of a matrix of doubles. Rows without a route are left out."""
    known = rows.where(F.col(S.ROUTE).isNotNull())
    numbers = known.groupBy(S.ROUTE).agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("_chunks"))
    dealt = join_group_values(known.select(S.ROUTE, *(v.alias(c) for c, v in columns.items())), numbers, [S.ROUTE], source=known, how="inner")
    hashed = dealt.withColumn("_hash", F.xxhash64(*columns))
    placed = hashed.withColumn("_chunk", F.pmod("_hash", F.col("_chunks")).cast("int")).drop("_chunks")
    together = placed.repartition(S.ROUTE, "_chunk").sortWithinPartitions(S.ROUTE, "_chunk", "_hash")
    width = len(columns)

    def run(batches):
        route, held, size = None, [], 0
        for batch in batches:
            codes = batch.column(0).dictionary_encode().indices.to_numpy()
            starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if batch.num_rows else []
            cuts = sorted({*map(int, starts), *range(0, batch.num_rows, BLOCK_ROWS), batch.num_rows})
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                own = batch.column(0)[low].as_py()
                if held and (own != route or size + high - low > BLOCK_ROWS):
                    yield _block(route, held, width)
                    held, size = [], 0
                route, size = own, size + high - low
                held.append(batch.slice(low, high - low))
        if held:
            yield _block(route, held, width)

    return together.mapInArrow(run, ", ".join([f"{S.ROUTE} string", *(f"{c} binary" for c in columns)]))


def _block(route: str, parts: list[pa.RecordBatch], width: int) -> pa.RecordBatch:
    values = [b"".join(p.column(i).flatten().to_numpy(zero_copy_only=False).tobytes() for p in parts) for i in range(1, width + 1)]
    return pa.RecordBatch.from_arrays([pa.array([route], pa.string()), *(pa.array([v], pa.binary()) for v in values)], parts[0].schema.names[: width + 1])


def sum_arrays(parts: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """``sums``: the arrays of each key added up place by place, combined before they are shuffled."""
    places = parts.select(*keys, F.posexplode(column).alias("_place", "_value")).groupBy(*keys, "_place").agg(F.sum("_value").alias("_value"))
    return places.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", "_value"))), lambda s: s["_value"]).alias("sums"))
