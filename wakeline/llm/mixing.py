"""Mixing sources to target weights: cube-method balanced sampling in blocks."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import WORD, kept_table, whole_text

SHARE = 1.5
"""Size of the mix, as a share of all sizes."""
MOST = 2.0
"""Times that a source, and a document, is taken at most."""
WEIGHTS = (3.0, 1.0, 2.0)
"""Weights of the sources in code point order, null last, repeating."""
BLOCK = 2048
"""Documents that one task balances at once."""
_EDGE = 1e-9


def size_of(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``source, number, documents, source_size, target`` of every source.

    Sources share ``share`` times all sizes by their weights; a target stops at ``most`` times its source's size, and the excess
    is shared again by weight until none is above. The level of weight is raised round by round with one aggregation each, so
    neither the sources nor their order passes through the driver.
    """
    totals = sizes.groupBy("source").agg(F.count("*").alias("documents"), F.sum("size").alias("source_size"))
    ordered = totals.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(lambda x: (x[0]["source"], x[1], x[0]["documents"], x[0]["source_size"]))
    numbered = sizes.sparkSession.createDataFrame(ordered, "source string, number long, documents long, source_size long")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("number") % len(weights) + 1).cast("int"))
    weighed = kept_table(numbered.withColumn("weight", weight), "sources")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = most * F.col("source_size") <= F.lit(level) * F.col("weight")
        capped, free = weighed.agg(F.sum(F.when(full, most * F.col("source_size")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        above = (share * total - (capped or 0.0)) / free if free else math.inf
        if above <= level or not free:
            break
        level = above
    target = F.least(most * F.col("source_size"), F.lit(level) * F.col("weight"))
    return weighed.select("source", "number", "documents", "source_size", target.alias("target"))


def flight(chances: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Chances moved to 0 or 1, with their sum and their sum of sizes unchanged, until at most two lie between.

    Three open chances at a time are moved along the direction that keeps both totals (two, if of one size), up to the first
    that closes; either way is taken so often that each chance stays the same on average.
    """
    p, waiting, open_ = chances.tolist(), list(range(len(chances)))[::-1], []
    draws = iter(rng.random(2 * len(p) + 2).tolist())
    s = sizes.tolist()
    while True:
        open_ = [i for i in open_ if _EDGE < p[i] < 1 - _EDGE]
        while waiting and len(open_) < 3:
            i = waiting.pop()
            if _EDGE < p[i] < 1 - _EDGE:
                open_.append(i)
        pair = next(((i, j) for i, j in itertools.combinations(open_, 2) if s[i] == s[j]), None)
        if pair:
            moved, u = pair, (1.0, -1.0)
        elif len(open_) == 3:
            a, b, c = open_
            moved, u = (a, b, c), (s[c] - s[b], s[a] - s[c], s[b] - s[a])
        else:
            break
        up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip(moved, u, strict=True) if d)
        down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip(moved, u, strict=True) if d)
        step = up if next(draws) * (up + down) < down else -down
        for i, d in zip(moved, u, strict=True):
            p[i] += step * d
            if p[i] < _EDGE or p[i] > 1 - _EDGE:
                p[i] = float(round(p[i]))
    return np.array(p)


def landing(chances: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The last open chances closed: the sum of sizes is kept as long as two are open, and the last goes to the nearer side,
    so that a source misses its target by half a document at most."""
    p = chances.tolist()
    while len(open_ := [i for i, x in enumerate(p) if _EDGE < x < 1 - _EDGE]) > 1:
        a, b = open_[:2]
        u = (float(sizes[b]), -float(sizes[a])) if sizes[a] or sizes[b] else (1.0, -1.0)
        up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip((a, b), u, strict=True) if d)
        down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip((a, b), u, strict=True) if d)
        step = up if rng.random() * (up + down) < down else -down
        for i, d in zip((a, b), u, strict=True):
            p[i] = min(1.0, max(0.0, p[i] + step * d))
            p[i] = float(round(p[i])) if p[i] < _EDGE or p[i] > 1 - _EDGE else p[i]
    return np.array([float(x >= 0.5) for x in p])


def _flown(level: int, names: list[str]):
    """The flight of a block, and the landing if it is all of its source."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "doc_id", "row"], ascending=[False, True, True], kind="stable")  # the small ones last: they stay open
        rng = np.random.default_rng([level, int(rows["number"].iloc[0]), int(rows["block"].iloc[0])])
        sizes = rows["size"].to_numpy(dtype=np.float64)
        chances = flight(rows["chance"].to_numpy(), sizes, rng)
        if rows["blocks"].iloc[0] == 1:
            chances = landing(chances, sizes, rng)
        return rows.assign(chance=chances)[names]

    return run


def _balanced(chosen: DataFrame) -> DataFrame:
    """``chosen`` with ``chance`` moved to 0 or 1 in every row.

    Rows of a source are dealt over blocks of about BLOCK documents by the hash of their contents; each block leaves two
    open documents at most, which are dealt again, a thousandth each time, until a source is one block, which lands. A hot source is
    so many blocks, and a rerun draws the same numbers, as they come from the source, the block and the round alone.
    """
    done, level = None, 0
    while True:
        left = chosen if level else chosen.withColumn("left", F.col("documents"))
        blocks = F.greatest(F.lit(1), F.ceil(F.col("left") / BLOCK)).cast("long")
        dealt = left.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("doc_id", "size", "row", F.lit(level)), "blocks"))

        names = [c for c in chosen.columns if c != "left"]
        moved = dealt.groupBy("number", "block").applyInPandas(_flown(level, names), dealt.select(names).schema)
        moved = kept_table(moved, "flight")
        open_ = (F.col("chance") > _EDGE) & (F.col("chance") < 1 - _EDGE)
        closed = moved.where(~open_)
        done = closed if done is None else done.union(closed)
        rest = moved.where(open_)
        counts = rest.groupBy("number").agg(F.count("*").alias("left"))
        if rest.isEmpty():
            return done
        chosen, level = rest.join(counts, "number").select(*names, "left"), level + 1


def mix(docs: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[float, ...] = WEIGHTS, row: Column | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies, row`` of every document: how many words the mix takes of it.

    A source's documents are all taken the whole number of times that its target holds it, and once more by a balanced sample with
    equal chances, so that the words and the documents taken of each source come to its target but for half a document.
    ``copies`` is 0 to 2, ``taken`` the size times it. Null and empty texts have size 0 and take nothing. A source without words has target 0. A null
    source is the last one. Repeated rows are documents of their own; null ids stay; no rows give no rows. ``row`` may tell equal ids apart.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size_of(F.col("text")).alias("size"), F.col("source").cast("string").alias("source"), (row if row is not None else F.lit(0)).cast("long").alias("row"))
    sizes = kept_table(source, "sizes")
    shares = targets(sizes, share, most, weights).withColumnRenamed("source", "of")
    rows = sizes.join(shares, F.col("source").eqNullSafe(F.col("of")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(rate + _EDGE)
    rows = rows.withColumn("whole", whole.cast("long")).withColumn("chance", F.greatest(F.lit(0.0), rate - whole))
    rows = rows.withColumn("chance", F.when(F.col("chance") > _EDGE, F.col("chance")).otherwise(0.0)).drop("source", "of")
    copies = (F.col("whole") + F.round("chance").cast("long")).alias("copies")
    picked = _balanced(rows).select("doc_id", "size", "source_size", "target", copies, "row")
    return picked.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "row")


def apply_mix(docs: DataFrame) -> DataFrame:
    """``docs`` as mixed: each document that is taken, with ``copies`` (1 or 2) behind its columns (instead of one of that name).

    Rows that are equal in all columns stay one row, with their copies added up.
    """
    names = [c for c in docs.columns if c != "copies"]
    row = F.xxhash64(*(F.col(c) for c in names))
    known = F.coalesce(F.col("doc_id").cast("long"), F.lit(0))  # the row's hash tells null from 0
    taken = mix(docs, row=row).groupBy(F.col("row").alias("__row"), known.alias("__id")).agg(F.sum("copies").alias("copies")).where("copies > 0")
    joined = docs.select(*names).withColumns({"__row": row, "__id": known}).join(taken, ["__row", "__id"])
    first = F.row_number().over(Window.partitionBy("__row", "__id").orderBy("__id"))  # partitioned as the join is: texts move once
    return joined.withColumn("__first", first).where("__first = 1").select(*names, "copies")
