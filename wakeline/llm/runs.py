"""Periodic runs of words, found with the dictionary of basic factors.

The factors of length 2^k are named from those of length 2^(k-1), for many texts at once; a factor that does not come again in its text
has no name and is not looked at again. Where a factor's next occurrence lies within a window of twice its length (a distance of at
most 2^k), the occurrences form an arithmetic progression whose difference is the smallest period of all they cover. Starts that lie
side by side at one difference are factors of one run, so the run goes from the first start to the end of the last one's successor.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wakeline.llm.common import whole_text

LEAST, TIMES = 24, 3
"""Words of the shortest run, and how often its period must fit into it."""
BLOCK = 1 << 19
"""Words of short texts that are searched together; a longer text is searched alone."""
PIECE = 1 << 22
"""Bytes of a text that are split into words at once."""

_SPACE = re.compile(rb"[\x20\x09-\x0d]")
RUN = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def word_lists(data: bytes):
    """The words of a text, in lists of about PIECE bytes; no word is cut."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        yield data[at:end].split()  # bytes.split() parts at space and tab to carriage return
        at = end


def _name(first: np.ndarray, second: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the pairs (first, second) that come more than once, and their positions: sorted by name, then by position."""
    pair = first * np.int64(second.max() + 1) + second
    order = np.argsort(pair, kind="stable")
    pair, at = pair[order], at[order]
    new = np.r_[True, pair[1:] != pair[:-1]]
    again = ~(new & np.r_[new[1:], True])
    return np.cumsum(new)[again], at[again]


def find_runs(words: np.ndarray, texts: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Columns start, length, period of every run, by start and period; ``words`` and ``texts`` give each position's word and text number.

    A run has at least ``least`` words and ``times`` (3 or more) times its smallest period: so it holds a factor whose length lies between
    one and two periods, together with its successor, and the level of that length finds it.
    """
    total, found, size = len(words), [np.empty((0, 3), dtype=np.int64)], 1
    if total == 0:
        return found[0]
    names, at = _name(texts.astype(np.int64), words.astype(np.int64), np.arange(total))
    while at.size:
        # One difference belongs to one level: half the factor's length is below it, the length is not.
        gap = np.where(names[1:] == names[:-1], at[1:] - at[:-1], 0)
        near = np.flatnonzero((gap > size // 2) & (gap <= size))
        start, period = at[near], gap[near]
        order = np.argsort(start)  # a position has one successor
        start, period = start[order], period[order]
        first = np.flatnonzero(np.r_[True, (start[1:] != start[:-1] + 1) | (period[1:] != period[:-1])][: len(start)])
        last = np.r_[first[1:] - 1, len(start) - 1][: len(first)]
        length = start[last] - start[first] + period[first] + size
        long = (length >= least) & (length >= times * period[first])
        found.append(np.stack([start[first], length, period[first]], axis=1)[long])
        # A longer factor comes again only where both its halves do.
        table = np.full(total + size, -1, dtype=np.int64)
        table[at] = names
        both = (table[at + size] >= 0) & (names >= 0)
        if not both.any():
            break
        names, at = _name(names[both], table[at[both] + size], at[both])
        size *= 2
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _search(texts: list, least: int, times: int) -> list[tuple[int, list, bytes]]:
    """Number of words, runs, and the words that stay, of each of a few texts."""
    number = defaultdict(itertools.count().__next__)
    codes, sizes = [], []
    for data in texts:
        parts = [np.fromiter(map(number.__getitem__, words), np.int64, len(words)) for words in word_lists(data)]
        codes += parts
        sizes.append(sum(map(len, parts)))
    codes = np.concatenate(codes) if codes else np.empty(0, dtype=np.int64)
    ends = np.cumsum(sizes)
    runs = find_runs(codes, np.repeat(np.arange(len(texts)), sizes), least, times)
    cuts = np.searchsorted(runs[:, 0], ends)
    out = []
    for data, size, end, low, high in zip(texts, sizes, ends.tolist(), [0, *cuts[:-1]], cuts, strict=True):
        own = runs[low:high] - np.array([end - size, 0, 0])
        out.append((size, own, collapse(data, size, own)))
    return out


def collapse(data: bytes, size: int, runs: np.ndarray) -> bytes:
    """The words of a text that no run contains after its first period, joined by a space."""
    if not len(runs):
        return b" ".join(itertools.chain.from_iterable(word_lists(data)))
    change = np.zeros(size + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = (np.cumsum(change)[:size] == 0).tolist()
    return b" ".join(itertools.compress(itertools.chain.from_iterable(word_lists(data)), kept))


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row: the periodic runs of its whole text, and the text without their repeats.

    ``runs`` holds (start, length, period) in words, numbered from 0, by start and period. A run is a longest stretch with smallest
    period ``period``, of ``least`` words and ``times`` periods or more (no fewer than three). ``collapsed`` drops each word that a run
    contains after its first period. Null and empty texts have no words, no runs and an empty ``collapsed``; a null doc_id stays null;
    repeated rows are returned as often as they come; no rows give no rows. Other columns are not read. Rows are independent: nothing
    is shuffled, and a task holds one block of words, or one text, at a time.
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods are not all found")
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("runs", RUN), T.StructField("packed", T.BinaryType())])
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches):
        for batch in batches:
            held, room = [], 0
            for i in range(batch.num_rows):
                data = batch.column(1)[i].as_py()
                held.append(data)
                room += len(data)
                if room >= 6 * BLOCK or i + 1 == batch.num_rows:
                    rows = _search(held, least, times)
                    runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in own.tolist()] for _, own, _ in rows]
                    columns = [batch.column(0).slice(i + 1 - len(held), len(held)), pa.array([n for n, *_ in rows], pa.int64()), pa.array(runs, kind), pa.array([c for *_, c in rows], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, schema.names)
                    held, room = [], 0

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).cast("binary").alias("data"))
    return source.mapInArrow(run, schema).select("doc_id", "n_words", "runs", F.col("packed").cast("string").alias("collapsed"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; the first of equal ones, null if there is none."""
    beats = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    return F.aggregate(runs, F.lit(None).cast(RUN.elementType), lambda best, x: F.when(beats(best, x), x).otherwise(best))
