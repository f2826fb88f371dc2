"""Benchmark decontamination: exact hits of item pieces (pigeonhole), verified by Myers' bit-parallel edit distance."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import whole_text

ERROR_RATE = 0.1
"""Edits that a match may have, as a share of the item's length."""
BLOCK_CHARS = 1 << 22
"""Items are searched in blocks of so many characters: what a task holds does not grow with the benchmark."""


def normal(text: str) -> str:
    """Lower case, each run of white space as one space."""
    return " ".join(text.lower().split())


def nearest(masks: dict[str, int], m: int, budget: int, window: str) -> tuple[int, int] | None:
    """``(edits, end)`` of the substring of ``window`` nearest to a pattern of ``m`` characters (the first such end), if within the budget.

    ``masks`` has a bit for each position of a character in the pattern. One column of the distance table is two bit vectors.
    """
    top, full = 1 << (m - 1), (1 << m) - 1
    plus, minus, score, found = full, 0, m, None
    for end, c in enumerate(window, start=1):
        equal = masks.get(c, 0)
        across = (((equal & plus) + plus) ^ plus) | equal | minus
        up, down = minus | ~(across | plus) & full, plus & across
        score += 1 if up & top else -1 if down & top else 0
        up, down = up << 1 & full, down << 1 & full  # a match may begin anywhere: no carry into the first row
        vertical = equal | minus
        plus, minus = down | ~(vertical | up) & full, up & vertical
        if score <= budget and (found is None or score < found[0]):
            found = score, end
    return found


class Part:
    """A part of an item with a share of its error budget.

    With ``budget`` edits or fewer in the part, one of its halves keeps to its own share, as the shares add up to one less. So a
    match has a chain of parts, from an untouched piece up to the whole item, that all keep to their shares.
    """

    def __init__(self, text: str, start: int, end: int, budget: int, above: Part | None = None):
        self.text, self.start, self.budget, self.above = text[start:end], start, budget, above
        self.masks: dict[str, int] = {}
        for i, c in enumerate(self.text):
            self.masks[c] = self.masks.get(c, 0) | 1 << i
        self.halves: list[Part] = []
        if budget:
            left = (budget - 1) // 2
            middle = start + (end - start) * (left + 1) // (budget + 1)
            self.halves = [Part(text, start, middle, left, self), Part(text, middle, end, budget - 1 - left, self)]

    def pieces(self) -> Iterator[Part]:
        """The budget + 1 parts that have no edit to spend."""
        if not self.halves:
            yield self
        for half in self.halves:
            yield from half.pieces()

    def near(self, text: str, at: int) -> tuple[int, int] | None:
        """Edits and end of the part in ``text``, where the item would begin at ``at`` but for edits."""
        low = max(0, at + self.start - self.budget)
        window = text[low : max(0, at + self.start + len(self.text) + self.budget)]
        if self.budget == 1:  # one half is untouched, and so is a half of the other, which is quicker to look for
            if not all(h.text[: len(h.text) // 2] in window or h.text[len(h.text) // 2 :] in window for h in self.halves):
                return None
        found = nearest(self.masks, len(self.text), self.budget, window)
        return found and (found[0], low + found[1])


class Item:
    """A normalised test item, divided by its error budget."""

    def __init__(self, item_id: int, text: str, rate: float):
        self.item_id, self.text, self.budget = item_id, text, int(len(text) * rate)
        self.whole = Part(text, 0, len(text), self.budget)


class Block:
    """Some items and the automaton of all their pieces."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [Item(i, t, rate) for i, t in items]
        self.automaton = None

    def _build(self) -> None:
        pieces: dict[str, list[tuple[int, Part]]] = {}
        for k, item in enumerate(self.items):
            for part in item.whole.pieces():
                pieces.setdefault(part.text, []).append((k, part))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def matches(self, text: str, first: bool = False) -> list[tuple[int, int, int, int]]:
        """``(item_id, edits, start, end)``: the best match of each item in the normalised text; with ``first``, of any one item."""
        if self.automaton is None:
            self._build()
        best: dict[int, tuple[int, int, int]] = {}
        seen: dict[int, set[int]] = {}
        for last, (size, where) in self.automaton.iter(text):
            for k, part in where:
                item = self.items[k]
                at = last + 1 - size - part.start  # where the item begins, but for edits before the piece
                done = seen.setdefault(k, set())
                if at in done or best.get(k, (1,))[0] == 0:
                    continue
                if not item.budget:  # the only piece is the whole item; it must end at word borders
                    inside = (at > 0 and text[at - 1].isalnum()) or text[last + 1 : last + 2].isalnum()
                    found = None if inside else (0, last + 1)
                else:
                    found, part = (0, last + 1), part.above
                    while found and part:
                        found, part = part.near(text, at), part.above
                    if part is None:  # the whole item was compared from here
                        done.add(at)
                if found and (k not in best or found[0] < best[k][0]):
                    best[k] = found[0], max(0, found[1] - len(item.text)), found[1]
                    if first:
                        return [(item.item_id, *best[k])]
        return [(self.items[k].item_id, *found) for k, found in sorted(best.items())]


def blocks(benchmark: DataFrame, rate: float = ERROR_RATE) -> Iterator[Block]:
    """The items in bounded blocks. Null ids, and texts without a letter or digit, are no items; repeated rows are one."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).where("item_id is not null and text is not null").distinct()
    items, size = [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        text = normal(row["text"])
        if any(map(str.isalnum, text)):
            items.append((row["item_id"], text))
            size += len(text)
        if size >= BLOCK_CHARS:
            yield Block(items, rate)
            items, size = [], 0
    if items:
        yield Block(items, rate)


def find(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """``doc_id, item_id, edits, start_char, end_char``: for each document and item with a match, the best one.

    A match is a substring of the normalised whole text within floor(rate x length) edits of the normalised item. Positions are code points of
    that text; the start is that of a match without insertions or deletions. Items under 1 / rate characters must occur exactly, between
    word borders. Null and empty texts have no match; repeated rows are reported as often as they come; no items or no rows give no rows.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    schema = "doc_id long, item_id long, edits int, start_char long, end_char long"
    out = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark, rate):
        out = out.union(source.mapInArrow(_finder(docs.sparkSession.sparkContext.broadcast(block)), schema))
    return out


def _finder(block):
    def run(batches):
        for batch in batches:
            rows = [(d, *m) for d, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for m in block.value.matches(normal(t.as_py()))]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "item_id", "edits", "start_char", "end_char"])

    return run


def remove(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """``docs`` without the documents that match an item; columns and other rows, null texts included, stay as they are.

    Each block of items filters the rows in passing, so nothing is joined or shuffled.
    """
    text = docs.columns.index("text")
    out = docs
    for block in blocks(benchmark, rate):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in batches:
                yield batch.filter(pa.array([not shared.value.matches(normal(t.as_py() or ""), first=True) for t in batch.column(text)], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
