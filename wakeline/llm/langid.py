"""Language identification by cross-parsing: the language whose text parses a document into the fewest phrases."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import held_out

TRAIN_TEXTS = 32
TRAIN_CHARS = 512
"""The bounded sample of a fit: for each language so many code points from the middle of so many texts, taken by the hash of their ids."""
DENSE = 256
"""Letters of a language up to which its parse table has a column for each; with more, its transitions are searched. Results are the same."""
BLOCK = 512
"""Letters after which a phrase ends in any case, so that the blocks of all texts are parsed side by side."""
LANES = 8192

_SPACE, _UNKNOWN, _BREAK, _PAD = 0, 61, 62, 63
_POINTS = 0x110000


def _training(docs: DataFrame) -> DataFrame:
    """``lang, pieces``: the bounded sample of every language."""
    rows = docs.select(F.col("doc_id"), F.col("lang"), F.col("text")).where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.where(F.col("text").rlike(r"\p{L}"))
    middle = F.greatest(F.lit(1), F.floor((F.length("text") - TRAIN_CHARS) / 2).cast("int"))
    rows = rows.select("lang", F.xxhash64("doc_id").alias("h"), F.substring(F.col("text"), middle, F.lit(TRAIN_CHARS)).alias("piece"))
    for keys in (["lang", F.pmod("h", F.lit(1024))], ["lang"]):  # first in 1024 parts of a language, so that the last task of a hot one is small
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy("h", "piece"))
        rows = rows.withColumn("r", rank).where(F.col("r") <= TRAIN_TEXTS).drop("r")
    return rows.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("h", "piece"))).alias("pieces"))


def _codes(text: str, points: np.ndarray) -> np.ndarray:
    """Letter codes of the lower-cased text; each run of other characters is one space."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = points[raw]
    return codes[np.r_[True, (codes[1:] != _SPACE) | (codes[:-1] != _SPACE)]] if len(codes) else codes


def _alphabet(texts: list[str]) -> np.ndarray:
    """Code of every code point: spaces for all but letters, own codes for all letters of the sample."""
    points = np.array([_UNKNOWN if chr(i).isalpha() else _SPACE for i in range(_POINTS)], dtype=np.int32)
    letters = sorted({c for text in texts for c in text.lower() if c.isalpha()})
    for code, c in enumerate(letters, start=1):
        points[ord(c)] = code if code < _UNKNOWN else code + _PAD - _UNKNOWN + 1
    return points


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring of ``codes``; state 0 is its start."""
    moves, link, longest, last = [{}], [-1], [0], 0
    for c in codes:
        state = len(moves)
        moves.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = state
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if longest[q] == longest[p] + 1:
                link[state] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                longest.append(longest[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    return moves


class _Parser:
    """Greedy parses by the automaton of one language's text; its letters have columns of their own, all others one that continues nothing."""

    def __init__(self, codes: list[int], size: int):
        own = sorted({*codes} - {_BREAK})
        self.column, self.width = np.full(size, len(own), dtype=np.int32), len(own) + 1
        self.column[own] = np.arange(len(own))
        moves = suffix_automaton(codes)
        found = np.array(sorted((s * self.width + int(self.column[c]), q) for s, row in enumerate(moves) for c, q in row.items() if c != _BREAK), dtype=np.int64).reshape(-1, 2)
        self.keys, self.to = found[:, 0].copy(), found[:, 1] * self.width << 1
        self.start = np.full(self.width, 1, dtype=np.int64)  # a new phrase, in state 0 if nothing begins with the letter
        self.start[self.keys[self.keys < self.width]] = self.to[self.keys < self.width] | 1
        later = self.keys >= self.width
        self.keys, self.to, self.table = self.keys[later], self.to[later], None
        if self.width <= DENSE:
            self.table = np.tile(self.start.astype(np.int32), len(moves))
            self.table[self.keys] = self.to
            self.keys = self.to = None

    def step(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Twice the next row's start, plus one if the letter begins a new phrase: one that does not continue the phrase begins the next."""
        at = (state >> 1) + column
        if self.table is not None:
            return self.table[at]
        if not len(self.keys):
            return self.start[column]
        where = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
        return np.where(self.keys[where] == at, self.to[where], self.start[column])


class Model:
    """Languages, their parsers and the bits that a phrase costs in each."""

    def __init__(self, samples: dict[str, list[str]]):
        self.langs = sorted(samples)
        self.points = _alphabet([t for lang in self.langs for t in samples[lang]])
        self.parsers, self.bits, size = [], [], max(_PAD, int(self.points.max())) + 1
        for lang in self.langs:
            codes = [c for t in samples[lang] for c in (*_codes(t, self.points).tolist(), _BREAK)]
            self.parsers.append(_Parser(codes, size))
            self.bits.append(float(np.log2(len(codes) + 1)))

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases of each text in each language, shape (texts, languages)."""
        total = np.zeros((len(texts), len(self.langs)), dtype=np.int64)
        owner, blocks = [], []
        for i, text in enumerate(texts):
            codes = _codes(text, self.points)
            for at in range(0, len(codes), BLOCK):
                owner.append(i)
                blocks.append(codes[at : at + BLOCK])
                if len(blocks) == LANES:
                    self._add(total, owner, blocks)
                    owner, blocks = [], []
        if blocks:
            self._add(total, owner, blocks)
        return total

    def _add(self, total: np.ndarray, owner: list[int], blocks: list[np.ndarray]) -> None:
        order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
        lanes = np.full((len(blocks), BLOCK), _PAD, dtype=np.int32)
        for lane, i in enumerate(order):
            lanes[lane, : len(blocks[i])] = blocks[i]
        lengths = np.array([len(blocks[i]) for i in order])
        steps = np.ascontiguousarray(lanes.T)
        active = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(BLOCK)]  # lanes longer than t
        who = np.array(owner)[order]
        for k, parser in enumerate(self.parsers):
            columns = parser.column[steps]
            state, count = np.zeros(len(blocks), dtype=np.int64), np.zeros(len(blocks), dtype=np.int32)
            for t in range(int(lengths[0])):
                n = active[t]
                state[:n] = parser.step(state[:n], columns[t, :n])
                count[:n] += state[:n] & 1
            np.add.at(total[:, k], who, count)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        known = [t if t is not None else "" for t in texts]
        cost = self.phrases(known) * np.array(self.bits) if self.langs else np.zeros((len(known), 0))
        langs, scores = [], []
        for text, row in zip(known, cost, strict=True):
            if not self.langs or not any(map(str.isalpha, text)):
                langs.append("und")
                scores.append(0.0)
                continue
            best = int(row.argmin())
            second = float(np.delete(row, best).min()) if len(row) > 1 else float("inf")
            langs.append(self.langs[best])
            scores.append(1.0 if second == float("inf") else second / (second + float(row[best])))
        return langs, scores


def fit(docs: DataFrame) -> Model:
    """Learns from text and non-null lang of the rows that are not held out. The sample is bounded by TRAIN_TEXTS pieces a language."""
    return Model({r["lang"]: [p["piece"] for p in r["pieces"]] for r in _training(docs).toLocalIterator()})


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row, from the whole text alone.

    The language that needs the fewest phrases wins, each phrase weighed by the bits that point into the language's text; ties go to the
    first by name. ``score`` is the runner-up's share of both costs, 0.5 to 1 (1 with a single language). Null texts and texts without
    a letter are ``und`` with score 0, and so is all if nothing was learned. Repeated rows stay; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        for batch in batches:
            langs, scores = [], []
            for at in range(0, batch.num_rows, 2000):
                found = model.predict(batch.column(2).slice(at, 2000).to_pylist())
                langs += found[0]
                scores += found[1]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "held_out": batch.column(1), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())})

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
