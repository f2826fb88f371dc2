"""Quality classifier: Naive Bayes log-count ratios scale n-gram indicators of a linear hinge-loss model."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import held_out, kept_table, whole_text

SAMPLE = 3000
"""The fit reads about so many labelled documents of each class, taken by the hash of their ids (all, if there are fewer)."""
BUCKETS = 1 << 17
"""N-gram indicators are hashed into so many features."""
THRESHOLD = 0.3
PIECE = 1 << 22

_MIX = np.uint64(0x9E3779B97F4A7C15)  # golden ratio, for multiplicative hashing
_SHIFT = np.uint64(64 - 17)
#: Class of each byte: letters and digits by kind, every other byte its own.
_KIND = np.arange(256, dtype=np.uint8)
for _low, _high, _kind in ((ord("a"), ord("z"), ord("a")), (ord("A"), ord("Z"), ord("A")), (ord("0"), ord("9"), ord("0")), (128, 255, ord("a"))):
    _KIND[_low : _high + 1] = _kind
_POWERS = np.cumprod(np.full(64, 0x100000001B3, dtype=np.uint64))


def _hashed(value: np.ndarray, family: int) -> np.ndarray:
    return (((value + np.uint64(family)) * _MIX) ^ (value >> np.uint64(29))) * _MIX >> _SHIFT


def _grams(codes: np.ndarray, sizes: range, family: int) -> list[np.ndarray]:
    """Hashed n-grams of small codes."""
    found, value = [], np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, sizes.stop):
        if len(codes) < n:
            break
        value = value[: len(codes) - n + 1] * np.uint64(257) + codes[n - 1 :].astype(np.uint64) + np.uint64(1)
        if n in sizes:
            found.append(_hashed(value, family + n))
    return found


def features(text: str) -> np.ndarray:
    """Sorted numbers of the features that the whole text has.

    Three families of n-grams: bytes (1 to 4); the text's outline, in which runs of one kind of character are one sign with
    its length in four steps (1 to 4); and word to word relations, same or not (1 to 4). Long texts are read in pieces.
    """
    data, mark = text.encode("utf-8", "surrogatepass"), np.zeros(BUCKETS, dtype=bool)
    for at in range(0, len(data), PIECE):
        raw = np.frombuffer(data[at : at + PIECE], dtype=np.uint8)
        found = _grams(raw, range(1, 5), 0)
        kind = _KIND[raw]
        starts = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]])
        runs = np.diff(np.r_[starts, len(kind)])
        step = (runs > 1).astype(np.uint16) + (runs > 3) + (runs > 9)
        found += _grams(kind[starts].astype(np.uint16) * 4 + step, range(1, 5), 100)
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        words = np.flatnonzero(~space & np.r_[True, space[:-1]])
        if len(words) > 1:
            offset = np.arange(len(raw)) - np.repeat(words, np.diff(np.r_[words, len(raw)])) if words[0] == 0 else np.arange(len(raw)) - np.repeat(np.r_[0, words], np.diff(np.r_[0, words, len(raw)]))
            value = np.where(space, 0, (raw.astype(np.uint64) + np.uint64(1)) * _POWERS[offset % 64])
            sums = np.add.reduceat(value, words)
            found += _grams((sums[1:] == sums[:-1]).astype(np.uint8), range(1, 5), 200)
        for numbers in found:
            mark[numbers] = True
    return np.flatnonzero(mark)


def dual_coordinate_descent(rows: list[np.ndarray], ratio: np.ndarray, y: np.ndarray, c: float = 1.0, tolerance: float = 1e-2) -> np.ndarray:
    """Weights of the L2-regularised hinge loss over indicator rows scaled by ``ratio`` (and a constant, the last weight).

    Solves the dual one coefficient at a time in a fixed random order, until the projected gradients of a pass differ by no more
    than ``tolerance``. Rows are scaled to unit length, so that long texts do not outweigh short ones.
    """
    w, alpha = np.zeros(len(ratio) + 1), np.zeros(len(rows))
    values = []
    for row in rows:
        x = ratio[row]
        values.append(x / max(1e-9, float(np.sqrt(x @ x))))
    order, rng = np.arange(len(rows)), np.random.default_rng(0)
    while len(rows):
        rng.shuffle(order)
        low, high = np.inf, -np.inf
        for i in order:
            row, x = rows[i], values[i]
            gradient = y[i] * (w[row] @ x + w[-1]) - 1
            projected = min(gradient, 0) if alpha[i] == 0 else max(gradient, 0) if alpha[i] == c else gradient
            low, high = min(low, projected), max(high, projected)
            if projected:
                before, alpha[i] = alpha[i], min(max(alpha[i] - gradient / 2, 0), c)  # a row's length squared is 1, the constant adds 1
                step = (alpha[i] - before) * y[i]
                w[row] += step * x
                w[-1] += step
        if high - low <= tolerance:
            return w
    return w


class Model:
    """Feature weights, already multiplied by the ratios, and the curve from margin to score."""

    def __init__(self, rows: list[np.ndarray], labels: list[int]):
        y = np.where(np.array(labels) > 0, 1, -1)
        counts = {side: np.ones(BUCKETS) for side in (1, -1)}
        for row, side in zip(rows, y, strict=True):
            counts[side][row] += 1
        ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[-1] / counts[-1].sum())
        self.ratio, self.slope, self.offset = ratio, 1.0, 0.0
        self.weights, self.constant = np.zeros(BUCKETS), 0.0
        if len(set(y.tolist())) < 2:  # one class: every score is its share
            self.slope, self.offset = 0.0, 3.0 if len(y) and y[0] > 0 else -3.0 if len(y) else 0.0
            return
        part = np.arange(len(rows)) % 5 == 0  # a fifth sets the curve, the rest the weights
        w = dual_coordinate_descent([r for r, p in zip(rows, part, strict=True) if not p], ratio, y[~part])
        self.weights, self.constant = w[:-1] * ratio, float(w[-1])
        margins = np.array([self.margin(r) for r, p in zip(rows, part, strict=True) if p])
        self.slope, self.offset = _curve(margins, y[part])

    def margin(self, row: np.ndarray) -> float:
        x = self.ratio[row]
        return float(self.weights[row].sum() / max(1e-9, float(np.sqrt(x @ x)))) + self.constant

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(features(text)) + self.offset, -30, 30))))


def _curve(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the margins (Platt), by Newton steps on smoothed targets."""
    positive, negative = max(1, int((y > 0).sum())), max(1, int((y < 0).sum()))
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x, beta = np.stack([margins, np.ones(len(margins))], axis=1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
        beta = beta - np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (beta - np.array([1.0, 0.0])))
    return max(0.1, float(beta[0])), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns ``labels.quality`` (0 or 1) of the labelled documents that are not held out, from their texts alone.

    The sample holds about SAMPLE documents of each class: those whose hashed id is below the class's share, so no class is gathered in one task. Ids without a document, null labels and null ids are passed over; of a
    repeated id the larger label counts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("label")).where("id is not null and label in (0, 1)")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    known = kept_table(known, "labels")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {label: min(1 << 53, int(SAMPLE / n * (1 << 53))) for label, n in counts.items()}
    below = F.when(F.col("label") == 1, F.lit(share.get(1, 0))).otherwise(F.lit(share.get(0, 0)))
    chosen = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 53)) < below)  # about 2 x SAMPLE rows of two numbers: small enough to broadcast
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text")).join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))

    def run(batches):
        for batch in batches:
            rows = [features(t.as_py()).astype(np.int32).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "label": batch.column(2), "features": pa.array(rows, pa.binary())})

    found = sample.select("doc_id", "text", "label").mapInArrow(run, "doc_id long, label int, features binary").dropDuplicates(["doc_id"])
    rows = sorted(((r["doc_id"] * 0x9E3779B1 % (1 << 32), r["label"], r["features"]) for r in found.toLocalIterator()), key=lambda r: r[:2])
    return Model([np.frombuffer(r[2], dtype=np.int32) for r in rows], [r[1] for r in rows])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row: score from 0 to 1 (higher: label 1 is likelier) and 1 where it is 0.3 or more.

    Reads the whole text and nothing else. Null and empty texts have no feature and get the score of the constant. Repeated rows stay; no rows
    give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            scores = [shared.value.score(t.as_py()) for t in batch.column(2)]
            predicted = [int(s >= THRESHOLD) for s in scores]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "held_out": batch.column(1), "score": pa.array(scores, pa.float64()), "predicted": pa.array(predicted, pa.int32())})

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), whole_text(F.col("text")).alias("text"))
    return source.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects; the columns stay as they are.

    The filter runs beside the rows: text goes through the tasks once and nothing is joined, so repeated and null ids need no care.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    text = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            good = [model.value.score(t.as_py() or "") >= THRESHOLD for t in batch.column(text)]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
