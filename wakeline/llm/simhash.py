"""SimHash near-duplicates: pivot distance tables discard pairs, exact distances verify the rest."""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import kept_table, whole_text
from wakeline.llm.graph import components

SEED = 42
PIVOTS = 16
"""Reference fingerprints. Each halves what is left of unrelated pairs; sixteen leave a few in a million."""
MAX_GROUP = 4096
"""Fingerprints that one task compares at once; larger groups are divided by further bits, without loss."""
PIECE = 1 << 22
"""Bytes of a text that are split into words at once."""

_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def pivot_fingerprints(count: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: hashes of their numbers, the same in every run."""
    return np.array([xxhash.xxh64_intdigest(str(i), SEED) for i in range(count)], dtype=np.uint64)


# ---------------------------------------------------------------- fingerprints


def shingle_hashes(text: str, words: int):
    """Arrays of the 64-bit hashes of every shingle of ``words`` words, repeats included; one shingle of all words where there are fewer."""
    data, at, rest, some = text.encode("utf-8", "surrogatepass").lower(), 0, [], False  # bytes.lower() changes A-Z only
    while at < len(data):
        cut = _SPACE.search(data, at + PIECE)
        end = cut.start() if cut else len(data)
        rest += data[at:end].split()
        at = end
        if len(rest) >= words:
            yield _hashes([b" ".join(x) for x in zip(*(rest[i:] for i in range(words)), strict=False)])
            some, rest = True, rest[len(rest) - words + 1 :]
    if not some and rest:
        yield _hashes([b" ".join(rest)])


def _hashes(shingles: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, itertools.repeat(SEED))), dtype=">u8")


def fingerprint(arrays) -> int:
    """Bit i is 1 if it is set in over half of the hashes; zero without any. Signed, as Spark stores it."""
    ones, total = np.zeros(64, dtype=np.int64), 0
    for hashes in arrays:
        raw = hashes.view(np.uint8).reshape(-1, 8)
        ones += np.concatenate([np.bincount(raw[:, j], minlength=256) @ _BITS for j in range(8)])
        total += len(raw)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, fp`` of every row: the SimHash of its word shingles. Null and empty texts have fingerprint zero."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))

    def run(batches):
        for batch in batches:
            prints = [fingerprint(shingle_hashes(text.as_py(), words)) for text in batch.column(1)]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fp": pa.array(prints, pa.int64())})

    return source.mapInArrow(run, "doc_id long, fp long")


# ---------------------------------------------------------------- links of fingerprints


def _cuts(low: int, high: int, parts: int) -> list[int]:
    """Masks of ``parts`` adjacent blocks over the bits low to high."""
    at = [low + (high - low) * i // parts for i in range(parts + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(at)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(bits: int) -> tuple[list[int], list[list[int]]]:
    """First masks, and for each of them the finer ones.

    Two fingerprints that differ in ``bits`` bits agree on ``bits`` of ``2 * bits`` blocks at least, so they share one of the
    masked keys. The blocks outside a mask are halved for the finer masks, by the same argument.
    """
    blocks = _cuts(0, 64, 2 * bits)
    first, finer = [], []
    for kept in itertools.combinations(range(2 * bits), bits):
        mask = sum(blocks[i] for i in kept)
        first.append(mask)
        others = []
        for i in set(range(2 * bits)) - set(kept):
            low, high = (blocks[i] & -blocks[i]).bit_length() - 1, blocks[i].bit_length()
            others += _cuts(low, high, 2)
        finer.append([mask + sum(others[i] for i in more) for more in itertools.combinations(range(2 * bits), bits)])
    return first, finer


def _keys(fp: Column, masks: Column) -> Column:
    return F.transform(masks, lambda m: F.struct(m.alias("mask"), fp.bitwiseAND(m).alias("key")))


def _literals(masks: list[int]) -> Column:
    return F.array(*(F.lit(_signed(m)) for m in masks))


def group_links(fp: np.ndarray, bits: int, pivots: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Links that connect a group as all its links of ``bits`` bits or fewer would, as (one, others) by position.

    Each fingerprint that has been reached is compared with those not yet reached: first by its row of the pivot table
    (two distances to one pivot differ by no more than the pair's own distance), then bit by bit.
    """
    distances = np.bitwise_count(fp[:, None] ^ pivots[None, :]).astype(np.int8)
    left, found = np.arange(len(fp)), []
    while left.size:
        frontier, left = [left[0]], left[1:]
        while frontier and left.size:
            x = frontier.pop()
            close = np.abs(distances[left] - distances[x]).max(axis=1) <= bits
            close[close] = np.bitwise_count(fp[left[close]] ^ fp[x]) <= bits
            if close.any():
                near = left[close]
                found.append((x, near))
                frontier.extend(near)
                left = left[~close]
    return found


def links(prints: DataFrame, bits: int = 3) -> DataFrame:
    """Links ``a, b`` between ``node`` values of distinct fingerprints (``fp, node``) that connect the same fingerprints as all pairs
    of ``bits`` differing bits or fewer do.

    A key group of more than MAX_GROUP fingerprints is divided by finer keys (48 of 64 bits for three), which bounds
    every group by the 2^17 values that the rest can take; nothing is dropped at either level.
    """
    first, finer = _masks(bits)
    keyed = prints.select("fp", "node", F.explode(_keys(F.col("fp"), _literals(first))).alias("k")).select("fp", "node", "k.*")
    sizes = kept_table(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "sizes")  # stored: a join with a stored side can split hot keys
    grouped = keyed.join(sizes, ["mask", "key"])
    whole = grouped.where(F.col("n") <= MAX_GROUP).select("mask", "key", "fp", "node")
    fine = F.element_at(F.create_map(*(x for m, more in zip(first, finer, strict=True) for x in (F.lit(_signed(m)), _literals(more)))), F.col("mask"))
    large = grouped.where(F.col("n") > MAX_GROUP).select("fp", "node", F.explode(_keys(F.col("fp"), fine)).alias("k")).select("k.*", "fp", "node")
    pivots = pivot_fingerprints()

    def run(batches):
        rest = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                part = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
                rest = part if rest is None else np.concatenate([rest, part], axis=1)
            if rest is None or not rest.shape[1]:
                continue
            starts = np.flatnonzero(np.r_[True, (rest[0, 1:] != rest[0, :-1]) | (rest[1, 1:] != rest[1, :-1])])
            ends = np.r_[starts[1:], rest.shape[1]]
            if batch is not None:  # the last group may go on
                held, starts, ends = starts[-1], starts[:-1], ends[:-1]
            a, b = [], []
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                if e - s > 1:
                    for x, near in group_links(rest[2, s:e].view(np.uint64), bits, pivots):
                        a += [rest[3, s + x]] * len(near)
                        b += rest[3, s + near].tolist()
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
            rest = rest[:, held:] if batch is not None else None

    groups = whole.union(large).repartition("mask", "key").sortWithinPartitions("mask", "key")
    return groups.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row: fingerprints of ``bits`` differing bits or fewer are linked.

    ``fingerprint`` has 16 hex digits; ``component_id`` is the smallest doc_id reachable, itself included. Equal
    fingerprints are collapsed before any comparison, so copies cost one row each. Null and empty texts have fingerprint
    zero and are linked like any other; a null doc_id gets the class of its fingerprint (null if no row of the class has
    an id); repeated rows are returned as often as they come; no rows give no rows. Other columns are not read.
    """
    prints = kept_table(fingerprints(docs, words), "prints")
    reps = kept_table(prints.groupBy("fp").agg(F.min("doc_id").alias("node")), "reps")
    found = components(links(reps.where("node is not null"), bits)).withColumnRenamed("node", "member")
    classes = reps.join(found, F.col("node") == F.col("member"), "left").select(F.col("fp").alias("of"), F.coalesce("component", "node").alias("component_id"))
    return prints.join(classes, F.col("fp") == F.col("of"), "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


# ---------------------------------------------------------------- removal


def deduplicate(docs: DataFrame, words: int = 3, bits: int = 3) -> DataFrame:
    """``docs`` with one document of each class of :func:`near_duplicates`: that with the smallest doc_id.

    Of repeated rows of a kept doc_id one stays, the smallest text first (null before all); all empty and null texts are one class; rows
    without a doc_id stay. Other columns are kept as they are, whatever their names. No rows give no rows.
    """
    kept = near_duplicates(docs, words, bits).where("doc_id = component_id").select(F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    order = F.struct(F.col("row.text").isNotNull(), F.col("row.text"), F.xxhash64(*(F.col("row")[c] for c in docs.columns)))
    first = rows.join(kept, "id").groupBy("id").agg(F.min_by("row", order).alias("row"))
    return first.select("row.*").union(rows.where("id is null").select("row.*"))
