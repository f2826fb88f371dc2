"""Substring deduplication: sliding spans of sentences, hashed and joined over all documents."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import kept_table, shuffles_freed, whole_text

RUN_SENTENCES = 2
RUN_WORDS = 16
"""A run goes from a sentence on until it has so many sentences and words."""
WINDOW = 4
"""Pairs of words on each side among which the least one cuts a sentence."""

_END = re.compile(r"[.!?]\s+|\n\s*")
#: Thai, kana and Han are written without spaces: each character is a word.
_UNSPACED = r"\u0E00-\u0E7F\u3040-\u30FF\u3400-\u9FFF"
_WORD = re.compile(rf"[^\s{_UNSPACED}]+|[{_UNSPACED}]")
_ONE_UNSPACED = re.compile(f"[{_UNSPACED}]")
#: Whether a character is a space, by code point; there is none from the last entry on.
_SPACE = np.array([chr(i).isspace() for i in range(0x3002)])


def _spaced(text: str) -> bool:
    return text.isascii() or not _ONE_UNSPACED.search(text)


def _words(text: str) -> list[str]:
    """All words of a lower-cased text."""
    return text.split() if _spaced(text) else _WORD.findall(text)


def _starts_and_hashes(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts, and the crc32 of its lower-case UTF-8."""
    if not _spaced(text):
        found = [(m.start(), zlib.crc32(m.group().lower().encode("utf-8", "surrogatepass"))) for m in _WORD.finditer(text)]
        return np.array([f[0] for f in found], dtype=np.int64), np.array([f[1] for f in found], dtype=np.uint64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = _SPACE[np.minimum(points, len(_SPACE) - 1)]
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    # Spaces end all that lower-casing looks at, so words may be lower-cased and encoded together.
    words = " ".join(text.lower().split()).encode("utf-8", "surrogatepass").split(b" ") if len(starts) else []
    return starts, np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def _cuts_within(text: str, ends: list[int]) -> list[int]:
    """Where sentences are cut: behind a word whose pair with the next word has the least hash of WINDOW pairs on each side, all in one sentence.

    This depends on no words further away, so a passage is cut alike wherever it stands, but for WINDOW words at its borders.
    """
    starts, hashes = _starts_and_hashes(text)
    if len(starts) < 2 * WINDOW + 2:
        return []
    pairs = (hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    last = np.searchsorted(starts, np.array(ends, dtype=np.int64))  # words before each end
    sentence = np.repeat(np.arange(len(ends)), np.diff(last, prepend=0))
    middle = pairs[WINDOW : len(pairs) - WINDOW]
    least = sentence[: len(middle)] == sentence[2 * WINDOW + 1 :]
    for i in range(2 * WINDOW + 1):
        least &= middle <= pairs[i : i + len(middle)]
    return starts[np.flatnonzero(least) + WINDOW + 1].tolist()


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each sentence, or part of a longer one, with the space behind it; together they are the whole text."""
    at, ends = 0, [*(m.end() for m in _END.finditer(text)), len(text)]
    for end in sorted({*ends, *_cuts_within(text, ends)}):
        if end > at:
            yield at, end
        at = end


def runs(text: str, ends: bool = True) -> Iterator[tuple[int, int, bytes]]:
    """``(first sentence, sentences, digest)`` of every run of several consecutive sentences, by their lower-cased words, in order.

    A run begins at any sentence with a word, or with ``ends`` also ends at any, and is as short as RUN_SENTENCES and RUN_WORDS let it be. So a
    passage shared by two texts gives the same runs in both, and those that begin or end in it cover all its sentences; without ``ends`` its
    last ones may stay. A text that is one long sentence is one run, and with ``ends`` also one that is too short for a run.
    """
    sizes, keys, where = [], [], []
    for i, (a, b) in enumerate(sentences(text)):
        if words := _words(text[a:b].lower()):
            sizes.append(len(words))
            keys.append(xxhash.xxh128_digest(" ".join(words).encode("utf-8", "surrogatepass")))
            where.append(i)
    end, size, count, found = 0, 0, len(keys), set()
    for i in range(count):
        while end < count and (end - i < RUN_SENTENCES or size < RUN_WORDS):
            size += sizes[end]
            end += 1
        if end - i < RUN_SENTENCES or size < RUN_WORDS:
            break
        found.add((i, end))
        size -= sizes[i]
    first, size = 0, 0
    for end in range(1, count + 1 if ends else 1):
        size += sizes[end - 1]
        while end - first > RUN_SENTENCES and size - sizes[first] >= RUN_WORDS:
            size -= sizes[first]
            first += 1
        if end - first >= RUN_SENTENCES and size >= RUN_WORDS:
            found.add((first, end))
    if count and not found and (ends or sum(sizes) >= RUN_WORDS):
        found.add((0, count))
    for i, end in sorted(found):
        yield where[i], where[end - 1] + 1 - where[i], xxhash.xxh128_digest(b"".join(keys[i:end]))


def _run_rows(docs: DataFrame, ends: bool) -> DataFrame:
    """``doc_id, h1, h2, first, size, again``: every run; ``again`` if the same run begins earlier in the document."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text")).where("doc_id is not null")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                ids, digests, firsts, sizes, again = [], [], [], [], []
                for doc_id, text in zip(batch.column(0).slice(at, 500).to_pylist(), batch.column(1).slice(at, 500), strict=True):
                    seen = set()
                    for first, size, digest in runs(text.as_py(), ends):
                        ids.append(doc_id)
                        digests.append(digest)
                        firsts.append(first)
                        sizes.append(size)
                        again.append(digest in seen)
                        seen.add(digest)
                halves = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
                columns = {"doc_id": pa.array(ids, pa.int64()), "h1": pa.array(halves[:, 0]), "h2": pa.array(halves[:, 1])}
                columns |= {"first": pa.array(firsts, pa.int32()), "size": pa.array(sizes, pa.int32()), "again": pa.array(again, pa.bool_())}
                yield pa.RecordBatch.from_pydict(columns)

    return source.mapInArrow(run, "doc_id long, h1 long, h2 long, first int, size int, again boolean")


def repeated_runs(docs: DataFrame, ends: bool) -> DataFrame:
    """``doc_id, first, size, first_doc_id`` of each run that also begins earlier: in a document of smaller id, or before in the same one.

    Rows of one doc_id count as one document. Runs are stored once; their smallest document comes from a pre-aggregated count and is joined
    back, popular runs split. Each step is stored and its shuffle files freed, so that the disk holds one shuffle of the runs at a time.
    """
    with shuffles_freed(docs.sparkSession):
        rows = kept_table(_run_rows(docs, ends), "runs")
        # Stored, so that both sides of the join are exchanges, whose hot keys can be split.
        least = rows.where(~F.col("again")).groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last")).where("first_doc_id < last")
        least = kept_table(least.drop("last"), "least")
        # A run without a row there begins in one document only.
        found = rows.join(least, ["h1", "h2"], "left").where(F.col("again") | (F.col("doc_id") > F.col("first_doc_id")))
        return kept_table(found.select("doc_id", "first", "size", F.coalesce("first_doc_id", "doc_id").alias("first_doc_id")), "repeated")


def _cut(docs: DataFrame, how: str, ends: bool) -> DataFrame:
    """The documents joined with what is cut from them."""
    cuts = repeated_runs(docs, ends).groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set(F.struct("first", "size")).alias("__cuts"), F.collect_set("first_doc_id").alias("__firsts"))
    return docs.join(cuts, F.col("doc_id").cast("long") == F.col("__id"), how)


def remaining(text: str, cuts) -> tuple[str, int]:
    """The text without the sentences of the runs, ``(first sentence, sentences)`` each, and how many they are."""
    parts = [text[a:b] for a, b in sentences(text)]
    first, size = np.asarray(cuts, dtype=np.int64).reshape(-1, 2).T
    begin, end = (np.bincount(np.minimum(x, len(parts)), minlength=len(parts) + 1) for x in (first, first + size))
    gone = (np.cumsum(begin - end)[: len(parts)] > 0).tolist()
    return "".join(p for p, g in zip(parts, gone, strict=True) if not g), sum(bool(p.strip()) for p, g in zip(parts, gone, strict=True) if g)


def _pairs(cuts: pa.ListArray) -> Iterator[np.ndarray]:
    """The runs of each row as an array of first sentence and sentences; a null has none."""
    pairs = np.column_stack([cuts.values.field(name).to_numpy() for name in ("first", "size")])
    offsets = cuts.offsets.to_numpy()
    return (pairs[a:b] for a, b in zip(offsets, offsets[1:], strict=False))


def deduplicate(docs: DataFrame, ends: bool = False) -> DataFrame:
    """``docs`` with every sentence removed from ``text`` that a repeated run covers, except where the run occurs first (smallest doc_id,
    then position); ``ends`` as in :func:`runs`. ``n_chars``, if there, is counted anew where the text changed; rows and other columns stay. Null texts and rows
    without a doc_id are left alone; a text may become empty."""
    names = docs.columns
    at, length = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [t if not len(c) or t is None else remaining(t, c)[0] for t, c in zip(old, _pairs(batch.column(len(names))), strict=True)]
            columns = list(batch.columns)[: len(names)]
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if length is not None:
                counts = [n if a == b else len(b) for n, a, b in zip(columns[length].to_pylist(), old, new, strict=True)]
                columns[length] = pa.array(counts, batch.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    joined = _cut(docs, "left", ends)
    return joined.select(*(docs[c] for c in names), joined["__cuts"]).mapInArrow(run, docs.schema)


def report(docs: DataFrame, ends: bool = False) -> DataFrame:
    """``doc_id, n_removed, first_doc_ids, text``: each document that loses sentences, how many, where their runs occur first, and the text that is left.

    Cases as in :func:`deduplicate`; documents that stay whole have no row.
    """

    def run(batches):
        for batch in batches:
            kept = [remaining(t, c) for t, c in zip(batch.column(1).to_pylist(), _pairs(batch.column(2)), strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "n_removed": pa.array([k[1] for k in kept], pa.int32()), "first_doc_ids": batch.column(3), "text": pa.array([k[0] for k in kept], pa.string())}
            )

    joined = _cut(docs.select("doc_id", "text"), "inner", ends).select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"), "__cuts", "__firsts")
    return joined.mapInArrow(run, "doc_id long, n_removed int, first_doc_ids array<long>, text string")
