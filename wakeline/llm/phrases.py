"""Phrase collocations: suffixes are sorted by multikey three-way quicksort; the sizes of equal partitions are the phrases' counts.

Each task sorts the suffix pointers of its own texts first, which counts the phrases of every length in them before anything moves. The
counts are routed by the words that lead them and sorted once more where they arrive: what is equal there is all there is, so partitions
below the smallest count are abandoned. Phrases of each length are routed by all their words: one leading word, or two, may stand before
a third of all words, but a phrase has one count a block.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wakeline.llm.common import kept_table, whole_text

WORDS, LEAST, TOP = 3, 10, 2000
"""Words of the longest phrase, occurrences of the rarest, phrases reported a language."""
INSIDE = 50
"""A phrase goes if a longer one around it has this percentage of its occurrences."""
PIECE = 1 << 22
"""Bytes of texts whose suffixes are sorted together."""
UNKNOWN = "und"

_BREAK, _NOTHING = b"\n", b""
_SPACE = re.compile(rb"[\x20\x09]")
_PIECES = bytes.maketrans(b"\t.,;:!?\x0b\x0c\x0dABCDEFGHIJKLMNOPQRSTUVWXYZ", b" \n\n\n\n\n\n\n\n\nabcdefghijklmnopqrstuvwxyz")


def multikey(keys: np.ndarray, weights: np.ndarray, sizes: np.ndarray, least: int = 1):
    """Three-way quicksort of rows by ``keys`` (a line of codes for each column; negative: the row ends before). The rows come in
    partitions of ``sizes``. Yields ``(columns, rows, weights)``: of every equal partition, the number of columns it agrees in, one of its
    rows and its weight, if that is ``least`` or more.

    All open partitions are split side by side: each picks the key of one of its rows, and its rows are below, equal to, or above that
    key. The equal part goes on with the next column. Parts that weigh less than ``least`` are abandoned with all that they hold.
    """
    count, flat, draw = keys.shape[1], keys.ravel(), np.random.default_rng(keys.size)
    rows, column, alone = np.arange(count), np.zeros(len(sizes), dtype=np.int64), []
    while len(rows):
        key = flat[np.repeat(column * count, sizes) + rows]
        starts = np.cumsum(sizes) - sizes
        pivot = key[starts + (draw.random(len(sizes)) * sizes).astype(np.int64)]
        spread = np.repeat(pivot, sizes)
        parts = []
        for is_equal, side in ((0, key < spread), (1, key == spread), (0, key > spread)):
            size = np.add.reduceat(side, starts, dtype=np.int64)
            some = size > 0
            if not some.any():
                continue
            mine, size = rows[side], size[some]
            begin = np.cumsum(size) - size
            weight = np.add.reduceat(weights[mine], begin)
            at, heavy = column[some], weight >= least
            if is_equal:
                heavy &= pivot[some] >= 0  # rows that have ended are done
                for c in np.unique(at[heavy]):
                    chosen = heavy & (at == c)
                    yield int(c) + 1, mine[begin[chosen]], weight[chosen]
                at = at + 1
            heavy &= at < len(keys)
            single = heavy & (size == 1)
            alone.append((mine[begin[single]], at[single]))
            stays = heavy & ~single
            parts.append((mine[np.repeat(stays, size)], size[stays], at[stays]))
        rows, sizes, column = (np.concatenate(x) for x in zip(*parts, strict=True))
    if alone:  # single rows need no more sorting
        rows, column = (np.concatenate(x) for x in zip(*alone, strict=True))
        for c in range(len(keys)):
            going = column > c
            going[~going] = keys[c, rows[~going]] >= 0
            rows, column = rows[going], column[going]
            here = column <= c
            yield c + 1, rows[here], weights[rows[here]]


def _tokens(text: bytes) -> list[bytes]:
    """Words, and a break wherever a piece ends; some entries are empty."""
    return text.translate(_PIECES).replace(_BREAK, b" \n ").split(b" ")


def _parts(text: bytes, words: int):
    """A text in parts of about PIECE bytes, cut at a space, and what follows each: the rest of phrases that start in it."""
    at = 0
    while at < len(text) or at == 0:
        cut = _SPACE.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield text[at:end], re.compile(rb"(?:[\x20\x09]*[^\x20\x09]+){0,%d}" % (words - 1)).match(text, end).group()
        at = end + 1


def _sorted_block(block: list[tuple[bytes, bytes, str]], words: int, buckets: int) -> pa.RecordBatch:
    """Counts of all phrases of up to ``words`` words, and of all words (an empty phrase), that start in a block of (part, what follows,
    language): one row a bucket and language, its phrases one after the other with a line break behind each."""
    number: dict[bytes, int] = defaultdict(itertools.count().__next__)
    number[_BREAK], number[_NOTHING]
    block = sorted(block, key=lambda entry: entry[2])
    langs, sizes = np.unique([lang for *_, lang in block], return_counts=True)
    codes, starts = [], []
    for part, ahead, _ in block:
        own = _tokens(part)
        rest = [*_tokens(ahead), _BREAK]
        found = np.fromiter(map(number.__getitem__, own + rest), np.int64, len(own) + len(rest))
        start = np.arange(len(found)) < len(own)
        start, found = start[found != 1], found[found != 1] - 2  # a break is negative
        codes.append(found)
        starts.append(start & (found >= 0))
    words_of = np.add.reduceat([int(s.sum()) for s in starts], np.cumsum(sizes) - sizes)
    names = list(number)[2:]
    at = np.flatnonzero(np.concatenate(starts))
    codes = np.concatenate([*codes, np.full(words, -1)]).astype(np.int32)
    keys, going = np.full((words, len(at)), -1, dtype=np.int32), np.ones(len(at), dtype=bool)
    for k in range(words):
        going &= codes[at + k] >= 0
        keys[k, going] = codes[at[going] + k]
    lang = np.repeat(np.arange(len(langs)), words_of)
    some = words_of > 0
    first = (np.cumsum(words_of) - words_of)[some]
    found = [(np.zeros(len(first), dtype=np.int64), first, words_of[some])]
    found += ((np.full(len(rows), length), rows, size) for length, rows, size in multikey(keys, np.ones(len(at), dtype=np.int64), words_of[some]))
    depth, rows, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
    # The bucket follows from the words of the phrase: it is the same in every block.
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))
    route = np.zeros(len(rows), dtype=np.uint64)
    for k in range(words):
        longer = depth > k
        route[longer] = (route[longer] ^ hashes[keys[k, rows[longer]]]) * np.uint64(0x9E3779B97F4A7C15)
    group = ((route >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64) * len(langs) + lang[rows]
    order = np.argsort(group, kind="stable")
    group, depth, rows, sizes = group[order], depth[order], rows[order], sizes[order]
    named = pa.array(names, pa.binary())
    columns = [named.take(pa.array(keys[k, rows], mask=depth <= k)) for k in range(words)]
    phrases = pc.binary_join_element_wise(columns[0].fill_null(b""), *columns[1:], b" ", null_handling="skip")
    lines = pc.binary_join_element_wise(phrases, b"", b"\n")
    # Adjacent phrases become one value: the same bytes with fewer borders.
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)])
    borders = pa.array(np.r_[first, len(group)], pa.int32())
    offsets = np.frombuffer(lines.buffers()[1], dtype=np.int32, count=len(lines) + 1)[np.r_[first, len(group)]]
    packed = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(np.ascontiguousarray(offsets)), lines.buffers()[2]])
    counts = pa.ListArray.from_arrays(borders, pa.array(sizes, pa.int64()))
    lang_column = pa.array(langs[group[first] % len(langs)].tolist(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(group[first] // len(langs), pa.int64()), lang_column, packed, counts], ["bucket", "lang", "phrases", "counts"])


def block_counts(docs: DataFrame, words: int, buckets: int) -> DataFrame:
    """``bucket, lang, phrases, counts``: the phrases of up to ``words`` words of blocks of texts, dealt into ``buckets``."""

    def run(batches):
        for batch in batches:
            block, room = [], 0
            for i in range(batch.num_rows):
                lang = batch.column(0)[i].as_py()
                for part, ahead in _parts(batch.column(1)[i].as_py(), words):
                    block.append((part, ahead, lang))
                    room += len(part)
                    if room >= PIECE:
                        yield _sorted_block(block, words, buckets)
                        block, room = [], 0
            if block:
                yield _sorted_block(block, words, buckets)

    source = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), whole_text(F.col("text")).cast("binary").alias("data"))
    return source.mapInArrow(run, "bucket long, lang string, phrases binary, counts array<long>")


def _sum_bucket(rows: list[tuple[str, bytes, np.ndarray]], words: int, least: int) -> pa.RecordBatch:
    """Whole counts of the phrases of one bucket, of those with ``least`` or more (an empty phrase always)."""
    rows = sorted(rows, key=lambda row: row[0])
    data = np.frombuffer(b"".join(lines for _, lines, _ in rows), dtype=np.uint8)
    ends = np.flatnonzero(data == 10)
    weights = np.concatenate([counts for *_, counts in rows])
    langs, kinds = np.unique([lang for lang, *_ in rows], return_inverse=True)
    lang = np.repeat(kinds, [len(counts) for *_, counts in rows])
    # A line is a value of the same bytes; the break behind it would be its last word's end.
    offsets = np.r_[0, ends + 1].astype(np.int64)
    lines = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    phrases = pc.binary_slice(lines, 0, -1)
    parts = pc.split_pattern(phrases, b" ")
    coded = parts.values.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    start = parts.offsets.to_numpy()
    sizes = np.where(pc.binary_length(phrases).to_numpy() > 0, np.diff(start), 0)
    keys = np.full((words, len(sizes)), -1, dtype=np.int32)
    for k in range(words):
        at = np.flatnonzero(sizes > k)
        keys[k, at] = coded[start[at] + k]
    empty = np.flatnonzero(sizes == 0)
    totals = np.bincount(lang[empty], weights[empty], len(langs)).astype(np.int64)
    found, totals = [np.unique(lang[empty], return_index=True)[1]], [totals[totals > 0]]
    found[0] = empty[found[0]]
    for length in range(1, words + 1):  # each phrase travels with its whole size, so lengths are sorted apart
        own = np.flatnonzero(sizes == length)
        per_lang = np.bincount(lang[own], minlength=len(langs))
        for depth, first, size in multikey(keys[:length, own], weights[own], per_lang[per_lang > 0], least):
            if depth == length:
                found.append(own[first])
                totals.append(size)
    chosen = np.concatenate(found)
    return pa.RecordBatch.from_arrays([pa.array(langs[lang[chosen]].tolist(), pa.string()), phrases.take(pa.array(chosen)).cast(pa.binary()), pa.array(np.concatenate(totals), pa.int64())], ["lang", "phrase", "f"])


def phrase_counts(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """``lang, phrase, f``: every phrase of 1 to ``words`` words that comes ``least`` times or more within pieces, words joined by a space.

    The empty phrase counts all words of its language, however few they are. Texts are lower-cased (A-Z) and split into pieces at
    ``. , ; : ! ?`` and line breaks; words are what spaces and tabs separate. A null lang is ``und``; null and empty texts have no words.
    A task sorts one bucket at a time, an eighth of a shuffle partition.
    """
    buckets = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    routed = block_counts(docs, words, buckets).repartition("bucket").sortWithinPartitions("bucket")

    def run(batches):
        held, bucket = [], None
        for batch in batches:
            for row in range(batch.num_rows):
                if bucket is not None and batch.column(0)[row].as_py() != bucket:
                    yield _sum_bucket(held, words, least)
                    held = []
                bucket = batch.column(0)[row].as_py()
                held.append((batch.column(1)[row].as_py(), batch.column(2)[row].as_py(), batch.column(3)[row].values.to_numpy()))
        if held:
            yield _sum_bucket(held, words, least)

    return routed.mapInArrow(run, "lang string, phrase binary, f long")


def collocations(docs: DataFrame, words: int = WORDS, least: int = LEAST, inside: int = INSIDE, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two to ``words`` words in each language, by score, then ``a``
    (both descending), then phrase (by its bytes).

    ``a``, ``l`` and ``r`` count the phrase and its two parts at the cut that scores lowest (the first of equal ones), ``n`` all words of
    the language; the score is a millionfold ``a * a / (l * r)``, rounded down, exact for counts up to 10^15. A phrase that comes ``least``
    times at least goes if a longer one of these holds its words side by side and has ``inside`` percent of its occurrences. Repeated rows count as
    often as they come; no rows, and languages without such phrases, give no rows. Columns other than lang and text are not read.
    """
    counts = kept_table(phrase_counts(docs, words, least), "phrases").select("lang", F.col("phrase").cast("string").alias("phrase"), "f")
    totals = counts.where("phrase = ''").select("lang", F.col("f").alias("n"))  # one row a language
    split = F.split("phrase", " ")
    candidates = counts.where("phrase <> ''").select("lang", "phrase", F.col("f").alias("a"), split.alias("w")).where(F.size("w") > 1)
    best = _lowest_cut(candidates, counts)
    covered = _inner(candidates, words).groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    free = best.join(covered, ["lang", "phrase"], "left").where(F.col("around").isNull() | (100 * F.col("around") < inside * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)  # each task sends its own best only
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _lowest_cut(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of each candidate, at its lowest-scoring cut."""
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("w") - 1),
        lambda k: F.struct(k.alias("k"), F.array_join(F.slice("w", 1, k), " ").alias("left"), F.array_join(F.slice("w", k + 1, F.size("w")), " ").alias("right")),
    )
    cut = kept_table(candidates.select("lang", F.col("phrase").alias("of"), "a", F.inline(cuts)), "cuts")  # stored: a hot part is split when joined
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    both = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    square = F.col("a").cast("decimal(19,0)") * F.col("a").cast("decimal(19,0)")
    scored = both.withColumn("score", F.call_function("div", (square * F.lit(1000000)).cast("decimal(38,0)"), F.col("l").cast("decimal(19,0)") * F.col("r").cast("decimal(19,0)")))
    lowest = scored.groupBy("lang", "of").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("m"))
    return lowest.select("lang", F.col("of").alias("phrase"), "m.a", "m.l", "m.r", "m.score")


def _inner(candidates: DataFrame, words: int) -> DataFrame:
    """``lang, phrase, a``: the shorter phrases of two words or more inside each candidate, with the candidate's count."""
    parts = F.flatten(
        F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda size: F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda at: F.array_join(F.slice("w", at, size), " ")))
    )
    return candidates.where(F.size("w") > 2).select("lang", F.explode(parts).alias("phrase"), "a")
