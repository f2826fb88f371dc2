"""Byte-pair encoding of pieces, and its decoding: every prefix of a text has one last token, found with an automaton.

A sequence of tokens is the encoding of its text exactly if each two neighbours are the encoding of theirs. So the last token of a prefix
is the one match ending there that goes with the last token of the prefix before it. The table of last tokens is filled from the left, and
the ids are read from it backwards.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import whole_text

SPACE = "▁"
"""Stands for a space in the pieces."""
WORDS_KEPT, PAIRS_KEPT = 1 << 17, 1 << 19
"""Encoded words (twice as many at most, the latest), and tested pairs of tokens, that a Python worker remembers; what is forgotten is found anew."""
LONGEST = 64
"""Bytes of the longest word that is encoded together with others, and remembered."""
TOGETHER = 1 << 15
"""Words encoded side by side."""
BLOCK = 1 << 22
"""Bytes of texts that are split into words together; a longer text is split alone."""


class Pieces:
    """The pieces of a model file: texts, scores and kinds, and what follows from them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.texts = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.scores = [model.get_score(i) for i in range(model.vocab_size())]
        kinds = {"byte": model.is_byte, "control": model.is_control, "unknown": model.is_unknown, "unused": model.is_unused}
        self.kinds = [next((k for k, test in kinds.items() if test(i)), "normal") for i in range(model.vocab_size())]
        self.ids = {t: i for i, (t, k) in enumerate(zip(self.texts, self.kinds, strict=True)) if k == "normal"}
        self.bytes = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.texts, self.kinds, strict=True)) if k == "byte"}
        self._check(model)
        #: Codes beside the ids: what stands before a text, and a byte of a character that is no piece.
        self.before, self.stranger = len(self.texts), len(self.texts) + 1
        self.lengths = np.array([*(len(_raw(t)) for t in self.texts), 0, 1], dtype=np.int64)
        self._byte_id = np.array([self.bytes[b] for b in range(256)], dtype=np.int64)
        self._pairs, self._good = np.empty(0, dtype=np.int64), np.empty(0, dtype=bool)
        self._recent: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def _check(self, model) -> None:
        """Only models are read that do not normalise, put a space before the text, and whose pieces hold a space at their start only."""
        sample = "  a\tAÅﬁ　 ​  b \n"
        if model.normalize(sample) != SPACE + sample.replace(" ", SPACE) or len(self.bytes) != 256 or "unused" in self.kinds:
            raise ValueError("the model normalises texts, has no byte pieces or has unused pieces")
        if any(SPACE in t.lstrip(SPACE) or any(c not in self.ids for c in t) for t in self.ids):
            raise ValueError("a piece has a space after other characters, or a character that is no piece")

    def _merge(self, text: str) -> list:
        """The merges of a text in their order: best score first, leftmost of equal ones. Returns the tree of each symbol left."""
        symbols: list = list(text)
        strings = list(text)
        while True:
            best, at = None, -1
            for i in range(len(strings) - 1):
                piece = self.ids.get(strings[i] + strings[i + 1])
                if piece is not None and (best is None or self.scores[piece] > best):
                    best, at = self.scores[piece], i
            if best is None:
                return symbols
            symbols[at : at + 2] = [(symbols[at], symbols[at + 1])]
            strings[at : at + 2] = [strings[at] + strings[at + 1]]

    def goes(self, left: int, right: int) -> bool:
        """Whether the encoding of the texts of two codes is these two. Nothing merges with a character that is no piece."""
        if left >= self.before:
            return True
        # Where no symbol at the end of one ever meets its match at the start of the other, nothing merges across.
        if not any(a + b in self.ids for a in self.spines[left][1] for b in self.spines[right][0]):
            return True
        symbols = self._merge(self.texts[left] + self.texts[right])
        return len(symbols) == 2 and len(_text(symbols[0])) == len(self.texts[left])

    def all_go(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """:meth:`goes` for arrays of codes; each pair is tested once, as long as it is remembered."""
        pairs = left * np.int64(len(self.lengths)) + right
        at = np.searchsorted(self._pairs, pairs)
        known = at < len(self._pairs)
        known[known] = self._pairs[at[known]] == pairs[known]
        if not known.all():
            new = np.unique(pairs[~known])
            good = np.array([self.goes(*divmod(p, len(self.lengths))) for p in new.tolist()], dtype=bool)
            if len(self._pairs) > PAIRS_KEPT:
                wanted = np.unique(at[known])
                self._pairs, self._good = self._pairs[wanted], self._good[wanted]
            to = np.searchsorted(self._pairs, new)
            self._pairs, self._good = np.insert(self._pairs, to, new), np.insert(self._good, to, good)
            at = np.searchsorted(self._pairs, pairs)
        return self._good[at]

    @functools.cached_property
    def spines(self) -> dict[int, tuple]:
        """Of every piece that its own text is encoded to, what stands first and last in it while it is merged. Only encoding needs them."""
        return {i: s for t, i in self.ids.items() if (s := _spines(self._merge(t))) is not None}

    @functools.cached_property
    def _automaton(self):
        """An automaton, over bytes, of the pieces that a text of theirs is encoded to."""
        import ahocorasick

        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i in self.spines:
            automaton.add_word(_raw(self.texts[i]).decode("latin-1"), i)
        automaton.make_automaton()
        return automaton

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of words (the bytes of 32-bit numbers), found side by side: the tables of last tokens lie one after the other, a gap before each."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        first = np.cumsum(sizes + 1) - sizes
        data = b"\0" + b"\0".join(words)
        found = np.fromiter(self._automaton.iter(data.decode("latin-1")), np.dtype("i4,i4"))
        end, piece = found["f0"], found["f1"]  # by end, longest first
        place = np.arange(len(end), dtype=np.int32)
        rank = place - np.maximum.accumulate(np.where(np.r_[True, end[1:] != end[:-1]][: len(end)], place, 0))
        width = int(rank.max(initial=0)) + 1
        within = np.arange(len(data), dtype=np.int32) - np.repeat(first, sizes + 1).astype(np.int32)  # a word's own places; its gap has -1
        step = within[end] * width + rank
        order = np.argsort(step.astype(np.int16 if LONGEST * width < 1 << 15 else np.int32), kind="stable")
        end, piece, step = end[order], piece[order].astype(np.int64), step[order]
        reach = end - self.lengths[piece]
        last = np.full(len(data), -1, dtype=np.int64)
        last[first - 1] = self.before
        longer = np.arange(len(words))
        bounds = np.searchsorted(step, np.arange(width * int(sizes.max(initial=0)) + 1)).tolist()
        for s, (low, high) in enumerate(itertools.pairwise(bounds)):
            if high > low:
                open_ = np.flatnonzero(last[end[low:high]] < 0) + low
                open_ = open_[self.all_go(last[reach[open_]], piece[open_])]
                last[end[open_]] = piece[open_]
            if s % width == width - 1:  # no match goes up to these bytes
                longer = longer[sizes[longer] > s // width]
                here = first[longer] + s // width
                last[here[last[here] < 0]] = self.stranger
        return self._read_back(np.frombuffer(data, dtype=np.uint8), last, first, sizes)

    def _read_back(self, data: np.ndarray, last: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Ids from the tables of last tokens, backwards, for all words at once."""
        at, owner = first + sizes - 1, np.arange(len(first))
        ids, owners = [np.empty(0, dtype=np.int64)], [owner[:0]]
        while True:
            left = at >= first[owner]
            at, owner = at[left], owner[left]
            if not at.size:
                break
            code = last[at]
            ids.append(np.where(code == self.stranger, self._byte_id[data[at]], code))
            owners.append(owner)
            at = at - self.lengths[code]
        owner = np.concatenate(owners[::-1])
        flat = np.concatenate(ids[::-1])[np.argsort(owner.astype(np.uint16 if len(first) < 1 << 16 else np.int64), kind="stable")].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(first)))).tolist()
        return [flat[low:high] for low, high in itertools.pairwise([0, *ends])]

    def encode_long(self, word: bytes) -> list[int]:
        """The ids of one word of any length, in time linear in it."""
        size, done = len(word), 0
        last: list = [-1] * size + [self.before]  # the entry before the first is the last one
        known: dict[tuple[int, int], bool] = {}
        lengths = self.lengths.tolist()
        for end, piece in self._automaton.iter(word.decode("latin-1")):
            if last[end] >= 0:
                continue
            for at in range(done, end):  # no match goes up to these bytes
                if last[at] < 0:
                    last[at] = self.stranger
            done = max(done, end)
            pair = (last[end - lengths[piece]], piece)
            if pair not in known:
                if len(known) >= PAIRS_KEPT:
                    known.clear()
                known[pair] = self.goes(*pair)
            if known[pair]:
                last[end] = piece
        at, ids = size, []
        while at:
            code = last[at - 1]
            known_code = 0 <= code < self.before
            ids.append(code if known_code else self.bytes[word[at - 1]])
            at -= lengths[code] if known_code else 1
        return ids[::-1]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in UTF-8 one after the other, and the borders between texts."""
        number: dict[bytes, int] = defaultdict(itertools.count().__next__)
        parts, borders = [np.empty(0, dtype=np.int64)], [0]
        for t in texts:
            words = _WORD.findall(b" " + t.replace(_SPACE, b" ")) if t else []
            parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            borders.append(borders[-1] + len(words))
        found = self._ids_of(list(number))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), dtype=np.int32)
        words = np.concatenate(parts)
        ends = np.r_[0, np.cumsum(sizes[words])]
        shift = (np.cumsum(sizes) - sizes)[words] - ends[:-1]
        return flat[np.arange(ends[-1]) + np.repeat(shift, sizes[words])], ends[borders]

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words. Those that are not remembered are encoded together."""
        if len(self._recent) > WORDS_KEPT:
            self._recent, self._older = {}, self._recent
        known, older, new, long = self._recent, self._older, [], {}
        for w in words:
            if w not in known:
                if w in older:
                    known[w] = older[w]
                elif len(w) > LONGEST:
                    long[w] = np.array(self.encode_long(w), dtype=np.int32).tobytes()
                else:
                    new.append(w)
        for at in range(0, len(new), TOGETHER):
            part = new[at : at + TOGETHER]
            known.update(zip(part, self.encode_words(part), strict=True))
        return [known[w] if w in known else long[w] for w in words]

    @functools.cached_property
    def _surfaces(self) -> list[str]:
        kept = {"normal": lambda t: t.replace(SPACE, " "), "control": lambda t: "", "unknown": lambda t: " ⁇ "}
        return [kept[k](t) if k in kept else "" for t, k in zip(self.texts, self.kinds, strict=True)]

    @functools.cached_property
    def _byte_of(self) -> np.ndarray:
        out = np.full(len(self.texts), -1, dtype=np.int16)
        out[list(self.bytes.values())] = list(self.bytes)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, byte pieces as UTF-8 (a byte that is none: U+FFFD), without the space put before the text."""
        values = self._byte_of[ids]
        parts: list[str] = list(map(self._surfaces.__getitem__, ids.tolist()))
        at = np.flatnonzero(values >= 0)
        if at.size:
            for run in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
                parts[run[0]] = _utf8(values[run].astype(np.uint8).tobytes())
        first = next((i for i, p in enumerate(parts) if p), None)
        if first is not None and self.kinds[ids[first]] == "normal":
            parts[first] = parts[first].removeprefix(" ")
        return "".join(parts)


_SPACE = SPACE.encode("utf-8")
_WORD = re.compile(rb" +[^ ]*|[^ ]+")


def _raw(piece: str) -> bytes:
    """A piece as the words hold it: in UTF-8, with spaces."""
    return piece.replace(SPACE, " ").encode("utf-8")


def _text(symbol) -> str:
    return symbol if isinstance(symbol, str) else _text(symbol[0]) + _text(symbol[1])


def _spines(symbols: list) -> tuple[tuple[str, ...], tuple[str, ...]] | None:
    """The symbols that stand first, and those that stand last, while a piece is merged; None if it does not merge to itself."""
    if len(symbols) != 1:
        return None
    sides = []
    for side in (0, -1):
        symbol, found = symbols[0], []
        while not isinstance(symbol, str):
            found.append(_text(symbol))
            symbol = symbol[side]
        sides.append((*found, symbol))
    return tuple(sides)


def _utf8(data: bytes) -> str:
    """UTF-8 with one U+FFFD for each byte that does not belong to a character."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError as wrong:
        return data[: wrong.start].decode("utf-8") + "�" + _utf8(data[wrong.start + 1 :])


@functools.cache
def load(path: str) -> Pieces:
    """The pieces of a file, read once in a Python worker."""
    return Pieces(path)


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` of every row: the ids of its whole text by the model file ``path`` (on every executor), none added at either end.
    With ``decoded`` also ``text``, decoded from the ids in the same pass as :func:`decode` does.

    Null and empty texts have no ids (an empty list); a null doc_id stays null; repeated rows are returned as often as they come; no
    rows give no rows. Other columns are not read. Rows are independent, nothing is shuffled; a text without spaces is one word, encoded
    in time linear in its length.
    """
    names = ["doc_id", "ids", "text"] if decoded else ["doc_id", "ids"]

    def run(batches):
        pieces = load(path)
        for batch in batches:
            texts, room = [], 0
            for i in range(batch.num_rows):
                texts.append(batch.column(1)[i].as_py())
                room += len(texts[-1])
                if room >= BLOCK or i + 1 == batch.num_rows:
                    ids, borders = pieces.encode(texts)
                    columns = [batch.column(0).slice(i + 1 - len(texts), len(texts)), pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(ids, pa.int32()))]
                    if decoded:
                        columns.append(pa.array([pieces.decode(ids[a:b]) for a, b in itertools.pairwise(borders.tolist())], pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, names)
                    texts, room = [], 0

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).cast("binary").alias("data"))
    return source.mapInArrow(run, "doc_id long, ids array<int>" + (", text string" if decoded else ""))


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text`` of every row with ``doc_id, ids``: the text of its ids. Null ids give a null text, no ids an empty one.

    An id that the model does not have, also a null in a list, is an error.
    """

    def run(batches):
        pieces = load(path)
        for batch in batches:
            texts = [None if not ids.is_valid else pieces.decode(ids.values.to_numpy()) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, ids array<int>, text string")
