"""Periodic runs, piece encoding and collocations against brute force, the library and SQL, with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from wakeline.llm import phrases, pieces, queries, runs, secret_scan

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ", ids int, runs string, f double, bucket string, route int, w int, n long, a string, phrase int, best int"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def odd_rows(rng):
    rows = [(i, " ".join(rng.choice("ab cd ef gh".split()) for _ in range(rng.randrange(0, 300))), rng.choice(["en", "de", None]), "a", 1) for i in range(60)]
    rows += [(100 + i, "x y z " * rng.randrange(1, 60) + "end", "en", "b", 1) for i in range(30)]
    rows += [(200, None, None, None, None), (201, "", "en", "", 0), (202, " \n\t ", "und", "a", 3), (203, "One", "en", "a", 3), (203, "One", "en", "a", 3)]
    rows += [(None, "no id, no id, no id", "en", "a", 9), (-7, "w " * 50_000 + "!", "de", "b", 1), (204, "Größe ß 漢字 😀 İ▁x\u0000", "fr", "ü", 1), (205, "q" * 100_000, "en", "a", 1)]
    return rows


def table(spark, rows, extra=True):
    if extra:
        return spark.createDataFrame([(*r, 1, "r", 0.5, "k", 2, 3, 4, "x", 5, 6) for r in rows], COLUMNS + CLASHING)
    return spark.createDataFrame(rows, COLUMNS)


# ---------------------------------------------------------------- periodic runs


def brute_runs(words, least=24, times=3):
    found = []
    for p in range(1, len(words) // times + 1):
        same = [words[i] == words[i + p] for i in range(len(words) - p)]
        for equal, group in itertools.groupby(range(len(same)), key=same.__getitem__):
            group = list(group)
            start, length = group[0], len(group) + p
            if equal and length >= max(least, times * p):
                inside = words[start : start + length]
                if not any(inside[q:] == inside[:-q] for q in range(1, p)):
                    found.append((start, length, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least, times", [(24, 3), (3, 3), (6, 3), (5, 4)])
def test_runs_of_many_texts_at_once(least, times):
    rng = random.Random(least)
    for _ in range(60):
        texts = []
        for _ in range(rng.randrange(1, 5)):
            words = [rng.randrange(rng.choice([1, 2, 3, 8])) for _ in range(rng.randrange(0, 120))]
            if words and rng.random() < 0.6:
                a = rng.randrange(len(words))
                p = 1 + rng.randrange(max(1, (len(words) - a) // 3))
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
            texts.append(words)
        flat = np.array([w for words in texts for w in words], dtype=np.int64)
        got = runs.find_runs(flat, np.repeat(np.arange(len(texts)), [len(w) for w in texts]), least, times)
        base, want = 0, []
        for words in texts:
            want += [(s + base, n, p) for s, n, p in brute_runs(words, least, times)]
            base += len(words)
        assert [tuple(r) for r in got.tolist()] == want


def brute_report(doc_id, text):
    """The columns of op11 by plain loops."""
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    dropped = {i for s, length, p in found for i in range(s + p, s + length)}
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    digest = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digest)


def test_op11_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()]
    want = [brute_report(r.doc_id, r.text) for r in docs if len((r.text or "").split()) < 4000]
    assert len(got) == len(docs) and set(want) <= set(got)
    assert sum(r[1] > 0 for r in want) > 5


def test_runs_of_odd_rows(spark):
    rows = [r for r in odd_rows(random.Random(1)) if r[0] != -7]
    got = runs.periodic_runs(table(spark, rows)).collect()
    want = []
    for doc_id, text, *_ in rows:
        words = WORD.findall(text or "")
        found = brute_runs(words)
        dropped = {i for s, length, p in found for i in range(s + p, s + length)}
        want.append((doc_id, len(words), found, " ".join(w for i, w in enumerate(words) if i not in dropped)))
    plain = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got]
    assert sorted(map(repr, plain)) == sorted(map(repr, want))
    long = runs.periodic_runs(table(spark, [(1, "w " * 200_000 + "end", "en", "a", 1)])).first()
    assert [tuple(r) for r in long.runs] == [(0, 200_000, 1)] and long.collapsed == "w end"
    assert runs.periodic_runs(spark.createDataFrame([], COLUMNS)).collect() == []
    with pytest.raises(ValueError):
        runs.periodic_runs(table(spark, rows), times=2)


def test_a_text_in_parts_has_the_same_runs(monkeypatch):
    data = ("a b c " * 40 + "d\ne " * 3 + "f g " * 30).encode()
    whole = runs._search([data, b"", data[:50]], 24, 3)
    monkeypatch.setattr(runs, "PIECE", 7)
    parts = runs._search([data, b"", data[:50]], 24, 3)
    assert [(n, own.tolist(), text) for n, own, text in whole] == [(n, own.tolist(), text) for n, own, text in parts]


# ---------------------------------------------------------------- piece encoding


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def encoded(texts):
    flat, borders = pieces.load(MODEL).encode([t.encode() for t in texts])
    return [flat[a:b].tolist() for a, b in itertools.pairwise(borders)]


def test_encoding_and_decoding_equal_the_library(library):
    rng = random.Random(3)
    bits = ["  ", "   ", " ", "a", "b", "e", "t", "h", "in", "ing", "\n", "\t", "é", "漢", "梦", "😀", "▁", "▁▁", "0", "==", "----", "//", "​", "\x00", "ﬁ", "<0x0A>", "<s>", "the"]
    texts = ["", " ", "a"] + ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 40))) for _ in range(3000)]
    ranges = [(32, 127), (0x20, 0x3000), (0x4E00, 0x9FFF), (0x1F300, 0x1F600)]
    texts += ["".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(30)) for _ in range(1000)]
    want = library.encode(texts)
    assert encoded(texts) == want
    model = pieces.load(MODEL)
    assert [model.decode(np.array(ids, dtype=np.int64)) for ids in want] == library.decode(want)
    loose = [[rng.choice([rng.randrange(0, 260), rng.randrange(0, 32000)]) for _ in range(rng.randrange(0, 9))] for _ in range(3000)]
    assert [model.decode(np.array(ids, dtype=np.int64)) for ids in loose] == [library.decode(ids) for ids in loose]


@pytest.mark.parametrize("text", ["a" * 30_000, "abcdef0123456789" * 3000, " " * 30_000, "漢😀x" * 5000, "the" * 10_000, "x" * 65 + " " + "é" * 100])
def test_long_words(library, text):
    assert encoded([text]) == [library.encode(text)]


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(pieces, "WORDS_KEPT", 20)
    monkeypatch.setattr(pieces, "PAIRS_KEPT", 50)
    monkeypatch.setattr(pieces, "TOGETHER", 7)
    rng, model = random.Random(4), pieces.Pieces(MODEL)
    for _ in range(20):
        texts = [" ".join("".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 12))) for _ in range(30)) for _ in range(5)]
        flat, borders = model.encode([t.encode() for t in texts])
        assert [flat[a:b].tolist() for a, b in itertools.pairwise(borders)] == library.encode(texts)


def test_every_pair_of_neighbours_is_its_own_encoding(library):
    model = pieces.load(MODEL)
    for text in ("internationalisation", "xxyyzz" * 5, "Donaudampfschifffahrt"):
        ids = library.encode(text)
        assert all(model.goes(a, b) for a, b in itertools.pairwise(ids))


def test_op12_equals_the_library(spark, library):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for r in docs:
        ids = library.encode(r.text or "")
        want.add((r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    got = [tuple(r) for r in queries.op12_piece_tokens(spark, SF).collect()]
    assert len(got) == len(docs) and set(got) == want


def test_pieces_of_odd_rows(spark, library):
    rows = odd_rows(random.Random(2))
    coded = pieces.encode(table(spark, rows), MODEL)
    assert sorted(map(repr, (tuple(r) for r in coded.collect()))) == sorted(repr((r[0], library.encode(r[1] or ""))) for r in rows)
    back = pieces.decode(coded, MODEL)
    assert sorted(map(repr, ((r.doc_id, r.text) for r in back.collect()))) == sorted(repr((r[0], (r[1] or "").replace("▁", " "))) for r in rows)
    both = pieces.encode(table(spark, rows), MODEL, decoded=True)
    assert sorted(map(repr, (tuple(r) for r in both.collect()))) == sorted(map(repr, (tuple(r) for r in back.collect())))
    assert pieces.decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>"), MODEL).orderBy("doc_id").collect()[0].text is None
    empty = pieces.encode(spark.createDataFrame([], COLUMNS), MODEL)
    assert empty.collect() == [] and pieces.decode(empty, MODEL).collect() == []


# ---------------------------------------------------------------- collocations


def test_multikey_counts_equal_partitions():
    rng = random.Random(1)
    for _ in range(150):
        n, columns, values = rng.randrange(0, 150), rng.randrange(1, 5), rng.choice([1, 2, 5, 50])
        keys = np.full((columns, n), -1)
        for i in range(n):
            for k in range(rng.randrange(0, columns + 1)):
                keys[k, i] = rng.randrange(values)
        weights = np.array([rng.randrange(1, 4) for _ in range(n)], dtype=np.int64)
        group = np.sort(np.array([rng.randrange(3) for _ in range(n)], dtype=np.int64))
        sizes = np.bincount(group, minlength=3)
        for least in (1, 3, 10):
            want = Counter()
            for i in range(n):
                for k in range(columns):
                    if keys[k, i] < 0:
                        break
                    want[(group[i], *keys[: k + 1, i].tolist())] += int(weights[i])
            got = [((group[r], *keys[:c, r].tolist()), int(w)) for c, rows, sums in phrases.multikey(keys, weights, sizes[sizes > 0], least) for r, w in zip(rows, sums, strict=True)]
            assert len(got) == len(dict(got)) and dict(got) == {k: v for k, v in want.items() if v >= least}


def brute_collocations(rows, words=3, least=10, inside=50, top=2000):
    counts, totals = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            counts.update((lang, tuple(w[i : i + k])) for k in range(1, words + 1) for i in range(len(w) - k + 1))
    found = {key: f for key, f in counts.items() if f >= least and len(key[1]) > 1}
    around = Counter()
    for (lang, w), f in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                around[lang, w[i : i + k]] = max(around[lang, w[i : i + k]], f)
    out = []
    for lang in sorted(totals):
        scored = []
        for (of, w), a in found.items():
            if of == lang and not (around[of, w] and 100 * around[of, w] >= inside * a):
                cuts = [(1_000_000 * a * a // (counts[of, w[:k]] * counts[of, w[k:]]), k) for k in range(1, len(w))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(w).encode(), counts[of, w[:k]], counts[of, w[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return out


def test_collocations_equal_brute_force(spark):
    rows = odd_rows(random.Random(3)) + [(1000 + i, "New  York, new\tyork! NEW YORK. kick the bucket; kick the bucket\x0bkick the", "en", "a", 1) for i in range(5)]
    for top in (2000, 3):
        got = [tuple(r) for r in phrases.collocations(table(spark, rows).repartition(5), top=top).orderBy("lang", "rank").collect()]
        assert got == brute_collocations(rows, top=top) and got
    got = phrases.collocations(table(spark, rows, extra=False), words=4, least=3, inside=80).orderBy("lang", "rank").collect()
    assert [tuple(r) for r in got] == brute_collocations(rows, 4, 3, 80)
    assert phrases.collocations(spark.createDataFrame([], COLUMNS)).collect() == []
    assert phrases.collocations(table(spark, [(1, "", None, None, 0), (2, None, "en", None, 0), (3, "rare words only", "en", "a", 1)])).collect() == []


def test_a_text_in_parts_has_the_same_phrases(monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice(["aa ", "b ", "c. ", "d,e ", "\t", "f\n"]) for _ in range(400)).encode()

    def counted(size):
        monkeypatch.setattr(phrases, "PIECE", size)
        out = Counter()
        for part, ahead in phrases._parts(text, 3):
            found = phrases._sorted_block([(part, ahead, "en")], 3, 5).to_pydict()
            for lines, counts in zip(found["phrases"], found["counts"], strict=True):
                out.update(dict(zip(lines.split(b"\n")[:-1], counts, strict=True)))
        return out

    assert counted(1 << 20) == counted(11) == counted(1)


def test_phrases_of_a_hot_language_and_hot_pair(spark):
    """A third of all phrases start with one pair of words; each phrase still has one count a block."""
    rng = random.Random(6)
    rows = [(i, " ".join(f"of the w{rng.randrange(30)} x{rng.randrange(300)}" for _ in range(20)), "en", "a", 1) for i in range(200)]
    got = [tuple(r) for r in phrases.collocations(table(spark, rows).repartition(9)).orderBy("lang", "rank").collect()]
    assert got == brute_collocations(rows)


# ---------------------------------------------------------------- secret scans in linear time


def quick(call):
    started = time.perf_counter()
    out = call()
    assert time.perf_counter() - started < 10  # quadratic search takes hours
    return out


def test_lexing_is_linear():
    assert quick(lambda: secret_scan.spans("x=1 " + "g" * 1_000_000)) == ([], [])
    assert quick(lambda: secret_scan.spans("a.b-" * 250_000 + " : ")) == ([], [])
    assert quick(lambda: secret_scan.spans('k = "v"' + " " * 300_000 + "x")) == ([], [])
    chain = "\n".join(f"c{i} = c{i + 1}" for i in range(50_000)) + '\nc50000 = "Zx81-kkQ9-pl0w"\npassword = c0\n'
    (_, found) = quick(lambda: secret_scan.spans(chain))
    assert [chain[s:e] for s, _, e in found] == ["Zx81-kkQ9-pl0w"]
    many = "".join(f'api_key = "Ab{i:08d}cdEF"\nthe_passphrase = "Qw{i:06d}-zxcV"\n' for i in range(10_000))
    base, every = quick(lambda: secret_scan.spans(many))
    assert len(base) == 10_000 and len(every) == 20_000


@pytest.mark.parametrize(
    "text, want",
    [
        ("secret = get_secret('x')", []),
        ('signing_key = os.environ["KEY_NAME"]', []),
        ("passphrase = other_name\n", []),
        ("client_pwd=correcthorse7battery\n", ["correcthorse7battery"]),
        ('const a = "hT5-kLp9-wQz2";\nconst pwd = a;', ["hT5-kLp9-wQz2"]),
        ('pwd = mid\nmid = last\nlast = "hT5-kLp9-wQz2"', ["hT5-kLp9-wQz2"]),
        ('last = "hT5-kLp9-wQz2"\nplain = last', []),
        ("<passphrase>hT5-kLp9-wQz2</passphrase>", ["hT5-kLp9-wQz2"]),
        ('1pwd: "hT5-kLp9" + \n "-wQz2"', ['hT5-kLp9" + \n "-wQz2']),
    ],
)
def test_lexed_literals(text, want):
    assert [text[s:e] for s, kind, e in secret_scan.spans(text)[1] if kind == "lexed"] == want
