"""Secret scans: fixed patterns, and an assignment-aware lexer that scores literals by the names they are assigned to."""

from __future__ import annotations

import bisect
import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.common import whole_text

MASK = "[SECRET]"
THRESHOLD = 1.0
"""Score from which a literal counts as a secret: name weight times literal strength, at most 2."""

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

# Assignments: a name (quoted or not, perhaps indexed), a sign, and a value. Values are one or more joined literals, a name, or a bare word.
_LITERAL = r"""(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`)"""
# A name is looked for where a word starts only, and possessive repeats never go back, so the time is linear in the text.
_PAIR = re.compile(rf"""(?<![\w.-])[\d.-]*+(?P<name>[A-Za-z_][\w.-]*+)["'`]?\]?[\x20\t]*(?P<sign>:=|=>|:|=(?!=))[\x20\t]*(?:(?P<lits>{_LITERAL}(?:[\x20\t]*+(?:[+.][\x20\t]*+)?(?:\n[\x20\t]*+)?{_LITERAL})*)|(?P<ref>\$?\{{?[A-Za-z_][\w.]*\}}?(?=[\s,;)\]]|$))|(?P<bare>[^\s"'`,;(){{}}\[\]<>]+))""")
_TAG = re.compile(r"<(?P<name>[A-Za-z_][\w.-]*)>(?P<bare>[^<>\s]+)</(?P=name)>")
_ONE = re.compile(_LITERAL)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

#: Fixed weights of name parts, and of pairs of parts.
_WEIGHTS = {
    "password": 2.0, "passwd": 2.0, "passphrase": 2.0, "pwd": 2.0, "secret": 2.0, "token": 1.6, "apikey": 2.0, "credential": 1.6, "credentials": 1.6, "auth": 1.2, "bearer": 1.4,
    "api key": 2.0, "access key": 2.0, "private key": 2.0, "secret key": 2.0, "signing key": 2.0, "encryption key": 2.0, "client secret": 2.0, "account key": 1.8, "connection string": 1.6,
}
_PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|changeme|change_me|none|null|true|false|example|placeholder|redacted|your[_-].*|<.*>|\$\{.*\}|\{\{.*\}\}|%\(.*\)s)$")


def name_weight(name: str) -> float:
    """How sensitive a target name is: 0 to 2, by its parts in camel, snake, kebab or dotted case."""
    parts = [p.lower() for p in _PART.findall(name)]
    pairs = [" ".join(x) for x in zip(parts, parts[1:], strict=False)]
    return max([_WEIGHTS.get(x, 0.0) for x in (*parts, *pairs)], default=0.0)


def literal_strength(value: str) -> float:
    """0 to 1: longer and less regular literals are stronger; placeholders and short ones are nothing."""
    if len(value) < 8 or _PLACEHOLDER.match(value) or " " in value:
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", r"\d", r"[^A-Za-z0-9]"))
    return min(1.0, entropy / 3) * (1.0 if kinds > 1 or entropy > 3 else 0.6)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, kind number, end)`` of the fixed patterns, ends exclusive. A match that is too short is dropped, and what it covers with it."""
    found, low = [], text.lower()
    if any(name in low for name in _NAMES):  # cheaper than the pattern, which most texts need not meet
        found += [(m.start(), "assign", m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), "hex", m.end()) for m in _HEX.finditer(text)]
    return found


def _assignments(text: str):
    """``(name, literal, start, end, reference)``: name-literal pairs of source and configuration syntax, or a name and the name it refers to."""
    for m in _PAIR.finditer(text):
        name = m["name"]
        if m["lits"]:
            parts = list(_ONE.finditer(text, m.start("lits"), m.end("lits")))
            yield name, "".join(p[0][1:-1] for p in parts), parts[0].start() + 1, parts[-1].end() - 1, None
        elif m["ref"]:
            yield name, m["ref"], m.start("ref"), m.end("ref"), m["ref"].strip("${}")
        elif text[m.end() : m.end() + 1] not in ("(", "[") and (m["sign"] != ":" or name_weight(name)):  # a call or an index is no literal
            yield name, m["bare"], m.start("bare"), m.end("bare"), None
    for m in _TAG.finditer(text):
        yield m["name"], m["bare"], m.start("bare"), m.end("bare"), None


def lexed_spans(text: str) -> list[tuple[int, str, int]]:
    """Literals that reach a sensitive name, directly or over other names.

    Every name takes the highest weight of the names that refer to it, so a constant counts as what it is used for; references
    may come before or after the constant and may form circles.
    """
    if "=" not in text and ":" not in text and "</" not in text:
        return []
    literals, refers, bound = [], {}, set()
    for name, value, start, end, ref in _assignments(text):
        if ref is None or ref == name:
            bound.add(name)
        else:
            refers.setdefault(name, set()).add(ref)
        literals.append((name, value, start, end, ref))
    weights = _weights({name for name, *_ in literals}, refers)
    found = []
    for name, value, start, end, ref in literals:
        if ref is not None and ref != name and (ref in bound or _is_code(text, value, start)):  # what a name stands for is looked at where it is bound
            continue
        if weights[name] and weights[name] * literal_strength(value) >= THRESHOLD:
            found.append((start, "lexed", end))
    return found


def _is_code(text: str, value: str, start: int) -> bool:
    """Whether an unquoted word is a name of source code: set off by a blank, without a digit. Configuration writes words like ``key=word`` or with digits."""
    return text[start - 1 : start] in (" ", "\t") and not any(c.isdigit() for c in value)


def _weights(names: set[str], refers: dict[str, set[str]]) -> dict[str, float]:
    """The highest weight among each name and the names that refer to it, over any steps: the heaviest names hand theirs on first, so each name is met once."""
    weights: dict[str, float] = {}
    for name in sorted(names | refers.keys(), key=lambda n: (-name_weight(n), n)):
        open_names, own = [name], name_weight(name)
        while open_names:
            at = open_names.pop()
            if at not in weights:
                weights[at] = own
                open_names += refers.get(at, ())
    return weights


_ORDER = {"assign": 0, "access": 1, "hex": 2, "lexed": 3}


def spans(text: str) -> tuple[list, list]:
    """Base spans, and all spans, ``(start, kind, end)`` in order. A lexed literal inside or across a base span is that span."""
    base = sorted(base_spans(text), key=lambda s: (s[0], _ORDER[s[1]]))
    covered: list[list[int]] = []
    for start, _, end in base:  # what the base spans cover, without overlaps
        if covered and start <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], end)
        else:
            covered.append([start, end])
    extra = [s for s in lexed_spans(text) if not _meets(covered, s[0], s[2])]
    return base, sorted(base + extra, key=lambda s: (s[0], _ORDER[s[1]]))


def _meets(covered: list[list[int]], start: int, end: int) -> bool:
    at = bisect.bisect_left(covered, [end]) - 1
    return at >= 0 and covered[at][1] > start


def _written(found: list) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in found)


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_lexed`` of every row's whole text.

    Spans are ``kind:start:end`` in code points, ends exclusive, by start and then kind, joined by commas. Null and empty texts have none (their
    digest is that of the empty string). Repeated rows and null ids stay; no rows give no rows; other columns are not read.
    """

    def run(batches):
        for batch in batches:
            out = {"doc_id": batch.column(0)} | {name: [] for name in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_lexed")}
            for text in batch.column(1):
                base, every = spans(text.as_py())
                kinds = Counter(kind for _, kind, _ in every)
                for name in ("assign", "access", "hex", "lexed"):
                    out[f"n_{name}"].append(kinds[name])
                out["base_sha256"].append(hashlib.sha256(_written(base).encode()).hexdigest())
                out["spans"].append(_written(every))
            yield pa.RecordBatch.from_pydict({k: v if k == "doc_id" else pa.array(v, pa.int64() if k.startswith("n_") else pa.string()) for k, v in out.items()})

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    return source.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_lexed long")


def masked(text: str) -> str:
    """The text with every span, overlapping ones together, replaced by MASK."""
    out, at = [], 0
    for start, _, end in spans(text)[1]:
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in ``text`` masked and ``n_chars``, if there, counted anew where the text changed. All rows and columns stay; null texts stay null."""
    names = docs.columns
    at, length = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batches):
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [t if t is None else masked(t) for t in old]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if length is not None:
                counts = [n if a == b else len(b) for n, a, b in zip(columns[length].to_pylist(), old, new, strict=True)]
                columns[length] = pa.array(counts, batch.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
