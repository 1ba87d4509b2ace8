"""Secret scan: base patterns, and a token-efficiency test for random strings.

A byte-pair vocabulary spells ordinary words and names in few tokens and
random strings in many.  Stretches of key characters with few characters
per token are reported, unless they are known digests, UUIDs or numbers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.llm.byte_bpe import encoding
from alloy.llm.common import map_arrow, pick

#: Kinds in the order that breaks ties of equal starts; the last is the method's.
KINDS = ("assign", "access", "hex", "random")

# Fixed patterns of the base rules.
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs of 32 or more: a longest run matches whole or fails whole

# The method's candidates and what it leaves out.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{14,}={0,2}")
SHORTEST = 20
#: Parts from this length on are judged if they mix letters with digits or cases, by a ratio that is less by STRICTER.
SHORT_PART = 14
STRICTER = 0.4
MIXED = re.compile(r"(?=.*[A-Za-z])(?=.*[0-9])|.*[a-z][A-Z]", re.S)
#: UUIDs, times, encoded host names, and digests of the right length with their name, as whole parts.
KNOWN = re.compile(r"(?<![A-Za-z0-9])(?:" + "|".join([
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}", r"[0-9]{8}T[0-9]{4,6}Z?", r"xn--[A-Za-z0-9-]+",
    *(rf"(?i:{name})[-_]?(?:[0-9a-fA-F]{{{2 * n}}}|[A-Za-z0-9+/_-]{{{-(-4 * n // 3)}}}={{0,2}})"
      for name, n in (("md5", 16), ("sha1", 20), ("sha224", 28), ("sha256", 32), ("sha384", 48), ("sha512", 64))),
]) + r")(?![A-Za-z0-9])")
#: Lengths of common digests in hexadecimal.
DIGEST_HEX = frozenset({32, 40, 56, 64, 96, 128})
PART = re.compile(r"[A-Za-z0-9]+")
_CAPITALS = re.compile(r"[A-Z]{4,}")
#: Parts that can be words, and the characters a token from which on they are.
WORDLIKE = re.compile(r"[A-Za-z]{3,}[0-9]{0,4}")
WORD_RATIO = 3


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base rules, in code points, end exclusive.

    A span is the whole match; matches that fail their length are dropped
    after they are matched, so a failing match still uses its characters.
    """
    low = text.lower()
    out = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if any(w in low for w in _WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return sorted(out)


def digest(run: str) -> bool:
    return len(run) in DIGEST_HEX and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", run) is not None


def without(start: int, end: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the spans leave of start to end."""
    out = []
    for s, e in sorted(spans):
        if start < s < end:
            out.append((start, s))
        start = max(start, e)
    return [*out, (start, end)] if start < end else out


def _spelled(run: str) -> str:
    return _CAPITALS.sub(lambda m: m[0].lower(), run)


def _scores(enc, run: str, max_ratio: float) -> tuple[list[int], list[float], list[int]]:
    """Of each token of a run: its end, its score, and the characters it counts for.

    A token scores ``max_ratio`` less its characters, so that a stretch with
    at most ``max_ratio`` characters a token has no score below 0.  Separators
    and numbers that are whole parts count for nothing, and a part that is
    one token, a word of the vocabulary, gains nothing.  Capitals are spelled
    as small letters: the vocabulary has few words in capitals.
    """
    ends, at = [], 0
    for t in enc.encode_ordinary(_spelled(run)):
        at += len(enc.decode_single_token_bytes(t))
        ends.append(at)
    sizes = [e - s for s, e in zip([0, *ends], ends)]
    score, counted, k = [0.0] * len(ends), [0] * len(ends), 0
    for m in PART.finditer(run):
        while ends[k] <= m.start():
            k += 1
        first = k
        while k < len(ends) and ends[k] <= m.end():
            k += 1
        if m[0].isdigit():
            continue
        for i in range(first, k):
            score[i] = max_ratio - sizes[i] if k - first > 1 else min(0.0, max_ratio - sizes[i])
            counted[i] = sizes[i]
    return ends, score, counted


def between_words(enc, run: str) -> list[tuple[int, int]]:
    """What whole parts that are words leave of a run, the separator beside a word left out too."""
    words = [m.span() for m in PART.finditer(run) if WORDLIKE.fullmatch(m[0])
             and len(m[0]) >= WORD_RATIO * len(enc.encode_ordinary(_spelled(m[0])))]
    return without(0, len(run), [(max(0, s - 1), e + 1) for s, e in words])


def random_parts(enc, run: str, max_ratio: float) -> list[tuple[int, int]]:
    """Stretches of a run with at most ``max_ratio`` characters a token, none across a part that is a word."""
    return [(s + x, s + y) for s, e in between_words(enc, run) if e - s >= SHORTEST
            for x, y in _stretches(enc, run[s:e], max_ratio)]


def _stretches(enc, run: str, max_ratio: float) -> list[tuple[int, int]]:
    """Stretches of what lies between words, names around them left out.

    Each is a stretch of the highest score, grown to whole parts if these
    still hold the ratio; of ``SHORTEST`` characters or more, three quarters
    of them in parts that count.  A run without any is one if it is as a whole.
    """
    ends, score, counted = _scores(enc, run, max_ratio)
    starts = [0, *ends]
    word = [run[s].isalnum() for s in starts[:-1]]

    def enough(i: int, j: int) -> bool:
        return (starts[j] - starts[i] >= SHORTEST and 4 * sum(counted[i:j]) >= 3 * SHORTEST
                and sum(score[i:j]) > 0)

    out, at = [], 0
    while at < len(ends):
        total, best, i, j, here = 0.0, 0.0, at, at, at
        for k in range(at, len(ends)):
            total += score[k]
            if total <= 0:
                if j > i:
                    break
                total, here = 0.0, k + 1
            elif total > best:
                best, i, j = total, here, k + 1
        if j == i:
            break
        low, high = i, j
        while low > at and word[low] and word[low - 1]:
            low -= 1
        while high < len(ends) and word[high] and word[high - 1]:
            high += 1
        for x, y in ((low, high), (i, j)):
            if enough(x, y):
                out.append((starts[x], starts[y]))
                j = y
                break
        at = j
    return out or [(0, len(run))] * enough(0, len(ends))


def short_parts(enc, run: str, max_ratio: float) -> list[tuple[int, int]]:
    """Parts of a run under ``SHORTEST`` characters that look random by the stricter ratio."""
    out = []
    for m in PART.finditer(run):
        if SHORT_PART <= len(m[0]) < SHORTEST and MIXED.match(m[0]):
            if len(m[0]) <= (max_ratio - STRICTER) * len(enc.encode_ordinary(_spelled(m[0]))):
                out.append(m.span())
    return out


def random_spans(enc, text: str, base: list[tuple[int, int, int]], max_ratio: float) -> list[tuple[int, int, int]]:
    """Random parts of the runs outside base spans, known digests and UUIDs.

    ``base`` is sorted.  What a base span leaves of a run is judged by itself.
    """
    out, at = [], 0
    for m in CANDIDATE.finditer(text):
        if digest(m[0]):
            continue
        while at < len(base) and base[at][2] <= m.start():
            at += 1
        known = [k.span() for k in KNOWN.finditer(m[0])]
        k = at
        while k < len(base) and base[k][0] < m.end():
            known.append((base[k][0] - m.start(), base[k][2] - m.start()))
            k += 1
        body = len(m[0].rstrip("="))
        for s, e in without(0, body, known):
            run = m[0][s:e]
            found = random_parts(enc, run, max_ratio) if len(run) >= SHORTEST else []
            found += [(x, y) for x, y in short_parts(enc, run, max_ratio) if all(y <= a or b <= x for a, b in found)]
            out += [(m.start() + s + x, 3, m.end() if s + y == body else m.start() + s + y) for x, y in sorted(found)]
    return out


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[secret]") -> str:
    """``text`` with every span, or chain of overlapping spans, as one mark."""
    out, at = [], 0
    for s, _, e in sorted(spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def _scan(path: str, pattern: str, max_ratio: float, redact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                given = batch.column(1).to_pylist()
                base = [base_spans(t or "") for t in given]
                both = [sorted(b + random_spans(enc, t or "", b, max_ratio)) for t, b in zip(given, base, strict=True)]
                counts = [pa.array([sum(k == n for _, k, _ in b) for b in base], pa.int64()) for n in range(3)]
                columns = [batch.column(0), *counts,
                           pa.array([hashlib.sha256(_said(b).encode()).hexdigest() for b in base]),
                           pa.array([_said(b) for b in both], pa.string())]
                names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
                if redact:
                    columns.append(pa.array([t if t is None else redacted(t, b) for t, b in zip(given, both, strict=True)], pa.string()))
                    names.append("redacted")
                    columns += batch.columns[2:]
                    names += batch.schema.names[2:]
                yield pa.record_batch(columns, names)
    return run


_RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_secrets(docs: DataFrame, path: str, pattern: str, max_ratio: float = 2.2) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    ``path`` and ``pattern``: rank file and split pattern of the vocabulary.
    A NULL or empty text has no spans.  Rows are independent: repeated rows
    repeat their result; other columns of ``docs`` are not read.
    """
    return map_arrow(pick(docs, "doc_id", "text"), _scan(path, pattern, max_ratio, False), _RESULT)


def redact_secrets(docs: DataFrame, path: str, pattern: str, max_ratio: float = 2.2) -> DataFrame:
    """``docs`` (its own columns, in order) with every span in ``text`` replaced by ``[secret]``.

    NULL texts stay NULL.  Other columns, whatever their names, are kept as they are.
    """
    names = docs.columns
    at = names.index("text")
    rest = [i for i in range(len(names)) if i != at]
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    rows = flat.select(F.lit(0).cast("long").alias("doc_id"), F.col(f"_c{at}").alias("text"),
                       *[f"_c{i}" for i in rest])
    fields = ", ".join(f"_c{i} {flat.schema[i].dataType.simpleString()}" for i in rest)
    out = map_arrow(rows, _scan(path, pattern, max_ratio, True),
                    f"{_RESULT}, redacted string" + (", " + fields if rest else ""))
    return out.select(*[F.col("redacted" if i == at else f"_c{i}") for i in range(len(names))]).toDF(*names)
