"""Benchmark decontamination by a broadcast hash set of the benchmark's word windows.

Every window of ``size`` consecutive words of a benchmark item (all words of
a shorter item) is hashed.  The set of hashes, the windows' words and the
items that hold each window are broadcast; a task slides the same window over
the words of its documents, looks each up, compares the words of a hit one by
one, and marks the words it covers.  So the documents are scanned once, no
text is shuffled, and a passage that a third of the documents share is no
group of its own.

What is broadcast is bounded: a benchmark of more than ``max_bytes`` is dealt
into parts of that size, and the documents are scanned once for each, the
marks of the former scans being kept with them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import map_arrow, pick, stored

SIZE = 10
#: Bytes of words of a benchmark part; its arrays and vocabulary take some 30 times that at most.
MAX_BYTES = 4 << 20
CHUNK = 4096  # windows of a long item that are dealt together
PIECE = 1 << 20  # bytes of a text that are split into words at once
SEED = 11
#: Of a lowered text: digits, a to z, and all bytes of non-ASCII characters.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9a-z\x80-\xff]")


def pieces(text: bytes) -> Iterator[bytes]:
    """A lowered text in pieces of about ``PIECE`` bytes, cut between words."""
    at = 0
    while len(text) - at > PIECE:
        gap = _GAP.search(text, at + PIECE)
        end = gap.end() if gap else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


# ------------------------------------------------------------------ the set

@dataclass(frozen=True)
class Windows:
    """Distinct windows of one length, by hash: a place of each in the part's words, and its items."""
    size: int
    hashes: np.ndarray  # sorted
    starts: np.ndarray
    ends: np.ndarray  # window i is held by items[ends[i]:ends[i + 1]]
    items: np.ndarray


@dataclass(frozen=True)
class Part:
    vocabulary: dict[bytes, int]
    ids: np.ndarray  # words of all rows, -1 after each
    names: list[str | None]
    windows: tuple[Windows, ...]
    seed: int


def _known(ids: np.ndarray, size: int) -> np.ndarray:
    """Places where a window of ``size`` words of the vocabulary starts."""
    if len(ids) < size:
        return np.zeros(0, np.int64)
    seen = np.concatenate([[0], np.cumsum(ids >= 0)])
    return np.flatnonzero(seen[size:] - seen[:-size] == size)


def _hash(ids: np.ndarray, at: np.ndarray, size: int, seed: int) -> np.ndarray:
    times = np.random.default_rng([SEED, size, seed]).integers(1, 1 << 63, size, dtype=np.uint64)
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out += (ids[at + k].astype(np.uint64) + np.uint64(1)) * times[k]
    return out


def _same(a: np.ndarray, at: np.ndarray, b: np.ndarray, bt: np.ndarray, size: int) -> np.ndarray:
    """Whether the windows at ``at`` of a and ``bt`` of b have equal words."""
    out = np.ones(len(at), bool)
    for k in range(size):
        out &= a[at + k] == b[bt + k]
    return out


def part_of(rows: list[tuple[str | None, bytes]], size: int = SIZE, seed: int = 0) -> Part:
    """The set of (item, words joined by a space) rows."""
    vocabulary: dict[bytes, int] = {}
    names: dict[str | None, int] = {}
    ids, owner, starts = [], [], {}
    at = 0
    for name, text in rows:
        item = names.setdefault(name, len(names))
        row = [vocabulary.setdefault(w, len(vocabulary)) for w in text.split(b" ")]
        n = min(size, len(row))
        starts.setdefault(n, []).append(np.arange(at, at + len(row) - n + 1))
        ids += [*row, -1]
        owner += repeat(item, len(row) + 1)
        at += len(row) + 1
    ids, owner = np.array(ids, np.int32), np.array(owner, np.int32)
    made = []
    for n, places in sorted(starts.items()):
        places = np.concatenate(places)
        h = _hash(ids, places, n, seed)
        order = np.argsort(h, kind="stable")
        h, places = h[order], places[order]
        first = np.concatenate([[True], h[1:] != h[:-1]])
        group = np.cumsum(first) - 1
        if not _same(ids, places, ids, places[first][group], n).all():  # two windows of one hash
            return part_of(rows, size, seed + 1)
        held = np.unique(group * len(names) + owner[places])
        ends = np.searchsorted(held, np.arange(group[-1] + 2) * len(names))
        made.append(Windows(n, h[first], places[first], ends, (held % len(names)).astype(np.int32)))
    return Part(vocabulary, ids, list(names), tuple(made), seed)


def _hits(ids: np.ndarray, part: Part) -> Iterator[tuple[Windows, np.ndarray, np.ndarray]]:
    """For each length: places of ``ids`` where a window occurs, and which."""
    for w in part.windows:
        at = _known(ids, w.size)
        h = _hash(ids, at, w.size, part.seed)
        which = np.minimum(np.searchsorted(w.hashes, h), len(w.hashes) - 1)
        maybe = w.hashes[which] == h
        at, which = at[maybe], which[maybe]
        sure = _same(ids, at, part.ids, w.starts[which], w.size)
        yield w, at[sure], which[sure]


# ------------------------------------------------------------------ the scan

def _runs(hit: np.ndarray) -> np.ndarray:
    """First word and the one after the last of each run of hit words, in turn."""
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))


def scan(texts: list[bytes | None], before: list[list[int]], held: list[list[str | None]], part: Part):
    """For each text its number of words, runs of hit words and items, those of former parts included."""
    get, rows = part.vocabulary.get, []
    for t in texts:
        low = t.lower() if t else b""
        for piece in pieces(low):
            found = WORD.findall(piece)
            rows.append(np.fromiter(map(get, found, repeat(-1)), np.int32, len(found)))
        rows.append(np.array([-2], np.int32))  # ends the text
    ids = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    ends = np.flatnonzero(ids == -2)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    change = np.zeros(len(ids) + 1, np.int64)
    pairs = [np.zeros((2, 0), np.int64)]
    for w, at, which in _hits(ids, part):
        np.add.at(change, at, 1)
        np.add.at(change, at + w.size, -1)
        doc = np.searchsorted(ends, at)
        seen = np.unique(doc * len(w.hashes) + which)  # each window of a text once
        doc, which = seen // len(w.hashes), seen % len(w.hashes)
        n = w.ends[which + 1] - w.ends[which]
        place = np.repeat(w.ends[which], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        pairs.append(np.stack([np.repeat(doc, n), w.items[place]]))
    hit = np.cumsum(change)[:-1] > 0
    doc, item = np.unique(np.concatenate(pairs, axis=1), axis=1)
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    for k in range(len(texts)):
        mask = hit[starts[k]:ends[k]]
        for a, b in zip(before[k][::2], before[k][1::2], strict=True):
            mask[a:b] = True
        items = {part.names[i] for i in item[cut[k]:cut[k + 1]]} | set(held[k])
        yield len(mask), _runs(mask), sorted(items, key=lambda s: (s is None, s or ""))


def _scan_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = batch.column(0).cast(pa.binary()).to_pylist()
                found = list(scan(texts, batch.column(2).to_pylist(), batch.column(3).to_pylist(), part))
                yield pa.record_batch(
                    [batch.column(0), pa.array([n for n, _, _ in found], pa.int64()),
                     pa.array([r.tolist() for _, r, _ in found], pa.list_(pa.int32())),
                     pa.array([i for _, _, i in found], pa.list_(pa.string())), *batch.columns[4:]], batch.schema.names)
    return run


def _item_chunks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = words_of(text)
                ends = range(0, max(len(words) - size + 1, min(len(words), 1)), CHUNK)
                rows = [b" ".join(words[a:a + CHUNK + size - 1]) for a in ends]
                yield pa.record_batch([pa.array([name] * len(rows), pa.string()), pa.array(rows, pa.binary())],
                                      ["item", "words"])
    return run


def _parts(benchmark: DataFrame, size: int, max_bytes: int) -> Iterator[Part]:
    """The benchmark's sets, each of about ``max_bytes`` of words and never above twice that."""
    rows = pick(benchmark, "item_id", "text").select(F.col("item_id").cast("string").alias("item"), "text")
    chunks = stored(map_arrow(rows, _item_chunks(size), "item string, words binary").distinct(), "benchmark")
    total = chunks.agg(F.sum(F.length("words"))).first()[0] or 0
    n = max(1, -(-total // max_bytes))
    part = F.pmod(F.xxhash64("words", F.lit(SEED)), F.lit(n))
    while n > 1:
        most = chunks.groupBy(part.alias("p")).agg(F.sum(F.length("words")).alias("n")).agg(F.max("n")).first()[0]
        if most <= 2 * max_bytes:
            break
        n *= 2
        part = F.pmod(F.xxhash64("words", F.lit(SEED)), F.lit(n))
    for p in range(n):
        got = chunks.where(part == p).collect()  # at most 2 * max_bytes
        if got:
            yield part_of([(r["item"], bytes(r["words"])) for r in got], size)


def _found(docs: DataFrame, benchmark: DataFrame, size: int, max_bytes: int) -> DataFrame:
    """Columns of ``docs`` by place (_c0, _c1, …) with __text, __n, __runs and __items."""
    if max_bytes < 64 << 10:
        raise ValueError("max_bytes: a chunk of an item would not fit")
    text = F.col(f"_c{docs.columns.index('text')}")
    flat = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    rows = flat.select(text.alias("__text"), F.lit(0).cast("long").alias("__n"),
                       F.array().cast("array<int>").alias("__runs"), F.array().cast("array<string>").alias("__items"),
                       *[c for c in flat.columns if c != f"_c{docs.columns.index('text')}"])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    # a benchmark without words has no part: one empty part counts the words
    for k, part in enumerate(list(_parts(benchmark, size, max_bytes)) or [Part({}, np.zeros(0, np.int32), [], (), 0)]):
        if k:
            rows = stored(rows, "contamination")
        rows = map_arrow(rows, _scan_batches(docs.sparkSession.sparkContext.broadcast(part)), schema)
    return rows


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, max_bytes: int = MAX_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, runs, items.

    ``docs``: doc_id, text; ``benchmark``: item_id, text.  Words are runs of
    digits, letters a to z and non-ASCII characters after A-Z are lowered.  A
    window is ``size`` consecutive words of an item; an item of fewer, but
    not none, is one window.  n_hit: the document's words inside any
    occurrence of a window.  runs: for each run of hit words the number of
    its first word and of the one after its last (from 0), in turn.  items:
    the ids, as text and sorted, of the items with windows that occur.

    A NULL or empty text has no words.  Rows of one item id are one item,
    each row windowed by itself; rows without an id are one item too, whose
    name is NULL.  Repeated documents repeat their result, NULL ids are
    returned as they are, an empty benchmark hits nothing, and other columns
    are not read.
    """
    found = _found(pick(docs, "text", "doc_id"), benchmark, size, max_bytes)
    n_hit = F.aggregate(F.transform("__runs", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)),
                        F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(F.col("_c1").alias("doc_id"), F.col("__n").alias("n_words"), n_hit.alias("n_hit"),
                        F.col("__runs").alias("runs"), F.col("__items").alias("items"))


def cut_runs(text: bytes, runs: list[int]) -> bytes:
    """``text`` without its runs of words; what stood before and after a run stays."""
    out, at, word, places = [], 0, 0, iter(runs)
    start, end = next(places, None), next(places, None)
    if start is None:
        return text
    for m in WORD.finditer(text.lower()):
        if word == start:
            out.append(text[at:m.start()])
        word += 1
        if word == end:
            at = m.end()
            start, end = next(places, None), next(places, None)
            if start is None:
                break
    return b"".join([*out, text[at:]])


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [None if t is None else cut_runs(t, r) for t, r in zip(
            batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        yield pa.record_batch([pa.array(texts, pa.binary()).cast(pa.string()), *batch.columns[1:]], batch.schema.names)


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "spans", size: int = SIZE,
                   max_bytes: int = MAX_BYTES) -> DataFrame:
    """The rows of ``docs`` (its own columns) without what the benchmark holds.

    ``remove``: ``spans`` cuts each run of hit words out of the text and
    keeps all rows; ``documents`` drops every document with a hit word.  See
    ``contamination`` for words, windows and odd rows.
    """
    if remove not in ("spans", "documents"):
        raise ValueError("remove: spans or documents")
    at = docs.columns.index("text")
    found = _found(docs, benchmark, size, max_bytes)
    if remove == "documents":
        found = found.where(F.size("__runs") == 0)
    else:
        found = found.select("__text", "__runs", *[f"_c{i}" for i in range(len(docs.columns)) if i != at])
        found = map_arrow(found, _cut_batches, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema))
    return found.select(*[F.col("__text" if i == at else f"_c{i}") for i in range(len(docs.columns))]).toDF(*docs.columns)
