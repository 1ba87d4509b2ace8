"""Quality rules: text statistics and cross-document line frequency.

Lines are normalised and hashed.  For each host (a column of the documents)
the distinct documents that hold a line are counted; a line above both
limits is boilerplate and is removed; a document that loses most of its
words, or has too few left, is rejected.  Documents of one host with equal texts count as one, so
copies of a document don't make its lines boilerplate.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from alloy.llm.common import map_arrow, pick, splittable, stored

#: Characters that count as symbols, as bytes.
SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOL = bytes(set(range(256)) - set(SYMBOLS))
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
_CONTINUED = bytes(range(0x80, 0xC0))  # bytes that aren't the first of a code point
_OTHER = re.compile(rb"[\x20\x09-\x0D]+")


def repeat_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur twice or more, the first included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    hit = np.zeros(len(words), bool)
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            hit[i:i + 3] = True
            hit[j:j + 3] = True
    return int(hit.sum())


def normalise(line: bytes) -> bytes:
    """A-Z lowered, digits as 0, words joined by one space."""
    return b" ".join(line.lower().translate(_DIGITS).split())


def statistics(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = text.split()
    chars = len(_OTHER.sub(b"", text).translate(None, _CONTINUED))
    symbols = len(text.translate(None, _NOT_SYMBOL))
    seen: set[bytes] = set()
    dups = 0
    for line in text.split(b"\n"):
        if line in seen:
            dups += 1
        elif line and not line.isspace():
            seen.add(line)
    return len(words), chars, symbols, dups, repeat_words(words)


def lines_of(text: bytes) -> dict[int, int]:
    """Hash of each distinct normalised line with a word, and the words it has in all."""
    out: dict[int, int] = {}
    for line in text.split(b"\n"):
        if norm := normalise(line):
            h = xxhash.xxh3_64_intdigest(norm) - (1 << 63)
            out[h] = out.get(h, 0) + norm.count(b" ") + 1
    return out


_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            stats = list(zip(*map(statistics, texts), strict=True))
            lines = [lines_of(t) for t in texts]
            ends = np.cumsum([0, *map(len, lines)])
            hashes = pa.array(chain.from_iterable(lines), pa.int64())
            sizes = pa.array(chain.from_iterable(x.values() for x in lines), pa.int32())
            offsets = pa.array(ends, pa.int32())
            yield pa.record_batch(
                [batch.column(0), batch.column(1),
                 pa.array(list(map(text_hash, texts)), pa.int64()),
                 *[pa.array(s, pa.int64()) for s in stats],
                 pa.ListArray.from_arrays(offsets, hashes), pa.ListArray.from_arrays(offsets, sizes)],
                ["doc_id", "host", "text_hash", *_STATS, "hashes", "sizes"])


def _measured(docs: DataFrame, host: str) -> DataFrame:
    rows = pick(docs, "doc_id", host, "text").toDF("doc_id", "host", "text").withColumn("host", _host(F.col("host")))
    return stored(map_arrow(
        rows, _measure, "doc_id long, host long, text_hash long, " + ", ".join(f"{s} long" for s in _STATS)
        + ", hashes array<long>, sizes array<int>"), "lines")


def _host(host: Column) -> Column:
    return F.xxhash64(F.isnull(host), host)


_UNIT = ["host", "text_hash"]


def _frequent(measured: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """(host, text_hash, line, size) of every text's distinct lines that are frequent."""
    lines = (measured.select(*_UNIT, F.explode(F.arrays_zip("hashes", "sizes")).alias("l"))
             .select(*_UNIT, F.col("l.hashes").alias("line"), F.col("l.sizes").alias("size"))
             .distinct())
    per_host = (measured.select(*_UNIT).distinct().groupBy("host")
                .agg(F.count("*").alias("texts")))
    frequent = (lines.groupBy("host", "line").agg(F.count("*").alias("texts_with"))
                .where(F.col("texts_with") > min_docs)
                .join(splittable(per_host, "host"), "host")
                .where(F.col("texts_with") > F.lit(max_share) * F.col("texts"))
                .select("host", "line"))
    return lines.join(splittable(frequent, "line"), ["host", "line"])


def line_quality(docs: DataFrame, host: str = "source", min_docs: int = 10, max_share: float = 0.01,
                 min_left: float = 0.3, min_words: int = 50) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed, n_words_left, kept.

    A line goes if more than ``min_docs`` distinct texts of its host hold it
    and these are over ``max_share`` of the host's distinct texts.
    n_words_left: words on the other lines.  kept: not base_failed, and at
    least ``min_left`` of the words and ``min_words`` words left: a text that
    is long enough by its boilerplate alone is depleted too.

    NULL or empty texts have no words and fail the base rule.  Documents
    without a host form a host of their own.  Lines count once per text.
    Repeated rows repeat their result, NULL ids are returned as they are,
    other columns of ``docs`` are not read.
    """
    measured = _measured(docs, host)
    frequent = _frequent(measured, min_docs, max_share)
    removed = frequent.groupBy(*_UNIT).agg(F.sum("size").alias("gone"))
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    left = n - F.coalesce("gone", F.lit(0))
    return (measured.drop("hashes", "sizes").join(splittable(removed, "text_hash"), _UNIT, "left")
            .select("doc_id", *_STATS, failed.alias("base_failed"), left.alias("n_words_left"),
                    (~failed & (left >= F.lit(min_left) * n) & (left >= min_words)).alias("kept")))


def text_hash(text: bytes | None) -> int:
    return xxhash.xxh3_64_intdigest(text or b"") - (1 << 63)


def _hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = [text_hash(t) for t in batch.column(0).cast(pa.binary()).to_pylist()]
        yield pa.record_batch([*batch.columns, pa.array(h, pa.int64())], [*batch.schema.names, "text_hash"])


def strip_lines(text: bytes, gone: set[int]) -> bytes:
    """``text`` without the lines whose normalised form has one of these hashes."""
    def stays(line: bytes) -> bool:
        norm = normalise(line)
        return not norm or xxhash.xxh3_64_intdigest(norm) - (1 << 63) not in gone
    return b"\n".join(filter(stays, text.split(b"\n")))


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [strip_lines(t, set(g)) for t, g in zip(
            batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        yield pa.record_batch([pa.array(texts, pa.binary()).cast(pa.string()), *batch.columns[1:]], batch.schema.names)


def without_frequent_lines(docs: DataFrame, host: str = "source", min_docs: int = 10,
                           max_share: float = 0.01) -> DataFrame:
    """The rows of ``docs`` (its own columns), every frequent line cut out of its texts.

    Lines are frequent as in ``line_quality``; lines without a word, and all
    texts without a frequent line, stay as they are.  A NULL text stays NULL.
    Only hashes are counted and joined; the texts are shuffled once, to meet
    the hashes of their own lines.
    """
    names = docs.columns
    frequent = _frequent(_measured(docs, host), min_docs, max_share)
    gone = stored(frequent.groupBy(*_UNIT).agg(F.collect_set("line").alias("gone")), "frequent-lines")  # lines of one text
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    text = f"_c{names.index('text')}"
    others = [c for c in flat.columns if c != text]
    rows = flat.select(F.col(text).alias("text"), *others, _host(F.col(f"_c{names.index(host)}")).alias("host"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    met = map_arrow(rows, _hash_texts, f"{fields}, text_hash long").join(splittable(gone, "text_hash"), _UNIT, "left")
    met = met.select("text", "gone", *others)
    cut = map_arrow(met.where(F.col("gone").isNotNull() & F.col("text").isNotNull()), _strip,
                    ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in met.schema))
    out = met.where(F.col("gone").isNull() | F.col("text").isNull()).unionByName(cut)
    return out.select(*[F.col("text" if c == text else c) for c in flat.columns]).toDF(*names)
