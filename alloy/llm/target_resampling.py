"""Importance resampling towards a target distribution, weighed by bit-sliced sums.

Every word and every pair of neighbouring words of a text falls into one of
10,000 buckets.  A bucket's gain is the logarithm of its share in the target
against its share in all documents, in whole thousandths.  A document's
weight is the mean gain of its features, and its sum is taken bit by bit:
the document's counts become planes of 10,000 bits (bit j of every count),
the gains become planes too (bit k of every positive, and of every negative
gain), and each pair of planes adds the number of bits they share times two
to the power of j + k.  All of it is whole numbers, so a weight is exact and
does not depend on any order.

A Gumbel draw from the hash of the document's id is added, and the highest
scores are drawn.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from alloy.llm.common import map_arrow, pick, stored
from alloy.llm.decontaminate import WORD, pieces

BUCKETS = 10_000
SEED = 7
MIN_WORDS = 20
PERCENT = 25
CHUNK_DOCS = 256  # documents whose planes are in memory together


# ------------------------------------------------------------------ features

class _Words(dict):
    """word → crc32 of the word and of the word with a space after it."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) > 100_000:
            self.clear()
        c = zlib.crc32(word)
        out = self[word] = c, zlib.crc32(b" ", c)
        return out


_words = _Words()


def features(text: bytes | None, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every word and every pair of neighbours."""
    found, n, last = [], 0, None
    for piece in pieces((text or b"").lower()):
        words = WORD.findall(piece)
        if not words:
            continue
        sums = [_words[w] for w in words]
        starts = [s for _, s in sums]
        found.append(np.fromiter((c for c, _ in sums), np.int64, len(words)))
        heads = starts[:-1] if last is None else [last, *starts[:-1]]
        tails = words[1:] if last is None else words
        found.append(np.fromiter(map(zlib.crc32, tails, heads), np.int64, len(tails)))
        n, last = n + len(words), starts[-1]
    return n, (np.concatenate(found) if found else np.zeros(0, np.int64)) % buckets


def _count(buckets: int, rows: bool):
    """Rows of a document's buckets and counts, and after a task's last one the task's totals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, last = np.zeros(buckets, np.int64), None
        for whole in batches:
            last = whole
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                n_words, n_features, kinds, counts = [], [], [], []
                for t in batch.column(0).cast(pa.binary()).to_pylist():
                    n, found = features(t, buckets)
                    b, c = np.unique(found, return_counts=True)
                    total[b] += c
                    n_words.append(n)
                    n_features.append(len(found))
                    kinds.append(b)
                    counts.append(c)
                if rows:
                    ends = pa.array(np.cumsum([0, *map(len, kinds)]), pa.int32())
                    yield pa.record_batch(
                        [pa.array([False] * batch.num_rows), pa.array(n_words, pa.int64()), pa.array(n_features, pa.int64()),
                         pa.ListArray.from_arrays(ends, pa.array(np.concatenate(kinds), pa.int32())),
                         pa.ListArray.from_arrays(ends, pa.array(np.concatenate(counts), pa.int64())), *batch.columns[1:]],
                        ["total", "n_words", "n_features", "buckets", "counts", *batch.schema.names[1:]])
        if last is not None and total.any():
            some = np.flatnonzero(total)
            yield pa.record_batch(
                [pa.array([True]), pa.array([0], pa.int64()), pa.array([int(total.sum())], pa.int64()),
                 pa.array([some.tolist()], pa.list_(pa.int32())), pa.array([total[some].tolist()], pa.list_(pa.int64())),
                 *[pa.nulls(1, c.type) for c in last.columns[1:]]],
                ["total", "n_words", "n_features", "buckets", "counts", *last.schema.names[1:]])
    return run


def counted(docs: DataFrame, buckets: int = BUCKETS, rows: bool = True) -> DataFrame:
    """(total, n_words, n_features, buckets, counts, other columns) of ``docs`` (first column: the text).

    One row per document, if ``rows``, and one per task with ``total`` true
    and the task's sums.
    """
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema[1:])
    schema = "total boolean, n_words long, n_features long, buckets array<int>, counts array<long>"
    return map_arrow(docs, _count(buckets, rows), f"{schema}, {fields}" if fields else schema)


def _totals(rows: DataFrame, buckets: int) -> np.ndarray:
    """Count of each bucket: as many rows as there are buckets come to the driver."""
    pairs = rows.where("total").select(F.explode(F.arrays_zip("buckets", "counts")).alias("x"))
    sums = pairs.groupBy(F.col("x.buckets").alias("b")).agg(F.sum("x.counts").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in sums:
        out[r["b"]] = r["n"]
    return out


# ------------------------------------------------------------------ weights

def gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Each bucket's gain in whole thousandths: floor(1000 ln((t+1)(S+B) / ((s+1)(T+B))))."""
    more = float(len(raw))
    top, bottom = float(raw.sum()) + more, float(target.sum()) + more
    return np.array([math.floor(1000 * math.log((float(t) + 1) * top / ((float(s) + 1) * bottom)))
                     for t, s in zip(target, raw, strict=True)], np.int64)


def _pack(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), bool)
    wide[:, :bits.shape[1]] = bits
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


def bitplanes(values: np.ndarray) -> np.ndarray:
    """Plane k holds bit k of each of the values (not negative)."""
    n = int(values.max(initial=0)).bit_length()
    return _pack(((values[None, :] >> np.arange(n)[:, None]) & 1).astype(bool))


def sums(row: np.ndarray, bucket: np.ndarray, count: np.ndarray, n_rows: int, buckets: int,
         plus: np.ndarray, minus: np.ndarray) -> np.ndarray:
    """Sum of count times gain of each row, by planes."""
    out = np.zeros(n_rows, np.int64)
    for j in range(int(count.max(initial=0)).bit_length()):
        have = (count >> j) & 1 == 1
        at, where = np.unique(row[have], return_inverse=True)
        bits = np.zeros((len(at), buckets), bool)
        bits[where, bucket[have]] = True
        plane = _pack(bits)
        part = np.zeros(len(at), np.int64)
        for signed, sign in ((plus, 1), (minus, -1)):
            for k, gain in enumerate(signed):
                part += sign * (np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64) << k)
        out[at] += part << j
    return out


def _weigh(gain: np.ndarray):
    plus, minus, n = bitplanes(np.maximum(gain, 0)), bitplanes(np.maximum(-gain, 0)), len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK_DOCS):
                batch = whole.slice(at, CHUNK_DOCS)
                held = batch.column(1)
                ends = np.diff(np.asarray(held.offsets))
                row = np.repeat(np.arange(batch.num_rows), ends)
                total = sums(row, np.asarray(held.flatten(), np.int64), np.asarray(batch.column(2).flatten(), np.int64),
                             batch.num_rows, n, plus, minus)
                size = np.asarray(batch.column(0), np.int64)
                weight = np.where(size > 0, total // np.maximum(size, 1), 0)
                yield pa.record_batch([pa.array(weight, pa.int64()), batch.column(0), *batch.columns[3:]],
                                      ["weight", "n_features", *batch.schema.names[3:]])
    return run


def gumbel(key: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) of a share u from the first 8 hex digits of sha256(``seed:key``)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _weighed(rows: DataFrame, target: DataFrame, buckets: int, seed: int, min_words: int) -> DataFrame:
    """weight, n_features, doc_id, score, may (takes part), other columns; first column of ``rows``: the text."""
    found = stored(counted(rows, buckets), "features")
    aim = _totals(counted(pick(target, "text"), buckets, rows=False), buckets)
    gain = gains(aim, _totals(found, buckets))
    others = [c for c in rows.columns if c not in ("text", "doc_id")]
    doc = found.where(~F.col("total")).select(
        "n_features", "buckets", "counts", "n_words", "doc_id", *others)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in doc.schema[3:])
    out = map_arrow(doc, _weigh(gain), f"weight long, n_features long, {fields}")
    return stored(out.select("weight", "n_features", "doc_id", *others, (F.col("n_words") >= min_words).alias("may"),
                             (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score")), "weights")


def _ranked(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` with rank: 1, 2, … of the drawn ones, highest score first, ties to the smaller doc_id; else NULL.

    Scores are whole numbers between some -10^5 and 10^5: their counts come
    to the driver and give the least score that can be drawn.  Only rows from
    there on are sorted, dealt by range over the partitions, and numbered by
    the counts of the partitions before theirs.
    """
    counts = {r["score"]: r["n"] for r in rows.where("may").groupBy("score").agg(F.count("*").alias("n")).collect()}
    k = sum(counts.values()) * percent // 100
    least, above = None, 0
    for s in sorted(counts, reverse=True):
        if above >= k:
            break
        least, above = s, above + counts[s]
    none = F.lit(None).cast("long").alias("rank")
    if least is None:
        return rows.select("*", none)
    drawn = F.col("may") & (F.col("score") >= least)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("__salt")]
    sorted_ = (rows.where(drawn).withColumn("__salt", F.monotonically_increasing_id())  # equal rows can be parted
               .repartitionByRange(*order).sortWithinPartitions(*order)
               .withColumn("__at", F.monotonically_increasing_id()).drop("__salt"))
    sorted_ = stored(sorted_, "drawn")
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted(sorted_.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())  # one row a partition
    before, at = [], 0
    for r in sizes:
        before.append((r["p"], at))
        at += r["n"]
    offsets = rows.sparkSession.createDataFrame(before, "__p long, __before long")
    rank = F.col("__before") + place + 1
    numbered = (sorted_.join(F.broadcast(offsets), part == F.col("__p"))  # one row a partition
                .select(*rows.columns, F.when(rank <= k, rank).alias("rank")))
    return rows.where(~drawn).select("*", none).unionByName(numbered)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank.

    ``docs``: doc_id, text; ``target``: text.  Words as in
    ``decontaminate.contamination``; features are all words and all pairs of
    neighbours, repeats counted.  weight: the floored mean of the features'
    gains, 0 without features.  Of the documents with at least ``min_words``
    words ``percent`` in a hundred are drawn: rank 1, 2, … by score, ties to
    the smaller doc_id; the others' rank is NULL.

    A NULL or empty text has no features.  A NULL id draws as an empty id
    and loses ties.  Repeated rows are drawn one by one.  An empty target
    leaves every bucket its prior; no documents give no rows.  Other columns
    are not read.
    """
    rows = _weighed(pick(docs, "text", "doc_id"), target, buckets, seed, min_words)
    return _ranked(rows, percent).select("doc_id", "n_features", "weight", "score", "rank")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
              buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """The drawn rows of ``docs`` with their own columns; see ``resample``."""
    names = docs.columns
    flat = stored(docs.toDF(*[f"_c{i}" for i in range(len(names))]).withColumn(
        "__row", F.monotonically_increasing_id()), "resample-rows")
    col = {n: F.col(f"_c{names.index(n)}").alias(n) for n in ("text", "doc_id")}
    rows = _weighed(flat.select(col["text"], col["doc_id"], "__row"), target, buckets, seed, min_words)
    drawn = _ranked(rows, percent).where(F.col("rank").isNotNull()).select("__row")
    return flat.join(drawn, "__row", "left_semi").drop("__row").toDF(*names)
