"""Near-duplicate detection: MinHash bands, signature check, full-set check, components.

1. Documents with equal word sequences form a class; one signature a class.
2. Classes that share a band fall into a bucket.  Each class is compared
   with the bucket's head, a member drawn by a hash, so different buckets of
   a group have different heads; pairs whose signatures agree too little
   for the threshold are dropped, the rest are confirmed on full sets.
3. Components of these links.  What a bucket holds besides its largest
   component is compared with all its members; members that are already in
   one component are not.  Members of a bucket of more than ``DIVIDE`` blocks
   (pages of one template, say) meet in smaller cells instead: documents that are similar enough
   share one of the rarest shingles of both, so each shingle that is among
   the rarest of several members makes a cell.  Cells are compared in blocks
   of bounded size.
4. Components of all links.

Signatures and texts are shuffled for the classes that a comparison needs
only: a Bloom filter of fixed size, broadcast, leaves out most others before
the join that leaves out the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import map_arrow, pick, splittable, stored
from alloy.llm.components import components
from alloy.llm.url_filter import bloom, with_possible

BANDS, ROWS = 25, 5
SEED = 5
BLOCK = 256  # members of a cell that one task compares with as many others
DIVIDE = 16  # buckets of more blocks are divided: a member has some dozens of rarest shingles, so fewer blocks cost less
PLACES = 1 << 20  # counters of shingles: they order the shingles of a set, whatever their number
_U = np.uint64
_rng = np.random.default_rng(SEED)
# the universal family h(x) = high half of (a x + b) mod 2**64, a odd
_A = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * _U(2) + _U(1)
_B = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
_STEP = _rng.integers(0, 1 << 63, 16, dtype=np.uint64) * _U(2) + _U(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _WordHashes(dict):
    """64-bit hash of each word, kept for the next texts."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = _WordHashes()


def words_of(text: str | None) -> list[bytes]:
    """Words of the whole text with A-Z lowered."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``size`` words.

    With fewer words the whole sequence is the only one; without words there is none.
    """
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    size = min(size, len(words))
    h = np.full(len(w) - size + 1, size, np.uint64)
    for k in range(size):
        h += w[k:k + len(h)] * _STEP[k]
    return np.unique(_mix(h))


def signature(sh: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that isn't empty."""
    out = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(sh), 2048):
        h = np.multiply.outer(sh[at:at + 2048], _A) + _B
        out = np.minimum(out, (h >> _U(32)).min(axis=0).astype(np.uint32))
    return out


def band_hashes(sig: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each band, band number included."""
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
    for k in range(ROWS):
        h = _mix(h + rows[:, k] * _STEP[k])
    return h.view(np.int64)


def short(sig: np.ndarray) -> bytes:
    """The low 16 bits of the minima: enough to count agreement."""
    return sig.astype(np.uint16).tobytes()


def least_agreement(similarity: float) -> int:
    """Agreeing minima below which a pair of that similarity is left out with a chance of 1e-6 or so."""
    n = BANDS * ROWS
    return int(n * similarity - 5.5 * np.sqrt(n * similarity * (1 - similarity)))


def _measure(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                key1, key2, n, sig, bands = [], [], [], [], []
                for text in batch.column(1).to_pylist():
                    words = words_of(text)
                    digest = xxhash.xxh3_128_intdigest(b" ".join(words))
                    key1.append((digest >> 64) - (1 << 63))
                    key2.append((digest & (1 << 64) - 1) - (1 << 63))
                    sh = shingles(words, size)
                    n.append(len(sh))
                    s = signature(sh) if len(sh) else None
                    sig.append(None if s is None else short(s))
                    bands.append(None if s is None else band_hashes(s))
                yield pa.record_batch(
                    [batch.column(0), pa.array(key1, pa.int64()), pa.array(key2, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(sig, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "key1", "key2", "n_shingles", "sig", "bands"])
    return run


def _agree(least: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, sa, sb = (batch.column(i) for i in range(6))
            na, nb = na.to_numpy(), nb.to_numpy()
            same = np.fromiter(
                (np.count_nonzero(np.frombuffer(x, np.uint16) == np.frombuffer(y, np.uint16))
                 for x, y in zip(sa.to_pylist(), sb.to_pylist(), strict=True)), np.int64, len(na))
            ok = (same >= least) & (np.minimum(na, nb) >= similarity * np.maximum(na, nb) - 1e-9)
            yield pa.record_batch([a, b], ["a", "b"]).filter(pa.array(ok))
    return run


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct arrays."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirm(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=64)
        def sets(text: str) -> np.ndarray:
            return shingles(words_of(text), size)

        for batch in batches:
            a, b, x, y = (batch.column(i) for i in range(4))
            ok = [similar(sets(s.as_py()), sets(t.as_py()), percent) for s, t in zip(x, y, strict=True)]
            yield pa.record_batch([a, b], ["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _able(odd: pd.DataFrame, rest: pd.DataFrame, least: int) -> np.ndarray:
    """Which pairs of two blocks of a cell need a comparison.

    Not those of one component, those whose signatures agree too little, and
    those that share an earlier band: its bucket compares them, or the cells
    that it is divided into (their own band is 0).
    """
    band = int(rest["band"].iloc[0])
    roots = rest["root"].to_numpy()
    sig = np.stack([np.frombuffer(s, np.uint16) for s in rest["sig"]])
    bands = np.stack([np.asarray(x, np.int64)[:band] for x in rest["bands"]])
    out = np.zeros((len(odd), len(rest)), bool)
    for i, (root, own, own_bands) in enumerate(zip(odd["root"], odd["sig"], odd["bands"], strict=True)):
        out[i] = (roots != root) & ((sig == np.frombuffer(own, np.uint16)).sum(axis=1) >= least)
        out[i] &= ~(bands == np.asarray(own_bands, np.int64)[:band]).any(axis=1)
    return out


def _count(size: int):
    """How often each place has a shingle, of all texts that a task reads."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(PLACES, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                np.add.at(n, _places(shingles(words_of(text), size)), 1)
        used = np.nonzero(n)[0]
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(n[used])], ["place", "n"])
    return run


def _places(sh: np.ndarray) -> np.ndarray:
    return (sh % _U(PLACES)).astype(np.int64)


def rarest(sh: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The rarest shingles of a set, so many that two sets of the similarity share one of theirs.

    Both share at least ``percent`` of the larger set, and both are in one
    order (count, then hash).  If none of the first n - percent of n + 1 were
    shared, fewer than ``percent`` of n could be.
    """
    order = np.lexsort((sh, counts[_places(sh)]))
    return sh[order[:len(sh) + (-percent * len(sh)) // 100 + 1]]


def _rarest(size: int, percent: int, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                found = [rarest(shingles(words_of(t), size), counts, percent) for t in batch.column(2).to_pylist()]
                row = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                yield pa.record_batch([pa.array(np.concatenate(found).view(np.int64)), batch.column(0).take(row),
                                       batch.column(1).take(row)], ["cell", "rep", "root"])
    return run


_SIDES = ["cell", "i", "j", "band", "rep", "root", "sig", "bands", "odd_side"]
_SIDES_SCHEMA = ("cell long, i int, j int, band int, rep long, root long, sig binary, bands array<long>, "
                 "odd_side boolean")


def _agree_block(least: int):
    """The members of two blocks that have a partner in the other."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        odd, rest = pdf[pdf["odd_side"]], pdf[~pdf["odd_side"]]
        if not len(odd) or not len(rest):
            return pdf[_SIDES].iloc[:0]
        able = _able(odd, rest, least)
        return pd.concat([odd[able.any(axis=1)], rest[able.any(axis=0)]])[_SIDES]
    return run


def _compare_block(size: int, percent: int, least: int):
    """Links between the odd members of one block and the members of another.

    Pairs that the links found so far already join are left out.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        odd, rest = pdf[pdf["odd_side"]], pdf[~pdf["odd_side"]]
        out = []
        if len(odd) and len(rest):
            able = _able(odd, rest, least)
            ids, ids2 = odd["rep"].tolist(), rest["rep"].tolist()
            roots, roots2 = odd["root"].to_numpy().copy(), rest["root"].to_numpy().copy()
            sets, sets2 = ([shingles(words_of(t), size) for t in d["text"]] for d in (odd, rest))
            for i in range(len(ids)):
                for j in np.nonzero(able[i])[0]:
                    if roots2[j] != roots[i] and similar(sets[i], sets2[j], percent):
                        out.append((ids[i], ids2[j]))
                        old, new = max(roots[i], roots2[j]), min(roots[i], roots2[j])
                        roots[roots == old] = new
                        roots2[roots2 == old] = new
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")
    return run


def _only(rows: DataFrame, needed: DataFrame, column: str) -> DataFrame:
    """``rows`` whose ``column`` is in ``needed`` (a column of that name): a Bloom filter first, then a join."""
    ids = needed.select(column).distinct()
    possible = with_possible(rows, column, bloom(ids, column)).where("__possible").drop("__possible")
    return possible.join(splittable(ids, column), column, "left_semi")


def _texts(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(rep, text) of the classes in ``needed`` (rep), one row each."""
    rows = docs.withColumnRenamed("doc_id", "rep")
    return _only(rows, needed, "rep").groupBy("rep").agg(F.first("text").alias("text"))


def near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of ``size``-word shingles have a
    Jaccard similarity of at least ``similarity`` (rounded to whole
    percents).  component_id: the least doc_id reachable by links, a
    document's own included; kept: doc_id = component_id.

    A NULL or empty text, or one without words, has no shingles, is linked
    with nothing and kept.  Rows with one doc_id are one document and are
    all returned; if their texts differ, the document is linked with all that
    any of them is linked with.  A row without doc_id has its class's component and isn't
    kept; without any id in its class it has none and is kept.  Other
    columns of ``docs`` are not read.
    """
    percent = round(100 * similarity)
    least = least_agreement(percent / 100)
    docs = pick(docs, "doc_id", "text")
    measured = stored(map_arrow(
        docs, _measure(size), "doc_id long, key1 long, key2 long, n_shingles long, sig binary, bands array<long>"),
        "minhash")
    key = ["key1", "key2"]
    texts_of = measured.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        *[f(k).alias(f"{n}{k}") for k in key for n, f in (("min", F.min), ("max", F.max))])
    if not texts_of.where("minkey1 <> maxkey1 or minkey2 <> maxkey2").isEmpty():
        return _of_rows(docs, size, similarity)
    # members of a class have equal texts but for blanks and case, so any member's signature is the class's
    classes = stored(measured.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).groupBy(*key)
                     .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"),
                          F.first("sig").alias("sig"), F.first("bands").alias("bands")), "minhash-classes")
    each = classes.select("rep", F.posexplode("bands").alias("band", "bucket"))
    heads = (each.groupBy("bucket").agg(F.min_by("rep", F.xxhash64("rep", "bucket")).alias("head"),
                                        F.count("*").alias("members")).where(F.col("members") > 1))
    members = stored(each.join(splittable(heads, "bucket"), "bucket"), "minhash-members")
    pairs = members.where(F.col("rep") != F.col("head")).select(
        F.least("rep", "head").alias("a"), F.greatest("rep", "head").alias("b")).distinct()
    pairs = stored(pairs, "minhash-candidates")
    sigs = _only(classes.select("rep", "n", "sig"), _ends(pairs), "rep")
    agreed = (pairs.join(sigs.toDF("a", "na", "sa"), "a").join(sigs.toDF("b", "nb", "sb"), "b")
              .select("a", "b", "na", "nb", "sa", "sb"))
    agreed = map_arrow(agreed, _agree(least, percent / 100), "a long, b long")
    agreed = stored(agreed, "minhash-pairs")
    texts = stored(_texts(docs, _ends(agreed)), "minhash-texts")
    links = (agreed.join(texts.toDF("b", "tb"), "b").join(texts.toDF("a", "ta"), "a")
             .select("a", "b", "ta", "tb"))
    links = stored(map_arrow(links, _confirm(size, percent), "a long, b long"), "minhash-links")
    roots = components(links)
    more = _odd_members(docs, classes, members, roots, size, percent, least)
    if more is not None:
        roots = components(roots.toDF("a", "b").unionByName(more))  # roots stand for the links found first
    ended = classes.select(*key, "rep").join(roots.toDF("rep", "component_id"), "rep", "left").select(
        *key, F.coalesce("component_id", "rep").alias("component_id"))
    out = measured.select("doc_id", *key, "n_shingles").join(ended, key, "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    kept = F.when(own.isNull(), True).otherwise(F.coalesce(own == F.col("doc_id"), F.lit(False)))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), kept.alias("kept"))


def _of_rows(docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """``near_duplicates`` where a doc_id has several texts: rows are compared, then joined by their ids."""
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "minhash-rows")
    found = near_duplicates(rows.select(F.col("__row").alias("doc_id"), "text"), size, similarity)
    found = found.select(F.col("doc_id").alias("__row"), "n_shingles", F.col("component_id").alias("part"))
    found = stored(found.join(rows.select("__row", "doc_id"), "__row").drop("__row"), "minhash-row-parts")
    filled = found.where("n_shingles > 0")
    ids = filled.where(F.col("doc_id").isNotNull()).select("doc_id", "part").distinct()
    least = ids.groupBy("doc_id").agg(F.min("part").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    links = ids.join(splittable(least, "doc_id"), "doc_id").where("part <> b").select(F.col("part").alias("a"), "b")
    roots = components(links).toDF("part", "root")
    parts = filled.groupBy("part").agg(F.min("doc_id").alias("least"))
    parts = parts.join(roots, "part", "left").withColumn("root", F.coalesce("root", "part"))
    parts = stored(parts, "minhash-parts")
    firsts = parts.groupBy("root").agg(F.min("least").alias("component_id"))
    ended = parts.select("part", "root").join(firsts, "root").select("part", "component_id")
    out = found.join(splittable(ended, "part"), "part", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    kept = F.when(own.isNull(), True).otherwise(F.coalesce(own == F.col("doc_id"), F.lit(False)))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), kept.alias("kept"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("rep"))


def _odd_members(docs: DataFrame, classes: DataFrame, members: DataFrame, roots: DataFrame,
                 size: int, percent: int, least: int) -> DataFrame | None:
    """Links of members that are not in their cell's largest component, or None.

    Buckets of two are done: their only pair was compared, as is a bucket of
    one component.  Of the others, those of at most ``DIVIDE`` blocks are cells;
    the members of larger ones are dealt into cells of their rarest shingles.
    Cells deal their members and their odd members into blocks; every block of
    odd members meets every block of members, first by signatures, then those
    with a partner by their full sets.
    """
    placed = (members.where(F.col("members") > 2).join(roots.toDF("rep", "root"), "rep", "left")
              .select("bucket", "band", "rep", F.coalesce("root", "rep").alias("root"), "members"))
    placed = stored(placed, "minhash-placed")
    mixed = (placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
             .where("low <> high").select("bucket"))
    cells = stored(placed.join(splittable(mixed, "bucket"), "bucket").withColumnRenamed("bucket", "cell"), "minhash-cells")
    if cells.isEmpty():
        return None
    large = cells.where(F.col("members") > DIVIDE * BLOCK).select("rep", "root").distinct()
    if not large.isEmpty():
        divided = _divided(docs, stored(large, "minhash-large"), size, percent)
        cells = cells.where(F.col("members") <= DIVIDE * BLOCK).unionByName(divided.withColumn("band", F.lit(0)))
    largest = (cells.groupBy("cell", "root").agg(F.count("*").alias("n"))
               .groupBy("cell").agg(F.max_by("root", F.struct("n", "root")).alias("largest"),
                                    (F.sum("n") - F.max("n")).alias("odds")))
    left = cells.join(splittable(largest, "cell"), "cell").withColumn("odd", F.col("root") != F.col("largest"))
    blocks = (F.ceil(F.col("members") / BLOCK)).cast("int")
    odd_blocks = (F.ceil(F.col("odds") / BLOCK)).cast("int")
    place = F.xxhash64("rep", F.lit(SEED))
    rest = left.withColumn("i", F.explode(F.sequence(F.lit(0), odd_blocks - 1))).select(
        "cell", "band", "rep", "root", "i", F.pmod(place, blocks).cast("int").alias("j"),
        F.lit(False).alias("odd_side"))
    odd = left.where("odd").withColumn("j", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "cell", "band", "rep", "root", F.pmod(place, odd_blocks).cast("int").alias("i"), "j",
        F.lit(True).alias("odd_side"))
    sides = stored(rest.unionByName(odd), "minhash-sides")
    group = ["cell", "i", "j"]
    sigs = _only(classes.select("rep", "sig", "bands"), sides, "rep")
    partners = stored(sides.join(sigs, "rep").groupBy(*group).applyInPandas(
        _agree_block(least), _SIDES_SCHEMA), "minhash-partners")
    links = partners.join(_texts(docs, partners), "rep").groupBy(*group).applyInPandas(
        _compare_block(size, percent, least), "a long, b long")
    links = stored(links, "minhash-more")
    return None if links.isEmpty() else links


def _divided(docs: DataFrame, large: DataFrame, size: int, percent: int) -> DataFrame:
    """(cell, rep, root, members): the members of large buckets by each of their rarest shingles.

    The order of shingles is by their counts among these members, in
    ``PLACES`` counters that every task gets; shingles that share a counter
    make larger cells, never other links.  Cells of one component are left
    out, and of cells with the same members all but one.
    """
    texts = stored(_texts(docs, large).join(large, "rep").select("rep", "root", "text"), "minhash-large-texts")
    found = map_arrow(texts.select("text"), _count(size), "place int, n long").groupBy("place").agg(
        F.sum("n").alias("n")).toArrow()  # PLACES rows at most
    counts = np.zeros(PLACES, np.int32)
    counts[found["place"].to_numpy()] = np.minimum(found["n"].to_numpy(), np.iinfo(np.int32).max)
    rare = stored(map_arrow(texts, _rarest(size, percent, counts), "cell long, rep long, root long"), "minhash-rarest")
    mixed = (rare.groupBy("cell").agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("rep")).alias("print"),
                                      F.min("root").alias("low"), F.max("root").alias("high"))
             .where("low <> high").groupBy("members", "print").agg(F.min("cell").alias("cell")))
    return rare.join(splittable(mixed.select("cell", "members"), "cell"), "cell").select("cell", "rep", "root", "members")
