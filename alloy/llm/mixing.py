"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents of a source fall into blocks of about ``block_docs`` by the hash
of their id.  A source's target is met by whole passes over its blocks and
by a quota of whole blocks of one more pass; in the block after the quota
single documents fill up what is left.  A tree over the output shards splits
the exact quotas of all sources: each node deals its blocks to its two
halves by a multivariate hypergeometric draw, so a leaf knows which range of
each source's permuted blocks is its own.  Ranges are disjoint and cover the
quotas.  Within a shard, documents are in the order of a hash.

Every draw is seeded by its node and every order by hashes of ids, so the
same rows give the same mix.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from alloy.llm.common import numbered, pick, salted, stored, word_count

SEED = 71
WEIGHTS = (5, 2, 1)
MOST = 3  # times a source's size that its target may be
#: Multipliers of the block permutations, one a pass; primes over any number of blocks.
_TIMES = (2_147_483_647, 2_147_483_629, 2_147_483_587, 2_147_483_579)
SHARD_WORDS = 1_000_000  # words in an output shard
GROUP = 1024  # blocks in the first step of the search for a quota's end


def targets(sizes: Sequence[int], weights: Sequence[float], most: float = MOST) -> list[float]:
    """Shares of the sum of ``sizes`` by weight, none above ``most`` times its own size.

    What a source can't take is shared among the others by weight, again
    until none is above its bound.
    """
    out = [0.0] * len(sizes)
    left, open_ = float(sum(sizes)), list(range(len(sizes)))
    while open_ and left > 0:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total >= most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def shard_ranges(quotas: np.ndarray, shards: int, shard: int, seed: int = SEED) -> list[tuple[int, int]]:
    """The range of each source's draws that one shard takes, found by walking down the tree.

    Shards get equal numbers of blocks, at most one apart.
    """
    lo, q = np.zeros(len(quotas), np.int64), quotas.astype(np.int64)
    ends = [int(quotas.sum()) * s // shards for s in range(shards + 1)]
    a, b = 0, shards
    while b - a > 1:
        mid = (a + b) // 2
        rng = np.random.default_rng([seed, a, b])
        left = rng.multivariate_hypergeometric(q, ends[mid] - ends[a], method="marginals")
        if shard < mid:
            b, q = mid, left
        else:
            a, lo, q = mid, lo + left, q - left
    return [(int(x), int(x + n)) for x, n in zip(lo, q, strict=True)]


def fill_units(sizes: Sequence[int], counts: Sequence[int], room: float) -> list[int]:
    """How many rows of each unit, in order, to take: as many as fit, then one more row if that comes nearer."""
    taken = []
    for s, n in zip(sizes, counts, strict=True):
        taken.append(min(n, int(room // s)) if s > 0 else 0)
        room -= s * taken[-1]
    rest = [(s, i) for i, s in enumerate(sizes) if s > 0 and taken[i] < counts[i]]
    if rest and min(rest)[0] < 2 * room:
        taken[min(rest)[1]] += 1
    return taken


def fill(sizes: Sequence[int], room: float) -> list[bool]:
    """``fill_units`` of single rows."""
    return [n > 0 for n in fill_units(sizes, [1] * len(sizes), room)]


@dataclass(frozen=True)
class Mix:
    """What the draws need: the sizes, a row per source, the chosen documents of the last blocks, the draws."""
    rows: DataFrame  # doc_id, source, size, __salt
    sources: DataFrame  # source, sid, source_size, target, blocks, passes, a, c, last
    chosen: DataFrame  # sid, doc_id, size, n, take: units of the blocks that are filled up
    draws: DataFrame  # sid, block, draws
    shards: int
    partial: bool  # a unit is taken in part: its rows must be numbered


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(SEED)), blocks)


def _place(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with their source's columns, their block and its place in the last pass."""
    given = sources.withColumnRenamed("source", "__source")
    out = rows.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    out = out.withColumn("block", _block(F.col("blocks")))
    return out.withColumn("place", F.pmod(F.col("block") * F.col("a") + F.col("c"), F.col("blocks")))


def _end(sums: DataFrame, column: str, room: dict[int, float]) -> dict[int, tuple[int, float]]:
    """For each source the first place whose cumulative size passes its room, and the room before it."""
    spark = sums.sparkSession
    rooms = spark.createDataFrame([(int(s), float(r)) for s, r in room.items()], "sid int, room double")
    order = Window.partitionBy("sid").orderBy(column).rowsBetween(Window.unboundedPreceding, 0)
    past = (sums.withColumn("sum", F.sum("size").over(order)).join(F.broadcast(rooms), "sid")
            .where(F.col("sum") > F.col("room")))
    first = past.groupBy("sid").agg(
        F.min(F.struct(column, (F.col("room") - F.col("sum") + F.col("size")).alias("room"))).alias("x"))
    return {r["sid"]: (r["x"][column], r["x"]["room"]) for r in first.collect()}  # one row per source


def _fill_block(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["h", "doc_id", "size"])
    take = fill_units(pdf["size"].tolist(), pdf["n"].tolist(), float(pdf["room"].iloc[0]))
    return pdf.assign(take=take).loc[lambda d: d["take"] > 0, ["sid", "doc_id", "size", "n", "take"]]


def plan_mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, shard_words: int = SHARD_WORDS,
             block_docs: int = 64, max_sources: int = 10_000) -> Mix:
    """Targets, quotas and draws for a mix of ``docs`` (doc_id, source, text).

    Size: words of the text.  Sources in code-point order, NULL last, get
    the weights in turn.  One row per source comes to the driver; more than
    ``max_sources`` raise an error.
    """
    if not 0 < most <= MOST:
        raise ValueError(f"most must be over 0 and at most {MOST}")
    spark = docs.sparkSession
    rows = stored(salted(pick(docs, "doc_id", "source", "text").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"))), "mix-sizes")
    found = (rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
             .limit(max_sources + 1).collect())
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    goal = targets([r["size"] for r in found], [weights[i % len(weights)] for i in range(len(found))], most)
    made, room = [], {}
    for i, (r, t) in enumerate(zip(found, goal, strict=True)):
        blocks = -(-r["n"] // block_docs)
        passes = min(int(t // r["size"]), MOST) if r["size"] else 0
        room[i] = t - passes * r["size"]
        made.append([r["source"], i, r["size"], t, blocks, passes, _TIMES[passes] % blocks,
                     (SEED * 7919 * (passes + 1)) % blocks, -1])
    schema = ("source string, sid int, source_size long, target double, blocks long, passes int, "
              "a long, c long, last long")
    sources = spark.createDataFrame([tuple(m) for m in made], schema)
    placed = _place(rows, sources).select("sid", "doc_id", "size", "place")
    # the end of each quota: first among groups of blocks, then among the blocks of one group
    grouped = placed.groupBy("sid", F.floor(F.col("place") / GROUP).alias("group")).agg(F.sum("size").alias("size"))
    at = _end(grouped, "group", room)
    groups = spark.createDataFrame([(s, g) for s, (g, _) in at.items()], "sid int, group long")
    inside = (placed.join(F.broadcast(groups), "sid")
              .where(F.floor(F.col("place") / GROUP) == F.col("group"))
              .groupBy("sid", "place").agg(F.sum("size").alias("size")))
    last = _end(inside, "place", {s: r for s, (_, r) in at.items()})
    for s, (place, _) in last.items():
        made[s][-1] = place
    sources = spark.createDataFrame([tuple(m) for m in made], schema)
    ends = spark.createDataFrame([(s, p, float(r)) for s, (p, r) in last.items()],
                                 "sid int, place long, room double")
    # about block_docs units of each source
    chosen = stored(
        placed.join(F.broadcast(ends), ["sid", "place"]).groupBy("sid", "doc_id", "size", "room")
        .agg(F.count("*").alias("n")).withColumn("h", F.xxhash64("doc_id", F.lit(SEED + 1)))
        .groupBy("sid").applyInPandas(_fill_block, "sid int, doc_id long, size long, n long, take long"), "mix-chosen")
    quotas = []
    for m in made:
        blocks, passes, end = m[4], m[5], m[8]
        rest = end + 1 if end >= 0 and room[m[1]] > 0 else 0
        quotas.append(passes * blocks + rest)
    shards = max(1, -(-sum(r["size"] for r in found) // shard_words))
    draws = stored(_draws(spark, np.array(quotas, np.int64), made, shards), "mix-draws")
    return Mix(rows, sources, chosen, draws, shards, not chosen.where("take < n").isEmpty())


def _draws(spark, quotas: np.ndarray, made: list[list], shards: int) -> DataFrame:
    """(sid, block, draws): for each block its passes and the shard that draws it in each."""
    inverse = [[pow(_TIMES[p] % m[4], -1, m[4]) if m[4] > 1 else 0 for p in range(MOST + 1)] for m in made]

    def ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for shard in pdf["id"]:
                got = shard_ranges(quotas, shards, int(shard))
                yield pd.DataFrame({"shard": int(shard), "sid": range(len(got)),
                                    "lo": [a for a, _ in got], "hi": [b for _, b in got]})

    known = spark.createDataFrame(
        [(m[1], m[4], [int(x) for x in inverse[i]], [(SEED * 7919 * (p + 1)) % m[4] for p in range(MOST + 1)])
         for i, m in enumerate(made)], "sid int, blocks long, inverse array<long>, shift array<long>")
    leaves = (spark.range(shards).repartition(min(shards, max(200, shards // 1000))).mapInPandas(ranges, "shard int, sid int, lo long, hi long")
              .where(F.col("hi") > F.col("lo")).join(F.broadcast(known), "sid"))
    each = leaves.select("*", F.explode(F.sequence("lo", F.col("hi") - 1)).alias("k"))
    each = each.withColumn("pass", F.floor(F.col("k") / F.col("blocks")).cast("int"))
    place = F.pmod(F.col("k"), F.col("blocks"))
    turn = F.element_at("inverse", F.col("pass") + 1)
    shift = F.element_at("shift", F.col("pass") + 1)
    each = each.withColumn("block", F.pmod((place - shift) * turn, F.col("blocks")))
    return each.groupBy("sid", "block").agg(
        F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("draws"))  # at most MOST + 1


def _drawn(rows: DataFrame, mix: Mix) -> DataFrame:
    """``rows`` (doc_id, source, size, any ``_c`` columns) with source_size, target and draws.

    Where units are taken in part, ``rows`` must read a written table that
    has a column ``__salt``.
    """
    found = _place(rows, mix.sources).join(mix.draws, ["sid", "block"], "left")
    pick_ = mix.chosen.select(F.col("sid").alias("__sid"), F.col("doc_id").alias("__id"),
                              F.col("size").alias("__size"), F.col("n").alias("__n"), F.col("take").alias("__take"))
    same = ((F.col("sid") == F.col("__sid")) & F.col("doc_id").eqNullSafe(F.col("__id"))
            & (F.col("size") == F.col("__size")) & (F.col("place") == F.col("last")))
    found = found.join(F.broadcast(pick_), same, "left")  # about block_docs rows of each source
    found = found.withColumn("__rank", F.lit(0).cast("long"))
    if mix.partial:
        parted = F.coalesce(F.col("__take") < F.col("__n"), F.lit(False))
        ranked = numbered(found.where(parted).drop("__rank"), ["sid", "doc_id", "size"], [])
        found = found.where(~parted).drop("__salt").unionByName(ranked)
    out = (F.col("place") == F.col("last")) & ~F.coalesce(F.col("__rank") <= F.col("__take"), F.lit(False))
    kept = F.when(out, F.filter("draws", lambda d: d["pass"] < F.col("passes"))).otherwise(F.col("draws"))
    kept = F.coalesce(kept, F.array().cast("array<struct<pass:int,shard:int>>"))
    return found.withColumn("draws", kept).select(
        *[c for c in rows.columns if c != "__salt"], "source_size", "target", "draws")


def mix_plan_rows(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST,
                  shard_words: int = SHARD_WORDS, block_docs: int = 64) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, draws.

    draws: array of (pass, shard), one entry for each time the mix takes the
    document, empty if it doesn't.  Documents without words weigh nothing;
    a NULL text has none.  NULL sources form the last source.  Rows of equal
    id and size can be taken in part, whichever of them: how many is the same
    on every run.  An empty input gives no rows.  Other columns of ``docs``
    are not read.
    """
    mix = plan_mix(docs, weights, most, shard_words, block_docs)
    return _drawn(mix.rows, mix)


def mix_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST,
                  shard_words: int = SHARD_WORDS, block_docs: int = 64, most_partitions: int = 10_000) -> DataFrame:
    """The mix itself: rows of ``docs`` (its own columns), each as often as it is drawn.

    A partition holds whole shards, dealt over as many partitions as there
    are shards, up to ``most_partitions``; rows of a shard are in the order
    of a hash.
    """
    names = docs.columns
    mix = plan_mix(docs, weights, most, shard_words, block_docs)
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    col = {n: F.col(f"_c{names.index(n)}") for n in ("doc_id", "source", "text")}
    rows = flat.select("*", col["doc_id"].alias("doc_id"), col["source"].alias("source"),
                       word_count(col["text"]).alias("size"))
    if mix.partial:
        rows = stored(salted(rows), "mix-rows")
    out = _drawn(rows, mix).select("*", F.explode("draws").alias("d"))
    out = out.withColumn("__shard", F.col("d.shard")).withColumn(
        "__order", F.xxhash64("doc_id", "d", F.lit(SEED + 2)))
    return (out.repartition(min(mix.shards, most_partitions), "__shard").sortWithinPartitions("__shard", "__order")
            .select(*[f"_c{i}" for i in range(len(names))]).toDF(*names))
