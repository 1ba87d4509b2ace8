"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``CELLS`` equal cells.  Each shard owns ``vnodes`` of them, its
virtual nodes; a row falls into the cell that its key's hash names and asks
the next virtual node clockwise.  A shard takes rows up to its bound; the
rest continue clockwise to the next virtual node of a shard that has room.

Rows of one cell share one path round the ring, so the walk needs only the
row count of each cell: a table of fixed size however large the input.  The
walk on it yields pieces (cell, ranks from-to, shard, first slot), and a row
finds its piece by its cell and its rank in that cell.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alloy.llm.common import numbered, pick, salted, stored

CELLS = 1 << 17
SEED = 41


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing of integers (splitmix)."""
    x = (x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ring_nodes(shards: int, vnodes: int, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the virtual nodes in ring order, and their shards.

    A shard's nodes depend on its own number only, so one more shard moves
    no existing node; of two nodes in one cell the lower shard comes first.
    """
    s = np.repeat(np.arange(shards), vnodes)
    v = np.tile(np.arange(vnodes), shards)
    pos = (_mix(s * 1_000_003 + v + SEED) % np.uint64(cells)).astype(np.int64)
    order = np.lexsort((v, s, pos))
    return pos[order], s[order]


def bounds(n: int, shards: int, load_factor: float | None) -> np.ndarray:
    """Rows that each shard may take.

    None: n split as evenly as whole rows allow (counts at most one apart).
    Otherwise ceil(load_factor * n / shards), load_factor >= 1.
    """
    if load_factor is None:
        return n // shards + (np.arange(shards) < n % shards)
    if load_factor < 1:
        raise ValueError("load_factor is below 1: the shards can't hold all rows")
    return np.full(shards, int(np.ceil(load_factor * n / shards)))


def walk(cell: np.ndarray, count: np.ndarray, shards: int, vnodes: int,
         load_factor: float | None = None, cells: int = CELLS) -> np.ndarray:
    """Pieces (cell, lo, hi, shard, first slot) for the given cell counts.

    In each round every row not yet placed asks its next virtual node; a
    shard serves them by distance to the node, then cell, then rank, until
    it is full; the others go on.  Each round that leaves rows fills at
    least one shard, so there are at most ``shards`` rounds.
    """
    pos, owner = ring_nodes(shards, vnodes, cells)
    room = bounds(int(count.sum()), shards, load_factor).astype(np.int64)
    cell, lo, hi = cell.astype(np.int64), np.zeros(len(cell), np.int64), count.astype(np.int64)
    at = np.searchsorted(pos, cell) % len(pos)  # a node in the row's own cell serves it
    done = []
    while len(cell):
        ahead = np.arange(len(pos))  # the next node, clockwise, of a shard with room
        nxt = -1
        for i in range(2 * len(pos) - 1, -1, -1):
            if room[owner[i % len(pos)]] > 0:
                nxt = i % len(pos)
            ahead[i % len(pos)] = nxt
        at = ahead[at]
        shard = owner[at]
        order = np.lexsort((lo, cell, (pos[at] - cell) % cells, shard))
        cell, lo, hi, at, shard = (x[order] for x in (cell, lo, hi, at, shard))
        size = hi - lo
        before = np.cumsum(size) - size
        first = np.searchsorted(shard, np.arange(shards))
        before -= before[np.minimum(first, len(before) - 1)][shard]
        take = np.clip(room[shard] - before, 0, size)
        some = take > 0
        done.append(np.stack([cell, lo, lo + take, shard])[:, some])
        np.subtract.at(room, shard, take)
        left = take < size
        cell, lo, hi, at = cell[left], (lo + take)[left], hi[left], at[left]
    if not done:
        return np.zeros((5, 0), np.int64)
    out = np.concatenate(done, axis=1)
    out = out[:, np.lexsort((out[1], out[0], out[3]))]
    size = out[2] - out[1]
    slot = np.cumsum(size) - size
    first = np.searchsorted(out[3], np.arange(shards))
    slot -= slot[np.minimum(first, len(slot) - 1)][out[3]]
    return np.concatenate([out, slot[None]])


def shard_rows(rows: DataFrame, key: Sequence[str], shards: int = 24, vnodes: int = 64,
               load_factor: float | None = None, cells: int = CELLS, hot_rows: int = 10_000) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 in a shard).

    ``key``: columns that place a row on the ring and order rows of a cell
    (all hashable types).  The default bound gives counts at most one apart.
    The same rows give the same shards whatever their order or partitions.
    NULL keys are keys like others; rows with equal keys are placed one by
    one, in any order among themselves.  An empty input gives no rows.  The
    names ``shard`` and ``slot`` must be free in ``rows``.  A cell with more
    rows than ``hot_rows`` and eight average cells is sorted by no task alone.
    """
    if shards < 1 or vnodes < 1:
        raise ValueError("shards and vnodes must be 1 at least")
    spark = rows.sparkSession
    cell = F.pmod(F.xxhash64(*key, F.lit(SEED)), F.lit(cells)).cast("int")
    # at most `cells` rows come to the driver, whatever the input
    counted = rows.groupBy(cell.alias("__cell")).count().toPandas()
    pieces = walk(counted["__cell"].to_numpy(np.int64), counted["count"].to_numpy(np.int64),
                  shards, vnodes, load_factor, cells)
    names = ["__cell", "__lo", "__hi", "shard", "__slot"]
    made = spark.createDataFrame([tuple(map(int, p)) for p in pieces.T],
                                 "__cell int, __lo long, __hi long, shard int, __slot long")
    # equal keys share a cell: rows of a cell far beyond the others are numbered by salted counts
    limit = hot_rows + 8 * int(counted["count"].sum()) // cells
    hot = [(int(c),) for c in counted["__cell"][counted["count"] > limit]]
    placed = rows.withColumn("__cell", cell).withColumn("__order", F.xxhash64(*key, F.lit(SEED + 1)))
    order = ["__order", *key]
    ranked = None
    if hot:
        hot_cells = F.broadcast(spark.createDataFrame(hot, "__cell int"))  # at most `cells` rows
        crowd = stored(salted(placed.join(hot_cells, "__cell", "left_semi")), "ring-hot")
        ranked = numbered(crowd, ["__cell"], order).withColumn("__rank", F.col("__rank") - 1)
        placed = placed.join(hot_cells, "__cell", "left_anti")
    plain = placed.withColumn("__rank", F.row_number().over(
        Window.partitionBy("__cell").orderBy(*order)).cast("long") - 1)
    ranked = (plain if ranked is None else plain.unionByName(ranked)).drop("__order")
    fits = (F.col("__rank") >= F.col("__lo")) & (F.col("__rank") < F.col("__hi"))
    return (ranked.join(F.broadcast(made), "__cell").where(fits)  # at most cells + shards**2 pieces
            .withColumn("slot", F.col("__slot") + F.col("__rank") - F.col("__lo"))
            .drop("__rank", *[n for n in names if n != "shard"]))


def shard_documents(docs: DataFrame, shards: int = 24, vnodes: int = 64,
                    load_factor: float | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot.

    size: UTF-8 bytes of the text plus 8 (NULL text: 8); text_crc32: CRC-32
    of those bytes (NULL text: 0).  The key is doc_id; rows without one are
    keyed by their text's checksum and size alone.  Repeated rows are placed
    like any others; other columns of ``docs`` are not read.
    """
    text = F.col("text")
    rows = pick(docs, "doc_id", "text").select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"))
    return shard_rows(rows, ["doc_id", "text_crc32", "size"], shards, vnodes, load_factor)
