"""Near-duplicate vectors by a forest of random-projection trees with spill overlap.

Each tree splits a group of vectors again and again: project on a random
direction, split near the median, and send what is close to the split to
both sides.  A node is split until it holds ``leaf`` vectors, or until no
direction tried makes its sides clearly smaller (a dense ball).  Vectors are
compared within leaves; a pair is counted in one of its common leaves only.

The trees grow in rounds of ``LEVELS`` levels, all trees and groups at once.
In a round, split points come from a sample of each open node and all its
vectors are routed.  Directions come from seeds, so only split points move.
Large dense leaves are compared in pairs of bounded blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import pick, splittable, stored
from alloy.llm.components import components

TREES = 6
LEVELS = 5  # levels of a tree that one round grows
LEAF = 512  # vectors at which a node isn't split further
SAMPLE = 1024  # of a node, for its split points
TRIES = 4  # directions tried for a split
SHRINK = 0.85  # the larger side's share that a split may have
SPILL = 0.6  # overlap on each side, in deviations of a linked pair's difference
BLOCK = 1024
SEED = 4
_DEEP = 1 << 56


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, in double precision."""
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@lru_cache(maxsize=4096)
def direction(tree: int, path: int, attempt: int, dim: int) -> np.ndarray:
    x = np.random.default_rng([SEED, tree, path & 0xFFFFFFFF, path >> 32, attempt]).standard_normal(dim)
    return x / np.linalg.norm(x)


def fit(x: np.ndarray, count: int, tree: int, path: int, margin: float, leaf: int) -> list[tuple[int, int, float]]:
    """Splits (path, attempt, point) below a node, from a sample ``x`` of its ``count`` vectors."""
    out, todo = [], [(path, np.arange(len(x)), 0)]
    while todo:
        at, rows, level = todo.pop()
        if level == LEVELS or count * len(rows) <= leaf * len(x) or len(rows) < 8 or at >= _DEEP:
            continue
        best = None
        for attempt in range(TRIES):
            p = x[rows] @ direction(tree, at, attempt, x.shape[1])
            share = np.random.default_rng([SEED + 1, tree, at & 0xFFFFFFFF, at >> 32, attempt]).uniform(0.4, 0.6)
            point = float(np.quantile(p, share))
            left, right = p <= point + margin, p >= point - margin
            worst = max(left.sum(), right.sum()) / len(rows)
            if best is None or worst < best[0]:
                best = (worst, attempt, point, left, right)
        worst, attempt, point, left, right = best
        if worst > SHRINK:
            continue
        out.append((at, attempt, point))
        todo += [(2 * at, rows[left], level + 1), (2 * at + 1, rows[right], level + 1)]
    return out


def route(x: np.ndarray, tree: int, path: int, splits: dict[int, tuple[int, float]],
          margin: float) -> list[tuple[int, np.ndarray]]:
    """(path, rows) of the nodes below ``path`` that aren't split."""
    out, todo = [], [(path, np.arange(len(x)))]
    while todo:
        at, rows = todo.pop()
        if at not in splits:
            if len(rows):
                out.append((at, rows))
            continue
        attempt, point = splits[at]
        p = x[rows] @ direction(tree, at, attempt, x.shape[1])
        todo += [(2 * at, rows[p <= point + margin]), (2 * at + 1, rows[p >= point - margin])]
    return out


_NODE = ["grp", "tree", "path"]


def _fit_node(similarity: float, leaf: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, path = int(pdf["tree"].iloc[0]), int(pdf["path"].iloc[0])
        x = unit(np.stack(pdf.sort_values("rep")["vec"].to_numpy()))
        got = fit(x, int(pdf["n"].iloc[0]), tree, path, _margin(similarity, x.shape[1]), leaf)
        return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "tree": [tree], "path": [path],
                             "at": [[a for a, _, _ in got]], "attempt": [[t for _, t, _ in got]],
                             "point": [[p for _, _, p in got]]})
    return run


def _margin(similarity: float, dim: int) -> float:
    """Overlap on each side of a split."""
    return SPILL * float(np.sqrt(2 - 2 * similarity) / np.sqrt(dim))


def _route_rows(similarity: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            out = []
            for (grp, tree, path), pdf in whole.groupby(_NODE):
                x = unit(np.stack(pdf["vec"].to_numpy()))
                first = pdf.iloc[0]
                splits = {int(a): (int(t), float(p)) for a, t, p in
                          zip(first["at"], first["attempt"], first["point"], strict=True)}
                ids = pdf["rep"].to_numpy()
                for at, rows in route(x, int(tree), int(path), splits, _margin(similarity, x.shape[1])):
                    n = len(rows)
                    out.append((ids[rows], np.full(n, grp), np.full(n, tree, np.int32), np.full(n, at), np.full(n, at != path)))
            if out:
                yield pd.DataFrame(dict(zip(("rep", *_NODE, "grown"), map(np.concatenate, zip(*out, strict=True)), strict=True)))
    return run


def leaves_of(classes: DataFrame, similarity: float, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """(rep, leaf): the leaves of all trees that hold each vector of ``classes`` (rep, grp, vec)."""
    rows = classes.select("rep", "grp", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"),
                          F.lit(1).cast("long").alias("path"), F.lit(True).alias("grown"))
    done = []
    for k in range(100):
        counts = rows.groupBy(*_NODE).agg(F.count("*").alias("n"), F.max("grown").alias("grown"))
        # a node that no split was found for in its round is a leaf whatever its size
        open_ = stored(counts.where((F.col("n") > leaf) & F.col("grown") & (F.col("path") < _DEEP)), "forest-open")
        done.append(rows.join(open_.select(*_NODE), _NODE, "left_anti").select("rep", *_NODE))
        if open_.isEmpty():
            break
        here = rows.select("rep", *_NODE).join(open_.select(*_NODE, "n"), _NODE).join(
            classes.select("rep", "vec"), "rep")
        part = F.pmod(F.xxhash64("rep", "tree", F.lit(SEED + k)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        splits = stored(here.where(part < F.lit(SAMPLE) / F.col("n")).groupBy(*_NODE).applyInPandas(
            _fit_node(similarity, leaf),
            "grp long, tree int, path long, at array<long>, attempt array<int>, point array<double>"),
            "forest-splits")
        none = F.array()
        routed = here.join(splits, _NODE, "left").select(
            "rep", *_NODE, "vec", *[F.coalesce(c, none.cast(t)).alias(c) for c, t in (
                ("at", "array<long>"), ("attempt", "array<int>"), ("point", "array<double>"))])
        rows = stored(routed.mapInPandas(
            _route_rows(similarity), "rep long, grp long, tree int, path long, grown boolean"), "forest-rows")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return stored(out.select("rep", F.xxhash64(*_NODE).alias("leaf")), "forest-leaves")


def _compare(similarity: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.stack(pdf["vec"].to_numpy()))
        linked = x @ x.T >= similarity
        np.fill_diagonal(linked, False)
        if pdf["i"].iloc[0] != pdf["j"].iloc[0]:  # two blocks: pairs across them only
            b = pdf["block"].to_numpy()
            linked &= b[:, None] != b[None, :]
        here = pdf["leaf"].iloc[0]
        met = np.nonzero(linked.any(axis=1))[0]
        if not len(met):
            return pd.DataFrame({"rep": [], "links": [], "root": []}, dtype="int64")
        linked = linked[np.ix_(met, met)]
        pdf = pdf.iloc[met]
        ids, weight = pdf["rep"].to_numpy(), pdf["weight"].to_numpy()
        earlier = [x[x < here] for x in map(np.asarray, pdf["leaves"])]
        names, places = np.unique(np.concatenate(earlier), return_inverse=True)
        inside = np.zeros((len(ids), len(names)), np.float32)
        inside[np.repeat(np.arange(len(ids)), list(map(len, earlier))), places] = 1
        own = linked & ~(inside @ inside.T > 0)  # pairs that no earlier leaf holds
        root = ids.copy()
        while True:
            new = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (new == root).all():
                break
            root = new
        return pd.DataFrame({"rep": ids, "links": own @ weight, "root": root})
    return run


def linked_vectors(rows: DataFrame, similarity: float = 0.98, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``rows`` has vec_id, embedding, label.  Vectors with equal, non-NULL
    labels are linked if their cosine, in double precision, is at least
    ``similarity``.  n_links: other vectors linked directly; component_id:
    the least vec_id reachable; kept: vec_id = component_id.

    Vectors that are NULL, empty, zero, or hold NULL or non-finite
    components, and those without label, are linked with nothing; vectors of
    different lengths aren't linked.  Equal vectors form a class and are
    compared as one.  Rows with one vec_id and equal values count once and
    are all returned.  A row without vec_id is linked with nothing and kept.
    Other columns of ``rows`` are not read.
    """
    e = F.col("embedding")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    able = (e.isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
            & ~F.coalesce(bad, F.lit(True)) & F.exists(e, lambda v: v != 0))
    grp = F.xxhash64(F.size(e), F.col("label"))
    key = ["key1", "key2"]
    rows = pick(rows, "vec_id", "embedding", "label").select(
        "vec_id", "embedding", grp.alias("grp"), F.coalesce(able, F.lit(False)).alias("able"),
        F.xxhash64("embedding", grp).alias("key1"), F.xxhash64(grp, "embedding", F.lit(SEED)).alias("key2"))
    classes = stored(
        rows.where("able").groupBy(*key, "vec_id").agg(F.first("grp").alias("grp"), F.first("embedding").alias("vec"))
        .groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"),
                           F.first("grp").alias("grp"), F.first("vec").alias("vec")), "forest-classes")
    leaves = leaves_of(classes, similarity, trees, leaf)
    sizes = leaves.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    each = classes.join(leaves.groupBy("rep").agg(F.collect_set("leaf").alias("leaves")), "rep")
    each = each.select("rep", "weight", "vec", "leaves", F.explode("leaves").alias("leaf")).join(
        splittable(sizes, "leaf"), "leaf")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    each = each.withColumn("block", F.pmod(F.xxhash64("rep", F.lit(SEED)), blocks).cast("int"))
    each = each.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    each = each.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    found = stored(each.drop("other", "n").groupBy("leaf", "i", "j").applyInPandas(
        _compare(similarity), "rep long, links long, root long"), "forest-links")
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    ended = (classes.select(*key, "rep", "weight").join(counts, "rep", "left")
             .join(roots.toDF("rep", "root"), "rep", "left")
             .select(*key, (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("root", "rep").alias("component_id"), F.lit(True).alias("able")))
    out = rows.select("vec_id", *key, "able").join(ended, [*key, "able"], "left")
    own = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      own.alias("component_id"), F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"))
