"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import splittable, stored


def _large_star(links: DataFrame) -> DataFrame:
    """Each node joins its larger neighbours to the least of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    out = both.join(splittable(least, "a"), "a").where(F.col("b") > F.col("a"))
    return out.select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node joins its smaller neighbours and itself to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(splittable(least, "a"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return joined.where(F.col("a") != F.col("b")).unionByName(own).distinct()


def _print(links: DataFrame) -> tuple:
    """A fingerprint of the set of links: one row."""
    h = F.xxhash64("a", "b")
    return tuple(links.agg(F.count("*"), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component_id) of every node in ``links`` (a, b: long): the least node it reaches.

    Repeated links, both directions and links of a node with itself are
    allowed; a node that is linked with itself only isn't returned.  No
    links give no rows.  Each round is written to the shared folder.  More
    than ``most_rounds`` rounds (they grow as the logarithm) raise an error.
    """
    down = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = stored(down, "links")
    seen = _print(now)
    for _ in range(most_rounds):
        if not seen[0]:
            break
        now = stored(_small_star(_large_star(now)), "links")
        last, seen = seen, _print(now)
        if last == seen:
            break
    else:
        raise RuntimeError(f"components: not done after {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component_id")).unionByName(roots)
