"""Data-quality checks (JN3, DQ1-DQ5, DQ7).

Each check is one distributed aggregation or join; results are small
summaries (one row, or one row per offending key) and stay DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _count_if(pred: Column) -> Column:
    return F.count(F.when(pred, 1))


def null_blank_profile(df: DataFrame, columns: Sequence[str], trim: bool = True) -> DataFrame:
    """One row: ``n_rows``, then ``{c}_null`` and ``{c}_blank`` per column.

    Blank means equal to ``""`` (after ``trim`` when asked); NULL is not blank.
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        value = F.trim(F.col(c)) if trim else F.col(c)
        aggs.append(_count_if(F.col(c).isNull()).alias(f"{c}_null"))
        aggs.append(_count_if(value == "").alias(f"{c}_blank"))
    return df.agg(*aggs)


def check_unique(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys seen more than once, with their row count ``n_rows``."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def check_range(df: DataFrame, value: str, low, high,
                by: Sequence[str] = ()) -> DataFrame:
    """Per group: rows seen, rows with ``low <= value <= high``, rows outside.

    A NULL value is counted as seen but neither in nor out of range.
    """
    v = F.col(value)
    inside = v.between(low, high)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_seen"),
        _count_if(inside).alias("rows_ok"),
        _count_if(~inside).alias("rows_bad"),
    )


def check_min(df: DataFrame, value: str, low, by: Sequence[str] = ()) -> DataFrame:
    """Per group: rows seen, rows with ``value >= low``, rows below it."""
    v = F.col(value)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_seen"),
        _count_if(v >= low).alias("rows_ok"),
        _count_if(v < low).alias("rows_bad"),
    )


def find_orphans(child: DataFrame, parent: DataFrame,
                 child_key: Sequence[str], parent_key: Sequence[str] | None = None) -> DataFrame:
    """Child rows whose key has no parent row: a ``left_anti`` join.

    A NULL child key never matches, so such rows are reported as orphans.
    Only the parent's key columns are read.
    """
    parent_key = list(parent_key or child_key)
    keys = parent.select(*[F.col(p).alias(f"__pk{i}") for i, p in enumerate(parent_key)])
    cond = [child[c] == keys[f"__pk{i}"] for i, c in enumerate(child_key)]
    return child.join(keys, on=cond, how="left_anti")


def count_orphans(child: DataFrame, parent: DataFrame,
                  child_key: Sequence[str], parent_key: Sequence[str] | None = None) -> DataFrame:
    """One row ``n_orphans``: the number of child rows ``find_orphans`` returns.

    The child is first reduced to one row per key with its row count (map-side
    partial aggregation), so the anti join moves one row per distinct key and a
    key holding a third of the child rows costs one row per map task.
    """
    names = [f"__ck{i}" for i in range(len(child_key))]
    per_key = child.groupBy(*[F.col(c).alias(n) for c, n in zip(child_key, names)]).agg(
        F.count(F.lit(1)).alias("__n"))
    orphans = find_orphans(per_key, parent, names, list(parent_key or child_key))
    return orphans.agg(F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("n_orphans"))


@dataclass(frozen=True)
class ForeignKey:
    """``child_key`` of the child's rows must be the ``parent_key`` of some row of the parent.

    ``check`` and ``table`` name the count of rows without one; ``repeated``,
    if given, names the count of parent keys that more than one row has.
    """

    check: str
    table: str
    child: DataFrame
    child_key: tuple[str, ...]
    parent: DataFrame
    parent_key: tuple[str, ...]
    repeated: str | None = None


def integrity(keys: Sequence[ForeignKey]) -> DataFrame:
    """All foreign keys in one pass: (check, table_name, n_bad), one or two rows per key.

    Every frame is scanned once, whatever the number of keys that it is the
    child or the parent of: a row gives one (key number, key) for each, these
    are counted map side, and children meet parents in one group-by on the
    tagged key.  So a value that a third of the rows hold is one row per map
    task.  A NULL in a child's key matches nothing; a parent's row with one
    is no parent.
    """
    if not keys:
        raise ValueError("no foreign keys")
    uses: dict[int, tuple[DataFrame, list[Column]]] = {}
    for i, k in enumerate(keys):
        types = [[df.schema[c].dataType for c in cols] for df, cols in ((k.child, k.child_key), (k.parent, k.parent_key))]
        if types[0] != types[1]:
            raise TypeError(f"{k.check} {k.table}: key types differ: {types}")
        for df, cols, child in ((k.child, k.child_key, 1), (k.parent, k.parent_key, 0)):
            value = F.array(*[F.col(c).cast("string") for c in cols])
            uses.setdefault(id(df), (df, []))[1].append(F.struct(
                F.lit(i).alias("fk"), value.alias("key"), F.lit(child).cast("long").alias("rows"),
                F.lit(1 - child).cast("long").alias("parents")))
    tagged = [df.select(F.explode(F.array(*made)).alias("e")).select("e.*") for df, made in uses.values()]
    spark = keys[0].child.sparkSession
    none = spark.range(len(keys)).select(F.col("id").cast("int").alias("fk"), F.array(F.lit(None).cast("string")).alias("key"),
                                         F.lit(0).cast("long").alias("rows"), F.lit(0).cast("long").alias("parents"))
    every = reduce(DataFrame.unionByName, [none, *tagged]).where((F.col("parents") == 0) | ~F.exists("key", F.isnull))
    met = every.groupBy("fk", "key").agg(F.sum("rows").alias("rows"), F.sum("parents").alias("parents"))
    counts = met.groupBy("fk").agg(
        F.sum(F.when(F.col("parents") == 0, F.col("rows")).otherwise(0)).alias("orphans"),
        F.count_if(F.col("parents") > 1).alias("repeated"))

    def names(of) -> Column:
        return F.element_at(F.array(*[F.lit(of(k)).cast("string") for k in keys]), F.col("fk") + 1)

    found = F.array(*[F.struct(names(of).alias("check"), names(lambda k: k.table).alias("table_name"),
                               F.col(n).cast("long").alias("n_bad"))
                      for of, n in ((lambda k: k.check, "orphans"), (lambda k: k.repeated, "repeated"))])
    return counts.select(F.explode(found).alias("e")).select("e.*").where(F.col("check").isNotNull())


def check_fanout(dim: DataFrame, key: Sequence[str], distinct: bool = True) -> DataFrame:
    """Dimension keys that map to more than one row (``n_rows`` > 1).

    Joining a fact to such a key multiplies the fact's rows.
    """
    rows = dim.distinct() if distinct else dim
    return (rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
                .filter(F.col("n_rows") > 1))
