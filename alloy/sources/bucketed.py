"""Co-located tables: bucketed and sorted by a join key, joined without a shuffle (JN1, IO6).

``stage_bucketed`` writes a version of a table in ``buckets`` files by the
hash of the key, each sorted by it.  Two such tables with the same number of
buckets are joined bucket by bucket: no row of either is exchanged.

A bucket is read by one task, so a key that holds a large share of the rows
would make one long task that nothing splits.  Such keys are found while the
table is laid out (rows of a key beyond ``hot_share`` of an average bucket's)
and their rows go to a second, unbucketed folder of the version.  ``join``
unites the bucketed join with a join of the hot rows, in which each hot key
is dealt over as many parts as its rows need.  The hot keys of a table are
few: beyond an average bucket's rows times ``hot_share`` there are at most
``buckets`` / ``hot_share``.

Spark keeps bucketing in its catalog, so reading registers a version as an
external table of the session, under a name made from its path.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from alloy.sources.parquet import COMPRESSION, Entry, Staged, drop_staged, manifest, publish, table_path

BUCKETS = 64
HOT_SHARE = 2.0
COLD, HOT = "cold", "hot"
#: Rows of a hot key that are joined together; a key of more is dealt over several parts.
PART_ROWS = 100_000


def _registered(spark: SparkSession, path: str, layout: dict) -> str:
    """The name of the catalog table of a bucketed folder."""
    name = "alloy_bucketed_" + hashlib.sha256(path.encode()).hexdigest()[:32]
    if not spark.catalog.tableExists(name):
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(layout["schema"]))
        by = ", ".join(f"`{k}`" for k in layout["key"])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet CLUSTERED BY ({by}) "
                  f"SORTED BY ({by}) INTO {layout['buckets']} BUCKETS LOCATION '{path}'")
    return name


def hot_keys(df: DataFrame, key: Sequence[str], buckets: int, hot_share: float = HOT_SHARE) -> DataFrame:
    """Keys with more rows than ``hot_share`` average buckets: at most ``buckets`` / ``hot_share`` rows."""
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n")).first()[0] or 0
    return counts.where(F.col("__n") > max(1.0, hot_share * total / buckets)).select(*key)


def stage_bucketed(df: DataFrame, root: str, name: str, key: Sequence[str], buckets: int = BUCKETS,
                   hot_share: float = HOT_SHARE, made_from: str | None = None, hot: DataFrame | None = None) -> Staged:
    """Write ``df`` as an unpublished version, bucketed and sorted by ``key``.

    ``hot``: the keys to keep out of the buckets, as ``hot_keys`` of a frame
    that is cheaper than ``df`` gives them; by default those of ``df``, which
    is computed once more for them.  If there are any, ``df`` is computed
    once for the buckets and once for the hot rows.
    """
    spark = df.sparkSession
    key = list(key)
    found = hot_keys(df, key, buckets, hot_share) if hot is None else hot
    hot = [tuple(r) for r in found.collect()]
    layout = {"key": key, "buckets": buckets, "parts": [COLD, HOT] if hot else [COLD],
              "schema": df.schema.jsonValue()}
    staged = Staged(root, name, f"v-{uuid.uuid4().hex}", made_from, layout)
    catalog_name = "alloy_staging_" + uuid.uuid4().hex
    is_hot = F.lit(False)
    if hot:
        found = spark.createDataFrame(hot, df.select(*key).schema).withColumn("__hot", F.lit(True))
        # a row per hot key, at most buckets / hot_share; NULL keys meet no bucket of another table
        names = [f"__k{i}" for i in range(len(key))]
        found = found.toDF(*names, "__hot")
        same = F.lit(True)
        for k, n in zip(key, names):
            same = same & F.col(k).eqNullSafe(F.col(n))
        df = df.join(F.broadcast(found), same, "left").drop(*names)
        is_hot = F.col("__hot").isNotNull()
    try:
        cold = df.where(~is_hot).drop("__hot")
        (cold.repartition(buckets, *key)  # a task per bucket: one file each, dealt as bucketBy deals
         .write.bucketBy(buckets, *key).sortBy(*key).format("parquet")
         .option("compression", COMPRESSION).option("path", f"{staged.path}/{COLD}").saveAsTable(catalog_name))
        if hot:
            df.where(is_hot).drop("__hot").write.option("compression", COMPRESSION).parquet(f"{staged.path}/{HOT}")
    except Exception:
        drop_staged(spark, [staged])
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {catalog_name}")  # an external table: its files stay
    return staged


def write_bucketed(df: DataFrame, root: str, name: str, key: Sequence[str], buckets: int = BUCKETS,
                   hot_share: float = HOT_SHARE) -> str:
    """``stage_bucketed`` and publish; the version's path."""
    staged = stage_bucketed(df, root, name, key, buckets, hot_share)
    publish(df.sparkSession, [staged])
    return staged.path


def _entry(spark: SparkSession, root: str, name: str) -> Entry | None:
    entry = manifest(spark, root).tables.get(name)
    return entry if entry and entry.layout and len(entry.folders) == 1 else None


def bucketed_alike(spark: SparkSession, root: str, left: str, right: str) -> bool:
    """Whether ``join_bucketed`` can join two tables."""
    a, b = (_entry(spark, root, n) for n in (left, right))
    return bool(a and b) and all(a.layout[x] == b.layout[x] for x in ("key", "buckets"))


def _parts(spark: SparkSession, root: str, name: str) -> tuple[DataFrame, DataFrame | None, dict]:
    """The bucketed rows of a table, its hot rows if it has any, and its layout."""
    entry = _entry(spark, root, name)
    if entry is None:
        raise ValueError(f"{table_path(root, name)} isn't a bucketed table")
    path = f"{table_path(root, name)}/{entry.folders[0]}"
    cold = spark.table(_registered(spark, f"{path}/{COLD}", entry.layout))
    hot = spark.read.schema(cold.schema).parquet(f"{path}/{HOT}") if HOT in entry.layout["parts"] else None
    return cold, hot, entry.layout


def _join_hot(hot: DataFrame, other: DataFrame, key: list[str], part_rows: int = PART_ROWS) -> DataFrame:
    """Inner join of the hot rows of a table with another one, no task of which has all rows of a key.

    A key's hot rows are dealt over one part per ``part_rows`` of them, and
    the other table's rows of the key are repeated for each part: besides
    themselves, one repeated row for every ``part_rows`` joined ones.
    """
    n_parts = F.ceil(F.count(F.lit(1)) / part_rows).cast("int").alias("__parts")
    parts = F.broadcast(hot.groupBy(*key).agg(n_parts))  # a row per hot key, at most buckets / hot_share
    row = F.xxhash64(F.monotonically_increasing_id())
    dealt = (hot.withColumn("__row", row).join(parts, key)
             .withColumn("__part", F.pmod("__row", F.col("__parts")).cast("int")).drop("__row", "__parts"))
    repeated = (other.join(parts, key)
                .withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))).drop("__parts"))
    return dealt.join(repeated, [*key, "__part"]).drop("__part")


def join_bucketed(spark: SparkSession, root: str, left: str, right: str) -> DataFrame:
    """Inner join of two tables bucketed alike on their key, which appears once.

    Without hot keys nothing is exchanged.  The rows of hot keys of either
    table, and only these, are joined by an exchange (``_join_hot``).
    """
    (a, hot_a, la), (b, hot_b, lb) = (_parts(spark, root, n) for n in (left, right))
    if (la["key"], la["buckets"]) != (lb["key"], lb["buckets"]):
        raise ValueError(f"{left} and {right} are bucketed differently")
    key = la["key"]
    out = a.join(b, key)
    if hot_a is not None:  # against all rows of the other table that have such a key
        whole = b if hot_b is None else b.unionByName(hot_b)
        out = out.unionByName(_join_hot(hot_a, whole, key).select(*out.columns))
    if hot_b is not None:
        out = out.unionByName(_join_hot(hot_b, a, key).select(*out.columns))
    return out
