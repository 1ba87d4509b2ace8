"""Column picking, table loading and text rules shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from alloy.session import scratch_path

#: A word is a run of characters other than these six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns, by exact name.

    Other columns go, so that an input column that is named like a result
    column, or like one of these but for case, clashes with nothing.
    """
    at = {n: i for i, n in reversed(list(enumerate(df.columns)))}
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_c{at[n]}").alias(n) for n in names])


def word_count(text: Column) -> Column:
    """Words of a text as a long; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow``, its Arrow batches bounded by ``BATCH_BYTES``.

    Texts take from no byte to many megabytes, and a batch is held several
    times on its way to Python and back.  A larger bound of the session is
    lowered; plans that were made before run with it too.
    """
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(conf.get(key))
    if not now.removesuffix("b").isdigit() or not 0 < int(now.removesuffix("b")) <= BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def splittable(df: DataFrame, column: str) -> DataFrame:
    """``df`` with a long column as a value of its own, for a join on it.

    An aggregate by the column would be joined where it was made, and AQE
    could not split a hot key's partition of the other side.  As the value of
    an expression the column is shuffled again, one row per key.
    """
    return df.withColumn(column, F.col(column).bitwiseXOR(F.lit(0).cast("long")))


def splittable_text(df: DataFrame, column: str) -> DataFrame:
    """``splittable`` for a column of strings."""
    return df.withColumn(column, F.concat(F.col(column), F.lit("")))


#: Salts of a group of rows that are numbered.
SALTS = 4096


def salted(df: DataFrame) -> DataFrame:
    """``df`` with ``__salt``, from the row's place; store it before it is read twice."""
    return df.withColumn("__salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))


def numbered(rows: DataFrame, unit: list[str], order: list[str]) -> DataFrame:
    """Salted, stored ``rows`` with ``__rank``: 1, 2, … in a unit by ``order``, among equal ones in any order.

    Rows are counted by unit, order and salt, the counts of those before are
    added up in each unit, and rows are numbered within a salt alone, so that
    no task holds equal rows that are many.
    """
    by = [*unit, *order, "__salt"]
    counts = rows.groupBy(*by).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(*unit).orderBy(*order, "__salt").rowsBetween(Window.unboundedPreceding, -1))
    names = [f"__u{i}" for i in range(len(by))]
    offsets = counts.withColumn("__before", F.coalesce(before, F.lit(0))).drop("__n").toDF(*names, "__before")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(u)) for c, u in zip(by, names, strict=True)])
    within = F.row_number().over(Window.partitionBy(*by).orderBy(F.lit(0)))
    ranked = rows.withColumn("__within", within).join(offsets, same)
    return ranked.withColumn("__rank", F.col("__before") + F.col("__within")).drop("__within", "__before", "__salt", *names)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written as a table in the shared folder and read back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
