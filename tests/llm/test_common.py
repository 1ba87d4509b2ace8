from pyspark.sql import functions as F

from alloy.llm.common import SALTS, numbered, salted, stored


def test_rows_are_numbered_by_order_and_equal_ones_by_salts(spark):
    rows = spark.range(60_000, numPartitions=8).select(
        (F.col("id") % 3).alias("u"), F.when(F.col("id") % 2 == 0, 5).when(F.col("id") % 5 > 0, F.col("id") % 7).alias("k"))
    rows = stored(salted(rows.withColumn("u", F.when(F.col("u") > 0, F.col("u")))), "numbered")
    got = numbered(rows, ["u"], ["k"])
    assert got.columns == ["u", "k", "__rank"] and got.count() == 60_000
    for u in (None, 1, 2):
        ranks = [(r["__rank"], r["k"]) for r in got.where(F.col("u").eqNullSafe(F.lit(u))).collect()]
        assert sorted(r for r, _ in ranks) == list(range(1, 20_001))
        ks = [k for _, k in sorted(ranks)]
        assert ks == sorted(ks, key=lambda k: (k is not None, k))  # NULLs first


def test_no_task_numbers_many_equal_rows(spark):
    rows = stored(salted(spark.range(200_000, numPartitions=8).select(F.lit(7).alias("u"))), "numbered")
    assert rows.groupBy("__salt").count().agg(F.max("count")).first()[0] < 10 * 200_000 / SALTS
    assert numbered(rows, ["u"], []).agg(F.count_distinct("__rank"), F.max("__rank")).first()[:] == (200_000, 200_000)
