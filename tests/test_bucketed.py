"""Tables bucketed by a key join without an exchange; hot keys are kept out of the buckets."""

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from alloy.sources import bucketed as bk
from alloy.sources.parquet import drop_old, read_table, write_table
from test_skew import SKEW_CONF, SF, _final_plan, _with_conf

LOW = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def _tables(spark, hot):
    items = spark.read.parquet(f"{SF}/lineitem.parquet").withColumnRenamed("l_orderkey", "k")
    if hot:
        items = items.withColumn("k", F.when(F.col("l_partkey") % 3 == 0, F.lit(1)).otherwise(F.col("k")))
    return items, spark.read.parquet(f"{SF}/orders.parquet").withColumnRenamed("o_orderkey", "k")


def _written(spark, tmp_dir, hot, buckets=8):
    items, orders = _tables(spark, hot)
    bk.write_bucketed(items, tmp_dir, "items", ["k"], buckets)
    bk.write_bucketed(orders, tmp_dir, "orders", ["k"], buckets)
    return items, orders


def test_the_fact_join_exchanges_nothing(spark, tmp_dir):
    items, orders = _written(spark, tmp_dir, hot=False)

    def work():
        df = bk.join_bucketed(spark, tmp_dir, "items", "orders")
        return df, _final_plan(df)

    df, plan = _with_conf(spark, LOW, work)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    want = items.join(orders, "k")
    assert df.count() == want.count() and df.exceptAll(want.select(*df.columns)).count() == 0


def test_each_bucket_is_one_sorted_file(spark, tmp_dir):
    _written(spark, tmp_dir, hot=False)
    path = bk._parts(spark, tmp_dir, "items")[0].inputFiles()
    assert len(path) == 8
    first = [r[0] for r in spark.read.parquet(path[0]).select("k").collect()]
    assert first == sorted(first)


def test_a_hot_order_is_joined_apart_and_split(spark, tmp_dir):
    items, orders = _written(spark, tmp_dir, hot=True)
    cold, hot, layout = bk._parts(spark, tmp_dir, "items")
    assert layout["parts"] == [bk.COLD, bk.HOT] and {r[0] for r in hot.select("k").distinct().collect()} == {1}
    sizes = [spark.read.parquet(f).count() for f in cold.inputFiles()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)

    def work():
        df = bk.join_bucketed(spark, tmp_dir, "items", "orders")
        return df, _final_plan(df)

    df, plan = _with_conf(spark, SKEW_CONF, work)
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") <= 3  # the hot rows alone
    want = items.join(orders, "k")
    assert df.count() == want.count() and df.exceptAll(want.select(*df.columns)).count() == 0
    assert rows(read_table(spark, tmp_dir, "items").groupBy("k").count().where("k = 1")) == rows(
        items.groupBy("k").count().where("k = 1"))


def test_both_sides_hot_and_null_keys(spark, tmp_dir):
    a = spark.createDataFrame([(1, i) for i in range(60)] + [(None, 1)] * 40 + [(i, 0) for i in range(2, 40)], "k long, x long")
    b = spark.createDataFrame([(1, i) for i in range(50)] + [(5, i) for i in range(40)] + [(None, 2)] * 30
                              + [(i, 9) for i in range(2, 30)], "k long, y long")
    bk.write_bucketed(a, tmp_dir, "a", ["k"], 8, hot_share=1.0)
    bk.write_bucketed(b, tmp_dir, "b", ["k"], 8, hot_share=1.0)
    assert [bk._parts(spark, tmp_dir, t)[1].select("k").distinct().count() for t in "ab"] == [2, 3]
    got = bk.join_bucketed(spark, tmp_dir, "a", "b")
    assert rows(got) == rows(a.join(b, "k").select(*got.columns))
    assert rows(read_table(spark, tmp_dir, "a")) == rows(a)


def test_empty_and_unequal_tables(spark, tmp_dir):
    a = spark.range(20).withColumnRenamed("id", "k")
    bk.write_bucketed(a.limit(0), tmp_dir, "none", ["k"], 4)
    bk.write_bucketed(a, tmp_dir, "a", ["k"], 4)
    bk.write_bucketed(a, tmp_dir, "b", ["k"], 2)
    assert bk.join_bucketed(spark, tmp_dir, "none", "a").count() == 0
    assert bk.bucketed_alike(spark, tmp_dir, "none", "a") and not bk.bucketed_alike(spark, tmp_dir, "a", "b")
    with pytest.raises(ValueError, match="differently"):
        bk.join_bucketed(spark, tmp_dir, "a", "b")
    write_table(a, tmp_dir, "plain")
    with pytest.raises(ValueError, match="isn't a bucketed table"):
        bk.join_bucketed(spark, tmp_dir, "a", "plain")
    assert read_table(spark, tmp_dir, "plain").count() == 20


def test_a_failing_layout_keeps_the_old_rows(spark, tmp_dir):
    a = spark.range(20).withColumnRenamed("id", "k")
    bk.write_bucketed(a, tmp_dir, "a", ["k"], 4)
    bad = a.withColumn("x", F.when(F.col("k") == 7, F.raise_error(F.lit("lost")).cast("int")).otherwise(1))
    with pytest.raises(Exception, match="lost"):
        bk.write_bucketed(bad, tmp_dir, "a", ["k"], 4)
    assert read_table(spark, tmp_dir, "a").count() == 20
    assert len(os.listdir(f"{tmp_dir}/a")) == 1
    assert drop_old(spark, tmp_dir, 0) == []
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("alloy_staging_")]


def test_the_lake_joins_its_fact_in_buckets(spark, tmp_dir):
    from alloy.plans import marketplace as mp
    from alloy.plans.medallion import run_layers
    from test_medallion import _layout, _write_landing

    plain, laid = _layout(os.path.join(tmp_dir, "a")), _layout(os.path.join(tmp_dir, "b"))
    for layout, buckets in ((plain, None), (laid, 4)):
        _write_landing(layout.landing)
        with open(f"{layout.landing}/{mp.ITEMS}.csv", "a") as f:  # a hot order
            f.write("".join(f"o6,{i},p1,s1,2018-01-01 00:00:00,{i},1\n" for i in range(40)))
        run_layers(spark, layout, kpis=True, buckets=buckets)
    assert bk.bucketed_alike(spark, laid.silver, mp.ITEMS, mp.ORDERS)
    assert bk._parts(spark, laid.silver, mp.ITEMS)[1] is not None
    for t in (mp.ITEMS, mp.ORDERS):
        assert rows(read_table(spark, laid.silver, t)) == rows(read_table(spark, plain.silver, t))
    for t in [*mp.GOLD_TABLES, *mp.KPI_TABLES]:
        assert rows(read_table(spark, laid.gold, t)) == rows(read_table(spark, plain.gold, t)), t


def test_a_hot_key_is_dealt_over_several_tasks(spark):
    """All rows of the hot key meet their partner, by parts that no one task holds together."""
    hot = spark.range(0, 20_000, 1, 4).select((F.col("id") % 10 == 0).cast("long").alias("k"), F.col("id").alias("x"))
    other = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "e")], "k long, y string")

    def work():
        df = bk._join_hot(hot, other, ["k"], part_rows=1000)
        sizes = df.groupBy(F.spark_partition_id().alias("p")).count().toPandas()["count"]
        return df.collect(), sizes

    got, sizes = _with_conf(spark, LOW | {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.enabled": "false"}, work)
    assert sorted(got) == sorted(r for r in hot.join(other, "k").collect())
    assert len(sizes) == 8 and sizes.max() < 22_000 / 2  # 18,000 rows of one key
