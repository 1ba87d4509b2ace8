"""A key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import functions as F

from alloy.operators import kpi
from alloy.operators.dedup import keep_one
from alloy.operators.quality import check_unique

SF = "/root/testdata/sf0.01"


def _skewed_items(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    # every third row is moved onto one hot order key
    return li.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(1))
                         .otherwise(F.col("l_orderkey")))


def test_dedup_with_hot_key_matches_window(spark):
    items = _skewed_items(spark)
    hot = items.filter("l_orderkey = 1").count()
    assert hot > items.count() / 4
    key = ["l_orderkey", "l_linenumber"]
    got = keep_one(items, key, [("l_shipdate", "desc")])
    # brute force: the window formulation of the same total order
    from reference_dedup import keep_one_window
    rest = [c for c in items.columns if c not in key and c != "l_shipdate"]
    want = keep_one_window(items, key, [("l_shipdate", True)], rest)
    assert got.count() == want.count() == items.select(*key).distinct().count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_hot_key_is_reduced_before_the_shuffle(spark):
    items = _skewed_items(spark)
    plan = keep_one(items, ["l_orderkey", "l_linenumber"], [("l_shipdate", "desc")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("partial_min") > text.index("Exchange")  # partial agg sits below the exchange


def test_indicators_with_hot_order_and_customer(spark):
    items = _skewed_items(spark)
    orders = spark.read.parquet(f"{SF}/orders.parquet").withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey")))
    cust = spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_mktsegment")
    sales = items.join(orders, items.l_orderkey == orders.o_orderkey)
    got = kpi.sales_by_group(sales, cust, customer="o_custkey", attr="o_orderstatus",
                             customer_key="c_custkey", group_col="c_mktsegment",
                             value="l_extendedprice").drop("n_bad_values")
    want = (items.join(orders, items.l_orderkey == orders.o_orderkey)
                 .join(cust, F.col("o_custkey") == F.col("c_custkey"))
                 .groupBy("c_mktsegment", "o_orderstatus")
                 .agg(F.count(F.lit(1)).alias("n_items"),
                      F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue")))
    assert sorted(got.collect()) == sorted(want.select(*got.columns).collect())
    assert check_unique(got, ["c_mktsegment", "o_orderstatus"]).count() == 0


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


def _with_conf(spark, conf, work):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return work()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_order_partition_is_split_in_the_fact_join(spark, tmp_dir):
    """The hot key's reducer partition is cut into several tasks at run time.

    AQE splits a partition along map outputs, so the items come from several
    files, as a large table does.
    """
    from alloy.operators import star
    from alloy.plans.tpch import fact_mapping
    _skewed_items(spark).repartition(8).write.parquet(f"{tmp_dir}/items")
    items = spark.read.parquet(f"{tmp_dir}/items").withColumnRenamed("l_orderkey", "order_key")
    orders = spark.read.parquet(f"{SF}/orders.parquet").withColumnRenamed("o_orderkey", "order_key")

    def work():
        df = star.rename(star.fact_join(items, orders, "order_key"), fact_mapping())
        return df.count(), _final_plan(df)

    n, plan = _with_conf(spark, SKEW_CONF, work)
    assert "SortMergeJoin(skew=true)" in plan
    assert n == items.join(orders, "order_key").count()


def test_hot_key_partition_is_split_in_the_orphan_join(spark, tmp_dir):
    from alloy.operators.quality import find_orphans
    _skewed_items(spark).repartition(8).write.parquet(f"{tmp_dir}/items")
    items = spark.read.parquet(f"{tmp_dir}/items")
    parents = spark.read.parquet(f"{SF}/orders.parquet").filter("o_orderstatus <> 'F'")

    def work():
        df = find_orphans(items, parents, ["l_orderkey"], ["o_orderkey"])
        return df.count(), _final_plan(df)

    n, plan = _with_conf(spark, SKEW_CONF, work)
    assert "(skew=true)" in plan
    keys = parents.select("o_orderkey")
    assert n == items.join(keys, items.l_orderkey == keys.o_orderkey, "left_anti").count()


def test_hot_supplier_partition_is_split_in_the_supplier_join(spark, tmp_dir):
    """A third of the items on one supplier: the second star join splits it too."""
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    li.withColumn("l_suppkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(1))
                  .otherwise(F.col("l_suppkey"))).repartition(8).write.parquet(f"{tmp_dir}/items")
    items = spark.read.parquet(f"{tmp_dir}/items").select("l_orderkey", "l_suppkey")
    suppliers = spark.read.parquet(f"{SF}/supplier.parquet").select("s_suppkey", "s_nationkey")

    def work():
        df = items.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        return df.count(), _final_plan(df)

    n, plan = _with_conf(spark, SKEW_CONF, work)
    assert "SortMergeJoin(skew=true)" in plan
    assert n == items.count()  # every item has its supplier
