"""One cube gives all indicators, merges over runs, and its sketches count within their error."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from alloy.operators import kpi
from test_skew import SKEW_CONF, SF, _final_plan, _skewed_items, _with_conf

KEYS = dict(order_key="o_orderkey", date_col="o_orderdate", value="l_extendedprice")


def _frames(spark, hot=False):
    items = _skewed_items(spark) if hot else spark.read.parquet(f"{SF}/lineitem.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    if hot:
        orders = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey")))
    sales = items.join(orders, items.l_orderkey == orders.o_orderkey)
    customers = spark.read.parquet(f"{SF}/customer.parquet").where("c_custkey % 10 > 0")  # some are unknown
    return sales, customers


def _cells(sales, customers, **more):
    return kpi.sales_cells(sales, customers, customer="o_custkey", status="o_orderstatus", customer_key="c_custkey",
                           state="c_mktsegment", **KEYS, **more)


@pytest.mark.parametrize("hot", [False, True])
def test_both_indicator_tables_come_from_the_cube(spark, hot):
    sales, customers = _frames(spark, hot)
    cube = kpi.sales_cube(_cells(sales, customers))
    monthly = kpi.monthly_sales(sales, **KEYS)
    assert rows(kpi.monthly_of(cube).select(*monthly.columns)) == rows(monthly)
    state = kpi.sales_by_group(sales, customers, customer="o_custkey", attr="o_orderstatus", customer_key="c_custkey",
                               group_col="c_mktsegment", value="l_extendedprice")
    assert rows(kpi.by_state_of(cube, "c_mktsegment", "o_orderstatus").select(*state.columns)) == rows(state)
    total = cube.where("level = 'all'").collect()
    assert len(total) == 1 and total[0]["n_items"] == sales.count()
    assert total[0]["n_orders"] == sales.select("o_orderkey").distinct().count()


def test_sketches_count_within_their_error(spark):
    sales, customers = _frames(spark)
    for bits, error in ((12, 0.05), (16, 0.0125)):
        cube = kpi.sales_cube(_cells(sales, customers, sketch_bits=bits)).where("n_orders > 100").collect()
        assert len(cube) > 50
        assert max(abs(r["n_orders_estimate"] / r["n_orders"] - 1) for r in cube) < error


def test_a_new_week_merges_in(spark):
    sales, customers = _frames(spark)
    late = F.col("o_orderdate") >= "1997-01-01"
    whole = _cells(sales, customers)
    merged = kpi.merge_cells(_cells(sales.where(~late), customers), _cells(sales.where(late), customers))
    exact = [rows(kpi.sales_cube(c).drop("n_orders_estimate")) for c in (merged, whole)]
    assert exact[0] == exact[1]
    # items of one order in two runs: the sketch still counts it once
    again = kpi.merge_cells(_cells(sales.where("l_linenumber < 3"), customers), _cells(sales.where("l_linenumber >= 3"), customers))
    twice, once = (kpi.sales_cube(c).where("level = 'all'").first() for c in (again, whole))
    assert twice["n_items"] == once["n_items"] and twice["revenue"] == once["revenue"]
    assert twice["n_orders"] > 1.5 * once["n_orders"]
    assert abs(twice["n_orders_estimate"] / once["n_orders"] - 1) < 0.05


def test_the_sales_are_scanned_once(spark):
    sales, customers = _frames(spark)
    cube = kpi.sales_cube(_cells(sales, customers))
    plan = cube._jdf.queryExecution().executedPlan().toString()
    assert len([x for x in plan.split("Initial Plan")[0].splitlines() if "Expand" in x]) == 2
    assert kpi.sales_cube(_cells(sales.limit(0), customers)).where("n_items > 0").count() == 0


def test_money_beyond_small_decimals(spark):
    data = [(1, "2020-01-01", 7, "a", v) for v in (1e15, 1e17, 1e30, 1e40, float("nan"), None, 0.005, -1e17)]
    sales = spark.createDataFrame(data, "k int, d string, c int, s string, v double").withColumn("d", F.to_date("d"))
    got = kpi.monthly_sales(sales, order_key="k", date_col="d", value="v").first()
    assert got["n_bad_values"] == 2 and got["n_orders"] == 1
    assert got["revenue"] == float(10 ** 30 + 10 ** 15)


def test_a_hot_customer_is_split_in_the_cells(spark, tmp_dir):
    sales, customers = _frames(spark, hot=True)
    sales.repartition(8).write.parquet(f"{tmp_dir}/sales")
    df = spark.read.parquet(f"{tmp_dir}/sales")

    def work():
        cells = _cells(df, customers)
        return rows(cells.drop("orders")), _final_plan(cells)

    got, plan = _with_conf(spark, SKEW_CONF, work)
    assert got == rows(_cells(df, customers).drop("orders")) and "SortMergeJoin" in plan
