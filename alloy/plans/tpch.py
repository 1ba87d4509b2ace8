"""The registered queries: library operators applied to the driver's tables.

The test tables (TPC-H-like) play the roles of the marketplace tables:
orders/lineitem are orders and order items, part/supplier/customer are
products, sellers and customers, nation/region are the geography used in
two roles, conversations carry multi-line review text, documents carry
accented text, events carry a scored value.

The tables are clean, so some queries first inject defects with a fixed
expression (``dirty_orders``); the oracle SQL injects the same ones.
Every query reads whole tables.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alloy.functions.cast import cast_failures, safe_date, safe_double, safe_int, safe_timestamp
from alloy.functions.text import normalise, strip
from alloy.operators import aggregate, clean as cl, dedup, kpi, quality, star
from alloy.plans import marketplace as mp
from alloy.plans.lake_checks import bronze_checks, quality_report
from alloy.plans.medallion import Layout, Limit, landing_quarantine, run_bronze, run_gold, run_layers
from alloy.plans.tpch_landing import write_landing
from alloy.session import scratch_path
from alloy.streaming.ingest import ingest_stream
from alloy.sources.bucketed import join_bucketed, write_bucketed
from alloy.sources.csv import read_csv, write_csv
from alloy.sources.landing import landing_counts
from alloy.sources.parquet import read_table, write_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dirty_orders(orders: DataFrame) -> DataFrame:
    """Orders as raw text with injected defects (same as the oracle's view).

    NULL id (key % 97), blank id (key % 89), padded ids otherwise, empty
    customer (key % 83), padded status, unparseable date (key % 71).
    """
    k = F.col("o_orderkey")
    return orders.select(
        k.alias("row_id"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
         .when(k % 89 == 0, F.lit("   "))
         .otherwise(F.concat(F.lit(" "), k.cast("string"), F.lit("  "))).alias("order_id"),
        F.when(k % 83 == 0, F.lit("")).otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.concat(F.lit("  "), F.col("o_orderstatus"), F.lit(" ")).alias("order_status"),
        F.when(k % 71 == 0, F.lit("n/a")).otherwise(F.col("o_orderdate").cast("string")).alias("purchased_at"),
        F.col("o_totalprice").cast("string").alias("total_raw"),
    )


# The silver-orders shape (SV1) over the dirty view.
ORDERS_SPEC = cl.TableSpec(
    name="orders",
    columns=(
        cl.trimmed("order_id"),
        cl.trimmed("customer_id"),
        cl.code("order_status"),
        cl.typed("purchased_at", "date", "purchased_on"),
        cl.typed("total_raw", "double", "total"),
    ),
    required=("order_id", "customer_id"),
    non_blank=("order_id", "customer_id"),
    key=("order_id",),
    order_by=(("purchased_on", "desc"),),
)

KEYS_SPEC = cl.TableSpec(
    name="order_keys",
    columns=(cl.trimmed("order_id"), cl.trimmed("customer_id")),
    required=("order_id", "customer_id"),
    non_blank=("order_id", "customer_id"),
)

PART_SPEC = cl.TableSpec(
    name="part_dim",
    columns=(cl.keep("p_partkey", "nk_part"), cl.keep("p_type", "category"),
             cl.keep("p_size", "size_cm")),
)


# ---------------------------------------------------------------- projection

def project_rename(spark, d):
    return cl.project(table(spark, d, "part"), PART_SPEC)


def trim_lower(spark, d):
    raw = table(spark, d, "customer").select(
        "c_custkey", F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("raw"))
    return raw.select("c_custkey", normalise("raw").alias("segment"),
                      F.length(strip("raw")).alias("n"))


def translate_accents(spark, d):
    spec = cl.TableSpec("docs", (cl.keep("doc_id"), cl.code("text", "folded", fold=True)))
    return cl.project(table(spark, d, "documents"), spec)


def cast_int_safe(spark, d):
    k = F.col("o_orderkey")
    raw = F.when(k % 5 == 0, F.lit("abc")).otherwise(F.col("o_custkey").cast("string"))
    return table(spark, d, "orders").select(k, safe_int(raw).alias("v"))


def cast_double_safe(spark, d):
    k = F.col("o_orderkey")
    raw = F.when(k % 5 == 0, F.lit("")).otherwise(F.col("o_totalprice").cast("string"))
    return table(spark, d, "orders").select(k, safe_double(raw).alias("v"))


def _date_text():
    k = F.col("o_orderkey")
    return F.when(k % 71 == 0, F.lit("n/a")).otherwise(F.col("o_orderdate").cast("string"))


def to_date_safe(spark, d):
    return table(spark, d, "orders").select("o_orderkey", safe_date(_date_text()).alias("d"))


def to_timestamp_safe(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", safe_timestamp(_date_text(), ntz=True).alias("t"))


def cast_failure_profile(spark, d):
    raw = dirty_orders(table(spark, d, "orders"))
    return cast_failures(raw, {"purchased_at": "date", "total_raw": "double"})


def computed_sum_col(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey",
                     F.round(star.total("l_extendedprice", "l_tax"), 4).alias("total"))


# ---------------------------------------------------------------- filters

def drop_null_keys(spark, d):
    raw = dirty_orders(table(spark, d, "orders"))
    return raw.dropna(subset=["order_id", "customer_id"]).agg(F.count(F.lit(1)).alias("n"))


def drop_blank_keys(spark, d):
    return cl.clean(dirty_orders(table(spark, d, "orders")), KEYS_SPEC, dedup=False)


def silver_orders(spark, d):
    return cl.clean(dirty_orders(table(spark, d, "orders")), ORDERS_SPEC)


def quarantine_rows(spark, d):
    rejected = cl.quarantine(dirty_orders(table(spark, d, "orders")), ORDERS_SPEC,
                             keep_columns=["row_id"])
    return rejected.select("row_id", cl.REASON_COLUMN)


def null_blank_profile(spark, d):
    return quality.null_blank_profile(dirty_orders(table(spark, d, "orders")),
                                      ["order_id", "customer_id"])


# ---------------------------------------------------------------- dedup

def dedup_composite_key(spark, d):
    li = table(spark, d, "lineitem")
    kept = dedup.keep_one(li, ["l_orderkey", "l_linenumber"], [("l_shipdate", "desc")])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def dedup_key_count(spark, d):
    return dedup.duplicate_count(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def dedup_single_key(spark, d):
    kept = dedup.keep_one(table(spark, d, "events"), ["user_id"], [("ts", "desc")])
    return kept.select("user_id", "event_id", "event_type")


def hot_items(spark, d) -> DataFrame:
    """Line items where every third part's lines belong to one order (key 1).

    A third of all rows on one key: the skew every keyed operator must take.
    """
    li = table(spark, d, "lineitem")
    return li.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(1).cast("long"))
                         .otherwise(F.col("l_orderkey")))


def dedup_hot_key(spark, d):
    kept = dedup.keep_one(hot_items(spark, d), ["l_orderkey", "l_linenumber"],
                          [("l_shipdate", "desc")])
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def fact_join_hot_order(spark, d):
    items = hot_items(spark, d).withColumnRenamed("l_orderkey", "order_key")
    return star.rename(star.fact_join(items, _orders(spark, d), "order_key"), fact_mapping())


def key_uniqueness(spark, d):
    return quality.check_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- aggregates

def group_avg_two(spark, d):
    avg = aggregate.group_average(table(spark, d, "orders"),
                                  ["o_orderstatus", "o_orderpriority"],
                                  ["o_totalprice", "o_custkey"], ["avg_price", "avg_cust"])
    return avg.select("o_orderstatus", "o_orderpriority",
                      F.round("avg_price", 2).alias("avg_price"),
                      F.round("avg_cust", 4).alias("avg_cust"))


def _supplier_geo(spark, d) -> DataFrame:
    """Suppliers as geolocation rows: zip, city, state, lat, lng."""
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select((F.col("s_nationkey") % 7).alias("zip"),
                     F.lower("n_name").alias("city"),
                     F.col("r_name").alias("state"),
                     F.col("s_acctbal").alias("lat"),
                     F.col("s_suppkey").cast("double").alias("lng")))


def centroid_3key(spark, d):
    c = aggregate.centroid(_supplier_geo(spark, d), "zip", "lat", "lng", "city", "state")
    return c.select("zip", "city", "state", F.round("lat", 4).alias("lat"),
                    F.round("lng", 4).alias("lng"))


def centroid_exact(spark, d):
    """Mean positions of the customers' places, to the last bit and unrounded."""
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    places = c.select((F.col("c_nationkey") % 7).alias("zip"), F.col("n_name").alias("city"),
                      F.col("c_mktsegment").alias("state"), F.col("c_acctbal").alias("lat"),
                      (F.col("c_acctbal") / 3 - 7).alias("lng"))
    return aggregate.centroid(places, "zip", "lat", "lng", "city", "state")


def zip_centroid(spark, d):
    z = aggregate.one_per_key(_supplier_geo(spark, d).dropna(subset=["zip", "lat", "lng"]),
                              "zip", ["lat", "lng"], ["city", "state"])
    return z.select("zip", F.round("lat", 4).alias("lat"), F.round("lng", 4).alias("lng"),
                    "city", "state")


def dim_fanout_check(spark, d):
    c = aggregate.centroid(_supplier_geo(spark, d), "zip", "lat", "lng", "city", "state")
    return quality.check_fanout(c.select("zip", "city", "state"), ["zip"])


# ---------------------------------------------------------------- joins / star

def _items(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "order_key")


def _orders(spark, d) -> DataFrame:
    return table(spark, d, "orders").withColumnRenamed("o_orderkey", "order_key")


def fact_mapping() -> list:
    """Item ⋈ order columns → fact names (GD1's shape)."""
    return [
        ("order_key", "sk_order"),
        ("o_custkey", "nk_customer"),
        ("l_partkey", "nk_part"),
        ("l_suppkey", "nk_supplier"),
        ("l_linenumber", "line_no"),
        ("l_extendedprice", "item_value"),
        ("l_tax", "freight_value"),
        (F.round(star.total("l_extendedprice", "l_tax"), 4), "total_value"),
        ("o_orderdate", "ordered_at"),
        ("l_shipdate", "shipped_at"),
        ("o_orderstatus", "order_status"),
    ]


def fact_sales_join(spark, d):
    return star.rename(star.fact_join(_items(spark, d), _orders(spark, d), "order_key"),
                       fact_mapping())


def role_playing_dims(spark, d):
    nation = table(spark, d, "nation")
    roles = [("n_nationkey", "{role}_nationkey"), ("n_name", "{role}_nation")]
    cust_nation = star.role_view(nation, roles, "customer")
    supp_nation = star.role_view(nation, roles, "supplier")
    customers = (table(spark, d, "customer").select("c_custkey", "c_nationkey")
                 .join(cust_nation, F.col("c_nationkey") == F.col("customer_nationkey"))
                 .select("c_custkey", "customer_nation"))
    suppliers = (table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
                 .join(supp_nation, F.col("s_nationkey") == F.col("supplier_nationkey"))
                 .select("s_suppkey", "supplier_nation"))
    items = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    # Resolve the customer role on the orders (4x fewer rows than items), so
    # the item rows are shuffled twice (order key, supplier key), not three times.
    orders = (table(spark, d, "orders").select("o_orderkey", "o_custkey")
              .join(customers, F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "customer_nation"))
    fact = (items.join(orders, items.l_orderkey == orders.o_orderkey)
                 .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")))
    return fact.select("o_orderkey", "customer_nation", "l_linenumber", "l_partkey",
                       "supplier_nation")


# ---------------------------------------------------------------- quality

def rule_score_range(spark, d):
    return quality.check_range(table(spark, d, "events"), "value", 1, 100, by=["event_type"])


def rule_money_min(spark, d):
    return quality.check_min(table(spark, d, "lineitem"), "l_extendedprice", 1000.0,
                             by=["l_returnflag"])


def ri_orphans(spark, d):
    """Items with injected orphans: the key is negative for every seventh part and NULL for every 101st."""
    part, key = F.col("l_partkey"), F.col("l_orderkey")
    items = table(spark, d, "lineitem").withColumn(
        "l_orderkey", F.when(part % 101 != 0, F.when(part % 7 == 0, -key).otherwise(key)))
    orphans = quality.find_orphans(items, table(spark, d, "orders"), ["l_orderkey"], ["o_orderkey"])
    return orphans.select("l_orderkey", "l_linenumber", "l_partkey")


# ---------------------------------------------------------------- indicators

def kpi_monthly_sales(spark, d):
    sales = star.fact_join(_items(spark, d), _orders(spark, d), "order_key")
    return kpi.monthly_sales(sales, order_key="order_key", date_col="o_orderdate",
                             value="l_extendedprice")


def _customer_region(spark, d) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select("c_custkey", "r_name"))


def kpi_sales_by_region(spark, d):
    sales = star.fact_join(_items(spark, d), _orders(spark, d), "order_key")
    return kpi.sales_by_group(sales, _customer_region(spark, d), customer="o_custkey",
                              attr="o_orderstatus", customer_key="c_custkey",
                              group_col="r_name", value="l_extendedprice")


def _cells(spark, d, items: DataFrame) -> DataFrame:
    sales = star.fact_join(items, _orders(spark, d), "order_key")
    return kpi.sales_cells(sales, _customer_region(spark, d), order_key="order_key", date_col="o_orderdate",
                           customer="o_custkey", status="o_orderstatus", value="l_extendedprice",
                           customer_key="c_custkey", state="r_name")


def kpi_cube(spark, d):
    """All totals of the sales; a sketch's count within 8 % (five deviations) of the exact one is ``near``."""
    cube = kpi.sales_cube(_cells(spark, d, _items(spark, d)))
    near = F.abs(F.col("n_orders_estimate") - F.col("n_orders")) <= 0.08 * F.col("n_orders") + 1
    return cube.select("level", "y", "m", "state", "status", "n_items", F.col("revenue").cast("double").alias("revenue"),
                       "n_bad_values", "n_orders", near.alias("near"))


def kpi_cube_merged(spark, d):
    """The same totals from stored cells of two halves of the orders, the second merged into the first."""
    root = scratch_path(spark, "cells")
    half = F.pmod("order_key", F.lit(2))
    for k in (0, 1):
        cells = _cells(spark, d, _items(spark, d).where(half == k))
        if k:
            cells = kpi.merge_cells(read_table(spark, root, "cells"), cells)
        write_table(cells, root, "cells")
    cube = kpi.sales_cube(read_table(spark, root, "cells"))
    return cube.select("level", "y", "m", "state", "status", "n_items", F.col("revenue").cast("double").alias("revenue"),
                       "n_bad_values", "n_orders")


# ---------------------------------------------------------------- files

def csv_multiline_roundtrip(spark, d):
    """Write conversations as CSV, read them back as text and cast (bronze → silver)."""
    path = scratch_path(spark, "csv-roundtrip")
    write_csv(table(spark, d, "conversations").select("conv_id", "turn", "role", "text"), path)
    spec = cl.TableSpec("conversations", (
        cl.typed("conv_id", "bigint"), cl.typed("turn", "bigint"),
        cl.keep("role"), cl.keep("text")))
    return cl.project(read_csv(spark, path), spec)


def _misfit_lines(orders: DataFrame) -> DataFrame:
    """Raw CSV lines of the orders, some of which don't fit the header; one column named by it."""
    k = F.col("o_orderkey")
    key, cust, status = k.cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus")
    line = (F.when(k % 7 == 1, F.concat_ws(",", key, cust))
            .when(k % 11 == 2, F.concat_ws(",", key, cust, status, F.lit("extra")))
            .when(k % 13 == 3, F.concat(key, F.lit(',"'), cust, F.lit('"x,'), status))
            .when(k % 17 == 4, F.concat_ws(",", key, cust, status, F.lit(""), F.lit("two")))
            .when(k % 19 == 5, F.concat(key, F.lit(',"'), cust, F.lit('\nnext, ""q""",'), status))
            .when(k % 23 == 6, F.concat(key, F.lit(',5" '), cust, F.lit(","), status))
            .otherwise(F.concat_ws(",", key, cust, status)))
    return orders.select(F.explode(F.split(line, "\n")).alias("order_id,customer_id,status"))


def landing_misfits(spark, d):
    """Bronze of landing files with records that don't fit: the good rows and, with their reason, all others."""
    root = scratch_path(spark, "misfits")
    layout = Layout(f"{root}/landing", f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/quarantine")
    # lines as they are: no value is quoted by the writer
    write_csv(_misfit_lines(table(spark, d, "orders")), f"{layout.landing}/orders.csv", sep="\u0001", quote="")
    run_bronze(spark, layout)
    none = F.lit(None).cast("string")
    good = read_table(spark, layout.bronze, "orders").select(
        none.alias("reason"), "order_id", "customer_id", "status", none.alias("record"))
    bad = read_table(spark, layout.quarantine, landing_quarantine("orders")).select(
        "reason", none.alias("order_id"), none.alias("customer_id"), none.alias("status"), "record")
    return good.unionByName(bad)


def landing_glob_scan(spark, d):
    """Count each table of a landing root: one in the root, one in a sub-folder in
    several part files, one in two places, and a text note that is no table."""
    root = scratch_path(spark, "landing")
    write_csv(table(spark, d, "customer"), f"{root}/customer.csv")
    write_csv(table(spark, d, "supplier").repartition(2), f"{root}/market/supplier.csv")
    orders = table(spark, d, "orders")
    write_csv(orders.where(F.col("o_orderkey") % 3 == 0), f"{root}/market/orders.csv")
    write_csv(orders.where(F.col("o_orderkey") % 3 != 0), f"{root}/late/orders.csv")
    table(spark, d, "part").select("p_name").write.mode("overwrite").text(f"{root}/note.txt")
    return landing_counts(spark, root)


def stream_ingest(spark, d):
    """Landing CSV (conversations, multi-line text) → bronze by an availableNow stream."""
    root = scratch_path(spark, "stream")
    write_csv(table(spark, d, "conversations").select("conv_id", "turn", "role", "text"),
              f"{root}/landing/conversations.csv")
    ingest_stream(spark, f"{root}/landing", f"{root}/bronze",
                  checkpoint=f"{root}/checkpoint").awaitTermination()
    spec = cl.TableSpec("conversations", (
        cl.typed("conv_id", "bigint"), cl.typed("turn", "bigint"),
        cl.keep("role"), cl.keep("text")))
    return cl.project(spark.read.parquet(f"{root}/bronze"), spec)


def parquet_roundtrip(spark, d):
    """Replace a table twice, then read it back."""
    root = scratch_path(spark, "parquet")
    orders = table(spark, d, "orders")
    write_table(orders, root, "orders")
    write_table(orders, root, "orders")
    return read_table(spark, root, "orders")


def atomic_replace(spark, d):
    """A table is replaced from its own rows, and an overwrite that fails halfway leaves it so."""
    root = scratch_path(spark, "replace")
    orders = table(spark, d, "orders")
    write_table(orders.select("o_orderkey", "o_totalprice"), root, "orders")
    own = read_table(spark, root, "orders")
    write_table(own.withColumn("o_totalprice", F.col("o_totalprice") * 2), root, "orders")
    lost = F.when(F.col("o_orderkey") % 1000 == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("o_orderkey"))
    try:
        write_table(orders.select(lost.cast("long").alias("o_orderkey"), "o_totalprice"), root, "orders")
    except PySparkException as e:
        if "lost" not in str(e):
            raise
    return read_table(spark, root, "orders")


def _colocated(spark, items: DataFrame, orders: DataFrame) -> DataFrame:
    root = scratch_path(spark, "colocated")
    write_bucketed(items, root, "items", ["order_key"])
    write_bucketed(orders, root, "orders", ["order_key"])
    return star.rename(join_bucketed(spark, root, "items", "orders"), fact_mapping())


def colocated_fact_join(spark, d):
    """The sales fact from tables laid out in buckets of the order: joined without an exchange."""
    return _colocated(spark, _items(spark, d), _orders(spark, d))


def colocated_hot_order(spark, d):
    """The same with a third of the items on one order, which is kept out of the buckets."""
    return _colocated(spark, hot_items(spark, d).withColumnRenamed("l_orderkey", "order_key"), _orders(spark, d))


# ---------------------------------------------------------------- full layer run

_RUNS: dict[tuple[str, str], Layout] = {}
SINGLE_LINE_TABLES = (mp.ORDERS, mp.ITEMS)


def lake_run(spark: SparkSession, d: str, fresh: bool = False) -> Layout:
    """Landing (derived from the test tables) → bronze → silver → gold, once per app."""
    key = (spark.conf.get("spark.app.id", "app"), d)
    if fresh or key not in _RUNS:
        root = scratch_path(spark, "lake")
        layout = Layout(landing=f"{root}/landing", bronze=f"{root}/bronze",
                        silver=f"{root}/silver", gold=f"{root}/gold",
                        quarantine=f"{root}/quarantine")
        write_landing(spark, d, layout.landing)
        # items and orders are ids, numbers and dates: no line breaks, so their
        # files are split; every other table is read record-wise (multi-line)
        run_layers(spark, layout, kpis=True, single_line=SINGLE_LINE_TABLES)
        _RUNS[key] = layout
    return _RUNS[key]


def medallion_fact(spark, d):
    return read_table(spark, lake_run(spark, d).gold, "fato_vendas")


def medallion_geo_dim(spark, d):
    return read_table(spark, lake_run(spark, d).gold, "dim_geolocalizacao_clientes")


def medallion_customers(spark, d):
    return read_table(spark, lake_run(spark, d).gold, "dim_clientes")


def medallion_products(spark, d):
    return read_table(spark, lake_run(spark, d).gold, "dim_produtos")


def medallion_sellers(spark, d):
    return read_table(spark, lake_run(spark, d).gold, "dim_vendedores")


def medallion_payments(spark, d):
    return read_table(spark, lake_run(spark, d).gold, "dim_pagamentos")


def medallion_geo_sellers(spark, d):
    return read_table(spark, lake_run(spark, d).gold, "dim_geolocalizacao_vendedores")


def medallion_reviews(spark, d):
    return read_table(spark, lake_run(spark, d).gold, "dim_avaliacoes")


def medallion_quality(spark, d):
    lake = lake_run(spark, d)
    return quality_report(spark, lake.gold).unionByName(bronze_checks(spark, lake.bronze))


def gold_gate(spark, d):
    """Status and rows of each gold table after a run that a limit holds back."""
    layout = replace(lake_run(spark, d), gold=scratch_path(spark, "gated"))
    for most in (10 ** 12, 0):
        report = run_gold(spark, layout, limits=[Limit("negative_value", "dim_pagamentos", most)])
    frames = [read_table(spark, layout.gold, t).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(t).alias("table_name"), F.lit(report.gold[t]).alias("status"), "n_rows") for t in mp.GOLD_TABLES]
    return reduce(DataFrame.unionByName, frames)


def medallion_kpi_monthly(spark, d):
    return read_table(spark, lake_run(spark, d).gold, "kpi_vendas_mensais")


def medallion_kpi_state(spark, d):
    return read_table(spark, lake_run(spark, d).gold, "kpi_vendas_por_estado")


def medallion_kpi_cube(spark, d):
    """Gold's two indicator tables as read off the cube of its fact."""
    gold = lake_run(spark, d).gold
    cells = kpi.sales_cells(read_table(spark, gold, "fato_vendas"), read_table(spark, gold, "dim_clientes"),
                            order_key="sk_pedido", date_col="data_compra", customer="nk_cliente", status="status_pedido",
                            value="valor_produto", customer_key="nk_cliente", state="estado_cliente")
    cube = kpi.sales_cube(cells)
    monthly, state = kpi.monthly_of(cube), kpi.by_state_of(cube, "customer_state", "order_status")
    return monthly.unionByName(state, allowMissingColumns=True)


QUERIES = {
    "project_rename": project_rename,
    "trim_lower": trim_lower,
    "translate_accents": translate_accents,
    "cast_int_safe": cast_int_safe,
    "cast_double_safe": cast_double_safe,
    "to_date_safe": to_date_safe,
    "to_timestamp_safe": to_timestamp_safe,
    "cast_failure_profile": cast_failure_profile,
    "computed_sum_col": computed_sum_col,
    "drop_null_keys": drop_null_keys,
    "drop_blank_keys": drop_blank_keys,
    "silver_orders": silver_orders,
    "quarantine_rows": quarantine_rows,
    "null_blank_profile": null_blank_profile,
    "dedup_composite_key": dedup_composite_key,
    "dedup_key_count": dedup_key_count,
    "dedup_single_key": dedup_single_key,
    "key_uniqueness": key_uniqueness,
    "dedup_hot_key": dedup_hot_key,
    "fact_join_hot_order": fact_join_hot_order,
    "group_avg_two": group_avg_two,
    "centroid_3key": centroid_3key,
    "centroid_exact": centroid_exact,
    "zip_centroid": zip_centroid,
    "dim_fanout_check": dim_fanout_check,
    "fact_sales_join": fact_sales_join,
    "role_playing_dims": role_playing_dims,
    "rule_score_range": rule_score_range,
    "rule_money_min": rule_money_min,
    "ri_orphans": ri_orphans,
    "kpi_monthly_sales": kpi_monthly_sales,
    "kpi_sales_by_region": kpi_sales_by_region,
    "kpi_cube": kpi_cube,
    "kpi_cube_merged": kpi_cube_merged,
    "csv_multiline_roundtrip": csv_multiline_roundtrip,
    "landing_glob_scan": landing_glob_scan,
    "landing_misfits": landing_misfits,
    "parquet_roundtrip": parquet_roundtrip,
    "atomic_replace": atomic_replace,
    "colocated_fact_join": colocated_fact_join,
    "colocated_hot_order": colocated_hot_order,
    "stream_ingest": stream_ingest,
    "medallion_fact": medallion_fact,
    "medallion_geo_dim": medallion_geo_dim,
    "medallion_customers": medallion_customers,
    "medallion_products": medallion_products,
    "medallion_sellers": medallion_sellers,
    "medallion_payments": medallion_payments,
    "medallion_geo_sellers": medallion_geo_sellers,
    "medallion_reviews": medallion_reviews,
    "medallion_kpi_monthly": medallion_kpi_monthly,
    "medallion_kpi_state": medallion_kpi_state,
    "medallion_kpi_cube": medallion_kpi_cube,
    "medallion_quality": medallion_quality,
    "gold_gate": gold_gate,
}
