"""Marketplace landing CSVs derived by Spark from the driver's test tables.

Lets the full layer run (landing → bronze → silver → gold) be exercised on
whole tables: every raw column is written as text, ids become strings, zip
prefixes are zero-padded (so a loss of leading zeros would show) and review
texts carry line breaks and quotes.

The test tables are clean, so defects are injected by fixed expressions on
the keys: padded and upper-case codes, blank and NULL keys, repeated keys,
orphans, unreadable numbers, a price beyond any decimal, negative payments,
scores outside 1-5, accented cities, two cities in one zip.  All date
columns of an order differ, as do all sizes of a product.  The oracle SQL
(``oracle.LAKE``) injects the same defects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alloy.plans import marketplace as mp
from alloy.plans.jobs import each
from alloy.sources.csv import write_csv


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _null() -> Column:
    return F.lit(None).cast("string")


def _zip(c: str) -> Column:
    return F.lpad(F.col(c).cast("string"), 5, "0")


def _padded(c: Column) -> Column:
    return F.concat(F.lit("  "), c, F.lit(" "))


def _key(k: Column, blank: int, missing: int | None = None) -> Column:
    """The padded key as text; blank where it is divisible by ``blank``, NULL where by ``missing``."""
    out = F.when(k % blank == 0, F.lit("   ")).otherwise(_padded(k.cast("string")))
    return out if missing is None else F.when(k % missing != 0, out)


def _later(base: Column, days: Column, hours: Column) -> Column:
    return base + F.make_dt_interval(days.cast("int"), hours.cast("int"))


def _orders(orders: DataFrame) -> DataFrame:
    """Every 53rd order a second time, with another status and a later purchase."""
    rows = (orders.withColumn("v", F.lit(0))
            .unionByName(orders.where(F.col("o_orderkey") % 53 == 0).withColumn("v", F.lit(1))))
    k, at, zero = F.col("o_orderkey"), F.col("o_orderdate"), F.lit(0)
    customer = F.concat(F.when(k % 79 == 0, "x").otherwise(""), _s("o_custkey"))
    return rows.select(
        _key(k, 89, 97).alias("order_id"),
        F.when(k % 83 == 0, "").otherwise(customer).alias("customer_id"),
        _padded(F.when(F.col("v") == 1, "Z").otherwise(F.col("o_orderstatus"))).alias("order_status"),
        _s(_later(at, F.col("v"), zero)).alias("order_purchase_timestamp"),
        F.when(k % 11 == 0, "n/a").otherwise(_s(_later(at, zero, k % 5 + 1))).alias("order_approved_at"),
        _s(_later(at, k % 3 + 1, F.lit(2))).alias("order_delivered_carrier_date"),
        F.when(k % 13 != 0, _s(_later(at, k % 4 + 5, zero))).alias("order_delivered_customer_date"),
        _s(F.date_add(F.to_date(at), 30)).alias("order_estimated_delivery_date"))


def _items(items: DataFrame) -> DataFrame:
    p = F.col("l_partkey")
    product = F.when(p % 109 == 0, F.concat(F.lit("x"), _s(p))).otherwise(_s(p))
    seller = F.when(p % 107 == 0, F.concat(F.lit("x"), _s("l_suppkey"))).otherwise(_s("l_suppkey"))
    return items.select(
        _padded(_s("l_orderkey")).alias("order_id"), _s("l_linenumber").alias("order_item_id"),
        F.when(p % 113 == 0, "  ").otherwise(product).alias("product_id"),
        F.when(p % 127 != 0, seller).alias("seller_id"),
        _s("l_shipdate").alias("shipping_limit_date"),
        F.when(p % 103 == 0, "abc").when(p % 499 == 0, "1e40").otherwise(_s("l_extendedprice")).alias("price"),
        _s("l_tax").alias("freight_value"))


def _payments(orders: DataFrame) -> DataFrame:
    """One or two payments of an order; every 59th order's first one twice."""
    k = F.col("o_orderkey")
    order_id = _key(k, 89, 97).alias("order_id")

    def rows(df: DataFrame, seq: str, kind: Column, parts: Column, value: Column) -> DataFrame:
        return df.select(order_id, F.lit(seq).alias("payment_sequential"), kind.alias("payment_type"),
                         _s(parts).alias("payment_installments"), _s(value).alias("payment_value"))

    total = F.col("o_totalprice")
    first = rows(orders, "1", _padded(F.col("o_orderpriority")), k % 4 + 1,
                 F.when(k % 61 == 0, -total).otherwise(total))
    second = rows(orders.where(k % 3 == 0), "2", F.lit("VOUCHER"), F.lit(1), k % 100 + F.lit(0.5))
    again = rows(orders.where(k % 59 == 0), "1", F.lit("0-OTHER"), F.lit(9), F.lit(1.0))
    return first.unionByName(second).unionByName(again)


def _products(part: DataFrame) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    names = ["product_category_name", "product_name_lenght", "product_description_lenght",
             "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm",
             "product_width_cm"]
    product_id = _key(k, 91, 93).alias("product_id")
    rows = part.select(product_id, *[_s(c).alias(n) for n, c in zip(names, [
        _padded(F.upper("p_type")), F.length("p_name"), F.length("p_brand") * 7, size % 6,
        F.col("p_retailprice"), size.cast("double"), size * 2 + F.lit(0.5), size * 3 + F.lit(0.25)], strict=True)])
    again = part.where(k % 47 == 0).select(product_id, *[
        F.lit(v).alias(n) for n, v in zip(names, ["0DUP", "1", "2", "3", "4", "5", "6", "7"], strict=True)])
    return rows.unionByName(again)


def _customers(customers: DataFrame) -> DataFrame:
    """Every 43rd customer a second time without unique id, every 45th with another one."""
    c = F.col("c_custkey")
    city = F.when(c % 2 == 0, F.concat(F.lit("SÃO "), F.upper("n_name"))).otherwise(_padded(F.col("n_name")))

    def rows(df: DataFrame, unique: Column) -> DataFrame:
        return df.select(_key(c, 67).alias("customer_id"), unique.alias("customer_unique_id"),
                         _zip("c_nationkey").alias("customer_zip_code_prefix"), city.alias("customer_city"),
                         _padded(F.col("r_name")).alias("customer_state"))

    return (rows(customers, F.col("c_name")).unionByName(rows(customers.where(c % 43 == 0), _null()))
            .unionByName(rows(customers.where(c % 45 == 0), F.lit("0"))))


def _sellers(suppliers: DataFrame) -> DataFrame:
    k = F.col("s_suppkey")

    def rows(df: DataFrame, zip_code: Column, city: Column) -> DataFrame:
        return df.select(_key(k, 31).alias("seller_id"), zip_code.alias("seller_zip_code_prefix"),
                         city.alias("seller_city"), F.col("r_name").alias("seller_state"))

    return rows(suppliers, _zip("s_nationkey"), F.concat(F.lit(" É "), F.col("n_name"))).unionByName(
        rows(suppliers.where(k % 9 == 0), F.lit("00000"), F.lit("A")))


def _reviews(conversations: DataFrame) -> DataFrame:
    """Every message of every 7th conversation a second time, without an answer."""
    c = F.col("conv_id")
    rows = (conversations.withColumn("v", F.lit(0))
            .unionByName(conversations.where(c % 7 == 0).withColumn("v", F.lit(1))))
    again = F.col("v") == 1
    made = _later(F.lit("2018-01-01").cast("timestamp_ntz"), c % 300, F.lit(0))
    score = F.when(c % 13 == 0, 0).when(c % 17 == 0, 9).when(c % 19 != 0, F.length("role") % 5 + 1)
    return rows.select(
        F.concat_ws("-", _s("conv_id"), _s("turn")).alias("review_id"),
        F.when(c % 23 == 0, "  ").otherwise(_s("conv_id")).alias("order_id"),
        _s(score).alias("review_score"),
        F.when(again, "dup").otherwise(_padded(F.col("role"))).alias("review_comment_title"),
        F.col("text").alias("review_comment_message"), _s(made).alias("review_creation_date"),
        F.when(~again, _s(made + F.make_dt_interval(F.lit(0), (F.col("turn") + 1).cast("int")))).alias(
            "review_answer_timestamp"))


def _geolocation(customers: DataFrame) -> DataFrame:
    c = F.col("c_custkey")
    return customers.select(
        F.when(c % 41 == 0, "  ").otherwise(_zip("c_nationkey")).alias("geolocation_zip_code_prefix"),
        F.when(c % 37 == 0, "NaN").when(c % 39 != 0, _s("c_acctbal")).alias("geolocation_lat"),
        _s(c.cast("double")).alias("geolocation_lng"),
        F.when(c % 3 == 0, F.concat(F.lit(" ÁGUAS "), F.col("n_name"))).otherwise(
            F.initcap("n_name")).alias("geolocation_city"),
        F.col("r_name").alias("geolocation_state"))


def landing_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def t(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    nation, region = t("nation"), t("region")
    geo_names = nation.join(region, nation.n_regionkey == region.r_regionkey)
    customers = t("customer").join(geo_names, F.col("c_nationkey") == F.col("n_nationkey"))
    suppliers = t("supplier").join(geo_names, F.col("s_nationkey") == F.col("n_nationkey"))
    return {
        mp.ORDERS: _orders(t("orders")),
        mp.ITEMS: _items(t("lineitem")),
        mp.PAYMENTS: _payments(t("orders")),
        mp.PRODUCTS: _products(t("part")),
        mp.CUSTOMERS: _customers(customers),
        mp.SELLERS: _sellers(suppliers),
        mp.REVIEWS: _reviews(t("conversations")),
        mp.GEOLOCATION: _geolocation(customers),
    }


def write_landing(spark: SparkSession, sf_dir: str, root: str) -> list[str]:
    """Write all eight landing tables below ``root`` as ``<table>.csv`` folders."""
    frames = landing_frames(spark, sf_dir)
    each(frames, lambda name: write_csv(frames[name], f"{root.rstrip('/')}/{name}.csv"))
    return sorted(frames)
