import math

import pandas as pd

from alloy.operators import aggregate, kpi, quality, star
from alloy.plans.marketplace import GEOLOCATION, SILVER_SPECS, build_fact, silver_post
from alloy.operators.clean import clean

from conftest import rows


def test_geolocation_centroid(spark):
    raw = spark.createDataFrame([
        ("01037", "-23.5", "-46.6", "São Paulo", "SP"),
        ("01037", "-23.7", "-46.8", " sao paulo", "sp"),
        ("01037", "-20.0", "-40.0", "Osasco", "SP"),
        ("02000", None, "-46.0", "x", "SP"),
        ("02000", "NaN", "-46.0", "x", "SP"),
        ("03000", "1.0", "2.0", None, "SP"),
        ("", "5.0", "6.0", "Ñuñoa", "RM"),
    ], "geolocation_zip_code_prefix string, geolocation_lat string, geolocation_lng string, "
       "geolocation_city string, geolocation_state string")
    out = silver_post(GEOLOCATION, clean(raw, SILVER_SPECS[GEOLOCATION]))
    got = sorted((r[0], r[1], r[2], round(r[3], 6), round(r[4], 6)) for r in
                 out.select("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state",
                            "geolocation_lat", "geolocation_lng").collect())
    assert got == [
        ("", "ñuñoa", "rm", 5.0, 6.0),                 # blank zip is kept, ñ not folded
        ("01037", "osasco", "sp", -20.0, -40.0),
        ("01037", "sao paulo", "sp", -23.6, -46.7),   # two spellings, one group
        ("03000", None, "sp", 1.0, 2.0),              # NULL city is its own group
    ]


def test_group_average_keeps_value_names(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, None)], "k string, x double, y double")
    out = aggregate.group_average(df, ["k"], ["x", "y"])
    assert out.columns == ["k", "x", "y"]
    assert rows(out) == [("a", 2.0, 2.0)]


def test_fact_join_and_total(spark):
    items = spark.createDataFrame([
        ("o1", 1, "p1", "s1", None, 10.0, 2.5),
        ("o1", 2, "p2", "s1", None, 5.0, None),
        ("o9", 1, "p1", "s2", None, 1.0, 1.0),   # no order: dropped
    ], "order_id string, order_item_id int, product_id string, seller_id string, "
       "shipping_limit_date timestamp, price double, freight_value double")
    orders = spark.createDataFrame([
        ("o1", "c1", "delivered", None, None, None, None, None),
        ("o2", "c2", "shipped", None, None, None, None, None),  # no items: dropped
    ], "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
       "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
       "order_delivered_customer_date timestamp, order_estimated_delivery_date date")
    fact = build_fact(items, orders)
    assert len(fact.columns) == 14
    got = rows(fact.select("sk_pedido", "quantidade_itens", "valor_total_item", "nk_cliente"))
    assert got == [("o1", 1, 12.5, "c1"), ("o1", 2, None, "c1")]


def test_role_view(spark):
    geo = spark.createDataFrame([("01037", 1.0)], "zip string, lat double")
    v = star.role_view(geo, [("zip", "cep_{role}"), ("lat", "lat_{role}")], "vendedor")
    assert v.columns == ["cep_vendedor", "lat_vendedor"]


def test_quality_checks(spark):
    df = spark.createDataFrame([
        ("a", 1, "x", 3), ("a", 1, " ", 0), ("b", 2, None, 6), ("b", 3, "", None),
    ], "k string, n int, s string, score int")
    prof = quality.null_blank_profile(df, ["s"]).collect()[0]
    assert (prof.n_rows, prof.s_null, prof.s_blank) == (4, 1, 2)
    assert rows(quality.check_unique(df, ["k", "n"])) == [("a", 1, 2)]
    rng = rows(quality.check_range(df, "score", 1, 5, by=["k"]))
    assert rng == [("a", 2, 1, 1), ("b", 2, 0, 1)]
    assert rows(quality.check_min(df, "score", 1)) == [(4, 2, 1)]
    parents = spark.createDataFrame([("a",)], "key string")
    orphans = quality.find_orphans(df.union(spark.createDataFrame([(None, 9, "z", 1)], df.schema)),
                                   parents, ["k"], ["key"])
    assert sorted(r.n for r in orphans.collect()) == [2, 3, 9]
    dim = spark.createDataFrame([("01", "a"), ("01", "b"), ("01", "a"), ("02", "c")], "zip string, city string")
    assert rows(quality.check_fanout(dim, ["zip"])) == [("01", 2)]


def test_kpis_match_brute_force(spark):
    items = pd.DataFrame({"ok": [1, 1, 2, 3, 3, 3], "v": [1.10, 2.20, 3.30, 0.01, 0.02, None]})
    orders = pd.DataFrame({"key": [1, 2, 3, 4], "cust": [10, 10, 20, 20], "st": ["F", "O", "F", "F"],
                           "d": pd.to_datetime(["2020-01-05", "2020-01-20", "2020-02-01", "2020-02-02"])})
    cg = pd.DataFrame({"ck": [10, 20], "grp": ["EU", "AM"]})
    si, so, sc = (spark.createDataFrame(x) for x in (items, orders, cg))
    sales = si.join(so, si.ok == so.key)
    m = kpi.monthly_sales(sales, order_key="key", date_col="d", value="v")
    assert rows(m) == [(2020, 1, 2, 6.6, 0), (2020, 2, 1, 0.03, 1)]
    g = kpi.sales_by_group(sales, sc, customer="cust", attr="st", customer_key="ck",
                           group_col="grp", value="v")
    assert rows(g) == [("AM", "F", 3, 0.03, 1), ("EU", "F", 2, 3.3, 0), ("EU", "O", 1, 3.3, 0)]
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows(g) for v in r)


def test_count_orphans_equals_rows_found(spark):
    child = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k", "id AS v")
    parent = spark.range(0, 3000, 2).selectExpr("id AS pk")  # even keys only; 7 (hot) is missing
    n = quality.count_orphans(child, parent, ["k"], ["pk"]).collect()[0].n_orphans
    assert n == quality.find_orphans(child, parent, ["k"], ["pk"]).count()
    assert n == child.join(parent, child.k == parent.pk, "left_anti").count()
