import datetime as dt

from alloy.operators.clean import REASON_COLUMN, TableSpec, clean, code, project, quarantine, trimmed, typed
from alloy.plans.marketplace import ORDERS, PRODUCTS, SILVER_SPECS

from conftest import rows

RAW_ORDERS = [
    # order_id, customer_id, status, purchase, approved, carrier, delivered, estimated
    (" o1 ", "c1", " Delivered ", "2017-10-02 10:56:33", "2017-10-02 11:07:15", None, None, "2017-10-18 00:00:00"),
    (None, "c2", "shipped", "2017-10-03 10:00:00", None, None, None, "2017-10-20"),
    ("   ", "c3", "shipped", "2017-10-03 10:00:00", None, None, None, "2017-10-20"),
    ("o4", "", "shipped", "2017-10-03 10:00:00", None, None, None, "2017-10-20"),
    ("o5", "c5", "INVOICED", "n/a", None, None, None, "2017-10-20"),
    ("o6", "c6", "canceled", "2018-01-01 00:00:00", None, None, None, None),
    ("o6", "c6", "delivered", "2018-02-01 00:00:00", None, None, None, None),
]
RAW_SCHEMA = ("order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
              "order_approved_at string, order_delivered_carrier_date string, "
              "order_delivered_customer_date string, order_estimated_delivery_date string")


def test_silver_orders_contents(spark):
    raw = spark.createDataFrame(RAW_ORDERS, RAW_SCHEMA)
    got = rows(clean(raw, SILVER_SPECS[ORDERS]))
    assert got == [
        ("o1", "c1", "delivered", dt.datetime(2017, 10, 2, 10, 56, 33), dt.datetime(2017, 10, 2, 11, 7, 15),
         None, None, dt.date(2017, 10, 18)),
        ("o5", "c5", "invoiced", None, None, None, None, dt.date(2017, 10, 20)),
        # the later of two rows of one id survives
        ("o6", "c6", "delivered", dt.datetime(2018, 2, 1), None, None, None, None),
    ]


def test_quarantine_reasons(spark):
    raw = spark.createDataFrame(RAW_ORDERS, RAW_SCHEMA)
    q = quarantine(raw, SILVER_SPECS[ORDERS]).select("customer_id", REASON_COLUMN)
    assert rows(q) == [("", "blank_key"), ("c2", "null_key"), ("c3", "blank_key")]


def test_rows_are_accounted_for(spark):
    raw = spark.createDataFrame(RAW_ORDERS, RAW_SCHEMA)
    spec = SILVER_SPECS[ORDERS]
    kept = clean(raw, spec).count()
    rejected = quarantine(raw, spec).count()
    valid = clean(raw, spec, dedup=False).count()
    assert raw.count() == kept + rejected + (valid - kept)
    assert (kept, rejected, valid) == (3, 3, 4)


def test_cleaning_is_idempotent(spark):
    spec = TableSpec("t", (trimmed("a"), code("b"), typed("c", "int")), required=("a",), non_blank=("a",), key=("a",))
    raw = spark.createDataFrame([(" x ", " AB ", "1"), ("y", "c", "z"), ("", "d", "3")], "a string, b string, c string")
    once = clean(raw, spec)
    twice = clean(once.selectExpr("a", "b", "cast(c as string) c"), spec)
    assert rows(once) == rows(twice)


def test_project_renames_typo_columns(spark):
    spec = SILVER_SPECS[PRODUCTS]
    raw = spark.createDataFrame([(" p1 ", " Beleza_Saude ", "40", "287", "1", "225", "16", "10", "14")],
                                ", ".join(f"{c} string" for c in spec.source_columns))
    out = project(raw, spec)
    assert "product_name_length" in out.columns and "product_description_length" in out.columns
    assert rows(out) == [("p1", "beleza_saude", 40, 287, 1, 225.0, 16.0, 10.0, 14.0)]


def test_nan_in_required_double_is_dropped(spark):
    spec = TableSpec("g", (typed("lat", "double"),), required=("lat",))
    raw = spark.createDataFrame([("1.5",), ("NaN",), (None,)], "lat string")
    assert rows(clean(raw, spec)) == [(1.5,)]


from hypothesis import given, settings, strategies as st  # noqa: E402

_ids = st.one_of(st.none(), st.sampled_from(["", " ", "a", " a ", "b", "c\t"]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(_ids, _ids, st.one_of(st.none(), st.sampled_from(["1", "x", " 2 "]))),
                max_size=25))
def test_every_row_is_kept_rejected_or_a_duplicate(spark, data):
    spec = TableSpec("t", (trimmed("id"), trimmed("other"), typed("n", "int")),
                     required=("id",), non_blank=("id", "other"), key=("id",),
                     order_by=(("n", "desc"),))
    raw = spark.createDataFrame(data, "id string, other string, n string")
    kept = clean(raw, spec).count()
    rejected = quarantine(raw, spec).count()
    valid = clean(raw, spec, dedup=False)
    duplicates = valid.count() - valid.select("id").distinct().count()
    assert len(data) == kept + rejected + duplicates
    # a kept id is never blank or NULL, and appears once
    ids = [r.id for r in clean(raw, spec).collect()]
    assert all(i for i in ids) and len(ids) == len(set(ids))


def test_non_blank_on_a_typed_column(spark):
    spec = TableSpec("t", (trimmed("id"), typed("n", "int")), non_blank=("id", "n"))
    raw = spark.createDataFrame([("a", "1"), ("b", "x"), ("", "2")], "id string, n string")
    assert rows(clean(raw, spec)) == [("a", 1)]
    assert rows(quarantine(raw, spec).select("id", REASON_COLUMN)) == [("", "blank_key"), ("b", "null_key")]
