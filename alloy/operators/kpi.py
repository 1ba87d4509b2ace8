"""Business indicators over the star (AG2).

Money is summed as DECIMAL(38,2) and only the total is turned back into a
double, so totals do not depend on the order rows are added in.  A value
that isn't such a decimal (NaN, infinite, 37 digits or more) is left out of
the revenue and counted as ``n_bad_values``.

``sales`` is one row per item sold with its order's columns: the fact table,
or a join of items and orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(38,2)"
#: Values of up to 16 digits before the point, nearly all of them, are summed in this type.
SMALL = "decimal(18,2)"


def _with_money(df: DataFrame, value: str) -> DataFrame:
    """``df`` with its value as ``__small`` or, where that doesn't hold it, ``__large``; each is cast once."""
    v = F.col(value)
    df = df.withColumn("__small", v.try_cast(SMALL))
    large = F.when(F.col("__small").isNull() & v.isNotNull(), v.try_cast(MONEY))
    return df.withColumn("__large", large).withColumn(
        "__bad", v.isNotNull() & F.col("__small").isNull() & F.col("__large").isNull())


def _revenue() -> Column:
    small, large = F.sum("__small").cast(MONEY), F.sum("__large")
    return F.coalesce(small + large, small, large)


def _measures() -> list[Column]:
    return [F.count(F.lit(1)).alias("n_items"), _revenue().alias("revenue"),
            F.count_if("__bad").alias("n_bad_values")]


def monthly_sales(sales: DataFrame, *, order_key: str, date_col: str, value: str) -> DataFrame:
    """Per calendar month of ``date_col``: distinct orders, revenue, bad values.

    The sales are first reduced to one row per order and month.
    """
    per_order = _with_money(sales.select(
        F.col(order_key).alias("__key"), F.year(date_col).cast("int").alias("y"),
        F.month(date_col).cast("int").alias("m"), F.col(value).alias("__value")), "__value").groupBy(
        "__key", "y", "m").agg(F.sum("__small").alias("__small"), F.sum("__large").alias("__large"),
                               F.count_if("__bad").alias("n_bad_values"))
    return per_order.groupBy("y", "m").agg(
        F.count(F.lit(1)).alias("n_orders"), _revenue().cast("double").alias("revenue"),
        F.sum("n_bad_values").alias("n_bad_values"))


def sales_by_group(sales: DataFrame, customer_group: DataFrame, *, customer: str, attr: str,
                   customer_key: str, group_col: str, value: str,
                   attr_name: str | None = None) -> DataFrame:
    """Per (customer group, attribute): item rows, revenue, bad values.

    ``customer_group`` maps a customer key to its group (e.g. region).  The
    sales meet that map at once: one shuffle by customer, in which AQE splits
    a hot customer, and an aggregate that leaves a row per group and task.
    Output columns are named ``group_col`` and ``attr_name`` (or ``attr``).
    """
    sold = sales.select(F.col(customer).alias("__cust"), F.col(attr).alias("__attr"),
                        F.col(value).alias("__value"))
    groups = customer_group.select(F.col(customer_key).alias("__ckey"),
                                   F.col(group_col).alias("__group"))
    joined = _with_money(sold.join(groups, F.col("__cust") == F.col("__ckey"), "inner"), "__value")
    return joined.groupBy(F.col("__group").alias(group_col),
                          F.col("__attr").alias(attr_name or attr)).agg(
        *_measures()).withColumn("revenue", F.col("revenue").cast("double"))


# ------------------------------------------------------------------ the cube

CELL = ("y", "m", "state", "status", "known")
SKETCH_BITS = 12  # 4 KB a sketch at most; relative error of a distinct count about 1.6 % (one deviation)
#: Sets of a cell's columns that the cube has totals of.
SETS = (("y", "m"), ("state", "status"), ("y",), ("state",), ("status",), ())


def sales_cells(sales: DataFrame, customers: DataFrame, *, order_key: str, date_col: str, customer: str,
                status: str, value: str, customer_key: str, state: str,
                sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """One row per month, customer state and order status, from which all indicators follow.

    Columns: y, m, state, status, known (the customer is in ``customers``);
    n_items, revenue (DECIMAL), n_bad_values, n_orders, and ``orders``, a
    sketch of the distinct orders.  The sales are scanned once and reduced to
    a row per order before they meet the customers.

    Sums and sketches of separately made cells merge (``merge_cells``).  An
    order has one month, customer and status, so n_orders adds up over the
    cells of one run; over runs that both hold items of an order only the
    sketches tell it as one.
    """
    per_order = _with_money(sales.select(
        F.col(order_key).alias("__key"), F.year(date_col).cast("int").alias("y"), F.month(date_col).cast("int").alias("m"),
        F.col(customer).alias("__cust"), F.col(status).alias("status"), F.col(value).alias("__value")), "__value").groupBy(
        "__key", "y", "m", "__cust", "status").agg(*_measures())
    states = customers.select(F.col(customer_key).alias("__ckey"), F.col(state).alias("state"))
    joined = per_order.join(states, F.col("__cust") == F.col("__ckey"), "left").withColumn(
        "known", F.col("__ckey").isNotNull())
    return joined.groupBy(*CELL).agg(
        F.sum("n_items").alias("n_items"), F.sum("revenue").cast(MONEY).alias("revenue"),
        F.sum("n_bad_values").alias("n_bad_values"), F.count(F.lit(1)).alias("n_orders"),
        F.hll_sketch_agg(F.col("__key").cast("string"), F.lit(sketch_bits)).alias("orders"))


def _merged() -> list[Column]:
    return [F.sum("n_items").alias("n_items"), F.sum("revenue").cast(MONEY).alias("revenue"),
            F.sum("n_bad_values").alias("n_bad_values"), F.sum("n_orders").alias("n_orders"),
            F.hll_union_agg("orders").alias("orders")]


def merge_cells(*cells: DataFrame) -> DataFrame:
    """Cells of several runs (say, weeks) as the cells of all their sales; see ``sales_cells`` for n_orders."""
    out = cells[0]
    for c in cells[1:]:
        out = out.unionByName(c)
    return out.groupBy(*CELL).agg(*_merged())


def sales_cube(cells: DataFrame, sets: Sequence[Sequence[str]] = SETS) -> DataFrame:
    """Totals of the cells over every set of columns, in one plan over the (small) cells.

    ``level`` names the set, columns joined by ``+`` (``all`` for the empty
    one); columns outside of the set are NULL.  n_orders_estimate is the
    sketch's count.  Rows of unknown customers are in every total but those
    by state.
    """
    by_state = [s for s in sets if "state" in s]
    others = [s for s in sets if "state" not in s]
    names = {tuple(s): "+".join(s) or "all" for s in sets}
    keys = ("y", "m", "state", "status")

    def totals(rows: DataFrame, some: Sequence[Sequence[str]]) -> DataFrame:
        found = rows.groupingSets([[F.col(c) for c in s] for s in some], *[F.col(c) for c in keys]).agg(
            F.grouping_id(*keys).alias("__id"), *_merged())
        level = F.lit(None).cast("string")
        for s in some:  # bit i of the id, from the left, is set if key i is not in the set
            id_ = sum((c not in s) << (len(keys) - 1 - i) for i, c in enumerate(keys))
            level = F.when(F.col("__id") == id_, names[tuple(s)]).otherwise(level)
        return found.select(level.alias("level"), *keys, "n_items", "revenue", "n_bad_values", "n_orders",
                            F.hll_sketch_estimate("orders").alias("n_orders_estimate"))

    parts = [totals(rows, some) for rows, some in ((cells, others), (cells.where("known"), by_state)) if some]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def monthly_of(cube: DataFrame) -> DataFrame:
    """``monthly_sales`` from the cube."""
    return cube.where(F.col("level") == "y+m").select(
        "y", "m", "n_orders", F.col("revenue").cast("double").alias("revenue"), "n_bad_values")


def by_state_of(cube: DataFrame, state: str, status: str) -> DataFrame:
    """``sales_by_group`` by state and status from the cube."""
    return cube.where(F.col("level") == "state+status").select(
        F.col("state").alias(state), F.col("status").alias(status), "n_items",
        F.col("revenue").cast("double").alias("revenue"), "n_bad_values")
