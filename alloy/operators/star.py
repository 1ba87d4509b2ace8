"""Star-schema building blocks (JN1, JN2, PR1, PR4, PR5, SC8).

Joins are declared and left to Catalyst and AQE: an equi-join of two large
tables becomes a sort-merge join on the key (AQE splits a skewed key's
partitions); a side that proves small is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Mapping = Sequence[tuple[str | Column, str]]


def rename(df: DataFrame, mapping: Mapping) -> DataFrame:
    """``select(src.alias(dst), …)``: listed columns only, in the listed order."""
    return df.select(*[(F.col(s) if isinstance(s, str) else s).alias(d) for s, d in mapping])


def total(a: str | Column, b: str | Column) -> Column:
    """``a + b``; NULL when either side is NULL."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return a + b


def fact_join(items: DataFrame, orders: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner equi-join sharing the key name(s); the key appears once.

    Items with no order and orders with no item are not in the result.
    """
    return items.join(orders, on=key, how="inner")


def role_view(df: DataFrame, mapping: Mapping, role: str) -> DataFrame:
    """One source projected for one role: ``{role}`` in names is filled in.

    ``role_view(geo, [("zip", "zip_{role}")], "customer")`` and the same with
    ``"seller"`` give two dimensions over one scan of the source.
    """
    return rename(df, [(s, d.format(role=role)) for s, d in mapping])

