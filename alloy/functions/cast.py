"""Safe casts (SC4-SC7).

Spark 4 runs with ANSI mode on, where ``cast('abc' as int)`` fails the whole
job.  Raw layers hold text, so every cast here is a ``try_cast``: a value
that does not parse becomes NULL, and ``cast_failures`` counts those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Short names accepted in table specs, mapped to Spark SQL type names.
TYPE_NAMES = {
    "int": "int",
    "integer": "int",
    "long": "bigint",
    "bigint": "bigint",
    "double": "double",
    "string": "string",
    "date": "date",
    "timestamp": "timestamp",
    "timestamp_ntz": "timestamp_ntz",
    "boolean": "boolean",
}


def sql_type(name: str) -> str:
    """Spark SQL type name for a spec type (decimal(p,s) passes through)."""
    key = name.strip().lower()
    return TYPE_NAMES.get(key, key)


def safe_cast(c: str | Column, to: str) -> Column:
    """``try_cast`` to ``to``; NULL when the value does not parse."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast(sql_type(to))


def safe_int(c: str | Column) -> Column:
    return safe_cast(c, "int")


def safe_double(c: str | Column) -> Column:
    return safe_cast(c, "double")


def safe_timestamp(c: str | Column, ntz: bool = False) -> Column:
    """Like ``to_timestamp(col)`` without a format, but NULL on bad text."""
    return safe_cast(c, "timestamp_ntz" if ntz else "timestamp")


def safe_date(c: str | Column) -> Column:
    """Like ``to_date(col)``: a timestamp is truncated to its date."""
    return safe_cast(c, "date")


def cast_failures(raw: DataFrame, casts: dict[str, str]) -> DataFrame:
    """One row: per column, how many non-NULL raw values failed to cast.

    A single pass with conditional counts; no row leaves the executors.
    """
    return raw.agg(*[
        F.count(F.when(F.col(c).isNotNull() & safe_cast(c, t).isNull(), 1)).alias(f"{c}_bad")
        for c, t in casts.items()
    ])
