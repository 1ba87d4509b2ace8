"""Row predicates (FL1-FL3, SC9) as Spark columns."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructType


def all_of(preds: list[Column]) -> Column:
    """Boolean AND of predicates; TRUE for an empty list."""
    return reduce(and_, preds) if preds else F.lit(True)


def any_of(preds: list[Column]) -> Column:
    """Boolean OR of predicates; FALSE for an empty list."""
    return reduce(or_, preds) if preds else F.lit(False)


def is_missing(name: str, schema: StructType) -> Column:
    """NULL, or NaN in a float column: the rows ``dropna`` removes."""
    c = F.col(name)
    if isinstance(schema[name].dataType, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_blank(name: str, schema: StructType | None = None) -> Column:
    """The value equals ``""`` (apply after trim, as the cleaning does).

    Only text can be blank: for other types (given a schema) this is FALSE.
    """
    if schema is not None and not isinstance(schema[name].dataType, StringType):
        return F.lit(False)
    return F.col(name) == ""


def non_blank(names: list[str], schema: StructType | None = None) -> Column:
    """``col != ""`` for every text name, NOT NULL for others; NULL fails too."""
    return all_of([F.col(n).isNotNull() & ~is_blank(n, schema) for n in names])
