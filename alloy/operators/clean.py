"""Declarative table cleaning (PR1, PR2, FL1-FL3, SC1-SC7, DQ6).

A ``TableSpec`` lists the output columns (each a ``ColumnRule``), the
columns that must be present, those that must not be blank, and the
de-duplication key.  ``clean`` turns a raw frame into the clean table;
``quarantine`` returns the rejected rows with a reason instead of losing
them.  Both are lazy single-pass plans: project → filter → (aggregate).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from alloy.functions.cast import safe_cast
from alloy.functions.predicates import any_of, is_blank, is_missing, non_blank
from alloy.functions.text import text_rule
from alloy.operators.dedup import Repeats, keep_one, keep_one_by

REASON_COLUMN = "reject_reason"


@dataclass(frozen=True)
class ColumnRule:
    """One output column: source name, optional new name, text rules, type."""

    source: str
    target: str | None = None
    trim: bool = False
    lower: bool = False
    fold: bool = False
    cast: str | None = None

    @property
    def name(self) -> str:
        return self.target or self.source

    def column(self) -> Column:
        c = text_rule(self.source, trim=self.trim, lower=self.lower, fold=self.fold)
        if self.cast:
            c = safe_cast(c, self.cast)
        return c.alias(self.name)


def keep(source: str, target: str | None = None) -> ColumnRule:
    return ColumnRule(source, target)


def trimmed(source: str, target: str | None = None) -> ColumnRule:
    return ColumnRule(source, target, trim=True)


def code(source: str, target: str | None = None, fold: bool = False) -> ColumnRule:
    """lower(trim(x)), optionally with accent folding."""
    return ColumnRule(source, target, trim=True, lower=True, fold=fold)


def typed(source: str, cast: str, target: str | None = None) -> ColumnRule:
    return ColumnRule(source, target, cast=cast)


@dataclass(frozen=True)
class TableSpec:
    """How one raw table becomes one clean table."""

    name: str
    columns: tuple[ColumnRule, ...]
    required: tuple[str, ...] = ()
    non_blank: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    order_by: tuple = ()

    @property
    def source_columns(self) -> list[str]:
        return list(dict.fromkeys(r.source for r in self.columns))

    @property
    def output_columns(self) -> list[str]:
        return [r.name for r in self.columns]


def project(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The spec's ``select``: every unlisted column is dropped."""
    return df.select(*[r.column() for r in spec.columns])


def valid_rows(projected: DataFrame, spec: TableSpec) -> DataFrame:
    """Drop rows missing a required column (NULL, or NaN in floats) or blank."""
    out = projected
    if spec.required:
        out = out.dropna(subset=list(spec.required))
    if spec.non_blank:
        out = out.filter(non_blank(list(spec.non_blank), out.schema))
    return out


def reject_reason(projected: DataFrame, spec: TableSpec) -> Column:
    """'null_key' / 'blank_key' for a rejected row, NULL for a kept one."""
    schema = projected.schema
    missing = [is_missing(c, schema) for c in spec.required]
    missing += [F.col(c).isNull() for c in spec.non_blank if c not in spec.required]
    blank = [is_blank(c, schema) for c in spec.non_blank]
    return (F.when(any_of(missing), F.lit("null_key"))
             .when(any_of(blank), F.lit("blank_key")))


def clean(df: DataFrame, spec: TableSpec, dedup: bool = True) -> DataFrame:
    """Project, drop invalid rows, keep one row per key."""
    out = valid_rows(project(df, spec), spec)
    if dedup and spec.key:
        out = keep_one(out, spec.key, spec.order_by)
    return out


def clean_counted(df: DataFrame, spec: TableSpec, found: Repeats | None = None) -> tuple[DataFrame, Observation]:
    """``clean``, and an observation whose ``rejected`` is the number of rows it rejects.

    The observation has its value once the frame has been written.
    ``found``: the ``repeats`` of the valid rows' keys, for ``keep_one_by``.
    """
    projected = project(df, spec)
    seen = Observation()
    reason = reject_reason(projected, spec)
    out = valid_rows(projected.observe(seen, F.count(F.when(reason.isNotNull(), 1)).alias("rejected")), spec)
    if found is not None:
        return keep_one_by(out, spec.key, spec.order_by, found, valid_rows(projected, spec)), seen
    return (keep_one(out, spec.key, spec.order_by) if spec.key else out), seen


def empty_quarantine(df: DataFrame, spec: TableSpec) -> DataFrame:
    """No rows, with the columns of ``quarantine``; ``df`` isn't read."""
    return df.sparkSession.createDataFrame([], quarantine(df, spec).schema)


def quarantine(df: DataFrame, spec: TableSpec,
               keep_columns: Sequence[str] | None = None) -> DataFrame:
    """The rows ``clean`` rejects, with a ``reject_reason`` column.

    ``keep_columns`` may name raw columns to carry along (e.g. a row id),
    which the projection would otherwise drop.
    """
    extra = [c for c in (keep_columns or []) if c not in spec.output_columns]
    projected = df.select(*extra, *[r.column() for r in spec.columns])
    return (projected.withColumn(REASON_COLUMN, reject_reason(projected, spec))
                     .filter(F.col(REASON_COLUMN).isNotNull()))
