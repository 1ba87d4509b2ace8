"""Deterministic de-duplication (DD1, DD2).

``dropDuplicates`` keeps an arbitrary row per key: which one depends on the
order rows reach the final aggregate.  ``keep_one`` keeps the *first* row per
key in a declared total order, so reruns and different partition counts
agree: first the ``order_by`` columns (NULLs last in either direction), then
every other column ascending as tie-breakers (Spark's natural order, NULLs
first).

It is planned as an aggregation, not a window: ``min`` over a struct whose
fields are the ordering keys followed by the row.  Aggregations combine map
side, so a key that holds a third of the table is reduced to one row per
input partition before the shuffle; a ``row_number`` window would instead
sort all of that key's rows in one task.  Every orderable type has an
order-reversing key expression for descending ``order_by`` columns, arrays
and structs included (built from their elements' and fields' keys), so the
window form is kept only as the reference formulation in tests.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOAT = (T.FloatType, T.DoubleType)

# Each hex digit d of a byte string becomes 15 - d, which reverses the
# byte-wise order; the terminator sorts above every digit, so a string sorts
# after its own extensions, as descending order needs.
_HEX = "0123456789ABCDEF"
_HEX_REVERSED = "FEDCBA9876543210"
_TERMINATOR = "Z"


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.MapType, T.VariantType)):
        return False
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    return True


def _ntz_parts(c: Column) -> list[Column]:
    """(epoch day, microsecond of day) of a TIMESTAMP_NTZ, free of the session zone."""
    day = F.unix_date(c.cast("date"))
    tod = (F.hour(c).cast("long") * 3_600_000_000 + F.minute(c).cast("long") * 60_000_000
           + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long"))
    return [day, tod]


_UTC_ZONES = {"UTC", "Etc/UTC", "GMT", "Etc/GMT", "Z", "+00:00", "Zulu", "UCT"}


def _descending_key(c: Column, dt: T.DataType, utc_session: bool = False) -> list[Column] | None:
    """Columns that sort ascending in the order of ``c`` descending, or None."""
    if isinstance(dt, _INTEGRAL):
        return [F.bitwise_not(c)]
    if isinstance(dt, _FLOAT):
        # NaN is the greatest value, so it comes first when descending.
        return [~F.isnan(c), -c]
    if isinstance(dt, T.DecimalType):
        return [-c]
    if isinstance(dt, T.BooleanType):
        return [~c]
    if isinstance(dt, T.DateType):
        return [F.bitwise_not(F.unix_date(c))]
    if isinstance(dt, T.TimestampType):
        return [F.bitwise_not(F.unix_micros(c))]
    if isinstance(dt, T.TimestampNTZType):
        if utc_session:  # the cast to an instant is exact when the zone has no DST
            return [F.bitwise_not(F.unix_micros(c.cast("timestamp")))]
        return [F.bitwise_not(x) for x in _ntz_parts(c)]
    if isinstance(dt, (T.StringType, T.BinaryType)):
        # Spark orders strings by their UTF-8 bytes (the default collation).
        return [F.concat(F.translate(F.hex(c), _HEX, _HEX_REVERSED), F.lit(_TERMINATOR))]
    if isinstance(dt, T.ArrayType):
        # Elements compare in turn, a NULL element below any value and a
        # prefix below its extensions; reversed: each element becomes
        # (0, its key) or (1, NULL) for a NULL, and an end mark (2) follows.
        if _descending_key(F.lit(None).cast(dt.elementType), dt.elementType, utc_session) is None:
            return None
        def element(e: Column) -> Column:
            return F.struct(F.when(e.isNull(), 1).otherwise(0).alias("f"),
                            _one(_descending_key(e, dt.elementType, utc_session)).alias("v"))
        end = F.array(F.struct(F.lit(2).alias("f"), F.lit(None).alias("v")))
        return [F.concat(F.transform(c, element), end)]
    if isinstance(dt, T.StructType):
        # Fields compare in turn, a NULL field below any value.
        keys = []
        for i, f in enumerate(dt.fields):
            sub = c.getField(f.name)
            inv = _descending_key(sub, f.dataType, utc_session)
            if inv is None:
                return None
            keys.append(F.struct(sub.isNull().alias("n"), _one(inv).alias("v")).alias(f"f{i}"))
        return [F.struct(*keys)]
    return None


def _one(parts: list[Column]) -> Column:
    """Several key columns as one (a struct compares field by field)."""
    if len(parts) == 1:
        return parts[0]
    return F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def _normalise_order(order_by) -> list[tuple[str, bool]]:
    out = []
    for item in order_by or ():
        if isinstance(item, str):
            out.append((item, False))
        else:
            name, direction = item
            out.append((name, str(direction).lower() == "desc"))
    return out


def keep_one(df: DataFrame, key: Sequence[str],
             order_by: Sequence[str | tuple[str, str]] = ()) -> DataFrame:
    """One row per ``key``: the first by ``order_by`` then all other columns.

    ``order_by`` items are a column name (ascending) or ``(name, "desc")``;
    their NULLs sort last in either direction.  Remaining columns break ties
    ascending with NULLs first.  NULL key parts form one group, as in
    ``dropDuplicates``.  Output columns keep the input order.
    """
    key = list(key)
    order = _normalise_order(order_by)
    schema = df.schema
    ordered = {name for name, _ in order}
    rest = [c for c in df.columns if c not in key and c not in ordered]
    if not rest and not order:
        return df.select(*key).distinct()

    utc = df.sparkSession.conf.get("spark.sql.session.timeZone", "") in _UTC_ZONES
    fields: list[Column] = []
    invertible = True
    for i, (name, desc) in enumerate(order):
        c = F.col(name)
        fields.append(c.isNull().alias(f"__null{i}"))
        if desc:
            inv = _descending_key(c, schema[name].dataType, utc)
            if inv is None:
                invertible = False
                break
            fields.extend(x.alias(f"__ord{i}_{j}") for j, x in enumerate(inv))
        fields.append(c)
    if not invertible:
        bad = [n for n, _ in order if not _orderable(schema[n].dataType)]
        raise TypeError(f"order_by columns have no order: {bad}")

    tie = [c for c in rest if _orderable(schema[c].dataType)]
    carried = [c for c in rest if c not in tie]
    fields.extend(F.col(name) for name in tie)

    payload = [name for name, _ in order] + tie
    if carried:
        best = F.min_by(F.struct(*[F.col(c) for c in payload + carried]), F.struct(*fields))
    else:
        best = F.min(F.struct(*fields))
    picked = df.groupBy(*key).agg(best.alias("__best"))
    return picked.select(*[
        F.col(c) if c in key else F.col("__best").getField(c).alias(c) for c in df.columns
    ])


# ------------------------------------------------------------------ by how often keys repeat

_HASH = "__key_hash"
#: Repeated keys whose hashes are broadcast, 8 bytes each.
MOST_REPEATED = 1 << 21
#: A key is frequent beyond this share of the rows (and this number of drawn rows, one of ``DRAWN``).
FREQUENT, DRAWN, LEAST_DRAWN = 0.001, 64, 100


@dataclass(frozen=True)
class Repeats:
    """``hashes``: cached hashes of all repeated keys (``rest_single``), or of the frequent ones alone; ``n`` of them."""

    hashes: DataFrame
    n: int
    rest_single: bool


def _cached(hashes: DataFrame, rest_single: bool) -> Repeats:
    hashes = hashes.select(_HASH).persist()
    return Repeats(hashes, hashes.count(), rest_single)


def repeats(df: DataFrame, key: Sequence[str], most: int = MOST_REPEATED) -> Repeats:
    """Which keys ``keep_one_by`` reduces before a shuffle; ``unpersist`` the hashes.

    All repeated keys, if they are ``most`` at the most: only hashes are
    shuffled to find them.  Else the frequent ones, told from drawn rows; they
    are few.  Which keys these are changes no row of the result.
    """
    hashes = df.select(F.xxhash64(*key).alias(_HASH))
    n, distinct = hashes.agg(F.count(F.lit(1)), F.approx_count_distinct(_HASH, 0.01)).first()
    if n - distinct <= most + 0.02 * n:  # the estimate is off by one per cent or so
        counts = hashes.groupBy(_HASH).agg(F.count(F.lit(1)).alias("__n"))
        found = _cached(counts.where(F.col("__n") > 1), True)
        if found.n <= most:
            return found
        found.hashes.unpersist()
    draw = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(DRAWN))
    counts = hashes.withColumn("__draw", draw).where("__draw = 0").groupBy(_HASH).agg(F.count(F.lit(1)).alias("__n"))
    return _cached(counts.where(F.col("__n") > max(LEAST_DRAWN, FREQUENT * n / DRAWN)), False)


def keep_one_by(df: DataFrame, key: Sequence[str], order_by: Sequence[str | tuple[str, str]],
                found: Repeats, again: DataFrame | None = None) -> DataFrame:
    """``keep_one`` that sorts no input partition whole: ``found`` are the ``repeats`` of its keys.

    The rows of these keys alone are reduced before their shuffle.  The other
    rows stay where they are if no key has two of them (no other row has the
    key's hash, and equal keys have equal hashes), else they are shuffled as
    they are and sorted in parts that AQE sizes.  ``again``: the same rows as
    ``df``, for the second read.
    """
    def of(rows: DataFrame, how: str) -> DataFrame:
        return rows.withColumn(_HASH, F.xxhash64(*key)).join(F.broadcast(found.hashes), _HASH, how).drop(_HASH)

    rest = of(df, "left_anti") if found.n else df
    if not found.rest_single:
        rest = keep_one(rest.repartition(*key), key, order_by)
    if not found.n:
        return rest
    return rest.unionByName(keep_one(of(df if again is None else again, "left_semi"), key, order_by))


def duplicate_count(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: input rows, distinct keys, and rows a dedup would drop."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.sum(F.col("n") - 1).alias("n_dropped"),
    )
