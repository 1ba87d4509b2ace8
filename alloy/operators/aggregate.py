"""Grouped averages (AG1, PR3).

``groupBy().agg(avg)`` is planned as a partial average per input partition,
one hash exchange on the keys and a final merge, so a group holding a third
of the rows costs one row per map task in the shuffle.  Its last bits depend
on the order in which partial sums meet.  ``exact_average`` adds doubles as
whole numbers, so the same rows give the same bits whatever their order and
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_average(df: DataFrame, keys: Sequence[str | Column],
                  values: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """Average of each value column per key; the result keeps the value names.

    NULL key parts form their own group.  NULL values are ignored by ``avg``.
    """
    names = list(names or values)
    return df.groupBy(*keys).agg(*[F.avg(v).alias(n) for v, n in zip(values, names)])


# A finite double is m * 2^(8 b - 54) for a whole m below 2^63, where b is its
# magnitude in steps of 8 bits (one step too low or high still fits).
_STEP = 8
_BITS = 54


def _power(exponent: Column) -> Column:
    """2 to a whole exponent beyond a double's range too, as two factors that each are within it."""
    half = F.floor(exponent / 2)
    return F.struct(F.pow(F.lit(2.0), half).alias("a"), F.pow(F.lit(2.0), exponent - half).alias("b"))


def _times_power(x: Column, exponent: Column) -> Column:
    p = _power(exponent)
    return x * p["a"] * p["b"]


def _binned(x: Column) -> Column:
    """A double as (bin, m, n, odd): n is 1 unless it is NULL; odd is a value that is not finite."""
    finite = ~F.isnan(x) & (F.abs(x) != float("inf"))
    bin_ = F.when(finite, F.when(x == 0, 0).otherwise(F.floor(F.log2(F.abs(x)) / _STEP))).cast("int")
    m = F.when(finite, _times_power(x, _BITS - _STEP * bin_.cast("long"))).cast("long").cast("decimal(20,0)")
    return F.struct(bin_.alias("bin"), m.alias("m"), F.when(x.isNotNull(), 1).otherwise(0).cast("long").alias("n"),
                    F.when(x.isNotNull() & ~finite, x).alias("odd"))


def _total(bins: Column) -> Column:
    """The sum of (bin, m) entries as the nearest double; NULL if there are none.

    Going up the bins, what exceeds a bin's 8 bits is carried on, which leaves
    one digit of base 256 per bin and the last carry.  Going down again, the
    digits are put together up to a number of 100 bits or more; whether any
    digit below is not 0 decides ties.  That number is rounded once.
    """
    whole = "decimal(38,0)"
    sums = F.map_from_entries(bins)
    ids = F.map_keys(sums)
    low, high = F.array_min(ids), F.array_max(ids)

    def up(at: Column, b: Column) -> Column:
        t = at["carry"] + F.coalesce(F.try_element_at(sums, b), F.lit(0).cast(whole))
        digit = F.pmod(t, F.lit(1 << _STEP).cast(whole))
        return F.struct(((t - digit) / F.lit(1 << _STEP).cast("decimal(4,0)")).cast(whole).alias("carry"),
                        F.concat(at["digits"], F.array(digit.cast("int"))).alias("digits"))

    def down(at: Column, digit: Column) -> Column:
        full = F.abs(at["m"]) >= F.lit(str(2 ** 100)).cast(whole)
        return F.struct(
            F.when(full, at["m"]).otherwise((at["m"] * F.lit(1 << _STEP).cast("decimal(4,0)") + digit).cast(whole)).alias("m"),
            (at["left"] + F.when(full, 1).otherwise(0)).alias("left"),
            (at["rest"] | (full & (digit != 0))).alias("rest"))

    carried = F.aggregate(F.sequence(low, high), F.struct(F.lit(0).cast(whole).alias("carry"),
                          F.array().cast("array<int>").alias("digits")), up)

    def put_together(c: Column) -> Column:
        start = F.struct(c["carry"].alias("m"), F.lit(0).alias("left"), F.lit(False).alias("rest"))
        return F.aggregate(F.reverse(c["digits"]), start, down)

    def rounded(at: Column) -> Column:
        m = (at["m"] * 2 + F.when(at["rest"], 1).otherwise(0)).cast(whole).cast("double")
        return _times_power(m, (F.lit(-_BITS - 1) + _STEP * (low + at["left"])).cast("long"))

    # one entry arrays bind a value to a name for the steps above
    value = F.transform(F.transform(F.array(carried), put_together), rounded)[0]
    return F.when(F.size(bins) > 0, value)


def exact_average(df: DataFrame, keys: Sequence[str | Column], values: Sequence[str],
                  names: Sequence[str] | None = None) -> DataFrame:
    """``group_average`` of doubles, its bits free of the rows' order.

    The sum is exact and rounded once to a double, then divided by the count.
    NULL values are ignored; NaN and infinities give what their sum gives.
    Two aggregations: one row per group, value column, and 8 bits of
    magnitude, then one row per group.
    """
    names = list(names or values)
    cols = [k if isinstance(k, Column) else F.col(k) for k in keys]
    tags = [f"__k{i}" for i in range(len(cols))]
    entries = F.array(*[F.struct(F.lit(i).alias("v"), _binned(F.col(v).cast("double")).alias("x"))
                        for i, v in enumerate(values)])
    each = df.select(*[c.alias(t) for c, t in zip(cols, tags)], F.explode(entries).alias("e"))
    parts = each.groupBy(*tags, F.col("e.v").alias("v"), F.col("e.x.bin").alias("bin")).agg(
        F.sum("e.x.m").cast("decimal(38,0)").alias("m"), F.sum("e.x.n").alias("n"), F.sum("e.x.odd").alias("odd"))
    aggs = []
    for i in range(len(names)):
        here = F.col("v") == i
        aggs += [F.collect_list(F.when(here & F.col("bin").isNotNull(), F.struct("bin", "m"))).alias(f"__bins{i}"),
                 F.sum(F.when(here, F.col("n"))).alias(f"__n{i}"), F.sum(F.when(here, F.col("odd"))).alias(f"__odd{i}")]
    out = parts.groupBy(*tags).agg(*aggs)
    labels = df.select(*cols).columns
    return out.select(*[F.col(t).alias(n) for t, n in zip(tags, labels)], *[
        F.when(F.col(f"__n{i}") > 0, F.coalesce(F.col(f"__odd{i}"), _total(F.col(f"__bins{i}"))) / F.col(f"__n{i}")).alias(n)
        for i, n in enumerate(names)])


def centroid(df: DataFrame, zip_col: str, lat: str, lng: str,
             city: str, state: str) -> DataFrame:
    """Mean position per (zip, city, state) after dropping rows with no position.

    Rows whose zip, latitude or longitude is NULL (or NaN) are dropped first,
    as the geolocation cleaning does; a NULL city or state is its own group.
    The means are exact to the last bit, so a rerun writes the same table.
    """
    located = df.dropna(subset=[zip_col, lat, lng])
    return exact_average(located, [zip_col, city, state], [lat, lng])


def one_per_key(df: DataFrame, key: str, values: Sequence[str],
                labels: Sequence[str] = ()) -> DataFrame:
    """A zip-unique form of the centroid table, safe to join on ``key`` alone.

    Positions are averaged over all rows of the key; each label column keeps
    its smallest value.  Joining the 3-key table by zip would multiply fact
    rows wherever a zip has two spellings of its city.
    """
    return df.groupBy(key).agg(
        *[F.avg(v).alias(v) for v in values],
        *[F.min(c).alias(c) for c in labels],
    )
