import datetime as dt

from pyspark.sql import functions as F

from alloy.functions.cast import cast_failures, safe_date, safe_double, safe_int, safe_timestamp
from alloy.functions.predicates import is_missing, non_blank
from alloy.functions.text import ACCENTED, PLAIN, fold_accents, normalise, strip


def test_trim_strips_spaces_only(spark):
    df = spark.createDataFrame([("  a b  ",), ("\tx ",), (None,)], "s string")
    got = [r[0] for r in df.select(strip("s")).collect()]
    assert got == ["a b", "\tx", None]


def test_normalise_and_fold(spark):
    df = spark.createDataFrame([("  SÃO Paulo ",), ("Açaí ",), ("Ñandú",), ("MÜNCHEN",)], "s string")
    got = [r[0] for r in df.select(fold_accents(normalise("s"))).collect()]
    # ñ, ü are not in the map and stay as they are
    assert got == ["sao paulo", "acai", "ñandu", "münchen"]


def test_accent_map_is_aligned():
    assert len(ACCENTED) == len(PLAIN) == 18


def test_safe_casts_give_null_not_error(spark):
    df = spark.createDataFrame(
        [("12", "1.5", "2017-10-02 10:56:33", "2017-10-02 10:56:33"),
         ("abc", "", "n/a", "n/a"),
         (" 7 ", "3", None, "2018-01-01")],
        "i string, d string, t string, dt string")
    got = df.select(safe_int("i"), safe_double("d"), safe_timestamp("t", ntz=True),
                    safe_date("dt")).collect()
    assert [tuple(r) for r in got] == [
        (12, 1.5, dt.datetime(2017, 10, 2, 10, 56, 33), dt.date(2017, 10, 2)),
        (None, None, None, None),
        (7, 3.0, None, dt.date(2018, 1, 1)),
    ]


def test_cast_failures_counts_only_non_null_raw(spark):
    df = spark.createDataFrame([("1", "x"), ("abc", None), (None, "2.5")], "a string, b string")
    r = cast_failures(df, {"a": "int", "b": "double"}).collect()[0]
    assert (r.a_bad, r.b_bad) == (1, 1)


def test_predicates(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), ""), (None, None)], "x double, s string")
    miss = [r[0] for r in df.select(is_missing("x", df.schema)).collect()]
    assert miss == [False, True, True]
    nb = [r[0] for r in df.select(F.coalesce(non_blank(["s"]), F.lit(False))).collect()]
    assert nb == [True, False, False]
