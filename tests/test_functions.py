"""Column functions on the edge rows listed for each operator."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from layerkit.functions import (age_from_date, age_from_year, at_most, cast_columns,
                                decode, flag, full_match, minutes_between,
                                null_if_token, parse_timestamp, surrogate_key, try_cast)


def test_casts_null_tolerant(spark):
    df = spark.createDataFrame(
        [("1",), ("",), ("abc",), ("1.9",), ("1e12",), ("1.005",), ("2020",), (None,)], "v string")
    out = cast_columns(df.select(*[F.col("v").alias(c) for c in ("d", "i", "m", "dt")]),
                       {"d": "double", "i": "int", "m": "decimal(10,2)", "dt": "date"})
    got = [tuple(r) for r in out.collect()]
    assert got[0][:3] == (1.0, 1, Decimal("1.00"))
    assert got[1] == (None, None, None, None)          # empty → NULL
    assert got[2] == (None, None, None, None)          # junk → NULL, no exception
    assert got[3][1] == 1                               # "1.9" → 1 (truncated)
    assert got[4][2] is None                            # decimal overflow → NULL
    assert got[5][2] == Decimal("1.01")                 # half-up
    assert got[6][3] == dt.date(2020, 1, 1)             # lenient date
    assert got[7] == (None, None, None, None)


def test_sentinel_then_date(spark):
    df = spark.createDataFrame([("-",), ("2020-02-03",), (None,)], "d string")
    got = [r[0] for r in df.select(try_cast(null_if_token("d", ["-"]), "date")).collect()]
    assert got == [None, dt.date(2020, 2, 3), None]


def test_parse_timestamp_literal_z(spark):
    df = spark.createDataFrame([("2020-01-02T03:04:05Z",), ("2020-01-02 03:04:05",), (None,)], "s string")
    got = [r[0] for r in df.select(
        parse_timestamp("s", "yyyy-MM-dd'T'HH:mm:ss'Z'").cast("timestamp_ntz")).collect()]
    assert got == [dt.datetime(2020, 1, 2, 3, 4, 5), None, None]


def test_decode_and_flags(spark):
    df = spark.createDataFrame([("M",), ("S",), ("X",), (None,)], "m string")
    got = df.select(decode("m", {"M": "Married", "S": "Single"}, "Unknown").alias("a"),
                    decode("m", {"M": "Married"}).alias("b"),
                    flag(F.col("m") == "M").alias("c")).collect()
    assert [tuple(r) for r in got] == [("Married", "Married", True), ("Single", None, False),
                                       ("Unknown", None, False), ("Unknown", None, False)]


def test_full_match_rejects_trailing_newline(spark):
    vals = ["1234567890", "123456789", "12345678901", "1234567890\n", "abcdefghij", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(flag(full_match("v", r"\d{10}"))).collect()]
    assert got == [True, False, False, False, False, False]


def test_threshold_flag(spark):
    df = spark.createDataFrame([(30,), (31,), (None,)], "d int")
    assert [r[0] for r in df.select(at_most("d", 30)).collect()] == [True, False, False]


def test_surrogate_key_forms(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a_b", "c", None)],
                               "x string, y string, z string")
    plain = [r[0] for r in df.select(surrogate_key(["x", "y", "z"])).collect()]
    safe = [r[0] for r in df.select(surrogate_key(["x", "y", "z"], null_token="\\N")).collect()]
    assert plain[0] == plain[1]            # NULL parts are skipped (original rule)
    assert safe[0] != safe[1]              # token keeps positions
    assert len(plain[0]) == 32


def test_age_rules(spark):
    df = spark.createDataFrame(
        [(dt.date(1990, 1, 1),), (dt.date(1990, 12, 31),), (dt.date(2000, 2, 29),), (None,)],
        "b date")
    out = df.select(age_from_date("b", "2024-12-31").alias("d365"),
                    age_from_date("b", "2024-12-31", mode="calendar").alias("cal"),
                    age_from_year(F.year("b"), "2024-12-31").alias("yr")).collect()
    assert tuple(out[0]) == (35, 34, 34)       # days/365 overstates just before a birthday
    assert tuple(out[1]) == (34, 34, 34)
    assert tuple(out[2]) == (24, 24, 24)
    assert tuple(out[3]) == (None, None, None)


def test_minutes_truncate_toward_zero(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2020, 1, 1, 0, 0, 0), dt.datetime(2020, 1, 1, 0, 1, 30)),
         (dt.datetime(2020, 1, 1, 0, 1, 31), dt.datetime(2020, 1, 1, 0, 0, 0)),
         (dt.datetime(2020, 1, 1), None)], "s timestamp_ntz, e timestamp_ntz")
    assert [r[0] for r in df.select(minutes_between("s", "e")).collect()] == [1, -1, None]
