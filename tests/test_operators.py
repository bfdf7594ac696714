"""DataFrame operators: normalise, dedup, lookup, diff, sequence, quality."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_CHECK, rows
from layerkit.operators import (keep_latest, keyed_diff, left_join_split, lookup,
                                next_in_sequence, normalise, quality_checks, split_by_tag)


def test_normalise_lower_rename_drop(spark):
    df = spark.createDataFrame([(1, "x", "s")], "ID int, Marital string, SSN string")
    out = normalise(df, rename={"marital": "marital_status", "absent": "nothing"}, drop=("ssn",))
    assert out.columns == ["id", "marital_status"]


def test_normalise_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`Id` int, `ID` int")
    with pytest.raises(ValueError):
        normalise(df)


def test_split_by_tag(spark):
    df = spark.createDataFrame(
        [("numeric", "1.5"), ("numeric", "abc"), ("text", "hello"), ("other", "7"), (None, "8")],
        "type string, value string")
    out = split_by_tag(df, "value", "type")
    assert "value" not in out.columns
    assert [tuple(r) for r in out.collect()] == [
        ("numeric", 1.5, None), ("numeric", None, None), ("text", None, "hello"),
        ("other", None, None), (None, None, None)]


def test_keep_latest_edges(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    data = [("a", t1, "old"), ("a", t2, "new"), ("b", t1, "only"),
            ("c", t1, "x"), ("c", t1, "y"), (None, t1, "n1"), (None, t2, "n2")]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v string")
    got = rows(keep_latest(df, "k", "ts"), "k", "v")
    assert got == [("a", "new"), ("b", "only"), ("c", "y"), (None, "n2")]
    # stable under input order
    shuffled = spark.createDataFrame(list(reversed(data)), df.schema).repartition(3)
    assert rows(keep_latest(shuffled, "k", "ts"), "k", "v") == got


def test_keep_latest_plans_partial_limit(spark):
    df = spark.read.parquet(f"{SF_CHECK}/lineitem.parquet")
    plan = keep_latest(df, ["l_orderkey", "l_linenumber"], "l_shipdate")._jdf \
        .queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_lookup_unmatched_and_null(spark):
    df = spark.createDataFrame([("A10",), ("U07",), ("a10",), (None,)], "code string")
    out = lookup(df, {"A": "Infectious"}, on="letter", value="cat",
                 key_expr=F.substring("code", 1, 1))
    assert out.columns[0] == "letter"
    assert rows(out, "code", "cat") == [("A10", "Infectious"), ("U07", None),
                                        ("a10", None), (None, None)]


def test_lookup_rejects_duplicate_keys(spark):
    df = spark.createDataFrame([("A",)], "k string")
    lk = spark.createDataFrame([("A", "x"), ("A", "y")], "k string, v string")
    with pytest.raises(ValueError):
        lookup(df, lk, on="k", check_unique=True)


def test_left_join_split_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "w")], "k int, r string")
    expect = rows(left.join(right, "k", "left"), "k", "l", "r")
    assert rows(left_join_split(left, right, "k"), "k", "l", "r") == expect


def test_keyed_diff_cases(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c"), (5, "e")], "k int, v string")
    got = rows(keyed_diff(old, new, "k", "v"))
    assert got == [(2, "CHANGED", "b", "B"), (3, "CHANGED", None, "c"),
                   (4, "REMOVED", "d", None), (5, "ADDED", None, "e")]


def _plain_lead(df, keys, order, value, alias):
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(alias, F.lead(value).over(w))


def test_next_in_sequence_matches_window_under_hot_key(spark):
    o = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    # a third of all orders moved onto one customer: a hot key
    hot = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(7))
                       .otherwise(F.col("o_custkey")))
    args = (["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", "nxt")
    fast = next_in_sequence(hot, *args, num_slices=16, sliced=True)
    ref = _plain_lead(hot, *args)
    cols = ["o_orderkey", "o_custkey", "nxt"]
    assert rows(fast, *cols) == rows(ref, *cols)


def test_next_in_sequence_null_keys_and_single_rows(spark):
    data = [(None, 1, 10), (None, 2, 20), (1, 1, 5), (2, 1, 7), (2, 2, 8), (2, 3, 9)]
    df = spark.createDataFrame(data, "k int, o int, v int")
    fast = next_in_sequence(df, "k", "o", "v", "nxt", num_slices=4, sliced=True)
    ref = _plain_lead(df, ["k"], ["o"], "v", "nxt")
    assert rows(fast) == rows(ref)


def test_quality_checks(spark):
    child = spark.createDataFrame([(1, 1, "x"), (1, 1, None), (2, 1, "y"), (9, 1, "z")],
                                  "o int, l int, v string")
    parent = spark.createDataFrame([(1,), (2,)], "o int")
    r = quality_checks(child, ["o", "l"], not_null=["v"], parent=parent,
                       parent_key="o", fk="o").first()
    assert (r["row_count"], r["null_v"], r["duplicate_keys"], r["orphan_rows"]) == (4, 1, 1, 1)


def test_lookup_null_mapping_keys_may_repeat(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    table = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v int")
    assert rows(lookup(df, table, on="k"), "k", "v") == [("a", 1), (None, None)]


def test_lookup_ignore_case(spark):
    df = spark.createDataFrame([("a10",), ("A11",)], "code string")
    out = lookup(df, {"A": "Infectious"}, on="letter", value="cat",
                 key_expr=F.substring("code", 1, 1), ignore_case=True)
    assert rows(out, "code", "cat") == [("A11", "Infectious"), ("a10", "Infectious")]


def test_keyed_diff_duplicate_keys_not_multiplied(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "x")], "k int, v string")
    new = spark.createDataFrame([(1, "c"), (1, "d"), (1, "e"), (2, "x")], "k int, v string")
    got = rows(keyed_diff(old, new, "k", "v"))
    assert got == [(1, "DUPLICATE", "b", "e")]          # one row, not 2 x 3 pairs
    plan = keyed_diff(old, new, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_next_in_sequence_two_key_columns(spark):
    o = spark.read.parquet(f"{SF_CHECK}/orders.parquet")
    keys, order = ["o_orderstatus", "o_orderpriority"], ["o_orderdate", "o_orderkey"]
    fast = next_in_sequence(o, keys, order, "o_orderkey", "nxt", num_slices=9, sliced=True)
    ref = _plain_lead(o, keys, order, "o_orderkey", "nxt")
    assert rows(fast, "o_orderkey", "nxt") == rows(ref, "o_orderkey", "nxt")
