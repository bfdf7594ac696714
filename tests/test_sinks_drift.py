"""Sinks, sources and schema drift against a scratch namespace."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import rows
from layerkit.plans.bronze import CsvSource, ingest_all
from layerkit.plans.drift import capture_schema, detect_drift, diff_schema
from layerkit.session import scratch_path
from layerkit.sinks import append_evolving, replace_scope, write_table
from layerkit.sources import create_database, read_csv


@pytest.fixture()
def db(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    return create_database(spark, name, scratch_path(spark, name))


def test_write_table_counts(spark, db):
    df = spark.range(100).withColumn("g", F.col("id") % 3)
    assert write_table(df, f"{db}.a", "overwrite", partition_by=["g"]) == 100
    assert write_table(df, f"{db}.a", "overwrite", partition_by=["g"]) == 100
    assert spark.table(f"{db}.a").count() == 100


def test_replace_scope_runs(spark, db):
    tbl = f"{db}.reg"
    base = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "s string, v int")
    replace_scope(base, tbl, "s")                                   # first run creates
    replace_scope(spark.createDataFrame([("a", 9)], "s string, v int"), tbl, "s", "a")
    assert rows(spark.table(tbl), "s", "v") == [("a", 9), ("b", 3)]
    replace_scope(spark.createDataFrame([], "s string, v int"), tbl, "s", "b")   # empty scope
    assert rows(spark.table(tbl), "s", "v") == [("a", 9)]


def test_append_evolving(spark, db):
    tbl = f"{db}.log"
    append_evolving(spark.createDataFrame([(1, "x")], "a int, b string"), tbl)
    append_evolving(spark.createDataFrame([(2, "y", 5)], "a int, b string, c int"), tbl)
    append_evolving(spark.createDataFrame([(3,)], "a int"), tbl)
    assert append_evolving(spark.createDataFrame([], "a int"), tbl) == 0
    assert rows(spark.table(tbl), "a", "b", "c") == [(1, "x", None), (2, "y", 5), (3, None, None)]


def test_csv_edges(spark):
    d = scratch_path(spark, "csv")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "t.csv"), "w") as f:
        f.write('a,b\n"x,1",\n"multi\nline",2\n')
    got = read_csv(spark, os.path.join(d, "t.csv"), multiLine=True).collect()
    assert [tuple(r) for r in got] == [("x,1", None), ("multi\nline", "2")]
    plain = read_csv(spark, os.path.join(d, "t.csv")).count()
    assert plain == 3                                      # quoted newline splits a row
    with open(os.path.join(d, "h.csv"), "w") as f:
        f.write("a,b\n")
    assert read_csv(spark, os.path.join(d, "h.csv")).count() == 0


def test_ingest_all_isolates_failures(spark, db):
    d = scratch_path(spark, "land")
    spark.createDataFrame([(1,)], "a int").write.option("header", True).csv(f"{d}/good.csv")
    status = {r["table_name"]: r for r in
              ingest_all(spark, CsvSource(d, db, "raw"), ["good", "missing"]).collect()}
    assert status["good"]["status"] == "ok" and status["good"]["row_count"] == 1
    assert status["missing"]["status"] == "error" and status["missing"]["row_count"] is None


def test_drift_cases(spark, db):
    ctl = create_database(spark, f"c_{uuid.uuid4().hex[:8]}", scratch_path(spark, "ctl"))
    reg, log = f"{ctl}.schema_registry", f"{ctl}.schema_drift_log"
    with pytest.raises(ValueError):
        detect_drift(spark, db, reg, log)                        # no baseline yet
    write_table(spark.createDataFrame([(1, "a", 1.0)], "k int, old string, t double"),
                f"{db}.x", "overwrite")
    capture_schema(spark, db, reg)
    assert detect_drift(spark, db, reg, log).count() == 0       # no change
    assert not spark.catalog.tableExists(log)                  # empty → no log written
    write_table(spark.createDataFrame([(1, "a", 1)], "k int, new string, t int"),
                f"{db}.x", "overwrite")
    got = rows(detect_drift(spark, db, reg, log), "column_name", "drift_type", "old_value", "new_value")
    assert got == [("new", "COLUMN_ADDED", None, "string"), ("old", "COLUMN_REMOVED", "string", None),
                   ("t", "TYPE_CHANGED", "double", "int")]
    assert spark.table(log).count() == 3


def test_diff_schema_ignores_nullability(spark):
    a = spark.createDataFrame([("s", "t", "c", "int", True)],
                              "schema_name string, table_name string, column_name string, "
                              "data_type string, is_nullable boolean")
    b = a.withColumn("is_nullable", F.lit(False))
    assert diff_schema(a, b).count() == 0


def test_show_preview_prints(spark, capsys):
    from layerkit.sinks import show_preview
    show_preview(spark.createDataFrame([(1, "a")], "k int, v string"), 5)
    out = capsys.readouterr().out.replace(" ", "")
    assert "|k|v|" in out and "|1|a|" in out


def test_append_evolving_never_changes_a_value(spark, db):
    from layerkit.sinks.tables import append_evolving

    table = f"{db}.whole"
    append_evolving(spark.createDataFrame([(1, "a")], "v int, s string"), table)
    append_evolving(spark.createDataFrame([(2.0, 7), (None, None)], "v double, s int"), table)
    for rows, schema in ([(1.75,)], "v double"), ([(5_000_000_000,)], "v bigint"), ([("x7",)], "v string"):
        with pytest.raises(Exception, match="does not fit int"):
            append_evolving(spark.createDataFrame(rows, schema), table)
    assert sorted((r.v, r.s) for r in spark.table(table).collect() if r.v) == [(1, "a"), (2, "7")]
