"""Evolving types and the file ledger: no value lost, nothing twice."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql.types import _parse_datatype_string as typ

from layerkit.plans import ledger
from layerkit.registry.io import scratch_db
from layerkit.registry.landing import land_file
from layerkit.session import scratch_path
from layerkit.sinks.evolving import IllegalChange, append_widening, least_common_type, read_widened, versions


@pytest.mark.parametrize("a, b, want", [
    ("int", "bigint", "bigint"), ("tinyint", "int", "int"), ("int", "decimal(4,2)", "decimal(12,2)"), ("bigint", "decimal(30,5)", "decimal(30,5)"),
    ("decimal(10,2)", "decimal(8,6)", "decimal(14,6)"), ("decimal(10,2)", "double", "double"), ("float", "int", "double"), ("date", "timestamp_ntz", "timestamp_ntz"),
    ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,double>", "map<string,double>"),
    ("struct<a:int>", "struct<b:string,a:bigint>", "struct<a:bigint,b:string>"), ("string", "int", None), ("decimal(38,0)", "decimal(2,2)", None),
    ("boolean", "int", None), ("map<string,int>", "map<int,int>", None), ("struct<a:int>", "int", None), ("timestamp", "date", None)])
def test_least_common_types(spark, a, b, want):
    for x, y in ((a, b), (b, a)):
        if want is None:
            with pytest.raises(IllegalChange):
                least_common_type(typ(x), typ(y))
        elif "struct" not in want:
            assert least_common_type(typ(x), typ(y)).simpleString() == want
    if want and "struct" in want:
        assert least_common_type(typ(a), typ(b)).simpleString() == want


def test_three_batches_widen_and_lose_nothing(spark):
    table = f"{scratch_db(spark, 'w')}.t"
    batches = [([(1, 5, (7,), [1], "x")], "id int, v int, s struct<a:int>, l array<int>, only string"),
               ([(5_000_000_000, Decimal("1.75"), (8, "b"), [5_000_000_000])], "ID bigint, v decimal(6,2), s struct<a:int,b:string>, l array<bigint>"),
               ([(3, 0.1, None, None)], "id int, v double, s struct<a:tinyint>, l array<int>"), ([(4, None, (9,), [None])], "id int, v void, s struct<a:int>, l array<int>")]
    for rows, schema in batches:
        assert append_widening(spark.createDataFrame(rows, schema), table) == 1
    got = sorted((r.id, r.v, r.s and tuple(r.s), r.l, r.only) for r in read_widened(spark, table).collect())
    assert got == [(1, 5.0, (7, None), [1], "x"), (3, 0.1, None, None, None), (4, None, (9, None), [None], None),
                   (5_000_000_000, 1.75, (8, "b"), [5_000_000_000], None)]
    assert [v["v"].dataType.simpleString() for v in versions(spark, table)] == ["int", "decimal(12,2)", "double"]
    parts = [f for n in range(3) for f in spark.table(f"{table}__v{n}").inputFiles()]
    append_widening(spark.createDataFrame(*batches[0]), table)
    assert set(parts) <= {f for n in range(3) for f in spark.table(f"{table}__v{n}").inputFiles()} and len(versions(spark, table)) == 3


def test_illegal_changes_are_reported_and_write_nothing(spark):
    table = f"{scratch_db(spark, 'w')}.t"
    append_widening(spark.createDataFrame([(1, 2**60 + 1, ([2**60 + 1],))], "id int, big bigint, s struct<l:array<bigint>>"), table)
    for rows, schema, path in ([(("x"), 1)], "id string, big bigint", "id"), ([(1, 0.5)], "id int, big double", "big"), \
            ([(1, ([0.5],))], "id int, s struct<l:array<double>>", "l"):
        with pytest.raises(IllegalChange, match=path):
            append_widening(spark.createDataFrame(rows, schema), table)
    assert len(versions(spark, table)) == 1 and read_widened(spark, table).count() == 1
    # the batch, too, must survive the table's type
    append_widening(spark.createDataFrame([(1, 0.5)], "id int, v double"), f"{table}2")
    with pytest.raises(IllegalChange, match="batch.*1 values"):
        append_widening(spark.createDataFrame([(1, 2**60 + 1), (2, 7)], "id int, v bigint"), f"{table}2")


def test_a_version_that_was_cut_off_is_written_again(spark):
    table = f"{scratch_db(spark, 'w')}.t"
    append_widening(spark.createDataFrame([(1,)], "v int"), table)
    spark.createDataFrame([(9.5,)], "v double").write.saveAsTable(f"{table}__v1")      # written, not recorded
    append_widening(spark.createDataFrame([(2.5,)], "v double"), table)
    assert sorted(r.v for r in read_widened(spark, table).collect()) == [1.0, 2.5]


def setup(spark):
    db, land = scratch_db(spark, "lg"), scratch_path(spark, "lg-land")
    return f"{land}/*.csv", land, f"{db}.raw", f"{db}.ledger"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v string")


def read(spark, raw):
    return sorted((r.k, r.v, r._source_file.rsplit("/", 1)[1]) for r in spark.table(raw).collect())


def test_files_are_taken_once_and_replaced_files_replace_their_rows(spark):
    pattern, land, raw, known = setup(spark)
    land_file(frame(spark, ("1", "a"), ("2", "b")), f"{land}/x y+z%.csv")
    land_file(frame(spark, ("3", "c")), f"{land}/two.csv")
    first = ledger.ingest_new_files(spark, pattern, raw, known)
    assert sorted(r.row_count for r in first.collect()) == [1, 2]
    want = [("1", "a", "x y+z%.csv"), ("2", "b", "x y+z%.csv"), ("3", "c", "two.csv")]
    assert read(spark, raw) == want and ledger.ingest_new_files(spark, pattern, raw, known).collect() == [] and read(spark, raw) == want
    land_file(frame(spark, ("1", "A"), ("9", "z"), ("9", "z")), f"{land}/x y+z%.csv")
    land_file(frame(spark, ("4", "d")), f"{land}/three.csv")
    ledger.ingest_new_files(spark, pattern, raw, known)
    assert read(spark, raw) == [("1", "A", "x y+z%.csv"), ("3", "c", "two.csv"), ("4", "d", "three.csv"), ("9", "z", "x y+z%.csv"), ("9", "z", "x y+z%.csv")]
    land_file(frame(spark, ("q", "q")).limit(0), f"{land}/three.csv")
    land_file(frame(spark, ("5", "e")), f"{land}/five.csv")
    ledger.ingest_new_files(spark, pattern, raw, known)
    assert {x[2] for x in read(spark, raw)} == {"x y+z%.csv", "two.csv", "five.csv"}


def test_a_run_cut_off_before_the_ledger_is_repeated_without_doubles(spark, monkeypatch):
    pattern, land, raw, known = setup(spark)
    land_file(frame(spark, ("1", "a"), ("2", "b")), f"{land}/one.csv")
    real = ledger.write_table

    def cut_off(df, table, **kw):
        if table == known:
            raise RuntimeError("lost")
        return real(df, table, **kw)
    monkeypatch.setattr(ledger, "write_table", cut_off)
    with pytest.raises(RuntimeError):
        ledger.ingest_new_files(spark, pattern, raw, known)
    monkeypatch.undo()
    assert [r.row_count for r in ledger.ingest_new_files(spark, pattern, raw, known).collect()] == [2]
    assert read(spark, raw) == [("1", "a", "one.csv"), ("2", "b", "one.csv")]


def test_a_file_with_another_header_fails_before_anything_is_written(spark):
    pattern, land, raw, known = setup(spark)
    land_file(frame(spark, ("1", "a")), f"{land}/a.csv")
    land_file(frame(spark, ("1", "a")).withColumnRenamed("v", "other"), f"{land}/b.csv")
    with pytest.raises(Exception):
        ledger.ingest_new_files(spark, pattern, raw, known)
    assert not spark.catalog.tableExists(known)


def test_listing_reads_no_contents(spark):
    pattern, land, _, _ = setup(spark)
    land_file(frame(spark, ("1", "a")), f"{land}/a.csv")
    files = ledger.list_files(spark, pattern)
    assert files.columns == ["path", "size", "modified"] and files.first()["modified"] > dt.datetime(2020, 1, 1)
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
