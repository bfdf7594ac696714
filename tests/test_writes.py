"""Writers under failure and concurrency: no lost rows, no side effects."""

import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from conftest import rows
from layerkit.plans.drift import capture_schema, detect_drift
from layerkit.plans.merge import upsert
from layerkit.plans.silver import CleanSpec, apply_spec
from layerkit.session import scratch_path
from layerkit.sinks import replace_scope
from layerkit.sinks.tables import write_table
from layerkit.sources import create_database
from layerkit.streaming import incremental_append
from layerkit.functions.casts import lenient_int


@pytest.fixture
def db(spark):
    name = f"writes_{uuid.uuid4().hex[:8]}"
    return create_database(spark, name, scratch_path(spark, name))


def test_scoped_upsert_null_partitions_and_moved_keys(spark, db):
    schema = "k int, v string, n int, year int"
    t = f"{db}.t"
    upsert(spark.createDataFrame([(1, "a", 1, None), (2, "b", 1, None), (3, "c", 1, 2020), (4, "d", 1, 2019)], schema),
           t, "k", "n", partition_by=["year"], scoped=True)
    batch = spark.createDataFrame([(1, "A", 2, None), (4, "D", 2, 2020)], schema)
    for _ in range(2):                                             # repeating a batch changes nothing
        upsert(batch, t, "k", "n", partition_by=["year"], scoped=True)
        assert rows(spark.table(t), "k", "v", "year") == [
            (1, "A", None), (2, "b", None), (3, "c", 2020), (4, "D", 2020)]


def test_upsert_recovers_an_interrupted_swap(spark, db):
    t = f"{db}.t"
    old = spark.createDataFrame([(i, 1) for i in range(10)], "k int, n int")
    upsert(old, t, "k", "n")
    # the state between the two renames: the new copy is complete, the table has moved away
    write_table(old.unionByName(spark.createDataFrame([(10, 1)], "k int, n int")), f"{t}__staging", "overwrite")
    spark.sql(f"ALTER TABLE {t} RENAME TO {t}__previous")
    upsert(spark.createDataFrame([(11, 1)], "k int, n int"), t, "k", "n")
    assert rows(spark.table(t), "k") == sorted([(i,) for i in range(12)], key=str)
    assert not spark.catalog.tableExists(f"{t}__previous") and not spark.catalog.tableExists(f"{t}__staging")


def test_scope_values_of_any_type_and_foreign_rows(spark, db):
    for i, (typ, a, b) in enumerate([("string", "O'X", "y\\z"), ("int", 1, None), ("boolean", True, False)]):
        t = f"{db}.s{i}"
        df = spark.createDataFrame([(1, a), (2, b)], f"v int, s {typ}")
        replace_scope(df, t, "s")
        replace_scope(df.filter(F.lit(False)), t, "s", a)
        assert rows(spark.table(t), "v") == [(2,)]
        replace_scope(df.filter(F.lit(False)), t, "s", b)
        assert spark.table(t).count() == 0
        replace_scope(df.filter("v = 1"), t, "s", a)
        with pytest.raises(Exception, match="outside the scope"):
            replace_scope(df, t, "s", a)


def test_concurrent_replaces_leave_the_session_setting_alone(spark, db):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "STATIC")
    try:
        for i in range(4):
            replace_scope(spark.createDataFrame([(1, "a"), (2, "b")], "v int, s string"), f"{db}.c{i}", "s")
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(lambda i: replace_scope(
                spark.createDataFrame([(3, "a")], "v int, s string"), f"{db}.c{i % 4}", "s", "a"), range(4)))
        assert spark.conf.get(key) == "STATIC"
        assert all(rows(spark.table(f"{db}.c{i}"), "v") == [(2,), (3,)] for i in range(4))
    finally:
        spark.conf.set(key, before)


def test_incremental_late_ties_and_missing_stamps(spark, db):
    def load(data):
        df = spark.createDataFrame(data, "k int, ts date")
        return incremental_append(df.select("k", "ts"), "ts", f"{db}.t", f"{db}.m", "s", keys="k")
    import datetime as dt
    d = [dt.date(2024, 1, i) for i in range(1, 6)]
    load([(1, d[0]), (2, d[1]), (3, None)])
    load([(1, d[0]), (2, d[1]), (3, None), (4, d[1])])              # 4 carries the mark's own stamp
    load([(1, d[0]), (2, d[1]), (3, d[2]), (4, d[1]), (5, d[1]), (6, None)])
    assert rows(spark.table(f"{db}.t"), "k", "ts") == sorted(
        [(1, d[0]), (2, d[1]), (3, d[2]), (4, d[1]), (5, d[1]), (6, None)], key=str)


def test_incremental_row_arriving_between_bound_and_write(spark, db, monkeypatch):
    import datetime as dt
    import layerkit.streaming.incremental as inc
    d = [dt.date(2024, 1, i) for i in range(1, 4)]
    src = f"{db}.src"
    write_table(spark.createDataFrame([(1, d[0])], "k int, ts date"), src)
    plain = inc.replace_scope

    def late(df, *args):
        spark.createDataFrame([(2, d[1])], "k int, ts date").write.insertInto(src)
        monkeypatch.setattr(inc, "replace_scope", plain)
        return plain(df, *args)
    monkeypatch.setattr(inc, "replace_scope", late)
    inc.incremental_append(spark.table(src), "ts", f"{db}.t", f"{db}.m", "s")
    spark.catalog.refreshTable(src)
    inc.incremental_append(spark.table(src), "ts", f"{db}.t", f"{db}.m", "s")
    assert rows(spark.table(f"{db}.t"), "k") == [(1,), (2,)]


def test_rename_collision_raises_in_clean_specs(spark):
    raw = spark.createDataFrame([("a", "b", "2024")], "PATIENT string, PATIENT_ID string, _ingested_at string")
    with pytest.raises(ValueError, match="duplicate"):
        apply_spec(raw, CleanSpec("x", key=("patient_id",), rename={"patient": "patient_id"}))


def test_lenient_int_truncates_text(spark):
    cases = {"1.99999": 1, "-0.99996": 0, "7": 7, " 8.5 ": 8, ".5": 0, "-3.": -3, "1e3": 1000, "99999999999.1": None,
             "x": None, "": None, "1.9x": None, "123456789012345678901234567890.9": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", lenient_int("s").alias("i"))
    assert {r["s"]: r["i"] for r in df.collect()} == cases


def test_drift_reports_an_unreadable_table_and_goes_on(spark, db, monkeypatch):
    registry, log = f"{db}_ctl.reg", f"{db}_ctl.log"
    create_database(spark, f"{db}_ctl", scratch_path(spark, "ctl"))
    for name in ("bad", "good"):
        write_table(spark.createDataFrame([(1,)], "a int"), f"{db}.{name}")
    capture_schema(spark, db, registry)
    write_table(spark.createDataFrame([(1, 2)], "a int, b int"), f"{db}.good", "overwrite")
    plain = type(spark).table
    monkeypatch.setattr(type(spark), "table", lambda self, n: 1 / 0 if n.endswith("`bad`") else plain(self, n))
    got = rows(detect_drift(spark, db, registry, log), "table_name", "drift_type")
    assert got == [("bad", "TABLE_UNREADABLE"), ("good", "COLUMN_ADDED")]
