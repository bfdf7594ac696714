"""Values kept whole in a variant column, and small files merged without touching the others."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from layerkit.operators.columns import split_by_tag
from layerkit.operators.variants import as_type, extract, merged_schemas, read_merged, typed_values
from layerkit.registry.io import scratch_db
from layerkit.sinks import compaction
from layerkit.sinks.compaction import compact, recover_compaction, table_files
from layerkit.sinks.tables import write_table

VALUES = [(1, "numeric", "1.5"), (2, "numeric", "x"), (3, "text", "1.5"), (4, "json", '{"a": {"b": 2}, "c": [1, 2]}'), (5, "json", "{"),
          (6, "day", "2024-02-29"), (7, "day", "2023-02-29"), (8, "flag", "true"), (9, None, "kept"), (10, "other", ""), (11, "json", None),
          (12, "json", "null"), (13, "big", "9007199254740993"), (14, "text", "ü" * 100_000), (15, "numeric", "-0.0"), (16, "numeric", "NaN")]
KINDS = {"json": "json", "day": "date", "flag": "boolean", "big": "bigint"}


@pytest.fixture(scope="module")
def kept(spark):
    raw = spark.createDataFrame(VALUES, "id int, tag string, value string")
    return typed_values(raw, "value", "tag", KINDS, keep_value=True)


def test_every_value_is_kept_and_typed(kept):
    got = {r.id: r for r in kept.select("id", "is_typed", F.try_variant_get("typed_value", "$", "string").alias("text"),
                                        F.schema_of_variant("typed_value").alias("kind"), F.col("typed_value").isNull().alias("gone")).collect()}
    typed = {i: r.is_typed for i, r in got.items()}
    assert typed == {1: True, 2: False, 3: True, 4: True, 5: False, 6: True, 7: False, 8: True, 9: None, 10: None, 11: None, 12: True,
                     13: True, 14: True, 15: True, 16: True}
    assert [i for i, r in got.items() if r.gone] == [11]
    texts = {i: v for i, t, v in VALUES}
    for i in (2, 3, 5, 7, 9, 10, 14):
        assert got[i].text == texts[i] and got[i].kind == "STRING"
    assert {i: got[i].kind for i in (1, 6, 8, 12, 13)} == {1: "DOUBLE", 6: "DATE", 8: "BOOLEAN", 12: "VOID", 13: "BIGINT"}
    assert json.loads(got[4].text) == json.loads(texts[4]) and got[13].text == texts[13]


def test_number_and_text_columns_are_those_of_the_split(spark, kept):
    raw = spark.createDataFrame(VALUES, "id int, tag string, value string")
    assert repr(rows(kept.select("id", "numeric_value", "text_value"))) == repr(
        rows(split_by_tag(raw, "value", "tag").select("id", "numeric_value", "text_value")))
    assert typed_values(raw, "value", "tag", KINDS).columns == ["id", "tag", "typed_value", "is_typed", "numeric_value", "text_value"]


def test_values_are_read_by_path_and_type(kept):
    read = extract(kept, {"b": ("$.a.b", "int"), "c": ("$.c", "array<int>"), "second": ("$.c[1]", "bigint"), "day": ("$", "date"), "none": ("$.x.y", "int")})
    got = {r.id: r for r in read.collect()}
    assert (got[4].b, got[4].c, got[4].second, got[4].none) == (2, [1, 2], 2, None)
    assert got[6].day == dt.date(2024, 2, 29) and got[8].day is None and got[11].b is None


def test_merged_schemas_become_types(spark):
    docs = ['{"a": 1, "b": {"c": "x"}, "d": null, "m": 1}', '{"a": 2.25, "b": {"e": [1]}, "m": "t", "odd name": true}', None]
    raw = spark.createDataFrame([(i, "json", d) for i, d in enumerate(docs)], "id int, tag string, value string")
    kept = typed_values(raw, "value", "tag", KINDS)
    read = read_merged(kept, "doc")
    kind = dict(read.dtypes)["doc"]
    assert kind == "struct<a:decimal(12,2),b:struct<c:string,e:array<bigint>>,d:string,m:variant,odd name:boolean>" or "decimal" in kind
    got = {r.id: r.doc for r in read.orderBy("id").collect()}
    assert (float(got[0].a), got[0].b.c, got[0].b.e, got[0].d) == (1.0, "x", None, None)
    assert (float(got[1].a), got[1].b.c, got[1].b.e, got[1]["odd name"]) == (2.25, None, [1], True) and got[2] is None
    per = {r.id: r.schema for r in merged_schemas(kept, by="id").collect()}
    assert per[0] == "OBJECT<a: BIGINT, b: OBJECT<c: STRING>, d: VOID, m: BIGINT>"
    assert as_type("OBJECT<`VOID OBJECT<`: VOID, a: ARRAY<OBJECT<b: VOID>>>") == "STRUCT<`VOID OBJECT<`: STRING, a: ARRAY<STRUCT<b: STRING>>>"
    empty = typed_values(raw.limit(0), "value", "tag", KINDS)
    assert read_merged(empty, "doc").count() == 0


def _append(spark, table, batches, partition_by=("part",)):
    for rows_ in batches:
        write_table(spark.createDataFrame(rows_, "id long, word string, part string").coalesce(1), table, partition_by=list(partition_by))


def _files(spark, table):
    return {r.path: (r.folder.rsplit("/", 1)[1], r.size) for r in table_files(spark, table).collect()}


def _batches(n):
    return [[(i * 10 + j, f"w{j}", p) for j, p in enumerate(["a", "b b", "x=1/2%", "", None, "007"])] for i in range(n)]


def test_twenty_appends_become_few_files(spark):
    table = f"{scratch_db(spark, 'c')}.t"
    _append(spark, table, [[(-i, "long" * 40 + str(i * 7919 % 1000), "a") for i in range(4000)]])
    large = set(_files(spark, table))
    limit = min(s for _, s in _files(spark, table).values())
    _append(spark, table, _batches(20))
    before, had = rows(spark.table(table)), _files(spark, table)
    done = compact(spark, table, target_bytes=limit * 10, small_bytes=limit)
    now = _files(spark, table)
    folders = {}
    for folder, _ in now.values():
        folders[folder] = folders.get(folder, 0) + 1
    assert rows(spark.table(table)) == before and spark.table(table).schema["part"].dataType.simpleString() == "string"
    assert large <= set(now) and max(folders.values()) == 2 and done.replaced == len(had) - len(large) and done.rounds == 1
    again = compact(spark, table, target_bytes=limit * 10, small_bytes=limit)
    assert (again.replaced, again.written, _files(spark, table)) == (0, 0, now)


def test_bins_follow_the_sizes_and_rounds_take_all(spark):
    table = f"{scratch_db(spark, 'c')}.t"
    _append(spark, table, [[(i, "w" * i, None)] for i in range(30)], partition_by=())
    before, sizes = rows(spark.table(table)), [s for _, s in _files(spark, table).values()]
    target = 4 * max(sizes)
    done = compact(spark, table, target_bytes=target, small_bytes=max(sizes) + 1, round_files=10)
    assert rows(spark.table(table)) == before and 29 <= done.replaced <= 30 and 1 < done.rounds <= 3     # the last may be alone in its bin
    assert done.written + 30 - done.replaced == len(_files(spark, table)) >= sum(sizes) // (target + max(sizes))


@pytest.mark.parametrize("cut", ["before", "after", "half"])
def test_a_round_that_was_cut_off(spark, cut, monkeypatch):
    table = f"{scratch_db(spark, 'c')}.t"
    _append(spark, table, _batches(3))
    before, had = rows(spark.table(table)), set(_files(spark, table))

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if cut == "before":
            m.setattr(compaction, "_write_manifest", stop)      # rows are staged, the manifest is not
        elif cut == "after":
            m.setattr(compaction, "_finish", stop)
        else:
            m.setattr(compaction, "_read_manifest", stop)
        with pytest.raises(KeyboardInterrupt):
            compact(spark, table)
    assert set(_files(spark, table)) == had
    if cut == "half":                                        # one file was moved in already
        home = compaction._about(spark, table)[0]
        root = spark._jvm.org.apache.hadoop.fs.Path(f"{home}/_compaction")
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        staged = fs.listStatus(root)[0].getPath()
        f = compaction._data_files(fs, staged)[0]
        assert fs.rename(f, spark._jvm.org.apache.hadoop.fs.Path(home + f.toString().split(staged.getName())[1]))
    assert recover_compaction(spark, table) == (0 if cut == "before" else 1)
    spark.catalog.refreshTable(table)
    assert rows(spark.table(table)) == before
    assert compact(spark, table).replaced == (len(had) if cut == "before" else 0)
    assert rows(spark.table(table)) == before and len(_files(spark, table)) == 5     # "" and null are one partition
    assert recover_compaction(spark, table) == 0


def test_tables_that_cannot_be_merged(spark):
    db = scratch_db(spark, "c")
    write_table(spark.range(4), f"{db}.b", bucket_by=(2, ["id"]))
    spark.range(2).write.format("json").saveAsTable(f"{db}.j")
    for name in ("b", "j"):
        with pytest.raises(ValueError, match="not merged"):
            compact(spark, f"{db}.{name}")
    spark.range(0).write.saveAsTable(f"{db}.e")
    assert compact(spark, f"{db}.e").replaced == 0 and spark.table(f"{db}.e").count() == 0
