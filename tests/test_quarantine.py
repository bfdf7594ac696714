"""Bad CSV records land in quarantine with file and reasons; good rows are what the plain reader gives."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerkit.plans.quarantine import accepted, ingest_checked, parse_lines, rejected
from layerkit.registry.io import scratch_db

LINES = ["id,amount,day,note", "1,1.50,2024-01-02,plain", '2,2.25,2024-01-03,"with, comma"', '3,,-,"say ""hi"""', "4,5.00", "5,1,2024-01-01,x,extra",
         '6,1,2024-01-01,"open', "7,abc,2024-01-01,x", "8,1,2024-99-01,x", "9,abc,never,x", "", "   ", "id,amount,day,note", "10,1.005,2024-02-29,é漢", '"11","7","2024-03-01",""',
         "x,1,2024-01-01,y", '12,3,"2024-01-01,x']
TYPES = {"id": "int", "amount": "decimal(10,2)", "day": "date"}


@pytest.fixture(scope="module")
def land(tmp_path_factory):
    d = tmp_path_factory.mktemp("land")
    (d / "a.csv").write_text("\n".join(LINES[:8]) + "\n", encoding="utf-8")
    (d / "b.csv").write_text("\n".join(LINES[:1] + LINES[8:]), encoding="utf-8")
    return str(d)


def test_every_line_lands_once_with_its_reasons(spark, land):
    table = f"{scratch_db(spark, 'q')}.t"
    counts = ingest_checked(spark, f"{land}/*.csv", table, TYPES, null_tokens={"day": ["-"]})
    good = {r.id: (r.amount, r.day, r.note) for r in accepted(spark, table).collect()}
    assert good.pop(11) in ((Decimal("7.00"), dt.date(2024, 3, 1), None), (Decimal("7.00"), dt.date(2024, 3, 1), ""))
    assert good == {1: (Decimal("1.50"), dt.date(2024, 1, 2), "plain"), 2: (Decimal("2.25"), dt.date(2024, 1, 3), "with, comma"),
                    3: (None, None, 'say "hi"'), 10: (Decimal("1.01"), dt.date(2024, 2, 29), "é漢")}
    bad = {r._line: (os.path.basename(r._source_file), r._reasons) for r in rejected(spark, table).collect()}
    assert bad == {
        "4,5.00": ("a.csv", ["too few fields"]), "5,1,2024-01-01,x,extra": ("a.csv", ["too many fields"]), '6,1,2024-01-01,"open': ("a.csv", ["unclosed quote"]),
        "7,abc,2024-01-01,x": ("a.csv", ["not typed: amount"]), "8,1,2024-99-01,x": ("b.csv", ["not typed: day"]),
        "9,abc,never,x": ("b.csv", ["not typed: amount", "not typed: day"]), "x,1,2024-01-01,y": ("b.csv", ["not typed: id"]),
        '12,3,"2024-01-01,x': ("b.csv", ["unclosed quote"])}
    assert counts == {"rows": 13, "rejected": 8, "reasons": {"unclosed quote": 2, "too few fields": 1, "too many fields": 1, "not typed: id": 1,
                                                             "not typed: amount": 2, "not typed: day": 2}}


def test_good_rows_equal_the_plain_reader(spark, land, tmp_path):
    (tmp_path / "g.csv").write_text("\n".join([LINES[0], *LINES[1:4], LINES[13]]), encoding="utf-8")
    table = f"{scratch_db(spark, 'q')}.t"
    ingest_checked(spark, str(tmp_path), table, {})
    plain = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path))
    assert sorted(map(str, accepted(spark, table).select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert rejected(spark, table).count() == 0


def test_one_scan_one_write_and_pruned_reads(spark, land):
    table = f"{scratch_db(spark, 'q')}.t"
    ingest_checked(spark, f"{land}/*.csv", table, TYPES)
    plan = rejected(spark, table)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_rejected" in plan or "_rejected" in plan.split("PartitionFilters")[1][:80]
    assert {"_rejected=true", "_rejected=false"} == {f.split("/")[-2] for f in spark.table(table).inputFiles()}


def test_other_separators_and_no_lines(spark):
    lines = spark.createDataFrame([("1;2,5",), ("1",)], "value string")
    got = sorted((r.a, r.b, r._reasons) for r in parse_lines(lines, ["a", "b"], {"a": "int"}, sep=";").collect() if r.a)
    assert got == [(1, "2,5", [])]
    assert parse_lines(lines.filter(F.lit(False)), ["a"], {}).collect() == []
    with pytest.raises(ValueError):
        parse_lines(lines, ["a"], {}, sep="::")
