"""Compiled model tests: every kind, conditions, nulls, empty tables, bounded samples, two scans."""

import datetime as dt

import pytest

from layerkit.operators.constraints import Check, last_count, record_results, run_checks
from layerkit.registry.io import scratch_db

NOW = dt.datetime(2024, 1, 10)
ROWS = [(1, "a", 5.0, "x", dt.datetime(2024, 1, 9), 1), (2, "b", -1.0, " ", dt.datetime(2024, 1, 2), 1), (3, None, None, None, None, 1),
        (4, "zz", 11.0, "y\n", dt.datetime(2023, 1, 1), 1), (4, "a", 5.0, "x", dt.datetime(2024, 1, 1), 1), (None, "a", 5.0, "x", dt.datetime(2024, 1, 1), 1)]
CHECKS = [Check("key", "not_null", "id"), Check("code", "accepted", "code", args={"values": ["a", "b"]}), Check("no_b", "rejected", "code", args={"values": ["b"]}),
          Check("low_high", "range", "v", args={"low": 0.0, "high": 10.0}), Check("letter", "matches", "t", args={"pattern": "x|y"}),
          Check("blank", "not_blank", "t"), Check("sql", "expression", "v > 0 or code = 'b'"), Check("order", "later_than", "at", args={"other": "floor_at"}),
          Check("unique", "unique", columns=("id",)), Check("unique_a", "unique", columns=("code", "v"), where="id is not null and id < 4"),
          Check("fresh", "fresh", "at", args={"as_of": NOW, "max_age": 2 * 86400}), Check("stale", "fresh", "at", where="id > 1", args={"as_of": NOW, "max_age": 86400}),
          Check("few", "row_count", args={"low": 7}), Check("same", "row_count_change", args={"previous": 5, "share": 0.1}),
          Check("first", "row_count_change", args={"previous": None, "share": 0.1}), Check("constant", "not_constant", "one"), Check("varies", "not_constant", "id"),
          Check("where", "not_null", "v", where="code = 'a'")]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "id int, code string, v double, t string, at timestamp_ntz, one int")
    return df.selectExpr("*", "timestamp_ntz'2024-01-01 12:00:00' as floor_at")


def test_every_kind(spark):
    got = {r.test: (r.checked, r.failed, r.passed, r.sample) for r in run_checks(frame(spark, ROWS), CHECKS, "id").collect()}
    assert got == {
        "key": (6, 1, False, ["[null]"]), "code": (6, 1, False, ['["4"]']), "no_b": (6, 1, False, ['["2"]']), "low_high": (6, 2, False, ['["2"]', '["4"]']),
        "letter": (6, 2, False, ['["2"]', '["4"]']), "blank": (6, 1, False, ['["2"]']), "sql": (6, 0, True, []),
        "order": (6, 3, False, ['["4"]', "[null]"]), "unique": (6, 1, False, ['["4"]']), "unique_a": (3, 0, True, []), "fresh": (6, 0, True, []),
        "stale": (4, 1, False, []), "few": (6, 1, False, []), "same": (6, 1, False, []), "first": (6, 0, True, []), "constant": (6, 1, False, []),
        "varies": (6, 0, True, []), "where": (3, 0, True, [])}


def test_empty_table_and_bounded_sample(spark):
    got = {r.test: r.passed for r in run_checks(frame(spark, ROWS).limit(0), CHECKS, "id").collect()}
    assert {k for k, ok in got.items() if not ok} == {"fresh", "stale", "few", "same", "constant", "varies"}
    many = spark.range(1000).selectExpr("id", "cast(null as int) as v", "id % 10 as g")
    r = {x.test: x for x in run_checks(many, [Check("v", "not_null", "v"), Check("g", "unique", columns=("g",))], "id", sample=2).collect()}
    assert r["v"].failed == 1000 and len(r["v"].sample) == 2 and r["g"].failed == 10 and r["g"].sample == ['["0"]', '["1"]']


def test_names_and_kinds_are_checked(spark):
    for bad in ([Check("a", "not_null", "id")] * 2, [Check("a", "odd", "id")]):
        with pytest.raises(ValueError):
            run_checks(frame(spark, ROWS), bad, "id")


def test_row_counts_are_compared_with_the_last_recorded_run(spark):
    log = f"{scratch_db(spark, 'ct')}.results"
    assert last_count(spark, log, "rows") is None
    for n, day in ((6, 2), (3, 1)):      # recorded out of order
        record_results(run_checks(frame(spark, ROWS[:n]), [Check("rows", "row_count")], "id"), log, str(n), dt.datetime(2024, 1, day))
    assert last_count(spark, log, "rows") == 6


def test_two_scans(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, ROWS).write.parquet(path)
    reads = []
    df = spark.read.parquet(path)
    counter = spark.sparkContext.accumulator(0)

    def once(frames):
        counter.add(1)
        yield from frames
    one = df.coalesce(1).mapInPandas(once, df.schema)
    run_checks(one, CHECKS, "id")
    reads.append(counter.value)
    assert reads == [2]
