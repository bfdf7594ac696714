"""History of schema baselines against a brute-force walk over random captures."""

import datetime as dt
import random

import pytest

from layerkit.plans.drift import KEYS, UNREADABLE, capture_schema
from layerkit.plans.drift_history import drift_between, forget_capture, record_snapshot, schema_as_of, schema_history
from layerkit.registry.io import scratch_db
from layerkit.sinks.tables import write_table
from layerkit.sources.catalog import REGISTRY_SCHEMA

T0 = dt.datetime(2024, 3, 1)


def day(n):
    return T0 + dt.timedelta(days=n)


def brute(captures):
    """captures: [(instant, {(table, column): type}, unreadable tables)] of one schema."""
    rows, held, opened = [], {}, {}
    captures = sorted(captures, key=lambda c: c[0])
    for at, columns, failed in captures:
        now = dict(columns) | {k: t for k, t in held.items() if k[0] in failed}
        for k in set(held) | set(now):
            if held.get(k) != now.get(k):
                if k in held:
                    rows.append((*k, held[k], opened.pop(k), at))
                if k in now:
                    opened[k] = at
        held = now
    return sorted([*rows, *((*k, t, opened[k], None) for k, t in held.items())], key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_history_equals_a_walk_over_captures_in_any_order(spark, seed):
    rng, db = random.Random(seed), scratch_db(spark, "h")
    log, captures = f"{db}.captures", []
    for n in range(7):
        columns = {(t, c): rng.choice(["int", "string"]) for t in "ab" for c in "xyz" if rng.random() < 0.7}
        failed = [t for t in "ab" if rng.random() < 0.25]
        captures.append((day(n), {k: v for k, v in columns.items() if k[0] not in failed}, failed))
    for at, columns, failed in rng.sample(captures, len(captures)) + captures[:1]:
        snap = spark.createDataFrame([("s", t, c, k, True) for (t, c), k in columns.items()], REGISTRY_SCHEMA)
        record_snapshot(snap, "s", log, at, [(t, "cannot be read") for t in failed])
    history = schema_history(spark.table(log))
    got = sorted(((r.table_name, r.column_name, r.data_type, r.valid_from, r.valid_to) for r in history.collect()), key=str)
    assert got == brute(captures)
    forget_capture(spark, "s", log, day(3))
    got = sorted(((r.table_name, r.column_name, r.data_type, r.valid_from, r.valid_to) for r in schema_history(spark.table(log)).collect()), key=str)
    assert got == brute([c for c in captures if c[0] != day(3)])


def test_as_of_and_drift_between(spark):
    db = scratch_db(spark, "h")
    log = f"{db}.captures"
    for n, cols in ((0, {"x": "int", "y": "string"}), (2, {"x": "bigint", "y": "string"}), (4, {}), (6, {"y": "string", "z": "date"})):
        record_snapshot(spark.createDataFrame([("s", "t", c, k, True) for c, k in cols.items()], REGISTRY_SCHEMA), "s", log, day(n))
    history = schema_history(spark.table(log))
    instants = spark.createDataFrame([("s", day(-1), 1), ("s", day(1), 2), ("s", day(2), 3), ("s", day(5), 4), ("q", day(9), 5)],
                                     "schema_name string, at timestamp_ntz, run int")
    got = sorted((r.run, r.column_name, r.data_type) for r in schema_as_of(history, instants).collect())
    assert got == [(2, "x", "int"), (2, "y", "string"), (3, "x", "bigint"), (3, "y", "string")]
    drift = {(r.column_name, r.drift_type, r.old_value, r.new_value) for r in drift_between(history, day(1), day(7)).collect()}
    assert drift == {("x", "COLUMN_REMOVED", "int", None), ("z", "COLUMN_ADDED", None, "date")}
    assert {r.valid_from for r in history.filter("column_name = 'y'").collect()} == {day(0), day(6)}


def test_baseline_survives_an_unreadable_table(spark, monkeypatch, capsys):
    from layerkit.sources import catalog

    db, ctl = scratch_db(spark, "h"), scratch_db(spark, "hc")
    for name in ("good", "bad"):
        write_table(spark.range(1), f"{db}.{name}", mode="overwrite")
    capture_schema(spark, db, f"{ctl}.registry")
    write_table(spark.range(1).selectExpr("id", "id as extra"), f"{db}.good", mode="overwrite")
    real = type(spark).table
    monkeypatch.setattr(type(spark), "table", lambda self, name: (_ for _ in ()).throw(RuntimeError("broken")) if name.endswith("`bad`") else real(self, name))
    capture_schema(spark, db, f"{ctl}.registry")
    monkeypatch.undo()
    assert sorted((r.table_name, r.column_name) for r in spark.table(f"{ctl}.registry").collect()) == [("bad", "id"), ("good", "extra"), ("good", "id")]
    assert UNREADABLE in capsys.readouterr().out and catalog.REGISTRY_SCHEMA.names[:3] == KEYS
