"""Maintained summaries equal their full recompute after every batch."""

import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerkit.plans import maintained as m
from layerkit.registry.io import scratch_db

SCHEMA = "who string, item long, cost decimal(10,2), day date"


def spec(spark, **options):
    return m.Maintained(f"{scratch_db(spark, 'mt')}.summary", ("who",), (
        m.Measure("n", "count", "item"), m.Measure("kinds", "distinct", "item"), m.Measure("cost", "sum", "cost"),
        m.Measure("mean", "avg", "cost"), m.Measure("first", "min", "day"), m.Measure("last", "max", "day")),
        inputs={"events": ("who",)}, **{"buckets": 3, **options})


def recompute(rows):
    groups = defaultdict(list)
    for r in rows.elements():
        groups[r[0]].append(r)
    out = {}
    for who, g in groups.items():
        items, costs, days = ([r[i] for r in g if r[i] is not None] for i in (1, 2, 3))
        out[who] = (len(items), len(set(items)), sum(costs, Decimal(0)) if costs else None,
                    float(sum(costs)) / len(costs) if costs else None, min(days, default=None), max(days, default=None))
    return out


def signed(spark, changes):
    rows = [(*r, n) for r, n in changes.items() for n in [1 if n > 0 else -1] * abs(n)]
    return spark.createDataFrame(rows, f"{SCHEMA}, {m.SIGN} int")


def model(spark, s):
    got = {}
    for r in m.read_model(spark, s).collect():
        assert r.who not in got
        got[r.who] = (r.n, r.kinds, r.cost, pytest.approx(r["mean"]) if r["mean"] is not None else None, r["first"], r["last"])
    return got


def random_batches(seed, batches=4):
    import datetime as dt

    rng, held, out = random.Random(seed), Counter(), []
    for n in range(batches):
        change = Counter()
        for _ in range(30):
            change[(rng.choice(["a", "a", "b", "c", None]), rng.choice([None, 1, 2, 3]), rng.choice([None, Decimal("1.10"), Decimal("-2.25")]),
                    rng.choice([None, dt.date(2024, 1, rng.randint(1, 9))]))] += 1
        for r in rng.sample(sorted(held.elements(), key=str), min(25, held.total()) if n else 0):
            change[r] -= 1
        if n == batches - 1:        # a group that goes altogether
            for r in [r for r in held if r[0] == "c"]:
                change[r] = -held[r]
            change = Counter({r: k for r, k in change.items() if r[0] != "c" or k < 0})
        held.update(change)
        held = +held
        out.append((+change) - Counter() if n == 0 else Counter({r: k for r, k in change.items() if k}))
    return out


@pytest.mark.parametrize("fold", [None, 1, 2])
def test_model_equals_recompute_after_each_batch_and_repeats_change_nothing(spark, fold):
    s, held = spec(spark), Counter()
    for n, change in enumerate(random_batches(fold or 9)):
        m.apply_changes(spark, s, n, {"events": signed(spark, change)})
        held.update(change)
        assert all(k >= 0 for k in held.values())
        assert model(spark, s) == recompute(+held)
        m.apply_changes(spark, s, n, {"events": signed(spark, change)})
        assert model(spark, s) == recompute(+held)
        if n == fold:
            m.fold_state(spark, s)
            m.fold_state(spark, s)
            m.apply_changes(spark, s, n, {"events": signed(spark, change)})
            m.apply_changes(spark, s, 0, {"events": signed(spark, Counter({("z", 1, None, None): 5}))})
            assert model(spark, s) == recompute(+held)
    assert "c" not in model(spark, s)


def test_batches_in_any_order_give_the_same_model(spark):
    s, change = spec(spark), random_batches(4, 3)
    for n in (1, 0, 2):
        # a deletion before its insertion leaves a negative count that the next batch mends
        if n == 1:
            change_now = Counter({r: k for r, k in change[1].items() if k > 0})
            rest = change[1] - change_now if False else Counter({r: k for r, k in change[1].items() if k < 0})
            m.apply_changes(spark, s, 1, {"events": signed(spark, change_now)})
        else:
            m.apply_changes(spark, s, n, {"events": signed(spark, change[n])})
    m.apply_changes(spark, s, 3, {"events": signed(spark, rest)})
    held = Counter()
    for c in change:
        held.update(c)
    assert model(spark, s) == recompute(+held)


def test_a_batch_reads_the_state_of_its_buckets_only(spark):
    s = spec(spark, buckets=8)
    m.apply_changes(spark, s, 0, {"events": signed(spark, Counter({(f"g{i}", i, None, None): 1 for i in range(60)}))})
    before = {f: None for f in spark.table(s.table).inputFiles()}
    touched = m.apply_changes(spark, s, 1, {"events": signed(spark, Counter({("g7", 99, None, None): 1}))})
    assert len(touched) == 1
    rewritten = [f for f in before if f not in set(spark.table(s.table).inputFiles())]
    assert rewritten and all(f"{m.BUCKET}={touched[0]}/" in f for f in rewritten)
    plan = m._state(spark, s.values, touched)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [(_bucket" in plan


def test_removing_what_is_not_there_fails(spark):
    s = spec(spark)
    m.apply_changes(spark, s, 0, {"events": signed(spark, Counter({("a", 1, None, None): 2}))})
    with pytest.raises(Exception, match="removed more often than added"):
        m.apply_changes(spark, s, 1, {"events": signed(spark, Counter({("a", 2, None, None): -1}))})


def test_floating_point_sums_are_refused(spark):
    s = m.Maintained(f"{scratch_db(spark, 'mt')}.x", ("k",), (m.Measure("s", "sum", "v"),), inputs={"events": ("k",)})
    with pytest.raises(ValueError, match="decimal"):
        m.apply_changes(spark, s, 0, {"events": spark.createDataFrame([(1, 1.5, 1)], f"k int, v double, {m.SIGN} int")})
    with pytest.raises(ValueError, match="no columns"):
        m.apply_changes(spark, s, 0, {"events": spark.createDataFrame([(1, 1)], f"k int, {m.SIGN} int")})


def test_signed_changes_replace_insert_delete_and_cancel(spark):
    held = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k int, v string")
    batch = spark.createDataFrame([(1, "a", None), (2, "B", False), (3, None, True), (4, "d", None), (5, None, True), (None, "m", None)],
                                  "k int, v string, gone boolean")
    got = Counter(tuple(r) for r in m.signed_changes(held, batch, "k", deleted="gone").collect())
    assert got == Counter([(2, "b", -1), (2, "B", 1), (3, "c", -1), (4, "d", 1), (None, "m", 1)])


def test_base_input_says_which_groups_there_are(spark):
    s = m.Maintained(f"{scratch_db(spark, 'mt')}.people", ("id",), (
        m.Measure("name", "attribute", "name", "people"), m.Measure("visits", "count", "visit", "visits")),
        inputs={"people": ("id",), "visits": ("person",)}, base="people", buckets=2)
    people = lambda rows: spark.createDataFrame(rows, f"id int, name string, {m.SIGN} int")
    visits = lambda rows: spark.createDataFrame(rows, f"person int, visit int, {m.SIGN} int")
    m.apply_changes(spark, s, 0, {"people": people([(1, "x", 1), (2, None, 1)]), "visits": visits([(1, 10, 1), (3, 11, 1), (None, 12, 1)])})
    assert sorted(map(tuple, m.read_model(spark, s).collect())) == [(1, "x", 1), (2, None, None)]
    m.apply_changes(spark, s, 1, {"people": people([(1, "x", -1), (1, "y", 1), (3, "z", 1)])})
    m.apply_changes(spark, s, 2, {"visits": visits([(1, 10, -1), (2, 13, 1)])})
    assert sorted(map(tuple, m.read_model(spark, s).collect())) == [(1, "y", None), (2, None, 1), (3, "z", 1)]


def test_unscoped_upsert_keeps_partitioned_tables_whole(spark):
    from layerkit.plans.merge import upsert

    table = f"{scratch_db(spark, 'mt')}.t"
    rows = spark.createDataFrame([(1, "a b/c", 1), (2, None, 1), (3, "z=%", 1)], "k long, p string, v int")
    for v in (1, 2, 3):
        upsert(rows.filter("k = 1 or v > 0").withColumn("v", F.lit(v)).filter(f"{v} = 1 or k = 1"), table, "k", "v", partition_by=["p"])
        assert sorted((r.k, r.p, r.v) for r in spark.table(table).collect()) == [(1, "a b/c", v), (2, None, 1), (3, "z=%", 1)]
