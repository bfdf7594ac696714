"""Hypergeometric sharding: exact sizes, gapless slots, the law of the matrix."""

import random
from collections import Counter
from math import comb

import pytest

from layerkit.llm import hypergeometric_shards as h


def test_draw_follows_the_hypergeometric_law():
    rng, good, bad, draws, n = random.Random(4), 7, 12, 8, 40_000
    seen = Counter(h.draw_hypergeometric(rng, good, bad, draws) for _ in range(n))
    for x in range(0, 8):
        p = comb(good, x) * comb(bad, draws - x) / comb(good + bad, draws)
        assert abs(seen[x] / n - p) < 0.01


@pytest.mark.parametrize("good,bad,draws", [(0, 5, 3), (5, 0, 3), (4, 4, 8), (4, 4, 0), (10**12, 10**13, 10**9)])
def test_draw_bounds(good, bad, draws):
    x = h.draw_hypergeometric(random.Random(1), good, bad, draws)
    assert max(0, draws - bad) <= x <= min(good, draws)
    if draws == 10**9:
        assert abs(x - draws * good / (good + bad)) < 10 * draws**0.5


def test_matrix_has_both_margins():
    counts = {b: (b * 37) % 11 for b in range(50)}
    sizes = h.shard_sizes(sum(counts.values()), 7)
    cells = h.communication_matrix(counts, sizes, 3)
    rows, cols = Counter(), Counter()
    for b, s, lo, hi in cells:
        assert hi > lo
        rows[b] += hi - lo
        cols[s] += hi - lo
    assert rows == Counter(counts) and [cols[s] for s in range(7)] == sizes and max(sizes) - min(sizes) <= 1


def dealt(df, shards, **kw):
    return [(r.shard, r.slot) + tuple(r[c] for c in df.columns if c not in ("shard", "slot"))
            for r in h.shuffle_into_shards(df, shards, **kw).collect()]


def check(rows, n, shards):
    assert len(rows) == n
    slots = {}
    for r in rows:
        slots.setdefault(r[0], []).append(r[1])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_sizes_slots_and_repeatability(spark):
    df = spark.range(1003).selectExpr("id AS doc_id", "concat('t', id % 7) AS text").repartition(5)
    rows = dealt(df, 24)
    check(rows, 1003, 24)
    assert sorted(r[2] for r in rows) == list(range(1003))
    assert sorted(rows) == sorted(dealt(df.repartition(2), 24))        # independent of how rows lie
    assert sorted(rows) != sorted(dealt(df, 24, seed=5))


def test_assignment_is_near_uniform(spark):
    df = spark.range(6000).toDF("doc_id")
    seen = Counter((r[2] // 1000, r[0]) for r in dealt(df, 6))
    assert all(abs(seen[k] - 1000 / 6) < 60 for k in [(a, b) for a in range(6) for b in range(6)])
    early = sum(r[1] < 500 for r in dealt(df, 6) if r[2] < 3000)
    assert 1350 < early < 1650


def test_nulls_repeats_small_and_clashing(spark):
    df = spark.createDataFrame([(None, None, 9), (1, "a", 9), (1, "a", 9), (2, None, 9)], "doc_id long, text string, shard int")
    rows = dealt(df, 24)
    check(rows, 4, 24)
    assert Counter(r[2:] for r in rows) == Counter([(None, None), (1, "a"), (1, "a"), (2, None)])
    assert dealt(spark.createDataFrame([], "doc_id long, text string"), 3) == []
    hot = spark.range(900).selectExpr("if(id % 3 = 0, 0, id) AS doc_id", "id AS row")
    check(dealt(hot, 4), 900, 4)
