"""Multi-index search: recall against brute force, exact scores and ties, odd vectors."""

import numpy as np
import pytest

from layerkit.llm import multi_index as m


def brute(rows, queries, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    dim = max({len(v) for _, v in good}, key=lambda n: sum(len(v) == n for _, v in good))
    good = [(i, v) for i, v in good if len(v) == dim]
    out = {}
    for q, qv in good:
        if q in queries:
            scored = sorted({(-float((qv * v).sum() / np.sqrt((qv * qv).sum()) / np.sqrt((v * v).sum())), i) for i, v in good if i != q})
            out[q] = [(i, -s) for s, i in scored[:k]]
    return out


def test_walk_is_in_order_and_complete():
    rng = np.random.default_rng(1)
    a, b, sizes = rng.random(7), rng.random(5), rng.integers(0, 4, (7, 5))
    cells = m.walk_cells(a, b, sizes, 10**9)
    sums = [a[i] + b[j] for i, j in cells]
    assert sums == sorted(sums) and len(set(cells)) == len(cells) == (sizes > 0).sum()
    few = m.walk_cells(a, b, sizes, 6)
    assert few == cells[:len(few)] and sum(sizes[c] for c in few) >= 6 > sum(sizes[c] for c in few[:-1])


def search(vectors, queries, **kw):
    out = {}
    for r in sorted(m.nearest_neighbours(vectors, queries, **kw).collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_embeddings(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, {i for i, _ in rows if i % 50 == 0}, 5)
    got = search(df, df.filter("vec_id % 50 = 0"), k=5, centroids=64, reach=0.5)
    assert got.keys() == want.keys()
    exact = {q: dict(w) for q, w in brute(rows, set(want), 10**9).items()}
    hits = 0
    for q in want:
        assert len(got[q]) == 5
        assert all(s == pytest.approx(exact[q][i], abs=1e-12) for i, s in got[q])
        hits += len({i for i, _ in got[q]} & {i for i, _ in want[q]})
    assert hits / (5 * len(want)) >= 0.9


def test_full_reach_is_exact_with_ties_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(120)]
    rows += [(200 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)]                    # copies
    rows += [(300, None), (301, [0.0] * 4), (302, [1.0, None, 2.0, 3.0]), (303, [float("nan"), 1.0, 1.0, 1.0]),
             (304, [float("inf"), 1.0, 1.0, 1.0]), (305, []), (306, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0]), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    queries = {0, 5, 50, 100, 200, 250, 300, 301, 306}
    want = brute(rows, queries, 5)
    asked = df.filter(df.vec_id.isin(list(queries)))
    for kw in ({"centroids": 8, "block": 7}, {"centroids": 3}):
        got = search(df, asked, k=5, reach=1.0, **kw)
        assert got.keys() == want.keys()
        for q in want:
            assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
            assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-14)


def test_few_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], schema).selectExpr("*", "1 AS score")
    assert search(df, df.filter("vec_id = 0")) == {0: [(1, pytest.approx(2 ** -0.5))]}
    assert search(df.filter("vec_id = 0"), df.filter("vec_id = 0")) == {}
    none = spark.createDataFrame([], schema)
    assert search(none, none) == {} and search(df, none) == {}
