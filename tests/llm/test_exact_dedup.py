"""Golomb-coded exact dedup: the code itself, and classes against a dictionary."""

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from layerkit.llm import golomb_dedup as g


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**63 - 1), max_size=200), st.integers(0, 50))
def test_rice_code_round_trip(values, shift):
    v = np.array(sorted({x >> shift for x in values}), np.uint64)
    assert (g.rice_decode(g.rice_encode(v)) == v).all()


def test_rice_code_is_smaller_than_the_values():
    v = np.unique(np.random.default_rng(1).integers(0, 1 << 32, 100_000, dtype=np.uint64))
    assert len(g.rice_encode(v)) < 0.55 * 4 * len(v)          # 32-bit values over a gap of 2**15: about 17 bits


def brute(rows):
    classes = {}
    for i, t in rows:
        classes.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in classes[t or ""] if x is not None]
        keep = max(ids) if ids else None
        n = len(classes[t or ""])
        out.append((i, keep if n > 1 else i, n, i == keep or n == 1, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, **kw):
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in g.exact_duplicates(df, **kw).collect()), key=str)


def test_classes_match_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, f"text {rng.integers(0, 150)}") for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, " "), (1003, "é\u0000 \U0001f600" * 3), (1004, "é\u0000 \U0001f600" * 3),
             (1005, "w " * 200_000), (1006, "w " * 200_000), (None, "text 1"), (None, "only null ids"), (None, "only null ids"),
             (7, "again"), (7, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute(rows)
    for kw in ({}, {"owners": 1}, {"owners": 37, "block_rows": 16, "fingerprint_bits": 12, "filter_bits": 7}):
        assert found(df, **kw) == want      # short fingerprints make chance suspects, never wrong classes


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert found(df) == []
    df = spark.createDataFrame([(1, "a", 5, "x"), (2, "a", 6, "y")], "doc_id long, text string, keep_id int, sha string")
    assert [r[:4] for r in found(df)] == [(1, 2, 2, False), (2, 2, 2, True)]


def test_one_text_with_a_third_of_the_rows(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('t', id)) AS text").repartition(8)
    rows = found(df, block_rows=100)
    assert sum(r[3] for r in rows) == 2001
    assert {r[1:3] for r in rows if r[0] % 3 == 0} == {(2997, 1000)}
