"""SimHash near-dedup against all pairs."""

import random
import re

import pytest
import xxhash

from layerkit.llm import simhash_pivots as s
from layerkit.llm.components import connected_components


def slow_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, close):
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    values = sorted(values)
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if close(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "Two WORDS", "a b c", "ÀB é x ß", "x " * 700])
def test_fingerprint(text):
    assert s.fingerprint(text, 3) == slow_fingerprint(text)


def test_chunks_do_not_matter(monkeypatch):
    text = " ".join(random.Random(5).choices("alpha beta gamma delta epsilon zeta".split(), k=1000))
    whole = s.fingerprint(text, 3)
    monkeypatch.setattr(s, "CHUNK", 97)
    assert s.fingerprint(text, 3) == whole == slow_fingerprint(text)


def test_components_match_all_pairs(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    rnd = random.Random(2)
    for i, (_, text) in enumerate(rows[:40]):        # near copies
        words = (text or "").split(" ")
        words[rnd.randrange(len(words))] = "changed"
        rows.append((10_000 + i, " ".join(words)))
    rows += [(20_000, None), (20_001, ""), (20_002, " "), (20_003, "two words"), (20_003, "two words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    fps = [(i, slow_fingerprint(t)) for i, t in rows]
    root = roots({f for _, f in fps}, lambda a, b: (a ^ b).bit_count() <= 2)
    first = {}
    for i, f in fps:
        first[root[f]] = min(first.get(root[f], i), i)
    want = sorted((i, f, first[root[f]]) for i, f in fps)
    for limit in (64, 1):
        got = sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in s.near_duplicates(df, bucket_limit=limit).collect())
        assert got == want


@pytest.mark.parametrize("max_bits", [0, 1, 2])
def test_links_on_dense_clusters(spark, max_bits):
    rnd = random.Random(1)
    values = set()
    for _ in range(12):
        base = rnd.getrandbits(64)
        for _ in range(50):
            x = base
            for _ in range(rnd.randrange(5)):
                x ^= 1 << rnd.randrange(64)
            values.add(s._signed(x))
    want = roots(values, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= max_bits)
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    for limit in (1, 64):
        links = s.fingerprint_links(df, max_bits, limit)
        got = {r.node: r.root for r in connected_components(links, "a", "b").collect()}
        assert {v: got.get(v, v) for v in values} == want


def test_long_chain_is_one_component(spark):
    links = spark.range(300).selectExpr("id AS a", "id + 1 AS b").repartition(4)
    got = connected_components(links, "a", "b").collect()
    assert len(got) == 301 and {r.root for r in got} == {0}


def test_empty_and_null_ids(spark):
    assert s.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (None, "x y z")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in s.near_duplicates(df.selectExpr("*", "1 AS fp", "2 AS root")).collect()), key=str)
    assert got == [(5, 5), (None, 5), (None, None)]
