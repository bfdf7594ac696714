"""Packing: the plan, and an exact round trip of all token ids."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from layerkit.llm import cutting_stock as c
from layerkit.llm.queries import pack_documents

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def used(plan):
    out = Counter()
    for pattern, n in plan:
        for k, m in pattern.items():
            out[k] += m * n
    return out


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=20))
def test_plan_uses_every_piece_once(demand):
    plan = c.packing_plan(demand, 64)
    assert used(plan) == Counter(demand)
    assert all(sum(k * m for k, m in p.items()) <= 64 and n > 0 for p, n in plan)


def test_plan_is_near_the_bound():
    rng = np.random.default_rng(0)
    for capacity, sizes in ((1024, [64 * i for i in range(1, 16)] + list(range(1, 64))), (100, [31, 37, 45, 14, 9])):
        demand = {s: int(rng.integers(1, 900)) for s in sizes}
        bound = sum(k * n for k, n in demand.items()) / capacity
        lp = sum(x for _, x in c.relaxed_plan(demand, capacity))
        assert lp >= bound - 1e-6
        assert sum(n for _, n in c.packing_plan(demand, capacity)) <= 1.005 * lp + 3


def test_relaxed_plan_reaches_the_optimum():
    # three lengths of which two fit, one way each: 60+40, 50+50, and 60 alone where 40s run out
    lp = sum(x for _, x in c.relaxed_plan({60: 10, 40: 4, 50: 7}, 100, gap=0.0))
    assert lp == pytest.approx(10 + 3.5)


def test_knapsack_matches_enumeration():
    lengths, prices = np.array([3, 5, 7]), np.array([0.3, 0.56, 0.75])
    best, last = c._knapsack(prices, lengths, 23)
    for room in range(24):
        top = max(0.3 * a + 0.56 * b + 0.75 * d for a in range(8) for b in range(5) for d in range(4) if 3 * a + 5 * b + 7 * d <= room)
        assert best[room] == pytest.approx(top)
        items = c._filled(last, room)
        assert sum(k * n for k, n in items.items()) <= room
        assert sum(n * prices[list(lengths).index(k)] for k, n in items.items()) == pytest.approx(top)


def test_long_runs_of_white_space_are_encoded_alike():
    encoding = c._encoder(RANKS, PATTERN)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    runs = (" " * 9, "\n" * 9, " \n\t\u3000\x85 \xa0 \u2003\n", " " * 4, "\n" * 5 + " ", "\x1c" * 9)
    for run in runs:
        for text in (run, "a" + run, run + "b", f"it's{run}'s 12{run}. {run}x {run}"):
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert c.encode_text(encoding, text, long_run=4) == want == c.encode_text(encoding, text)
    for blank in (" ", "\n"):
        text = "a" + blank * 1_200_000 + "b"
        assert encoding.decode(c.encode_text(encoding, text)) == text


def test_every_id_lies_in_one_piece(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = [(10_000, None), (10_001, ""), (10_002, "x" * 3000), (10_003, "a <|endoftext|> b é \U0001f600"), (10_004, "word " * 40_000)]
    df = df.union(spark.createDataFrame(extra, df.schema)).repartition(5)
    pieces = c.token_pieces(df, RANKS, PATTERN)
    rows = c.pack_pieces(pieces.selectExpr("*", "1 AS offset")).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    whole, sequences = {}, {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(whole.setdefault(r.doc_id, b"")) // 4 and r.length == len(r.ids) // 4
        whole[r.doc_id] += r.ids
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc in df.collect():
        want = np.array(tokenizer.encode(doc.text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        assert whole[doc.doc_id] == want
        assert all(r.doc_tokens == len(want) // 4 for r in rows if r.doc_id == doc.doc_id)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= sum(r.length for r in rows) / 1024 + 3
    digests = {(r.doc_id, r.start): (r.ids_crc32, r.length) for r in pack_documents(df).collect()}
    assert digests == {(r.doc_id, r.start): (zlib.crc32(r.ids), r.length) for r in rows}


def test_whole_tails_hot_lengths_and_repeats(spark):
    df = spark.range(2000).selectExpr("if(id % 3 = 0, 0, id) AS doc_id", "if(id % 3 = 0, 500, 1 + id % 700) AS length", "id AS start")
    rows = c.pack_pieces(df, 1024).collect()
    assert len(rows) == 2000 and len({(r.sequence_id, r.offset) for r in rows}) == 2000
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024
    docs = spark.createDataFrame([(1, "one two " * 900), (1, "one two " * 900), (None, None)], "doc_id long, text string")
    tails = c.token_pieces(docs, RANKS, PATTERN, grain=1024).collect()
    assert sorted((r.start, r.length) for r in tails if r.doc_id == 1) == [(0, 1024)] * 2 + [(1024, 778)] * 2
    assert c.pack_pieces(c.token_pieces(docs, RANKS, PATTERN)).count() >= 5


def test_empty_and_impossible(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(docs).count() == 0
    with pytest.raises(ValueError, match="capacity"):
        c.pack_pieces(spark.createDataFrame([(1, 0, 9)], "doc_id long, start long, length long"), 8)
    with pytest.raises(ValueError, match="grain"):
        c.token_pieces(docs, RANKS, PATTERN, capacity=1000, grain=64)
