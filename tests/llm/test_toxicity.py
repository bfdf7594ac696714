"""The gated network: gradients, windows, held-out accuracy and edge cases."""

import random
from zlib import crc32

import numpy as np
import pytest
from conftest import SF_CHECK

from layerkit.llm import gated_toxicity as g
from layerkit.llm.common import read_table


def small_model(seed=0, kind=np.float32):
    model = g.new_model(np.random.default_rng(seed))
    model.parts = {k: v.astype(kind) for k, v in model.parts.items()}
    model.parts["word_used"][:] = 1
    model.parts["gram_used"][:] = 1
    return model


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    model = small_model(kind=np.float64)
    words, ids = [b"abc", b"de", b"fghij", b"k"], rng.integers(0, 4, (3, 5))
    mask, wanted, weight = np.ones((3, 5)), np.array([1.0, 0, 1]), np.array([1.0, 0.5, 1])
    mask[0, 3:] = 0
    _, found = g.gradients(model, words, ids, mask, wanted, weight)
    for name in ("inner", "inner_bias", "look", "look_bias", "weigh", "out", "out_bias", "project", "bias", "word", "gram"):
        a = model.parts[name]
        where = (int(found[name][0][0]), 1) if isinstance(found[name], tuple) else tuple(int(rng.integers(n)) for n in a.shape)
        value = found[name][1][0][1] if isinstance(found[name], tuple) else found[name][where]
        held, losses = a[where], []
        for step in (1e-3, -1e-3):
            a[where] = held + step
            losses.append(g.gradients(model, words, ids, mask, wanted, weight)[0])
        a[where] = held
        assert value == pytest.approx((losses[0] - losses[1]) / 2e-3, abs=2e-6), name


def test_windows_cover_every_word_and_overlap():
    for n in (0, 1, 63, 64, 65, 111, 112, 113, 1000):
        starts = g.window_starts(n)
        covered = {i for s in starts for i in range(s, min(n, s + g.WINDOW))}
        assert covered == set(range(n))
        assert all(b - a <= g.STRIDE for a, b in zip(starts, starts[1:])) and len(set(starts)) == len(starts)


def test_logit_is_that_of_the_worst_window_however_texts_are_run(monkeypatch):
    model, rng = small_model(3), random.Random(1)
    words = [f"w{i}".encode() for i in range(60)]
    texts = [b" ".join(rng.choices(words, k=k)) for k in (0, 1, 5, 64, 65, 300, 2000, 7, 0, 130)]
    want = []
    for t in texts:
        w = t.split()
        logits = [float(model.logits(model.projected(w[s:s + g.WINDOW]), np.arange(len(w[s:s + g.WINDOW]))[None])[0]) for s in g.window_starts(len(w))]
        want.append(max(logits) if logits else float(model.parts["out_bias"][0]))
    assert list(g.text_logits(model, iter(texts))) == pytest.approx(want, abs=1e-4)
    monkeypatch.setattr(g, "RUN_WINDOWS", 3)
    monkeypatch.setattr(g, "HELD_WORDS", 10)
    assert list(g.text_logits(model, iter(texts))) == pytest.approx(want, abs=1e-4)


def fixture(n=1200):
    rng = random.Random(7)
    clean, bad = [f"word{i}" for i in range(300)], ["zorgly", "mubbish", "krud"]
    rows, labels = [], []
    for i in range(n):
        words, toxic = rng.choices(clean, k=rng.choice([10, 60, 250])), i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):  # some with an ending that no other text has
                words.insert(rng.randrange(len(words)), rng.choice(bad) + (f"en{i}" if i % 8 == 0 else ""))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_texts_are_told_apart(spark):
    rows, labels = fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", g.F.lit(1)).withColumn("toxic", g.F.lit(0))
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in g.score_documents(docs, g.train(docs, marks)).collect()}
    assert len(got) == len(rows)
    assert all(r.held_out == (crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for i, r in got.items())
    held = [(y, got[i].predicted) for i, y in labels if got[i].held_out]
    assert sum(y == p for y, p in held) >= 0.95 * len(held)
    assert sum(p for y, p in held if y) >= 0.9 * sum(y for y, _ in held)


def test_held_out_labels_are_not_learnt_from(spark):
    rows, labels = fixture(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    turned = [(i, 1 - y if crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    models = [g.train(docs, spark.createDataFrame(x, "doc_id long, toxic int"), max_toxic=40, max_clean=60, epochs=1) for x in (labels, turned)]
    assert all(np.array_equal(models[0].parts[k], models[1].parts[k]) for k in models[0].parts)


def test_edge_cases(spark):
    rows, labels = fixture(200)
    odd = [(None, "zorgly"), (900, None), (901, ""), (902, "\t!! 。"), (903, "x" * 300_000), (904, "zorgly " * 200_000), (5, "twice"), (5, "twice")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1), (7, None), (900, 0), (12345, 1), (5, 1)], "doc_id long, toxic int")
    got = g.score_documents(docs, g.train(docs, marks, max_toxic=40, max_clean=60, epochs=1)).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[900].score == by[901].score and not next(r for r in got if r.doc_id is None).held_out
    assert g.score_documents(docs.limit(0), g.train(docs.limit(0), marks)).collect() == []
    # nothing toxic to learn from: every text gets the share
    assert {r.score for r in g.score_documents(docs, g.train(docs, marks.filter("toxic = 0"))).collect()} == {0.0}


def test_query_tells_held_out_documents_of_the_tables_apart(spark):
    from layerkit.llm.audit_queries import toxicity

    got = toxicity(spark, SF_CHECK)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "boolean", "double", "int"]
    toxic = {r.doc_id: r.toxic for r in read_table(spark, SF_CHECK, "labels").collect()}
    rows = got.collect()
    assert len(rows) == read_table(spark, SF_CHECK, "documents").count()
    held = [(r.score, toxic[r.doc_id]) for r in rows if r.held_out and r.doc_id in toxic]
    pairs = [(a > b) + 0.5 * (a == b) for a, y in held for b, z in held if y and not z]
    assert sum(pairs) / len(pairs) >= 0.8  # area under the curve; some 260 documents to learn from
