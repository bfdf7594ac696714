"""Iterative proportional fitting against plain Python, and the sampling."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from layerkit.llm import mixing_ipf as m

LEX = {"sea": "ship|wave", "land": "hill"}


def slow_rake(cells, targets, sweeps):
    total = sum(cells.values())
    weight = {k: v / total for k, v in cells.items()}
    for _ in range(sweeps):
        for i, margin in enumerate(m.MARGINS):
            values = {k[i] for k in cells}
            want = {v: 1.0 if targets.get(margin) is None else targets[margin].get(v, 0.0) for v in values}
            scale = sum(want.values())
            held = defaultdict(float)
            for k, w in weight.items():
                held[k[i]] += w
            weight = {k: w * want[k[i]] / scale / held[k[i]] if held[k[i]] else 0.0 for k, w in weight.items()}
    return weight


def test_rake_matches_python_and_meets_the_margins(spark):
    cells = {(s, g, t): 1.0 + (7 * i) % 23 for i, (s, g, t) in enumerate(
        (s, g, t) for s in ("a", "b", None) for g in ("en", "de") for t in ("sea", "land", "other"))}
    targets = {"source": None, "lang": {"en": 3.0, "de": 1.0, "xx": 9.0}, "topic": {"sea": 0.5, "land": 0.3, "other": 0.2}}
    df = spark.createDataFrame([(*k, v) for k, v in cells.items()], "source string, lang string, topic string, tokens double")
    got = {(r.source, r.lang, r.topic): r.weight for r in m.rake(df, targets).collect()}
    assert got == pytest.approx(slow_rake(cells, targets, 30), abs=1e-9)
    assert sum(w for k, w in got.items() if k[1] == "en") == pytest.approx(0.75)
    assert sum(w for k, w in got.items() if k[0] is None) == pytest.approx(1 / 3)
    few = {(r.source, r.lang, r.topic): r.weight for r in m.rake(df, targets, sweeps=2).collect()}
    assert few == pytest.approx(slow_rake(cells, targets, 2), abs=1e-12)


def test_values_without_target_get_nothing(spark):
    df = spark.createDataFrame([("a", "en", "x", 5.0), ("a", "fr", "x", 5.0)], "source string, lang string, topic string, tokens double")
    got = {r.lang: r.weight for r in m.rake(df, {"lang": {"en": 1.0}}).collect()}
    assert got == {"en": pytest.approx(1.0), "fr": 0.0}


def test_topics_and_tokens(spark):
    df = spark.createDataFrame([("ship hill",), ("hill hill ship",), ("wave ship hill",), ("none",), ("",), (None,)], "text string")
    got = [tuple(r) for r in df.select(m.lexicon_topic(F.col("text"), LEX), m.token_count(F.col("text"))).collect()]
    assert got == [("sea", 2), ("land", 3), ("sea", 3), ("other", 1), ("other", 1), ("other", 1)]


def test_sampled_tokens_follow_the_targets(spark):
    df = spark.range(30_000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', concat('s', id % 5)) AS source",
                                        "if(id % 4 = 0, 'de', 'en') AS lang", "if(id % 2 = 0, 'ship a b', 'hill a b c') AS text", "1 AS tokens")
    targets = {"source": None, "lang": {"en": 0.7, "de": 0.3}, "topic": {"sea": 0.4, "land": 0.6}}
    out = m.mix_documents(df, targets, LEX, size=0.5).cache()
    total = out.agg(F.sum("tokens")).first()[0]
    used = out.agg(F.sum(F.col("tokens") * F.col("copies"))).first()[0]
    assert used == pytest.approx(0.5 * total, rel=0.03)
    for margin, want in (("lang", {"en": 0.7, "de": 0.3}), ("topic", {"sea": 0.4, "land": 0.6}), ("source", {s: 1 / 6 for s in "s0 s1 s2 s3 s4 hot".split()})):
        share = {r[0]: r[1] / used for r in out.groupBy(margin).agg(F.sum(F.col("tokens") * F.col("copies"))).collect()}
        assert share == {k: pytest.approx(v, abs=0.02) for k, v in want.items()}
    assert out.filter("copies NOT IN (floor(epochs), floor(epochs) + 1)").count() == 0
    again = m.mix_documents(df.repartition(7), targets, LEX, size=0.5)
    assert again.select("doc_id", "copies").exceptAll(out.select("doc_id", "copies")).count() == 0


def test_nulls_repeats_and_empty(spark):
    schema = "doc_id long, text string, source string, lang string"
    df = spark.createDataFrame([(None, None, None, None), (1, "ship", "a", None), (1, "ship", "a", None)], schema)
    out = m.mix_documents(df, {}, LEX, size=1.0).collect()
    assert len(out) == 3 and all(r.epochs is not None and r.copies is not None for r in out)
    assert m.mix_documents(spark.createDataFrame([], schema), {}, LEX).count() == 0


def test_mix_repeats_rows_by_their_copies(spark):
    rows = [(i if i % 9 else None, "hill a b c", "a", "en", str(i)) for i in range(200)] + [(500, "ship", "a", "en", "x"), (500, "hill", "a", None, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, topic string")
    args = dict(targets={"topic": {"sea": 0.4, "land": 0.6}}, lexicons=LEX, size=0.5)
    want = defaultdict(int)
    for r in m.mix_documents(df, **args).collect():
        want[r.doc_id, r.lang, r.tokens] += r.copies
    out = m.repeat_documents(df, **args)
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id, r.lang, r.text.count(" ") + 1] += 1
    assert out.schema == df.schema and got == {k: n for k, n in want.items() if n}
    assert got[500, "en", 1] > 100 and sum(n * k[2] for k, n in got.items()) == pytest.approx(0.5 * 802, rel=0.15)


def test_rest_keeps_its_own_share(spark):
    cells = [("a", "en", "x", 5.0), ("a", "de", "x", 1.0), ("a", "it", "x", 3.0), ("a", None, "x", 1.0)]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, tokens double")
    got = {r.lang: r.weight for r in m.rake(df, {"lang": {"en": 1.0, "de": 3.0, m.REST: m.OWN_SHARE}}).collect()}
    assert got == {"en": pytest.approx(0.15), "de": pytest.approx(0.45), "it": pytest.approx(0.3), None: pytest.approx(0.1)}
