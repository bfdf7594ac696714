"""Ordinal regression: features, gradients by differences, held-out accuracy."""

import numpy as np
from pyspark.sql import functions as F

from layerkit.llm import ordinal_quality as q


def test_features_are_whole_text_and_chunk_free(monkeypatch):
    text = ("Straße of words, gone TWICE twice. " * 400) + "end " + "x" * 9000
    whole = q.text_features(text, 18)
    assert (np.diff(whole) > 0).all() and set(q.text_features("end", 18)) <= set(whole)
    monkeypatch.setattr(q, "CHUNK", 4096)
    cut = q.text_features(text, 18)
    assert len(np.setxor1d(whole, cut)) <= 12                     # trigrams across a cut only
    assert len(q.text_features(None, 18)) == len(q.text_features("", 18)) == 0
    assert len(q.text_features(" ", 18)) == 0 and len(q.text_features("\n\n\n", 18)) == 1


def test_words_differ_by_their_letters_only():
    one, two = set(q.text_features("ab", 18)), set(q.text_features("AB", 18))
    assert one == two and one != set(q.text_features("ba", 18))


def log_likelihood(model, slots, grades):
    total = 0.0
    for s, g in zip(slots, grades):
        x = model.idf[s]
        score = (x * model.weights[s]).sum() / np.sqrt((x * x).sum())
        cut = np.concatenate([[-np.inf], model.thresholds, [np.inf]])
        cdf = 1 / (1 + np.exp(-(cut - score)))
        total += np.log(cdf[g + 1] - cdf[g])
    return total / len(grades)


def test_fit_is_a_maximum_and_thresholds_are_ordered():
    rng = np.random.default_rng(0)
    slots, grades = [], []
    for _ in range(400):
        s = np.sort(rng.choice(24, 8, replace=False))
        score = 1.2 * np.isin(s, range(0, 6)).sum() - 1.2 * np.isin(s, range(6, 12)).sum() + rng.logistic()
        slots.append(s.astype(np.int32))
        grades.append(int(score > -1) + int(score > 1.5) + int(score > 3))
    grades = np.array(grades)
    m = q.fit_ordinal(slots, grades, bits=5, steps=800, rate=0.1, penalty=0.0, min_texts=1)
    assert (np.diff(m.thresholds) > 0).all() and m.weights[:6].min() > m.weights[6:12].max()
    best = log_likelihood(m, slots, grades)
    for i in range(24):
        for step in (-0.2, 0.2):
            w = m.weights.copy()
            w[i] += step
            assert log_likelihood(q.OrdinalModel(5, m.idf, w, m.thresholds), slots, grades) < best + 1e-4
    for i in range(3):
        for step in (-0.1, 0.1):
            t = m.thresholds.copy()
            t[i] += step
            assert log_likelihood(q.OrdinalModel(5, m.idf, m.weights, t), slots, grades) < best + 1e-4
    tails = m.tails(np.linspace(-3, 3, 9))
    assert (np.diff(tails, axis=1) <= 0).all() and (np.diff(tails, axis=0) > 0).all()


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{base}/labels.parquet").withColumn("grade", F.col("quality") + 1 - F.col("toxic"))
    held = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(4)) == 0
    model = q.train(docs, labels.filter(~held), max_rows=4000)
    rated = q.score_documents(docs.join(labels.filter(held), "doc_id"), model).withColumn("kept", F.col("top_probability") >= 0.5)
    share = {(r.quality, r.toxic): (r["n"], r["kept"]) for r in rated.groupBy("quality", "toxic").agg(
        F.count("*").alias("n"), F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1, 0][1] >= 0.96 and share[0, 0][1] <= 0.2 and share[1, 1][1] <= 0.5
    assert rated.filter("expected_grade NOT BETWEEN 0 AND 2").count() == 0


def test_sample_is_bounded_and_independent_of_layout(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('good fine text ', id % 9, if(id % 3 = 0, ' awful junk', '')) AS text")
    ratings = spark.range(-20, 300).selectExpr("id AS doc_id", "cast(if(id % 3 = 0, 0, 1) AS int) AS grade")
    ratings = ratings.union(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, grade int"))
    a = q.train(docs, ratings, max_rows=100, steps=20)
    b = q.train(docs.repartition(7), ratings.repartition(3), max_rows=100, steps=20)
    assert (a.weights == b.weights).all() and (a.thresholds == b.thresholds).all()
    out = q.score_documents(docs, a)
    wrong = out.filter((F.col("top_probability") >= 0.5) != (F.col("doc_id") % 3 != 0)).count()
    assert out.count() == 300 and wrong == 0


def test_nulls_empty_tables_one_grade_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, 7.0), (2, "", 7.0), (None, "a b", 7.0), (2, "", 7.0)],
                                 "doc_id long, text string, expected_grade double")
    none = spark.createDataFrame([], "doc_id long, grade int")
    model = q.train(docs, none)
    got = [tuple(r) for r in q.score_documents(docs, model).collect()]
    assert sorted(got, key=str) == sorted([(i, t, 0.0, 0.0) for i, t in ((1, None), (2, ""), (None, "a b"), (2, ""))], key=str)
    two = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, grade int")
    rated = q.score_documents(docs, q.train(docs, two, steps=5)).collect()
    assert all(0 <= r.top_probability <= 1 for r in rated)
    assert q.score_documents(docs.limit(0), model).count() == 0
