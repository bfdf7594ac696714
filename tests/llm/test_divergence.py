"""Source divergence against a brute-force version, and the transducers by themselves."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from layerkit.llm.transducer_vocabulary import Transducer, divergence_audit, kept_terms, shares, term_ordinals, vocabulary

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs, top):
    docs = [(lang or "", source or "", [t.translate(UPPER) for t in TERM.findall(text or "")]) for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        seen = Counter(t for d in docs if d[0] == lang for t in set(d[2]))
        kept = sorted((t for t, n in seen.items() if n >= min_docs), key=str.encode)
        count = defaultdict(Counter)
        for one, source, terms in docs:
            if one == lang:
                count[source].update(t for t in terms if t in set(kept))
        whole = Counter()
        for c in count.values():
            whole.update(c)

        def share(c):
            return {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        for s in count:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in count if o != s))
            out += [(lang, s, "pair", o, -f, i) for i, (f, _, o) in enumerate(pairs, 1)]
            terms = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if count[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "term", t, -f, i) for i, (f, _, t) in enumerate(terms, 1)]
    return sorted(out)


def corpus():
    rng = random.Random(5)
    words = ["a", "B", "ab", "abc", "Abé", "été", "ÉTÉ", "zz", "z", "日本", "日", "x9y", "don't"]
    rows = [(i, " ".join(rng.choices(words, weights=range(1, 14) if i % 3 else range(13, 0, -1), k=rng.randrange(25))),
             rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", None, "S1"])) for i in range(120)]
    return rows + [(7, None, "en", "s1"), (None, "a\x00b\tab", "en", "s4"), (None, "", "lonely", "only"), (9, "", "de", "s1"), (9, "q", "de", "s2"),
                   (1000, "Long" * 40_000 + " ab", "en", "s2"), (1001, "lonG" * 40_000, "en", "s3")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("options", [{}, {"shard_terms": 3, "round_bytes": 1}])
def test_audit_equals_brute_force(spark, options):
    rows = corpus()
    got = divergence_audit(frame(spark, rows), min_docs=2, top_terms=4, **options)
    assert [f.dataType.simpleString() for f in got.schema] == ["string"] * 4 + ["bigint", "int"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 2, 4)


def test_repeated_rows_count_each_time_and_clashing_columns_are_ignored(spark):
    rows = corpus() * 2
    df = frame(spark, rows)
    for name in ("term", "ordinal", "n", "part", "item", "value", "rank", "block", "whole", "v", "used", "base"):
        df = df.withColumn(name, df["doc_id"])
    got = divergence_audit(df, min_docs=4, top_terms=50)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 4, 50)


def test_no_documents_and_no_kept_terms(spark):
    assert divergence_audit(frame(spark, [])).collect() == []
    got = divergence_audit(frame(spark, [(1, "a", "en", "x"), (2, None, "en", "y"), (3, "b", "fr", "x")])).collect()
    assert sorted(tuple(r) for r in got) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]


def test_transducer_is_minimal_and_gives_ordinals():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(1, 7))).encode() for _ in range(2000)} | {b"a" * 3000})
    t = Transducer.from_bytes(Transducer.build(words).to_bytes())
    assert list(t.terms()) == words
    probe = words + [b"zz", b"abab" * 9, b"a" * 2999, b"\xc3"]
    size = np.array([len(w) for w in probe])
    got = t.ordinals(np.frombuffer(b"".join(probe), np.uint8), np.cumsum(size) - size, size)
    assert got.tolist() == [words.index(w) if w in words else -1 for w in probe]
    # minimal: no two states but the root accept the same endings
    ends, first = {}, t.first.tolist()
    for s in range(len(t.final) - 1):
        key = (bool(t.final[s]), tuple((int(t.labels[e]), int(t.targets[e])) for e in range(first[s], first[s + 1])))
        assert ends.setdefault(key, s) == s


def test_ordinals_of_all_shards_follow_the_terms(spark):
    docs = frame(spark, corpus())
    terms = kept_terms(docs.na.fill("").select("lang", "text"), 1)
    shards = vocabulary(terms, shard_terms=4)
    assert shards.count() > 3
    got = defaultdict(dict)
    for r in term_ordinals(shards).collect():
        got[r.lang][r.ordinal] = r.term
    want = defaultdict(list)
    for r in terms.collect():
        want[r.lang].append(r.term)
    assert {k: [v[i] for i in range(len(v))] for k, v in got.items()} == {k: sorted(v, key=str.encode) for k, v in want.items()}


def test_shares_are_exact_beyond_64_bit_products():
    count, whole = np.array([0, 10**12, 7 * 10**14]), np.array([10**15, 3 * 10**15, 7 * 10**14 + 5])
    assert shares(count, whole).tolist() == [1 + 10**9 * (int(c) + 5) // int(w) for c, w in zip(count, whole)]
