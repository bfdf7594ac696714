"""Filter interaction against a brute-force version, and the radix trie by itself."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from layerkit.llm.filter_tries import RadixTrie, common_prefix, failing_filters, filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def masks(rows):
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    out = []
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        fails = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 bool(re.search("[#$%&*|]", t)), i is not None and i > least[t]]
        out.append((i, s or "", "".join(f for f, x in zip("ABCDE", fails) if x)))
    return out


def brute(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    out = Counter()
    marked = masks(rows)
    for part in {s for _, s, _ in marked}:
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                key = (part, "".join(order), step)
                for what in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"):
                    out[key + (what,)] += 0
                for i, s, fails in marked:
                    if s != part:
                        continue
                    gone, here = bool(set(fails) & set(order[:step - 1])), f in fails
                    out[key + ("kept",)] += not gone and not here
                    out[key + ("removed",)] += here and not gone
                    out[key + ("redundant",)] += here and gone
                    out[key + ("unique_fails",)] += fails == f
                    out[key + ("good_lost",)] += here and not gone and i is not None and i in good
                    out[key + ("toxic_lost",)] += here and not gone and i is not None and i in toxic
                    out[(part, f, "shapley")] += here and not gone
    return out


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(80)] + ["Big", "LOUD", "a#b"]
    shared = "a passage that many begin with " * 30
    rows = []
    for i in range(90):
        n = rng.choice([0, 3, 49, 50, 51, 90])
        text = " ".join(rng.choices(vocabulary[:81 + rng.randrange(3)], k=n)) if i % 4 else shared + rng.choice(["x", "y", "xy", ""])
        rows.append((rng.choice([i, i, i % 20, None]), text, rng.choice(["s", "t", None])))
    return rows + rows[:15] + [(500, None, "s"), (501, "", "s"), (None, "", "t"), (502, "  é\x0b\x1fA", "t"), (3, "word " * 300_000, "u"), (2, "word " * 300_000, "u")]


def frames(spark, rows, labels=()):
    return (spark.createDataFrame(rows, "doc_id long, text string, source string"),
            spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int"))


@pytest.mark.parametrize("options", [{}, {"block_rows": 7, "split_bytes": 50}])
def test_masks_equal_brute_force(spark, options):
    rows = corpus()
    docs, _ = frames(spark, rows)
    got = Counter((r.doc_id, r.source, "".join(f for k, f in enumerate("ABCDE") if r.mask >> k & 1))
                  for r in failing_filters(docs.repartition(3), **options).collect())
    assert got == Counter(masks(rows))


def test_audit_equals_brute_force(spark):
    rows = corpus()
    labels = [(i, i % 2, i % 3 % 2) for i in range(60)] + [(None, 1, 1), (4, 1, 1), (4, 0, 0), (7, None, 1), (9999, 1, 1)]
    docs, marks = frames(spark, rows, labels)
    for name in ("part", "mask", "block", "number", "least", "n", "good", "toxic"):
        docs = docs.withColumn(name, docs["doc_id"])
    want = brute(rows, labels)
    got = filter_audit(docs, marks.withColumn("good", marks["quality"])).collect()
    assert len(got) == 600 * len({r[2] or "" for r in rows})
    for r in got:
        key = (r.part, r.filter_order, r.step)
        for what in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"):
            assert r[what] == want[key + (what,)], (key, what)
        assert r.shapley == want[(r.part, r.filter_order[r.step - 1], "shapley")]


def test_no_documents(spark):
    docs, labels = frames(spark, [])
    assert filter_audit(docs, labels).collect() == []


def test_trie_keeps_least_ids_and_order():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6))) * rng.choice([1, 40]) for _ in range(2000)]
    texts += [b"x" * 100_000 + e for e in (b"a", b"b", b"")]
    trie, node, best = RadixTrie(), {}, {}
    for t in texts:
        i = rng.choice([None, rng.randrange(10_000)])
        assert node.setdefault(t, n := trie.insert(t, i)) == n
        if i is not None:
            best[t] = min(best.get(t, i), i)
    assert {t: trie.least[n] for t, n in node.items() if trie.least[n] is not None} == best
    back = {n: t for t, n in node.items()}
    assert [back[n] for n in trie.terminals()] == sorted(node)


def test_common_prefix():
    rng = random.Random(4)
    for _ in range(500):
        a = b"p" * rng.randrange(60)
        x, y = (a + bytes(rng.choice(b"pq") for _ in range(rng.randrange(9))) for _ in range(2))
        assert common_prefix(x, y) == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
