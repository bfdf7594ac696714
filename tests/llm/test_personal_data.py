"""Base spans against Python's expressions; discovered spans on made contexts."""

import re

import pytest

from layerkit.llm import pii_bootstrap as p

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits)))
        return 16 <= len(digits) <= 19 and total % 10 == 0
    return 8 <= len(digits) <= 15 if kind == "phone" else True


def base(text):
    return [(k, m.start(), m.end()) for k, e in PATTERNS.items() for m in re.finditer(e, text or "") if passes(k, m.group())]


TEXTS = [None, "", "no data", "a.b@c.d", "x@y a@b.c.d@e.f g@h..i @q.r", "a@b.c_d@e.f", "é 1.2.3.4 ü 256.1.1.1 1.2.3.4.5.6.7.8",
         "0000000001.02.003.255", "00000256.1.1.1", "1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
         "5500005555555559 12345678901234567890123 0000000000000000", "4111  1111", "+1 (743) 555-3824 +12 +1 2 3 4 5 6 7 8",
         "+1234567 +123456789012345 +1234567890123456", "++49 30 1234567.", "\U0001f600 +44 20 7946 0958 \U0001f600 me@x.org",
         "9" * 20_000, "a" * 50_000, "a@" * 5_000, "+" * 1_000 + "1" + " " * 5_000, "1.1.1 " * 3_000 + "10.0.0.1",
         *(" ".join(f"u{i}@h{i}.com" for i in range(n)) for n in (255, 256, 257, 512, 5_000)),
         " ".join(f"{i}: 10.{i % 300}.0.1 +1 {i:07d} x{i}@y.z" for i in range(1_500))]


def found(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r.doc_id: [(x.kind, x.start, x.end, x.found_by) for x in r.spans] for r in p.find_personal_data(df, **kw).collect()}


def test_base_spans_match_python(spark):
    got = found(spark, list(enumerate(TEXTS)))
    for i, text in enumerate(TEXTS):
        assert [x[:3] for x in got[i] if x[3] == "base"] == base(text), text and text[:60]


def test_base_spans_on_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in p.find_personal_data(df).collect():
        assert [(x.kind, x.start, x.end) for x in r.spans if x.found_by == "base"] == base(texts[r.doc_id])


def test_overlap_search_matches_brute_force(spark):
    spans = [(10, 14), (14, 20), (30, 31), (40, 60)]
    for n in range(len(spans) + 1):
        df = spark.createDataFrame([(spans[:n], a, a + w) for a in range(0, 64, 3) for w in (1, 5, 25)],
                                   "spans array<struct<start:long,end:long>>, a long, b long")
        for r in df.withColumn("hit", p._overlapped(df["spans"], df["a"], df["b"])).collect():
            assert r.hit == any(x.start < r.b and x.end > r.a for x in r.spans)


def test_contexts_of_seeds_find_unseen_identifiers(spark):
    cards = ["4111111111111111", "5500005555555559", "4012888888881881", "4222222222222220"]
    cards = [c for c in cards if passes("card", c)]
    rows = [(i, f"w{i} my card {c} thanks") for i, c in enumerate(cards)]
    hidden = "4111111111111112"                                   # fails the check, so no base match
    rows += [(50, f"also my card {hidden}, thanks"), (51, f"order number {hidden[:-1]}3 shipped")]
    assert len(cards) >= 3 and not base(hidden)
    got = found(spark, rows)
    at = rows[-2][1].index(hidden)
    assert got[50] == [("card", at, at + 16, "context")]          # the sign after it is not part of it
    assert got[51] == []
    assert found(spark, rows, min_support=len(cards) + 1)[50] == []


def test_instances_carry_patterns_to_other_instances(spark):
    seen = [("p1", f"s{i}", 2) for i in range(4)] + [("p1", "new", None)] + [("p2", "new", None), ("p2", "s0", 2), ("p3", "other", None)]
    df = spark.createDataFrame(seen, "pattern string, instance string, kind int")
    one = {r.pattern: (round(r.score, 3), r.support) for r in p.pattern_scores(df, rounds=1).collect()}
    two = {r.pattern: (round(r.score, 3), r.support) for r in p.pattern_scores(df, rounds=2).collect()}
    assert one == {"p1": (0.8, 4), "p2": (0.5, 1)}
    assert two["p2"][0] == pytest.approx((1 + 1 - (1 - 0.8) * (1 - 0.5)) / 2, abs=1e-3) and "p3" not in two


def test_empty_repeated_rows_and_null_ids(spark):
    assert found(spark, []) == {}
    df = spark.createDataFrame([(None, "a@b.c"), (1, "a@b.c"), (1, "a@b.c")], "doc_id long, text string").selectExpr("*", "'x' AS spans")
    assert [[tuple(x) for x in r.spans] for r in p.find_personal_data(df).collect()] == [[("email", 0, 5, "base")]] * 3


def test_identifiers_of_several_words_are_instances(spark):
    phones = [f"+1 (0{i}7) 555-77{i}3" for i in range(1, 6)]
    cards = ["4111 1111 1111 1111", "5500 0055 5555 5559", "4012 8888 8888 1881"]
    ips = ["10.0.0.1", "10.0.0.2", "10.0.0.3"]
    rows = [(i, f"w{i} please call {x} now") for i, x in enumerate(phones)]
    rows += [(10 + i, f"w{i} card number {x} now") for i, x in enumerate(cards)]
    rows += [(20 + i, f"w{i} host at {x} now") for i, x in enumerate(ips)]
    # fails the check, so no base match
    hidden = {50: ("card number", "4111 1111 1111 1112")}
    rows += [(i, f"x {words} {x}, thanks") for i, (words, x) in hidden.items()]
    rows += [(52, "w host at 10.0.0.9 now"), (53, "w host of 99.9.9.900")]
    assert not any(base(x) for _, x in hidden.values())
    got = found(spark, rows)
    assert got[50] == [("card", 14, 33, "context")]
    assert got[20][0][0] == "ip" and got[52][0][3] == "base" and got[53] == []


def test_contexts_at_the_start_and_behind_other_identifiers(spark):
    cards = [c for c in ("4111111111111111", "5500005555555559", "4012888888881881") if passes("card", c)]
    rows = [(i, c) for i, c in enumerate(cards)] + [(9, "4111111111111112")]
    rows += [(20 + i, f"pay u{i}@h.com {c}") for i, c in enumerate(cards)] + [(29, "pay me@x.org 4111111111111113")]
    got = found(spark, rows)
    assert got[9] == [("card", 0, 16, "context")] and got[29] == [("email", 4, 12, "base"), ("card", 13, 29, "context")]


def test_phones_support_the_words_before_the_whole_number(spark):
    rows = [(i, f"w{i} please call +1 (0{i}7) 555-77{i}3 now") for i in range(1, 6)]
    df = spark.createDataFrame([*rows, (9, "now please call +1 (097) 555-7793 0000 0000 0000")], "doc_id long, text string")
    facts = p._facts(df, "doc_id", "text").collect()
    assert {m.pattern for r in facts for m in r.matches} == {"please call +9 (999) 999-9999"}
    assert [m.pattern for r in facts if r.doc_id == 9 for m in r.groups] == ["please call +9 (999) 999-9999 9999 9999 9999"]


def test_patterns_known_only_through_what_other_patterns_found(spark):
    def luhn(i):
        return next(c for c in (f"40000{i:010d}{d}" for d in range(10)) if passes("card", c))

    seeds = [luhn(i) for i in range(120)]
    failing = [s[:-1] + str((int(s[-1]) + 1) % 10) for s in seeds[:11]]
    rows = [(i, f"w my card {c} ok") for i, c in enumerate(seeds[:60])] + [(100 + i, f"w paid with {c} ok") for i, c in enumerate(seeds[60:])]
    rows += [(200 + i, f"w my card {c} ok") for i, c in enumerate(failing[:10])] + [(300 + i, f"w paid with {c} ok") for i, c in enumerate(failing[:10])]
    rows += [(400 + i, f"w pan is {c} ok") for i, c in enumerate(failing)] + [(500 + i, f"w order no {failing[10][:-3]}{i}{i}7 ok") for i in range(3)]
    assert not any(base(f"w pan is {c} ok") for c in failing)
    got = found(spark, rows)
    assert all(got[n + i] == [("card", at, at + 16, "context")] for n, at in ((200, 10), (300, 12), (400, 9)) for i in range(10))
    assert got[410] == [("card", 9, 25, "context")] and all(got[500 + i] == [] for i in range(3))
    assert found(spark, rows, min_support=11)[410] == []          # ten trusted instances are too few then


def brute_accepted(seen, rounds, min_score, min_support):
    edges = {}
    for p_, i, _ in seen:
        edges[p_, i] = edges.get((p_, i), 0) + 1
    total = {}
    for (p_, _), n in edges.items():
        total[p_] = total.get(p_, 0) + n
    seeds = {(k, i): 1.0 for _, i, k in seen if k is not None}

    def reached(scores):
        doubt = {}
        for (p_, i) in edges:
            for (k, q), s in scores.items():
                if q == p_:
                    doubt[k, i] = doubt.get((k, i), 1.0) * (1 - min(s, 0.99))
        return {x: min(1 - d, 0.99) for x, d in doubt.items()}

    trusted, accepted = dict(seeds), {}
    while True:
        known = dict(trusted)
        for left in range(rounds, 0, -1):
            part, support = {}, {}
            for (p_, i), n in edges.items():
                for k, j in known:
                    if i == j:
                        part[k, p_] = part.get((k, p_), 0.0) + n * known[k, j]
                        support[k, p_] = support.get((k, p_), 0) + ((k, j) in trusted)
            scores = {x: round(s / total[x[1]], 9) for x, s in part.items()}
            if left > 1:
                known = reached(scores) | trusted
        new = {x: s for x, s in scores.items() if s >= min_score and support[x] >= min_support and x not in accepted}
        if not new:
            return accepted
        accepted |= new
        trusted = reached(accepted) | seeds


@pytest.mark.parametrize("seed", [3, 4])
def test_accepted_patterns_match_brute_force(spark, seed):
    import random
    r = random.Random(seed)
    seen = [(f"p{r.randrange(12)}", f"i{(j := r.randrange(40))}", r.choice([0, 2, 2]) if j < 12 and r.random() < 0.7 else None) for _ in range(260)]
    seen += [(f"q{n}", f"x{n + m}", 1 if n + m < 3 else None) for n in range(5) for m in range(4)]      # a chain: each leads to the next
    df = spark.createDataFrame(seen, "pattern string, instance string, kind int")
    for limits in ((2, 0.8, 3), (1, 0.6, 3)):
        rows = p.accepted_patterns(df, *limits).collect()
        want = brute_accepted(seen, *limits)
        assert {(x.kind, x.pattern): round(x.score, 6) for x in rows} == {x: round(s, 6) for x, s in want.items()}, limits
    assert max(x.step for x in rows) > 2


def test_words_and_identifiers_of_any_length(spark):
    far, word = " " * 500, "long" * 500
    rows = [(i, f"w {word}  my{far}{x}@h{x}.com ok") for i, x in enumerate("abcd")]
    hidden = "ü" * 990 + "@long.org"                              # no base match: nothing before the @ that one may hold
    rows += [(9, f"w {word}  my{far}{hidden} ok"), (10, f"w {word[1:]}  my{far}{hidden}x ok")]
    rows += [(20 + i, f"w {'x' * 900} card {c} ok") for i, c in enumerate(["4111111111111111", "5500005555555559", "4012888888881881"])]
    rows += [(30, f"w {'x' * 900} card 4111111111111112 ok"), (31, f"w {'x' * 901} card 4111111111111112 ok")]
    got = found(spark, rows)
    at = rows[4][1].index(hidden)
    assert not base(rows[4][1]) and got[9] == [("email", at, at + len(hidden), "context")] and got[10] == []
    assert got[30] == [("card", 908, 924, "context")] and got[31] == []      # one word of the two is another


def test_rows_are_told_by_id_and_text(spark):
    df = spark.createDataFrame([(1, "a", "1:a"), (None, "a", ":a"), (None, "1:a", "x")], "i long, t string, o string")
    keys = [bytes(r[0]) for r in df.select(p._row_key(df["i"], df["t"])).collect()]
    assert len(set(keys)) == 3 and all(len(k) == 32 for k in keys)
