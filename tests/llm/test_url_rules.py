"""URL rules: parts of a url, listed rules, mining against counting by hand."""

import random
from itertools import combinations

from pyspark.sql import functions as F

from layerkit.llm import url_rules as u
from layerkit.llm.queries import URL_RULES


def test_host_path_and_tokens(spark):
    cases = {None: ("", ""), "": ("", ""), "no scheme": ("", ""), "http://A.Example.COM": ("a.example.com", ""),
             "http://É.com/x": ("É.com", "/x"), "x://h?q=1#f": ("h", ""), "x://h#f/p": ("h", ""),
             "http://h/p/q?a=http://z/y": ("h", "/p/q"), "://": ("", ""), "http:///p": ("", "/p"), "a://b://c/d": ("b:", "//c/d"),
             "http://h/" + "p" * 50_000: ("h", "/" + "p" * 50_000)}
    df = spark.createDataFrame([(k,) for k in cases], "url string")
    got = {r.url: (r.h, r.p) for r in df.select("url", u.host_of(F.col("url")).alias("h"), u.path_of(F.col("url")).alias("p")).collect()}
    assert got == cases
    df = spark.createDataFrame([("http://www.a.com/en/x?id=3&b=4&id=5",)], "url string")
    assert set(df.select(u.tokens_of(F.col("url"))).first()[0]) == {"h:www", "h:a", "h:com", "p:en", "p:x", "q:id", "q:b"}


def slow_rule(host, path):
    fits = [(len(h + p), v, h + p) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_longest_listed_rule_wins(spark):
    urls = ["http://a.com/", "http://a.com", "http://example.com/en/1", "http://m.example.com/en/1", "http://www.example.com/en/1",
            "http://x.www.example.com/en/", "http://www.example.com/en", "http://notexample.com/en/", "http://a.net/es/", "http://net/fr/x",
            "http://a.net/en/", "http://a.org/en/", "ftp://COM/x", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    none = spark.createDataFrame([], "url string, bad boolean")
    for r in u.judge_urls(pages, none, URL_RULES).collect():
        verdict, rule = slow_rule(r.host, r.path)
        assert (r.rule, r.verdict) == (rule, verdict or "allow"), r.url


def test_mining_matches_counting(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(600):
        host, a, b = (rnd.choice(x) for x in (["s.org", "t.org", "spam.org"], ["en", "de", "ads"], ["x", "y", "pills"]))
        bad = host == "spam.org" or (a == "ads" and b == "pills") or rnd.random() < 0.1
        rows.append((i, f"http://{host}/{a}/{b}", bad))
    rows += [(700, None, True), (701, "http://s.org/en/x", None), (702, "nothing", True)]
    labelled = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    counts = {}
    used = [(set(f"h:{x}" for x in r[1].split("/")[2].split(".")) | {f"p:{x}" for x in r[1].split("/")[3:]}, r[2])
            for r in rows if r[1] and "://" in r[1] and r[2] is not None]
    used = [({t for t in tokens if len(t) > 2}, bad) for tokens, bad in used]
    for tokens, bad in used:
        for n in (1, 2):
            for c in combinations(sorted(tokens), n):
                counts.setdefault(c, [0, 0])[0] += 1
                counts[c][1] += bad
    least = max(5, -(-len(used) * 0.005 // 1))
    rules = {c for c, (n, k) in counts.items() if k >= least and k >= 0.8 * n}
    rules = {c for c in rules if len(c) == 1 or not any((t,) in rules for t in c)}
    got = {tuple(r.tokens): (r.pages, r.bad_pages) for r in u.mine_rules(labelled, min_confidence=0.8).collect()}
    assert got == {c: tuple(counts[c]) for c in rules} and ("h:spam",) in got and ("p:ads", "p:pills") in got

    pages = spark.createDataFrame([(1, "http://new.org/ads/pills", "q"), (2, "http://new.org/ads/x", "q"), (3, "http://a.spam.org/", "q"),
                                   (3, "http://a.spam.org/", "q"), (None, None, "q")], "page_id long, url string, verdict string")
    got = sorted(((r.page_id, r.verdict) for r in u.judge_urls(pages, labelled, (), min_confidence=0.8).collect()), key=str)
    assert got == [(1, "block"), (2, "allow"), (3, "block"), (3, "block"), (None, "allow")]


def test_three_token_rules_and_empty_pages(spark):
    labelled = spark.createDataFrame([(f"http://a.org/x{a}/y{b}/z{c}", a == b == c) for a in "12" for b in "12" for c in "12"] * 10,
                                     "url string, bad boolean")
    rules = {tuple(r.tokens) for r in u.mine_rules(labelled, min_confidence=0.9, max_tokens=3).collect()}
    assert rules == {("p:x1", "p:y1", "p:z1"), ("p:x2", "p:y2", "p:z2")}
    assert u.judge_urls(spark.createDataFrame([], "page_id long, url string"), labelled, URL_RULES).count() == 0


def test_rules_of_any_length_match_counting(spark):
    rnd = random.Random(4)
    rows = []
    for _ in range(900):
        host, a, b, q = (rnd.choice(x) for x in (["s.org", "t.org", "u.org"], ["en", "ads"], ["x", "pills"], ["id", "ref"]))
        bad = (host, a, q) == ("s.org", "ads", "ref") or (host, a, b, q) == ("t.org", "en", "pills", "id") or rnd.random() < 0.1
        rows.append((f"http://{host}/{a}/{b}?{q}=1", bad))
    counts = {}
    for url, bad in rows:
        host, a, b = url.split("/")[2:]
        tokens = {f"h:{x}" for x in host.split(".")} | {f"p:{a}", f"p:{b.split('?')[0]}", f"q:{b.split('?')[1][:-2]}"}
        for n in range(1, len(tokens) + 1):
            for c in combinations(sorted(tokens), n):
                counts.setdefault(c, [0, 0])[0] += 1
                counts[c][1] += bad
    rules = {c for c, (n, k) in counts.items() if k >= 5 and k >= 0.8 * n}
    rules = {c for c in rules if not any(set(r) < set(c) for r in rules)}
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    got = {tuple(r.tokens): (r.pages, r.bad_pages) for r in u.mine_rules(labelled, min_confidence=0.8).collect()}
    assert got == {c: tuple(counts[c]) for c in rules} and {len(c) for c in got} >= {3, 4}
    pages = spark.createDataFrame([(1, "http://s.org/ads/new?ref=2"), (2, "http://s.org/ads/x?id=2"), (3, "http://t.org/en/pills?id")],
                                  "page_id long, url string")
    judged = {r.page_id: r.verdict for r in u.judge_urls(pages, labelled, (), min_confidence=0.8).collect()}
    assert judged == {1: "block", 2: "allow", 3: "block"}


def test_a_rule_covered_by_a_much_shorter_one_is_dropped(spark):
    # x is a rule, x and y are none, x and y and z are one again
    urls = [("http://a/x", True)] * 40 + [("http://a/x/y", False)] * 12 + [("http://a/x/y/z", True)] * 10 + [("http://a/y/z", False)] * 50
    rules = [tuple(r.tokens) for r in u.mine_rules(spark.createDataFrame(urls, "url string, bad boolean"), min_confidence=0.8).collect()]
    assert rules == [("p:x",)]


def test_long_templates_are_mined_once_and_any_of_their_tokens_counts(spark):
    template = "/".join(f"seg{i}" for i in range(40))
    urls = [(f"http://a.org/{template}/{'pills' if i % 2 else 'x'}/n{i}", bool(i % 2)) for i in range(60)] + [(f"http://b.org/pills/q{i}", False) for i in range(40)]
    labelled = spark.createDataFrame(urls, "url string, bad boolean")
    rules = {tuple(r.tokens): (r.pages, r.bad_pages) for r in u.mine_rules(labelled, min_confidence=0.8).collect()}
    # the constant tokens are one class: each of them with "pills" is a rule, no two of them are in one
    assert rules == {tuple(sorted((t, "p:pills"))): (30, 30) for t in ["h:a", *(f"p:seg{i}" for i in range(40))]}
    pages = spark.createDataFrame([(1, "http://c.org/seg7/pills"), (2, "http://c.org/seg7/x"), (3, "http://c.org/pills")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in u.judge_urls(pages, labelled, (), min_confidence=0.8).collect()} == {1: "block", 2: "allow", 3: "allow"}
