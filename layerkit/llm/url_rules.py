"""URL filtering by listed rules and by association rules mined from labels.

Listed rules name a host and a path prefix; the longest that fits decides.
All other urls are judged by combinations of their tokens: Spark's FP-growth
finds the token sets that are frequent among labelled pages, sets that
mean "bad" often enough become rules, and rules that a shorter one implies
are dropped. An inverted index lists each rule under its rarest token; a url
looks up its tokens there and is blocked if it has all tokens of one rule.

Urls are judged once each, however many pages have them. FP-growth keeps
the frequent tokens on the driver: at most the number of tokens of a url
divided by ``min_support``. Tokens that always occur together count as one,
so long templates do not multiply the sets; tokens that mostly but not
always do still have each of their frequent combinations counted.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(_after_scheme(text_of(url)), "^[^/?#]*+", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(text_of(url)), "^[^/?#]*+([^?#]*+)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct tokens: labels of the host (h:), path segments (p:) and names of query parameters (q:)."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(text_of(url), r"^[^?#]*+\?([^#]*+)", 1)

    def named(kind: str, part: Column, sep: str) -> Column:
        return F.transform(F.split(part, sep), lambda x: F.concat(F.lit(kind), F.split_part(x, F.lit("="), F.lit(1))))

    every = F.concat(named("h:", host, "[.]"), named("p:", path, "/"), named("q:", query, "&"))
    return F.array_distinct(F.filter(every, lambda x: (F.length(x) > 2) & ~x.contains(" ")))


def listed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest of the (verdict, host, path) rules that fits, else nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def mine_rules(labelled: DataFrame, url_col: str = "url", bad_col: str = "bad", min_support: float = 0.005,
               min_pages: int = 5, min_confidence: float = 0.5, max_tokens: int | None = None) -> DataFrame:
    """Rules (tokens, pages, bad_pages): token sets whose labelled pages are mostly bad.

    ``min_support`` is the least share of labelled pages that have the
    tokens and are bad, ``min_pages`` their least number, ``min_confidence``
    the least share of bad ones among the pages that have the tokens. A rule
    that contains another rule's tokens is dropped. Sets have any number of
    tokens unless ``max_tokens`` limits it. Pages with a null label or
    without tokens take no part. No labelled pages give no rules.

    Every choice of one token for each class is listed here; judging works
    on the classes themselves (see :func:`mine_class_rules`).
    """
    rules, classes = mine_class_rules(labelled, url_col, bad_col, min_support, min_pages, min_confidence, max_tokens)
    members = classes.groupBy("item").agg(F.collect_list("token").alias("members"))  # the tokens of one url at most
    numbered = rules.withColumn("rule", F.monotonically_increasing_id()).select("*", F.posexplode("tokens").alias("at", "item"))
    lists = numbered.join(members, "item").groupBy("rule", "pages", "bad_pages").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "members"))), lambda x: x["members"]).alias("lists"))
    choices = F.aggregate("lists", F.array(F.array().cast("array<string>")),
                          lambda done, more: F.flatten(F.transform(done, lambda d: F.transform(more, lambda m: F.array_append(d, m)))))
    return lists.select(F.explode(choices).alias("tokens"), "pages", "bad_pages").withColumn("tokens", F.array_sort("tokens"))


def mine_class_rules(labelled: DataFrame, url_col: str = "url", bad_col: str = "bad", min_support: float = 0.005, min_pages: int = 5,
                     min_confidence: float = 0.5, max_tokens: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rules, classes) as of :func:`mine_rules`, over classes of tokens: classes has token and item.

    Tokens that occur in exactly the same labelled pages (the constant parts
    of a template) are one class, named by its least token: whatever set one
    of them is in has the same pages with another, and a set with two of
    them is never the shortest. So FP-growth counts a template once, not
    once for each of its subsets. It runs over the bad pages alone, whose
    number is the support; the pages of all labels that have a frequent
    set's tokens are counted by a join on its rarest token.
    """
    spark = labelled.sparkSession
    schema = "tokens array<string>, pages long, bad_pages long"
    baskets = stored(labelled.select(tokens_of(F.col(url_col)).alias("tokens"), F.col(bad_col).alias("bad"))
                     .filter(F.col("bad").isNotNull() & (F.size("tokens") > 0)).withColumn("basket", F.monotonically_increasing_id()),
                     "url-baskets")
    total, bad = baskets.agg(F.count("*"), F.count(F.when(F.col("bad"), 1))).first()
    least = max(min_pages, math.ceil(min_support * total - 1e-9), 1)
    if bad < least:
        return spark.createDataFrame([], schema), spark.createDataFrame([], "token string, item string")
    # 128 bits of the baskets that a token is in, beside their number
    where = [F.bit_xor(F.xxhash64(F.lit(i), F.col("basket"))).alias(f"w{i}") for i in (1, 2)]
    tokens = (baskets.select("basket", "bad", F.explode("tokens").alias("token")).groupBy("token")
              .agg(F.count("*").alias("pages"), F.count(F.when(F.col("bad"), 1)).alias("bad_pages"), *where).filter(F.col("bad_pages") >= least))
    same = ["pages", "bad_pages", "w1", "w2"]
    tokens = stored(tokens, "url-tokens")
    items = tokens.groupBy(*same).agg(F.min("token").alias("item"))
    classes = stored(tokens.join(items, same).select("token", "item", "pages"), "url-token-classes")
    # a basket has as many items as its url has tokens
    held = stored(baskets.select("basket", "bad", F.explode("tokens").alias("token")).join(classes, "token")
                  .groupBy("basket", "bad").agg(F.collect_set("item").alias("items")), "url-items")
    mined = FPGrowth(minSupport=(least - 0.5) / held.filter("bad").count(), itemsCol="items").fit(held.filter("bad")).freqItemsets
    sets = mined.select(F.array_sort("items").alias("tokens"), F.col("freq").alias("bad_pages"))
    if max_tokens:
        sets = sets.filter(F.size("tokens") <= max_tokens)
    sets = stored(sets, "frequent-item-sets")
    rarest = (sets.select("tokens", F.explode("tokens").alias("item")).join(classes.select("item", "pages").distinct(), "item")
              .groupBy("tokens").agg(F.min(F.struct("pages", "item")).alias("rarest")))
    # the baskets' files are far smaller than the baskets: they are never the side to broadcast
    pages = (held.select("basket", "items", F.explode("items").alias("item")).hint("merge")
             .join(rarest.select("tokens", F.col("rarest.item").alias("item")), "item")
             .filter(F.size(F.array_except("tokens", "items")) == 0).groupBy("tokens").agg(F.count("*").alias("pages")))
    sets = stored(sets.join(pages, "tokens").withColumn("rule", F.col("bad_pages") >= min_confidence * F.col("pages")), "frequent-token-sets")
    return _shortest_rules(sets), classes.select("token", "item")


def _shortest_rules(sets: DataFrame) -> DataFrame:
    """The rules among ``sets`` (tokens, pages, bad_pages, rule) that hold no other rule's tokens.

    All subsets of a set must be there too. So a set holds a shorter rule if
    one of its subsets with one token less is a rule or holds one: one join
    for each number of tokens, and no pairs of rules.
    """
    longest = sets.agg(F.max(F.size("tokens"))).first()[0] or 0
    found = sets.filter("rule").filter(F.size("tokens") == 1)
    holding = found.select("tokens")
    for n in range(2, longest + 1):
        these = sets.filter(F.size("tokens") == n)
        without_one = F.transform("tokens", lambda x: F.array_remove("tokens", x))
        implied = (these.select("tokens", F.explode(without_one).alias("subset"))
                   .join(holding.select(F.col("tokens").alias("subset")), "subset", "left_semi").select("tokens").distinct())
        marked = stored(these.join(implied.withColumn("implied", F.lit(True)), "tokens", "left")
                        .filter("rule or implied"), "url-rules-by-length")
        found = found.unionByName(marked.filter("implied is null").drop("implied"))
        holding = marked.select("tokens")
    return found.select("tokens", "pages", "bad_pages")


def blocked_urls(urls: DataFrame, rules: DataFrame, classes: DataFrame, url_col: str = "url") -> DataFrame:
    """The distinct urls that have, for each item of a rule, a token of its class."""
    counts = rules.select(F.explode("tokens").alias("item"), "pages").groupBy("item").agg(F.max("pages").alias("n"))
    listed = rules.select(F.col("tokens").alias("needed"), F.explode("tokens").alias("item")).join(counts, "item")
    index = listed.groupBy("needed").agg(F.min(F.struct("n", "item")).alias("rarest")).select("needed", "rarest.item")
    had = (urls.select(F.col(url_col).alias("url")).distinct().select("url", F.explode(tokens_of(F.col("url"))).alias("token"))
           .join(classes, "token").groupBy("url").agg(F.collect_set("item").alias("items")))  # at most the url's tokens
    return (had.select("url", "items", F.explode("items").alias("item")).join(index, "item")
            .filter(F.size(F.array_except("needed", "items")) == 0).select("url").distinct())


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id",
               url_col: str = "url", **mining) -> DataFrame:
    """page_id, url, host, path, rule and verdict for every page.

    ``labelled`` has the url and a boolean ``bad``. A listed rule's verdict
    wins; else a url with all tokens of a mined rule is blocked and all
    others are allowed. A null url, or one without ``://``, has an empty
    host and path and is judged by what tokens it has (none: allowed).
    Repeated pages give repeated rows. Extra columns are ignored, whatever
    their names.
    """
    url = F.col("url")
    host, path = host_of(url), path_of(url)
    rule, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    judged = (pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
              .withColumns({"host": host, "path": path}).withColumns({"rule": rule, "listed": verdict}))
    mined, classes = mine_class_rules(labelled, **mining)
    blocked = blocked_urls(judged.filter("listed is null"), stored(mined, "url-rules"), classes).select(F.col("url").alias("blocked"))
    return judged.join(blocked, judged["url"] == blocked["blocked"], "left").select(
        "page_id", "url", "host", "path", "rule",
        F.coalesce("listed", F.when(F.col("blocked").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))
