"""Personal data by bootstrapped contextual extraction.

Base matches (mail addresses, IP addresses, card and phone numbers) come
from fixed expressions and checks. They are the seed entities of a
bootstrap:

1. Every base match, every identifier-like token - one with an ``@`` or
   with many digits - and every run of adjoining digit groups is an
   instance. Its lexical pattern is the two words before it, whatever they
   are (the start of the text counts as words, an instance of the same
   expression as one), and its own shape. Words, shapes and instances count
   whole, of any length; the long ones go by their SHA-256.
2. Patterns and instances form a graph, weighted by how often they meet.
   Its edges are summed first, so it grows with distinct pairs only.
3. Scores go back and forth. A pattern's score is the share of its
   occurrences that have known instances, an instance's score grows with
   the scores of the patterns it fits. Base matches keep score 1.
4. Patterns with a score and a support above the thresholds are accepted,
   for the kind whose instances gave them. What they hold is trusted from
   then on: it counts, with the score of its patterns, as known instances
   and as support of further patterns. Steps 3 and 4 are repeated until no
   pattern is new. Accepted patterns' occurrences are the new spans.

All of it is DataFrame work: expressions on the text, grouped sums and
joins on the graph. Positions are counted in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of

KINDS = ("email", "ip", "card", "phone")

# The kinds' expressions, written so that no text needs
# backtracking over more than one match: runs are possessive, and a search
# begins only where a run begins or the last match ended.
LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|(?=[.]|$))"
#: Instances besides the base matches: blank-delimited tokens with an @ or at least six digits,
#: and runs of digit groups with a blank between them (six digits in all) or dotted quads.
TOKEN = r"(?<!\S)(?:(?=[^\s@]*+@)|(?=(?:[^\s0-9]*+[0-9]){6}))\S++"

GROUP = r"[+(]{0,2}[0-9]++(?:[().-]{1,3}[0-9]++)*+\)?+(?![\p{L}0-9@])"
GROUPS = rf"(?<!\S){GROUP}(?:\x20{GROUP})*+"
#: Stands for each of the two words before a text's first.
START = "^"
#: Words, patterns and instances of more characters are told by their SHA-256.
PLAIN = 64


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + F.when(
        (n - i) % 2 == 0, F.substr(digits, i, F.lit(1)).cast("int")).otherwise(
        F.element_at(F.array(*(F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), F.substr(digits, i, F.lit(1)).cast("int") + 1)))
    return total % 10 == 0


def _passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        digits = _digits(match)
        # the check sees at most 19 digits
        return F.length(digits).between(16, 19) & F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


#: Positions appended to one array before it is closed: appending copies the array.
RUN = 256


def _named(c: Column) -> Column:
    """The text itself, or of a long one its beginning and its SHA-256."""
    return F.when(F.length(c) <= PLAIN, c).otherwise(F.concat(F.left(c, F.lit(16)), F.lit("~"), F.sha2(c, 256)))


def _word(c: Column) -> Column:
    """A word of a context: in lower case with digits as 9; one with an @ as that sign."""
    return F.when(c.contains("@"), F.lit("@")).otherwise(_named(F.regexp_replace(F.lower(c), "[0-9]", "9")))


def _last_words(c: Column) -> Column:
    words = F.filter(F.split(c, r"\s+"), lambda w: w != "")
    return F.transform(F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), F.lit(2)), _word)


def _lengths(pieces: Column, matches: Column) -> Column:
    """Of each piece with the match behind it."""
    return F.transform(matches, lambda m, j: (F.length(F.get(pieces, j)) + F.length(m)).cast("long"))


def _starts(lengths: Column) -> Column:
    """Sums of the lengths before each, added up in runs, so that the work grows with their number and not its square."""
    last = F.size(lengths) - 1

    def run_of(first: Column) -> Column:
        return F.sequence(first, F.least(first + F.lit(RUN - 1), last))

    def sums(at: Column, first: Column) -> Column:
        return F.aggregate(run_of(first), F.struct(at.alias("at"), F.array().cast("array<bigint>").alias("found")),
                           lambda acc, j: F.struct((acc["at"] + F.get(lengths, j)).alias("at"), F.array_append(acc["found"], acc["at"]).alias("found")),
                           lambda acc: acc["found"])

    def after(at: Column, first: Column) -> Column:
        return F.aggregate(run_of(first), at, lambda acc, j: acc + F.get(lengths, j))

    zero = F.lit(0).cast("long")
    runs = F.aggregate(F.sequence(F.lit(0), last, F.lit(RUN)), F.struct(zero.alias("at"), F.array().cast("array<array<bigint>>").alias("found")),
                       lambda acc, first: F.struct(after(acc["at"], first).alias("at"), F.array_append(acc["found"], sums(acc["at"], first)).alias("found")),
                       lambda acc: F.flatten(acc["found"]))
    return F.when(F.size(lengths) > 0, runs).otherwise(F.array().cast("array<bigint>"))


def _walk(pieces: Column, matches: Column, starts: Column, words: Column) -> Column:
    """Matches with start, end and the two words before them.

    ``pieces`` are what a split by the same expression leaves, so positions
    are sums of lengths (``starts``: where each piece begins). ``words`` are
    the last two words of each piece; where a piece has fewer, the match
    before it is a word, and before that the last word of the piece before.
    """
    def match_word(j: Column) -> Column:
        return F.when(j >= 0, _word(F.get(matches, j))).otherwise(F.lit(START))

    def before(j: Column) -> Column:
        own, previous = F.get(words, j), F.get(words, F.greatest(j - 1, F.lit(0)))
        farther = F.when(j < 1, F.lit(START)).when(F.size(previous) > 0, F.element_at(previous, -1)).otherwise(match_word(j - 2))
        return (F.when(F.size(own) > 1, F.array_join(own, " ")).when(F.size(own) == 1, F.concat_ws(" ", match_word(j - 1), F.get(own, F.lit(0))))
                .otherwise(F.concat_ws(" ", farther, match_word(j - 1))))

    def span(match: Column, j: Column) -> Column:
        start = (F.get(starts, j) + F.length(F.get(pieces, j))).cast("long")
        return F.struct(start.alias("start"), (start + F.length(match)).alias("end"), match.alias("match"), before(j).alias("before"))

    return F.transform(matches, span)


def _overlapped(spans: Column, start: Column, end: Column) -> Column:
    """Whether one of the disjoint, ordered spans overlaps start to end: a binary search for the first that ends later."""
    def halve(acc: Column, _: Column) -> Column:
        middle = F.shiftright(acc["low"] + acc["high"], 1)
        later = F.get(spans, middle)["end"] > start
        return F.when(acc["low"] < acc["high"], F.struct(F.when(later, acc["low"]).otherwise(middle + 1).alias("low"),
                                                         F.when(later, middle).otherwise(acc["high"]).alias("high"))).otherwise(acc)

    n = F.size(spans)
    first = F.aggregate(F.sequence(F.lit(1), F.length(F.bin(n))), F.struct(F.lit(0).alias("low"), n.alias("high")), halve,
                        lambda acc: acc["low"])
    return F.coalesce(F.get(spans, first)["start"] < end, F.lit(False))


def _located(docs: DataFrame, text: str, wanted: dict[str, tuple[str, Column]]) -> DataFrame:
    """``docs`` with a column of spans for each (expression, condition on the text).

    The matches and the pieces are columns of their own, so each expression
    runs over a text once or twice whatever the number of matches.
    """
    none = F.array().cast("array<string>")
    docs = docs.withColumns({f"m_{k}": F.when(if_, F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none)
                             for k, (p, if_) in wanted.items()})
    docs = docs.withColumns({f"p_{k}": F.when(F.size(f"m_{k}") > 0, F.split(text, p, -1)).otherwise(none)
                             for k, (p, _) in wanted.items()})
    docs = docs.withColumns({f"l_{k}": _lengths(F.col(f"p_{k}"), F.col(f"m_{k}")) for k in wanted}
                            | {f"w_{k}": F.transform(f"p_{k}", _last_words) for k in wanted})
    docs = docs.withColumns({f"s_{k}": _starts(F.col(f"l_{k}")) for k in wanted})
    docs = docs.withColumns({k: _walk(*(F.col(f"{x}_{k}") for x in "pmsw")) for k in wanted})
    return docs.drop(*(f"{x}_{k}" for x in "mplsw" for k in wanted))


def _shape(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[0-9]", "9"), r"\p{L}+", "a")


def _core(match: Column) -> Column:
    """The token without the signs around it."""
    return F.regexp_replace(F.regexp_replace(match, r"^[^\p{L}0-9+(]++", ""), r"[^\p{L}0-9)]++$", "")


def _row_key(id_: Column, text: Column) -> Column:
    """SHA-256 of id and text: rows that share both, and no others, share it."""
    return F.unhex(F.sha2(F.concat(F.coalesce(F.concat(F.lit("#"), id_.cast("string")), F.lit("")), F.lit(":"), text), 256))


def _facts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), _row_key(F.col(id_col), text).alias("key"))
    digit, at = F.col("text").rlike("[0-9]"), F.col("text").contains("@")
    condition = {"email": at, "ip": digit, "card": digit, "phone": F.col("text").contains("+")}
    found = _located(base, "text", {k: (BASE[k], condition[k]) for k in KINDS}
                     | {"token": (TOKEN, digit | at), "groups": (GROUPS, digit)})
    span = "array<struct<kind:int,start:bigint,end:bigint>>"

    def passing(i: int, kind: str) -> Column:
        return F.transform(F.filter(kind, lambda x: _passes(kind, x["match"])), lambda x: F.struct(
            F.lit(i).alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).cast(span)

    sure = F.concat(*(passing(i, k) for i, k in enumerate(KINDS)))

    def several(x: Column) -> Column:
        digits = F.length(_digits(x["match"]))
        return F.when(x["match"].contains(" "), digits >= 6).otherwise(
            (digits < 6) & x["match"].rlike(r"^[0-9]+(?:\.[0-9]+){3}$"))

    def valid(kind: str) -> Column:
        return F.filter(kind, lambda x: _passes(kind, x["match"]))

    found = found.select("doc_id", "key", sure.alias("base"), "token", F.filter("groups", several).alias("groups"),
                         *(valid(k).alias(k) for k in KINDS))

    def instance(start: Column, end: Column, match: Column, before: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), _named(match).alias("instance"),
                        F.concat_ws(" ", before, _named(_shape(match))).alias("pattern"))

    def whole(x: Column) -> Column:
        return instance(x["start"], x["end"], x["match"], x["before"])

    def seen(x: Column) -> Column:
        core = _core(x["match"])
        begin = x["start"] + F.length(x["match"]) - F.length(F.regexp_replace(x["match"], r"^[^\p{L}0-9+(]++", ""))
        return instance(begin, begin + F.length(core), core, x["before"])

    names = "array<struct<start:bigint,end:bigint,instance:string,pattern:string>>"
    return found.select("doc_id", "key", "base", F.transform("token", seen).cast(names).alias("tokens"),
                        F.transform("groups", whole).cast(names).alias("groups"),
                        F.concat(*(F.transform(k, whole).cast(names) for k in KINDS)).alias("matches"))


def _graph(seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (pattern, instance, n) and seeds (kind, instance), what a base match of the kind holds anywhere."""
    edges = stored(seen.groupBy("pattern", "instance").agg(F.count("*").alias("n")), "pattern-graph")
    return edges, stored(seen.filter("kind is not null").select("kind", "instance").distinct(), "seeds")


def _reached(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """(kind, instance, known) of the instances in scored patterns."""
    doubt = F.exp(F.sum(F.log(1 - F.least(F.col("score"), F.lit(0.99)))))
    return edges.join(scores.hint("merge"), "pattern").groupBy("kind", "instance").agg(F.least(1 - doubt, F.lit(0.99)).alias("known"))


def _scores(edges: DataFrame, trusted: DataFrame, rounds: int) -> DataFrame:
    """(kind, pattern, score, support) by scores that go back and forth from the trusted (kind, instance, known)."""
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    trusted = trusted.withColumn("trusted", F.lit(1))
    known = trusted
    for left in range(rounds, 0, -1):
        sums = (edges.join(known.hint("merge"), "instance").groupBy("kind", "pattern")
                .agg(F.sum(F.col("n") * F.col("known")).alias("part"), F.sum("trusted").alias("support")))
        # rounded, so that the order of a sum decides nothing
        scores = stored(sums.join(totals.hint("merge"), "pattern").select(
            "kind", "pattern", F.round(F.col("part") / F.col("total"), 9).alias("score"), "support"), "pattern-scores")
        if left > 1:
            known = stored(_reached(edges, scores).withColumn("trusted", F.lit(0)).unionByName(trusted).groupBy("kind", "instance")
                           .agg(F.max_by("known", "trusted").alias("known"), F.max("trusted").alias("trusted")), "instance-scores")
    return scores


def pattern_scores(seen: DataFrame, rounds: int = 2) -> DataFrame:
    """(kind, pattern, score, support) from occurrences (pattern, instance, kind; null if no base match).

    ``support`` counts the distinct seeds of a pattern. One pass of the
    bootstrap, from the seeds alone.
    """
    edges, seeds = _graph(seen)
    return _scores(edges, seeds.withColumn("known", F.lit(1.0)), rounds)


def accepted_patterns(seen: DataFrame, rounds: int = 2, min_score: float = 0.8, min_support: int = 3) -> DataFrame:
    """(kind, pattern, score, support, step) of all patterns that the bootstrap accepts.

    Each step scores the patterns from the trusted instances - the seeds, and
    what accepted patterns hold, with a score from those patterns - and
    accepts those with ``min_score`` and ``min_support`` distinct trusted
    instances. A pattern keeps the score it was accepted with. Steps go on
    until none is new, so their number is that of the longest chain of
    patterns that only lead to each other; each works on the graph, not on
    the texts.
    """
    edges, seeds = _graph(seen)
    seeds = seeds.withColumn("known", F.lit(1.0))
    trusted, accepted, count, step = seeds, None, 0, 0
    while True:
        step += 1
        passing = (_scores(edges, trusted, rounds).filter((F.col("score") >= min_score) & (F.col("support") >= min_support))
                   .withColumn("step", F.lit(step)))
        if accepted is not None:
            passing = accepted.unionByName(passing.join(accepted.select("kind", "pattern").hint("merge"), ["kind", "pattern"], "left_anti"))
        accepted = stored(passing, "accepted-patterns")
        before, count = count, accepted.count()
        if count == before:
            return accepted
        promoted = _reached(edges, accepted).join(seeds.select("kind", "instance").hint("merge"), ["kind", "instance"], "left_anti")
        trusted = stored(seeds.unionByName(promoted), "trusted-instances")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2,
                       min_score: float = 0.8, min_support: int = 3) -> DataFrame:
    """doc_id and spans (kind, start, end, found_by) of every document, base and discovered ones.

    Spans are in code points, end exclusive, in order of kind (``KINDS``)
    and start; found_by is base or context. A discovered span overlaps no
    base span, and of a run of groups and a token in it only the run is
    given. Base matches that fail their kind's check are dropped and
    not searched again. Tokens of any length are instances.

    A null text is empty. Rows that repeat both id and text get the same
    spans. No documents give an empty result. Extra columns are ignored,
    whatever their names.
    """
    facts = stored(_facts(docs, id_col, text_col), "identifiers")
    # of a kind's spans none overlaps another
    by_kind = {f"base_{k}": F.filter("base", lambda b: b["kind"] == KINDS.index(k)) for k in KINDS}

    def occurrence(t: Column) -> Column:
        kind = F.coalesce(*(F.when(_overlapped(F.col(f"base_{k}"), t["start"], t["end"]), F.lit(i)) for i, k in enumerate(KINDS)))
        return F.struct(*(t[c].alias(c) for c in ("start", "end", "instance", "pattern")), kind.alias("kind"))

    def marked_base(name: str) -> Column:
        return F.transform(name, occurrence)

    # a run that holds a base match and more is no identifier; a match that is a token, too, is one occurrence
    runs = F.filter(marked_base("groups"), lambda t: t["kind"].isNull())
    def marked(spans: Column, run: bool) -> Column:
        return F.transform(spans, lambda t: F.struct(*(t[c].alias(c) for c in ("start", "end", "instance", "pattern", "kind")),
                                                     F.lit(run).alias("run")))

    every = F.concat(marked(marked_base("tokens"), False), marked(marked_base("matches"), False), marked(runs, True))
    seen = stored(facts.withColumns(by_kind).select("key", F.explode(every).alias("t")).select("key", "t.*").distinct(), "occurrences")
    sure = (accepted_patterns(seen, rounds, min_score, min_support).groupBy("pattern").agg(F.max(F.struct("score", "support", (-F.col("kind")).alias("k"))).alias("s"))
            .select("pattern", (-F.col("s.k")).alias("found")))
    new = (seen.filter("kind is null").join(sure.hint("merge"), "pattern")
           .groupBy("key").agg(*(F.array_sort(F.collect_set(F.when(c, F.struct("start", "end", F.col("found").alias("kind"))))).alias(n)
                                 for n, c in (("runs", F.col("run")), ("single", ~F.col("run")))))
           .select("key", F.concat("runs", F.filter("single", lambda x: ~_overlapped(F.col("runs"), x["start"], x["end"]))).alias("new")))
    both = F.concat(F.transform("base", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                                                           F.lit("base").alias("found_by"))),
                    F.coalesce(F.transform("new", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"),
                                                                     x["end"].alias("end"), F.lit("context").alias("found_by"))),
                               F.array().cast("array<struct<kind:int,start:bigint,end:bigint,found_by:string>>")))
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return facts.join(new.hint("merge"), "key", "left").select("doc_id", F.transform(F.array_sort(both), lambda x: F.struct(
        F.element_at(kinds, x["kind"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
        x["found_by"].alias("found_by"))).alias("spans"))
