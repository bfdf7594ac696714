"""Mixing sources to target weights by iterative proportional fitting.

The documents' tokens are summed into cells (source, language, topic). The
cells' weights are raked: scaled to the target share of every source, then
of every language, then of every topic, again and again until all three
marginals hold. A cell's weight over its tokens is its rate: how often each
of its tokens should be used per token of the mix. The rates, scaled to the
wanted size, are the documents' sampling probabilities.

The cells are a small table however many documents there are (sources
times languages times topics that occur); a sweep is three windowed sums
over it. Sweeps are stored in the shared folder one by one, so a lost
executor repeats one sweep. All is DataFrame work.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_of

MARGINS = ("source", "lang", "topic")
#: ``{REST: OWN_SHARE}`` among the targets of a margin: values that are not listed keep their own share of the tokens.
REST, OWN_SHARE = "*", "own share"


def token_count(text: Column) -> Column:
    """Words between blanks; a text has at least one token."""
    t = text_of(text)
    return (F.lit(1) + F.octet_length(t) - F.octet_length(F.translate(t, " ", ""))).cast("long")


def _target(margin: str, targets: Mapping[str, float] | None) -> Column:
    """A value's target share, null for a value that keeps its own; without targets all values that occur count alike."""
    if targets is None:
        return F.lit(1.0)
    pairs = [x for k, v in targets.items() if k != REST for x in (F.lit(k), F.lit(float(v)))]
    listed = F.try_element_at(F.create_map(*pairs), F.col(margin)) if pairs else F.lit(None).cast("double")
    return listed if targets.get(REST) == OWN_SHARE else F.coalesce(listed, F.lit(0.0))


def rake(cells: DataFrame, targets: Mapping[str, Mapping[str, float | str] | None], sweeps: int = 30,
         tolerance: float = 1e-9) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight``: shares that meet the targets.

    Targets of one margin are divided by their sum over the values that
    occur. Values without a target (null is one of them) get weight 0, or,
    with ``REST`` among the targets, keep their own share, and the targets
    share out what is left. It ends after ``sweeps`` sweeps or when no
    marginal is off by more than ``tolerance``; targets that contradict each
    other stop at ``sweeps``, with the topic marginal met.
    """
    everything = Window.partitionBy(F.lit(0))
    now = cells.withColumn("weight", F.col("tokens") / F.sum("tokens").over(everything))
    for m in MARGINS:
        # every value once
        values = cells.groupBy(m).agg(F.sum("tokens").alias("held")).withColumn("target", _target(m, targets.get(m)))
        own = F.when(F.col("target").isNull(), F.col("held") / F.sum("held").over(everything))
        values = values.withColumn("own", own).withColumn(
            "want", F.coalesce("own", F.col("target") / F.sum("target").over(everything) * (1 - F.coalesce(F.sum("own").over(everything), F.lit(0.0)))))
        now = now.join(values.select(F.col(m).alias("value"), F.col("want").alias(f"want_{m}")),
                       F.col(m).eqNullSafe(F.col("value")), "left").drop("value")
    now = stored(now, "raked-cells")
    for _ in range(sweeps):
        for m in MARGINS:
            held = F.sum("weight").over(Window.partitionBy(m))
            now = now.withColumn("weight", F.when(held > 0, F.col("weight") * F.col(f"want_{m}") / held).otherwise(0.0))
        now = stored(now, "raked-cells")
        gaps = now.select(*(F.abs(F.sum("weight").over(Window.partitionBy(m)) - F.col(f"want_{m}")).alias(f"off_{m}")
                            for m in MARGINS))
        if not any((x or 0) > tolerance for x in gaps.agg(*(F.max(f"off_{m}") for m in MARGINS)).first()):
            break
    return now.drop(*(f"want_{m}" for m in MARGINS))


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the MD5 of the key and the seed."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def lexicon_topic(text: Column, lexicons: Mapping[str, str], none: str = "other") -> Column:
    """The topic whose expression matches most often (ties: the first listed), ``none`` without a match."""
    counts = [(name, F.regexp_count(text_of(text), F.lit(pattern))) for name, pattern in lexicons.items()]
    most = F.greatest(*(n for _, n in counts), F.lit(0))
    out = F.lit(none)
    for name, n in reversed(counts):
        out = F.when((n == most) & (n > 0), F.lit(name)).otherwise(out)
    return out


def mix_documents(docs: DataFrame, targets: Mapping[str, Mapping[str, float] | None], lexicons: Mapping[str, str],
                  size: float = 0.5, sweeps: int = 30, tolerance: float = 1e-9, seed: int = 8, id_col: str = "doc_id",
                  text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """doc_id, source, lang, topic, tokens, epochs and copies for every document.

    ``targets`` maps source, lang and topic to target shares by value, or to
    None for equal shares. ``size`` is the size of the mix as a share of all
    tokens. ``epochs`` is a document's expected number of uses; below 1 it is
    the probability that the document is in the sample. ``copies`` is drawn
    from it: the whole part, and one more with the probability of the rest.

    A null text is one token; null sources, languages or topics are a value
    of their own. Rows with one doc_id share the random number. No documents
    give an empty result. Extra columns are ignored, whatever their names.
    """
    facts = stored(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(lang_col).cast("string").alias("lang"),
        lexicon_topic(F.col(text_col), lexicons).alias("topic"), token_count(F.col(text_col)).alias("tokens")), "document-cells")
    rates = cell_rates(facts, targets, size, sweeps, tolerance)
    return facts.join(rates, _same_cell(), "left").select("doc_id", *MARGINS, "tokens", "epochs", _copies(F.col("doc_id"), seed))


def cell_rates(facts: DataFrame, targets: Mapping[str, Mapping[str, float] | None], size: float, sweeps: int,
               tolerance: float) -> DataFrame:
    """``epochs`` of every cell (cell_source, cell_lang, cell_topic) of ``facts`` (source, lang, topic, tokens)."""
    cells = facts.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    raked = rake(cells, targets, sweeps, tolerance)
    everything = Window.partitionBy(F.lit(0))
    return raked.select(*(F.col(m).alias(f"cell_{m}") for m in MARGINS),
                        (F.col("weight") * F.lit(float(size)) * F.sum("tokens").over(everything) / F.col("tokens")).alias("epochs"))


def _same_cell() -> Column:
    """Whether a row is of a cell."""
    same = F.lit(True)
    for m in MARGINS:
        same = same & F.col(m).eqNullSafe(F.col(f"cell_{m}"))
    return same


def _copies(doc_id: Column, seed: int) -> Column:
    return F.floor(F.col("epochs") + uniform(doc_id, seed)).cast("long").alias("copies")


def repeat_documents(docs: DataFrame, targets: Mapping[str, Mapping[str, float] | None], lexicons: Mapping[str, str],
                     size: float = 0.5, sweeps: int = 30, tolerance: float = 1e-9, seed: int = 8) -> DataFrame:
    """The mix itself: every row of ``docs`` (doc_id, text, source, lang and others) ``copies`` times.

    The copies are those of ``mix_documents`` with the same arguments. Rows
    meet the small table of cells, not each other, so repeated and null ids
    are decided row by row. A row travels as one nested value, so columns
    may have any names. Texts are searched for topics once, whatever their
    length.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = stored(docs.select(row, F.col("doc_id").alias("doc_id"), F.col("source").cast("string").alias("source"),
                              F.col("lang").cast("string").alias("lang"), lexicon_topic(F.col("text"), lexicons).alias("topic"),
                              token_count(F.col("text")).alias("tokens")), "document-cells")
    rates = cell_rates(rows.select(*MARGINS, "tokens"), targets, size, sweeps, tolerance)
    drawn = rows.drop("tokens").join(rates, _same_cell(), "left").select("row", _copies(F.col("doc_id"), seed)).filter("copies > 0")
    return drawn.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).select("row.*")
