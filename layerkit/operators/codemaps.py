"""Mapping between code systems (E3): by longest prefix and by interval.

A lookup of equal codes (:func:`~layerkit.operators.joins.lookup`) cannot
say "D50 to D89 is blood, C00 to D48 is neoplasms", or "the longest listed
prefix decides". Both are done with equi-joins alone:

* longest prefix: a code is cut to the lengths that the table has, and each
  cut looked up;
* intervals: an interval of whole numbers is the union of at most two
  aligned blocks of each size 2^k, at most 2 x 63 in all; a number lies in
  exactly one block of each size. So an interval becomes a few (k, block)
  rows, a number becomes one (k, block) for each size that the table has,
  and equality of both says that it is inside - no residual condition and
  no nested loop, however wide intervals are or how they overlap.

The work is done once for each distinct code, and the result is joined back
by equality: a code that a third of all rows have costs one row for each task
in the search, and its rows meet one small row afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: 37 ** 12 is below 2 ** 63.
MOST_CHARACTERS = 12
_LEVELS = 63


def code_text(code: str | Column) -> Column:
    """A code without dots, dashes and blanks, upper-cased: ``e11.9`` and ``E119`` are one code."""
    c = F.col(code) if isinstance(code, str) else code
    return F.upper(F.regexp_replace(c.cast("string"), "[.\\- ]", ""))


def code_number(code: str | Column, characters: int = 8, end: bool = False) -> Column:
    """A number that orders codes of letters and digits as text; null for other codes and empty ones.

    The first ``characters`` count. A shorter code stands for its first
    continuation, with ``end`` for its last, so that ``E14`` as the end of
    an interval holds ``E14.9``.
    """
    if not 1 <= characters <= MOST_CHARACTERS:
        raise ValueError(f"1 to {MOST_CHARACTERS} characters")
    text = code_text(code)
    number = F.lit(0).cast("long")
    for i in range(1, characters + 1):
        digit = F.instr(F.lit(ALPHABET), F.substring(text, i, 1)).cast("long")
        # a substring beyond the end is empty, and an empty text is found at 1
        digit = F.when(F.length(text) >= i, digit).otherwise(F.lit(len(ALPHABET) if end else 0).cast("long"))
        number = number * (len(ALPHABET) + 1) + digit
    return F.when(text.rlike(r"\A[0-9A-Z]+\z"), number)


def _values(values) -> list[str]:
    return [values] if isinstance(values, str) else list(values)


def _joined_back(df: DataFrame, code: str, found: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with the columns ``names`` of ``found`` (one row for each ``__code``)."""
    taken = set(names) & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are there already")
    return df.join(found, df[code] == found["__code"], "left").select(*[df[c] for c in df.columns], *names)


def map_by_prefix(df: DataFrame, code: str, table: DataFrame, prefix: str, values, matched: str = "matched_prefix") -> DataFrame:
    """``df`` with the ``values`` columns of the longest ``prefix`` that its ``code`` begins with.

    Codes and prefixes are compared as they are (see :func:`code_text` for a
    common spelling). The prefix found comes as ``matched``; without one, or
    for a null code, all are null. The empty prefix matches every code. Rows
    of the table with a null prefix are ignored; of rows with the same
    prefix the least values win. Rows of ``df`` are kept as they are.
    """
    values = _values(values)
    listed = (table.filter(F.col(prefix).isNotNull()).groupBy(F.col(prefix).alias("__prefix"))
              .agg(F.min(F.struct(*[F.col(v) for v in values])).alias("__v")))
    lengths = sorted(r[0] for r in listed.select(F.length("__prefix")).distinct().collect())  # as many as there are lengths
    codes = df.select(F.col(code).alias("__code")).filter(F.col("__code").isNotNull()).distinct()
    fitting = [F.when(F.length("__code") >= n, F.substring("__code", 1, n)) for n in lengths]
    cuts = F.filter(F.array(*fitting), lambda x: x.isNotNull()) if lengths else F.array().cast("array<string>")
    found = (codes.select("__code", F.explode(cuts).alias("__prefix")).join(listed, "__prefix")
             .groupBy("__code").agg(F.max_by(F.struct("__prefix", "__v"), F.length("__prefix")).alias("__best")))
    found = found.select("__code", F.col("__best.__prefix").alias(matched), *[F.col(f"__best.__v.{v}").alias(v) for v in values])
    return _joined_back(df, code, found, [matched, *values])


def interval_blocks(low: Column, high: Column) -> Column:
    """The aligned blocks (level, block) whose union is the whole numbers from ``low`` to ``high``, both at least 0.

    At level k, blocks of 2^k: what remains of the interval after the lower
    levels begins at ceil(low / 2^k) and ends before floor((high + 1) / 2^k);
    an odd begin and an odd end stand alone there, all else goes up.
    """
    def at(level: Column) -> Column:
        k = level.cast("int")
        begin = F.call_function("shiftright", low + F.call_function("shiftleft", F.lit(1).cast("long"), k) - 1, k)
        end = F.call_function("shiftright", high + 1, k)
        block = lambda b: F.struct(k.alias("level"), b.alias("block"))
        first = F.when((begin < end) & (begin % 2 == 1), F.array(block(begin))).otherwise(F.array().cast("array<struct<level:int,block:bigint>>"))
        last = F.when((begin < end) & (end % 2 == 1), F.array(block(end - 1))).otherwise(F.array().cast("array<struct<level:int,block:bigint>>"))
        return F.concat(first, last)

    # levels above the interval's own size have nothing
    top = F.least(F.lit(_LEVELS - 2), F.ceil(F.log2((high - low + 2).cast("double"))).cast("int") + 1)
    return F.flatten(F.transform(F.sequence(F.lit(0), top), at))


def match_numbers(points: DataFrame, table: DataFrame, number: str, low: str, high: str, values) -> DataFrame:
    """(number, low, high, values) of the narrowest interval that holds each distinct number of ``points``.

    Intervals hold both ends. Of equally narrow ones the one with the
    greatest low wins, then the least values. Intervals with a null end, a
    negative end or low above high are ignored, as are null and negative
    numbers; numbers in no interval have no row. Ends up to 2^61.
    """
    values = _values(values)
    lo, hi = F.col("__low"), F.col("__high")
    listed = (table.select(F.col(low).cast("long").alias("__low"), F.col(high).cast("long").alias("__high"), *values)
              .filter((lo >= 0) & (lo <= hi) & (hi < 1 << 61)))
    blocks = listed.withColumn("__b", F.explode(interval_blocks(lo, hi))).select(
        F.col("__b.level").alias("__level"), F.col("__b.block").alias("__block"),
        F.struct((hi - lo).alias("span"), (-lo).alias("low"), *values).alias("__v"))
    # of intervals that share a block only the best counts there, so that a point meets one row at each level
    best = blocks.groupBy("__level", "__block").agg(F.min("__v").alias("__v"))
    levels = sorted(r[0] for r in best.select("__level").distinct().collect())  # at most 62
    n = F.col("__number")
    places = [F.struct(F.lit(k).alias("level"), F.call_function("shiftright", n, F.lit(k)).alias("block")) for k in levels]
    places = F.array(*places) if places else F.array().cast("array<struct<level:int,block:bigint>>")
    distinct = points.select(F.col(number).cast("long").alias("__number")).filter(n >= 0).distinct()
    met = distinct.withColumn("__p", F.explode(places)).select("__number", F.col("__p.level").alias("__level"), F.col("__p.block").alias("__block"))
    found = met.join(best, ["__level", "__block"]).groupBy("__number").agg(F.min("__v").alias("__v"))
    return found.select(n.alias(number), (-F.col("__v.low")).alias(low), (F.col("__v.span") - F.col("__v.low")).alias(high),
                        *[F.col(f"__v.{v}").alias(v) for v in values])


def map_by_number(df: DataFrame, number: str, table: DataFrame, low: str, high: str, values) -> DataFrame:
    """``df`` with the ``values`` of the narrowest interval of whole numbers that holds ``number`` (see :func:`match_numbers`)."""
    values = _values(values)
    found = match_numbers(df, table, number, low, high, values).select(F.col(number).alias("__code"), *values)
    return _joined_back(df, number, found, values)


def map_by_interval(df: DataFrame, code: str, table: DataFrame, low: str, high: str, values, characters: int = 8) -> DataFrame:
    """``df`` with the ``values`` of the narrowest interval of codes that holds its ``code``.

    Codes are letters and digits (dots, dashes and blanks are left out, case
    does not count). Both ends are inclusive with all their continuations:
    ``C00`` to ``D48`` holds ``D48.9``. Narrower is fewer codes of
    ``characters`` characters; then the greater low, then the least values
    win. A null or other code, and one in a gap, gets nulls. Ends that are
    null, no codes, or the wrong way round are ignored; ends longer than
    ``characters`` are refused.
    """
    values = _values(values)
    long_ends = table.filter((F.length(code_text(low)) > characters) | (F.length(code_text(high)) > characters))
    if not long_ends.isEmpty():
        raise ValueError(f"interval ends of more than {characters} characters")
    numbered = table.select(code_number(low, characters).alias("__from"), code_number(high, characters, end=True).alias("__to"), *values)
    # the number hangs on the count, so that filters on it stay above the aggregate: once for each code, not for each row
    codes = df.groupBy(F.col(code).alias("__code")).agg(F.count(F.lit(1)).alias("__rows"))
    codes = codes.select("__code", F.when(F.col("__rows") > 0, code_number("__code", characters)).alias("__n"))
    found = match_numbers(codes, numbered, "__n", "__from", "__to", values)
    found = codes.join(found, "__n").select("__code", *values)
    return _joined_back(df, code, found, values)
