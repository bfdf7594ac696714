"""Date and money derivations (DER1–DER7, X-date*, X-math*)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import col_of


def as_of_date(as_of=None) -> Column:
    """The reference day: a fixed date for repeatable runs, else today."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def age_from_date(birth, as_of=None, mode: str = "days365") -> Column:
    """DER1: age in whole years.

    ``days365``  days between the dates ÷ 365, truncated (the original rule;
                 it overstates age just before a birthday)
    ``calendar`` completed calendar years (year difference, minus one while
                 the birthday has not yet come in the reference year)
    """
    ref = as_of_date(as_of)
    birth = F.to_date(col_of(birth))
    if mode == "days365":
        return (F.datediff(ref, birth) / F.lit(365)).cast("int")
    if mode == "calendar":
        before = (F.month(ref) < F.month(birth)) | (
            (F.month(ref) == F.month(birth)) & (F.dayofmonth(ref) < F.dayofmonth(birth)))
        return F.year(ref) - F.year(birth) - F.when(before, 1).otherwise(0)
    raise ValueError(f"unknown age mode {mode!r}")


def age_from_year(birth_year, as_of=None) -> Column:
    """DER2: calendar year of the reference day minus a birth year."""
    return F.year(as_of_date(as_of)) - col_of(birth_year)


def minutes_between(start, end) -> Column:
    """DER3: whole minutes from start to end, truncated toward zero.

    64-bit, so a far-future end (``9999-12-31``) is a long span and not an
    overflow.
    """
    secs = F.unix_timestamp(col_of(end)) - F.unix_timestamp(col_of(start))
    return (secs / F.lit(60)).cast("bigint")


def days_between(start, end) -> Column:
    """DER7 / X-date3: calendar days from start to end (dates of timestamps)."""
    return F.datediff(col_of(end), col_of(start))


def year_month(df, c, prefix: str, month: bool = True):
    """DER4: add ``{prefix}_year`` (and ``{prefix}_month``) partition columns."""
    cols = {f"{prefix}_year": F.year(col_of(c))}
    if month:
        cols[f"{prefix}_month"] = F.month(col_of(c))
    return df.withColumns(cols)


def difference(a, b) -> Column:
    """DER5: a − b (decimal inputs widen by one digit, e.g. (10,2) → (11,2))."""
    return col_of(a) - col_of(b)


def prefix(c, n: int = 1) -> Column:
    """DER6: first ``n`` characters."""
    return F.substring(col_of(c), 1, n)
