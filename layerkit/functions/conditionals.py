"""Decodes, flags and predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import col_of


def decode(c, mapping: dict, default=None) -> Column:
    """Map code values to labels; unknown or NULL → ``default``.

    Built as one CASE expression from the dict, so it stays in codegen.
    """
    c = col_of(c)
    expr = None
    for code, label in mapping.items():
        expr = (F.when(c == F.lit(code), F.lit(label)) if expr is None
                else expr.when(c == F.lit(code), F.lit(label)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def flag(predicate: Column) -> Column:
    """Boolean flag from a predicate; NULL (unknown) becomes FALSE."""
    return F.coalesce(predicate, F.lit(False))


def is_present(c) -> Column:
    """F3 as a flag: TRUE when the value is not NULL."""
    return col_of(c).isNotNull()


def full_match(c, pattern: str) -> Column:
    """whole-string regex match.

    Java's ``$`` also matches before a trailing newline, so anchors are
    ``\\A`` and ``\\z`` — the value must match exactly, nothing after.
    """
    return col_of(c).rlike(r"\A(?:" + pattern + r")\z")


def at_most(c, limit) -> Column:
    """threshold flag ``c <= limit``; NULL → FALSE."""
    return flag(col_of(c) <= F.lit(limit))
