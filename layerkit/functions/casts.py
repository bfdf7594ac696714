"""Null-tolerant casts (C4–C11).

Spark 4 runs with ANSI mode on, where one malformed string fails the
whole job. Raw tables are untyped text, so every cast here is a
``try_*`` form: bad input becomes NULL instead of an exception, and the
expression stays inside whole-stage codegen (no Python).
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

ColumnLike = "Column | str"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_token(c, tokens: Iterable[str] = ("-",)) -> Column:
    """C4: map sentinel strings (default ``-``) to NULL before a cast."""
    c = col_of(c)
    tokens = list(tokens)
    if not tokens:
        return c
    return F.when(c.isin(tokens), F.lit(None)).otherwise(c)


def try_cast(c, to: str | DataType) -> Column:
    """Cast that yields NULL for malformed input."""
    return col_of(c).try_cast(to)


def lenient_int(c, via: DecimalType = DecimalType(38, 10)) -> Column:
    """C8/C9 for text that may carry a fraction (``"1.9"`` → 1).

    ANSI integer casts reject fractional text, and a failed ``try_cast`` is
    some twenty times as dear as one that works. So plain decimal text is told by one
    expression and cast up to its point, which loses the fraction as text,
    so no digit is ever rounded (``"1.99999"`` → 1, ``"-0.99996"`` → 0). Other
    notations (``"1e3"``) go through ``via`` and truncate toward zero. Junk
    and out-of-range values become NULL.
    """
    text = F.trim(col_of(c).cast("string"))
    whole = F.substring_index(text, ".", 1)
    return F.when(text.rlike(r"^[+-]?(?:\d+\.?\d*|\.\d+)$"), F.when(whole.isin("", "+", "-"), F.lit(0)).otherwise(whole.try_cast("int"))) \
            .otherwise(text.try_cast(via).try_cast("int"))


def truncate_int(c) -> Column:
    """Numeric → int, truncating toward zero (NULL on overflow)."""
    return col_of(c).try_cast("int")


def parse_timestamp(c, fmt: str, ntz: bool = False) -> Column:
    """Text → timestamp by pattern; NULL when the text does not match.

    ``ntz=False`` gives a session-zone ``timestamp``: a pattern that quotes a
    literal ``Z`` is then read in the session zone, so sessions built by
    :func:`layerkit.session.get_session` pin UTC. ``ntz=True`` gives the
    wall clock as written (``timestamp_ntz``), independent of the session
    zone and of its daylight-saving gaps. The text is validated with the
    null-tolerant parser first; the exact parser only sees rows that parse.
    """
    c = col_of(c)
    checked = F.try_to_timestamp(c, F.lit(fmt))
    if not ntz:
        return checked
    return F.when(checked.isNotNull(), F.to_timestamp_ntz(c, F.lit(fmt)))


def to_date(c) -> Column:
    """C11: timestamp (or text) → date."""
    return F.to_date(col_of(c))


def cast_expressions(types: dict, null_tokens: dict | None = None, formats: dict | None = None) -> dict:
    """Column → null-tolerant typed expression (see :func:`cast_columns`)."""
    null_tokens = null_tokens or {}
    formats = formats or {}
    out = {}
    for name, typ in types.items():
        c = null_if_token(name, null_tokens.get(name, ()))
        if name in formats:
            out[name] = parse_timestamp(c, formats[name], ntz=(typ == "timestamp_ntz"))
        elif typ in ("int", "integer"):
            out[name] = lenient_int(c)
        else:
            out[name] = try_cast(c, typ)
    for name, fmt in formats.items():
        if name not in out:
            out[name] = parse_timestamp(null_if_token(name, null_tokens.get(name, ())), fmt)
    return out


def cast_columns(df, types: dict, null_tokens: dict | None = None,
                 formats: dict | None = None):
    """Apply many null-tolerant casts in one projection.

    ``types``       column → Spark type (name or ``DataType``)
    ``null_tokens`` column → sentinel strings mapped to NULL first (C4)
    ``formats``     column → timestamp pattern (C6); type is then implied
                    (``timestamp``; ``timestamp_ntz`` when ``types`` says so)
    ``int`` targets go through :func:`lenient_int` so ``"1.9"`` → 1.
    """
    out = cast_expressions(types, null_tokens, formats)
    return df.withColumns(out) if out else df
