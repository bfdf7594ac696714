"""Surrogate keys (KEY1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import col_of


def key_text(cols, sep: str = "_", null_token: str | None = None) -> Column:
    """What :func:`surrogate_key` digests: rows share a key when these texts are equal."""
    parts = [col_of(c).cast("string") for c in cols]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.concat_ws(sep, *parts)


def surrogate_key(cols, sep: str = "_", null_token: str | None = None) -> Column:
    """md5 over the key parts joined by ``sep``.

    Default (``null_token=None``) keeps ``concat_ws`` semantics: NULL parts
    are skipped, so (a, NULL, b) and (a, b) share a key. Pass a token
    (e.g. ``"\\N"``) for the collision-safe form where every part keeps its
    position.
    """
    return F.md5(key_text(cols, sep, null_token))
