"""De-duplication and ordered previews.

``keep_latest`` is ``row_number() = 1`` over the key. Spark plans that
as a *partial* ``WindowGroupLimit`` before the shuffle and a final one
after it, so each map task forwards at most one row per key: a key that
holds a third of all rows costs one row per map task in the shuffle,
not a third of the data in one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from ..functions.casts import col_of

_RANK = "__lk_rank"


def _orderable(df: DataFrame, exclude) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if f.name not in ex and not isinstance(f.dataType, (MapType, VariantType))
            and "map<" not in f.dataType.simpleString()]


def _desc(c) -> Column:
    return c if isinstance(c, Column) else F.col(c).desc_nulls_last()


def keep_latest(df: DataFrame, keys, by, tiebreak=None) -> DataFrame:
    """One row per key — the one with the greatest ``by`` values.

    ``by``       names (descending, NULLs last) or explicit sort Columns
    ``tiebreak`` further columns (descending, NULLs last) used when ``by``
                 ties; default: every other orderable column, so the
                 survivor does not depend on input order.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    by = [by] if isinstance(by, (str, Column)) else list(by)
    if tiebreak is None:
        named = keys + [b for b in by if isinstance(b, str)]
        tiebreak = _orderable(df, named)
    order = [_desc(b) for b in by] + [_desc(t) for t in tiebreak]
    w = Window.partitionBy(*[col_of(k) for k in keys]).orderBy(*order)
    return (df.withColumn(_RANK, F.row_number().over(w))
              .filter(F.col(_RANK) == 1)
              .drop(_RANK))


def distinct_on(df: DataFrame, keys) -> DataFrame:
    """An arbitrary survivor per key (``dropDuplicates``).

    The hash aggregate behind it combines map-side, so hot keys are
    reduced before the shuffle. Which row survives is not defined.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.dropDuplicates(keys)


def preview(df: DataFrame, order, n: int = 20) -> DataFrame:
    """O2/K9: first ``n`` rows in a given order (a top-k: each task keeps n)."""
    order = [order] if isinstance(order, (str, Column)) else list(order)
    return df.orderBy(*order).limit(n)
