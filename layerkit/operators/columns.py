"""Column-level DataFrame operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import col_of


def normalise(df: DataFrame, rename: dict | None = None, drop=(),
              lower: bool = True) -> DataFrame:
    """Lower-case names, rename, drop — one projection.

    Raises when two source columns collide after lower-casing (the
    positional ``toDF`` form silently produces duplicates). A rename whose
    source is absent is a no-op, as with ``withColumnsRenamed``.
    """
    rename = rename or {}
    drop = {d.lower() if lower else d for d in drop}
    names = [c.lower() if lower else c for c in df.columns]
    seen = {}
    for src, dst in zip(df.columns, names):
        if dst in seen:
            raise ValueError(f"columns {seen[dst]!r} and {src!r} collide as {dst!r}")
        seen[dst] = src
    targets = []
    for dst in names:
        out = rename.get(dst, dst)
        if dst in drop or out in drop:
            continue
        targets.append((dst, out))
    outs = [o for _, o in targets]
    dup = {o for o in outs if outs.count(o) > 1}
    if dup:
        raise ValueError(f"rename produces duplicate columns {sorted(dup)}")
    by_lower = dict(zip(names, df.columns))
    return df.select(*[F.col(f"`{by_lower[d]}`").alias(o) for d, o in targets])


def stamp(df: DataFrame, time_col: str, source_col: str | None = None,
          source: str | None = None, file_path: bool = False) -> DataFrame:
    """Audit columns — processing time and (optionally) source label.

    ``file_path=True`` records each row's own file (``_metadata.file_path``)
    instead of a constant, which is what a multi-file glob needs.
    """
    cols = {time_col: F.current_timestamp()}
    if source_col:
        if file_path:
            cols[source_col] = F.col("_metadata.file_path")
        else:
            cols[source_col] = F.lit(source)
    return df.withColumns(cols)


def split_by_tag(df: DataFrame, value: str, tag: str, numeric_tag: str = "numeric",
                 text_tag: str = "text", numeric_col: str = "numeric_value",
                 text_col: str = "text_value", keep_value: bool = False) -> DataFrame:
    """Split a polymorphic text column into a number and a text column.

    Rows tagged ``numeric_tag`` get a (null-tolerant) double; rows tagged
    ``text_tag`` keep the text; any other tag leaves both NULL. The source
    column is dropped unless ``keep_value``.
    """
    v, t = col_of(value), col_of(tag)
    out = df.withColumns({
        numeric_col: F.when(t == F.lit(numeric_tag), v.cast("string").try_cast("double")),
        text_col: F.when(t == F.lit(text_tag), v.cast("string")),
    })
    return out if keep_value else out.drop(value)
