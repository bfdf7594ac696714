"""Polymorphic values kept whole and typed.

:func:`layerkit.operators.columns.split_by_tag` types numbers and texts;
values of other tags have no column there. Here each value is also kept in
one VARIANT column, typed by its tag: JSON documents by their own structure,
dates as dates, unknown tags as text. Types come back on reading: by path
and type, or by the schema merged over all values.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import col_of
from .columns import split_by_tag

JSON = "json"


def as_variant(value: Column, kind: str) -> Column:
    """Text as a variant of type ``kind`` (a Spark type or ``json``); null where it is no such value."""
    if kind == JSON:
        return F.try_parse_json(value)
    return value.try_cast(kind).cast("variant")


def typed_values(df: DataFrame, value: str, tag: str, kinds: dict[str, str], numeric_tag: str = "numeric", text_tag: str = "text",
                 numeric_col: str = "numeric_value", text_col: str = "text_value", variant_col: str = "typed_value",
                 typed_col: str = "is_typed", keep_value: bool = False) -> DataFrame:
    """Numeric and text columns as ``split_by_tag`` gives them, and every value as a variant.

    ``kinds`` maps tags to a type (``boolean``, ``bigint``, ``decimal(p,s)``,
    ``date``, ``timestamp`` ...) or ``json``; ``numeric_tag`` is a double and
    ``text_tag`` a string unless it says otherwise. A value that is not of
    its tag's type, and one whose tag is null or not listed, is kept as
    text: no value is lost, and ``typed_col`` tells the former (false) from
    values of their type (true); it is null for null values and for tags
    without a type. A null value is null (JSON's own ``null`` is a value).
    A text over Spark's limit for one variant fails the query.
    """
    kinds = {numeric_tag: "double", text_tag: "string"} | kinds
    v, t = col_of(value).cast("string"), col_of(tag)
    # the texts of a tag alone are parsed as its type
    typed = F.coalesce(*(as_variant(F.when(t == F.lit(k), v), kind) for k, kind in kinds.items()))
    cols = {variant_col: F.coalesce(typed, v.cast("variant")),
            typed_col: F.when(v.isNotNull() & t.isin(*kinds), typed.isNotNull())}
    out = split_by_tag(df.withColumns(cols), value, tag, numeric_tag, text_tag, numeric_col, text_col, keep_value=True)
    return out if keep_value else out.drop(value)


def extract(df: DataFrame, paths: dict[str, tuple[str, str]], variant_col: str = "typed_value") -> DataFrame:
    """Columns (name → path, type) read out of the variant; null where the path is missing or not of the type."""
    return df.withColumns({name: F.try_variant_get(col_of(variant_col), path, kind) for name, (path, kind) in paths.items()})


def merged_schemas(df: DataFrame, variant_col: str = "typed_value", by: str | None = None) -> DataFrame:
    """The least schema that holds all values, over the table or for each value of ``by``, as text.

    One grouped aggregate, combined before the shuffle.
    """
    schema = F.schema_of_variant_agg(col_of(variant_col)).alias("schema")
    return df.groupBy(by).agg(schema) if by else df.agg(schema)


def as_type(schema: str) -> str:
    """A merged schema as a Spark type; what has no common type stays a variant, what is always null is text.

    Quoted field names are left as they are.
    """
    parts = re.split(r"(`(?:[^`]|``)*`)", schema)
    return "".join(p if i % 2 else re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT<", "STRUCT<", p)) for i, p in enumerate(parts))


def read_merged(df: DataFrame, name: str, variant_col: str = "typed_value", schema: str | None = None) -> DataFrame:
    """The variant as a column of the type merged over all its values (one scan more, unless ``schema`` is given).

    Fields that a value lacks are null. With ``schema`` from elsewhere (an
    earlier batch), values that do not fit it are null.
    """
    if schema is None:
        schema = merged_schemas(df, variant_col).first()["schema"]
    kind = as_type(schema)
    c = col_of(variant_col)
    if kind in ("VARIANT", "STRUCT<>"):
        return df.withColumn(name, c)
    return df.withColumn(name, F.try_variant_get(c, "$", kind))
