"""Tables whose column types widen (K5): recorded versions, recast on read.

A parquet table holds its files' types; appending 1.75 to an int column by a
cast stores 1. Here a batch with a wider type starts a new version: the
least common type of table and batch is worked out column by column, nested
fields too; a part table of that schema takes the batch, and the part
tables of earlier versions stay as they are. Reading casts each version's rows up to the
last schema (columns that a version lacks are null). No file is rewritten.

The order of types::

    tinyint -> smallint -> int -> bigint -> decimal -> double    float -> double
    date -> timestamp_ntz      anything -> string is *not* done: text is no wider number

Casts keep every value, but for bigint and decimal to double beyond some 15
digits. Those are checked: the values that are there must come back the same
from the double, or the append fails and says how many would not. Decimals
that would need more than 38 digits are refused.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
                               MapType, NullType, ShortType, StructField, StructType, TimestampNTZType)

from .tables import write_table

_WHOLE = [(ByteType, 3), (ShortType, 5), (IntegerType, 10), (LongType, 19)]


class IllegalChange(ValueError):
    """A batch's types have no common type with the table's, or would lose values."""


def _digits(t: DataType) -> int | None:
    return next((d for k, d in _WHOLE if isinstance(t, k)), None)


def least_common_type(a: DataType, b: DataType, where: str = "") -> DataType:
    """The narrowest type that both can be cast up to; raises :class:`IllegalChange` without one."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged_schema(a, b, where)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(least_common_type(a.elementType, b.elementType, f"{where}[]"), True)
    if isinstance(a, MapType) and isinstance(b, MapType) and a.keyType == b.keyType:
        return MapType(a.keyType, least_common_type(a.valueType, b.valueType, f"{where}{{}}"), True)
    da, db = _digits(a), _digits(b)
    if da and db:
        return a if da >= db else b
    decimals = [t if isinstance(t, DecimalType) else DecimalType(d, 0) for t, d in ((a, da), (b, db)) if isinstance(t, DecimalType) or d]
    if len(decimals) == 2:
        scale, whole = max(t.scale for t in decimals), max(t.precision - t.scale for t in decimals)
        if scale + whole > 38:
            raise IllegalChange(f"{where}: {a.simpleString()} and {b.simpleString()} need {scale + whole} digits")
        return DecimalType(scale + whole, scale)
    floats, numbers = (DoubleType, FloatType), (DoubleType, FloatType, DecimalType, *(k for k, _ in _WHOLE))
    if isinstance(a, numbers) and isinstance(b, numbers) and (isinstance(a, floats) or isinstance(b, floats)):
        return DoubleType()
    if {type(a), type(b)} == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    raise IllegalChange(f"{where}: no common type of {a.simpleString()} and {b.simpleString()}")


def merged_schema(old: StructType, new: StructType, where: str = "") -> StructType:
    """``old``'s fields widened by ``new``'s, then those that only ``new`` has; names without regard to case."""
    by_name = {f.name.lower(): f for f in new.fields}
    if len(by_name) < len(new.fields):
        raise IllegalChange(f"{where or 'batch'}: two columns differ in case only")
    out = []
    for f in old.fields:
        g = by_name.pop(f.name.lower(), None)
        path = f"{where}.{f.name}" if where else f.name
        out.append(StructField(f.name, least_common_type(f.dataType, g.dataType, path) if g else f.dataType, True))
    return StructType(out + [StructField(f.name, f.dataType, True) for f in new.fields if f.name.lower() in by_name])


def cast_up(c: Column, old: DataType | None, new: DataType) -> Column:
    """``c`` of type ``old`` as ``new``; nested fields by name, missing ones null."""
    if old is None or isinstance(old, NullType):
        return F.lit(None).cast(new)
    if isinstance(new, StructType):
        have = {f.name.lower(): f for f in old.fields}
        fields = [cast_up(c.getField(have[f.name.lower()].name), have[f.name.lower()].dataType, f.dataType) if f.name.lower() in have
                  else F.lit(None).cast(f.dataType) for f in new.fields]
        return F.when(c.isNotNull(), F.struct(*[x.alias(f.name) for x, f in zip(fields, new.fields)]))
    if isinstance(new, ArrayType):
        return F.transform(c, lambda x: cast_up(x, old.elementType, new.elementType))
    if isinstance(new, MapType):
        return F.transform_values(c, lambda _, v: cast_up(v, old.valueType, new.valueType))
    return c.cast(new) if old != new else c


def cast_rows(df: DataFrame, schema: StructType) -> DataFrame:
    have = {f.name.lower(): f for f in df.schema.fields}
    return df.select(*[(cast_up(F.col(f"`{have[f.name.lower()].name}`"), have[f.name.lower()].dataType, f.dataType)
                        if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


def _unsafe(c: Column, old: DataType, new: DataType, where: str) -> list:
    """(path, condition on a row: its value does not come back from the wider type) of one column."""
    if isinstance(new, StructType):
        have = {f.name.lower(): f for f in old.fields}
        return [x for f in new.fields if f.name.lower() in have
                for x in _unsafe(c.getField(have[f.name.lower()].name), have[f.name.lower()].dataType, f.dataType, f"{where}.{f.name}")]
    if isinstance(new, ArrayType):
        return [(p, F.exists(c, lambda x: _any(_unsafe(x, old.elementType, new.elementType, where))))
                for p in [f"{where}[]"] if _unsafe(F.lit(None), old.elementType, new.elementType, where)]
    if isinstance(new, MapType):
        return [(p, F.exists(F.map_values(c), lambda x: _any(_unsafe(x, old.valueType, new.valueType, where))))
                for p in [f"{where}{{}}"] if _unsafe(F.lit(None), old.valueType, new.valueType, where)]
    if isinstance(new, DoubleType) and isinstance(old, (DecimalType, LongType)):
        same = c.cast("double").try_cast(old).eqNullSafe(c)
        return [(where, c.isNotNull() & ~same)]
    return []


def _any(conditions: list) -> Column:
    out = F.lit(False)
    for _, c in conditions:
        out = out | F.coalesce(c, F.lit(False))
    return out


def _versions_table(table: str) -> str:
    return f"{table}__versions"


def versions(spark: SparkSession, table: str) -> list[StructType]:
    """The recorded schemas, oldest first."""
    if not spark.catalog.tableExists(_versions_table(table)):
        return []
    rows = spark.table(_versions_table(table)).orderBy("version").collect()  # one for each widening
    return [StructType.fromJson(json.loads(r["schema"])) for r in rows]


def _part(table: str, version: int) -> str:
    return f"{table}__v{version}"


def append_widening(df: DataFrame, table: str) -> int:
    """Append ``df``, starting a new version if its types are wider; returns rows written.

    Columns are matched by name without regard to case; those only in the
    table are null. Raises :class:`IllegalChange` with the column's path,
    before anything is written, if types have no common one or a value
    would not survive. A column without a type (all null) changes nothing.
    """
    spark = df.sparkSession
    known = versions(spark, table)
    schema = merged_schema(known[-1], df.schema) if known else StructType([StructField(f.name, f.dataType, True) for f in df.schema.fields])
    untyped = [f.name for f in schema.fields if isinstance(f.dataType, NullType)]
    if untyped:
        schema = StructType([f for f in schema.fields if f.name not in untyped])
        df = df.drop(*untyped)
    checks = [("batch", df)] if known else []
    widened = known and schema != known[-1]
    if widened:
        checks += [(f"version {n}", spark.table(_part(table, n))) for n, old in enumerate(known)]
    for name, rows in checks:
        have = {f.name.lower(): f for f in schema.fields}
        risks = [x for f in rows.schema.fields for x in _unsafe(F.col(f"`{f.name}`"), f.dataType, have[f.name.lower()].dataType, f.name)]
        if risks:
            counts = rows.agg(*[F.count(F.when(c, 1)).alias(f"n{i}") for i, (_, c) in enumerate(risks)]).first()
            lost = [f"{path} ({counts[i]} values)" for i, (path, _) in enumerate(risks) if counts[i]]
            if lost:
                raise IllegalChange(f"{name}: values would change in {', '.join(lost)}")
    version = len(known) - 1
    if not known or widened:
        version += 1
        # the part first: a version is there once it is recorded
        spark.sql(f"DROP TABLE IF EXISTS {_part(table, version)}")
        n = write_table(cast_rows(df, schema), _part(table, version), mode="overwrite")
        write_table(spark.createDataFrame([(version, schema.json())], "version int, schema string"), _versions_table(table), mode="append")
        return n
    return write_table(cast_rows(df, schema), _part(table, version), mode="append")


def read_widened(spark: SparkSession, table: str) -> DataFrame:
    """All rows under the last schema."""
    known = versions(spark, table)
    if not known:
        raise ValueError(f"{table} has no versions")
    out = None
    for n in range(len(known)):
        rows = cast_rows(spark.table(_part(table, n)), known[-1])
        out = rows if out is None else out.unionAll(rows)
    return out
