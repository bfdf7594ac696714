"""Summary models kept up by batches of changes (A3, G1, G3, G4 under E2).

A model is a set of groups with measures over one or more inputs. Inputs
change: a batch brings rows with a sign, +1 for a row that is new and -1
for one that is gone (:func:`signed_changes` makes them from keyed rows).
What a group needs so that any change can be undone is kept as state that
adds up:

* totals: per group and input the signed number of rows, and per measure
  the signed count and sum of its values;
* values: per group and value the signed number of rows that have it, for
  distinct counts, least and greatest values and attributes.

Both are logs. A batch appends one partition of added-up differences per
bucket of groups (``_bucket``, ``_batch``); sums commute, so batches may
come in any order, and a batch that is applied again replaces its own
partitions. Then the groups that the batch touched are worked out anew,
from the state of their buckets alone, and replace their rows in the model
table. Nothing else is read, however large the inputs are.

:func:`fold_state` adds the log up to one partition per bucket; later
repeats of a folded batch are left out there.

Hot groups: differences are combined in the task before the shuffle, and
the state of a group is as many rows as it has distinct values, never its
rows. Sums must be exact, or a retraction would leave a rest behind: double
and float columns are refused, cast them to decimals.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructType

from ..sinks.tables import drop_partitions, replace_partitions, write_table

SIGN = "_sign"
BUCKET, BATCH = "_bucket", "_batch"
KINDS = ("count", "sum", "avg", "distinct", "min", "max", "attribute")
_VALUES = ("distinct", "min", "max", "attribute")


@dataclass(frozen=True)
class Measure:
    """One output column: ``kind`` over ``column`` of ``input``.

    count     rows with a value          distinct  different values
    sum, avg  of exact numbers           min, max  of values still there
    attribute the value of a keyed row (the greatest, should there be several)
    All ignore nulls; over no rows of the input a measure is null.
    """
    name: str
    kind: str
    column: str
    input: str = "events"


@dataclass(frozen=True)
class Maintained:
    """``table``: the model's name; state tables stand beside it.

    ``keys``    names of the group columns in the model
    ``inputs``  input -> its columns that hold the keys, in that order
    ``base``    the input that says which groups there are; without one, any
                group with rows of any input is there
    ``buckets`` parts of the groups; a batch rewrites the touched ones
    """
    table: str
    keys: tuple
    measures: tuple
    inputs: Mapping[str, tuple] = field(default_factory=lambda: {"events": ()})
    base: str | None = None
    buckets: int = 64

    def __post_init__(self):
        bad = [m for m in self.measures if m.kind not in KINDS or m.input not in self.inputs]
        if bad:
            raise ValueError(f"unknown kind or input: {bad}")

    @property
    def totals(self) -> str:
        return f"{self.table}__totals"

    @property
    def values(self) -> str:
        return f"{self.table}__values"


def signed_changes(held: DataFrame, batch: DataFrame, keys, deleted: str | None = None) -> DataFrame:
    """Signed rows that turn ``held`` into ``held`` with ``batch`` merged in.

    Both have unique ``keys``. A row of the batch replaces the held row with
    its key; with the boolean column ``deleted`` true it only removes it.
    Rows that stay as they are cancel out. Reads the held rows of the
    batch's keys (a semi join); keys are compared as SQL equality, so a null
    key never replaces anything.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = held.columns
    old = held.join(batch.select(*keys).distinct(), on=keys, how="left_semi").select(*cols, F.lit(-1).alias(SIGN))
    new = batch.filter(~F.coalesce(F.col(deleted), F.lit(False))) if deleted else batch
    both = old.unionAll(new.select(*cols, F.lit(1).alias(SIGN)))
    return both.groupBy(*cols).agg(F.sum(SIGN).cast("int").alias(SIGN)).filter(F.col(SIGN) != 0)


def _same(keys, prefix: str) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return out


def _only(df: DataFrame, touched: DataFrame, keys, how: str) -> DataFrame:
    """Rows of ``df`` whose group is (left_semi) or is not (left_anti) among ``touched``; null is a group."""
    named = touched.select(*[F.col(k).alias(f"__t_{k}") for k in keys])
    return df.join(named, _same(keys, "__t_"), how)


def _keyed(spec: Maintained, name: str, changes: DataFrame) -> DataFrame:
    missing = {*spec.inputs[name], SIGN, *(m.column for m in spec.measures if m.input == name)} - set(changes.columns)
    if missing:
        raise ValueError(f"{name}: no columns {sorted(missing)}")
    return changes.withColumns({f"__k_{k}": F.col(c) for k, c in zip(spec.keys, spec.inputs[name])})


def _exact_sum_type(typ) -> str:
    if isinstance(typ, DecimalType):
        return f"decimal(38,{typ.scale})"
    if isinstance(typ, (ShortType, IntegerType, LongType)):
        return "decimal(38,0)"
    if isinstance(typ, (DoubleType, FloatType)):
        raise ValueError("sums of floating-point numbers cannot be undone exactly: cast to a decimal first")
    raise ValueError(f"no sum over {typ.simpleString()}")


def _totals_of(spec: Maintained, name: str, changes: DataFrame) -> DataFrame:
    """Differences of one input: a row for each touched group."""
    sign = F.col(SIGN)
    out = [F.sum(sign).cast("bigint").alias(f"__rows_{name}")]
    for i, m in enumerate(spec.measures):
        if m.input == name and m.kind in ("count", "sum", "avg"):
            out.append(F.sum(F.when(F.col(m.column).isNotNull(), sign).otherwise(0)).cast("bigint").alias(f"__n_{i}"))
            if m.kind != "count":
                typ = _exact_sum_type(changes.schema[m.column].dataType)
                out.append(F.coalesce(F.sum(F.col(m.column).cast(typ) * sign), F.lit(0)).cast(typ).alias(f"__s_{i}"))
    return changes.groupBy(*[F.col(f"__k_{k}").alias(k) for k in spec.keys]).agg(*out)


def _value_columns(spec: Maintained) -> dict:
    """(input, column) -> number of the column that holds its values in the state."""
    out = {}
    for m in spec.measures:
        if m.kind in _VALUES:
            out.setdefault((m.input, m.column), len(out))
    return out


def _values_of(spec: Maintained, name: str, changes: DataFrame) -> DataFrame | None:
    """Differences of one input: a row for each touched group and value."""
    numbered = {c: i for (n, c), i in _value_columns(spec).items() if n == name}
    if not numbered:
        return None
    # a row has one entry for each column that has a value
    entries = F.array(*[F.struct(F.lit(i).alias("which"), *[(F.col(c) if c == d else F.lit(None).cast(changes.schema[d].dataType)).alias(f"v_{j}")
                                                            for d, j in numbered.items()])
                        for c, i in numbered.items()])
    rows = changes.select(*[F.col(f"__k_{k}").alias(k) for k in spec.keys], SIGN, F.explode(entries).alias("e"))
    cols = [f"v_{j}" for j in numbered.values()]
    rows = rows.select(*spec.keys, SIGN, F.col("e.which").alias("_which"), *[F.col(f"e.{c}").alias(c) for c in cols])
    return (rows.filter(_has_value(cols))
            .groupBy(*spec.keys, "_which", *cols).agg(F.sum(SIGN).cast("bigint").alias("_n")).filter("_n != 0"))


def _has_value(cols) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | (F.col(c).isNotNull() & (F.col("_which") == int(c[2:])))
    return out


def _bucketed(spec: Maintained, df: DataFrame) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*spec.keys), F.lit(spec.buckets)).cast("int"))


def _partitions(spark: SparkSession, table: str) -> list:
    """(bucket, batch) of the log's partitions, from the catalog."""
    if not spark.catalog.tableExists(table):
        return []
    out = []
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        parts = dict(p.split("=") for p in r[0].split("/"))
        out.append((int(parts[BUCKET]), int(parts[BATCH])))
    return out


def _folded(spark: SparkSession, table: str) -> dict:
    """Bucket -> the last batch that is folded in it. The folded partition of batch n bears the number -n - 1."""
    out: dict = {}
    for bucket, n in _partitions(spark, table):
        if n < 0:
            out[bucket] = max(out.get(bucket, -1), -n - 1)
    return out


def _state(spark: SparkSession, table: str, buckets=None) -> DataFrame:
    """The log without what a newer fold of the bucket holds already; a filter on partition columns only."""
    here, last = F.lit(True) if buckets is None else F.col(BUCKET).isin(list(buckets)), _folded(spark, table)
    log = spark.table(table).filter(here)
    if not last:
        return log
    counts = ~F.col(BUCKET).isin(list(last))
    for n in sorted(set(last.values())):
        inside = F.col(BUCKET).isin([b for b, m in last.items() if m == n])
        counts = counts | (inside & ((F.col(BATCH) == -n - 1) | (F.col(BATCH) > n)))
    return log.filter(counts)


def _append(spec: Maintained, df: DataFrame, table: str, batch: int) -> None:
    """Write one batch's partitions; those it wrote in an earlier attempt go first, folded buckets are left alone."""
    spark = df.sparkSession
    df = _bucketed(spec, df).withColumn(BATCH, F.lit(batch).cast("bigint"))
    if not spark.catalog.tableExists(table):
        write_table(df, table, mode="overwrite", partition_by=[BUCKET, BATCH])
        return
    done = [b for b, n in _folded(spark, table).items() if n >= batch]
    drop_partitions(spark, table, [{BUCKET: b, BATCH: n} for b, n in _partitions(spark, table) if n == batch and b not in done])
    replace_partitions(df.filter(~F.col(BUCKET).isin(done)).select(*spark.table(table).columns) if done
                       else df.select(*spark.table(table).columns), table)


def _union(frames) -> DataFrame | None:
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def _model_rows(spec: Maintained, totals: DataFrame, values: DataFrame | None, batch: int) -> DataFrame:
    """The model's rows of the groups in the given state that ``batch`` touched.

    Whether it did comes out of the same aggregates: a join on the groups
    would bring all values of a group to one task.
    """
    here = F.max(F.col(BATCH) == batch)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in totals.columns if c.startswith("__")]
    grouped = totals.groupBy(*spec.keys).agg(*sums, here.alias("__here"))
    numbers = _value_columns(spec)
    if values is not None:
        cols = [f"v_{i}" for i in numbers.values()]
        there = values.groupBy(*spec.keys, "_which", *cols).agg(F.sum("_n").alias("_n"), here.alias("_here")).filter("_n != 0 OR _here")
        aggs = [F.max("_here").alias("__here"), F.min("_n").alias("__least")]
        for i, m in enumerate(spec.measures):
            if m.kind in _VALUES:
                which, v = F.col("_which") == numbers[m.input, m.column], F.col(f"v_{numbers[m.input, m.column]}")
                one = F.when(which & (F.col("_n") > 0), v)
                aggs.append({"distinct": F.count(one), "min": F.min(one), "max": F.max(one), "attribute": F.max(one)}[m.kind].alias(f"__m_{i}"))
        grouped = _union([grouped, there.groupBy(*spec.keys).agg(*aggs)])
        # one row from either side: added up, not joined, so that null groups meet
        grouped = grouped.groupBy(*spec.keys).agg(*[(F.min if c == "__least" else F.max)(c).alias(c) for c in grouped.columns if c.startswith("__")])
        # fewer than none: a deletion of a row that was never there
        lacking = F.raise_error(F.lit(f"{spec.table}: a value was removed more often than added")).cast("boolean")
        grouped = grouped.filter("__here").filter(F.when(F.col("__least") < 0, lacking).otherwise(True))
    grouped = grouped.filter("__here")
    out = []
    for i, m in enumerate(spec.measures):
        rows = F.col(f"__rows_{m.input}")
        value = {"count": lambda: F.col(f"__n_{i}"), "sum": lambda: F.when(F.col(f"__n_{i}") > 0, F.col(f"__s_{i}")),
                 "avg": lambda: F.when(F.col(f"__n_{i}") > 0, F.col(f"__s_{i}").cast("double") / F.col(f"__n_{i}")),
                 "distinct": lambda: F.coalesce(F.col(f"__m_{i}"), F.lit(0).cast("bigint"))}.get(m.kind, lambda: F.col(f"__m_{i}"))()
        out.append(F.when(rows > 0, value).alias(m.name))
    held = F.col(f"__rows_{spec.base}") > 0 if spec.base else F.greatest(*[F.col(f"__rows_{n}") for n in spec.inputs], F.lit(0)) > 0
    return grouped.filter(held).select(*spec.keys, *out)


def apply_changes(spark: SparkSession, spec: Maintained, batch: int, changes: Mapping[str, DataFrame]) -> list[int]:
    """Apply batch number ``batch`` (0 or more): input -> signed rows. Returns the buckets it touched.

    Repeating a batch, after a failure at any step or without one, gives the
    same state and model; where a batch is folded already it changes nothing.
    A batch must always bring the same rows; it is evaluated more than once,
    so let it read stored tables.
    """
    if batch < 0:
        raise ValueError("batch numbers start at 0")
    keyed = {n: _keyed(spec, n, df) for n, df in changes.items()}
    totals = _union([_totals_of(spec, n, df) for n, df in keyed.items()])
    absent = [c for c in _total_columns(spec) if c not in totals.columns]
    sums = {c: t for c, t in _state_types(spec, changes, spark).items()}
    totals = totals.withColumns({c: F.lit(None).cast(sums[c]) for c in absent if c in sums}).groupBy(*spec.keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast(sums[c]).alias(c) for c in _total_columns(spec) if c in sums])
    _append(spec, totals, spec.totals, batch)
    values = _union([v for v in (_values_of(spec, n, df) for n, df in keyed.items()) if v is not None])
    if _value_columns(spec):
        if values is not None:
            types = _value_types(spec, changes, spark)
            values = values.withColumns({c: F.lit(None).cast(t) for c, t in types.items() if c not in values.columns})
            values = values.select(*spec.keys, "_which", *types, "_n")
            _append(spec, values, spec.values, batch)
    buckets = sorted({b for b, n in [*_partitions(spark, spec.totals), *_partitions(spark, spec.values)] if n == batch})
    _refresh(spark, spec, batch, buckets)
    return buckets


def _total_columns(spec: Maintained) -> list[str]:
    out = [f"__rows_{n}" for n in spec.inputs]
    for i, m in enumerate(spec.measures):
        if m.kind in ("count", "sum", "avg"):
            out += [f"__n_{i}"] + ([f"__s_{i}"] if m.kind != "count" else [])
    return out


def _state_types(spec: Maintained, changes: Mapping[str, DataFrame], spark: SparkSession) -> dict:
    """Types of the totals' columns, of the stored state where there is one."""
    stored: StructType | None = spark.table(spec.totals).schema if spark.catalog.tableExists(spec.totals) else None
    out = {}
    for c in _total_columns(spec):
        if stored is not None:
            out[c] = stored[c].dataType
        elif not c.startswith("__s_"):
            out[c] = LongType()
        else:
            m = spec.measures[int(c[4:])]
            if m.input not in changes:
                raise ValueError(f"the first batch must bring all inputs, {m.input} is missing")
            out[c] = _exact_sum_type(changes[m.input].schema[m.column].dataType)
    return out


def _value_types(spec: Maintained, changes: Mapping[str, DataFrame], spark: SparkSession) -> dict:
    if spark.catalog.tableExists(spec.values):
        schema = spark.table(spec.values).schema
        return {f"v_{i}": schema[f"v_{i}"].dataType for i in _value_columns(spec).values()}
    missing = {n for n, _ in _value_columns(spec)} - set(changes)
    if missing:
        raise ValueError(f"the first batch must bring all inputs, {sorted(missing)} missing")
    return {f"v_{i}": changes[n].schema[c].dataType for (n, c), i in _value_columns(spec).items()}


def _refresh(spark: SparkSession, spec: Maintained, batch: int, buckets: list[int]) -> None:
    """Work out the groups of one batch anew, from the state of its buckets."""
    if not buckets:
        return
    totals = _state(spark, spec.totals, buckets)
    values = _state(spark, spec.values, buckets) if spark.catalog.tableExists(spec.values) else None
    touched = totals.filter(F.col(BATCH) == batch).select(*spec.keys)
    if values is not None:
        touched = touched.unionAll(values.filter(F.col(BATCH) == batch).select(*spec.keys))
    touched = touched.distinct()
    rows = _model_rows(spec, totals, values, batch)
    rows = _bucketed(spec, rows)
    if not spark.catalog.tableExists(spec.table):
        write_table(rows, spec.table, mode="overwrite", partition_by=[BUCKET])
        return
    model = spark.table(spec.table).filter(F.col(BUCKET).isin(buckets))
    staging = f"{spec.table}__load"
    write_table(_only(model, touched, spec.keys, "left_anti").unionByName(rows.select(*model.columns)), staging, mode="overwrite",
                partition_by=[BUCKET])
    replace_partitions(spark.table(staging).select(*model.columns), spec.table)
    filled = {r[0] for r in spark.table(staging).select(BUCKET).distinct().collect()}  # at most ``buckets`` numbers
    drop_partitions(spark, spec.table, [{BUCKET: b} for b in buckets if b not in filled])
    spark.sql(f"DROP TABLE IF EXISTS {staging}")


def read_model(spark: SparkSession, spec: Maintained) -> DataFrame:
    """The model's groups and measures."""
    return spark.table(spec.table).select(*spec.keys, *[m.name for m in spec.measures])


def fold_state(spark: SparkSession, spec: Maintained) -> None:
    """Add the log up: one partition per bucket, without values that came to nothing.

    The folded partitions are written first, then what they hold is dropped.
    From the moment a bucket has its folded partition, readers leave out the
    older ones, so a fold may stop at any step and be repeated. Fold when no
    earlier batch is still to come: a batch that a bucket has folded changes
    nothing there any more.
    """
    for table in (spec.totals, spec.values):
        numbers = [n for _, n in _partitions(spark, table) if n >= 0]
        if not numbers:
            continue
        last, log = max(numbers), _state(spark, table)
        if table == spec.totals:
            sums = [c for c in log.columns if c.startswith("__")]
            # groups that came to nothing stay as zeros, so that every bucket keeps a folded partition
            added = log.groupBy(*spec.keys).agg(*[F.sum(c).cast(log.schema[c].dataType).alias(c) for c in sums])
        else:
            cols = [c for c in log.columns if c not in (BUCKET, BATCH, "_n")]
            added = log.groupBy(*cols).agg(F.sum("_n").cast("bigint").alias("_n"))
        staging = f"{table}__load"
        added = _bucketed(spec, added).withColumn(BATCH, F.lit(-last - 1).cast("bigint"))
        write_table(added.select(*log.columns), staging, mode="overwrite")
        replace_partitions(spark.table(staging), table)
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
        done = _folded(spark, table)
        drop_partitions(spark, table, [{BUCKET: b, BATCH: n} for b, n in _partitions(spark, table) if -done.get(b, -1) - 1 < n <= done.get(b, -1)])
        spark.catalog.refreshTable(table)
