"""Keep-latest over a stream (W1 under E2): keyed state, late rows, restarts.

The batch form reduces all rows to the latest per key. Over a stream, a
streaming aggregate keeps the best row of each key in the state store and
passes on, each micro-batch, the keys that got rows; an upsert compares them
with the rows in the target table.

How late a row may come is not bounded: the engine drops rows that are
older than the watermark of a time column, and a dropped row may be the
only one of its key. So the watermark runs over the time of arrival, which
no row is behind, and serves to forget: state is kept for each key and
``idle`` stretch of arrival time, and goes when the watermark has passed the
stretch. What comes for a key later, however old its event time, is compared
with the table. The table is thus always what the batch form gives over all
rows so far; state only combines the rows of a key that come close together.

Restarts continue from the checkpoint: state and input offsets are stored
together for each micro-batch, and one that was cut off is repeated; its
upsert gives the same table again. The aggregate combines rows in the task
before the shuffle, so a hot key sends one row for each task. The target
lies in ``buckets`` parts by key; a micro-batch rewrites those that its keys
fall in. A checkpoint written before the state held each column once (round
4) has state of another form and cannot be continued.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import _orderable
from ..plans.merge import upsert
from ..session import fine_session, remove_folder, scratch_path
from ..sinks.tables import GLOBAL_TEMP

ARRIVED, BUCKET = "_arrived", "_bucket"
_PLAIN = re.compile(r"(tiny|small|big)?int|boolean|date|timestamp(_ntz)?|string|binary|decimal\(.*\)")
STATE = "spark.sql.streaming.stateStore"


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own whose new streams keep their state on local disk, with a bounded share of memory.

    The default store holds every key on the heap, a copy for each version:
    with tens of millions of keys the executors do little but collect
    garbage. A checkpoint that has state goes on with the store it has.
    """
    own = fine_session(spark)
    own.conf.set(f"{STATE}.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set(f"{STATE}.rocksdb.boundedMemoryUsage", "true")
    own.conf.set(f"{STATE}.rocksdb.trackTotalNumberOfRows", "false")     # a lookup more for each write
    own.conf.set(f"{STATE}.rocksdb.allowFAllocate", "false")            # 4 MB ahead for each shuffle partition, however small
    # a batch without rows would only forget state, which the next one does as well
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    return own


def keep_latest_stream(stream: DataFrame, keys, by, target: str, checkpoint: str, tiebreak=None, idle: str = "1 hour",
                       buckets: int = 64) -> None:
    """Take all rows the stream has now into ``target``: one row per key, the greatest ``by``; then stop.

    ``by`` and ``tiebreak`` are names (descending, nulls last), as in
    :func:`~layerkit.operators.dedup.keep_latest`; without ``tiebreak``
    every other orderable column breaks ties. Null keys are keys, as in the
    batch form. Read the result with :func:`read_latest`.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    by = [by] if isinstance(by, str) else list(by)
    tiebreak = _orderable(stream, keys + by) if tiebreak is None else list(tiebreak)
    order = by + [c for c in tiebreak if c not in by]
    columns, caller = stream.columns, stream.sparkSession
    own, batches = _stream_session(caller), fine_session(caller)
    view = f"lk_{uuid.uuid4().hex}"
    stream.createGlobalTempView(view)
    try:
        rows = own.table(f"{GLOBAL_TEMP}.{view}")
    finally:
        caller.catalog.dropGlobalTempView(view)
    # a grouping key stands for its column where equal values are the same value (0.0 and -0.0 are not)
    plain = [k for k in keys if _PLAIN.fullmatch(stream.schema[k].dataType.simpleString())]
    ordered = order + [c for c in _orderable(stream, order + plain) if c in keys]
    # the greatest struct: fields one after the other, null least, as descending order with nulls last
    place = F.struct(*[F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(ordered)])
    rest = [c for c in columns if c not in ordered + plain]
    # what orders the rows is held once; only columns that take no part in it go along beside it
    beside = F.struct(place.alias("place"), *[F.col(f"`{c}`").alias(f"r{i}") for i, c in enumerate(rest)])
    best = F.max_by(beside, place) if rest else F.struct(F.max(place).alias("place"))
    named = {c: f"__k{i}" for i, c in enumerate(keys)}
    place_of = {c: f"best.r{i}" for i, c in enumerate(rest)}
    place_of |= {c: f"best.place.o{i}" for i, c in enumerate(ordered)} | {c: named[c] for c in plain}
    kept = (rows.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, idle)
            # keys lead: sorts tell rows by their first column, and the stretch is the same for most rows
            .groupBy(*[F.col(f"`{c}`").alias(k) for c, k in named.items()], F.window(ARRIVED, idle)).agg(best.alias("best"))
            .select(*[F.col(place_of[c]).alias(c) for c in columns]))

    def write(rows: DataFrame, epoch: int) -> None:
        # stored first, as the upsert reads its batch more than once; one stretch of arrival may end within a batch.
        # The upsert runs outside the stream's session, which fixes the number of tasks
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)
        folder = scratch_path(caller, "latest-batch")
        try:
            rows.select(*columns, bucket).write.parquet(folder)
            held = batches.read.parquet(folder)
            if not held.isEmpty():
                upsert(held, target, keys, by, tiebreak=tiebreak, partition_by=[BUCKET], scoped=True, moves=False)
        finally:
            remove_folder(caller, folder)

    (kept.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    # micro-batches run in a session of their own; this one may have listed the table's files before
    if stream.sparkSession.catalog.tableExists(target):
        stream.sparkSession.catalog.refreshTable(target)


def read_latest(spark: SparkSession, target: str) -> DataFrame:
    return spark.table(target).drop(BUCKET)
