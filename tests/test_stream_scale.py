"""What lets keep-latest over a stream grow: state off the heap and held once, upserts that search and copy nothing in vain."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from layerkit.operators.dedup import keep_latest
from layerkit.plans import merge
from layerkit.plans.merge import upsert
from layerkit.registry.io import scratch_db
from layerkit.session import scratch_path
from layerkit.sinks.tables import write_table
from layerkit.streaming import latest
from layerkit.streaming.latest import keep_latest_stream, read_latest

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def run(spark, df, **k):
    db, land, ckpt = scratch_db(spark, "ss"), scratch_path(spark, "ss-land"), scratch_path(spark, "ss-ckpt")
    df.write.parquet(f"{land}/d0")
    keep_latest_stream(spark.readStream.schema(df.schema).parquet(f"{land}/*"), "k", "at", f"{db}.t", ckpt, buckets=3, **k)
    return read_latest(spark, f"{db}.t"), ckpt.removeprefix("file:")


def text(df):
    return sorted(str(tuple(r)) for r in df.collect())


def some(spark):
    return spark.range(200).select((F.col("id") % 40).alias("k"), (F.col("id") * 7 % 11).alias("at"), (F.col("id") * 3 % 5).alias("v"), F.col("id").cast("string").alias("note"))


def test_state_is_off_the_heap_and_the_callers_session_is_left_alone(spark):
    before = dict(spark.conf.getAll)
    _, ckpt = run(spark, some(spark))
    assert dict(spark.conf.getAll) == before
    head = json.loads(open(f"{ckpt}/offsets/0").read().split("\n")[1])
    assert head["conf"][PROVIDER].endswith("RocksDBStateStoreProvider")
    assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("lk_")]
    assert len(glob.glob(f"{ckpt}/offsets/[0-9]*")) == 1          # no batch beside the one with rows


def test_small_states_reserve_no_disk(spark):
    own = latest._stream_session(spark)
    assert own.conf.get("spark.sql.streaming.stateStore.rocksdb.allowFAllocate") == "false"
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "unset") == "unset"


def test_state_holds_each_column_once(spark):
    _, ckpt = run(spark, some(spark))
    schema = spark.read.format("statestore").load(ckpt).schema["value"].dataType

    def leaves(kind):
        return sum(leaves(f.dataType) for f in kind.fields) if hasattr(kind, "fields") else 1
    assert leaves(schema) == 3                                    # at, v, note; k is the key


def test_upserts_run_outside_the_streams_session(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(latest, "upsert", lambda df, *a, **k: (seen.append((df.sparkSession.conf.get("spark.sql.adaptive.enabled"), k["moves"])), upsert(df, *a, **k))[1])
    base = scratch_path(spark, "x").removeprefix("file:").rsplit("/", 1)[0]
    before = set(glob.glob(f"{base}/latest-batch-*"))
    out, _ = run(spark, some(spark))
    assert seen == [("true", False)] and out.count() == 40
    assert set(glob.glob(f"{base}/latest-batch-*")) <= before     # what was stored for the upsert is gone


@pytest.mark.parametrize("tiebreak", [None, ["v"]])
def test_columns_that_cannot_order_and_keys_with_two_zeros(spark, tiebreak):
    df = some(spark).withColumns({"k": F.when(F.col("k") < 10, F.when(F.col("at") % 2 == 0, 0.0).otherwise(F.expr("-0.0D"))).otherwise(F.col("k").cast("double")),
                                  "at": F.col("at") * 1000 + F.col("note").cast("int"), "m": F.create_map("note", "v")})
    out, _ = run(spark, df, tiebreak=tiebreak)
    then = keep_latest(df, "k", "at", tiebreak)
    assert text(out.select(*df.columns)) == text(then)


def test_partitions_made_of_the_key_are_not_searched(spark, monkeypatch):
    rows = lambda lo, hi, v: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(v).alias("v"), (F.col("id") % 4).cast("int").alias("p"))
    got = []
    dealt = []
    monkeypatch.setattr(merge, "replace_partitions", lambda df, table, *a, _f=merge.replace_partitions: (dealt.append(a), _f(df, table, *a))[1])
    for moves in (True, False):
        table = f"{scratch_db(spark, 'mv')}.t"
        write_table(rows(0, 50, 1), table, "overwrite", partition_by=["p"])
        upsert(rows(40, 60, 2).filter("p < 2"), table, "k", "v", partition_by=["p"], scoped=True, moves=moves)
        got.append(text(spark.table(table)))
    assert got[0] == got[1] and len(got[0]) == 54
    assert dealt == [(), ()]                                      # copied, not shuffled again
    table = f"{scratch_db(spark, 'mv')}.t"
    write_table(rows(0, 8, 1), table, "overwrite", partition_by=["p"])
    upsert(rows(0, 1, 2).withColumn("p", F.lit(3)), table, "k", "v", partition_by=["p"], scoped=True, moves=False)
    assert spark.table(table).filter("k = 0").count() == 2        # a key that moved against the promise was not looked for
