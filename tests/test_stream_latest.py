"""Keep-latest over a stream equals the batch form, however rows arrive."""

import random

from pyspark.sql import functions as F

from layerkit.operators.dedup import keep_latest
from layerkit.registry.io import scratch_db
from layerkit.session import scratch_path
from layerkit.streaming.latest import keep_latest_stream, read_latest

SCHEMA = "k string, at timestamp_ntz, v double, note string"


def drops(spark, seed):
    rng = random.Random(seed)
    out = []
    for n in range(4):
        rows = [(rng.choice(["a", "b", "c", f"n{n}{i}", None]), rng.choice([None, f"2024-01-{rng.randint(1, 28):02d} 00:00:00"]),
                 rng.choice([None, 1.5, -2.0, float("nan")]), rng.choice(["x", "y", None])) for i in range(40)]
        if n == 3:  # all late, some of keys never seen
            rows = [(k, "1999-01-01 00:00:00", v, note) for k, _, v, note in rows]
        df = spark.createDataFrame(rows, "k string, at string, v double, note string").withColumn("at", F.col("at").cast("timestamp_ntz"))
        out.append(df.unionByName(out[0]) if n == 2 else df)       # one drop repeats the first
    return out


def text(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_stream_equals_batch_over_several_triggers_and_restarts(spark):
    for idle in ("1 hour", "1 second"):        # with the short one, state is forgotten between the triggers
        db, land, ckpt = scratch_db(spark, "sl"), scratch_path(spark, "sl-land"), scratch_path(spark, "sl-ckpt")
        seen = None
        for n, df in enumerate(drops(spark, 5)):
            df.write.parquet(f"{land}/d{n}")
            seen = df if seen is None else seen.unionByName(df)
            stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 3).parquet(f"{land}/*")
            keep_latest_stream(stream, "k", "at", f"{db}.t", ckpt, idle=idle, buckets=3)
            assert text(read_latest(spark, f"{db}.t")) == text(keep_latest(seen, "k", "at"))
        before = text(read_latest(spark, f"{db}.t"))
        keep_latest_stream(spark.readStream.schema(df.schema).parquet(f"{land}/*"), "k", "at", f"{db}.t", ckpt, idle=idle, buckets=3)
        assert text(read_latest(spark, f"{db}.t")) == before


def test_a_micro_batch_that_was_cut_off_is_repeated(spark, monkeypatch):
    from layerkit.streaming import latest

    db, land, ckpt = scratch_db(spark, "sl"), scratch_path(spark, "sl-land"), scratch_path(spark, "sl-ckpt")
    df = drops(spark, 6)[0]
    df.write.parquet(f"{land}/d0")
    real = latest.upsert

    def cut_off(*a, **b):
        real(*a, **b)
        raise RuntimeError("lost after the write")
    monkeypatch.setattr(latest, "upsert", cut_off)
    stream = spark.readStream.schema(df.schema).parquet(f"{land}/*")
    try:
        keep_latest_stream(stream, "k", "at", f"{db}.t", ckpt, buckets=2)
        raise AssertionError("it should have failed")
    except Exception as e:  # noqa: BLE001
        assert "lost after the write" in str(e)
    monkeypatch.undo()
    keep_latest_stream(spark.readStream.schema(df.schema).parquet(f"{land}/*"), "k", "at", f"{db}.t", ckpt, buckets=2)
    assert text(read_latest(spark, f"{db}.t")) == text(keep_latest(df, "k", "at"))
