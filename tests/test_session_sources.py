"""Session sizing and source helpers."""

from pyspark.sql import functions as F

from layerkit.operators import stamp
from layerkit.session import MB, scratch_path, sizing_conf
from layerkit.sources import read_csv


def test_sizing_conf_scales_with_input():
    big = sizing_conf(100 * 10**12, 8000)
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 * MB
    assert 150_000 < int(big["spark.sql.shuffle.partitions"]) <= 200_000
    more = sizing_conf(1000 * 10**12, 8000)                       # no cap: partitions keep their size
    assert int(more["spark.sql.shuffle.partitions"]) > 1_800_000
    small = sizing_conf(10**9, 8)
    assert 16 * MB <= int(small["spark.sql.files.maxPartitionBytes"]) <= 32 * MB   # ~4 waves
    assert int(small["spark.sql.shuffle.partitions"]) == 24                       # 3 per core
    assert big["spark.sql.autoBroadcastJoinThreshold"] == str(64 * MB)


def test_stamp_records_each_file(spark):
    land = scratch_path(spark, "multi")
    spark.range(40).repartition(4).write.option("header", True).csv(f"{land}/t.csv")
    df = stamp(read_csv(spark, f"{land}/t.csv"), "_ingested_at", "_source_file", file_path=True)
    files = {r[0] for r in df.select("_source_file").distinct().collect()}
    assert len(files) == 4 and all(f.endswith(".csv") for f in files)
    assert df.filter(F.col("_ingested_at").isNull()).count() == 0
    assert df.count() == 40


def test_cluster_without_shared_folder_raises():
    import pytest
    from layerkit.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, path):
            self.path = path

    class Session:
        def __init__(self, master):
            self.conf, self.sparkContext = Conf(), Context(master)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(Session(master))
    assert ensure_checkpoint_dir(Session("local[2]"))
