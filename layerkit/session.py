"""Session helpers: a tuned local/cluster session and the shared scratch folder.

On a cluster the scratch folder is whatever ``spark.checkpoint.dir`` names
(a shared file system such as HDFS/S3/ABFS); it is read from the session
and only created locally when nothing is configured (tests, laptops).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for sessions built by ``get_session``; ``extra`` overrides them.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # reliable checkpoints are deleted once their DataFrame is unreachable
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


MB = 1 << 20


def sizing_conf(input_bytes: int, cores: int, target_task_bytes: int = 256 * MB) -> dict:
    """Scan/shuffle sizing for a job over ``input_bytes`` on ``cores`` cores.

    * scan splits: ``input / (4 × cores)`` (about four waves of tasks),
      clamped to [16 MiB, ``target_task_bytes``];
    * initial shuffle partitions: enough for ~``target_task_bytes`` per
      reducer assuming the shuffle is half the input (projected columns),
      at least 3 per core — AQE then coalesces small ones to the advisory
      size and splits skewed ones;
    * broadcast threshold stays bounded (64 MiB) whatever the input size.

    Example: 100 TB on 8,000 cores → 256 MiB splits and ~186,000 initial
    shuffle partitions (~256 MiB each before AQE coalescing).
    """
    split = max(16 * MB, min(target_task_bytes, input_bytes // max(1, cores * 4)))
    shuffle = max(cores * 3, (input_bytes // 2) // target_task_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_task_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * MB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_task_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
    }


def get_session(master: str | None = None, app: str = "layerkit",
                shuffle_partitions: int | None = None,
                extra: dict | None = None, input_bytes: int | None = None,
                cores: int | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and a pinned UTC clock.

    With ``input_bytes`` and ``cores``, scan and shuffle sizes come from
    :func:`sizing_conf`.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if input_bytes and cores:
        conf.update(sizing_conf(input_bytes, cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def fine_session(spark: SparkSession) -> SparkSession:
    """A session of its own, with the caller's settings, for jobs that sort wide rows and write many tables.

    With Spark's defaults a task grows with the input up to 128 MB of a
    file or 64 MB of compressed shuffle, which text rows unpack to
    gigabytes of sort memory. Here a task stays at 8 MB and their number
    grows instead. Shuffle files go when their query ends; those of table
    writes, as measured, still wait for the driver's garbage collection.
    """
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.files.maxPartitionBytes", "8m")
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
    own.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(3 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    own.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    own.conf.set("spark.sql.parquet.compression.codec", "zstd")
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return own


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` must point to shared storage: an
    unset one raises, as executors would write to their own disks. The
    local fallback exists for ``local[n]`` masters (tests, one machine).
    """
    path = None
    try:
        path = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # pragma: no cover - conf access differs on Connect
        path = None
    sc = None
    try:
        sc = spark.sparkContext
        path = path or sc.getCheckpointDir()
    except Exception:  # pragma: no cover - Spark Connect has no context
        sc = None
    if not path:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="layerkit-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(path)
    elif sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared scratch area for one run."""
    base = ensure_checkpoint_dir(spark)
    # SparkContext.setCheckpointDir appends a per-application uuid folder;
    # both forms are shared storage, so either is a valid parent.
    base = base[len("file:"):] if base.startswith("file:") else base
    return os.path.join(base, "layerkit", f"{label}-{uuid.uuid4().hex[:12]}")
