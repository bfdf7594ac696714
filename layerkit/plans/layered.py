"""The layered batch run (M1): raw → clean → summary.

Each layer is written before the next one reads it, so lineage is cut at
every layer boundary (a lost executor recomputes at most one layer from
stored files) and every table is written by exactly one action.

Tables inside one layer do not depend on each other, so their jobs are
submitted together from a small thread pool (Spark schedules concurrent
jobs of one session side by side). On a large cluster each job fills the
executors anyway; on small tables this removes the idle gaps between
latency-bound jobs. A failing table raises after its layer has finished.
Large tables have no such gaps; those that a caller names run one at a
time, so that only one of them has its shuffle files on disk.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import stamp
from ..sinks.tables import write_table
from .silver import CleanSpec, write_clean


@dataclass(frozen=True)
class Layers:
    raw: str
    clean: str
    summary: str


def to_raw(df: DataFrame, source_label: str) -> DataFrame:
    """Model a raw landing table: mixed-case names, every value as text, stamps."""
    text = df.select(*[F.col(c).cast("string").alias(c.upper()) for c in df.columns])
    return stamp(text, "_ingested_at", "_source_file", source_label)


# A job over more than this (bytes, as stored) has tasks for many cores.
ALONE_BYTES = 64 << 20


def stored_bytes(df: DataFrame) -> int:
    """Size of the files that a plain table read covers: metadata, no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _run_layer(jobs: dict, parallel: int, alone=()) -> dict:
    """Run independent ``name → callable`` jobs; return ``name → result``.

    Those named in ``alone`` run first, in that order, one at a time.
    """
    if parallel <= 1 or len(jobs) <= 1:
        return {name: job() for name, job in jobs.items()}
    futures = {}
    for names, workers in ((list(alone), 1), ([name for name in jobs if name not in alone], parallel)):
        with ThreadPoolExecutor(max_workers=workers) as pool:
            futures |= {name: pool.submit(jobs[name]) for name in names}
    return {name: futures[name].result() for name in jobs}


def run_layers(spark: SparkSession, sources: dict, specs: dict, layers: Layers,
               models: dict, parallel: int = 4) -> DataFrame:
    """Ingest every source, clean it with its spec, build the summary models.

    ``sources`` name → DataFrame of landed data; ``specs`` name → CleanSpec;
    ``models`` name → ``f(clean_tables: dict[str, DataFrame]) -> DataFrame``.
    ``parallel`` bounds the concurrent jobs within one layer.
    Returns one status row per written table (layer, table, rows).
    """
    raw_rows = _run_layer(
        {name: (lambda name=name, df=df: write_table(
            to_raw(df, name), f"{layers.raw}.{name}", mode="append"))
         for name, df in sources.items()}, parallel)

    for spec in specs.values():
        assert isinstance(spec, CleanSpec)
    clean_rows = _run_layer(
        {name: (lambda name=name, spec=spec: write_clean(
            spark.table(f"{layers.raw}.{name}"), spec, f"{layers.clean}.{name}"))
         for name, spec in specs.items()}, parallel)
    clean = {name: spark.table(f"{layers.clean}.{name}") for name in specs}

    summary_rows = _run_layer(
        {name: (lambda name=name, model=model: write_table(
            model(clean), f"{layers.summary}.{name}", mode="overwrite"))
         for name, model in models.items()}, parallel)

    status = ([("raw", n, raw_rows[n]) for n in sources]
              + [("clean", n, clean_rows[n]) for n in specs]
              + [("summary", n, summary_rows[n]) for n in models])
    return spark.createDataFrame(status, "layer string, table_name string, row_count bigint")
