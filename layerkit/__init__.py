"""layerkit — layered (raw → clean → summary) batch analytics on Apache Spark.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column``)
function built from Spark's own expressions, so Catalyst sees the whole
plan: projections collapse, filters reach the parquet scan, and joins and
aggregates pick their physical strategy at run time (AQE).

Sub-packages
------------
``sources``    readers: CSV, catalog tables, inline relations, schema harvest
``sinks``      writers: append, overwrite, partitioned, scoped replace,
               schema-evolving append, observed row counts
``functions``  column expressions: null-tolerant casts, decodes, flags,
               surrogate keys, date arithmetic
``operators``  DataFrame operators: column normalisation, audit stamps,
               keep-latest de-duplication, lookups, keyed diffs,
               skew-safe sequence neighbours, frequencies, quality checks
``plans``      composite jobs: clean-table specs, summary models,
               schema drift, ingestion, the layered batch run, upsert
``streaming``  incremental reads by high-water mark (batch and
               ``availableNow`` streaming form)
"""

__version__ = "0.1.0"
