"""Composite jobs built from the operators.

``gold``     summary models G1–G5
``silver``   clean-table specs T1–T7 and ``apply_spec`` / ``write_clean``
``bronze``   raw ingestion B1–B3
``drift``    schema registry and drift detection D1–D3
``layered``  raw → clean → summary run over any sources and specs (M1)
``clinical`` the clinical batch run: CSV → seven clean specs → five models
``merge``    upsert on parquet tables (E1)
"""

from . import bronze, clinical, drift, gold, layered, merge, silver

__all__ = ["bronze", "clinical", "drift", "gold", "layered", "merge", "silver"]
