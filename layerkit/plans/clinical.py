"""The clinical batch run (M1 on the clinical layout).

Raw CSV tables are ingested as text (B2, optionally a catalog claims table,
B3), every raw table that exists is cleaned with its spec (T1–T7), and the
five summary models (G1–G5) are built from the clean tables. Tables of one
layer run as concurrent jobs; each layer is written before the next reads
it. A table that fails to ingest is reported in the status rows and its
clean step is skipped, instead of cleaning stale raw data silently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.tables import write_table
from . import gold
from .bronze import CsvSource, ingest_status, ingest_table_source
from .drift import capture_schema, detect_drift
from .layered import ALONE_BYTES, _run_layer, stored_bytes
from .silver import apply_spec, clinical_specs, write_clean

# The raw tables of the clinical layout.
CLINICAL_TABLES = ("patients", "encounters", "conditions", "medications", "observations",
                   "procedures", "allergies", "careplans", "imaging_studies", "immunizations",
                   "organizations", "providers")


def encounter_summary(encounters: DataFrame, conditions: DataFrame,
                      patients: DataFrame) -> DataFrame:
    """G2 with the clinical column names."""
    return gold.event_detail(
        encounters, conditions, patients,
        event_cols={"encounter_id": "id", "patient_id": "patient_id",
                    "encounter_start": "start", "encounter_end": "stop",
                    "duration_minutes": "duration_minutes", "encounter_cost": "cost",
                    "encounter_class": "encounterclass", "encounter_year": "encounter_year",
                    "encounter_month": "encounter_month"},
        fact_cols={"condition_code": "condition_code",
                   "condition_description": "condition_description"},
        entity_cols={"patient_age": "patient_age", "gender": "gender"},
        order=["encounter_id", "patient_id", "encounter_start", "encounter_end",
               "duration_minutes", "encounter_cost", "encounter_class", "condition_code",
               "condition_description", "has_condition", "patient_age", "gender",
               "encounter_year", "encounter_month"])


def clinical_models(clean: dict) -> dict:
    """The five summary models over clean patients / encounters / conditions, as functions.

    A model is planned when it is called: the readmission one runs a job of
    its own for that, which a run without this model must not pay.
    """
    p, e, c = clean["patients"], clean["encounters"], clean["conditions"]
    return {
        "patient_summary": lambda: gold.entity_summary(p, e, c),
        "encounter_summary": lambda: encounter_summary(e, c, p),
        "condition_prevalence": lambda: gold.prevalence(c, p, ["condition_code", "condition_description"]),
        "provider_metrics": lambda: gold.group_metrics(e),
        "readmission_risk": lambda: gold.next_event_risk(e),
    }


def _plans(raw: DataFrame, spec) -> bool:
    """Whether the spec fits the raw table; one that does not is reported when it is written, and its clean table stays."""
    try:
        apply_spec(raw, spec)
        return True
    except Exception:  # noqa: BLE001 - raised again by the write
        return False


def run_clinical_batch(spark: SparkSession, source: CsvSource, clean_db: str, summary_db: str,
                       tables=CLINICAL_TABLES, claims_table: str | None = None,
                       as_of=None, parallel: int = 4, drift: tuple | None = None,
                       models=None, ingested=None) -> DataFrame:
    """Ingest → clean → summarise → drift; one status row per table and layer.

    A table that fails to ingest, the claims table included, is reported
    and its clean step is skipped; the others go on. ``drift`` names
    (registry, log): after the run the raw and clean schemas are compared
    with their baselines, which a schema without one gets now. ``models``
    names the summary models to build (default: all five). ``ingested`` is
    called once the raw tables are written, when what landed may go.

    Disk: the clean tables that are made anew go before the first of them is
    written, and large ones are written one after the other, those with the
    most to shuffle first, while the fewest others lie there.
    """
    status = [(r["table_name"], "raw", r["status"], r["row_count"])
              for r in ingest_status(spark, source, tables, parallel=parallel)]
    if claims_table:
        try:
            n = ingest_table_source(spark, claims_table, source.target("claims"))
            status.append(("claims", "raw", "ok", n))
        except Exception:  # noqa: BLE001 - one table's failure does not stop the run
            status.append(("claims", "raw", "error", None))
    ok = [name for name, _, state, _ in status if state == "ok"]
    if ingested:
        ingested()

    specs = clinical_specs(as_of=as_of)
    # partitioned tables are shuffled twice
    load = {name: stored_bytes(spark.table(source.target(name))) * (2 if specs[name].partition_by else 1)
            for name in ok if name in specs}
    for name in load:
        if _plans(spark.table(source.target(name)), specs[name]):
            spark.sql(f"DROP TABLE IF EXISTS {clean_db}.{name}")
    cleaned = _run_layer(
        {name: (lambda name=name: write_clean(spark.table(source.target(name)), specs[name],
                                              f"{clean_db}.{name}"))
         for name in load}, parallel,
        alone=sorted((n for n in load if load[n] > ALONE_BYTES), key=lambda n: -load[n]))
    status += [(name, "clean", "ok", n) for name, n in cleaned.items()]

    if {"patients", "encounters", "conditions"} <= set(cleaned):
        clean = {n: spark.table(f"{clean_db}.{n}") for n in cleaned}
        wanted = {n: model for n, model in clinical_models(clean).items() if models is None or n in models}
        large = sum(stored_bytes(clean[n]) for n in ("patients", "encounters", "conditions")) > ALONE_BYTES
        built = _run_layer(
            {name: (lambda name=name, model=model: write_table(model(), f"{summary_db}.{name}", "overwrite"))
             for name, model in wanted.items()}, parallel, alone=list(wanted) if large else ())
        status += [(name, "summary", "ok", n) for name, n in built.items()]
    if drift:
        registry, log = drift
        for layer, db in (("raw", source.target_database), ("clean", clean_db)):
            known = spark.catalog.tableExists(registry) and not spark.table(registry).filter(
                F.col("schema_name") == db).isEmpty()
            if known:
                events = detect_drift(spark, db, registry, log).count()
            else:
                capture_schema(spark, db, registry)
                events = 0
            status.append(("schema_drift", layer, "ok", events))
    return spark.createDataFrame(
        status, "table_name string, layer string, status string, row_count bigint")
