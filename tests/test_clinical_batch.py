"""The clinical batch run end to end on fixture CSV files."""

import uuid

from layerkit.plans.bronze import CsvSource
from layerkit.plans.clinical import run_clinical_batch
from layerkit.session import scratch_path
from layerkit.sources import create_database


def _csv(path, header, rows):
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join("" if v is None else v for v in r) + "\n")


def test_run_clinical_batch(spark):
    land = scratch_path(spark, "clinical-land")
    raw, clean, summary = (create_database(spark, n, scratch_path(spark, n))
                           for n in (f"r_{uuid.uuid4().hex[:6]}", f"c_{uuid.uuid4().hex[:6]}",
                                     f"s_{uuid.uuid4().hex[:6]}"))
    _csv(f"{land}/patients.csv", ["Id", "BIRTHDATE", "DEATHDATE", "MARITAL", "SSN", "DRIVERS",
                                  "PASSPORT", "GENDER"],
         [("p1", "1980-02-01", "-", "M", "s", "d", "x", "F"),
          ("p2", "1990-07-04", "2023-01-01", "S", "s", "d", "x", "M"),
          ("p3", "2000-01-01", "-", "", "s", "d", "x", "F")])
    _csv(f"{land}/encounters.csv", ["Id", "START", "STOP", "PATIENT", "PROVIDER", "COST",
                                    "ENCOUNTERCLASS"],
         [("e1", "2024-01-01T08:00:00Z", "2024-01-01T09:00:00Z", "p1", "v1", "100.5", "amb"),
          ("e2", "2024-01-20T08:00:00Z", "2024-01-20T08:30:00Z", "p1", "v1", "20", "amb"),
          ("e3", "2024-02-01T08:00:00Z", "2024-02-01T10:00:00Z", "p2", "v2", "7", "emer"),
          ("e4", "2024-03-01T08:00:00Z", "2024-03-01T08:10:00Z", "px", "v2", "1", "amb")])
    _csv(f"{land}/conditions.csv", ["START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION"],
         [("2024-01-01", "", "p1", "e1", "c1", "flu"), ("2024-01-01", "", "p1", "e1", "c2", "cold"),
          ("2024-02-01", "", "p2", "e3", "c1", "flu")])
    status = {(r["table_name"], r["layer"]): r for r in run_clinical_batch(
        spark, CsvSource(land, raw, "src"), clean, summary,
        tables=["patients", "encounters", "conditions", "medications"],
        as_of="2024-06-30").collect()}
    assert status[("medications", "raw")]["status"] == "error"          # missing file isolated
    assert ("medications", "clean") not in status
    assert status[("patients", "clean")]["row_count"] == 3
    assert status[("patient_summary", "summary")]["row_count"] == 3        # one per patient
    assert status[("readmission_risk", "summary")]["row_count"] == 4       # one per encounter
    enc = spark.table(f"{summary}.encounter_summary")
    assert enc.count() == 4                    # e1 × 2 conditions, e2, e3; e4 has no patient
    risk = {r["encounter_id"]: r for r in spark.table(f"{summary}.readmission_risk").collect()}
    assert risk["e1"]["days_to_next_encounter"] == 19 and risk["e1"]["is_readmission_risk"]
    prev = {r["condition_code"]: r for r in spark.table(f"{summary}.condition_prevalence").collect()}
    assert prev["c1"]["patient_count"] == 2 and float(prev["c1"]["prevalence_pct"]) == 66.67
