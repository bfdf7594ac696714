"""The seven clinical clean-table specs on raw text fixtures."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerkit.operators.columns import stamp
from layerkit.plans.silver import apply_spec, clinical_specs

AS_OF = "2024-12-31"


def raw(spark, data, cols, ts=None):
    df = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))
    if ts is not None:
        df = df.withColumn("_ingested_at", F.lit(ts).cast("timestamp"))
        return df.withColumn("_source_file", F.lit("fixture"))
    return stamp(df, "_ingested_at", "_source_file", "fixture")


@pytest.fixture(scope="module")
def specs():
    return clinical_specs(as_of=AS_OF)


def test_patients(spark, specs):
    cols = ["Id", "BIRTHDATE", "DEATHDATE", "MARITAL", "SSN", "DRIVERS", "PASSPORT", "GENDER"]
    old = raw(spark, [("p1", "1990-01-01", "-", "S", "1", "2", "3", "F")], cols, "2024-01-01 00:00:00")
    new = raw(spark, [("p1", "1990-01-01", "2020-05-05", "M", "1", "2", "3", "F"),
                      ("p2", "2000-06-15", None, "X", "4", "5", "6", "M")], cols, "2024-02-01 00:00:00")
    out = {r["id"]: r for r in apply_spec(old.unionByName(new), specs["patients"]).collect()}
    assert set(out) == {"p1", "p2"}
    p1 = out["p1"]
    assert p1["marital_status"] == "Married" and p1["is_deceased"] is True
    assert p1["deathdate"] == dt.date(2020, 5, 5) and p1["patient_age"] == 35
    assert out["p2"]["marital_status"] == "Unknown" and out["p2"]["is_deceased"] is False
    for c in ("ssn", "drivers", "passport", "marital"):
        assert c not in p1.asDict()
    assert p1["_silver_processed_at"] is not None


def test_encounters(spark, specs):
    cols = ["Id", "START", "STOP", "PATIENT", "PROVIDER", "COST", "ENCOUNTERCLASS"]
    df = raw(spark, [("e1", "2024-03-01T10:00:00Z", "2024-03-01T11:30:59Z", "p1", "v1", "12.5", "amb"),
                     ("e2", "bad", None, "p1", "v1", "x", "amb")], cols)
    out = {r["id"]: r for r in apply_spec(df, specs["encounters"]).collect()}
    e1 = out["e1"]
    assert e1["duration_minutes"] == 90 and e1["cost"] == 12.5
    assert e1["patient_id"] == "p1" and e1["provider_id"] == "v1"
    assert (e1["encounter_year"], e1["encounter_month"]) == (2024, 3)
    assert out["e2"]["start"] is None and out["e2"]["cost"] is None


def test_conditions_key_and_dedup(spark, specs):
    cols = ["START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION"]
    df = raw(spark, [("2024-01-01", None, "p1", "e1", "c1", "flu"),
                     ("2024-01-01", None, "p1", "e1", "c1", "flu"),
                     ("2024-01-02", None, "p1", "e1", "c1", "flu")], cols)
    out = apply_spec(df, specs["conditions"]).collect()
    assert len(out) == 2
    assert {len(r["condition_id"]) for r in out} == {32}
    assert out[0]["condition_code"] == "c1"


def test_medications(spark, specs):
    cols = ["START", "STOP", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION",
            "COST", "DISPENSES", "TOTALCOST"]
    df = raw(spark, [("2024-01-01", "2024-02-01", "p1", "e1", "m1", "pill", "1.5", "3", "4.5")], cols)
    r = apply_spec(df, specs["medications"]).first()
    assert (r["cost"], r["dispenses"], r["totalcost"]) == (1.5, 3, 4.5)
    assert r["medication_code"] == "m1" and r["stop"] == dt.date(2024, 2, 1)


def test_observations_split(spark, specs):
    cols = ["DATE", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "VALUE", "TYPE"]
    df = raw(spark, [("2024-04-05", "p1", "e1", "o1", "bp", "120.5", "numeric"),
                     ("2024-04-05", "p1", "e1", "o2", "smoker", "never", "text"),
                     ("2024-04-06", "p1", "e1", "o3", "x", "1", "other")], cols)
    out = {r["observation_code"]: r for r in apply_spec(df, specs["observations"]).collect()}
    assert out["o1"]["numeric_value"] == 120.5 and out["o1"]["text_value"] is None
    assert out["o2"]["text_value"] == "never" and out["o2"]["numeric_value"] is None
    assert out["o3"]["numeric_value"] is None and out["o3"]["text_value"] is None
    assert "value" not in out["o1"].asDict()
    assert (out["o1"]["observation_year"], out["o1"]["observation_month"]) == (2024, 4)


def test_procedures(spark, specs):
    cols = ["DATE", "PATIENT", "ENCOUNTER", "CODE", "DESCRIPTION", "COST"]
    r = apply_spec(raw(spark, [("2023-07-01", "p1", "e1", "x1", "xray", "99.9")], cols),
                   specs["procedures"]).first()
    assert r["procedure_year"] == 2023 and r["cost"] == 99.9 and len(r["procedure_id"]) == 32


def test_claims(spark, specs):
    cols = ["claim_id", "service_line_number", "diagnosis_code", "date_service", "line_charge",
            "line_allowed", "patient_year_of_birth", "claim_type", "prov_rendering_npi"]
    df = raw(spark, [("c1", "1", "J45", "2024-01-01", "100.005", "80", "1980", "P", "1234567890"),
                     ("c1", "2", "U07", "2024-01-01", "abc", "1", "x", "Z", "123"),
                     ("c2", "1", None, None, None, None, None, None, None)], cols)
    out = {(r["claim_id"], r["service_line_number"]): r
           for r in apply_spec(df, specs["claims"]).collect()}
    a = out[("c1", 1)]
    assert a["icd10_letter"] == "J" and a["diagnosis_category"] == "Respiratory"
    assert a["line_charge"] == Decimal("100.01") and a["cost_reduction"] == Decimal("20.01")
    assert a["patient_age"] == 44 and a["claim_type_decoded"] == "Professional"
    assert a["is_valid_npi"] is True
    b = out[("c1", 2)]
    assert b["diagnosis_category"] is None and b["line_charge"] is None
    assert b["claim_type_decoded"] is None and b["is_valid_npi"] is False
    assert out[("c2", 1)]["is_valid_npi"] is False


def test_readme_flow_on_fixture(spark, specs):
    import uuid
    from layerkit.plans import gold
    from layerkit.plans.drift import capture_schema, run_drift_check
    from layerkit.plans.silver import write_clean
    from layerkit.session import scratch_path
    from layerkit.sources import create_database
    clean_db, ctl = (create_database(spark, n, scratch_path(spark, n))
                     for n in (f"c_{uuid.uuid4().hex[:6]}", f"k_{uuid.uuid4().hex[:6]}"))
    cols = ["Id", "START", "STOP", "PATIENT", "PROVIDER", "COST", "ENCOUNTERCLASS"]
    df = raw(spark, [("e1", "2024-03-01T10:00:00Z", "2024-03-01T11:00:00Z", "p1", "v1", "10", "a"),
                     ("e2", "2024-03-20T10:00:00Z", "2024-03-20T10:30:00Z", "p1", "v1", "5", "a"),
                     ("e3", "2024-05-01T10:00:00Z", None, "p2", "v2", "1", "b")], cols)
    write_clean(df, specs["encounters"], f"{clean_db}.encounters")
    enc = spark.table(f"{clean_db}.encounters")
    m = {r["provider_id"]: r for r in gold.group_metrics(enc).collect()}
    assert m["v1"]["total_encounters"] == 2 and m["v1"]["avg_duration_minutes"] == 45.0
    risk = {r["encounter_id"]: r for r in gold.next_event_risk(enc).collect()}
    assert risk["e1"]["days_to_next_encounter"] == 19 and risk["e1"]["is_readmission_risk"]
    capture_schema(spark, clean_db, f"{ctl}.schema_registry")
    assert run_drift_check(spark, [clean_db], f"{ctl}.schema_registry",
                           f"{ctl}.schema_drift_log").count() == 0
