"""Summary models on small clinical-shaped fixtures (FIXTURES.md §2)."""

import datetime as dt

from conftest import rows
from layerkit.plans import gold


def _fixtures(spark):
    patients = spark.createDataFrame(
        [("p1", 30, "F", False, "Married"), ("p2", 40, "M", True, "Single"),
         ("p3", 50, "F", False, "Unknown")],
        "id string, patient_age int, gender string, is_deceased boolean, marital_status string")
    d = dt.datetime
    encounters = spark.createDataFrame(
        [("e1", "p1", "v1", d(2024, 1, 1), 10, 100.0, "amb"),
         ("e2", "p1", "v1", d(2024, 1, 31), None, 50.5, "amb"),     # gap 30 days
         ("e3", "p1", "v2", d(2024, 3, 2), 20, 10.0, "emer"),       # gap 31 days
         ("e4", "p2", None, d(2024, 2, 1), 30, 1.0, "amb"),         # NULL provider
         ("e5", "p2", None, d(2024, 2, 1), 40, 2.0, "amb"),         # equal start
         ("e6", "px", "v1", d(2024, 5, 1), 5, 3.0, "amb")],         # no such patient
        "id string, patient_id string, provider_id string, start timestamp_ntz, "
        "duration_minutes int, cost double, encounterclass string")
    conditions = spark.createDataFrame(
        [("p1", "e1", "c1", "flu"), ("p1", "e1", "c2", "cold"), ("p1", "e1", "c1", "flu"),
         ("p1", "e3", "c1", "influenza"), ("p2", "e4", "c3", "cough")],
        "patient_id string, encounter_id string, condition_code string, condition_description string")
    return patients, encounters, conditions


def test_entity_summary(spark):
    p, e, c = _fixtures(spark)
    out = {r["id"]: r for r in gold.entity_summary(p, e, c).collect()}
    assert out["p1"]["total_encounters"] == 3 and out["p1"]["unique_conditions"] == 2
    assert out["p1"]["total_spend"] == 160.5
    assert out["p1"]["first_encounter_date"] == dt.date(2024, 1, 1)
    assert out["p3"]["total_encounters"] is None and out["p3"]["unique_conditions"] is None
    assert len(out) == 3


def test_event_detail(spark):
    p, e, c = _fixtures(spark)
    out = gold.event_detail(
        e, c, p,
        event_cols={"encounter_id": "id", "patient_id": "patient_id"},
        fact_cols={"condition_code": "condition_code"},
        entity_cols={"gender": "gender"}, event_entity="patient_id")
    got = rows(out, "encounter_id", "condition_code", "has_condition")
    assert ("e6", None, False) not in got                     # no patient → dropped
    assert [g for g in got if g[0] == "e1"] == [("e1", "c1", True), ("e1", "c1", True),
                                                ("e1", "c2", True)]
    assert ("e2", None, False) in got
    assert len(got) == 7


def test_prevalence(spark):
    p, e, c = _fixtures(spark)
    out = rows(gold.prevalence(c, p, ["condition_code", "condition_description"]))
    assert ("c1", "flu", 1, 3, out[0][4]) == out[0]
    assert float(out[0][4]) == 33.33
    assert {(r[0], r[1]) for r in out} == {("c1", "flu"), ("c1", "influenza"),
                                           ("c2", "cold"), ("c3", "cough")}


def test_group_metrics(spark):
    _, e, _ = _fixtures(spark)
    out = {r["provider_id"]: r for r in gold.group_metrics(e).collect()}
    assert out["v1"]["total_encounters"] == 3 and out["v1"]["count_patients"] == 2
    assert out["v1"]["avg_duration_minutes"] == 7.5             # NULL duration ignored
    assert out[None]["total_encounters"] == 2                   # NULL provider is a group


def test_next_event_risk(spark):
    _, e, _ = _fixtures(spark)
    for sliced in (True, False):
        out = {r["encounter_id"]: r for r in gold.next_event_risk(e, sliced=sliced).collect()}
        assert out["e1"]["days_to_next_encounter"] == 30 and out["e1"]["is_readmission_risk"]
        assert out["e2"]["days_to_next_encounter"] == 31 and not out["e2"]["is_readmission_risk"]
        assert out["e3"]["next_encounter_date"] is None and not out["e3"]["is_readmission_risk"]
        assert out["e4"]["days_to_next_encounter"] == 0            # tie broken by id
        assert out["e5"]["next_encounter_date"] is None


def test_entity_summary_fill_zero(spark):
    p, e, c = _fixtures(spark)
    out = {r["id"]: r for r in gold.entity_summary(p, e, c, fill_zero=True).collect()}
    assert out["p3"]["total_encounters"] == 0 and out["p3"]["unique_conditions"] == 0
    assert out["p3"]["total_spend"] is None
