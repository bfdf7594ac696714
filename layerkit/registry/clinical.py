"""The seven clinical clean-table specs (T1–T7) on raw text built from the
driver tables, and the whole clinical batch run (M1).

Each raw table is derived from the driver tables with Spark in the clinical
shape (mixed-case names, every value text). Role map: patient ← customer,
encounter ← order, condition / medication / procedure ← line item,
observation ← event, claim line ← line item. There are two raw batches: the
second one, ingested later, repeats some keys with changed values, and the
production specs must keep it. Keys are unique within a batch.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..plans.bronze import CsvSource
from ..plans.clinical import CLINICAL_TABLES, run_clinical_batch
from ..plans.layered import to_raw
from ..plans.silver import clinical_specs, write_clean
from ..session import fine_session, remove_folder, scratch_path
from ..sinks.tables import write_table
from .common import AS_OF, iso_z_text, t
from .io import scratch_db

FIRST, SECOND = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def _money_text(c):
    return F.col(c).cast("decimal(12,2)").cast("string")


def _lines(spark, sf_dir):
    li = t(spark, sf_dir, "lineitem")
    o = t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")


def raw_patients(spark, sf_dir, later):
    c = t(spark, sf_dir, "customer")
    c = c.filter("c_custkey % 3 = 0") if later else c
    birth = F.date_add(F.lit(dt.date(1940, 1, 1)), ((F.col("c_acctbal") + 1000) * 2).cast("int"))
    return c.select(
        F.col("c_custkey").alias("Id"), birth.alias("Birthdate"),
        F.when(F.col("c_acctbal") < 0, F.date_add(birth, 25000).cast("string"))
         .otherwise(F.lit("-")).alias("Deathdate"),
        (F.lit("M") if later else
         F.when(F.col("c_mktsegment") == "MACHINERY", "M")
          .when(F.col("c_mktsegment") == "BUILDING", "S")
          .when(F.col("c_mktsegment") == "AUTOMOBILE", None).otherwise("W")).alias("Marital"),
        F.col("c_name").alias("Ssn"), F.col("c_name").alias("Drivers"),
        F.col("c_name").alias("Passport"),
        F.when(F.col("c_acctbal") >= 5000, "F").otherwise("M").alias("Gender"))


def raw_encounters(spark, sf_dir, later):
    o = t(spark, sf_dir, "orders")
    o = o.filter("o_orderkey % 5 = 0") if later else o
    stop = F.timestamp_add("SECOND", (F.col("o_totalprice") / 10).cast("int"), F.col("o_orderdate"))
    return o.select(
        F.col("o_orderkey").alias("Id"),
        F.when(F.col("o_orderstatus") == "P", F.lit("bad"))
         .otherwise(iso_z_text("o_orderdate")).alias("Start"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("9999-12-31T00:00:00Z"))
         .otherwise(iso_z_text(stop)).alias("Stop"),
        F.col("o_custkey").alias("Patient"), F.col("o_orderpriority").alias("Provider"),
        (F.lit("12.50") if later else _money_text("o_totalprice")).alias("Cost"),
        F.col("o_orderstatus").alias("EncounterClass"))


def raw_conditions(spark, sf_dir, later):
    li = _lines(spark, sf_dir).groupBy("o_custkey", "l_orderkey", "l_returnflag", "l_shipdate").agg(
        F.max("l_linestatus").alias("status"))
    li = li.filter("l_orderkey % 5 = 0") if later else li
    return li.select(
        F.to_date("l_shipdate").alias("START"), F.date_add(F.to_date("l_shipdate"), 10).alias("STOP"),
        F.col("o_custkey").alias("PATIENT"), F.col("l_orderkey").alias("ENCOUNTER"),
        F.col("l_returnflag").alias("CODE"),
        (F.lit("revised") if later else F.col("status")).alias("DESCRIPTION"))


def raw_medications(spark, sf_dir, later):
    li = _lines(spark, sf_dir).groupBy("o_custkey", "l_orderkey", "l_partkey", "l_shipdate").agg(
        F.max("l_returnflag").alias("flag"), F.max("l_extendedprice").alias("price"),
        F.max("l_quantity").alias("quantity"), F.max("l_tax").alias("tax"))
    li = li.filter("l_orderkey % 5 = 0") if later else li
    return li.select(
        F.to_date("l_shipdate").alias("START"),
        F.date_add(F.to_date("l_shipdate"), 30).alias("STOP"),
        F.col("o_custkey").alias("PATIENT"), F.col("l_orderkey").alias("ENCOUNTER"),
        F.col("l_partkey").alias("CODE"), F.col("flag").alias("DESCRIPTION"),
        _money_text("price").alias("COST"),
        (F.lit("7.99999") if later else F.col("quantity")).alias("DISPENSES"),
        F.col("tax").alias("TOTALCOST"))


def raw_observations(spark, sf_dir, later):
    e = t(spark, sf_dir, "events").withColumn("day", F.to_date("ts")).groupBy("day", "user_id", "event_type").agg(
        F.max("value").alias("value"), F.max("props").alias("props"))
    e = e.filter("user_id % 3 = 0") if later else e
    numeric = F.col("event_type").isin("purchase", "click")
    return e.select(
        F.col("day").alias("DATE"), F.col("user_id").alias("PATIENT"),
        F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("ENCOUNTER"),
        F.col("event_type").alias("CODE"),
        (F.lit("revised") if later else F.col("event_type")).alias("DESCRIPTION"),
        F.when(numeric, F.col("value").cast("string")).otherwise(F.col("props")).alias("VALUE"),
        F.when(numeric, F.lit("numeric")).when(F.col("event_type") == "view", F.lit("text"))
         .otherwise(F.col("event_type")).alias("TYPE"))


def raw_procedures(spark, sf_dir, later):
    li = _lines(spark, sf_dir).groupBy("o_custkey", "l_orderkey", "l_returnflag", "l_linestatus", "l_shipdate").agg(
        F.max("l_extendedprice").alias("price"))
    li = li.filter("l_orderkey % 5 = 0") if later else li
    return li.select(
        F.to_date("l_shipdate").alias("DATE"),
        F.col("o_custkey").alias("PATIENT"), F.col("l_orderkey").alias("ENCOUNTER"),
        F.concat("l_returnflag", "l_linestatus").alias("CODE"),
        F.lit("line service").alias("DESCRIPTION"),
        (F.lit("3.25") if later else _money_text("price")).alias("COST"))


def raw_claims(spark, sf_dir, later):
    li = t(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        *[F.max(c).alias(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                                      "l_returnflag", "l_linestatus", "l_shipdate")])
    li = li.filter("l_orderkey % 5 = 0") if later else li
    allowed = (F.col("l_extendedprice").cast("decimal(12,2)")
               * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")))
    letter = F.char((F.lit(65) + F.col("l_partkey") % 26).cast("int"))
    return li.select(
        F.col("l_orderkey").cast("string").alias("claim_id"),
        F.col("l_linenumber").cast("string").alias("service_line_number"),
        F.when(F.col("l_partkey") % 31 == 0, F.lit(None))
         .otherwise(F.concat(F.when(F.col("l_partkey") % 29 == 0, F.lower(letter)).otherwise(letter),
                             F.col("l_partkey").cast("string"))).alias("diagnosis_code"),
        F.to_date("l_shipdate").cast("string").alias("date_service"),
        (F.lit("100.00") if later else _money_text("l_extendedprice")).alias("line_charge"),
        allowed.cast("string").alias("line_allowed"),
        (F.lit(1900) + F.col("l_quantity")).cast("string").alias("patient_year_of_birth"),
        F.when(F.col("l_returnflag") == "R", "P").when(F.col("l_returnflag") == "A", "I")
         .otherwise("N").alias("claim_type"),
        F.when(F.col("l_linestatus") == "O", F.lpad(F.col("l_suppkey").cast("string"), 10, "0"))
         .otherwise(F.col("l_suppkey").cast("string")).alias("prov_rendering_npi"))


RAW = {"patients": raw_patients, "encounters": raw_encounters, "conditions": raw_conditions,
       "medications": raw_medications, "observations": raw_observations,
       "procedures": raw_procedures, "claims": raw_claims}

COLUMNS = {
    "patients": ["id", "birthdate", "deathdate", "gender", "patient_age", "is_deceased", "marital_status"],
    "encounters": ["id", "start", "stop", "duration_minutes", "cost", "patient_id", "provider_id",
                   "encounterclass", "encounter_year", "encounter_month"],
    "conditions": ["condition_id", "start", "stop", "patient_id", "encounter_id", "condition_code",
                   "condition_description"],
    "medications": ["medication_id", "start", "stop", "patient_id", "encounter_id", "medication_code",
                    "medication_description", "cost", "dispenses", "totalcost"],
    "observations": ["observation_id", "date", "patient_id", "encounter_id", "observation_code",
                     "observation_description", "type", "numeric_value", "text_value",
                     "observation_year", "observation_month"],
    "procedures": ["procedure_id", "date", "patient_id", "encounter_id", "procedure_code",
                   "procedure_description", "cost", "procedure_year"],
    "claims": ["claim_line_id", "claim_id", "service_line_number", "diagnosis_code", "icd10_letter",
               "diagnosis_category", "date_service", "line_charge", "line_allowed", "cost_reduction",
               "patient_year_of_birth", "patient_age", "claim_type", "claim_type_decoded",
               "prov_rendering_npi", "is_valid_npi"],
}


def _batches(spark, sf_dir, name):
    """Both raw batches, stamped with their ingest times."""
    def one(later):
        raw = RAW[name](spark, sf_dir, later)
        if name != "claims":
            raw = to_raw(raw, f"{name}.csv")
        else:
            raw = raw.withColumn("_source_file", F.lit("claims_table"))
        return raw.withColumn("_ingested_at", F.lit(SECOND if later else FIRST).cast("timestamp"))
    return one(False).unionByName(one(True))


def _clean_query(name):
    def query(spark, sf_dir):
        db = scratch_db(spark, f"clin_{name}")
        write_clean(_batches(fine_session(spark), sf_dir, name), clinical_specs(as_of=AS_OF)[name], f"{db}.{name}")
        return spark.table(f"{db}.{name}").select(*COLUMNS[name])
    query.__name__ = f"clean_{name}"
    query.__doc__ = f"T: two raw batches of {name}, the later one wins per key."
    return query


def rejected_values(spark, sf_dir):
    """Values that could not be typed, per table and column, counted on the cleaning write."""
    out = []
    for name in ("encounters", "medications"):
        db, seen = scratch_db(spark, f"rej_{name}"), Observation(f"rejected_{name}")
        write_clean(_batches(spark, sf_dir, name), clinical_specs(as_of=AS_OF)[name], f"{db}.{name}", seen)
        out += [(name, column, n) for column, n in seen.get.items()]
    return spark.createDataFrame(out, "table_name string, column_name string, rejected long")


# The other six raw tables of the layout; they are ingested, not cleaned.
OTHERS = {"allergies": "nation", "careplans": "part", "imaging_studies": "region", "immunizations": "supplier",
          "organizations": "region", "providers": "supplier"}
MODEL_TABLES = ("patients", "encounters", "conditions")


def _land(raw, path):
    raw.write.option("header", True).option("compression", "lz4").csv(path)


def _clinical_run(spark, sf_dir, tables=CLINICAL_TABLES, claims=True, models=None):
    """Both batches landed as CSV (claims as a catalog table), run after run: (summary database, status rows of the second run).

    What landed goes once it is in the raw tables.
    """
    spark = fine_session(spark)
    raw, clean, summary, ctl = (scratch_db(spark, f"m1_{x}") for x in ("raw", "clean", "summary", "ctl"))
    for later in (False, True):
        land = scratch_path(spark, "m1-landing")
        for name in tables:
            if name in RAW:
                _land(RAW[name](spark, sf_dir, later), f"{land}/{name}.csv")
            elif name != "providers" or not later:      # one table fails to arrive with the second batch
                _land(t(spark, sf_dir, OTHERS[name]), f"{land}/{name}.csv")
        if claims:
            write_table(raw_claims(spark, sf_dir, later), f"{ctl}.claims_source", mode="overwrite")

        def ingested(land=land):
            remove_folder(spark, land)
            if claims:
                spark.sql(f"DROP TABLE {ctl}.claims_source")
        status = run_clinical_batch(spark, CsvSource(land, raw, "raw"), clean, summary, tables=tables,
                                    claims_table=f"{ctl}.claims_source" if claims else None, as_of=AS_OF,
                                    drift=(f"{ctl}.schema_registry", f"{ctl}.schema_drift_log") if claims else None,
                                    models=models if later or models is None else (), ingested=ingested)
    return summary, status


def clinical_run(spark, sf_dir):
    """M1: status rows of the second run (12 CSV tables, claims, T1–T7, G1–G5, drift)."""
    return _clinical_run(spark, sf_dir)[1]


def _model_query(name):
    def query(spark, sf_dir):
        return spark.table(f"{_clinical_run(spark, sf_dir, MODEL_TABLES, claims=False, models=(name,))[0]}.{name}")
    query.__name__ = f"clinical_{name}"
    query.__doc__ = f"M1: the model {name} after both batches of the tables it needs."
    return query


MODELS = ("patient_summary", "encounter_summary", "condition_prevalence", "provider_metrics", "readmission_risk")

QUERIES = {f"clean_{name}": _clean_query(name) for name in RAW}
QUERIES |= {"rejected_values": rejected_values, "clinical_run": clinical_run}
QUERIES |= {f"clinical_{name}": _model_query(name) for name in MODELS}

_LINES = "(SELECT l.*, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"
_MONEY = "CAST(CAST({c} AS DECIMAL(12,2)) AS VARCHAR)"

ORACLE = {
    "clean_patients": """
WITH r AS (
  SELECT c_custkey, c_acctbal, c_mktsegment,
         DATE '1940-01-01' + CAST(TRUNC((c_acctbal + 1000) * 2) AS INTEGER) AS b
  FROM customer)
SELECT CAST(c_custkey AS VARCHAR) AS id, b AS birthdate,
       CASE WHEN c_acctbal < 0 THEN b + 25000 END AS deathdate,
       CASE WHEN c_acctbal >= 5000 THEN 'F' ELSE 'M' END AS gender,
       CAST(TRUNC(date_diff('day', b, DATE '2024-06-30') / 365.0) AS INTEGER) AS patient_age,
       c_acctbal < 0 AS is_deceased,
       CASE WHEN c_custkey % 3 = 0 OR c_mktsegment = 'MACHINERY' THEN 'Married'
            WHEN c_mktsegment = 'BUILDING' THEN 'Single' ELSE 'Unknown' END AS marital_status
FROM r
""",
    "clean_encounters": f"""
WITH r AS (
  SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN TIMESTAMP '9999-12-31'
                 ELSE o_orderdate + to_seconds(CAST(TRUNC(o_totalprice / 10) AS BIGINT)) END AS stop
  FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS start, stop,
       CASE WHEN o_orderstatus = 'P' THEN NULL
            ELSE (epoch_us(stop) - epoch_us(o_orderdate)) // 60000000 END AS duration_minutes,
       CASE WHEN o_orderkey % 5 = 0 THEN 12.5 ELSE TRY_CAST({_MONEY.format(c='o_totalprice')} AS DOUBLE) END AS cost,
       CAST(o_custkey AS VARCHAR) AS patient_id, o_orderpriority AS provider_id,
       o_orderstatus AS encounterclass,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END
         AS encounter_year,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(month(o_orderdate) AS INTEGER) END
         AS encounter_month
FROM r
""",
    "clean_conditions": f"""
WITH r AS (
  SELECT CAST(l_shipdate AS DATE) AS s, CAST(o_custkey AS VARCHAR) AS p, l_orderkey AS k,
         CAST(l_orderkey AS VARCHAR) AS e, l_returnflag AS code, max(l_linestatus) AS descr
  FROM {_LINES} x GROUP BY ALL)
SELECT md5(p || '_' || e || '_' || code || '_' || CAST(s AS VARCHAR)) AS condition_id, s AS start,
       s + 10 AS stop, p AS patient_id, e AS encounter_id, code AS condition_code,
       CASE WHEN k % 5 = 0 THEN 'revised' ELSE descr END AS condition_description
FROM r
""",
    "clean_medications": f"""
WITH r AS (
  SELECT CAST(l_shipdate AS DATE) AS s, CAST(o_custkey AS VARCHAR) AS p, l_orderkey AS k,
         CAST(l_orderkey AS VARCHAR) AS e, CAST(l_partkey AS VARCHAR) AS code, max(l_returnflag) AS descr,
         max(l_extendedprice) AS price, max(l_quantity) AS quantity, max(l_tax) AS tax
  FROM {_LINES} x GROUP BY ALL)
SELECT md5(p || '_' || e || '_' || code || '_' || CAST(s AS VARCHAR)) AS medication_id, s AS start,
       s + 30 AS stop, p AS patient_id, e AS encounter_id, code AS medication_code,
       descr AS medication_description, TRY_CAST({_MONEY.format(c='price')} AS DOUBLE) AS cost,
       CASE WHEN k % 5 = 0 THEN 7 ELSE CAST(FLOOR(quantity) AS INTEGER) END AS dispenses, tax AS totalcost
FROM r
""",
    "clean_observations": """
WITH r AS (
  SELECT CAST(ts AS DATE) AS d, user_id, event_type AS code, max(value) AS value, max(props) AS props
  FROM events GROUP BY ALL)
SELECT md5(CAST(user_id AS VARCHAR) || '_v' || CAST(user_id AS VARCHAR) || '_' || code || '_' || CAST(d AS VARCHAR))
         AS observation_id,
       d AS date, CAST(user_id AS VARCHAR) AS patient_id, 'v' || CAST(user_id AS VARCHAR) AS encounter_id,
       code AS observation_code, CASE WHEN user_id % 3 = 0 THEN 'revised' ELSE code END AS observation_description,
       CASE WHEN code IN ('purchase', 'click') THEN 'numeric' WHEN code = 'view' THEN 'text' ELSE code END AS type,
       CASE WHEN code IN ('purchase', 'click') THEN value END AS numeric_value,
       CASE WHEN code = 'view' THEN props END AS text_value,
       CAST(year(d) AS INTEGER) AS observation_year, CAST(month(d) AS INTEGER) AS observation_month
FROM r
""",
    "clean_procedures": f"""
WITH r AS (
  SELECT CAST(l_shipdate AS DATE) AS d, CAST(o_custkey AS VARCHAR) AS p, l_orderkey AS k,
         CAST(l_orderkey AS VARCHAR) AS e, l_returnflag || l_linestatus AS code, max(l_extendedprice) AS price
  FROM {_LINES} x GROUP BY ALL)
SELECT md5(p || '_' || e || '_' || code || '_' || CAST(d AS VARCHAR)) AS procedure_id, d AS date,
       p AS patient_id, e AS encounter_id, code AS procedure_code, 'line service' AS procedure_description,
       CASE WHEN k % 5 = 0 THEN 3.25 ELSE TRY_CAST({_MONEY.format(c='price')} AS DOUBLE) END AS cost,
       CAST(year(d) AS INTEGER) AS procedure_year
FROM r
""",
    # The categories below are fixed values, written out on their own here.
    "clean_claims": f"""
WITH g AS (
  SELECT l_orderkey, l_linenumber, max(l_partkey) AS part, max(l_suppkey) AS supp, max(l_quantity) AS q,
         max(l_extendedprice) AS price, max(l_discount) AS discount, max(l_returnflag) AS flag,
         max(l_linestatus) AS status, max(l_shipdate) AS ship
  FROM lineitem GROUP BY ALL),
r AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS claim_id, l_linenumber AS service_line_number,
         CASE WHEN part % 31 = 0 THEN NULL
              WHEN part % 29 = 0 THEN lower(chr(CAST(65 + part % 26 AS INTEGER))) || part
              ELSE chr(CAST(65 + part % 26 AS INTEGER)) || part END AS diagnosis_code,
         CAST(ship AS DATE) AS date_service,
         CASE WHEN l_orderkey % 5 = 0 THEN CAST(100 AS DECIMAL(10,2))
              ELSE TRY_CAST({_MONEY.format(c='price')} AS DECIMAL(10,2)) END AS line_charge,
         TRY_CAST(CAST(CAST(price AS DECIMAL(12,2)) * (1 - CAST(discount AS DECIMAL(4,2))) AS VARCHAR)
                  AS DECIMAL(10,2)) AS line_allowed,
         CAST(1900 + FLOOR(q) AS INTEGER) AS patient_year_of_birth,
         CASE flag WHEN 'R' THEN 'P' WHEN 'A' THEN 'I' ELSE 'N' END AS claim_type,
         CASE WHEN status = 'O' THEN lpad(CAST(supp AS VARCHAR), 10, '0') ELSE CAST(supp AS VARCHAR) END
           AS prov_rendering_npi
  FROM g)
SELECT md5(concat_ws('_', claim_id, service_line_number, diagnosis_code)) AS claim_line_id, claim_id,
       CAST(service_line_number AS INTEGER) AS service_line_number, diagnosis_code,
       substr(diagnosis_code, 1, 1) AS icd10_letter, m.diagnosis_category, date_service, line_charge,
       line_allowed, line_charge - line_allowed AS cost_reduction, patient_year_of_birth,
       CAST(2024 - patient_year_of_birth AS INTEGER) AS patient_age, claim_type,
       CASE claim_type WHEN 'P' THEN 'Professional' WHEN 'I' THEN 'Institutional' END AS claim_type_decoded,
       prov_rendering_npi, length(prov_rendering_npi) = 10 AS is_valid_npi
FROM r
LEFT JOIN (VALUES ('A', 'Infectious Diseases'), ('B', 'Infectious Diseases'),
  ('C', 'Neoplasms / Blood Diseases'), ('D', 'Neoplasms / Blood Diseases'), ('E', 'Endocrine / Metabolic'),
  ('F', 'Mental / Behavioral'), ('G', 'Nervous System'), ('H', 'Eye / Ear'), ('I', 'Circulatory System'),
  ('J', 'Respiratory'), ('K', 'Digestive'), ('L', 'Skin'), ('M', 'Musculoskeletal'), ('N', 'Genitourinary'),
  ('O', 'Pregnancy'), ('P', 'Perinatal'), ('Q', 'Congenital'), ('R', 'Abnormal Findings'),
  ('S', 'Injury / Poisoning'), ('T', 'Injury / Poisoning'), ('V', 'External Causes'), ('W', 'External Causes'),
  ('X', 'External Causes'), ('Y', 'External Causes'), ('Z', 'Health Services / Factors'))
  AS m(icd10_letter, diagnosis_category) ON substr(diagnosis_code, 1, 1) = m.icd10_letter
""",
    "rejected_values": """
SELECT * FROM (VALUES ('encounters', 'cost', 0), ('encounters', 'stop', 0), ('medications', 'start', 0),
  ('medications', 'stop', 0), ('medications', 'cost', 0), ('medications', 'dispenses', 0),
  ('medications', 'totalcost', 0)) AS v(table_name, column_name, rejected)
UNION ALL
SELECT 'encounters', 'start',
       COUNT(*) FILTER (o_orderstatus = 'P') + COUNT(*) FILTER (o_orderstatus = 'P' AND o_orderkey % 5 = 0)
FROM orders
""",
}

_P, _E, _C = ORACLE["clean_patients"], ORACLE["clean_encounters"], ORACLE["clean_conditions"]
_CLEAN = f"WITH p AS ({_P}), e AS ({_E}), c AS ({_C})"

ORACLE |= {
    "clinical_patient_summary": f"""
{_CLEAN},
ev AS (SELECT patient_id, COUNT(id) AS total_encounters, ROUND(SUM(cost), 2) AS total_spend,
              MIN(CAST(start AS DATE)) AS first_encounter_date, MAX(CAST(start AS DATE)) AS last_encounter_date
       FROM e GROUP BY 1),
co AS (SELECT patient_id, COUNT(DISTINCT condition_code) AS unique_conditions FROM c GROUP BY 1)
SELECT p.id, total_encounters, unique_conditions, total_spend, first_encounter_date, last_encounter_date,
       patient_age, gender, is_deceased, marital_status
FROM p LEFT JOIN ev ON p.id = ev.patient_id LEFT JOIN co ON p.id = co.patient_id
""",
    "clinical_encounter_summary": f"""
{_CLEAN}
SELECT e.id AS encounter_id, e.patient_id, e.start AS encounter_start, e.stop AS encounter_end,
       duration_minutes, cost AS encounter_cost, encounterclass AS encounter_class, condition_code,
       condition_description, condition_code IS NOT NULL AS has_condition, patient_age, gender,
       encounter_year, encounter_month
FROM e LEFT JOIN c ON e.id = c.encounter_id JOIN p ON e.patient_id = p.id
""",
    "clinical_condition_prevalence": f"""
{_CLEAN}
SELECT condition_code, condition_description, COUNT(DISTINCT patient_id) AS patient_count,
       (SELECT COUNT(*) FROM p) AS total_patients,
       CAST(ROUND(COUNT(DISTINCT patient_id) * 100.0 / (SELECT COUNT(*) FROM p), 2) AS DECIMAL(27,2)) AS prevalence_pct
FROM c GROUP BY 1, 2
""",
    "clinical_provider_metrics": f"""
{_CLEAN}
SELECT provider_id, COUNT(id) AS total_encounters, COUNT(DISTINCT patient_id) AS count_patients,
       ROUND(AVG(duration_minutes), 2) AS avg_duration_minutes, ROUND(SUM(cost), 2) AS total_cost
FROM e GROUP BY 1
""",
    "clinical_readmission_risk": f"""
{_CLEAN},
n AS (SELECT id AS encounter_id, patient_id, start AS encounter_start,
             LEAD(start) OVER (PARTITION BY patient_id ORDER BY start NULLS FIRST, id) AS next_encounter_date
      FROM e)
SELECT *, CAST(date_diff('day', CAST(encounter_start AS DATE), CAST(next_encounter_date AS DATE)) AS INTEGER)
         AS days_to_next_encounter,
       COALESCE(date_diff('day', CAST(encounter_start AS DATE), CAST(next_encounter_date AS DATE)) <= 30, FALSE)
         AS is_readmission_risk
FROM n
""",
}

_COUNT = {"patients": "FROM customer WHERE c_custkey % 3 = 0", "encounters": "FROM orders WHERE o_orderkey % 5 = 0",
          "conditions": f"FROM (SELECT DISTINCT o_custkey, l_orderkey, l_returnflag, l_shipdate FROM {_LINES} WHERE l_orderkey % 5 = 0)",
          "medications": f"FROM (SELECT DISTINCT o_custkey, l_orderkey, l_partkey, l_shipdate FROM {_LINES} WHERE l_orderkey % 5 = 0)",
          "observations": "FROM (SELECT DISTINCT CAST(ts AS DATE), user_id, event_type FROM events WHERE user_id % 3 = 0)",
          "procedures": f"FROM (SELECT DISTINCT o_custkey, l_orderkey, l_returnflag, l_linestatus, l_shipdate FROM {_LINES} WHERE l_orderkey % 5 = 0)",
          "claims": "FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 5 = 0)"}
_STATUS = [f"SELECT '{n}' AS table_name, 'raw' AS layer, 'ok' AS status, COUNT(*) AS row_count {q}" for n, q in _COUNT.items()]
_STATUS += [f"SELECT '{n}', 'raw', 'ok', COUNT(*) FROM {s}" for n, s in OTHERS.items() if n != "providers"]
_STATUS += ["SELECT 'providers', 'raw', 'error', CAST(NULL AS BIGINT)"]
_STATUS += [f"SELECT '{n}', 'clean', 'ok', COUNT(*) FROM ({ORACLE[f'clean_{n}']})" for n in RAW]
_STATUS += [f"SELECT '{n}', 'summary', 'ok', COUNT(*) FROM ({ORACLE[f'clinical_{n}']})" for n in MODELS]
_STATUS += ["SELECT 'schema_drift', 'raw', 'ok', 0", "SELECT 'schema_drift', 'clean', 'ok', 0"]
ORACLE["clinical_run"] = "\nUNION ALL\n".join(_STATUS)
