"""Clean-layer specs (T1–T7) and the one function that applies them.

A :class:`CleanSpec` is data: renames, casts, derivation steps, key,
drops, partition columns. :func:`apply_spec` turns it into a single lazy
plan — projections collapse into one, the only shuffle is the keep-latest
de-duplication (partial top-1 before the exchange) — and
:func:`write_clean` writes it with one action and an observed row count.

Step order: lower-case names → rename → null-tolerant casts → derivations
→ surrogate key → drop (PII, consumed columns) → keep latest per key →
late derivations → processing stamp.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import (age_from_date, age_from_year, decode, flag, full_match, key_text,
                         minutes_between, prefix, surrogate_key, year_month)
from ..functions.casts import cast_columns, cast_expressions, null_if_token
from ..functions.dates import difference
from ..operators.columns import normalise, split_by_tag, stamp
from ..operators.dedup import keep_latest
from ..operators.joins import lookup
from ..sinks.tables import write_table

Step = Callable[[DataFrame], DataFrame]
_TEXT = "__lk_key_text"


@dataclass(frozen=True)
class CleanSpec:
    name: str
    key: tuple                      # natural key, or the surrogate key's name
    lower: bool = True
    rename: dict = field(default_factory=dict)
    casts: dict = field(default_factory=dict)
    null_tokens: dict = field(default_factory=dict)
    formats: dict = field(default_factory=dict)
    steps: tuple = ()               # DataFrame -> DataFrame derivations, in order
    late: tuple = ()                # the same, that only add columns made of columns that stay: run on the rows that stay
    surrogate: tuple | None = None  # (key name, parts)
    drop: tuple = ()
    order: tuple = ("_ingested_at",)
    tiebreak: tuple | None = None
    partition_by: tuple = ()
    bucket_by: tuple | None = None  # (buckets, columns) for co-located joins
    stamp_col: str = "_silver_processed_at"


def rejected_counts(spec: CleanSpec) -> list:
    """Per cast column: rows whose text is there, and no NULL token, but whose typed value is NULL."""
    typed = cast_expressions(spec.casts, spec.null_tokens, spec.formats)
    return [F.count(F.when(null_if_token(c, spec.null_tokens.get(c, ())).isNotNull() & e.isNull(), 1)).alias(c)
            for c, e in typed.items()]


def _late(df: DataFrame, spec: CleanSpec, key: str | None = None) -> DataFrame:
    """The late derivations, their columns where an early one would have left them (before the key's text)."""
    before = df.columns
    for step in spec.late:
        df = step(df)
    added = [c for c in df.columns if c not in before]
    return df.select(*[c for c in before if c != key], *added, *[c for c in (key,) if c])


def apply_spec(raw: DataFrame, spec: CleanSpec, rejected: Observation | None = None, rebalance: bool = False) -> DataFrame:
    """Raw (text) rows → typed, keyed, de-duplicated, stamped rows.

    ``rejected`` observes, on the pass that runs anyway, how many values of
    each cast column could not be typed. ``rebalance`` deals the rows by the
    spec's partition columns, as :func:`~layerkit.sinks.tables.write_table`
    does, but before the digest is made, which no shuffle can compress.
    """
    df = normalise(raw, rename=spec.rename, lower=spec.lower)
    if rejected is not None:
        df = df.observe(rejected, *rejected_counts(spec))
    df = cast_columns(df, spec.casts, spec.null_tokens, spec.formats)
    for step in spec.steps:
        df = step(df)
    tiebreak = list(spec.tiebreak) if spec.tiebreak is not None else None
    if not spec.surrogate or tuple(spec.key) != (spec.surrogate[0],) or spec.surrogate[0] in df.columns:
        if spec.surrogate:
            df = df.withColumn(spec.surrogate[0], surrogate_key(list(spec.surrogate[1])))
        df = _late(keep_latest(df.drop(*spec.drop), list(spec.key), list(spec.order), tiebreak), spec)
        return stamp(df.hint("rebalance", *spec.partition_by) if rebalance else df, spec.stamp_col)
    # rows are told by the text under the digest: sorted by it they compress well on their way, which a
    # digest does not. The digest is made of the rows that stay.
    name, parts = spec.surrogate
    df = df.withColumn(_TEXT, key_text(list(parts))).drop(*spec.drop)
    df = _late(keep_latest(df, [_TEXT], list(spec.order), tiebreak), spec, _TEXT)
    df = df.hint("rebalance", *spec.partition_by) if rebalance else df
    return stamp(df.withColumn(_TEXT, F.md5(_TEXT)).withColumnRenamed(_TEXT, name), spec.stamp_col)


def write_clean(raw: DataFrame, spec: CleanSpec, table: str, rejected: Observation | None = None) -> int:
    """T*: apply the spec and overwrite the clean table; returns rows written."""
    rebalance = bool(spec.partition_by) and not spec.bucket_by
    return write_table(apply_spec(raw, spec, rejected, rebalance), table, mode="overwrite",
                       partition_by=spec.partition_by, bucket_by=spec.bucket_by, dealt=rebalance)


# --------------------------------------------------------------------------
# Clinical specs (patients, encounters, conditions, medications,
# observations, procedures, claims).

# Decodes and the diagnosis-letter categories of the clean layer.
MARITAL_LABELS = {"M": "Married", "S": "Single"}
CLAIM_TYPE_LABELS = {"P": "Professional", "I": "Institutional"}
DIAGNOSIS_LETTER_CATEGORY = {
    "A": "Infectious Diseases", "B": "Infectious Diseases",
    "C": "Neoplasms / Blood Diseases", "D": "Neoplasms / Blood Diseases",
    "E": "Endocrine / Metabolic", "F": "Mental / Behavioral",
    "G": "Nervous System", "H": "Eye / Ear",
    "I": "Circulatory System", "J": "Respiratory",
    "K": "Digestive", "L": "Skin",
    "M": "Musculoskeletal", "N": "Genitourinary",
    "O": "Pregnancy", "P": "Perinatal",
    "Q": "Congenital", "R": "Abnormal Findings",
    "S": "Injury / Poisoning", "T": "Injury / Poisoning",
    "V": "External Causes", "W": "External Causes",
    "X": "External Causes", "Y": "External Causes",
    "Z": "Health Services / Factors",
}
ENCOUNTER_TS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
PII_COLUMNS = ("ssn", "drivers", "passport")


def clinical_specs(as_of=None) -> dict:
    """The seven clean-table specs; ``as_of`` fixes the age reference day."""

    def patient_steps(df):
        return df.withColumns({
            "patient_age": age_from_date("birthdate", as_of),
            "is_deceased": flag(F.col("deathdate").isNotNull()),
            "marital_status": decode("marital", MARITAL_LABELS, "Unknown"),
        })

    def encounter_steps(df):
        df = df.withColumn("duration_minutes", minutes_between("start", "stop"))
        return year_month(df, "start", "encounter")

    def observation_steps(df):
        return split_by_tag(df, "value", "type")

    def observation_months(df):
        return year_month(df, "date", "observation")

    def procedure_steps(df):
        return year_month(df, "date", "procedure", month=False)

    def claim_letter(df):
        # first, as it leads the order that breaks ties
        return df.select(prefix("diagnosis_code", 1).alias("icd10_letter"),
                         *[c for c in df.columns if c != "icd10_letter"])

    def claim_steps(df):
        df = df.withColumn("patient_age", age_from_year("patient_year_of_birth", as_of))
        df = lookup(df, DIAGNOSIS_LETTER_CATEGORY, on="icd10_letter", value="diagnosis_category")
        return df.withColumns({
            "cost_reduction": difference("line_charge", "line_allowed"),
            "claim_type_decoded": decode("claim_type", CLAIM_TYPE_LABELS, None),
            "is_valid_npi": flag(full_match("prov_rendering_npi", r"\d{10}")),
        })

    who = {"patient": "patient_id", "encounter": "encounter_id"}
    return {
        "patients": CleanSpec(
            "patients", key=("id",),
            casts={"birthdate": "date", "deathdate": "date"},
            null_tokens={"deathdate": ["-"]},
            steps=(patient_steps,), drop=PII_COLUMNS + ("marital",)),
        "encounters": CleanSpec(
            "encounters", key=("id",),
            rename={"patient": "patient_id", "provider": "provider_id"},
            formats={"start": ENCOUNTER_TS, "stop": ENCOUNTER_TS},
            casts={"cost": "double", "start": "timestamp_ntz", "stop": "timestamp_ntz"},
            late=(encounter_steps,),
            partition_by=("encounter_year", "encounter_month")),
        "conditions": CleanSpec(
            "conditions", key=("condition_id",),
            rename={**who, "code": "condition_code", "description": "condition_description"},
            casts={"start": "date", "stop": "date"},
            surrogate=("condition_id", ("patient_id", "encounter_id", "condition_code", "start"))),
        "medications": CleanSpec(
            "medications", key=("medication_id",),
            rename={**who, "code": "medication_code", "description": "medication_description"},
            casts={"start": "date", "stop": "date", "cost": "double",
                   "dispenses": "int", "totalcost": "double"},
            surrogate=("medication_id", ("patient_id", "encounter_id", "medication_code", "start"))),
        "observations": CleanSpec(
            "observations", key=("observation_id",),
            rename={**who, "code": "observation_code", "description": "observation_description"},
            casts={"date": "date"},
            steps=(observation_steps,), late=(observation_months,),
            surrogate=("observation_id", ("patient_id", "encounter_id", "observation_code", "date")),
            partition_by=("observation_year", "observation_month")),
        "procedures": CleanSpec(
            "procedures", key=("procedure_id",),
            rename={**who, "code": "procedure_code", "description": "procedure_description"},
            casts={"date": "date", "cost": "double"},
            late=(procedure_steps,),
            surrogate=("procedure_id", ("patient_id", "encounter_id", "procedure_code", "date")),
            partition_by=("procedure_year",)),
        "claims": CleanSpec(
            "claims", key=("claim_line_id",), lower=False,
            casts={"date_service": "date", "line_charge": "decimal(10,2)",
                   "line_allowed": "decimal(10,2)", "patient_year_of_birth": "int",
                   "service_line_number": "int"},
            steps=(claim_letter,), late=(claim_steps,),
            surrogate=("claim_line_id", ("claim_id", "service_line_number", "diagnosis_code"))),
    }


# --------------------------------------------------------------------------
# Driver-table specs used by the layered run (customer / orders / lineitem).

LINE_TIEBREAK = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                 "l_tax", "l_returnflag", "l_linestatus")


def driver_specs(buckets: int | None = None) -> dict:
    """Specs for customer / orders / line items.

    ``buckets``: store orders and line items in that many buckets on the
    order key (and customers on the customer key), so summary models join
    the clean tables without shuffling them again.
    """
    order_b = (buckets, ("order_id",)) if buckets else None
    line_b = (buckets, ("l_orderkey",)) if buckets else None
    cust_b = (buckets, ("customer_id",)) if buckets else None
    return {
        "customer": CleanSpec(
            "customer", key=("customer_id",),
            rename={"c_custkey": "customer_id", "c_nationkey": "nation_id",
                    "c_mktsegment": "segment"},
            casts={"customer_id": "bigint", "nation_id": "int", "c_acctbal": "decimal(12,2)"},
            drop=("c_name",), bucket_by=cust_b),
        "orders": CleanSpec(
            "orders", key=("order_id",),
            rename={"o_orderkey": "order_id", "o_custkey": "customer_id",
                    "o_totalprice": "order_cost", "o_orderdate": "order_date",
                    "o_orderstatus": "status", "o_orderpriority": "priority"},
            casts={"order_id": "bigint", "customer_id": "bigint",
                   "order_cost": "decimal(12,2)", "order_date": "timestamp_ntz"},
            steps=(lambda df: year_month(df, "order_date", "order"),),
            partition_by=("order_year",), bucket_by=order_b),
        "lineitem": CleanSpec(
            "lineitem", key=("line_id",),
            casts={"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
                   "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
                   "l_discount": "double", "l_tax": "double", "l_shipdate": "timestamp_ntz"},
            surrogate=("line_id", ("l_orderkey", "l_linenumber")),
            order=("_ingested_at", "l_shipdate"), tiebreak=LINE_TIEBREAK,
            bucket_by=line_b),
    }
