"""Summary models (G1–G5) as column-parameterised DataFrame functions.

Defaults carry the output names of the original models, so a clean
patients / encounters / conditions layout runs with no arguments; the
driver-table queries pass their own column roles.

Scale notes
- G1/G3/G4 aggregate before joining (hash aggregates combine map-side,
  ``COUNT(DISTINCT)`` runs as a two-level aggregate), so a hot entity is
  reduced before any shuffle; joins then see one row per entity.
- G2's fan-out left join goes through :func:`left_join_split`, whose
  branches AQE can split when one event owns many facts.
- G5 uses the range-sliced :func:`next_in_sequence` instead of a window
  hashed on the entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.conditionals import at_most, flag
from ..functions.dates import days_between
from ..operators.joins import left_join_split, with_scalar
from ..operators.sequence import next_in_sequence


def entity_summary(entities: DataFrame, events: DataFrame, facts: DataFrame,
                   entity_id: str = "id", entity_cols=("patient_age", "gender", "is_deceased", "marital_status"),
                   event_entity: str = "patient_id", event_id: str = "id",
                   event_cost: str = "cost", event_start: str = "start",
                   fact_entity: str = "patient_id", fact_code: str = "condition_code",
                   names: dict | None = None, fill_zero: bool = False) -> DataFrame:
    """G1: one row per entity with event and distinct-fact aggregates.

    Entities without events (or facts) keep NULL aggregates (left joins);
    ``fill_zero=True`` reports their counts as 0 instead.
    """
    nm = {"total": "total_encounters", "unique": "unique_conditions",
          "spend": "total_spend", "first": "first_encounter_date",
          "last": "last_encounter_date"}
    nm.update(names or {})
    ev = (events.groupBy(F.col(event_entity).alias("__e"))
                .agg(F.count(event_id).alias(nm["total"]),
                     F.round(F.sum(event_cost), 2).alias(nm["spend"]),
                     F.min(F.to_date(event_start)).alias(nm["first"]),
                     F.max(F.to_date(event_start)).alias(nm["last"])))
    fa = (facts.groupBy(F.col(fact_entity).alias("__f"))
               .agg(F.count_distinct(fact_code).alias(nm["unique"])))
    base = entities.select(entity_id, *entity_cols)
    out = (base.join(ev, base[entity_id] == ev["__e"], "left")
               .join(fa, base[entity_id] == fa["__f"], "left"))
    if fill_zero:
        out = out.fillna(0, subset=[nm["total"], nm["unique"]])
    return out.select(entity_id, nm["total"], nm["unique"], nm["spend"],
                      nm["first"], nm["last"], *entity_cols)


def event_detail(events: DataFrame, facts: DataFrame, entities: DataFrame,
                 event_cols: dict, fact_cols: dict, entity_cols: dict,
                 event_id: str = "id", event_entity: str = "patient_id",
                 fact_event: str = "encounter_id", entity_id: str = "id",
                 flag_col: str = "has_condition", flag_source: str | None = None,
                 order: list | None = None) -> DataFrame:
    """Events ⟕ facts ⋈ entities, one row per (event, fact).

    ``*_cols`` map output name → source column. Events without an entity
    are dropped (inner join); events without facts keep NULL fact columns
    and ``flag_col`` = FALSE. Grain is event × fact: summing an event
    measure over this output counts it once per fact.
    """
    ev = events.select(F.col(event_id).alias("__ev"), F.col(event_entity).alias("__en"),
                       *[F.col(s).alias(o) for o, s in event_cols.items()])
    fa = facts.select(F.col(fact_event).alias("__ev"),
                      *[F.col(s).alias(o) for o, s in fact_cols.items()])
    en = entities.select(F.col(entity_id).alias("__en"),
                         *[F.col(s).alias(o) for o, s in entity_cols.items()])
    joined = left_join_split(ev, fa, on="__ev").join(en, on="__en", how="inner")
    first_fact = flag_source or next(iter(fact_cols))
    joined = joined.withColumn(flag_col, flag(F.col(first_fact).isNotNull()))
    cols = order or (list(event_cols) + list(fact_cols) + [flag_col] + list(entity_cols))
    return joined.select(*cols)


def event_summary(events: DataFrame, facts: DataFrame, event_cols: dict,
                  event_id: str = "id", fact_event: str = "encounter_id",
                  fact_code: str = "condition_code", count_name: str = "condition_count",
                  distinct_name: str = "distinct_conditions",
                  flag_col: str = "has_condition") -> DataFrame:
    """G2 at event grain: one row per event with its fact counts.

    Facts are aggregated per event first (map-side combined), then joined
    once, so event measures (e.g. cost) appear exactly once per event and
    can be summed safely, unlike the event × fact detail.
    """
    counts = (facts.groupBy(F.col(fact_event).alias("__ev"))
                   .agg(F.count(F.lit(1)).alias(count_name),
                        F.count_distinct(fact_code).alias(distinct_name)))
    ev = events.select(F.col(event_id).alias("__ev"),
                       *[F.col(s).alias(o) for o, s in event_cols.items()])
    out = ev.join(counts, on="__ev", how="left").fillna(0, subset=[count_name, distinct_name])
    return out.withColumn(flag_col, F.col(count_name) > 0) \
              .select(*event_cols, count_name, distinct_name, flag_col)


def prevalence(facts: DataFrame, population: DataFrame, group_cols,
               entity: str = "patient_id", count_name: str = "patient_count",
               total_name: str = "total_patients", pct_name: str = "prevalence_pct") -> DataFrame:
    """Distinct entities per group, the population total, and the share in %.

    The total is an uncorrelated scalar subquery, evaluated once.
    ``pct`` keeps Spark's exact decimal arithmetic (HALF_UP at 2 places).
    """
    group_cols = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    total = population.agg(F.count(F.lit(1)).alias(total_name))
    agg = facts.groupBy(*group_cols).agg(F.count_distinct(entity).alias(count_name))
    agg = with_scalar(agg, total, total_name)
    pct = F.round(F.col(count_name) * F.lit(100.0).cast("decimal(4,1)") / F.col(total_name), 2)
    return agg.withColumn(pct_name, pct)


def group_metrics(events: DataFrame, group: str = "provider_id", event_id: str = "id",
                  entity: str = "patient_id", duration: str = "duration_minutes",
                  cost: str = "cost", names: dict | None = None) -> DataFrame:
    """Per group — event count, distinct entities, mean duration, total cost."""
    nm = {"total": "total_encounters", "distinct": "count_patients",
          "avg": "avg_duration_minutes", "sum": "total_cost"}
    nm.update(names or {})
    return events.groupBy(group).agg(
        F.count(event_id).alias(nm["total"]),
        F.count_distinct(entity).alias(nm["distinct"]),
        F.round(F.avg(duration), 2).alias(nm["avg"]),
        F.round(F.sum(cost), 2).alias(nm["sum"]),
    )


def next_event_risk(events: DataFrame, event_id: str = "id", entity: str = "patient_id",
                    start: str = "start", window_days: int = 30,
                    tiebreak: str | None = None, sliced: bool = True,
                    names: dict | None = None) -> DataFrame:
    """Per event, the entity's next event start and a ``<= window_days`` flag.

    ``tiebreak`` (default: the event id) orders events with equal starts,
    so the result does not depend on input order. The last event of an
    entity has NULL next date and flag FALSE.
    """
    nm = {"id": "encounter_id", "entity": "patient_id", "start": "encounter_start",
          "next": "next_encounter_date", "days": "days_to_next_encounter",
          "flag": "is_readmission_risk"}
    nm.update(names or {})
    tiebreak = tiebreak or event_id
    extra = [] if tiebreak == event_id else [F.col(tiebreak).alias("__tiebreak")]
    base = events.select(F.col(event_id).alias(nm["id"]), F.col(entity).alias(nm["entity"]),
                         F.col(start).alias(nm["start"]), *extra)
    # the id closes the order, so ties on (start, tiebreak) are still total
    order = [nm["start"]] + (["__tiebreak"] if extra else []) + [nm["id"]]
    seq = next_in_sequence(base, nm["entity"], order, nm["start"], nm["next"],
                           sliced=sliced)
    days = days_between(nm["start"], nm["next"])
    return seq.withColumns({nm["days"]: days, nm["flag"]: at_most(days, window_days)}) \
              .select(nm["id"], nm["entity"], nm["start"], nm["next"], nm["days"], nm["flag"])
