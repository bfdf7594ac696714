"""What lies on disk while the clinical run goes on: what landed, the tables made anew, one large shuffle at a time."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from layerkit.plans import clinical as plan
from layerkit.plans.bronze import CsvSource
from layerkit.plans.layered import _run_layer, stored_bytes
from layerkit.plans.silver import apply_spec, clinical_specs, write_clean
from layerkit.registry import clinical
from layerkit.registry.io import scratch_db
from layerkit.session import scratch_path
from layerkit.sinks.tables import write_table

TABLES = ("patients", "encounters", "conditions")


def land(spark, folder, sf_dir="/root/testdata/sf0.001"):
    for name in TABLES:
        clinical.RAW[name](spark, sf_dir, False).write.option("header", True).csv(f"{folder}/{name}.csv")


def test_what_landed_and_what_is_made_anew_go_before_the_clean_layer(spark, monkeypatch):
    folder, raw, clean, summary = scratch_path(spark, "disk"), *(scratch_db(spark, f"disk_{x}") for x in ("raw", "clean", "summary"))
    land(spark, folder)
    source, seen, calls = CsvSource(folder, raw, "raw"), [], []

    def look(df, spec, table, *a):
        seen.append((len(calls), sorted(t.name for t in spark.catalog.listTables(clean) if t.name in written)))
        return write_clean(df, spec, table, *a)
    written = set()
    run = lambda **k: plan.run_clinical_batch(spark, source, clean, summary, tables=TABLES, as_of=clinical.AS_OF, models=(), parallel=1, **k)
    run()
    monkeypatch.setattr(plan, "write_clean", look)
    written = set(TABLES)
    status = run(ingested=lambda: calls.append(1)).collect()
    assert [n for n, _ in seen] == [1, 1, 1] and seen[0][1] == []
    assert {r["table_name"] for r in status if r["layer"] == "clean"} == set(TABLES)


def test_a_clean_table_whose_spec_does_not_fit_stays(spark):
    folder, raw, clean, summary = scratch_path(spark, "disk"), *(scratch_db(spark, f"disk_{x}") for x in ("raw", "clean", "summary"))
    write_table(spark.range(3), f"{clean}.patients", "overwrite")
    spark.range(2).write.option("header", True).csv(f"{folder}/patients.csv")       # no birthdate
    with pytest.raises(Exception, match="birthdate"):
        plan.run_clinical_batch(spark, CsvSource(folder, raw, "raw"), clean, summary, tables=("patients",), as_of=clinical.AS_OF)
    assert spark.table(f"{clean}.patients").count() == 3


def test_large_jobs_run_one_at_a_time_and_first():
    lock, now, most, order = threading.Lock(), set(), [], []

    def job(name):
        def run():
            with lock:
                now.add(name)
                order.append(name)
                most.append(set(now))
            done.wait(0.2)
            now.discard(name)
            if name == "b":
                raise ValueError("b failed")
            return name
        return run
    done = threading.Event()
    with pytest.raises(ValueError, match="b failed"):
        _run_layer({n: job(n) for n in "abcde"}, 4, alone=["d", "b"])
    assert order[:2] == ["d", "b"] and sorted(order) == list("abcde")
    assert {"d"} in most and {"b"} in most and not any(len(s) > 1 and s & {"b", "d"} for s in most)


def test_size_is_that_of_the_files(spark):
    table = f"{scratch_db(spark, 'disk')}.t"
    write_table(spark.range(1000), table, "overwrite")
    home = next(r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r[0] == "Location").removeprefix("file:")
    assert stored_bytes(spark.table(table)) == sum(os.path.getsize(f"{home}/{f}") for f in os.listdir(home) if f.startswith("part-"))


@pytest.mark.parametrize("name,column", [("encounters", "duration_minutes"), ("claims", "cost_reduction"), ("procedures", "procedure_year"),
                                         ("observations", "observation_month")])
def test_derived_columns_are_not_shuffled_by_key(spark, name, column):
    df = apply_spec(clinical._batches(spark, "/root/testdata/sf0.001", name), clinical_specs(as_of=clinical.AS_OF)[name])
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    window = next(i for i, line in enumerate(lines) if "Window [" in line)
    assert any(f"AS {column}" in line for line in lines[:window]) and not any(f"AS {column}" in line for line in lines[window:])


def test_digests_are_made_after_the_rows_are_dealt(spark):
    df = apply_spec(clinical._batches(spark, "/root/testdata/sf0.001", "procedures"), clinical_specs(as_of=clinical.AS_OF)["procedures"], rebalance=True)
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    dealt = next(i for i, line in enumerate(lines) if "RebalancePartitions" in line)
    assert any("md5(" in line for line in lines[:dealt]) and not any("md5(" in line for line in lines[dealt:])


def test_ties_and_columns_are_as_with_early_derivations(spark):
    """The specs as they were, all derivations before the latest row is chosen, give the same table."""
    specs = clinical_specs(as_of=clinical.AS_OF)
    for name in ("encounters", "claims", "procedures", "observations"):
        rows = clinical._batches(spark, "/root/testdata/sf0.001", name).withColumn("_ingested_at", F.lit(clinical.FIRST).cast("timestamp"))
        spec = specs[name]
        early = type(spec)(**{**spec.__dict__, "steps": spec.steps + spec.late, "late": ()})
        now, then = (apply_spec(rows, s).drop(spec.stamp_col) for s in (spec, early))
        assert now.columns == then.columns and now.dtypes == then.dtypes
        assert now.exceptAll(then).isEmpty() and then.exceptAll(now).isEmpty()
