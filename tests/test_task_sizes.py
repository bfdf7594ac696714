"""What keeps tasks small and jobs from being run for nothing: fine sessions, lazy models, one read for each batch."""

import glob

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from layerkit.plans import clinical as plan
from layerkit.plans.silver import apply_spec, clinical_specs
from layerkit.registry import clinical, landing, maintained
from layerkit.session import ensure_checkpoint_dir, fine_session


def test_fine_session_leaves_the_callers_settings(spark):
    own = fine_session(spark)
    assert own.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8m"
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") != "8m"
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")
    assert own.catalog.currentDatabase() == spark.catalog.currentDatabase()


@pytest.mark.parametrize("name", ["conditions", "procedures", "medications"])
def test_digests_are_made_of_the_rows_that_stay(spark, name):
    df = apply_spec(clinical._batches(spark, SF_SMALL, name), clinical_specs(as_of=clinical.AS_OF)[name])
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    window = next(i for i, line in enumerate(lines) if "Window [" in line)
    assert not any("md5(" in line for line in lines[window:]) and any("md5(" in line for line in lines[:window])


@pytest.mark.parametrize("run", [lambda s: clinical.QUERIES["clean_procedures"](s, SF_SMALL), lambda s: landing.quarantine(s, SF_SMALL)])
def test_wide_writes_run_in_a_fine_session(spark, monkeypatch, run):
    from layerkit.plans import quarantine, silver
    seen = []
    for module in (silver, quarantine):
        monkeypatch.setattr(module, "write_table", lambda df, *a, _f=module.write_table, **k: (
            seen.append(df.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")), _f(df, *a, **k))[1])
    assert run(spark).count() > 0
    assert seen == ["8m"]


def test_a_model_that_is_not_wanted_runs_no_job(monkeypatch):
    called = []
    for f in ("entity_summary", "prevalence", "group_metrics", "next_event_risk"):
        monkeypatch.setattr(plan.gold, f, lambda *a, f=f, **k: called.append(f))
    models = plan.clinical_models({"patients": None, "encounters": None, "conditions": None})
    assert called == []
    models["provider_metrics"]()
    assert called == ["group_metrics"]


def test_what_landed_goes_once_it_is_ingested(spark):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{base}/layerkit/m1-landing-*"))
    out = clinical.QUERIES["clinical_provider_metrics"](spark, SF_SMALL)
    assert out.count() == 5
    assert set(glob.glob(f"{base}/layerkit/m1-landing-*")) <= before


def test_a_batch_reads_its_rows_once(spark):
    rows = spark.createDataFrame([(1, True, False), (2, False, True), (3, False, False), (4, None, True), (5, False, None)], "k int, late boolean, wrong boolean")
    first, second, third = maintained._batches(rows, F.col("late"), F.col("wrong"), {"k": F.col("k") + 100}, F.col("k") > 0)
    got = lambda df: sorted((r["k"], r["_sign"]) for r in df.collect())
    assert got(first) == [(2, 1), (3, 1), (5, 1)] and got(second) == [(1, 1), (2, -1), (102, 1)] and got(third) == [(1, -1), (3, -1), (102, -1)]
    for df in (first, second, third):
        assert "Union" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_a_batch_brings_no_group_whole_to_a_task(spark, monkeypatch):
    from layerkit.plans import maintained as kept
    from layerkit.registry.io import scratch_db
    joins = []
    monkeypatch.setattr(kept, "_only", lambda *a, _f=kept._only: (joins.append(a[-1]), _f(*a))[1])
    spec = kept.Maintained(f"{scratch_db(spark, 'hot')}.m", ("g",), (kept.Measure("n", "distinct", "v"),), inputs={"events": ("g",)}, buckets=2)
    rows = lambda *r: spark.createDataFrame(list(r), "g int, v int, _sign int")
    kept.apply_changes(spark, spec, 0, {"events": rows((1, 1, 1), (1, 2, 1), (2, 5, 1), (None, 7, 1))})
    kept.apply_changes(spark, spec, 1, {"events": rows((1, 2, -1), (2, 5, -1), (3, 1, 1))})
    assert sorted(tuple(r) for r in kept.read_model(spark, spec).fillna(-1).collect()) == [(-1, 1), (1, 1), (3, 1)]
    assert "left_semi" not in joins          # the state is aggregated by value first, over all tasks
    with pytest.raises(Exception, match="removed more often"):
        kept.apply_changes(spark, spec, 2, {"events": rows((1, 9, -1), (1, 1, 1))})
