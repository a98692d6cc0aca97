"""A whole run from CSV files written out of the supplied tables, twice."""

from __future__ import annotations

import dataclasses
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakevault import pipeline
from lakevault.given import Given
from lakevault.operators import rules
from lakevault.operators.rules import CriticalRuleFailed
from lakevault.plans import MODELS
from lakevault.schemas import SPECS
from lakevault.sources.audit import AuditLog
from lakevault.sources.csv_files import load_all_tables
from lakevault.sources.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def csv_dir(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    g = Given(spark, SF)
    for source, spec in SPECS.items():
        df = g.text[source]
        columns = [c for c in df.columns if not c.startswith("_")]
        df.select(*columns).write.option("header", True).option(
            "ignoreLeadingWhiteSpace", False).csv(str(folder / f"{source}.csv"))
    return str(folder)


@pytest.fixture(scope="module")
def first_run(spark, csv_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    loaded = pipeline.run(spark, csv_dir, root, datetime(2024, 1, 1, 5), fail_on_critical=False)
    return root, loaded


def test_every_source_is_loaded(spark, first_run):
    _, loaded = first_run
    assert set(loaded) == set(SPECS) and all(not e for _, e in loaded.values())
    g = Given(spark, SF)
    assert loaded["studentRegistration"][0] == g.student_registration.count()
    assert loaded["studentInfo"][0] == g.student_info.count()


def test_every_model_is_stored(spark, first_run):
    root, _ = first_run
    wh = Warehouse(spark, root)
    for m in MODELS.values():
        if m.kind != "view":
            assert wh.read(m.layer, m.name).count() > 0, m.name
    metrics = wh.read("gold", "rpt_quality_metrics")
    assert metrics.count() == 14 and metrics.filter("pass_rate < 100").count() > 0
    assert wh.read("bv", "bv_quality_metrics").count() == 1
    assert wh.read("gold", "anomaly_flags").count() > 0
    assert wh.read("bronze", "ingestion_log").count() == 7


def test_stored_report_equals_the_lazy_one(spark, first_run):
    root, _ = first_run
    stored = Warehouse(spark, root).read("gold", "rpt_student_performance")
    lazy = Given(spark, SF).tables()["rpt_student_performance"]
    keep = ["id_student", "code_module", "code_presentation", "final_result", "gender"]
    assert stored.select(keep).exceptAll(lazy.select(keep)).count() == 0


def test_second_run_changes_no_satellite_and_no_metrics_of_the_day(spark, csv_dir, first_run):
    root, loaded = first_run
    wh = Warehouse(spark, root)
    names = ["sat_student_details", "sat_assessment_details", "sat_student_assessment_result"]
    before = {n: wh.read("dv", n).count() for n in names}
    hubs = wh.read("dv", "hub_student").count()
    flags = wh.read("gold", "anomaly_flags").count()
    again = pipeline.run(spark, csv_dir, root, datetime(2024, 1, 1, 9), fail_on_critical=False)
    assert again == loaded
    assert {n: wh.read("dv", n).count() for n in names} == before
    assert wh.read("dv", "hub_student").count() == hubs
    assert wh.read("dv", "hub_student").select("dv_load_date").distinct().count() == 1
    assert wh.read("gold", "rpt_quality_metrics").count() == 14
    assert wh.read("gold", "anomaly_flags").count() == flags
    actions = {r.action for r in AuditLog(spark, f"{root}/audit").read_today().collect()}
    assert actions == {"ingest", "validate", "anomaly_detected", "drift"}
    drifted = wh.read("quality", "drift_results")
    assert drifted.count() == 3 and drifted.filter("drift > 1e-9 or exceeds").count() == 0


def test_gate_stops_the_run_before_any_model(spark, csv_dir, tmp_path):
    root = str(tmp_path / "wh")
    with pytest.raises(CriticalRuleFailed) as e:
        pipeline.run(spark, csv_dir, root, datetime(2024, 1, 1))
    wh = Warehouse(spark, root)
    failed = wh.read("gold", "rule_results_bronze").filter(
        "severity = 'critical' and not success").collect()
    assert failed and all(f"bronze.{r.table_name}.{r.column}: {r.rule}" in str(e.value) for r in failed)
    for m in MODELS.values():
        assert not wh.exists(m.layer, m.name)


def test_gate_behind_silver(spark, csv_dir, tmp_path, monkeypatch):
    root, real = str(tmp_path / "wh"), rules.require_critical

    def only_silver(results):
        real(results.filter("layer = 'silver'"))

    monkeypatch.setattr(rules, "require_critical", only_silver)
    with pytest.raises(CriticalRuleFailed, match="silver"):
        pipeline.run(spark, csv_dir, root, datetime(2024, 1, 1))
    wh = Warehouse(spark, root)
    assert {m.layer for m in MODELS.values() if wh.exists(m.layer, m.name)} == {"silver"}


def test_configured_thresholds(spark, csv_dir, tmp_path):
    root = str(tmp_path / "wh")
    pipeline.run(spark, csv_dir, root, datetime(2024, 1, 1), fail_on_critical=False, config={
        "anomaly": {"click_threshold": {"daily_max": 1, "z_score": 100.0}}})
    flags = Warehouse(spark, root).read("gold", "anomaly_flags")
    reasons = {r.reason for r in flags.filter("anomaly_type = 'click_outlier'").collect()}
    assert reasons == {"exceeds_daily_max_1"}


def test_absent_sources_stop_the_run(spark, tmp_path):
    with pytest.raises(RuntimeError, match="no bronze data"):
        pipeline.run(spark, str(tmp_path), str(tmp_path / "wh"))


def test_declared_checks_and_assertions_are_outcomes(spark, first_run):
    root, _ = first_run
    wh = Warehouse(spark, root)
    bronze = {(r.table_name, r.rule): r for r in wh.read("gold", "rule_results_bronze").collect()}
    orphans = bronze["student_vle", "references vle"]
    assert orphans.failed_rows > 0 and not orphans.success and orphans.severity == "critical"
    assert bronze["student_vle", "references courses"].success
    assert bronze["assessments", "unique"].success
    assert bronze["assessments", "no_future_dates"].evaluated_rows == wh.read("bronze", "assessments").count()
    assert bronze["assessments", "assessment_weight_sum"].severity == "warning"
    assert bronze["assessments", "invalid_assessment_type"].table_name == "assessments"
    vault = wh.read("gold", "rule_results_vault")
    nulls = wh.read("bv", "bv_student_assessment").filter("id_assessment is null").count()
    assert vault.count() > 30 and nulls > 0  # submissions without an assessment
    assert [(r.table_name, r.column, r.failed_rows) for r in vault.filter("not success").collect()] == [
        ("bv_student_assessment", "id_assessment", nulls)]


def test_an_orphan_stops_the_run(spark, csv_dir, tmp_path, monkeypatch):
    root, real = str(tmp_path / "wh"), rules.require_critical

    def only_references(results):
        real(results.filter("rule like 'references %'"))

    monkeypatch.setattr(rules, "require_critical", only_references)
    with pytest.raises(CriticalRuleFailed, match="student_vle.id_site: references vle"):
        pipeline.run(spark, csv_dir, root, datetime(2024, 1, 1))
    wh = Warehouse(spark, root)
    assert not any(wh.exists(m.layer, m.name) for m in MODELS.values())


def test_a_broken_vault_key_stops_the_run(spark, csv_dir, tmp_path, monkeypatch):
    root, real = str(tmp_path / "wh"), rules.require_critical
    monkeypatch.setattr(rules, "require_critical", lambda r: real(r.filter("table_name like 'hub%'")))
    hub = MODELS["hub_student"]
    monkeypatch.setitem(MODELS, "hub_student", dataclasses.replace(
        hub, build=lambda t: hub.build(t).withColumn("id_student", F.nullif("id_student", F.lit(1)))))
    with pytest.raises(CriticalRuleFailed, match="dv.hub_student.id_student: not_null"):
        pipeline.run(spark, csv_dir, root, datetime(2024, 1, 1))
    wh = Warehouse(spark, root)
    assert wh.exists("dv", "hub_student") and not wh.exists("gold", "dim_student")


def test_absent_files_are_named(spark, tmp_path):
    with pytest.warns(UserWarning, match="studentVle.csv does not exist; student_vle is not loaded"):
        load_all_tables(spark, Warehouse(spark, str(tmp_path / "wh")), str(tmp_path), datetime(2024, 1, 1))


def test_drift_and_spikes_are_warnings(spark, tmp_path):
    wh, audit = Warehouse(spark, str(tmp_path)), AuditLog(spark, str(tmp_path / "audit"))

    def load(day, results, clicks):
        tables = {
            "student_info": spark.createDataFrame([("F", r) for r in results], "gender string, final_result string"),
            "student_vle": spark.createDataFrame([(c,) for c in clicks], "sum_click long")}
        pipeline.note_drift(wh, audit, tables, datetime(2024, 1, day), f"2024010{day}")

    load(1, ["Pass"] * 9 + ["Fail"], [1, 2, 3])
    wh.replace_run(wh.read("quality", "profiles_of_run"), "quality", "column_profiles", "20240101")
    with pytest.warns(UserWarning, match="drifted") as told:
        load(2, ["Pass"] * 5 + ["Fail"] * 5, [101, 102, 103])
    assert {str(w.message).split()[0] for w in told} >= {"student_info.final_result", "student_vle.sum_click"}
    assert wh.read("quality", "drift_results").count() == 3
    form = "run_date date, table_name string, layer string, anomalies_detected long"
    wh.overwrite(spark.createDataFrame([
        (date(2024, 1, 1), "t", "bronze", 10), (date(2024, 1, 2), "t", "bronze", 40)], form),
        "gold", "rpt_quality_metrics")
    with pytest.warns(UserWarning, match="40 anomalies after 10"):
        pipeline.note_spikes(wh, audit, date(2024, 1, 2))
