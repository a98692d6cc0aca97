"""Rules, summaries, gate, drift, integrity checks and the audit log."""

from __future__ import annotations

import json
from datetime import UTC, datetime

import pytest

from lakevault.operators import drift, integrity, rules
from lakevault.plans import quality, rulebook
from lakevault.sources.audit import AuditLog


def test_twenty_nine_rules_are_executed():
    assert len(rulebook.EXECUTED) == 29
    assert len(rulebook.RULES.references) == 6 and len(rulebook.RULES.unique) == 3


def table(spark):
    return spark.createDataFrame(
        [(1, 1, 50.0, 0), (2, None, 101.0, 2), (3, 3, None, None)],
        "id_assessment long, id_student long, score double, is_banked int")


def test_rules_ignore_null_except_not_null(spark):
    rows = rules.validate_table(table(spark), "student_assessment", rulebook.RULES.rows).collect()
    got = {(r.rule, r.column): r.failed_rows for r in rows}
    assert got == {("not_null", "id_assessment"): 0, ("not_null", "id_student"): 1,
                   ("not_null", "score"): 1, ("range", "score"): 1,
                   ("is_banked_boolean", "is_banked"): 1}
    assert all(r.evaluated_rows == 3 for r in rows)


def test_one_aggregation_per_table(spark):
    plan = rules.validate_table(table(spark), "student_assessment", rulebook.EXECUTED)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate [") == 1


def test_missing_column_fails_and_no_rules_give_no_rows(spark):
    df = spark.range(2).withColumnRenamed("id", "id_site")
    rows = {r.column: r for r in rules.validate_table(df, "vle", rulebook.EXECUTED)
            .filter("rule = 'not_null'").collect()}
    assert rows["id_site"].success
    assert not rows["activity_type"].success and rows["activity_type"].failed_rows is None
    assert rules.validate_table(df, "nothing", rulebook.EXECUTED).count() == 0


def test_empty_and_absent_tables_are_skipped(spark):
    empty = table(spark).limit(0)
    results = rules.validate_all({"student_assessment": empty, "vle": None}, rulebook.EXECUTED)
    assert results.count() == 0
    row = rules.summarize(results).first()
    assert (row.total_expectations, row.pipeline_success, float(row.pass_rate)) == (0, True, 0.0)


def test_summary_and_top_failures(spark):
    results = rules.validate_all({"student_assessment": table(spark)}, rulebook.EXECUTED)
    row = rules.summarize(results).first()
    assert (row.total_passed, row.total_failed, float(row.pass_rate)) == (1, 3, 25.0)
    assert [r.position for r in rules.top_failures(results, 2).collect()] == [1, 2]


def test_gate(spark):
    good = table(spark).filter("id_student = 1")
    rules.require_critical(rules.validate_table(good, "student_assessment", rulebook.EXECUTED))
    with pytest.raises(rules.CriticalRuleFailed, match="student_assessment.score"):
        rules.require_critical(
            rules.validate_table(table(spark), "student_assessment", rulebook.EXECUTED))


def test_rules_from_json_file(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"rules": rulebook.DECLARED}))
    assert rules.rules_from_file(str(path)) == rulebook.RULES


def test_weight_sum_passes_only_with_hundred_and_exam(spark):
    df = spark.createDataFrame(
        [("A", "1", "TMA", 60.0), ("A", "1", "Exam", 40.5), ("B", "1", "TMA", 100.0),
         ("C", "1", "Exam", 102.0)],
        "code_module string, code_presentation string, assessment_type string, weight double")
    assert sorted(r.code_module for r in quality.weight_sum(df).collect()) == ["B", "C"]


def test_orphans_and_null_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    parent = spark.createDataFrame([(1,)], "id long")
    assert sorted(str(r.k) for r in integrity.orphans(child, ["k"], parent, ["id"]).collect()) == [
        "2", "2", "None"]
    ref = rules.Reference("c", ("k",), "p", ("id",))
    row = integrity.reference_counts({"c": child, "p": parent}, [ref]).first()
    assert (row.orphan_rows, row.orphan_keys) == (3, 2)


def test_duplicate_keys_count_null_as_a_key(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k long")
    assert integrity.unique_check(df, "t", ["k"]).first().failed == 2
    assert integrity.unique_check(df, "t", ["k"], ignore_null=True).first().failed == 1


def test_drift(spark):
    a = spark.createDataFrame([("x", 1.0), ("x", 3.0), ("y", 1.0), (None, 3.0)], "c string, v double")
    b = spark.createDataFrame([("x", 9.0), ("z", 9.0)], "c string, v double")
    rows = {r.category: (r.baseline_pct, r.current_pct, r.exceeds)
            for r in drift.categorical(a, b, "c", 5.0).collect()}
    assert rows == {"x": (50.0, 50.0, False), "y": (25.0, 0.0, True), None: (25.0, 0.0, True),
                    "z": (0.0, 50.0, True)}
    row = drift.numeric(a, b, "v", 3.0).first()
    assert (row.baseline_mean, row.baseline_std, row.drift_z, row.exceeds) == (2.0, 1.0, 7.0, True)
    flat = a.filter("v = 1.0")
    assert drift.numeric(flat, b, "v", 3.0).first().exceeds is False


def test_audit_log_appends_and_reads_one_day(spark, tmp_path):
    log = AuditLog(spark, str(tmp_path / "audit"))
    assert log.read_today().count() == 0
    log.log("ingest", "bronze.courses", {"rows": 3})
    log.log("validate", "bronze", principal="tester")
    log.log("report", "x", now=datetime(2020, 2, 3, 4, 5, 6, tzinfo=UTC))
    today = {r.action: r for r in log.read_today().collect()}
    assert set(today) == {"ingest", "validate"}
    assert json.loads(today["ingest"].detail) == {"rows": 3}
    assert today["validate"].principal == "tester"
    assert [r.action for r in log.read_day(datetime(2020, 2, 3)).collect()] == ["report"]
    assert (tmp_path / "audit" / "year=2020" / "month=02" / "day=03").is_dir()
