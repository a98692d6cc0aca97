"""Branches of the layer models that the derived tables do not reach."""

from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakevault import functions as L
from lakevault.operators import engagement
from lakevault.plans import Tables
from lakevault.schemas import BY_TABLE

TS = datetime(2024, 1, 1, 5)


def tables(spark, **rows):
    """Base tables from plain tuples; the ones not given are empty."""
    frames = {}
    for name, spec in BY_TABLE.items():
        data = [(*r, TS, "f.csv") for r in rows.get(name, [])]
        frames[name] = spark.createDataFrame(data, spec.struct)
    return Tables(frames, TS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_unregistration_zero_null_and_value(spark):
    t = tables(spark, student_registration=[
        ("A", "1B", 1, -3, 0.0), ("A", "1B", 2, 0, None), ("A", "1B", 3, None, 5.0)])
    rows = {r.id_student: r for r in t["silver_student_registration"].collect()}
    assert [rows[i].has_unregistered for i in (1, 2, 3)] == [False, False, True]
    assert [rows[i].date_unregistration for i in (1, 2, 3)] == [None, None, 5.0]
    assert [rows[i].registration_timing for i in (1, 2, 3)] == ["early", "on_time", "late"]


def test_hash_keys_and_null_parts(spark):
    row = spark.createDataFrame([(7, "A", None)], "a long, b string, c string").select(
        L.hash_key("a", "b").alias("k"), L.hash_key("a", "c").alias("n"),
        L.hashdiff("a", "c").alias("d")).first()
    assert (row.k, row.n, row.d) == (sha("7|A"), None, sha("7|"))


def test_null_business_keys_collapse_in_links(spark):
    t = tables(spark, assessments=[
        (None, "1B", 5, "TMA", 1, 1.0), (None, "2B", 5, "TMA", 1, 1.0)])
    rows = t["link_course_offering_assessment"].collect()
    assert len(rows) == 1 and rows[0].hk_course_offering is None
    assert rows[0].hk_assessment == sha("5")


def test_dim_student_with_missing_key_part(spark):
    t = tables(spark, student_registration=[
        (None, "1B", 1, -3, 0.0), (None, "1B", 1, -4, 0.0), ("A", "1B", 1, -5, 0.0)])
    rows = sorted((r.code_module or "", r.date_registration) for r in t["dim_student"].collect())
    assert rows == [("", None), ("A", -5)]


CLICKS = dict(
    vle=[(1, "A", "1B", "quiz", 1, 2), (2, "A", "1B", "page", 1, 2), (3, "A", "1B", "quiz", 1, 2)],
    student_vle=[("A", "1B", 9, 1, -1, 4), ("A", "1B", 9, 1, 0, 6), ("A", "1B", 9, 2, 0, 2),
                 ("A", "1B", 9, 3, 6, 3), ("A", "1B", 9, 77, 6, 1), ("A", "1B", 9, 1, 7, -5)])


def test_weeks_active_days_and_unknown_site(spark):
    rows = {r.week_number: r for r in tables(spark, **CLICKS)["fact_engagement_summary"].collect()}
    assert set(rows) == {-1, 0}
    week = rows[0]
    assert (week.active_days, week.total_clicks, week.max_daily_clicks) == (2, 12, 6)
    assert (week.unique_resources, week.unique_activity_types) == (4, 2)
    assert week.avg_daily_clicks == 3.0


@pytest.mark.parametrize("period", ["date", "week_number"])
def test_rollup_equals_plain_grouping_with_repeated_sites(spark, period):
    """Several rows per site multiply sums, not distinct counts."""
    t = tables(spark, **CLICKS)
    clicks, sites = t["bronze_student_vle"], t["silver_vle"]
    sites = sites.unionByName(sites.filter("id_site = 1")).unionByName(
        sites.filter("id_site = 1").withColumn("activity_type", F.lit("url")))
    join = ["id_site", "code_module", "code_presentation"]
    by = ["id_student", "code_module", "code_presentation"]
    clicks = clicks.unionByName(clicks.withColumn("id_student", F.lit(8)).limit(4)).unionByName(
        clicks.withColumn("id_student", F.lit(None).cast("long")))
    got = engagement.rollup(clicks, sites, by, "id_site", join, period)
    plain = clicks.join(sites.select(*join, "activity_type"), join, "left").withColumn(
        "week_number", L.week_number(F.col("date"))).groupBy(*by, period).agg(
        F.sum("sum_click").alias("total_clicks"),
        F.count_distinct("id_site").alias("unique_resources"),
        F.count_distinct("activity_type").alias("unique_activity_types"))
    assert {tuple(r) for r in got.select(plain.columns).collect()} == {
        tuple(r) for r in plain.collect()}


def withdrawn(spark, clicks=()):
    return tables(
        spark, courses=[("A", "1B", 200)], student_vle=list(clicks),
        student_registration=[("A", "1B", 9, -3, 5.0)],
        student_info=[("A", "1B", 9, "F", "r", "L", "i", "0-35", 0, 30, "N", "Withdrawn")])


def test_two_reports_differ_for_withdrawn_without_clicks(spark):
    t = withdrawn(spark)
    mart, view = t["rpt_student_performance"].first(), t["bv_student_performance"].first()
    assert (mart.early_dropout_flag, view.early_dropout_flag) == (False, True)
    assert (mart.assessment_completion_rate, view.assessment_completion_rate) == (None, 0.0)
    t = withdrawn(spark, [("A", "1B", 9, 1, 2, 3)])
    assert t["rpt_student_performance"].first().early_dropout_flag is True
    assert t["bv_student_performance"].first().early_dropout_flag is True


def test_unknown_outcome_in_the_vault_only(spark):
    t = tables(spark, courses=[("A", "1B", 200)], student_registration=[("A", "1B", 9, -3, None)])
    assert t["rpt_student_performance"].first().final_result is None
    assert t["bv_student_performance"].first().final_result == "Unknown"


def test_offering_summary(spark):
    t = tables(spark, courses=[("A", "1B", 200), ("B", "1J", 0)], assessments=[
        ("A", "1B", 1, "TMA", 5, 60.0), ("A", "1B", 2, "Exam", 6, 40.0),
        ("A", "1B", 3, "TMA", 7, 0.0)])
    rows = t["bv_course_offering"].collect()
    assert len(rows) == 1
    assert (rows[0].assessment_types, rows[0].assessment_count, rows[0].total_weight) == (
        "Exam, TMA", 3, 100.0)
    assert rows[0].presentation_start == "February"


def test_rounding_and_labels(spark):
    row = spark.range(1).select(
        L.round_half_up(F.lit(0.285), 2), L.one_decimal(F.lit(0.25)),
        L.week_number(F.lit(-1)), L.activity_category(F.lit("ouwiki"))).first()
    assert tuple(row) == (0.29, "0.3", -1, "other")
