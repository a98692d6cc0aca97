"""Plans whose memory and driver traffic must not grow with the tables: what is joined is not broadcast."""

from __future__ import annotations

from datetime import datetime

import pytest

from lakevault import queries
from lakevault.given import Given
from lakevault.operators import engagement
from lakevault.plans import Tables, dashboards, quality
from lakevault.schemas import BY_TABLE

TS = datetime(2024, 1, 1, 5)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def t(spark, tmp_path):
    """Base tables of one row each, in files: any join could be a broadcast."""
    rows = {
        "courses": ("M1", "2013J", 200), "assessments": ("M1", "2013J", 5, "TMA", 10, 50.0),
        "vle": (10, "M1", "2013J", "quiz", 1, 2),
        "student_registration": ("M1", "2013J", 1, -3, 0.0),
        "student_assessment": (5, 1, 9, 0, 70.0), "student_vle": ("M1", "2013J", 1, 10, 3, 4),
        "student_info": ("M1", "2013J", 1, "F", "r", "A", "b", "0-35", 0, 60, "N", "Pass"),
    }
    for n, spec in BY_TABLE.items():
        spark.createDataFrame([(*rows[n], TS, "f.csv")], spec.struct).write.parquet(f"{tmp_path}/{n}")
    return Tables({n: spark.read.parquet(f"{tmp_path}/{n}") for n in BY_TABLE}, TS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "silver_student_vle", "fact_student_interaction", "fact_engagement_summary",
    "bv_engagement_daily", "bv_engagement_weekly", "bv_student_assessment", "bv_student_performance"])
def test_tables_that_grow_are_not_broadcast(t, name):
    sites_or_students = plan(t[name])
    assert "SortMergeJoin" in sites_or_students
    courses = 1 if name == "bv_student_performance" else 0  # one row for each offering
    assert sites_or_students.count("BroadcastExchange") <= courses, sites_or_students


def test_references_and_drop_off_are_not_broadcast(t):
    for df in (quality.assert_referential_integrity(t), dashboards.interaction_drop_off(t),
               dashboards.weekly_clicks_by_result(t)):
        assert df.count() >= 0 and "BroadcastExchange" not in plan(df)


@pytest.mark.parametrize("versions", [False, True])
def test_clicks_are_shuffled_by_site_and_by_enrolment_alone(spark, versions):
    clicks = spark.createDataFrame([(1, 7, 10, 3, 4)], "s long, o long, v long, date long, sum_click long")
    sites = spark.createDataFrame([(10, "quiz")], "v long, activity_type string")
    out = engagement.rollup(clicks, sites, ["s", "o"], "v", ["v"], "week_number", not versions)
    totals = out.groupBy("s", "o").sum("total_clicks")
    assert plan(totals).count("Exchange hashpartitioning") == 3  # clicks, sites, reduced clicks
    assert [tuple(r) for r in totals.collect()] == [(1, 7, 4)]


def test_sites_are_made_in_many_tasks(spark):
    assert Given(spark, SMALL).vle.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


@pytest.fixture
def not_adaptive(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_link_and_satellite_of_submissions_share_one_grouping(spark, not_adaptive):
    found = plan(Given(spark, SMALL).tables()["bv_student_assessment"])
    made = [line for line in found.splitlines()
            if "Exchange hashpartitioning(id_assessment" in line and "id_student" in line]
    assert len([line for line in made if "Reused" not in line]) == 1, found
    assert "ReusedExchange" in found


def test_a_student_key_that_the_id_gives_does_not_travel(t):
    found = plan(t["bv_student_assessment"]).splitlines()
    at = next(i for i, line in enumerate(found) if "Exchange hashpartitioning(hk_assessment" in line)
    moved = next(line for line in found[at:] if "Project [" in line)
    assert "AS _other#" in moved and ", hk_student#" not in moved and "[hk_student#" not in moved, moved


def test_two_loads_meet_by_bytes(spark, monkeypatch):
    met = []

    def seen(merge):
        def run(old, new, key):
            met.extend(kind for df in (old, new) for c, kind in df.dtypes if c.startswith("hk_"))
            return merge(old, new, key)
        return run
    for name in ("upsert_by_key", "append_new_versions"):
        monkeypatch.setattr(queries, name, seen(getattr(queries, name)))
    df = queries.QUERIES["bv_student_assessment_all_versions"](spark, SMALL)
    assert met and set(met) == {"binary"}
    assert dict(df.dtypes)["hk_student_assessment"] == "string"


def test_keys_that_are_null_or_no_hash_of_an_id(t, spark):
    """A hub may hold other keys than hashes of its ids, and links and satellites NULL keys."""
    a, b, c = ("aa" * 32, "bb" * 32, "cc" * 32)
    at = (TS, "x")
    frames = {
        "link_student_assessment": spark.createDataFrame(
            [(a, a, a, *at), (b, b, a, *at), (None, None, None, *at)],
            "hk_student_assessment string, hk_student string, hk_assessment string, "
            "dv_load_date timestamp, dv_source string"),
        "sat_student_assessment_result": spark.createDataFrame(
            [(a, c, 1, 0, 50.0, *at), (None, c, 2, 0, 60.0, *at), (None, None, 3, 0, 70.0, *at)],
            "hk_student_assessment string, hk_hashdiff string, date_submitted long, is_banked long, "
            "score double, dv_load_date timestamp, dv_source string"),
        "hub_student": spark.createDataFrame(
            [(a, 7, *at)], "hk_student string, id_student long, dv_load_date timestamp, dv_source string"),
    }
    for versions in (False, True):
        df = t.with_frames(frames, all_versions=versions)["bv_student_assessment"]
        got = {r.hk_student_assessment: r for r in df.collect()}
        assert len(got) == df.count() == 3
        assert (got[a].hk_student, got[a].id_student, got[a].score) == (a, 7, 50.0)
        assert (got[b].hk_student, got[b].id_student, got[b].score) == (b, None, None)
        assert (got[None].hk_student, got[None].hk_assessment, got[None].score) == (None, None, None)
