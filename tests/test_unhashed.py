"""Rows that move with the ids of their keys give what rows that move with the keys give."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakevault import queries
from lakevault.given import Given
from lakevault.operators import hashed
from lakevault.plans import MODELS, Tables, Unhashed
from lakevault.schemas import BY_TABLE
from lakevault.sources.bucketed import BucketedVault

TS = datetime(2024, 1, 1, 5)
SMALL = "/root/testdata/sf0.001"
LINK, SAT, TXN = "link_student_assessment", "sat_student_assessment_result", "txn_student_vle_click"


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def t(spark):
    """Base tables with NULL keys, repeated keys and rows, orphans, and offerings of one key text."""
    made = {
        "courses": [("M1", "2013J", 200)],
        "assessments": [("M1", "2013J", 5, "TMA", 10, 50.0), ("M1", "2013J", 6, "Exam", 20, 50.0),
                        ("M1", "2013J", 6, "Exam", 21, 50.0), ("M1", "2013J", None, "TMA", 1, 1.0)],
        "vle": [(10, "M1", "2013J", "quiz", 1, 2), (10, "M1", "2013J", "quiz", 1, 3),
                (None, "M1", "2013J", "url", 1, 2)],
        "student_registration": [("M1", "2013J", s, -3, 0.0) for s in (1, 2, None)],
        "student_assessment": [
            (a, s, d, 0, p) for a in (5, 6, 7, None) for s in (1, 2, 3, None)
            for d, p in ((9, 70.0), (9, 70.0), (11, 30.0), (None, None))],
        "student_vle": [
            (m, p, s, v, d, 4) for m, p in (("a|b", "c"), ("a", "b|c"), ("M1", None), (None, "M1"),
                                            ("M1", "2013J"))
            for s in (1, None) for v in (10, 11, None) for d in (3, 3, 12)],
        "student_info": [("M1", "2013J", 1, "F", "r", "A", "b", "0-35", 0, 60, "N", "Pass")],
    }
    return Tables({n: spark.createDataFrame([(*r, TS, "f.csv") for r in made[n]], spec.struct)
                   for n, spec in BY_TABLE.items()}, TS)


def hashed_first(t, **changes):
    """The same tables, of which only the hashed models are known."""
    return t.with_frames({n: t[n] for n in MODELS if MODELS[n].layer == "dv"}, **changes)


@pytest.mark.parametrize("versions", [False, True])
@pytest.mark.parametrize("name", ["bv_student_assessment", "bv_engagement_weekly",
                                  "bv_engagement_daily", "bv_student_performance"])
def test_views_of_unhashed_rows_equal_those_of_hashed_ones(t, name, versions):
    lazy, want = t.with_frames({}, all_versions=versions), hashed_first(t, all_versions=versions)
    assert lazy.unhashed(LINK) and not want.unhashed(LINK)
    assert lazy[name].schema == want[name].schema
    got = rows(lazy[name])
    assert got and got == rows(want[name])


def test_models_are_what_they_were(t):
    for name in (LINK, SAT, TXN):
        made = t.unhashed(name)
        assert all(c.startswith("_") for c in made.parts) and not set(made.parts) & set(t[name].columns)
    assert t[SAT].count() == t[SAT].distinct().count()
    assert t[LINK].filter("hk_student_assessment is null").count() == 7


def test_keys_are_compared_where_their_bits_agree(t, monkeypatch):
    names = ["bv_student_assessment", "bv_engagement_weekly"]
    want = [rows(t[n]) for n in names]
    class Alike:
        xxhash64 = staticmethod(lambda *cols: F.lit(7).cast("long"))

        def __getattr__(self, name):
            return getattr(F, name)
    monkeypatch.setattr(hashed, "F", Alike())
    other = t.with_frames({})
    assert [rows(other[n]) for n in names] == want


@pytest.mark.parametrize("name", [LINK, SAT])
def test_two_loads_meet_unhashed_as_they_meet_hashed(spark, t, name, monkeypatch):
    first = t.with_frames({"student_assessment": t["student_assessment"].filter("score > 50 or score is null")})
    first.load_ts = datetime(2023, 1, 1)
    monkeypatch.setattr(queries, "_loads", lambda g: (first, t))
    got = queries._after_two_loads(None, True)[name]
    monkeypatch.setattr(queries, "_loads", lambda g: (hashed_first(first), hashed_first(t)))
    want = queries._after_two_loads(None, True)[name]
    assert rows(got) == rows(want) and want.count() > t[name].count() - 1


@pytest.fixture
def not_adaptive(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def moved(df):
    """The columns that each exchange moves."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return [re.sub(r"#\d+L?", "", i).split(", ") for i in re.findall(
        r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)]


@pytest.mark.parametrize("name", ["bv_student_assessment", "bv_student_assessment_all_versions"])
def test_submissions_move_without_hashes(spark, not_adaptive, name):
    found = [m for m in moved(queries.QUERIES[name](spark, SMALL)) if "_id_assessment" in m]
    assert len(found) >= 4
    assert not [c for m in found for c in m if c.startswith("hk_") and not c.endswith("_head")], found


def test_clicks_move_without_hashes(spark, not_adaptive):
    found = [m for m in moved(Given(spark, SMALL).tables()["bv_engagement_weekly"]) if "_id_student" in m]
    assert len(found) == 2
    assert not [c for m in found for c in m if c.startswith("hk_") and not c.endswith("_head")], found


def test_buckets_of_unhashed_rows(spark, t, tmp_path):
    """Loads of unhashed rows give the tables and the view that loads of hashed ones give."""
    names = [LINK, SAT, "hub_student", "hub_assessment", "sat_assessment_details"]
    lazy, plain = (BucketedVault(spark, str(tmp_path / n), buckets=4) for n in ("lazy", "plain"))
    for again in range(2):
        for n in names:
            plain.load(t[n], n)
            lazy.load(t.unhashed(n) or t[n], n)
            if n == LINK or not again:
                assert rows(lazy.read(n).select(plain.read(n).columns)) == rows(plain.read(n))
    assert isinstance(lazy._opened(t, LINK), Unhashed) and not isinstance(plain._opened(t, LINK), Unhashed)
    assert rows(lazy.tables(t, names)["bv_student_assessment"]) == rows(
        plain.tables(t, names)["bv_student_assessment"])
    new = moved(lazy.tables(t, names)["bv_student_assessment"])
    assert not [m for m in new if "_id_assessment" in m and "hk_student" in m]
