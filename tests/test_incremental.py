"""Upsert, satellite append, latest version, daily guard; vault and warehouse over two loads."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakevault.given import FIRST_LOAD_BEFORE, SECOND_LOAD_TS, Given, second_load
from lakevault.operators import incremental as inc
from lakevault.plans import MODELS, Tables
from lakevault.plans.metrics import METRIC_KEY
from lakevault.sources.warehouse import Warehouse

SF = "/root/testdata/sf0.001"
D1, D2, D3 = (datetime(2024, 1, d) for d in (1, 2, 3))
SAT = "hk string, hk_hashdiff string, dv_load_date timestamp"


def test_upsert_replaces_all_columns_and_inserts(spark):
    old = spark.createDataFrame([("a", 1, D1), ("b", 2, D1)], "k string, v int, t timestamp")
    new = spark.createDataFrame([("b", 9, D2), ("c", 3, D2)], "k string, v int, t timestamp")
    assert sorted(map(tuple, inc.upsert_by_key(old, new, ["k"]).collect())) == [
        ("a", 1, D1), ("b", 9, D2), ("c", 3, D2)]


def test_satellite_back_and_forth_keeps_two_versions(spark):
    sat = spark.createDataFrame([("x", "A", D1)], SAT)
    sat = inc.append_new_versions(sat, spark.createDataFrame([("x", "B", D2)], SAT), "hk")
    sat = inc.append_new_versions(sat, spark.createDataFrame([("x", "A", D3)], SAT), "hk")
    assert sat.count() == 2
    assert inc.latest_version(sat, "hk").first().hk_hashdiff == "B"


def test_latest_version_ties_fall_to_the_hashdiff(spark):
    sat = spark.createDataFrame([("x", "B", D1), ("x", "A", D1), ("y", "C", D1)], SAT)
    assert sorted(r.hk_hashdiff for r in inc.latest_version(sat, "hk").collect()) == ["A", "C"]


def test_latest_version_is_limited_before_the_shuffle(spark):
    sat = spark.createDataFrame([("x", "B", D1)], SAT)
    plan = inc.latest_version(sat, "hk")._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial")
    assert plan.index("Final") < plan.index("Exchange") < partial


def test_second_run_on_a_day_adds_nothing(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    cols = "run_date date, table_name string, layer string, n int"
    day = spark.createDataFrame([(date(2024, 1, 1), "t", "dv", 1)], cols)
    wh.upsert_daily(day, "gold", "m", METRIC_KEY)
    wh.upsert_daily(day.withColumn("n", F.lit(2)), "gold", "m", METRIC_KEY)
    assert wh.read("gold", "m").first().n == 1
    later = spark.createDataFrame([(date(2024, 1, 2), "t", "dv", 3)], cols)
    wh.upsert_daily(later, "gold", "m", METRIC_KEY)
    assert sorted(r.n for r in wh.read("gold", "m").collect()) == [1, 3]


def test_overwrite_may_read_the_table_it_replaces(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.overwrite(spark.range(10), "x", "t")
    wh.overwrite(wh.read("x", "t").filter("id > 6"), "x", "t")
    assert wh.read("x", "t").count() == 3
    wh.overwrite(spark.range(2), "x", "t")
    names = [p.name for p in (tmp_path / "x" / "t").iterdir() if not p.name.startswith(".")]
    assert sorted(n.split("-")[0] for n in names) == [
        "_commit_2.json", "_commit_3.json", "segment", "segment"]


def test_failed_overwrite_leaves_the_table(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.overwrite(spark.range(10), "x", "t")
    broken = spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        wh.overwrite(broken, "x", "t")
    assert wh.read("x", "t").count() == 10


def test_partitioned_overwrite(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.overwrite(spark.range(100).selectExpr("id", "id % 3 as p"), "x", "t", ["p"])
    assert list((tmp_path / "x" / "t").glob("segment-*/p=2"))
    assert wh.read("x", "t").filter("p = 1").count() == 33


class Cut(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "create", "close", "clean"])
@pytest.mark.parametrize("kind", ["overwrite", "append", "upsert"])
def test_a_write_that_dies_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, step, kind):
    wh = Warehouse(spark, str(tmp_path))
    old, new = spark.range(10).toDF("id"), spark.range(5, 15).toDF("id")

    def write():
        if kind == "upsert":
            wh.upsert(new, "x", "t", ["id"])
        else:
            getattr(wh, kind)(new, "x", "t")

    def rows():
        return sorted(r.id for r in Warehouse(spark, str(tmp_path)).read("x", "t").collect())

    wh.upsert(old, "x", "t", ["id"])
    after = {"overwrite": list(range(5, 15)), "append": sorted([*range(10), *range(5, 15)]),
             "upsert": list(range(15))}[kind]
    die = {"write": "_write", "create": "_commit", "clean": "_names"}
    with monkeypatch.context() as m:
        if step == "close":  # the commit is there but cut off
            (tmp_path / "x" / "t" / "_commit_2.json").write_text('{"version": 2, "segm')
        elif step == "clean":
            real, calls = wh._names, []

            def names(folder):
                calls.append(folder)
                commits = [f for f in real(folder) if f.startswith("_commit_")]
                if len(commits) > 1:
                    raise Cut
                return real(folder)

            m.setattr(wh, "_names", names)
        else:
            def stop(*_, **__):
                raise Cut

            m.setattr(wh, die[step], stop)
        if step != "close":
            with pytest.raises(Cut):
                write()
    if step == "clean":
        assert rows() == after
    else:
        assert rows() == list(range(10))
        write()
        assert rows() == after


def test_upsert_rewrites_touched_parts_only(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    wh.upsert(spark.range(1000).toDF("id").withColumn("v", F.lit("old")), "x", "t", ["id"])
    first = set(wh._segments("x", "t"))
    wh.upsert(spark.range(3).toDF("id").withColumn("v", F.lit("new")), "x", "t", ["id"])
    second = set(wh._segments("x", "t"))
    assert len(first) == 64 and len(second) == 64 and len(first - second) <= 3
    got = wh.read("x", "t")
    assert got.columns == ["id", "v"] and got.count() == 1000
    assert got.filter("v = 'new'").count() == 3
    wh.upsert(got.limit(0), "x", "t", ["id"])
    assert wh.read("x", "t").count() == 1000


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Vault tables after both loads, written through the sinks, and their sizes in between."""
    full = Given(spark, SF)
    first = Given(spark, SF, orders_before=FIRST_LOAD_BEFORE).tables()
    second = Tables(second_load(full), SECOND_LOAD_TS)
    wh = Warehouse(spark, str(tmp_path_factory.mktemp("vault")))
    models = [m for m in MODELS.values() if m.kind in ("upsert", "append")]
    sizes = {}
    for load, t in enumerate((first, second)):
        for m in models:
            if m.kind == "upsert":
                wh.upsert(t[m.name], m.layer, m.name, m.key)
            else:
                wh.append_versions(t[m.name], m.layer, m.name, m.key[0])
            sizes[m.name, load] = wh.read(m.layer, m.name).count()
    return wh, sizes, second


def test_hubs_and_links_stay_unique(stored):
    wh, _, _ = stored
    for m in MODELS.values():
        if m.kind == "upsert":
            df = wh.read(m.layer, m.name)
            assert df.count() == df.select(*m.key).distinct().count(), m.name


def test_assessment_satellite_grows_by_the_changed_rows(spark, stored):
    wh, sizes, second = stored
    changed = second["assessments"].filter("id_assessment % 10 = 0").count()
    assert sizes["sat_assessment_details", 1] - sizes["sat_assessment_details", 0] == changed
    assert sizes["sat_vle_details", 1] == sizes["sat_vle_details", 0]


def test_fan_out_only_with_all_versions(stored):
    wh, _, second = stored
    frames = {m.name: wh.read(m.layer, m.name) for m in MODELS.values()
              if m.kind in ("upsert", "append")}
    latest = second.with_frames(frames)
    every = second.with_frames(frames, all_versions=True)
    links = frames["link_student_assessment"].count()
    assert latest["bv_student_assessment"].count() == links
    assert every["bv_student_assessment"].count() > links

    def weight(t):
        return t["bv_course_offering"].agg(F.sum("total_weight")).first()[0]

    assert weight(every) > weight(latest)
    assert (latest["bv_course_offering"].agg(F.sum("assessment_count")).first()
            == every["bv_course_offering"].agg(F.sum("assessment_count")).first())
