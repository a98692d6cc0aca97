"""Streams: replay, failure between tables, restart, arrival order, late rows."""

from __future__ import annotations

import collections
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakevault import queries
from lakevault.given import Given
from lakevault.operators import ingest
from lakevault.plans import MODELS, Tables
from lakevault.plans import engagement_state as state
from lakevault.schemas import SPECS
from lakevault.sources.warehouse import Warehouse
from lakevault.streaming import landing, repeats, vault, weekly

SF = "/root/testdata/sf0.001"
TS = datetime(2024, 1, 1)
CLICK = ("code_module string, code_presentation string, id_student long, id_site long, date long, "
         "sum_click long")


def clicks(spark, *rows):
    return spark.createDataFrame([("M1", "2013J", *r) for r in rows], CLICK)


def counted(df):
    return collections.Counter(map(tuple, df.collect()))


class Place:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.folder, self.checkpoint = f"{root}/landing", f"{root}/checkpoint"
        self.warehouse = Warehouse(spark, f"{root}/warehouse")

    def land(self, df):
        df.coalesce(1).write.mode("append").parquet(self.folder)
        return landing.landed(self.spark, self.folder, df.schema, files_per_batch=1)


def test_a_batch_comes_once(spark, tmp_path):
    wh, rows = Warehouse(spark, str(tmp_path)), spark.range(3)
    wh.append(rows, "dv", "t", ("s", 0))
    wh.append(rows, "dv", "t", ("s", 0))
    wh.append(rows, "dv", "t", ("s", 1))
    wh.append(rows, "dv", "t", ("other", 0))
    assert wh.read("dv", "t").count() == 9
    wh.overwrite(wh.read("dv", "t").coalesce(1), "dv", "t")  # compaction keeps what it knows
    wh.append(rows, "dv", "t", ("s", 1))
    assert wh.read("dv", "t").count() == 9
    assert not wh.holds("dv", "t", ("s", 2)) and not wh.holds("dv", "absent", ("s", 0))


def test_replay_adds_no_row(spark, tmp_path):
    at = Place(spark, tmp_path)
    models = ["txn_student_vle_click"]
    sink, seen = vault.into_vault(at.warehouse.root, "student_vle", models, TS), []

    def source(*rows):
        return clicks(spark, *rows).withColumns({"_ingested_at": F.lit(TS), "_source_file": F.lit("f")})

    def twice(rows, batch):
        seen.append(batch)
        sink(rows, batch)
        sink(rows, batch)

    landing.drain(at.land(source((1, 10, 0, 5), (2, 10, 1, 6))), twice, at.checkpoint)
    landing.drain(at.land(source((1, 10, 0, 5))), twice, at.checkpoint)
    landing.drain(at.land(source((3, 10, 0, -5))), twice, at.checkpoint)  # the view drops it
    assert at.warehouse.read("dv", "txn_student_vle_click").count() == 3
    assert [n for _, n in seen] == [0, 1, 2] and len({s for s, _ in seen}) == 1


def test_failure_between_two_tables_is_made_good(spark, tmp_path, monkeypatch):
    at = Place(spark, tmp_path)
    rows = Given(spark, SF).assessments
    models = ["hub_assessment", "sat_assessment_details"]
    sink = vault.into_vault(at.warehouse.root, "assessments", models, TS)
    kept = Warehouse.append_versions

    def broken(self, *args):
        raise OSError("the disk is gone")

    monkeypatch.setattr(Warehouse, "append_versions", broken)
    with pytest.raises(Exception, match="the disk is gone"):
        landing.drain(at.land(rows), sink, at.checkpoint)
    assert at.warehouse.exists("dv", "hub_assessment")
    assert not at.warehouse.exists("dv", "sat_assessment_details")
    monkeypatch.setattr(Warehouse, "append_versions", kept)
    landing.drain(landing.landed(spark, at.folder, rows.schema), sink, at.checkpoint)
    t = Tables({"assessments": rows}, TS)
    for name in models:
        assert counted(at.warehouse.read("dv", name).select(t[name].columns)) == counted(t[name])


def test_only_vault_models_are_fed(tmp_path):
    with pytest.raises(ValueError, match="vault"):
        vault.into_vault(str(tmp_path), "student_vle", ["silver_vle"], TS)


def sites(spark):
    rows = [(10, "M1", "2013J", "quiz"), (11, "M1", "2013J", "url"), (11, "M1", "2013J", "page")]
    return spark.createDataFrame(
        rows, "id_site long, code_module string, code_presentation string, activity_type string")


def engaged(at, stream, delay):
    progress = landing.drain(weekly.states(stream, delay), weekly.into_states(at.warehouse.root),
                             at.checkpoint, "update")
    return sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])


@pytest.mark.parametrize("backwards", [False, True])
def test_weekly_states_in_any_order(spark, tmp_path, backwards):
    at = Place(spark, tmp_path)
    parts = [clicks(spark, (1, 10, 0, 5), (1, 10, 0, 7), (2, 11, 3, 1)),
             clicks(spark, (1, 11, 6, 1), (1, None, 2, 9), (1, 10, 7, 4)),
             clicks(spark, (1, 10, -1, 4), (2, 11, 20, 1), (1, 10, 5, 2))]
    whole = parts[0].union(parts[1]).union(parts[2])
    for part in parts[::-1] if backwards else parts:
        assert engaged(at, at.land(part), "10000 days") == 0
    got = state.summary(at.warehouse.read(weekly.LAYER, weekly.NAME), sites(spark))
    want = state.summary(state.states_of(whole), sites(spark))
    assert counted(got) == counted(want)
    late = weekly.late_clicks(whole, at.warehouse.read(weekly.LAYER, weekly.NAME)).collect()
    assert sum(r["landed"] for r in late) == 9 and all(r["late"] == 0 for r in late)


def test_late_clicks_are_dropped_and_counted(spark, tmp_path):
    at = Place(spark, tmp_path)
    first = clicks(spark, (1, 10, 0, 5), (1, 10, 70, 5))  # the watermark: end of week 10, less 7 days
    second = clicks(spark, (1, 10, 1, 9), (1, 10, 2, 9), (1, 10, 66, 9), (1, 10, 69, 1), (1, 10, 70, 3))
    assert engaged(at, at.land(first), "7 days") == 0
    assert engaged(at, at.land(second), "7 days") > 0
    stored = at.warehouse.read(weekly.LAYER, weekly.NAME)
    found = {r["week_number"]: (r["landed"], r["accepted"], r["late"])
             for r in weekly.late_clicks(first.union(second), stored).collect()}
    assert found == {0: (3, 1, 2), 9: (2, 0, 2), 10: (2, 2, 0)}
    assert {r["week_number"]: r["_clicks"] for r in stored.collect()} == {0: 5, 10: 8}


def test_odd_presentations_are_never_late(spark):
    rows = spark.createDataFrame([("2013J",), ("2014B",), ("x",), (None,), ("2013Z",)], "p string")
    days = [r[0] for r in rows.select(weekly.presentation_day(F.col("p"))).collect()]
    assert [str(d) for d in days] == ["2013-10-01", "2014-02-01", "None", "None", "None"]


def test_sums_survive_a_restart_and_corrections_are_told(spark, tmp_path):
    at, key = Place(spark, tmp_path), ["id_student", "id_site", "date"]
    form = CLICK + ", line long"
    first = [("M1", "2013J", 1, 10, 0, 5, 4), ("M2", None, 1, 10, 0, 6, 2), ("M3", "2014B", 2, 10, 0, None, 9)]
    second = [("M9", "2012B", 1, 10, 0, 7, 1), ("M3", "2014B", 3, 10, 0, 1, 1), ("M4", "2014B", None, 1, 0, 1, 1)]
    sink = repeats.into_log(at.warehouse.root, "bronze", "log")
    for rows in (first, second):
        stream = at.land(spark.createDataFrame(rows, form))
        landing.drain(repeats.summed(stream, key, "line"), sink, at.checkpoint, "update")
    log = at.warehouse.read("bronze", "log")
    got = counted(repeats.newest(log, key))
    whole = spark.createDataFrame(first + second[:2], form)
    assert got == counted(ingest.dedup_sum(whole, key, "line", "keep"))
    assert [tuple(r) for r in repeats.corrections(log, key, "sum_click").collect()] == [
        (1, 10, 0, 2, 11, 18)]


def test_sums_are_a_grouping_of_the_stream(spark, tmp_path):
    """No Python runs for a key; a key that has several rows in a batch is handed on once."""
    at, key, n = Place(spark, tmp_path), ["id_student", "id_site", "date"], None
    form = "id_student long, id_site long, date long, sum_click int, score double, line int"
    batches = [[(1, 10, 0, 5, None, 4), (1, 10, 0, 1, None, 2), (2, 10, 0, n, n, 1)],
               [(2, 10, 0, n, 1.5, 1), (3, 10, 0, 7, n, 1), (3, 10, n, 7, n, 1)],
               [(1, 10, 0, 2, 0.5, 9), (2, 10, 0, n, n, 2), (2, 10, 0, n, n, 3)]]
    for rows in batches:
        out = repeats.summed(at.land(spark.createDataFrame(rows, form)), key, "line")
        assert "TransformWithState" not in out._jdf.queryExecution().analyzed().toString()
        landing.drain(out, repeats.into_log(at.warehouse.root, "bronze", "log"), at.checkpoint, "update")
    log = at.warehouse.read("bronze", "log")
    assert log.schema["sum_click"].dataType.simpleString() == "int"
    assert counted(log) == collections.Counter([
        (1, 10, 0, 6, None, 1, False), (2, 10, 0, None, None, 1, False),
        (2, 10, 0, None, 1.5, 2, True), (3, 10, 0, 7, None, 1, False),
        (1, 10, 0, 8, 0.5, 2, True), (2, 10, 0, None, 1.5, 3, True)])


def test_refresh_leaves_other_weeks_unread(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    one = clicks(spark, (1, 10, 0, 5), (1, 10, 30, 5), (2, 11, 0, 1))
    two = clicks(spark, (1, 11, 1, 2), (1, 10, 2, 2), (3, 10, 0, 2))
    assert state.refresh(wh, one, sites(spark), 0, weeks=1) == ["2013J-0", "2013J-4"]
    before = {s for s in wh._segments(state.LAYER, state.NAME) if s.endswith("2013J-4")}
    for file in (tmp_path / state.LAYER / state.NAME).rglob("*2013J-4/*.parquet"):
        file.write_bytes(b"unreadable")  # whoever reads this week fails
    assert state.refresh(wh, two, sites(spark), 1, weeks=1) == ["2013J-0"]
    state.refresh(wh, two, sites(spark), 1, weeks=1)  # the same load again
    assert before <= set(wh._segments(state.LAYER, state.NAME))
    got = wh.read(state.LAYER, state.ROLLUP)
    want = state.summary(state.states_of(one.union(two)), sites(spark))
    assert counted(got.select(want.columns)) == counted(want)


@pytest.mark.parametrize("weeks", [1, 13])
def test_refreshed_loads_equal_one_build(spark, tmp_path, weeks):
    wh, rows = Warehouse(spark, str(tmp_path)), []
    for load in range(3):
        mine = [(s, 10 + s % 2, 7 * load + s, s + load) for s in range(-3, 9)]
        rows += mine
        state.refresh(wh, clicks(spark, *mine), sites(spark), load, weeks=weeks)
    want = MODELS["fact_engagement_summary"].build(Tables({
        "bronze_student_vle": clicks(spark, *rows), "silver_vle": sites(spark)}, TS))
    assert counted(wh.read(state.LAYER, state.ROLLUP).select(want.columns)) == counted(want)


def test_specs_name_the_click_key():
    assert list(SPECS["studentVle"].pk) == ["id_student", "id_site", "date"]


def test_a_batch_is_computed_once(spark, tmp_path):
    """The sink asks for its rows several times; the stateful part runs once a batch."""
    at, seen = Place(spark, tmp_path), spark.sparkContext.accumulator(0)

    def counted_rows(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    stream = at.land(clicks(spark, (1, 10, 0, 5), (2, 11, 3, 1))).mapInArrow(counted_rows, CLICK)
    assert engaged(at, stream, "10000 days") == 0
    assert seen.value == 2 and at.warehouse.read(weekly.LAYER, weekly.NAME).count() == 2


def test_a_part_lands_in_as_many_files_as_tasks(spark):
    at, width = queries.Landing(Given(spark, SF), "parts"), spark.sparkContext.defaultParallelism
    schema, batches = at.land(spark.range(1000).toDF("n"), 2), []
    landing.drain(at.stream(schema, 1), lambda rows, batch: batches.append(
        (rows.count(), rows.rdd.getNumPartitions())), f"{at.root}/checkpoint")
    assert sum(n for n, _ in batches) == 1000 and len(batches) == 2
    assert all(len(spark.read.parquet(at.folder).inputFiles()) == 2 * width for _ in batches)


def test_hash_keys_are_stored_in_half_their_digits(spark, tmp_path):
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("hk_student"))
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.append(rows, "dv", "keys")
    stored = sum(f.stat().st_size for f in (tmp_path / "wh").rglob("*.parquet"))
    assert stored < 20_000 * 40
    assert wh.read("dv", "keys").distinct().count() == 20_000
