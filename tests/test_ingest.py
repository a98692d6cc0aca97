"""CSV scan, validation, coercion, duplicate keys and the bronze sink."""

from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lakevault.functions import to_long
from lakevault.operators import ingest
from lakevault.schemas import SPECS, spec_for
from lakevault.sources.csv_files import load_all_tables, load_table, read_csv, summary_frame
from lakevault.sources.warehouse import Warehouse

TS = datetime(2024, 1, 1, 5)


def write(folder, name, text):
    path = folder / f"{name}.csv"
    path.write_text(text)
    return str(path)


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def test_header_is_stripped_and_aliased(spark, warehouse, tmp_path):
    path = write(tmp_path, "courses",
                 " code_module,code_presentation ,module_presentation_length\nAAA,2013J,268\n")
    assert load_table(spark, warehouse, "courses", path, TS) == (1, [])
    row = warehouse.read("bronze", "courses").first()
    assert (row.code_module, row.length, row._source_file) == ("AAA", 268, "courses.csv")
    assert row._ingested_at == TS


def test_wrong_header_rejects_the_table_and_keeps_the_old_one(spark, warehouse, tmp_path):
    good = write(tmp_path, "courses", "code_module,code_presentation,length\nA,1B,9\n")
    load_table(spark, warehouse, "courses", good, TS)
    bad = write(tmp_path, "bad", "code_module,length,extra\nA,9,1\n")
    rows, errors = load_table(spark, warehouse, "courses", bad, TS)
    assert rows == 0
    assert errors == ["missing columns: ['code_presentation']", "unexpected columns: ['extra']"]
    assert warehouse.read("bronze", "courses").count() == 1


def test_unreadable_file_is_an_error_not_an_exception(spark, warehouse, tmp_path):
    rows, errors = load_table(spark, warehouse, "courses", str(tmp_path / "none.csv"), TS)
    assert rows == 0 and errors[0].startswith("CSV read failed")


def test_unknown_table(spark, warehouse):
    with pytest.raises(ValueError, match="unknown table"):
        load_table(spark, warehouse, "teachers", "x.csv", TS)


@pytest.mark.parametrize("cell,expected", [
    ("", 0), ("NA", 0), ("NaN", 0), ("?", 0), ("3.7", 3), (" 12 ", 12), ("-4.9", -4),
    ("1e300", 0), (None, 0),
])
def test_integer_cells(spark, cell, expected):
    df = spark.createDataFrame([("A", "1B", cell, 0)], "code_module string, "
                               f"code_presentation string, length string, {ingest.FILE_ORDER} int")
    assert ingest.coerce(df, SPECS["courses"]).first().length == expected


def test_float_cells_keep_null_and_question_mark_stays_text(spark):
    df = spark.createDataFrame(
        [("1", "2", "x", "1", "NA"), ("1", "3", None, "0", "7.5")],
        "id_assessment string, id_student string, date_submitted string, is_banked string, "
        "score string")
    rows = ingest.coerce(df, SPECS["studentAssessment"]).collect()
    assert [(r.date_submitted, r.score) for r in rows] == [(None, None), (None, 7.5)]
    assert spark.range(1).select(ingest.blank_na(F.lit("?"))).first()[0] == "?"


def submissions(spark, rows):
    return spark.createDataFrame(
        rows, "id_assessment long, id_student long, score double, note string, line int")


def test_any_duplicate_turns_every_missing_number_into_zero(spark):
    df = submissions(spark, [(1, 1, 5.0, None, 2), (1, 1, None, "b", 3), (1, 1, 2.0, "c", 4),
                             (2, 2, None, "z", 1), (3, 3, 4.0, None, 5)])
    out = ingest.dedup_sum(df, ["id_assessment", "id_student"], "line")
    assert sorted(map(tuple, out.collect())) == [
        (1, 1, 7.0, "b"), (2, 2, 0.0, "z"), (3, 3, 4.0, None)]
    keep = ingest.dedup_sum(df, ["id_assessment", "id_student"], "line", null_sum="keep")
    assert (2, 2, None, "z") in [tuple(r) for r in keep.collect()]


def test_without_duplicates_nothing_changes(spark):
    rows = [(1, 1, None, "a", 1), (None, 2, 3.0, "b", 2)]
    out = ingest.dedup_sum(submissions(spark, rows), ["id_assessment", "id_student"], "line")
    assert {tuple(r) for r in out.collect()} == {(1, 1, None, "a"), (None, 2, 3.0, "b")}


def test_duplicates_drop_rows_without_key(spark):
    rows = [(1, 1, 1.0, "a", 1), (1, 1, 1.0, "a", 2), (None, 2, 3.0, "b", 3)]
    out = ingest.dedup_sum(submissions(spark, rows), ["id_assessment", "id_student"], "line")
    assert [tuple(r) for r in out.collect()] == [(1, 1, 2.0, "a")]


def test_clicks_need_no_duplicate_probe(spark):
    spec = SPECS["studentVle"]
    raw = spark.createDataFrame(
        [("A", "1B", "1", "2", "3", "x", 1)],
        ", ".join(f"{c} string" for c in spec.columns) + f", {ingest.FILE_ORDER} int")
    out = ingest.dedup_sum(ingest.coerce(raw, spec), spec.pk, ingest.FILE_ORDER)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan
    assert out.first().sum_click == 0


def test_file_order_decides_the_first_value(spark, tmp_path):
    lines = "".join(f"1,M{i},P,quiz,1,2\n" for i in range(200))
    path = write(tmp_path, "vle",
                 "id_site,code_module,code_presentation,activity_type,week_from,week_to\n" + lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    try:
        raw = read_csv(spark, path)
        assert raw.rdd.getNumPartitions() > 1
        row = ingest.to_bronze(raw, SPECS["vle"], TS, "vle.csv").first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert (row.code_module, row.week_from) == ("M0", 200)


def test_pseudonym_is_the_hash_prefix_and_null_stays_null(spark):
    df = spark.createDataFrame([Row(region="Wales"), Row(region=None)])
    out = ingest.pseudonymise(df, ["region", "imd_band"]).collect()
    assert [r.region for r in out] == [hashlib.sha256(b"Wales").hexdigest()[:16], None]


def test_load_all_skips_absent_files_logs_and_is_idempotent(spark, warehouse, tmp_path):
    write(tmp_path, "courses", "code_module,code_presentation,length\nA,1B,9\nA,1B,1\n")
    write(tmp_path, "studentInfo", "wrong\n1\n")
    events = []
    audit = lambda **e: events.append(e)
    first = load_all_tables(spark, warehouse, str(tmp_path), TS, audit)
    before = warehouse.read("bronze", "courses").collect()
    second = load_all_tables(spark, warehouse, str(tmp_path), TS, audit)
    assert first == second and first["courses"] == (1, []) and first["studentInfo"][0] == 0
    assert set(first) == {"courses", "studentInfo"}
    assert warehouse.read("bronze", "courses").collect() == before
    assert before[0].length == 10
    log = warehouse.read("bronze", "ingestion_log").collect()
    assert [(r.table_name, r.file_name, r.row_count) for r in log] == [
        ("courses", "courses.csv", 1)] * 2
    assert events[0]["resource"] == "bronze.courses" and events[0]["detail"]["rows"] == 1
    assert summary_frame(spark, first).filter("errors is not null").count() == 1


def test_spec_lists_twelve_columns_of_student_info():
    assert len(spec_for("studentInfo").columns) == 12


def test_rows_of_odd_length(spark, warehouse, tmp_path):
    short, long = tmp_path / "short.csv", tmp_path / "long.csv"
    names = "code_module,code_presentation,module_presentation_length"
    short.write_text(names + '\nAAA,"2013""J",268\nBBB,2014B\n')
    assert load_table(spark, warehouse, "courses", str(short), TS) == (2, [])
    before = warehouse.read("bronze", "courses").collect()
    assert {(r.code_module, r.code_presentation, r.length) for r in before} == {
        ("AAA", '2013"J', 268), ("BBB", "2014B", 0)}
    long.write_text(names + "\nAAA,2013J,268,\n")
    count, errors = load_table(spark, warehouse, "courses", str(long), TS)
    assert count == 0 and "a row has 4 cells, the header 3" in errors[0]
    assert warehouse.read("bronze", "courses").collect() == before


@pytest.mark.parametrize("row", ['AAA,2013J,"26\n8"', '"A\nAA",2013J,268', 'AAA,"20\n13J",268'])
def test_line_breaks_inside_quotes(spark, warehouse, tmp_path, row):
    file = tmp_path / "broken.csv"
    names = "code_module,code_presentation,module_presentation_length"
    file.write_text(f"{names}\nCCC,2014J,1\n{row}\n")
    count, errors = load_table(spark, warehouse, "courses", str(file), TS)
    assert count == 0 and "line break" in errors[0]
    assert not warehouse.exists("bronze", "courses")
    assert load_table(spark, warehouse, "courses", str(file), TS, multi_line=True) == (2, [])


def test_a_log_that_fails_is_a_warning(spark, warehouse, tmp_path):
    file = tmp_path / "c.csv"
    file.write_text("code_module,code_presentation,module_presentation_length\nCCC,2014J,1\n")

    def audit(**_):
        raise OSError("no log today")

    with pytest.warns(UserWarning, match="no log today"):
        assert load_table(spark, warehouse, "courses", str(file), TS, audit) == (1, [])
    assert warehouse.read("bronze", "courses").count() == 1


def test_numbers_as_they_stand(spark):
    cells = ["9007199254740993", "12d", "7F", "9223372036854775808", "-3.9", " 4 ", "1e3", "0x10", "NaN",
             "9007199254740992.0", "+5", ".5", "5."]
    row = spark.createDataFrame([cells], [f"c{i}" for i in range(len(cells))])
    got = row.select(*[to_long(F.col(c)).alias(c) for c in row.columns]).first()
    assert list(got) == [9007199254740993, None, None, None, -3, 4, 1000, None, None,
                         9007199254740992, 5, 0, 5]
