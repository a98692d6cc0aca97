"""Bronze views: typed source rows minus the ones that break a basic rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.plans.catalog import Tables, model
from lakevault.schemas import BY_TABLE

# Accepted outcomes of an enrolment.
FINAL_RESULTS = ["Pass", "Fail", "Withdrawn", "Distinction"]

LINEAGE = ("_ingested_at", "_source_file")


def _rows(t: Tables, table: str) -> DataFrame:
    return t[table].select(*BY_TABLE[table].columns, *LINEAGE)


@model("bronze", "view")
def bronze_courses(t: Tables) -> DataFrame:
    return _rows(t, "courses").filter("length > 0")


@model("bronze", "view")
def bronze_assessments(t: Tables) -> DataFrame:
    return _rows(t, "assessments")


@model("bronze", "view")
def bronze_vle(t: Tables) -> DataFrame:
    return _rows(t, "vle")


@model("bronze", "view")
def bronze_student_info(t: Tables) -> DataFrame:
    return _rows(t, "student_info").filter(F.col("final_result").isin(FINAL_RESULTS))


@model("bronze", "view")
def bronze_student_registration(t: Tables) -> DataFrame:
    left = F.coalesce(F.col("date_unregistration") != 0, F.lit(False))
    return _rows(t, "student_registration").withColumn("has_unregistered", left)


@model("bronze", "view")
def bronze_student_assessment(t: Tables) -> DataFrame:
    score = F.col("score")
    return _rows(t, "student_assessment").filter(score.isNull() | score.between(0, 100))


@model("bronze", "view")
def bronze_student_vle(t: Tables) -> DataFrame:
    return _rows(t, "student_vle").filter("sum_click >= 0")
