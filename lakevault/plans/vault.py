"""Data vault: hubs, links, change-tracking satellites and the click transaction table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault import functions as L
from lakevault.plans.catalog import Tables, Unhashed, model

OFFERING = ["code_module", "code_presentation"]

def _distinct(t: Tables, source: str, *cols: str | Column,
              keys: tuple[list[str], ...] = ()) -> DataFrame:
    """Distinct business rows first, hashed afterwards.

    The hash is a function of the business columns, so distinct on those gives the same rows
    while only short natural keys are shuffled and each key is hashed once. A composite key with
    a NULL part hashes to NULL whatever its other parts are; the columns of each key listed in
    ``keys`` therefore become NULL together, so that such rows fall into one as well.
    """
    return t[source].select(*_null_together(cols, keys)).distinct()


def _null_together(cols: tuple[str | Column, ...], keys: tuple[list[str], ...]) -> list:
    owner = {c: key for key in keys for c in key if len(key) > 1}
    out = []
    for c in cols:
        if isinstance(c, str) and c in owner:
            complete = reduce(and_, [F.col(k).isNotNull() for k in owner[c]])
            c = F.when(complete, F.col(c)).alias(c)
        out.append(c)
    return out


def _hub(t: Tables, source: str, hk: str, *business_key: str) -> DataFrame:
    return _distinct(t, source, *business_key).select(
        L.hash_key(*business_key).alias(hk), *business_key, *t.stamp)


@model("dv", "upsert", ("hk_student",), non_null=("hk_student", "id_student"))
def hub_student(t: Tables) -> DataFrame:
    return _hub(t, "bronze_student_registration", "hk_student", "id_student")


@model("dv", "upsert", ("hk_course_offering",), non_null=("hk_course_offering", *OFFERING))
def hub_course_offering(t: Tables) -> DataFrame:
    return _hub(t, "bronze_courses", "hk_course_offering", *OFFERING)


@model("dv", "upsert", ("hk_assessment",), non_null=("hk_assessment", "id_assessment"))
def hub_assessment(t: Tables) -> DataFrame:
    return _hub(t, "bronze_assessments", "hk_assessment", "id_assessment")


@model("dv", "upsert", ("hk_vle",), non_null=("hk_vle", "id_site"))
def hub_vle(t: Tables) -> DataFrame:
    return _hub(t, "bronze_vle", "hk_vle", "id_site")


STAMP = ["dv_load_date", "dv_source"]


def _parts(*keys: list[str]) -> tuple[list[Column], list[str]]:
    """What hub keys are the hashes of, as columns that travel in their place, and their names: an
    id, or the joined text of a key of several columns."""
    names = [f"_{'_'.join(key)}" for key in keys]
    return [(F.col(key[0]) if len(key) == 1 else L.joined(*key)).alias(name)
            for key, name in zip(keys, names, strict=True)], names


def _link(t: Tables, source: str, hk: str, parts: dict[str, list[str]]) -> Unhashed:
    """``parts`` maps each hub key to its business columns; the link key joins them in order."""
    cols = [c for business in parts.values() for c in business]
    made, names = _parts(*parts.values())
    rows = _distinct(t, source, *cols, keys=tuple(parts.values())).select(*made, *t.stamp)
    hubs = {hub: L.hash_key(name) for hub, name in zip(parts, names, strict=True)}
    return Unhashed(rows, {hk: L.hash_key(*names), **hubs}, [hk, *parts, *STAMP])


@model("dv", "upsert", ("hk_student_enrollment",),
       non_null=("hk_student_enrollment", "hk_student", "hk_course_offering"))
def link_student_enrollment(t: Tables) -> DataFrame:
    return _link(t, "bronze_student_registration", "hk_student_enrollment",
                 {"hk_student": ["id_student"], "hk_course_offering": OFFERING})


@model("dv", "upsert", ("hk_student_assessment",),
       non_null=("hk_student_assessment", "hk_student", "hk_assessment"))
def link_student_assessment(t: Tables) -> DataFrame:
    return _link(t, "bronze_student_assessment", "hk_student_assessment",
                 {"hk_student": ["id_student"], "hk_assessment": ["id_assessment"]})


@model("dv", "upsert", ("hk_course_offering_assessment",),
       non_null=("hk_course_offering_assessment", "hk_assessment", "hk_course_offering"))
def link_course_offering_assessment(t: Tables) -> DataFrame:
    return _link(t, "bronze_assessments", "hk_course_offering_assessment",
                 {"hk_assessment": ["id_assessment"], "hk_course_offering": OFFERING})


@model("dv", "upsert", ("hk_course_offering_vle",),
       non_null=("hk_course_offering_vle", "hk_vle", "hk_course_offering"))
def link_course_offering_vle(t: Tables) -> DataFrame:
    return _link(t, "bronze_vle", "hk_course_offering_vle",
                 {"hk_vle": ["id_site"], "hk_course_offering": OFFERING})


@model("dv", "append", ("hk_student",))
def sat_student_details(t: Tables) -> DataFrame:
    """Keyed by student only: a student in several presentations can have several versions."""
    described = ["gender", "age_band", "highest_education", "disability", "region", "imd_band",
                 "studied_credits", "num_of_prev_attempts"]
    return _distinct(t, "bronze_student_info", "id_student", *described).select(
        L.hash_key("id_student").alias("hk_student"),
        L.hashdiff(*described).alias("hk_hashdiff"),
        "gender", "age_band", "highest_education", "disability",
        L.hash_key("region").alias("region_hashed"),
        L.hash_key("imd_band").alias("imd_band_hashed"),
        "studied_credits", "num_of_prev_attempts", *t.stamp,
    )


@model("dv", "append", ("hk_student_enrollment",))
def sat_student_enrollment(t: Tables) -> DataFrame:
    key = ["id_student", *OFFERING]
    info = t["bronze_student_info"].select(*key, "final_result")
    tracked = {
        "date_registration": F.col("date_registration"),
        "date_unregistration": F.nullif(F.col("date_unregistration"), F.lit(0.0)),
        "has_unregistered": F.col("has_unregistered"),
        "final_result": F.coalesce("final_result", F.lit("Unknown")),
        "registration_timing": L.registration_timing(F.col("date_registration")),
    }
    rows = t["bronze_student_registration"].join(info.hint("merge"), key, "left").select(
        *_null_together(tuple(key), (key,)),
        *[c.alias(n) for n, c in tracked.items()]).distinct()
    return rows.select(
        L.hash_key(*key).alias("hk_student_enrollment"),
        L.hashdiff(*tracked).alias("hk_hashdiff"), *tracked, *t.stamp)


@model("dv", "append", ("hk_course_offering",))
def sat_course_offering_details(t: Tables) -> DataFrame:
    start = L.presentation_start(F.col("code_presentation")).alias("presentation_start")
    rows = _distinct(t, "bronze_courses", *OFFERING, "length", start, keys=(OFFERING,))
    return rows.select(
        L.hash_key(*OFFERING).alias("hk_course_offering"),
        L.hashdiff("length", "presentation_start").alias("hk_hashdiff"),
        "length", "presentation_start", *t.stamp)


@model("dv", "append", ("hk_assessment",))
def sat_assessment_details(t: Tables) -> DataFrame:
    rows = _distinct(t, "bronze_assessments", "id_assessment", "assessment_type",
                     F.col("date").alias("deadline_day"), "weight")
    return rows.select(
        L.hash_key("id_assessment").alias("hk_assessment"),
        L.hashdiff("assessment_type", "deadline_day", "weight").alias("hk_hashdiff"),
        "assessment_type", "deadline_day", "weight", *t.stamp)


@model("dv", "append", ("hk_student_assessment",))
def sat_student_assessment_result(t: Tables) -> Unhashed:
    tracked = ["date_submitted", "is_banked", "score"]
    key = ["id_student", "id_assessment"]
    made, names = _parts(*[[c] for c in key])
    rows = t["bronze_student_assessment"].select(*_null_together((*key, *tracked), (key,))).select(
        *made, *tracked, *t.stamp)
    hashes = {"hk_student_assessment": L.hash_key(*names), "hk_hashdiff": L.hashdiff(*tracked)}
    return Unhashed(rows, hashes, [*hashes, *tracked, *STAMP], repeats=True)


@model("dv", "append", ("hk_vle",))
def sat_vle_details(t: Tables) -> DataFrame:
    rows = _distinct(t, "bronze_vle", "id_site", "activity_type", "week_from", "week_to")
    category = L.activity_category(F.col("activity_type"))
    tracked = ["activity_type", "activity_category", "week_from", "week_to"]
    return rows.withColumn("activity_category", category).select(
        L.hash_key("id_site").alias("hk_vle"),
        L.hashdiff(*tracked).alias("hk_hashdiff"), *tracked, *t.stamp)


@model("dv", non_null=("hk_student", "hk_vle", "date"))
def txn_student_vle_click(t: Tables) -> Unhashed:
    """Every click row with its three hash keys: a plain projection, nothing is shuffled."""
    keys = {"hk_student": ["id_student"], "hk_vle": ["id_site"], "hk_course_offering": OFFERING}
    made, names = _parts(*keys.values())
    rows = t["bronze_student_vle"].select(*made, "date", "sum_click", *t.stamp)
    hashes = {hk: L.hash_key(name) for hk, name in zip(keys, names, strict=True)}
    return Unhashed(rows, hashes, [*hashes, "date", "sum_click", *STAMP])
