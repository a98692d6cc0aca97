"""Business vault: views over hubs, links and satellites.

Joins with tables that grow with students, submissions, assessments or sites are never broadcasts.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault import functions as L
from lakevault.operators import engagement
from lakevault.operators.hashed import met
from lakevault.operators.incremental import HASHDIFF, LOAD_DATE, latest_version
from lakevault.plans.catalog import Tables, Unhashed, model
from lakevault.plans.gold import DROPOUT_CLICKS, assessment_totals, engagement_totals, or_zero


#: What the key of an offering is the hash of, in unhashed rows.
OFFERING_PART = "_code_module_code_presentation"


def _bytes(df: DataFrame) -> DataFrame:
    """Hash keys as 32 bytes instead of 64 hex characters, for everything that shuffles; tables that
    are stored by bytes stay as they are."""
    return df.withColumns({c: F.unhex(c) for c, kind in df.dtypes
                           if c.startswith("hk_") and kind == "string"})


def _hex(df: DataFrame) -> DataFrame:
    """Hash keys as they are stored."""
    return df.withColumns({c: F.lower(F.hex(c)) for c in df.columns if c.startswith("hk_")})


def _satellite(t: Tables, sat: str, key: str, *columns: str) -> DataFrame:
    """Key as bytes and some columns of a satellite, for joins to its key.

    A NULL key becomes the first bytes of the hashdiff, which no hash key equals: a join infers that
    its key is not NULL, and that filter, pushed below the model, would keep the satellite from
    sharing the shuffles of the link over the same rows. Keys that are stored by bytes stay.

    An unhashed satellite moves to its keys before these and the hashdiffs are taken."""
    made = t.unhashed(sat)
    if made:
        rows = made.placed(key, _no_key(made.hashes[HASHDIFF]))
        if made.repeats and HASHDIFF not in columns:  # of versions in order the newest is one anyway
            rows = rows.drop(HASHDIFF).distinct()
        return rows.select(key, *columns)
    rows = t[sat]
    known = rows.schema[key].dataType.simpleString() == "binary"
    never_null = F.coalesce(F.unhex(key), _no_key(F.col(HASHDIFF))).alias(key)
    return _bytes(rows.select(F.col(key) if known else never_null, *columns))


def _no_key(diff: Column) -> Column:
    digits = F.when(F.length(diff) == 64, F.left(diff, F.lit(16)))
    return F.coalesce(F.unhex(digits), F.lit(bytearray(1)))


def _latest(t: Tables, sat: str, key: str, *columns: str) -> DataFrame:
    """Key and some columns of the newest satellite rows; the hashdiff settles ties as bytes."""
    rows = _satellite(t, sat, key, *columns, LOAD_DATE, HASHDIFF)
    return latest_version(rows, key).select(key, *columns)


def _versions(t: Tables, sat: str, key: str, *columns: str) -> DataFrame:
    """As :func:`_latest`, or of all satellite rows when the tables ask for every version."""
    return (_satellite(t, sat, key, *columns) if t.all_versions
            else _latest(t, sat, key, *columns))


@model("bv", unique=("hk_course_offering",),
       non_null=("hk_course_offering", "code_module", "code_presentation"))
def bv_course_offering(t: Tables) -> DataFrame:
    details = _versions(t, "sat_course_offering_details", "hk_course_offering", "length",
                        "presentation_start")
    weights = _versions(t, "sat_assessment_details", "hk_assessment", "assessment_type", "weight")
    per_offering = (
        _bytes(t["link_course_offering_assessment"].select("hk_course_offering", "hk_assessment"))
        .join(weights.hint("merge"), "hk_assessment", "left")
        .groupBy("hk_course_offering")
        .agg(
            F.array_sort(F.collect_set("assessment_type")).alias("types"),
            F.count_distinct("hk_assessment").alias("assessment_count"),
            F.sum(F.col("weight").cast(L.EXACT)).cast("double").alias("total_weight"),
        )
    )
    type_list = F.when(F.size("types") > 0, F.array_join("types", ", "))
    return _hex(
        _bytes(t["hub_course_offering"])
        .join(details, "hk_course_offering", "left")
        .join(per_offering, "hk_course_offering", "left")
        .select(
            "hk_course_offering", "code_module", "code_presentation", "length",
            "presentation_start", type_list.alias("assessment_types"),
            "assessment_count", "total_weight",
        )
    )


def _rollup(t: Tables, period: str) -> DataFrame | Unhashed:
    """Of unhashed clicks the ids are grouped and move, and only groups are hashed."""
    group = ["hk_student", "hk_course_offering"]
    sites = _versions(t, "sat_vle_details", "hk_vle", "activity_type")
    made = t.unhashed("txn_student_vle_click")
    if made:
        by, hashes = ["_id_student", OFFERING_PART], {k: made.hashes[k] for k in group}
        rows = engagement.rollup(
            made.rows.select(*made.parts, "date", "sum_click"), sites, by=by, site_key="_id_site",
            join_on=["hk_vle"], period=period, unique_sites=not t.all_versions,
            made=F.unhex(made.hashes["hk_vle"]))
        return Unhashed(rows, hashes, [*group, *[c for c in rows.columns if c not in by]])
    clicks = _bytes(t["txn_student_vle_click"].select(*group, "hk_vle", "date", "sum_click"))
    return _hex(engagement.rollup(clicks, sites, by=group, site_key="hk_vle", join_on=["hk_vle"],
                                  period=period, unique_sites=not t.all_versions))


@model("bv", non_null=("hk_student", "date"))
def bv_engagement_daily(t: Tables) -> DataFrame | Unhashed:
    return _rollup(t, "date")


@model("bv", non_null=("hk_student", "week_number"))
def bv_engagement_weekly(t: Tables) -> DataFrame | Unhashed:
    return _rollup(t, "week_number")


@model("bv", non_null=("hk_student_assessment", "id_student", "id_assessment"))
def bv_student_assessment(t: Tables) -> DataFrame:
    """Submissions; the two joins on the assessment key follow each other and share a shuffle.

    There a student's key does not travel if it is the hash of the id that the hub gave: it is hashed
    again behind the joins. Any other key travels. Of an unhashed link the ids travel, and no key."""
    result = _versions(t, "sat_student_assessment_result", "hk_student_assessment",
                       "date_submitted", "is_banked", "score")
    details = _versions(t, "sat_assessment_details", "hk_assessment", "assessment_type",
                        "deadline_day", "weight")
    hashed = L.hash_key("id_student")
    students = _bytes(t["hub_student"].select("hk_student", "id_student")).withColumn(
        "_hashed", F.col("hk_student") == F.unhex(hashed))
    assessments = _bytes(t["hub_assessment"].select("hk_assessment", "id_assessment"))
    key, link = "hk_student_assessment", t.unhashed("link_student_assessment")
    if link:
        of = {k: F.unhex(h) for k, h in link.hashes.items()}
        rows = link.rows.select(*link.parts, *[c for c in link.rows.columns if c == key])
        if key not in rows.columns:
            rows = rows.repartition(of[key]).withColumn(key, of[key])
        rows = rows.join(result.hint("merge"), key, "left").drop(key)
        rows = met(rows, students.drop("_hashed"), "hk_student", of["hk_student"])
        # the id of the link, where the hub did not give the same
        other = F.when(F.col("id_student") == F.col("_id_student"), None).otherwise(F.col("_id_student"))
        rows = rows.withColumn("_other", other).drop("_id_student", "hk_student_head")
        for side in (assessments, details):
            rows = met(rows, side, "hk_assessment", of["hk_assessment"])
        rows = rows.withColumn("_id_student", F.coalesce("_other", "id_student")).withColumns(of)
    else:
        other = F.when(F.coalesce("_hashed", F.lit(False)), None).otherwise(F.col("hk_student"))
        rows = (
            _bytes(t["link_student_assessment"].select(
                "hk_student_assessment", "hk_student", "hk_assessment"))
            .join(result.hint("merge"), "hk_student_assessment", "left")
            .join(students.hint("merge"), "hk_student", "left")
            .withColumn("_other", other).drop("hk_student", "_hashed")
            .join(assessments.hint("merge"), "hk_assessment", "left")
            .join(details.hint("merge"), "hk_assessment", "left")
            .withColumn("hk_student", F.coalesce("_other", F.unhex(hashed)))
        )
    return _hex(
        rows.select(
            "hk_student_assessment", "hk_student", "hk_assessment", "id_student", "id_assessment",
            "date_submitted", "is_banked", "score", "assessment_type", "deadline_day", "weight",
            L.assessment_result(F.col("score")).alias("assessment_result"),
            (F.col("date_submitted") - F.col("deadline_day")).alias("submission_delay_days"),
        )
    )


@model("bv", unique=("hk_student_enrollment",), non_null=("hk_student_enrollment", "id_student"))
def bv_student_enrollment(t: Tables) -> DataFrame:
    """Enrolments with the student's latest details (per student) and enrolment state."""
    details = _latest(
        t, "sat_student_details", "hk_student", "gender", "age_band", "highest_education",
        "disability", "region_hashed", "imd_band_hashed", "studied_credits",
        "num_of_prev_attempts")
    state = _latest(
        t, "sat_student_enrollment", "hk_student_enrollment", "date_registration",
        "date_unregistration", "has_unregistered", "final_result", "registration_timing")
    offering = _bytes(t["hub_course_offering"].select(
        "hk_course_offering", "code_module", "code_presentation"))
    students = _bytes(t["hub_student"].select("hk_student", "id_student"))
    return _hex(
        _bytes(t["link_student_enrollment"].select(
            "hk_student_enrollment", "hk_student", "hk_course_offering"))
        .join(students.hint("merge"), "hk_student", "left")
        .join(details.hint("merge"), "hk_student", "left")
        .join(offering, "hk_course_offering", "left")
        .join(state.hint("merge"), "hk_student_enrollment", "left")
        .select(
            "hk_student_enrollment", "hk_student", "hk_course_offering", "id_student",
            "code_module", "code_presentation", "gender", "age_band", "highest_education",
            "disability", "region_hashed", "imd_band_hashed", "studied_credits",
            "num_of_prev_attempts", "date_registration", "date_unregistration",
            "has_unregistered", "final_result", "registration_timing",
        )
    )


@model("bv", non_null=("id_student",))
def bv_student_performance(t: Tables) -> DataFrame:
    """Student performance per enrolment; no clicks count as 0 clicks, nothing taken as rate 0."""
    offering = ["hk_student", "hk_course_offering"]
    rate = L.round_half_up(L.ratio(F.col("assessments_passed"), F.col("assessments_taken")), 2)
    completion = F.coalesce(rate, F.lit(0.0))
    clicks = F.coalesce("lifetime_clicks", F.lit(0))
    dropout = F.coalesce(
        (F.col("final_result") == "Withdrawn") & (clicks < DROPOUT_CLICKS), F.lit(False))
    engaged = engagement_totals(_bytes(t["bv_engagement_weekly"]), offering)
    scores = assessment_totals(_bytes(t["bv_student_assessment"]), "hk_student")
    return _hex(
        _bytes(t["bv_student_enrollment"])
        .join(engaged.hint("merge"), offering, "left")
        .join(scores.hint("merge"), "hk_student", "left")
        .select(
            "hk_student_enrollment", "id_student", "code_module", "code_presentation",
            "final_result", "gender", "age_band", "disability", "num_of_prev_attempts",
            "registration_timing", "has_unregistered",
            or_zero("lifetime_clicks"), or_zero("total_active_days"), or_zero("active_weeks"),
            F.coalesce("avg_score", F.lit(0.0)).alias("avg_score"),
            or_zero("assessments_taken"), or_zero("assessments_passed"),
            completion.alias("assessment_completion_rate"),
            dropout.alias("early_dropout_flag"),
        )
    )


def bv_quality_metrics(t: Tables, run_date: date) -> DataFrame:
    """The placeholder metrics row of the business vault: only ``row_count`` is measured.

    Stored by (run_date, table_name, layer), once per day, see
    :func:`lakevault.operators.incremental.newer_than_stored`. The measured metrics are in
    :mod:`lakevault.plans.metrics`.
    """
    # The constants the placeholder row carries.
    constants = {
        "expectations_evaluated": 18, "expectations_passed": 18, "expectations_failed": 0,
        "pass_rate": 100.0, "anomalies_detected": 0, "click_anomalies": 0, "score_anomalies": 0,
        "temporal_anomalies": 0, "row_count": None, "pipeline_duration_sec": 0,
        "dbt_tests_passed": 0, "dbt_tests_failed": 0,
    }
    rows = t["link_student_enrollment"].agg(F.count(F.lit(1)).alias("row_count"))
    return rows.select(
        F.lit(run_date).cast("date").alias("run_date"),
        F.lit("student_enrollment").alias("table_name"),
        F.lit("dv").alias("layer"),
        *[F.col(n) if v is None else F.lit(v).alias(n) for n, v in constants.items()],
    )
