"""Silver tables: cleaned rows with derived classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault import functions as L
from lakevault.plans.catalog import Tables, model

OFFERING = ["code_module", "code_presentation"]


@model("silver")
def silver_courses(t: Tables) -> DataFrame:
    return t["bronze_courses"].select(
        *OFFERING, "length",
        L.presentation_start(F.col("code_presentation")).alias("presentation_start"),
        "_ingested_at",
    )


@model("silver")
def silver_assessments(t: Tables) -> DataFrame:
    """Assessments with module length and share of the offering's total weight.

    The total is an aggregation joined back, not a window: a window would sort all assessments
    of one offering in one task. Offerings are matched NULL-safely, as a window would group them.
    """
    a = t["bronze_assessments"]
    totals = a.groupBy(*[F.col(c).alias(f"_{c}") for c in OFFERING]).agg(
        F.sum(F.col("weight").cast(L.EXACT)).cast("double").alias("_total"))
    same_offering = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in OFFERING]
    courses = t["bronze_courses"].select(*OFFERING, F.col("length").alias("module_length"))
    share = L.round_half_up(L.ratio(F.col("weight"), F.col("_total")), 4)
    return a.join(totals, same_offering, "left").join(courses, OFFERING, "left").select(
        "id_assessment", *OFFERING, "assessment_type", F.col("date").alias("deadline_day"),
        "weight", "module_length", share.alias("weight_pct"),
    )


@model("silver")
def silver_vle(t: Tables) -> DataFrame:
    return t["bronze_vle"].select(
        "id_site", *OFFERING, "activity_type", "week_from", "week_to",
        L.activity_category(F.col("activity_type")).alias("activity_category"),
    )


@model("silver")
def silver_student_info(t: Tables) -> DataFrame:
    """Demographics; the personal fields are hashed a second time, in full length."""
    return t["bronze_student_info"].select(
        "id_student", *OFFERING, "gender",
        L.hash_key("region").alias("region"), L.hash_key("imd_band").alias("imd_band"),
        "highest_education", "age_band", "num_of_prev_attempts", "studied_credits",
        "disability", "final_result", "_ingested_at",
    )


@model("silver")
def silver_student_registration(t: Tables) -> DataFrame:
    return t["bronze_student_registration"].select(
        "id_student", *OFFERING, "date_registration",
        F.nullif(F.col("date_unregistration"), F.lit(0.0)).alias("date_unregistration"),
        "has_unregistered",
        L.registration_timing(F.col("date_registration")).alias("registration_timing"),
    )


@model("silver")
def silver_student_assessment(t: Tables) -> DataFrame:
    """Submissions with their assessment; both grow together, so never broadcast."""
    meta = t["silver_assessments"].select(
        "id_assessment", "assessment_type", "deadline_day", "weight")
    return t["bronze_student_assessment"].join(meta.hint("merge"), "id_assessment", "left").select(
        "id_assessment", "id_student", "date_submitted", "is_banked", "score",
        "assessment_type", "deadline_day", "weight",
        L.assessment_result(F.col("score")).alias("assessment_result"),
        (F.col("date_submitted") - F.col("deadline_day")).alias("submission_delay_days"),
    )


@model("silver")
def silver_student_vle(t: Tables) -> DataFrame:
    """Clicks with their site. Sites are not broadcast: a plan guesses their size from the files
    behind them, which can be far off where they are made from other rows."""
    sites = t["silver_vle"].hint("merge")
    return t["bronze_student_vle"].join(sites, ["id_site", *OFFERING], "left").select(
        "id_student", *OFFERING, "id_site", "date", "sum_click",
        "activity_type", "activity_category", "week_from", "week_to",
    )
