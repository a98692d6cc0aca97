"""Gold marts: dimensions, facts and the student performance report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault import functions as L
from lakevault.operators import engagement
from lakevault.plans.catalog import Tables, model
from lakevault.plans.silver import OFFERING

ENROLMENT = ["id_student", *OFFERING]
DROPOUT_CLICKS = 100


@model("gold")
def dim_student(t: Tables) -> DataFrame:
    """Enrolment keys with demographics and registration details.

    Joining the distinct keys back to the registrations would return the registrations, except
    that a key with a NULL part matches nothing. So the registrations are used as they are, and
    the (normally empty) NULL-key part is reduced to its distinct keys. One join less.
    """
    complete = " and ".join(f"{c} is not null" for c in ENROLMENT)
    reg = t["silver_student_registration"]
    keyless = reg.filter(f"not ({complete})").select(*ENROLMENT).distinct()
    base = reg.filter(complete).unionByName(keyless, allowMissingColumns=True)
    info = t["silver_student_info"].select(
        *ENROLMENT, "gender", "age_band", "highest_education", "disability",
        "num_of_prev_attempts", "studied_credits", "final_result", "_ingested_at")
    return base.join(info.hint("merge"), ENROLMENT, "left").select(
        *ENROLMENT, "gender", "age_band", "highest_education", "disability",
        "num_of_prev_attempts", "studied_credits", "final_result", "date_registration",
        "date_unregistration", "has_unregistered", "registration_timing", "_ingested_at",
    )


@model("gold")
def dim_course(t: Tables) -> DataFrame:
    """Courses with assessment count and total weight (no per-type column: it has no source)."""
    totals = t["silver_assessments"].groupBy(*OFFERING).agg(
        F.count_distinct("id_assessment").alias("assessment_count"),
        F.sum(F.col("weight").cast(L.EXACT)).cast("double").alias("total_weight"),
    )
    return t["silver_courses"].select(*OFFERING, "length", "presentation_start").distinct().join(
        totals, OFFERING, "left")


def _rollup(t: Tables, period: str) -> DataFrame:
    """Reads the clicks before the site join, see :func:`engagement.rollup`."""
    return engagement.rollup(
        t["bronze_student_vle"], t["silver_vle"], by=ENROLMENT, site_key="id_site",
        join_on=["id_site", *OFFERING], period=period)


@model("gold")
def fact_student_interaction(t: Tables) -> DataFrame:
    return _rollup(t, "date")


@model("gold")
def fact_student_assessment(t: Tables) -> DataFrame:
    return t["silver_student_assessment"].select(
        "id_student", "id_assessment", "date_submitted", "score", "is_banked",
        "assessment_type", "assessment_result", "submission_delay_days", "weight",
    )


@model("gold")
def fact_engagement_summary(t: Tables) -> DataFrame:
    """Weekly engagement. ``avg_daily_clicks`` and ``max_daily_clicks`` are per click row."""
    return _rollup(t, "week_number")


def engagement_totals(weekly: DataFrame, by: list[str]) -> DataFrame:
    """Lifetime clicks, active days and active weeks from the weekly grain.

    Weeks are already unique per group there, so a plain count replaces the distinct count.
    """
    return weekly.groupBy(*by).agg(
        F.sum("total_clicks").alias("lifetime_clicks"),
        F.sum("active_days").alias("total_active_days"),
        F.count("week_number").alias("active_weeks"),
    )


def assessment_totals(results: DataFrame, student: str) -> DataFrame:
    """Mean score, assessments taken and passed, over all courses of a student."""
    return results.groupBy(student).agg(
        L.exact_mean(F.col("score")).alias("avg_score"),
        F.count("id_assessment").alias("assessments_taken"),
        F.count_if(F.col("assessment_result") == "passed").alias("assessments_passed"),
    )


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


@model("gold")
def rpt_student_performance(t: Tables) -> DataFrame:
    """Student performance per enrolment.

    A Withdrawn student without any click row is not flagged here (unknown clicks are not
    fewer than 100); the business-vault report flags that student.
    """
    completion = F.when(F.col("total_active_days") == 0, 0.0).otherwise(
        L.round_half_up(L.ratio(F.col("assessments_passed"), F.col("assessments_taken")), 2))
    dropout = F.coalesce(
        (F.col("final_result") == "Withdrawn") & (F.col("lifetime_clicks") < DROPOUT_CLICKS),
        F.lit(False))
    clicks = engagement_totals(t["fact_engagement_summary"], ENROLMENT)
    scores = assessment_totals(t["fact_student_assessment"], "id_student")
    return (
        t["dim_student"]
        .join(clicks.hint("merge"), ENROLMENT, "left")
        .join(scores.hint("merge"), "id_student", "left")
        .select(
            *ENROLMENT, "final_result", "gender", "age_band", "disability",
            "num_of_prev_attempts", "registration_timing", "has_unregistered",
            or_zero("lifetime_clicks"), or_zero("total_active_days"), or_zero("active_weeks"),
            F.coalesce("avg_score", F.lit(0.0)).alias("avg_score"),
            or_zero("assessments_taken"), or_zero("assessments_passed"),
            completion.alias("assessment_completion_rate"),
            dropout.alias("early_dropout_flag"),
        )
    )
