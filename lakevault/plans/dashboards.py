"""Queries behind the dashboard pages, over the gold models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakevault import functions as L
from lakevault.plans.bronze import FINAL_RESULTS
from lakevault.plans.catalog import Tables
from lakevault.plans.gold import ENROLMENT
from lakevault.plans.silver import OFFERING

LOW_ACTIVE_DAYS, LOW_COMPLETION = 5, 0.5
DROP_OFF = 0.5


def pass_rate(t: Tables) -> DataFrame:
    """Share of enrolments that ended in Pass or Distinction."""
    passed = F.count_if(F.col("final_result").isin("Pass", "Distinction"))
    return t["dim_student"].agg(
        passed.alias("passed"), F.count(F.lit(1)).alias("students"),
    ).withColumn("pass_rate", L.ratio(F.col("passed"), F.col("students")))


def avg_engagement_score(t: Tables) -> DataFrame:
    """Mean daily clicks over the largest single click count.

    The measure names a column no model has; the weekly maximum is the one it can mean.
    """
    mean = L.ratio(F.sum("total_clicks"), F.count("total_clicks"))
    top = t["fact_engagement_summary"].select(F.max("max_daily_clicks")).scalar()
    return t["fact_student_interaction"].agg(mean.alias("avg_clicks")).select(
        "avg_clicks", top.alias("max_clicks"),
        L.ratio(F.col("avg_clicks"), top).alias("engagement_score"))


def dropout_signal(t: Tables) -> DataFrame:
    """Enrolments with few active days and a low completion rate.

    The completion rate lives in the performance report, so the whole measure is taken there.
    """
    low = (F.col("total_active_days") < LOW_ACTIVE_DAYS) & (
        F.col("assessment_completion_rate") < LOW_COMPLETION)
    return t["rpt_student_performance"].agg(F.count_if(low).alias("dropout_signals"))


def students_by_result(t: Tables) -> DataFrame:
    return t["dim_student"].groupBy("final_result").agg(
        F.count(F.lit(1)).alias("enrolments"), F.count_distinct("id_student").alias("students"))


def previous_attempts(t: Tables) -> DataFrame:
    return t["dim_student"].groupBy("num_of_prev_attempts").agg(
        F.count(F.lit(1)).alias("enrolments"))


def student_slices(t: Tables) -> DataFrame:
    """Enrolments by the slicer fields."""
    region = t["silver_student_info"].select(*ENROLMENT, "region")
    return t["dim_student"].join(region.hint("merge"), ENROLMENT, "left").groupBy(
        "gender", "age_band", "region").agg(F.count(F.lit(1)).alias("enrolments"))


def results_by_module(t: Tables) -> DataFrame:
    """One row per module, one column per outcome; the outcomes are listed, so no extra pass."""
    return t["dim_student"].groupBy("code_module").pivot("final_result", FINAL_RESULTS).agg(
        F.count(F.lit(1))).na.fill(0, FINAL_RESULTS)


def presentation_comparison(t: Tables) -> DataFrame:
    passed = F.count_if(F.col("final_result").isin("Pass", "Distinction"))
    return t["dim_student"].groupBy(*OFFERING).agg(
        F.count(F.lit(1)).alias("enrolments"), passed.alias("passed"),
    ).withColumn("pass_rate", L.ratio(F.col("passed"), F.col("enrolments")))


def score_by_assessment_type(t: Tables) -> DataFrame:
    return t["fact_student_assessment"].groupBy("assessment_type").agg(
        L.exact_mean(F.col("score")).alias("avg_score"), F.count("score").alias("scored"))


def daily_clicks(t: Tables) -> DataFrame:
    return t["fact_student_interaction"].groupBy("date").agg(
        F.sum("total_clicks").alias("total_clicks"),
        F.count(F.lit(1)).alias("active_enrolments"))


def clicks_by_activity(t: Tables) -> DataFrame:
    return t["silver_student_vle"].groupBy("activity_type", "activity_category").agg(
        F.sum("sum_click").alias("total_clicks"))


def active_days_by_result(t: Tables) -> DataFrame:
    """Active days per enrolment against its outcome."""
    days = t["fact_engagement_summary"].groupBy(*ENROLMENT).agg(
        F.sum("active_days").alias("active_days"))
    return t["dim_student"].select(*ENROLMENT, "final_result").join(days.hint("merge"), ENROLMENT).select(
        *ENROLMENT, "final_result", "active_days")


def weekly_clicks_by_result(t: Tables) -> DataFrame:
    """Mean weekly clicks of withdrawn against passing enrolments."""
    outcome = t["dim_student"].filter(F.col("final_result").isin("Withdrawn", "Pass")).select(
        *ENROLMENT, "final_result")
    weekly = t["fact_engagement_summary"].select(*ENROLMENT, "week_number", "total_clicks")
    return weekly.join(outcome.hint("merge"), ENROLMENT).groupBy("final_result", "week_number").agg(
        L.ratio(F.sum("total_clicks"), F.count("total_clicks")).alias("avg_clicks"),
        F.count(F.lit(1)).alias("enrolments"))


def score_trajectory(t: Tables) -> DataFrame:
    """Scores of a student in order of submission, with the change against the previous one.

    Numbered in two steps: within each (student, day), and over the days of a student, so a
    student holding much of the table is spread over the days instead of sorted in one task.
    """
    scored = t["fact_student_assessment"].filter("score is not null").select(
        "id_student", "id_assessment", "date_submitted", "score")
    by_day = Window.partitionBy("id_student", "date_submitted").orderBy("id_assessment")
    days = scored.groupBy(
        F.col("id_student").alias("_student"), F.col("date_submitted").alias("_day"),
    ).agg(F.count(F.lit(1)).alias("_n"), F.max_by("score", "id_assessment").alias("_last"))
    earlier = Window.partitionBy("_student").orderBy("_day")
    counted = earlier.rowsBetween(Window.unboundedPreceding, -1)
    days = days.select(
        "_student", "_day", F.coalesce(F.sum("_n").over(counted), F.lit(0)).alias("_before"),
        F.lag("_last").over(earlier).alias("_last"))
    same = F.col("id_student").eqNullSafe(F.col("_student")) & F.col(
        "date_submitted").eqNullSafe(F.col("_day"))
    previous = F.coalesce("_previous", "_last")
    return scored.withColumns({
        "_row": F.row_number().over(by_day), "_previous": F.lag("score").over(by_day),
    }).join(days.hint("merge"), same).select(
        "id_student", "id_assessment", "date_submitted", "score",
        (F.col("_before") + F.col("_row")).alias("attempt_no"),
        (F.col("score") - previous).alias("score_change"))


def interaction_drop_off(t: Tables, share: float = DROP_OFF) -> DataFrame:
    """Weeks in which an enrolment's clicks fell below a share of its previous active week.

    The window runs over the weekly grain: one row per week of an enrolment.
    """
    order = Window.partitionBy(*ENROLMENT).orderBy("week_number")
    return t["fact_engagement_summary"].select(
        *ENROLMENT, "week_number", "total_clicks",
        F.lag("total_clicks").over(order).alias("previous_clicks"),
    ).filter(F.col("total_clicks") < F.col("previous_clicks") * share)
