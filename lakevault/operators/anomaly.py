"""Statistical and temporal anomaly detectors.

Global statistics are one-row aggregations read back as scalar subqueries: the flagged rows come
from a plain filter over the scan, no row is shuffled for them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakevault.functions import one_decimal
from lakevault.operators.quantiles import exact_quantiles

# Default thresholds.
DAILY_MAX = 5000
Z_LIMIT = 3.0
IQR_FACTOR = 1.5
REGISTRATION_WINDOW = (-365, 0)
MIN_EXAM_CLICKS = 10

# Days of a student that are swept in one go.
SWEEP_DAYS = 256

OFFERING = ["code_module", "code_presentation"]
ENROLMENT = ["id_student", *OFFERING]


def _z(value: Column, mean: Column, std: Column) -> Column:
    """Absolute z-score, NULL when there is no spread."""
    return F.abs(value - mean) / F.nullif(std, F.lit(0.0))


def _flag_clicks(scored: DataFrame, daily_max: int, z_limit: float, detected_at: datetime,
                 ) -> DataFrame:
    over_cap = F.col("sum_click") > daily_max
    return (
        scored.filter(over_cap | (F.col("_z") > z_limit))
        .withColumns({
            "anomaly_reason": F.when(over_cap, f"exceeds_daily_max_{daily_max}")
            .otherwise(f"z_score_exceeds_{z_limit}"),
            "anomaly_score": F.when(over_cap, F.col("sum_click") / F.lit(float(daily_max)))
            .otherwise(F.col("_z")),
            "detected_at": F.lit(detected_at).cast("timestamp"),
        })
        .drop("_z")
    )


def click_anomalies(df: DataFrame, detected_at: datetime, daily_max: int | None = None,
                    z_limit: float | None = None, config: Mapping | None = None) -> DataFrame:
    """Click rows above the daily cap or beyond the z limit over the whole table.

    Arguments win over ``config`` (``{"click_threshold": {"daily_max", "z_score"}}``), which wins
    over the defaults. A missing count enters the statistics as 0. A frame without the column
    gives no rows.
    """
    if "sum_click" not in df.columns:
        return df.limit(0)
    limits = (config or {}).get("click_threshold", {})
    daily_max = daily_max or limits.get("daily_max", DAILY_MAX)
    z_limit = z_limit or limits.get("z_score", Z_LIMIT)
    clicks = F.coalesce("sum_click", F.lit(0))
    stats = df.agg(F.avg(clicks).alias("m"), F.stddev_pop(clicks).alias("s"))
    scored = df.withColumn("_stats", stats.select(F.struct("m", "s")).scalar()).withColumn(
        "_z", _z(clicks, F.col("_stats.m"), F.col("_stats.s"))).drop("_stats")
    return _flag_clicks(scored, daily_max, z_limit, detected_at)


def click_anomalies_per_course(df: DataFrame, detected_at: datetime, daily_max: int | None = None,
                               z_limit: float | None = None, config: Mapping | None = None
                               ) -> DataFrame:
    """As :func:`click_anomalies`, with mean and spread per offering.

    Statistics are aggregated and joined back instead of a window, which would bring all rows of
    one offering into one task. Adaptive execution broadcasts the few statistic rows when their
    measured size allows it and splits hot offerings otherwise.
    """
    limits = (config or {}).get("click_threshold", {})
    daily_max = daily_max or limits.get("daily_max", DAILY_MAX)
    z_limit = z_limit or limits.get("z_score", Z_LIMIT)
    clicks = F.coalesce("sum_click", F.lit(0))
    stats = df.groupBy(*[F.col(c).alias(f"_{c}") for c in OFFERING]).agg(
        F.avg(clicks).alias("_m"), F.stddev_pop(clicks).alias("_s"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in OFFERING]
    scored = df.join(stats, same, "inner").withColumn("_z", _z(clicks, F.col("_m"), F.col("_s")))
    return _flag_clicks(scored.select(*df.columns, "_z"), daily_max, z_limit, detected_at)


def score_anomalies(df: DataFrame, detected_at: datetime, z_limit: float | None = None,
                    iqr_factor: float | None = None, config: Mapping | None = None) -> DataFrame:
    """Scores beyond the z limit or outside the quartile fences; the z reason comes first.

    The z-score counts a missing score as 0, the fences ignore it; so a missing score can be
    flagged by its z-score.
    """
    if "score" not in df.columns:
        return df.limit(0)
    limits = (config or {}).get("assessment_score", {})
    z_limit = z_limit or limits.get("z_score", Z_LIMIT)
    iqr_factor = iqr_factor or limits.get("iqr_multiplier", IQR_FACTOR)
    filled = F.coalesce("score", F.lit(0.0))
    stats = df.agg(F.avg(filled).alias("m"), F.stddev_pop(filled).alias("s"))
    # a row of its own, so that the statistics are derived once and not in each use
    scored = df.select("*", F.inline(F.array(F.struct(
        stats.select(F.struct("m", "s")).scalar().alias("_stats"),
        exact_quantiles(df, "score", [0.25, 0.75]).alias("_q")))))
    spread = (F.col("_q.q1") - F.col("_q.q0")) * iqr_factor
    scored = scored.withColumns({
        "_z": _z(filled, F.col("_stats.m"), F.col("_stats.s")),
        "_low": F.col("_q.q0") - spread, "_high": F.col("_q.q1") + spread,
    })
    by_z = F.col("_z") > z_limit
    above, below = F.col("score") > F.col("_high"), F.col("score") < F.col("_low")
    reason = (
        F.when(by_z, f"z_score_exceeds_{z_limit}")
        .when(above, F.concat(F.lit("above_upper_fence_"), one_decimal(F.col("_high"))))
        .when(below, F.concat(F.lit("below_lower_fence_"), one_decimal(F.col("_low"))))
    )
    return scored.withColumns({
        "anomaly_reason": reason, "detected_at": F.lit(detected_at).cast("timestamp"),
    }).filter("anomaly_reason is not null").drop(
        "_stats", "_q", "_z", "_low", "_high")


def vle_before_registration(clicks: DataFrame, registrations: DataFrame) -> DataFrame:
    """Clicks dated before the student registered for the offering."""
    reg = registrations.select(*ENROLMENT, "date_registration")
    return clicks.join(reg.hint("merge"), ENROLMENT).filter("date < date_registration").withColumn(
        "anomaly_reason", F.lit("vle_before_registration"))


def assessment_before_registration(submissions: DataFrame, registrations: DataFrame) -> DataFrame:
    """Submissions dated before a registration of the same student, in any offering.

    Matched on the student alone, as the reference semantics have it: one row per submission and
    later registration, so students with several courses give false positives; see the strict
    variant. A student has at most one registration per offering, which bounds the matches of a
    submission; to count without forming the rows use :func:`assessment_before_counts`.
    """
    reg = registrations.select(*ENROLMENT, "date_registration")
    return submissions.join(
        reg.hint("merge"), (submissions["id_student"] == reg["id_student"])
        & (submissions["date_submitted"] < reg["date_registration"]),
    ).drop(reg["id_student"]).withColumn(
        "anomaly_reason", F.lit("assessment_before_registration"))


def assessment_before_counts(submissions: DataFrame, registrations: DataFrame) -> DataFrame:
    """Number of rows of :func:`assessment_before_registration`, without forming them.

    A sweep over each student's days: submissions and registrations become one row per student and
    day, and going back in time a submission meets the registrations counted so far. The sweep is
    split into blocks of ``SWEEP_DAYS``: inside a block day by day, between blocks by their totals, so
    no student's days meet in one sort, however many they are.
    """
    def told(df: DataFrame, day: str, name: str, other: str) -> DataFrame:
        return df.select("id_student", F.col(day).cast("long").alias("day"),
                         F.lit(1).alias(name), F.lit(0).alias(other))

    days = told(submissions, "date_submitted", "a", "b").unionByName(
        told(registrations, "date_registration", "b", "a")).dropna().groupBy(
        "id_student", "day").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).withColumn(
        "block", F.floor(F.col("day") / SWEEP_DAYS))

    def later(by: list[str], order: str) -> Column:
        over = Window.partitionBy(*by).orderBy(F.desc(order))
        return F.coalesce(F.sum("b").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    blocks = days.withColumn("inside", F.col("a") * later(["id_student", "block"], "day")).groupBy(
        "id_student", "block").agg(F.sum("inside").alias("inside"), F.sum("a").alias("a"),
                                   F.sum("b").alias("b"))
    pairs = blocks.select((F.col("inside") + F.col("a") * later(["id_student"], "block")).alias("n"))
    return pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"))


def assessment_before_registration_strict(submissions: DataFrame, assessments: DataFrame,
                                          registrations: DataFrame) -> DataFrame:
    """Submissions dated before the registration for the assessment's own offering."""
    offering = assessments.select("id_assessment", *OFFERING)
    reg = registrations.select(*ENROLMENT, "date_registration")
    return (
        submissions.join(offering.hint("merge"), "id_assessment").join(reg.hint("merge"), ENROLMENT)
        .filter("date_submitted < date_registration")
        .withColumn("anomaly_reason", F.lit("assessment_before_registration"))
    )


def activity_after_unregistration(clicks: DataFrame, registrations: DataFrame) -> DataFrame:
    """Clicks dated after the student left the offering (day 0 means never left)."""
    left = registrations.filter("date_unregistration <> 0").select(
        *ENROLMENT, "date_unregistration")
    return clicks.join(left.hint("merge"), ENROLMENT).filter("date > date_unregistration").withColumn(
        "anomaly_reason", F.lit("activity_after_unregistration"))


def zero_activity_exam(submissions: DataFrame, assessments: DataFrame, clicks: DataFrame,
                       min_clicks: int = MIN_EXAM_CLICKS) -> DataFrame:
    """Exam submissions of students with fewer than ``min_clicks`` clicks in that offering."""
    exams = assessments.filter("assessment_type = 'Exam'").select("id_assessment", *OFFERING)
    totals = clicks.groupBy(*ENROLMENT).agg(F.sum("sum_click").alias("total_clicks"))
    return (
        submissions.filter("score is not null")
        .join(exams.hint("merge"), "id_assessment")
        .join(totals.hint("merge"), ENROLMENT, "left")
        .withColumn("total_clicks", F.coalesce("total_clicks", F.lit(0)))
        .filter(F.col("total_clicks") < min_clicks)
        .select(*submissions.columns, *OFFERING, "total_clicks")
        .withColumn("anomaly_reason", F.lit("zero_activity_exam"))
    )


def outside_registration_window(registrations: DataFrame,
                                window: tuple[int, int] | None = None,
                                config: Mapping | None = None) -> DataFrame:
    """Registrations outside the expected day range."""
    limits = (config or {}).get("registration_window", {})
    low, high = window or (limits.get("min", REGISTRATION_WINDOW[0]),
                           limits.get("max", REGISTRATION_WINDOW[1]))
    return registrations.filter(~F.col("date_registration").between(low, high)).withColumn(
        "anomaly_reason", F.lit("registration_outside_window"))


def as_flags(flagged: DataFrame, table: str, anomaly_type: str, keys: Sequence[str],
             detected_at: datetime) -> DataFrame:
    """Flagged rows of one detector in the common flag layout; ``keys`` become a JSON text."""
    score = F.col("anomaly_score") if "anomaly_score" in flagged.columns \
        else F.lit(None).cast("double")
    return flagged.select(
        F.lit(table).alias("table_name"), F.lit(anomaly_type).alias("anomaly_type"),
        F.to_json(F.struct(*keys)).alias("keys"), F.col("anomaly_reason").alias("reason"),
        score.alias("score"), F.lit(detected_at).cast("timestamp").alias("detected_at"),
    )


def detect_all(detected_at: datetime, clicks: DataFrame | None = None,
               submissions: DataFrame | None = None, registrations: DataFrame | None = None,
               config: Mapping | None = None) -> DataFrame:
    """All flags of the detectors whose inputs are given, in the common layout.

    Temporal checks need all three inputs. Append the result to the anomaly-flag table.
    """
    parts = []
    if clicks is not None:
        parts.append(as_flags(click_anomalies(clicks, detected_at, config=config), "student_vle",
                              "click_outlier", ["id_student", "id_site", "date"], detected_at))
    if submissions is not None:
        parts.append(as_flags(
            score_anomalies(submissions, detected_at, config=config), "student_assessment",
            "score_outlier", ["id_assessment", "id_student"], detected_at))
    if clicks is not None and submissions is not None and registrations is not None:
        parts.append(as_flags(
            vle_before_registration(clicks, registrations), "student_vle",
            "vle_before_registration", ["id_student", "id_site", "date"], detected_at))
        parts.append(as_flags(
            assessment_before_registration(submissions, registrations), "student_assessment",
            "assessment_before_registration",
            ["id_assessment", "id_student", *OFFERING], detected_at))
    if not parts:
        raise ValueError("no input given")
    return reduce(DataFrame.unionByName, parts)


def _count(df: DataFrame, anomaly_type: str, in_total: bool) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count")).select(
        F.lit(anomaly_type).alias("anomaly_type"), "count", F.lit(in_total).alias("in_total"))


def summary(detected_at: datetime, clicks: DataFrame, submissions: DataFrame,
            registrations: DataFrame, config: Mapping | None = None) -> DataFrame:
    """Flag counts per detector; ``in_total`` marks the ones the overall total includes.

    The reference total leaves the temporal checks out; :func:`total` reproduces it. The
    many-to-many check is counted without forming its rows.
    """
    parts = [
        _count(click_anomalies(clicks, detected_at, config=config), "click_outlier", True),
        _count(score_anomalies(submissions, detected_at, config=config), "score_outlier", True),
        _count(vle_before_registration(clicks, registrations), "vle_before_registration", False),
        assessment_before_counts(submissions, registrations).select(
            F.lit("assessment_before_registration").alias("anomaly_type"), "count",
            F.lit(False).alias("in_total")),
    ]
    return reduce(DataFrame.unionByName, parts)


# Detectors, and whether the overall total includes them.
IN_TOTAL = {"click_outlier": True, "score_outlier": True, "vle_before_registration": False,
            "assessment_before_registration": False}


def count_flags(flags: DataFrame) -> DataFrame:
    """The :func:`summary` of flags that are stored already; detectors without a flag count 0."""
    known = F.explode(F.array(*[F.struct(
        F.lit(k).alias("anomaly_type"), F.lit(v).alias("in_total")) for k, v in IN_TOTAL.items()]))
    names = flags.sparkSession.range(1).select(known.alias("x")).select("x.*")
    counts = flags.groupBy("anomaly_type").agg(F.count(F.lit(1)).alias("count"))
    return names.join(counts, "anomaly_type", "left").select(
        "anomaly_type", F.coalesce("count", F.lit(0)).alias("count"), "in_total")


def total(counts: DataFrame) -> DataFrame:
    """Overall number of anomalies of a :func:`summary`."""
    included = F.when(F.col("in_total"), F.col("count"))
    return counts.agg(F.coalesce(F.sum(included), F.lit(0)).alias("anomalies_found"))


def samples(flags: DataFrame, per_type: int = 20) -> DataFrame:
    """The first flagged rows of each type in key order, for a report.

    One bounded top-n per type; no type is sorted as a whole.
    """
    types = ["click_outlier", "score_outlier"]
    parts = [
        flags.filter(F.col("anomaly_type") == kind).orderBy("keys", "reason").limit(per_type)
        for kind in types
    ]
    return reduce(DataFrame.unionByName, parts)
