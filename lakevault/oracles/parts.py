"""Named subqueries shared by the oracle statements and the assembly of a full statement.

A name may carry a load suffix: ``hub_student`` is the ordinary single load, ``hub_student_1``
and ``hub_student_2`` belong to the two-load scenario. In the templates ``@`` stands for it.
"""

from __future__ import annotations

import re

TS = "TIMESTAMP '2024-01-01 05:00:00'"
TS2 = "TIMESTAMP '2024-01-02 05:00:00'"
CUT = "DATE '2000-01-01'"

ENROLMENT = "id_student, code_module, code_presentation"


def key(*cols: str) -> str:
    """Hash key: NULL as soon as one part is NULL (``||`` keeps NULL)."""
    return "sha256(" + " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in cols) + ")"


def diff(*cols: str) -> str:
    return "sha256(" + " || '|' || ".join(
        f"COALESCE(CAST({c} AS VARCHAR), '')" for c in cols) + ")"


def dec(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(28,12))"


def rnd(expr: str, digits: int) -> str:
    return f"CAST(round({dec(expr)}, {digits}) AS DOUBLE)"


def mean(expr: str) -> str:
    return f"CAST(sum({dec(expr)}) AS DOUBLE) / nullif(count({expr}), 0)"


def total(expr: str) -> str:
    return f"CAST(sum({expr}) AS BIGINT)"


def percent(passed: str, evaluated: str) -> str:
    """100 * passed / evaluated, half-up to two decimals, in whole numbers."""
    return (f"CAST(COALESCE(((20000 * ({passed}) + ({evaluated})) // nullif(2 * ({evaluated}), 0)) "
            f"/ 100.0, 0) AS DECIMAL(5,2))")


# Activity types by category, start months, classes and activity types.
CATEGORY = """CASE
  WHEN activity_type IN ('forumng', 'glossary') THEN 'communication'
  WHEN activity_type IN ('oucontent', 'htmlactivity', 'page', 'subpage') THEN 'content'
  WHEN activity_type IN ('quiz', 'externalquiz', 'questionnaire') THEN 'assessment'
  WHEN activity_type IN ('resource', 'url', 'folder', 'sharedsubpage') THEN 'reference'
  WHEN activity_type IN ('homepage', 'dataplus', 'dualpane', 'repeatactivity') THEN 'tool'
  ELSE 'other' END"""
START = """CASE right(code_presentation, 1)
  WHEN 'B' THEN 'February' WHEN 'J' THEN 'October' ELSE 'Unknown' END"""
TIMING = """CASE WHEN date_registration < 0 THEN 'early'
  WHEN date_registration = 0 THEN 'on_time' ELSE 'late' END"""
RESULT = """CASE WHEN score IS NULL THEN 'not_submitted'
  WHEN score >= 40 THEN 'passed' ELSE 'failed' END"""
ACTIVITIES = ("['forumng','oucontent','homepage','resource','url','quiz','htmlactivity',"
              "'glossary','dataplus','questionnaire','repeatactivity','externalquiz','dualpane',"
              "'folder','sharedsubpage','page','subpage','oucollaborate','ouwiki','ouelluminate',"
              "'mystery']")
REGISTERED = """
  date_diff('day', pres_start, order_day) - 100 AS date_registration,
  CASE o_orderstatus
    WHEN 'F' THEN CAST(date_diff('day', pres_start, order_day) - 100 + o_orderkey % 90 AS DOUBLE)
    WHEN 'P' THEN 0.0::DOUBLE END AS date_unregistration"""


def lineage(source: str) -> str:
    return f"{TS} AS _ingested_at, '{source}.csv' AS _source_file"


# Base tables. {filter}, {weight} and {band} differ between the loads.
BASE = {
    "off@": """
  SELECT o_custkey AS id_student,
    'M' || left(o_orderpriority, 1) AS code_module,
    year(o_orderdate) || substr('BJK', 1 + (month(o_orderdate) - 1) // 4, 1) AS code_presentation,
    CAST(left(o_orderpriority, 1) AS BIGINT) * 100 + (year(o_orderdate) - 1995) * 3
      + (month(o_orderdate) - 1) // 4 AS offering_no,
    make_date(year(o_orderdate), 1 + 4 * ((month(o_orderdate) - 1) // 4), 1) AS pres_start,
    CAST(o_orderdate AS DATE) AS order_day, o_orderkey, o_orderstatus
  FROM orders {filter}""",
    "courses@": f"""
  SELECT DISTINCT code_module, code_presentation,
    CAST(CASE WHEN offering_no % 37 = 0 THEN 0 ELSE 200 + offering_no % 70 END AS BIGINT) AS length,
    {lineage("courses")}
  FROM off@""",
    "registration_dup@": f"""
  SELECT {ENROLMENT}, {REGISTERED}, o_orderkey FROM off@""",
    "first_orders@": f"""
  SELECT * FROM off@
  QUALIFY row_number() OVER (PARTITION BY {ENROLMENT} ORDER BY o_orderkey) = 1""",
    "student_registration@": f"""
  SELECT code_module, code_presentation, id_student, {REGISTERED},
    {lineage("studentRegistration")}
  FROM first_orders@""",
    "student_info_named@": """
  SELECT code_module, code_presentation,
    CASE WHEN o_orderkey % 53 = 0 OR id_student % 211 = 0 THEN -id_student
      ELSE id_student END AS id_student,
    CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS gender,
    n_name AS region, 'L' || n_regionkey AS highest_education,
    CASE WHEN c_acctbal < 0 THEN '?' ELSE c_mktsegment END AS imd_band,
    CASE WHEN c_acctbal < 3000 THEN '0-35' WHEN c_acctbal < 7000 THEN '35-55'
      ELSE '55<=' END AS age_band,
    o_orderkey % 4 AS num_of_prev_attempts,
    CAST(30 * (1 + c_nationkey % 6) AS BIGINT) AS studied_credits,
    CASE c_custkey % 10 WHEN 0 THEN 'Y' ELSE 'N' END AS disability,
    CASE WHEN o_orderkey % 97 = 0 THEN 'Deferred' WHEN o_orderstatus = 'F' THEN 'Withdrawn'
      WHEN o_orderstatus = 'P' THEN 'Fail' WHEN o_orderkey % 5 = 0 THEN 'Distinction'
      ELSE 'Pass' END AS final_result
  FROM first_orders@ JOIN customer ON c_custkey = id_student
  JOIN nation ON n_nationkey = c_nationkey""",
    "student_info@": f"""
  SELECT * REPLACE (left(sha256(region), 16) AS region, {{band}} AS imd_band),
    {lineage("studentInfo")}
  FROM student_info_named@""",
    "assessments@": f"""
  SELECT 'M' || (p_partkey % 5 + 1) AS code_module,
    (1995 + p_partkey % 7) || substr('BJK', 1 + p_size % 3, 1) AS code_presentation,
    CASE WHEN p_partkey % 41 = 0 THEN -p_partkey ELSE p_partkey END AS id_assessment,
    CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'TMA' WHEN p_type IN ('MEDIUM', 'STANDARD')
      THEN 'CMA' WHEN p_type = 'LARGE' THEN 'Exam' ELSE 'Quiz' END AS assessment_type,
    CAST(p_size * 5 AS BIGINT) AS date, {{weight}} AS weight,
    {lineage("assessments")}
  FROM part""",
    "vle@": f"""
  SELECT CASE WHEN s_suppkey % 29 = 0 THEN -1 ELSE 1 END
      * (s_suppkey * 1000 + (1 + slot // 21) * 100 + slot % 21) AS id_site,
    'M' || (1 + slot // 21) AS code_module,
    (1995 + slot % 21 // 3) || substr('BJK', 1 + CAST(slot % 3 AS INTEGER), 1) AS code_presentation,
    ({ACTIVITIES})[1 + s_suppkey % 21] AS activity_type,
    CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey % 30 END AS week_from,
    CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey % 30 + 1 END AS week_to,
    {lineage("vle")}
  FROM (SELECT s_suppkey, unnest(range(105)) AS slot FROM supplier)""",
    "lines@": """
  SELECT lineitem.*, off@.* FROM lineitem JOIN off@ ON l_orderkey = o_orderkey""",
    "student_assessment_dup@": """
  SELECT l_partkey AS id_assessment, id_student,
    abs(date_diff('day', pres_start, CAST(l_shipdate AS DATE))) % 300 - 20 AS date_submitted,
    CAST(CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END AS BIGINT) AS is_banked,
    CASE WHEN l_linenumber <> 7 THEN l_quantity * 2.1::DOUBLE END AS score,
    l_orderkey, l_linenumber, l_suppkey, l_extendedprice
  FROM lines@""",
    "student_assessment@": f"""
  SELECT id_assessment, id_student, date_submitted, is_banked, score,
    {lineage("studentAssessment")}
  FROM student_assessment_dup@
  QUALIFY row_number() OVER (PARTITION BY id_assessment, id_student
    ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) = 1""",
    "student_vle@": f"""
  SELECT code_module, code_presentation, id_student,
    l_suppkey * 1000 + offering_no AS id_site,
    abs(date_diff('day', pres_start, CAST(l_shipdate AS DATE))) % 300 - 30 AS date,
    CAST(CASE WHEN l_orderkey % 500 = 0 AND l_linenumber = 1 THEN l_quantity * 150
      WHEN l_orderkey % 701 = 0 THEN -1 ELSE l_quantity END AS BIGINT) AS sum_click,
    {lineage("studentVle")}
  FROM (SELECT *, unnest(CASE WHEN l_orderkey % 250 = 0 THEN [1, 2] ELSE [1] END) FROM lines@)""",
}

BRONZE = {
    "bronze_courses@": "SELECT * FROM courses@ WHERE length > 0",
    "bronze_assessments@": "SELECT * FROM assessments@",
    "bronze_vle@": "SELECT * FROM vle@",
    "bronze_student_info@": """
  SELECT * FROM student_info@
  WHERE final_result IN ('Pass', 'Fail', 'Withdrawn', 'Distinction')""",
    "bronze_student_registration@": """
  SELECT *, date_unregistration IS NOT NULL AND date_unregistration <> 0 AS has_unregistered
  FROM student_registration@""",
    "bronze_student_assessment@": """
  SELECT * FROM student_assessment@ WHERE score IS NULL OR score BETWEEN 0 AND 100""",
    "bronze_student_vle@": "SELECT * FROM student_vle@ WHERE sum_click >= 0",
}

SILVER = {
    "silver_courses": f"""
  SELECT code_module, code_presentation, length, {START} AS presentation_start, _ingested_at
  FROM bronze_courses""",
    "silver_assessments": f"""
  SELECT id_assessment, a.code_module, a.code_presentation, assessment_type,
    date AS deadline_day, weight, length AS module_length,
    {rnd('''weight / nullif(sum(weight) OVER (
      PARTITION BY a.code_module, a.code_presentation), 0)''', 4)} AS weight_pct
  FROM bronze_assessments a LEFT JOIN bronze_courses c USING (code_module, code_presentation)""",
    "silver_vle": f"""
  SELECT id_site, code_module, code_presentation, activity_type, week_from, week_to,
    {CATEGORY} AS activity_category
  FROM bronze_vle""",
    "silver_student_info": """
  SELECT * EXCLUDE (_source_file) REPLACE (sha256(region) AS region, sha256(imd_band) AS imd_band)
  FROM bronze_student_info""",
    "silver_student_registration": f"""
  SELECT id_student, code_module, code_presentation, date_registration,
    nullif(date_unregistration, 0) AS date_unregistration, has_unregistered,
    {TIMING} AS registration_timing
  FROM bronze_student_registration""",
    "silver_student_assessment": f"""
  SELECT id_assessment, id_student, date_submitted, is_banked, score, assessment_type,
    deadline_day, weight, {RESULT} AS assessment_result,
    date_submitted - deadline_day AS submission_delay_days
  FROM bronze_student_assessment LEFT JOIN silver_assessments USING (id_assessment)""",
    "silver_student_vle": """
  SELECT id_student, code_module, code_presentation, id_site, date, sum_click, activity_type,
    activity_category, week_from, week_to
  FROM bronze_student_vle LEFT JOIN silver_vle USING (id_site, code_module, code_presentation)""",
}


def weekly(source: str, group: str, site: str) -> str:
    return f"""
  SELECT {group}, CAST(floor(date / 7.0) AS BIGINT) AS week_number,
    count(DISTINCT date) AS active_days, {total("sum_click")} AS total_clicks,
    CAST(sum(sum_click) AS DOUBLE) / nullif(count(sum_click), 0) AS avg_daily_clicks,
    count(DISTINCT {site}) AS unique_resources,
    count(DISTINCT activity_type) AS unique_activity_types, max(sum_click) AS max_daily_clicks
  FROM {source} GROUP BY ALL"""


def daily(source: str, group: str, site: str) -> str:
    return f"""
  SELECT {group}, date, {total("sum_click")} AS total_clicks,
    count(DISTINCT {site}) AS unique_resources,
    count(DISTINCT activity_type) AS unique_activity_types
  FROM {source} GROUP BY ALL"""


GOLD = {
    "dim_student": f"""
  SELECT DISTINCT {ENROLMENT}, gender, age_band, highest_education, disability,
    num_of_prev_attempts, studied_credits, final_result, date_registration, date_unregistration,
    has_unregistered, registration_timing, _ingested_at
  FROM silver_student_registration LEFT JOIN silver_student_info USING ({ENROLMENT})""",
    "dim_course": """
  SELECT c.code_module, c.code_presentation, length, presentation_start, assessment_count,
    total_weight
  FROM silver_courses c LEFT JOIN (
    SELECT code_module, code_presentation, count(DISTINCT id_assessment) AS assessment_count,
      sum(weight) AS total_weight
    FROM silver_assessments GROUP BY ALL) USING (code_module, code_presentation)""",
    "fact_student_interaction": daily("silver_student_vle", ENROLMENT, "id_site"),
    "fact_engagement_summary": weekly("silver_student_vle", ENROLMENT, "id_site"),
    "fact_student_assessment": """
  SELECT id_student, id_assessment, date_submitted, score, is_banked, assessment_type,
    assessment_result, submission_delay_days, weight
  FROM silver_student_assessment""",
    "rpt_student_performance": f"""
  SELECT {ENROLMENT}, final_result, gender, age_band, disability, num_of_prev_attempts,
    registration_timing, has_unregistered,
    COALESCE(clicks, 0) AS lifetime_clicks, COALESCE(days, 0) AS total_active_days,
    COALESCE(weeks, 0) AS active_weeks, COALESCE(score, 0) AS avg_score,
    COALESCE(taken, 0) AS assessments_taken, COALESCE(passed, 0) AS assessments_passed,
    CASE WHEN days = 0 THEN 0 ELSE {rnd("CAST(passed AS DOUBLE) / nullif(taken, 0)", 2)}
      END AS assessment_completion_rate,
    COALESCE(final_result = 'Withdrawn' AND clicks < 100, FALSE) AS early_dropout_flag
  FROM dim_student
  LEFT JOIN (SELECT {ENROLMENT}, {total("total_clicks")} AS clicks, {total("active_days")} AS days,
      count(DISTINCT week_number) AS weeks
    FROM fact_engagement_summary GROUP BY ALL) USING ({ENROLMENT})
  LEFT JOIN (SELECT id_student, {mean("score")} AS score, count(id_assessment) AS taken,
      count(*) FILTER (assessment_result = 'passed') AS passed
    FROM fact_student_assessment GROUP BY ALL) USING (id_student)""",
}

OFFERING_KEY = key("code_module", "code_presentation")


def hub(hk: str, source: str, *cols: str) -> str:
    return (f"SELECT DISTINCT {key(*cols)} AS {hk}, {', '.join(cols)}, {{ts}} AS dv_load_date, "
            f"'OULAD' AS dv_source FROM {source}")


def link(hk: str, source: str, **hubs: tuple[str, ...]) -> str:
    cols = [c for group in hubs.values() for c in group]
    parts = ", ".join(f"{key(*group)} AS {name}" for name, group in hubs.items())
    return (f"SELECT DISTINCT {key(*cols)} AS {hk}, {parts}, {{ts}} AS dv_load_date, "
            f"'OULAD' AS dv_source FROM {source}")


def sat(hk: str, hk_cols: tuple[str, ...], source: str, tracked: tuple[str, ...],
        shown: str | None = None) -> str:
    return (f"SELECT DISTINCT {key(*hk_cols)} AS {hk}, {diff(*tracked)} AS hk_hashdiff, "
            f"{shown or ', '.join(tracked)}, {{ts}} AS dv_load_date, 'OULAD' AS dv_source "
            f"FROM {source}")


_OFF = ("code_module", "code_presentation")
VAULT = {
    "hub_student@": hub("hk_student", "bronze_student_registration@", "id_student"),
    "hub_course_offering@": hub("hk_course_offering", "bronze_courses@", *_OFF),
    "hub_assessment@": hub("hk_assessment", "bronze_assessments@", "id_assessment"),
    "hub_vle@": hub("hk_vle", "bronze_vle@", "id_site"),
    "link_student_enrollment@": link(
        "hk_student_enrollment", "bronze_student_registration@",
        hk_student=("id_student",), hk_course_offering=_OFF),
    "link_student_assessment@": link(
        "hk_student_assessment", "bronze_student_assessment@",
        hk_student=("id_student",), hk_assessment=("id_assessment",)),
    "link_course_offering_assessment@": link(
        "hk_course_offering_assessment", "bronze_assessments@",
        hk_assessment=("id_assessment",), hk_course_offering=_OFF),
    "link_course_offering_vle@": link(
        "hk_course_offering_vle", "bronze_vle@",
        hk_vle=("id_site",), hk_course_offering=_OFF),
    "sat_student_details@": sat(
        "hk_student", ("id_student",), "bronze_student_info@",
        ("gender", "age_band", "highest_education", "disability", "region", "imd_band",
         "studied_credits", "num_of_prev_attempts"),
        "gender, age_band, highest_education, disability, sha256(region) AS region_hashed, "
        "sha256(imd_band) AS imd_band_hashed, studied_credits, num_of_prev_attempts"),
    "enrolment_state@": f"""
  SELECT {ENROLMENT}, date_registration, nullif(date_unregistration, 0) AS date_unregistration,
    has_unregistered, COALESCE(final_result, 'Unknown') AS final_result,
    {TIMING} AS registration_timing
  FROM bronze_student_registration@
  LEFT JOIN bronze_student_info@ USING ({ENROLMENT})""",
    "sat_student_enrollment@": sat(
        "hk_student_enrollment", ("id_student", *_OFF), "enrolment_state@",
        ("date_registration", "date_unregistration", "has_unregistered", "final_result",
         "registration_timing")),
    "sat_course_offering_details@": sat(
        "hk_course_offering", _OFF,
        f"(SELECT *, {START} AS presentation_start FROM bronze_courses@)",
        ("length", "presentation_start")),
    "sat_assessment_details@": sat(
        "hk_assessment", ("id_assessment",),
        "(SELECT *, date AS deadline_day FROM bronze_assessments@)",
        ("assessment_type", "deadline_day", "weight")),
    "sat_student_assessment_result@": sat(
        "hk_student_assessment", ("id_student", "id_assessment"), "bronze_student_assessment@",
        ("date_submitted", "is_banked", "score")),
    "sat_vle_details@": sat(
        "hk_vle", ("id_site",), f"(SELECT *, {CATEGORY} AS activity_category FROM bronze_vle@)",
        ("activity_type", "activity_category", "week_from", "week_to")),
    "txn_student_vle_click@": f"""
  SELECT {key("id_student")} AS hk_student, {key("id_site")} AS hk_vle,
    {OFFERING_KEY} AS hk_course_offering, date, sum_click, {{ts}} AS dv_load_date,
    'OULAD' AS dv_source
  FROM bronze_student_vle@""",
}


def newest(table: str, hk: str) -> str:
    return (f"SELECT * FROM {table} QUALIFY row_number() OVER "
            f"(PARTITION BY {hk} ORDER BY dv_load_date DESC, hk_hashdiff) = 1")


def business(sfx: str, latest: bool) -> dict[str, str]:
    """Business views over the vault tables with the given suffix.

    ``latest`` picks the newest satellite rows, otherwise all versions are joined; the
    enrolment view always picks the newest.
    """
    def v(table: str, hk: str) -> str:
        return f"({newest(table + sfx, hk)})" if latest else table + sfx

    clicks = f"""(SELECT t.*, s.activity_type FROM txn_student_vle_click{sfx} t
    LEFT JOIN {v("sat_vle_details", "hk_vle")} s USING (hk_vle))"""
    group = "hk_student, hk_course_offering"
    return {
        f"bv_course_offering{sfx}": f"""
  SELECT h.hk_course_offering, code_module, code_presentation, length, presentation_start,
    assessment_types, assessment_count, total_weight
  FROM hub_course_offering{sfx} h
  LEFT JOIN {v("sat_course_offering_details", "hk_course_offering")} s USING (hk_course_offering)
  LEFT JOIN (
    SELECT hk_course_offering,
      string_agg(DISTINCT assessment_type, ', ' ORDER BY assessment_type) AS assessment_types,
      count(DISTINCT hk_assessment) AS assessment_count, sum(weight) AS total_weight
    FROM link_course_offering_assessment{sfx}
    LEFT JOIN {v("sat_assessment_details", "hk_assessment")} d USING (hk_assessment)
    GROUP BY ALL) a USING (hk_course_offering)""",
        f"bv_engagement_daily{sfx}": daily(clicks, group, "hk_vle"),
        f"bv_engagement_weekly{sfx}": weekly(clicks, group, "hk_vle"),
        f"bv_student_assessment{sfx}": f"""
  SELECT hk_student_assessment, hk_student, hk_assessment, id_student, id_assessment,
    date_submitted, is_banked, score, assessment_type, deadline_day, weight,
    {RESULT} AS assessment_result, date_submitted - deadline_day AS submission_delay_days
  FROM (SELECT hk_student_assessment, hk_student, hk_assessment FROM link_student_assessment{sfx})
  LEFT JOIN {v("sat_student_assessment_result", "hk_student_assessment")} r
    USING (hk_student_assessment)
  LEFT JOIN hub_student{sfx} USING (hk_student)
  LEFT JOIN hub_assessment{sfx} USING (hk_assessment)
  LEFT JOIN {v("sat_assessment_details", "hk_assessment")} d USING (hk_assessment)""",
        f"bv_student_enrollment{sfx}": f"""
  SELECT hk_student_enrollment, hk_student, hk_course_offering, id_student, code_module,
    code_presentation, gender, age_band, highest_education, disability, region_hashed,
    imd_band_hashed, studied_credits, num_of_prev_attempts, date_registration,
    date_unregistration, has_unregistered, final_result, registration_timing
  FROM (SELECT hk_student_enrollment, hk_student, hk_course_offering
    FROM link_student_enrollment{sfx})
  LEFT JOIN hub_student{sfx} USING (hk_student)
  LEFT JOIN hub_course_offering{sfx} USING (hk_course_offering)
  LEFT JOIN ({newest("sat_student_details" + sfx, "hk_student")}) sd USING (hk_student)
  LEFT JOIN ({newest("sat_student_enrollment" + sfx, "hk_student_enrollment")}) se
    USING (hk_student_enrollment)""",
        f"bv_student_performance{sfx}": f"""
  SELECT hk_student_enrollment, id_student, code_module, code_presentation, final_result, gender,
    age_band, disability, num_of_prev_attempts, registration_timing, has_unregistered,
    COALESCE(clicks, 0) AS lifetime_clicks, COALESCE(days, 0) AS total_active_days,
    COALESCE(weeks, 0) AS active_weeks, COALESCE(score, 0) AS avg_score,
    COALESCE(taken, 0) AS assessments_taken, COALESCE(passed, 0) AS assessments_passed,
    CASE WHEN COALESCE(taken, 0) = 0 THEN 0
      ELSE {rnd("CAST(passed AS DOUBLE) / taken", 2)} END AS assessment_completion_rate,
    COALESCE(final_result = 'Withdrawn' AND COALESCE(clicks, 0) < 100, FALSE) AS early_dropout_flag
  FROM bv_student_enrollment{sfx}
  LEFT JOIN (SELECT hk_student, hk_course_offering, {total("total_clicks")} AS clicks,
      {total("active_days")} AS days, count(DISTINCT week_number) AS weeks
    FROM bv_engagement_weekly{sfx} GROUP BY ALL) USING (hk_student, hk_course_offering)
  LEFT JOIN (SELECT hk_student, {mean("score")} AS score, count(id_assessment) AS taken,
      count(*) FILTER (assessment_result = 'passed') AS passed
    FROM bv_student_assessment{sfx} GROUP BY ALL) USING (hk_student)""",
    }


def _load(sfx: str, ts: str, where: str = "", changed: bool = False) -> dict[str, str]:
    weight = "p_size * 2.5::DOUBLE"
    band = "left(sha256(imd_band), 16)"
    if changed:
        weight = f"({weight} + CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 0 END)"
        band = f"CASE WHEN id_student % 10 = 0 THEN left(sha256('changed'), 16) ELSE {band} END"
    out = {}
    for name, sql in {**BASE, **BRONZE, **VAULT}.items():
        sql = (sql.replace("{filter}", where).replace("{weight}", weight)
               .replace("{band}", band).replace("{ts}", ts))
        out[name.replace("@", sfx)] = sql.replace("@", sfx)
    return out


def _merged() -> dict[str, str]:
    """Vault tables after both loads, suffix ``_m``."""
    out = {}
    for name in VAULT:
        table = name.rstrip("@")
        if table.startswith(("hub_", "link_")):
            hk = {"hub": table.replace("hub_", "hk_"), "link": table.replace("link_", "hk_")}[
                table.split("_")[0]]
            out[f"{table}_m"] = (f"SELECT * FROM {table}_2 UNION ALL BY NAME SELECT * FROM "
                                 f"{table}_1 WHERE {hk} NOT IN (SELECT {hk} FROM {table}_2)")
        elif table.startswith("sat_"):
            out[f"{table}_m"] = (
                f"SELECT * FROM {table}_1 UNION ALL BY NAME SELECT * FROM {table}_2 n WHERE NOT "
                f"EXISTS (SELECT 1 FROM {table}_1 o WHERE o.{SAT_KEYS[table]} = "
                f"n.{SAT_KEYS[table]} AND o.hk_hashdiff = n.hk_hashdiff)")
        elif table.startswith("txn_"):
            out[f"{table}_m"] = f"SELECT * FROM {table}_2"
    return out


SAT_KEYS = {
    "sat_student_details": "hk_student",
    "sat_student_enrollment": "hk_student_enrollment",
    "sat_course_offering_details": "hk_course_offering",
    "sat_assessment_details": "hk_assessment",
    "sat_student_assessment_result": "hk_student_assessment",
    "sat_vle_details": "hk_vle",
}

EXTRA = {
    "metrics_history": f"""
  SELECT CAST(ts AS DATE) AS run_date, event_type AS table_name, 'bronze' AS layer,
    count(*) AS expectations_evaluated,
    count(*) - count(*) FILTER (value > 100) AS expectations_passed,
    count(*) FILTER (value > 100) AS expectations_failed,
    {percent("count(*) - count(*) FILTER (value > 100)", "count(*)")} AS pass_rate,
    count(*) FILTER (value > 200) AS anomalies_detected,
    count(*) FILTER (value > 300) AS click_anomalies,
    count(*) FILTER (value > 200) - count(*) FILTER (value > 300) AS score_anomalies,
    0::BIGINT AS temporal_anomalies, count(DISTINCT user_id) AS row_count,
    CAST(max(floor(value)) AS BIGINT) AS pipeline_duration_sec,
    0::BIGINT AS dbt_tests_passed, 0::BIGINT AS dbt_tests_failed
  FROM events GROUP BY ALL""",
}

PARTS: dict[str, str] = {
    **_load("", TS), **SILVER, **GOLD, **business("", latest=True),
    **_load("_1", TS, f"WHERE o_orderdate < {CUT}"),
    **_load("_2", TS2, changed=True),
    **_load("_b", TS2, f"WHERE o_orderdate >= {CUT}"),
    **_merged(), **business("_m", latest=True),
    **{k.replace("_m", "_a") if k.endswith("_m") else k: v
       for k, v in business("_m", latest=False).items()},
    **EXTRA,
}

_WORD = re.compile(r"[a-z_0-9]+")


def assemble(sql: str, parts: dict[str, str] | None = None) -> str:
    """Put the parts a statement names, and the parts those name, in front of it."""
    known = PARTS if parts is None else {**PARTS, **parts}
    order: list[str] = []

    def visit(text: str, own: str | None) -> None:
        for word in dict.fromkeys(_WORD.findall(text)):
            if word in known and word != own and word not in order:
                visit(known[word], word)
                order.append(word)

    visit(sql, None)
    if not order:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({known[n]})" for n in order) + "\n" + sql
