"""One SQL statement per registered query."""

from __future__ import annotations

from lakevault.oracles.parts import (
    BRONZE,
    ENROLMENT,
    GOLD,
    SILVER,
    TS,
    VAULT,
    assemble,
    business,
    mean,
    newest,
    percent,
    rnd,
    total,
    weekly,
)

DETECTED = "TIMESTAMP '2024-01-01 06:00:00'"
RUN_DATE = "DATE '2024-01-01'"
NOW = "TIMESTAMP '2024-01-01 17:30:00'"
OFFERING = "code_module, code_presentation"

ORACLES: dict[str, str] = {}


def add(name: str, sql: str, **parts: str) -> None:
    ORACLES[name] = assemble(sql, parts)


# --- models --------------------------------------------------------------------------------

for _name in [*BRONZE, *VAULT, *SILVER, *GOLD, *business("", True)]:
    if _name != "enrolment_state@":
        add(_name.rstrip("@"), f"SELECT * FROM {_name.rstrip('@')}")

# --- ingestion -----------------------------------------------------------------------------

add("ingest_courses", "SELECT * FROM courses")

NUMERIC_TEXT = """
  SELECT l_orderkey, l_linenumber, l_partkey,
    CASE l_linenumber WHEN 1 THEN q WHEN 2 THEN 'NA' WHEN 3 THEN '?' WHEN 4 THEN ' ' || q || ' '
      WHEN 5 THEN q || '.7' WHEN 6 THEN q || 'd'
      WHEN 7 THEN '90071992547410' || lpad(q, 2, '0') END AS a,
    CASE l_linenumber WHEN 1 THEN q || '.5' WHEN 2 THEN 'NaN' WHEN 3 THEN 'x' WHEN 4 THEN ' ' || q
      WHEN 5 THEN '-' || q || '.25' WHEN 6 THEN q || 'F' WHEN 7 THEN '' END AS b
  FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q FROM lineitem)"""
add("coerce_numeric", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  COALESCE(x, 0) AS sum_click, x AS date_submitted, y AS score
FROM (SELECT *, CASE WHEN regexp_full_match(trim(a), '[0-9]+') THEN CAST(trim(a) AS BIGINT)
      WHEN a <> 'NA' THEN CAST(trunc(TRY_CAST(trim(a) AS DOUBLE)) AS BIGINT) END AS x,
    CASE WHEN b <> 'NaN' THEN TRY_CAST(trim(b) AS DOUBLE) END AS y FROM ({NUMERIC_TEXT}))""")

# Registrations summed per key: any repeated key turns missing numbers into 0 everywhere.
REGISTRATION_SUM = f"""
  SELECT {OFFERING}, id_student, CAST(sum(date_registration) AS BIGINT) AS date_registration,
    CASE WHEN (SELECT max(n) FROM (SELECT count(*) AS n FROM registration_dup
      GROUP BY {ENROLMENT})) > 1
    THEN COALESCE(sum(date_unregistration), 0) ELSE sum(date_unregistration)
    END AS date_unregistration
  FROM registration_dup GROUP BY {ENROLMENT}"""
SUBMISSION_SUM = """
  SELECT id_assessment, id_student, CAST(sum(date_submitted) AS BIGINT) AS date_submitted,
    CAST(sum(is_banked) AS BIGINT) AS is_banked,
    COALESCE(sum(score), 0) AS score
  FROM student_assessment_dup GROUP BY id_assessment, id_student"""
CLICK_SUM = f"""
  SELECT min({OFFERING.split(", ")[0]}) AS code_module, min(code_presentation) AS code_presentation,
    id_student, id_site, date, CAST(sum(sum_click) AS BIGINT) AS sum_click
  FROM student_vle GROUP BY id_student, id_site, date"""

add("ingest_registration", f"""
SELECT *, {TS} AS _ingested_at, 'studentRegistration.csv' AS _source_file
FROM ({REGISTRATION_SUM})""")
add("ingest_clicks", f"""
SELECT *, {TS} AS _ingested_at, 'studentVle.csv' AS _source_file FROM ({CLICK_SUM})""")
add("dedup_sum_clicks", CLICK_SUM)
add("dedup_null_sum", f"SELECT * REPLACE ({rnd('score', 4)} AS score) FROM ({SUBMISSION_SUM})")
add("dedup_null_sum_keep", f"""
SELECT id_assessment, id_student, CAST(sum(date_submitted) AS BIGINT) AS date_submitted,
  CAST(sum(is_banked) AS BIGINT) AS is_banked, {rnd('sum(score)', 4)} AS score
FROM student_assessment_dup GROUP BY id_assessment, id_student""")
add("pii_hash", f"""
SELECT {ENROLMENT}, left(sha256(region), 16) AS region, left(sha256(imd_band), 16) AS imd_band
FROM student_info_named""")

COUNTS = [
    ("courses", "courses", "courses"), ("assessments", "assessments", "assessments"),
    ("vle", "vle", "vle"), ("studentInfo", "student_info", "student_info"),
    ("studentRegistration", "student_registration", f"({REGISTRATION_SUM})"),
    ("studentAssessment", "student_assessment", f"({SUBMISSION_SUM})"),
    ("studentVle", "student_vle", f"({CLICK_SUM})"),
]
add("ingest_summary", " UNION ALL ".join(
    f"SELECT '{source}' AS \"table\", count(*) AS rows, CAST(NULL AS VARCHAR) AS errors "
    f"FROM {rows}" for source, _, rows in COUNTS))
add("ingestion_log", " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, '{source}.csv' AS file_name, count(*) AS row_count, "
    f"CAST(NULL AS VARCHAR) AS errors, {TS} AS _ingested_at FROM {rows}"
    for source, table, rows in COUNTS))
add("schema_check", """
SELECT 'studentInfo' AS "table", kind, "column", (SELECT count(*) FROM customer) AS rejected_rows
FROM (
  SELECT 'missing' AS kind, unnest(['age_band', 'code_module', 'code_presentation', 'disability',
    'final_result', 'gender', 'highest_education', 'id_student', 'imd_band',
    'num_of_prev_attempts', 'region', 'studied_credits']) AS "column"
  UNION ALL
  SELECT 'unexpected', unnest(['c_acctbal', 'c_custkey', 'c_mktsegment', 'c_name', 'c_nationkey']))
UNION ALL
SELECT 'studentVle', kind, "column", (SELECT count(*) FROM student_vle)
FROM (SELECT 'missing' AS kind, 'date' AS "column" UNION ALL SELECT 'unexpected', 'clicked_on')""")

# --- incremental loads ---------------------------------------------------------------------

add("hub_upsert_2nd_load", """
SELECT * FROM hub_student_b
UNION ALL BY NAME
SELECT * FROM hub_student_1 WHERE hk_student NOT IN (SELECT hk_student FROM hub_student_b)""")
add("sat_append_2nd_load", "SELECT * FROM sat_assessment_details_m")
add("sat_details_2nd_load", "SELECT * FROM sat_student_details_m")
add("latest_student_details", newest("sat_student_details_m", "hk_student"))
add("bv_course_offering_2nd_load", "SELECT * FROM bv_course_offering_m")
add("bv_course_offering_all_versions", "SELECT * FROM bv_course_offering_a")
add("bv_student_assessment_all_versions", "SELECT * FROM bv_student_assessment_a")
add("bv_engagement_weekly_all_versions", weekly(
    """(SELECT t.*, s.activity_type FROM txn_student_vle_click t
  LEFT JOIN (SELECT hk_vle, activity_type FROM sat_vle_details UNION ALL
    SELECT hk_vle, activity_type FROM sat_vle_details WHERE week_from % 2 = 0) s
    USING (hk_vle))""", "hk_student, hk_course_offering", "hk_vle"))
add("sat_append_bucketed", "SELECT * FROM sat_assessment_details_m")
add("bv_student_assessment_bucketed", "SELECT * FROM bv_student_assessment")
add("fact_engagement_2nd_load", "SELECT * FROM fact_engagement_summary")

# --- streams -------------------------------------------------------------------------------

add("stream_txn_student_vle_click", "SELECT * FROM txn_student_vle_click")
add("stream_sat_append_2nd_load", "SELECT * FROM sat_assessment_details_m")
add("stream_engagement_weekly", "SELECT * FROM fact_engagement_summary")
add("stream_dedup_sum_clicks", CLICK_SUM)
LATE = """
  SELECT code_module, code_presentation, id_site % 7 = 0 AS straggler,
    CAST(floor(date / 7.0) AS BIGINT) AS week_number,
    make_date(CAST(left(code_presentation, 4) AS INT), ascii(substr(code_presentation, 5, 1)) - 64, 1)
      + to_days(CAST((floor(date / 7.0) + 1) * 7 AS INT)) AS week_end
  FROM bronze_student_vle"""
add("stream_late_clicks", f"""
SELECT code_module, code_presentation, week_number, count(*) AS landed,
  count(*) FILTER (NOT straggler OR week_end > mark) AS accepted,
  count(*) FILTER (straggler AND week_end <= mark) AS late
FROM ({LATE}) CROSS JOIN (
  SELECT max(week_end) - to_days(1000) AS mark FROM ({LATE}) WHERE NOT straggler) GROUP BY ALL""")
add("metrics_guard", """
SELECT run_date, table_name, layer,
  expectations_evaluated + CASE WHEN run_date > DATE '2024-01-20' THEN 1 ELSE 0 END
    AS expectations_evaluated
FROM metrics_history""")
add("bv_quality_metrics", f"""
SELECT {RUN_DATE} AS run_date, 'student_enrollment' AS table_name, 'dv' AS layer,
  18 AS expectations_evaluated, 18 AS expectations_passed, 0 AS expectations_failed,
  100.0::DOUBLE AS pass_rate, 0 AS anomalies_detected, 0 AS click_anomalies, 0 AS score_anomalies,
  0 AS temporal_anomalies, count(*) AS row_count, 0 AS pipeline_duration_sec,
  0 AS dbt_tests_passed, 0 AS dbt_tests_failed
FROM link_student_enrollment""")

# --- assertions ----------------------------------------------------------------------------

ASSERTED = ("'forumng','oucontent','homepage','resource','url','quiz','htmlactivity','glossary',"
            "'dataplus','questionnaire','repeatactivity','externalquiz','dualpane','folder',"
            "'sharedsubpage','page','subpage','oucollaborate','ouwiki','ouelluminate'")
DECLARED_TYPES = ("'forumng','oucontent','homepage','resource','url','quiz','htmlactivity',"
                  "'glossary','dataplus','questionnaire','repeatactivity','externalquiz',"
                  "'dualpane','folder','sharedsubpage','page','subpage'")
# Fixed values, in the order they are declared.
RESULTS = "'Pass','Fail','Withdrawn','Distinction'"


def accepted(prefix: str) -> str:
    return f"""
SELECT 'invalid_final_result' AS check_name, id_student AS id, final_result AS value
FROM {prefix}student_info WHERE final_result NOT IN ({RESULTS})
UNION ALL
SELECT 'invalid_assessment_type', id_assessment, assessment_type
FROM {prefix}assessments WHERE assessment_type NOT IN ('TMA', 'CMA', 'Exam')
UNION ALL
SELECT 'invalid_activity_type', id_site, activity_type
FROM {prefix}vle WHERE activity_type NOT IN ({ASSERTED})"""


def ranges(prefix: str) -> str:
    return f"""
SELECT 'score_out_of_range' AS check_name, id_assessment AS id, CAST(score AS VARCHAR) AS value
FROM {prefix}student_assessment WHERE score NOT BETWEEN 0 AND 100
UNION ALL
SELECT 'weight_out_of_range', id_assessment, CAST(weight AS VARCHAR)
FROM {prefix}assessments WHERE weight NOT BETWEEN 0 AND 100
UNION ALL
SELECT 'negative_sum_click', id_student, CAST(sum_click AS VARCHAR)
FROM {prefix}student_vle WHERE sum_click < 0"""


add("assert_accepted_values", accepted("bronze_"))
add("assert_accepted_values_raw", accepted(""))
add("assert_range_checks", ranges("bronze_"))
add("assert_range_checks_raw", ranges(""))
add("assert_referential_integrity", """
SELECT 'orphan_student_assessment_assessment' AS check_name, CAST(id_assessment AS VARCHAR) AS value
FROM bronze_student_assessment s WHERE NOT EXISTS (
  SELECT 1 FROM bronze_assessments a WHERE a.id_assessment = s.id_assessment)
UNION ALL
SELECT 'orphan_student_vle_site', CAST(id_site AS VARCHAR)
FROM bronze_student_vle c WHERE NOT EXISTS (
  SELECT 1 FROM bronze_vle v WHERE v.id_site = c.id_site)
UNION ALL
SELECT 'orphan_registration_student', CAST(id_student AS VARCHAR)
FROM bronze_student_registration r WHERE NOT EXISTS (
  SELECT 1 FROM bronze_student_info i WHERE i.id_student = r.id_student)""")


def repeated(model: str, columns: str, where: str = "") -> str:
    return (f"SELECT '{model}' AS model, 'unique' AS test, '{columns.replace(' ', '')}' AS columns,"
            f" count(*) AS failed FROM (SELECT 1 FROM {model} {where} GROUP BY {columns} "
            f"HAVING count(*) > 1)")


add("assert_unique", " UNION ALL ".join([
    repeated("bv_course_offering", "hk_course_offering"),
    repeated("bv_student_enrollment", "hk_student_enrollment"),
    repeated("registration_dup", ENROLMENT),
]))

NON_NULL = {
    "hub_student": "hk_student id_student",
    "hub_course_offering": "hk_course_offering code_module code_presentation",
    "hub_assessment": "hk_assessment id_assessment",
    "hub_vle": "hk_vle id_site",
    "link_student_enrollment": "hk_student_enrollment hk_student hk_course_offering",
    "link_student_assessment": "hk_student_assessment hk_student hk_assessment",
    "link_course_offering_assessment":
        "hk_course_offering_assessment hk_assessment hk_course_offering",
    "link_course_offering_vle": "hk_course_offering_vle hk_vle hk_course_offering",
    "txn_student_vle_click": "hk_student hk_vle date",
    "bv_course_offering": "hk_course_offering code_module code_presentation",
    "bv_engagement_daily": "hk_student date",
    "bv_engagement_weekly": "hk_student week_number",
    "bv_student_assessment": "hk_student_assessment id_student id_assessment",
    "bv_student_enrollment": "hk_student_enrollment id_student",
    "bv_student_performance": "id_student",
}
add("assert_non_null", " UNION ALL ".join(
    f"SELECT '{m}' AS model, 'not_null' AS test, '{c}' AS columns, count(*) - count({c}) AS failed "
    f"FROM {m}" for m, cols in NON_NULL.items() for c in cols.split()))


def counted(model: str, test: str, columns: str, bad: str) -> str:
    return (f"SELECT '{model}' AS model, '{test}' AS test, '{columns}' AS columns, "
            f"count(*) FILTER ({bad}) AS failed FROM {model}")


MODEL_COLUMNS = {
    "silver_courses": "code_module,code_presentation,length",
    "silver_assessments": "id_assessment,assessment_type,weight",
    "silver_vle": "id_site,activity_type",
    "silver_student_info": "id_student,final_result",
    "silver_student_registration": "id_student,date_registration",
    "silver_student_assessment": "id_assessment,id_student",
    "silver_student_vle": "id_student,id_site,date",
    "dim_student": "id_student",
    "fact_student_interaction": "id_student,date",
    "fact_student_assessment": "id_student,id_assessment,score",
    "fact_engagement_summary": "id_student,week_number",
    "rpt_student_performance": "id_student",
    "rpt_quality_metrics": "run_date,table_name,pass_rate",
}
MODEL_VALUES = [
    ("silver_assessments", "assessment_type", "'CMA','Exam','TMA'"),
    ("silver_vle", "activity_category",
     "'communication','content','assessment','reference','tool','other'"),
    ("silver_student_info", "final_result", RESULTS),
    ("silver_student_assessment", "assessment_result", "'passed','failed','not_submitted'"),
]
TESTS = " UNION ALL ".join(
    [repeated("silver_courses", OFFERING,
              "WHERE code_module IS NOT NULL AND code_presentation IS NOT NULL"),
     repeated("dim_student", ENROLMENT,
              "WHERE id_student IS NOT NULL AND code_module IS NOT NULL "
              "AND code_presentation IS NOT NULL"),
     repeated("dim_course", OFFERING,
              "WHERE code_module IS NOT NULL AND code_presentation IS NOT NULL")]
    + [counted(m, "not_null", cols, " OR ".join(f"{c} IS NULL" for c in cols.split(",")))
       for m, cols in MODEL_COLUMNS.items()]
    + [counted(m, "accepted_values", c, f"{c} NOT IN ({values})") for m, c, values in MODEL_VALUES])
TEST_RESULTS = f"SELECT *, failed = 0 AS success FROM ({TESTS})"
HISTORY = {"rpt_quality_metrics": "SELECT * FROM metrics_history"}
add("model_tests", TEST_RESULTS, **HISTORY)

# --- declared rules ------------------------------------------------------------------------

# (kind, table, column, label, severity, condition of a failing row)
RULES = [
    ("not_null", table, c, "not_null", "critical", f"{c} IS NULL")
    for table, cols in {
        "student_info": "id_student code_module code_presentation gender final_result",
        "student_assessment": "id_assessment id_student score",
        "student_vle": "id_student id_site date sum_click",
        "student_registration": "id_student date_registration",
        "assessments": "id_assessment assessment_type weight",
        "courses": "code_module code_presentation",
        "vle": "id_site activity_type",
    }.items() for c in cols.split()
] + [
    ("range", "student_assessment", "score", "range", "critical", "score NOT BETWEEN 0 AND 100"),
    ("range", "assessments", "weight", "range", "critical", "weight NOT BETWEEN 0 AND 100"),
    ("range", "student_vle", "sum_click", "range", "critical", "sum_click < 0"),
    ("range", "student_registration", "date_registration", "range", "critical",
     "date_registration NOT BETWEEN -365 AND 0"),
    ("range", "assessments", "date", "range", "critical", "date NOT BETWEEN -365 AND 365"),
    ("allowed", "student_info", "final_result", "valid_final_results", "critical",
     f"final_result NOT IN ({RESULTS})"),
    ("allowed", "vle", "activity_type", "valid_activity_types", "warning",
     f"activity_type NOT IN ({DECLARED_TYPES})"),
    ("allowed", "assessments", "assessment_type", "valid_assessment_types", "critical",
     "assessment_type NOT IN ('TMA', 'CMA', 'Exam')"),
    ("allowed", "student_assessment", "is_banked", "is_banked_boolean", "warning",
     "is_banked NOT IN (0, 1)"),
]


def outcomes(chosen: list[tuple], layer: str = "bronze", prefix: str = "") -> str:
    inner = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{layer}' AS layer, '{label}' AS rule, "
        f"'{column}' AS \"column\", '{severity}' AS severity, count(*) AS evaluated_rows, "
        f"count(*) FILTER ({bad}) AS failed_rows FROM {prefix}{table}"
        for _, table, column, label, severity, bad in chosen)
    return f"SELECT *, failed_rows = 0 AS success FROM ({inner}) WHERE evaluated_rows > 0"


EXECUTED = [r for r in RULES if r[3] != "is_banked_boolean"]
add("rules_not_null", outcomes([r for r in RULES if r[0] == "not_null"]))
add("rules_range", outcomes([r for r in RULES if r[0] == "range"]))
add("rules_allowed", outcomes([r for r in RULES if r[0] == "allowed"]))
add("validate_table", outcomes([r for r in EXECUTED if r[1] == "student_assessment"]))
add("validate_all", outcomes(EXECUTED))
# The silver assessments carry the deadline under another name.
add("validate_silver", outcomes(
    [r for r in EXECUTED if r[1:3] != ("assessments", "date")], "silver", "silver_"))
add("quality_summary", f"""
SELECT bool_and(success) AS pipeline_success, count(*) AS total_expectations,
  count(*) FILTER (success) AS total_passed, count(*) FILTER (NOT success) AS total_failed,
  {percent("count(*) FILTER (success)", "count(*)")} AS pass_rate
FROM ({outcomes(EXECUTED)})""")
PER_TABLE = f"""
  SELECT table_name, layer, count(*) AS expectations_evaluated,
    count(*) FILTER (success) AS expectations_passed,
    count(*) FILTER (NOT success) AS expectations_failed, bool_and(success) AS success,
    max(evaluated_rows) AS row_count
  FROM ({outcomes(EXECUTED)}) GROUP BY ALL"""
add("quality_summary_tables", PER_TABLE)
add("quality_top_failures", f"""
SELECT table_name, layer,
  CAST(row_number() OVER (PARTITION BY table_name, layer ORDER BY rule, "column") AS INTEGER)
    AS position, rule, "column", severity, failed_rows
FROM ({outcomes(EXECUTED)}) WHERE NOT success QUALIFY position <= 10""")


def repeats(name: str, table: str, columns: str) -> str:
    return (f"SELECT '{name}' AS table_name, '{columns.replace(' ', '')}' AS columns, "
            f"count(*) AS duplicate_keys, CAST(COALESCE(sum(n), 0) AS BIGINT) AS duplicate_rows "
            f"FROM (SELECT count(*) AS n FROM {table} GROUP BY {columns}) WHERE n > 1")


add("rules_unique", " UNION ALL ".join([
    repeats("courses", "courses", OFFERING),
    repeats("assessments", "assessments", "id_assessment"),
    repeats("vle", "vle", "id_site"),
]))
add("rules_unique_raw", " UNION ALL ".join([
    repeats("registration_dup", "registration_dup", ENROLMENT),
    repeats("assessment_dup", "student_assessment_dup", "id_assessment, id_student"),
    repeats("student_vle", "student_vle", "id_student, id_site, date"),
]))


def lost(child: str, parent: str, columns: str) -> str:
    names = columns.replace(" ", "")
    same = " AND ".join(f"p.{c} = c.{c}" for c in names.split(","))
    return (f"SELECT '{child}({names})->{parent}({names})' AS rule, count(*) AS orphan_rows, "
            f"count(DISTINCT ({columns})) AS orphan_keys FROM {child} c "
            f"WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE {same})")


add("rules_ri", " UNION ALL ".join([
    lost("student_assessment", "assessments", "id_assessment"),
    lost("student_assessment", "student_info", "id_student"),
    lost("student_registration", "student_info", "id_student"),
    lost("student_vle", "vle", "id_site"),
    lost("student_vle", "student_info", "id_student"),
    lost("student_vle", "courses", OFFERING),
]))
add("rule_weight_sum", f"""
SELECT {OFFERING}, sum(weight) AS total_weight,
  count(*) FILTER (assessment_type = 'Exam') AS exams
FROM assessments GROUP BY ALL HAVING abs(sum(weight) - 100) > 1 OR exams = 0""")
add("rule_no_future_dates", f"""
SELECT id_assessment, {OFFERING}, date, length
FROM assessments JOIN courses USING ({OFFERING}) WHERE date > length""")


def shares(source: str, column: str, early: str) -> str:
    return f"""
SELECT category, {rnd("base", 6)} AS baseline_pct, {rnd("now", 6)} AS current_pct,
  {rnd("abs(now - base)", 6)} AS drift_pct, abs(now - base) > 5 AS exceeds
FROM (SELECT {column} AS category,
    count(*) FILTER ({early}) * 100.0::DOUBLE
      / (SELECT count(*) FROM {source} WHERE {early}) AS base,
    count(*) FILTER (NOT ({early})) * 100.0::DOUBLE
      / (SELECT count(*) FROM {source} WHERE NOT ({early})) AS now
  FROM {source} GROUP BY ALL)"""


add("drift_categorical", shares("events", "event_type", "ts < TIMESTAMP '2024-01-16'"))
add("drift_final_result", shares("student_info", "final_result", "code_presentation < '2000'"))
DRIFT_SHARES = " UNION ALL ".join(f"""
  SELECT 'student_info' AS table_name, '{c}' AS "column", 'categorical' AS kind, max(drift_pct) AS d,
    5 AS allowed FROM ({shares("student_info", c, "code_presentation < '2000'")})"""
    for c in ("gender", "final_result"))
RULES_DRIFT = f"""
SELECT table_name, "column", kind, {rnd("d", 6)} AS drift, CAST(allowed AS DOUBLE) AS allowed,
  COALESCE(d > allowed, FALSE) AS exceeds
FROM ({DRIFT_SHARES} UNION ALL
  SELECT 'student_vle', 'sum_click', 'numeric', abs(c - m) / nullif(s, 0), 3
  FROM (SELECT avg(sum_click) FILTER (code_presentation < '2000') AS m,
    stddev_pop(sum_click) FILTER (code_presentation < '2000') AS s,
    avg(sum_click) FILTER (code_presentation >= '2000') AS c FROM student_vle))"""
add("rules_drift", RULES_DRIFT)
add("drift_from_profiles", RULES_DRIFT)
add("drift_numeric", f"""
SELECT {rnd("m", 6)} AS baseline_mean, {rnd("s", 6)} AS baseline_std, {rnd("c", 6)} AS current_mean,
  {rnd("abs(c - m) / nullif(s, 0)", 6)} AS drift_z,
  COALESCE(abs(c - m) / nullif(s, 0) > 3, FALSE) AS exceeds
FROM (SELECT avg(value) FILTER (ts < TIMESTAMP '2024-01-16') AS m,
    stddev_pop(value) FILTER (ts < TIMESTAMP '2024-01-16') AS s,
    avg(value) FILTER (ts >= TIMESTAMP '2024-01-16') AS c FROM events)""")

# --- anomalies and audit -------------------------------------------------------------------

def click_flags(stats: str) -> str:
    return f"""
  SELECT c.*,
    CASE WHEN sum_click > 5000 THEN 'exceeds_daily_max_5000' ELSE 'z_score_exceeds_3.0' END
      AS anomaly_reason,
    {rnd("CASE WHEN sum_click > 5000 THEN sum_click / 5000.0::DOUBLE "
         "ELSE abs(sum_click - m) / s END", 6)} AS anomaly_score,
    {DETECTED} AS detected_at
  FROM student_vle c CROSS JOIN (SELECT {stats}) g
  WHERE sum_click > 5000 OR abs(sum_click - m) / nullif(s, 0) > 3"""


CLICK_FLAGS = click_flags(
    "avg(sum_click) AS m, stddev_pop(sum_click) AS s FROM student_vle")
add("click_anomalies", CLICK_FLAGS)
add("click_anomalies_per_course", f"""
SELECT c.* EXCLUDE (z),
  CASE WHEN sum_click > 5000 THEN 'exceeds_daily_max_5000' ELSE 'z_score_exceeds_3.0' END
    AS anomaly_reason,
  {rnd("CASE WHEN sum_click > 5000 THEN sum_click / 5000.0::DOUBLE ELSE z END", 6)}
    AS anomaly_score, {DETECTED} AS detected_at
FROM (SELECT c.*, abs(sum_click - avg(sum_click) OVER w) / nullif(stddev_pop(sum_click) OVER w, 0)
    AS z FROM student_vle c WINDOW w AS (PARTITION BY {OFFERING})) c
WHERE sum_click > 5000 OR z > 3""")


def score_flags(source: str, columns: str) -> str:
    return f"""
  SELECT {columns},
    CASE WHEN z > 3 THEN 'z_score_exceeds_3.0'
      WHEN score > high THEN 'above_upper_fence_' || CAST(CAST(high AS DECIMAL(18,1)) AS VARCHAR)
      ELSE 'below_lower_fence_' || CAST(CAST(low AS DECIMAL(18,1)) AS VARCHAR) END
      AS anomaly_reason, {DETECTED} AS detected_at
  FROM (SELECT s.*, abs(COALESCE(score, 0) - m) / nullif(sd, 0) AS z,
      q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
    FROM {source} s CROSS JOIN (SELECT avg(COALESCE(score, 0)) AS m,
        stddev_pop(COALESCE(score, 0)) AS sd, quantile_cont(score, 0.25) AS q1,
        quantile_cont(score, 0.75) AS q3 FROM {source}))
  WHERE z > 3 OR score > high OR score < low"""


add("score_anomalies", score_flags(
    "submission_sum", f"id_assessment, id_student, date_submitted, is_banked, "
    f"{rnd('score', 4)} AS score"), submission_sum=SUBMISSION_SUM)
SCORE_FLAGS = score_flags("student_assessment", "id_assessment, id_student")

EARLY_CLICKS = f"""
  SELECT c.*, date_registration, 'vle_before_registration' AS anomaly_reason
  FROM student_vle c JOIN (SELECT {ENROLMENT}, date_registration FROM student_registration)
    USING ({ENROLMENT})
  WHERE date < date_registration"""
EARLY_SUBMISSIONS = f"""
  SELECT s.*, {OFFERING}, date_registration, 'assessment_before_registration' AS anomaly_reason
  FROM student_assessment s
  JOIN (SELECT {ENROLMENT}, date_registration FROM student_registration) r USING (id_student)
  WHERE date_submitted < date_registration"""
add("vle_before_registration", EARLY_CLICKS)
add("assessment_before_registration", EARLY_SUBMISSIONS)
add("assessment_before_registration_strict", f"""
SELECT s.*, {OFFERING}, date_registration, 'assessment_before_registration' AS anomaly_reason
FROM student_assessment s
JOIN (SELECT id_assessment, {OFFERING} FROM assessments) USING (id_assessment)
JOIN (SELECT {ENROLMENT}, date_registration FROM student_registration) USING ({ENROLMENT})
WHERE date_submitted < date_registration""")
add("activity_after_unregistration", f"""
SELECT c.*, date_unregistration, 'activity_after_unregistration' AS anomaly_reason
FROM student_vle c JOIN (SELECT {ENROLMENT}, date_unregistration FROM student_registration)
  USING ({ENROLMENT})
WHERE date_unregistration <> 0 AND date > date_unregistration""")
add("zero_activity_exam", f"""
SELECT s.*, {OFFERING}, COALESCE(clicks, 0) AS total_clicks,
  'zero_activity_exam' AS anomaly_reason
FROM (SELECT * FROM student_assessment WHERE score IS NOT NULL) s
JOIN (SELECT id_assessment, {OFFERING} FROM assessments WHERE assessment_type = 'Exam')
  USING (id_assessment)
LEFT JOIN (SELECT {ENROLMENT}, {total("sum_click")} AS clicks FROM student_vle GROUP BY ALL)
  USING ({ENROLMENT})
WHERE COALESCE(clicks, 0) < 10""")
add("registration_window", """
SELECT *, 'registration_outside_window' AS anomaly_reason FROM student_registration
WHERE date_registration NOT BETWEEN -365 AND 0""")


def flags(source: str, table: str, kind: str, keys: list[str], score: str = "NULL") -> str:
    parts = " || ',' || ".join(
        f"""'"{k}":' || """ + (f"""'"' || {k} || '"'""" if k.startswith("code") else k)
        for k in keys)
    return (f"SELECT '{table}' AS table_name, '{kind}' AS anomaly_type, "
            f"'{{' || {parts} || '}}' AS keys, anomaly_reason AS reason, "
            f"CAST({score} AS DOUBLE) AS score, {DETECTED} AS detected_at FROM ({source})")


CLICK_KEYS = ["id_student", "id_site", "date"]
BASIC_FLAGS = [
    flags(CLICK_FLAGS, "student_vle", "click_outlier", CLICK_KEYS, "anomaly_score"),
    flags(SCORE_FLAGS, "student_assessment", "score_outlier", ["id_assessment", "id_student"]),
]
add("anomaly_flags", " UNION ALL ".join([
    *BASIC_FLAGS,
    flags(EARLY_CLICKS, "student_vle", "vle_before_registration", CLICK_KEYS),
    flags(EARLY_SUBMISSIONS, "student_assessment", "assessment_before_registration",
          ["id_assessment", "id_student", "code_module", "code_presentation"]),
]))
add("anomaly_samples", f"""
SELECT * FROM ({" UNION ALL ".join(BASIC_FLAGS)})
QUALIFY row_number() OVER (PARTITION BY anomaly_type ORDER BY keys, reason) <= 20""")
SUMMARY = " UNION ALL ".join(
    f"SELECT '{kind}' AS anomaly_type, count(*) AS count, {in_total} AS in_total FROM ({source})"
    for kind, source, in_total in [
        ("click_outlier", CLICK_FLAGS, True), ("score_outlier", SCORE_FLAGS, True),
        ("vle_before_registration", EARLY_CLICKS, False),
        ("assessment_before_registration", EARLY_SUBMISSIONS, False)])
add("anomaly_summary", SUMMARY)
add("anomaly_total", f"""
SELECT CAST(sum(count) FILTER (in_total) AS BIGINT) AS anomalies_found FROM ({SUMMARY})""")
add("audit_today", """
SELECT date_trunc('second', ts) AS timestamp, 'user_' || user_id AS principal,
  event_type AS action, 'event/' || event_id AS resource, props AS detail
FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-16'""")

# --- metrics and dashboards ----------------------------------------------------------------

add("rpt_quality_metrics", f"""
SELECT {RUN_DATE} AS run_date, table_name, layer, expectations_evaluated, expectations_passed,
  expectations_failed, {percent("expectations_passed", "expectations_evaluated")} AS pass_rate,
  click_anomalies + score_anomalies + temporal_anomalies AS anomalies_detected, click_anomalies,
  score_anomalies, temporal_anomalies, row_count, 0::BIGINT AS pipeline_duration_sec,
  COALESCE(passed, 0) AS dbt_tests_passed, COALESCE(failing, 0) AS dbt_tests_failed
FROM (SELECT p.*,
    CAST(COALESCE(sum(count) FILTER (anomaly_type = 'click_outlier'), 0) AS BIGINT)
      AS click_anomalies,
    CAST(COALESCE(sum(count) FILTER (anomaly_type = 'score_outlier'), 0) AS BIGINT)
      AS score_anomalies,
    CAST(COALESCE(sum(count) FILTER (NOT in_total), 0) AS BIGINT) AS temporal_anomalies
  FROM ({PER_TABLE}) p LEFT JOIN ({SUMMARY}) a
    ON table_name = CASE WHEN anomaly_type IN ('click_outlier', 'vle_before_registration')
      THEN 'student_vle' ELSE 'student_assessment' END
  GROUP BY ALL)
LEFT JOIN (SELECT regexp_replace(model, '^silver_', '') AS table_name,
    count(*) FILTER (success) AS passed, count(*) FILTER (NOT success) AS failing
  FROM ({TEST_RESULTS}) GROUP BY ALL) USING (table_name)""",
    rpt_quality_metrics=HISTORY["rpt_quality_metrics"])

PASSED, EVALUATED = total("expectations_passed"), total("expectations_evaluated")
add("pass_rate_by_table", f"""
SELECT table_name, {PASSED} AS passed, {EVALUATED} AS evaluated,
  {percent(PASSED, EVALUATED)} AS pass_rate
FROM metrics_history GROUP BY ALL""")
add("pass_rate_rolling30", f"""
SELECT table_name, run_date, passed, evaluated, {percent("passed", "evaluated")} AS pass_rate
FROM (SELECT table_name, run_date, CAST(sum(p) OVER w AS BIGINT) AS passed,
    CAST(sum(e) OVER w AS BIGINT) AS evaluated
  FROM (SELECT table_name, run_date, sum(expectations_passed) AS p,
      sum(expectations_evaluated) AS e FROM metrics_history GROUP BY ALL)
  WINDOW w AS (PARTITION BY table_name ORDER BY run_date
    RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW))""")
add("anomaly_trend", f"""
SELECT run_date, {total("anomalies_detected")} AS anomalies_detected,
  {total("click_anomalies")} AS click_anomalies, {total("score_anomalies")} AS score_anomalies,
  {total("temporal_anomalies")} AS temporal_anomalies
FROM metrics_history GROUP BY ALL""")
add("row_count_delta", """
SELECT run_date, table_name, layer, row_count, previous_row_count,
  row_count - previous_row_count AS row_delta
FROM (SELECT *, lag(row_count) OVER (PARTITION BY table_name, layer ORDER BY run_date)
  AS previous_row_count FROM metrics_history)""")
add("anomaly_spike", """
SELECT run_date, table_name, layer, anomalies_detected, previous
FROM (SELECT *, lag(anomalies_detected) OVER (PARTITION BY table_name, layer ORDER BY run_date)
  AS previous FROM metrics_history)
WHERE anomalies_detected > previous * 1.05""")
add("quality_band", f"""
SELECT *, CASE WHEN pass_rate > 95 THEN 'healthy' WHEN pass_rate > 90 THEN 'warning'
  ELSE 'critical' END AS status
FROM (SELECT run_date, {PASSED} AS passed, {EVALUATED} AS evaluated,
  {percent(PASSED, EVALUATED)} AS pass_rate FROM metrics_history GROUP BY ALL)""")
add("pipeline_latency", """
SELECT run_date, max(pipeline_duration_sec) AS pipeline_duration_sec
FROM metrics_history GROUP BY ALL""")
add("freshness_completeness", " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, (SELECT count(*) FROM {source}) AS source_rows, "
    f"count(*) AS bronze_rows, max(_ingested_at) AS last_ingested_at, "
    f"date_diff('second', max(_ingested_at), {NOW}) / 3600.0::DOUBLE AS age_hours, "
    f"count(*) = (SELECT count(*) FROM {source}) AS complete FROM {table}"
    for table, source in [
        ("student_registration", "registration_dup"),
        ("student_assessment", "student_assessment_dup"), ("student_vle", "student_vle")]))
add("freshness_from_log", " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, (SELECT count(*) FROM {source}) AS source_rows, "
    f"count(*) AS bronze_rows, (SELECT count(*) FROM {source}) - count(*) AS merged_rows, "
    f"{TS} AS last_ingested_at, date_diff('second', {TS}, {NOW}) / 3600.0::DOUBLE AS age_hours, "
    f"true AS complete FROM ({rows})"
    for table, source, rows in [
        ("student_registration", "registration_dup", REGISTRATION_SUM),
        ("student_assessment", "student_assessment_dup", SUBMISSION_SUM),
        ("student_vle", "student_vle", CLICK_SUM)]))
add("failed_tests", f"""
SELECT test, model AS table_name, columns || ': ' || failed || ' rows' AS detail
FROM ({TEST_RESULTS}) WHERE NOT success
UNION ALL
SELECT rule, table_name, "column" || ': ' || failed_rows || ' rows'
FROM ({outcomes(EXECUTED)}) WHERE NOT success""", **HISTORY)

GOOD = "count(*) FILTER (final_result IN ('Pass', 'Distinction'))"
add("pass_rate", f"""
SELECT {GOOD} AS passed, count(*) AS students, {GOOD} / count(*)::DOUBLE AS pass_rate
FROM dim_student""")
add("avg_engagement_score", """
SELECT a AS avg_clicks, m AS max_clicks, a / m AS engagement_score
FROM (SELECT sum(total_clicks)::DOUBLE / count(total_clicks) AS a,
  (SELECT max(max_daily_clicks) FROM fact_engagement_summary) AS m
  FROM fact_student_interaction)""")
add("dropout_signal", """
SELECT count(*) AS dropout_signals FROM rpt_student_performance
WHERE total_active_days < 5 AND assessment_completion_rate < 0.5""")
add("student_overview", """
SELECT final_result, count(*) AS enrolments, count(DISTINCT id_student) AS students
FROM dim_student GROUP BY ALL""")
add("student_overview_attempts", """
SELECT num_of_prev_attempts, count(*) AS enrolments FROM dim_student GROUP BY ALL""")
add("student_overview_slices", f"""
SELECT d.gender, d.age_band, i.region, count(*) AS enrolments
FROM dim_student d LEFT JOIN silver_student_info i USING ({ENROLMENT}) GROUP BY ALL""")
add("course_performance", f"""
SELECT code_module, {", ".join(
    f"count(*) FILTER (final_result = '{r}') AS {r}"
    for r in ("Pass", "Fail", "Withdrawn", "Distinction"))}
FROM dim_student GROUP BY ALL""")
add("course_performance_presentations", f"""
SELECT {OFFERING}, count(*) AS enrolments, {GOOD} AS passed,
  {GOOD} / count(*)::DOUBLE AS pass_rate
FROM dim_student GROUP BY ALL""")
add("course_performance_scores", f"""
SELECT assessment_type, {mean("score")} AS avg_score, count(score) AS scored
FROM fact_student_assessment GROUP BY ALL""")
add("engagement_analysis", f"""
SELECT date, {total("total_clicks")} AS total_clicks, count(*) AS active_enrolments
FROM fact_student_interaction GROUP BY ALL""")
add("engagement_analysis_activities", f"""
SELECT activity_type, activity_category, {total("sum_click")} AS total_clicks
FROM silver_student_vle GROUP BY ALL""")
add("engagement_analysis_active_days", f"""
SELECT {ENROLMENT}, final_result, {total("active_days")} AS active_days
FROM dim_student JOIN fact_engagement_summary USING ({ENROLMENT}) GROUP BY ALL""")
add("at_risk", f"""
SELECT final_result, week_number, sum(total_clicks)::DOUBLE / count(total_clicks) AS avg_clicks,
  count(*) AS enrolments
FROM fact_engagement_summary JOIN dim_student USING ({ENROLMENT})
WHERE final_result IN ('Withdrawn', 'Pass') GROUP BY ALL""")
add("at_risk_trajectory", """
SELECT id_student, id_assessment, date_submitted, score,
  row_number() OVER w AS attempt_no, score - lag(score) OVER w AS score_change
FROM fact_student_assessment WHERE score IS NOT NULL
WINDOW w AS (PARTITION BY id_student ORDER BY date_submitted, id_assessment)""")
add("at_risk_drop_off", f"""
SELECT * FROM (SELECT {ENROLMENT}, week_number, total_clicks,
  lag(total_clicks) OVER (PARTITION BY {ENROLMENT} ORDER BY week_number) AS previous_clicks
  FROM fact_engagement_summary)
WHERE total_clicks < previous_clicks * 0.5""")
