"""The declared rules of the warehouse."""

from __future__ import annotations

from lakevault.operators.rules import rules_from_mapping
from lakevault.plans.bronze import FINAL_RESULTS

# Accepted assessment and activity types. The row rule accepts 17 activity types,
# the assertion on the bronze view three more; both lists are kept as declared.
ASSESSMENT_TYPES = ["TMA", "CMA", "Exam"]
RULE_ACTIVITY_TYPES = [
    "forumng", "oucontent", "homepage", "resource", "url", "quiz", "htmlactivity", "glossary",
    "dataplus", "questionnaire", "repeatactivity", "externalquiz", "dualpane", "folder",
    "sharedsubpage", "page", "subpage",
]
ASSERTED_ACTIVITY_TYPES = [*RULE_ACTIVITY_TYPES, "oucollaborate", "ouwiki", "ouelluminate"]

ENROLMENT = ["id_student", "code_module", "code_presentation"]
OFFERING = ["code_module", "code_presentation"]

# The declared checks.
DECLARED = {
    "not_null_checks": [
        {"table": "student_info", "columns": [*ENROLMENT, "gender", "final_result"]},
        {"table": "student_assessment", "columns": ["id_assessment", "id_student", "score"]},
        {"table": "student_vle", "columns": ["id_student", "id_site", "date", "sum_click"]},
        {"table": "student_registration", "columns": ["id_student", "date_registration"]},
        {"table": "assessments", "columns": ["id_assessment", "assessment_type", "weight"]},
        {"table": "courses", "columns": OFFERING},
        {"table": "vle", "columns": ["id_site", "activity_type"]},
    ],
    "unique_checks": [
        {"table": "courses", "columns": OFFERING},
        {"table": "assessments", "columns": ["id_assessment"]},
        {"table": "vle", "columns": ["id_site"]},
    ],
    "referential_integrity": [
        {"child_table": "student_assessment", "child_column": "id_assessment",
         "parent_table": "assessments", "parent_column": "id_assessment"},
        {"child_table": "student_assessment", "child_column": "id_student",
         "parent_table": "student_info", "parent_column": "id_student"},
        {"child_table": "student_registration", "child_column": "id_student",
         "parent_table": "student_info", "parent_column": "id_student"},
        {"child_table": "student_vle", "child_column": "id_site",
         "parent_table": "vle", "parent_column": "id_site"},
        {"child_table": "student_vle", "child_column": "id_student",
         "parent_table": "student_info", "parent_column": "id_student"},
        {"child_table": "student_vle", "child_column": OFFERING,
         "parent_table": "courses", "parent_column": OFFERING},
    ],
    "range_checks": [
        {"table": "student_assessment", "column": "score", "min": 0, "max": 100},
        {"table": "assessments", "column": "weight", "min": 0, "max": 100},
        {"table": "student_vle", "column": "sum_click", "min": 0},
        {"table": "student_registration", "column": "date_registration", "min": -365, "max": 0},
        {"table": "assessments", "column": "date", "min": -365, "max": 365},
    ],
    "business_rules": [
        {"name": "valid_final_results", "table": "student_info", "column": "final_result",
         "allowed_values": FINAL_RESULTS, "severity": "critical"},
        {"name": "valid_activity_types", "table": "vle", "column": "activity_type",
         "allowed_values": RULE_ACTIVITY_TYPES, "severity": "warning"},
        {"name": "valid_assessment_types", "table": "assessments", "column": "assessment_type",
         "allowed_values": ASSESSMENT_TYPES, "severity": "critical"},
    ],
    "distribution_checks": [
        {"table": "student_info", "column": "gender", "profile_type": "categorical",
         "max_drift_percent": 5.0},
        {"table": "student_info", "column": "final_result", "profile_type": "categorical",
         "max_drift_percent": 5.0},
        {"table": "student_vle", "column": "sum_click", "profile_type": "numeric",
         "max_drift_zscore": 3.0},
    ],
    "custom_checks": [
        {"name": "is_banked_boolean", "table": "student_assessment", "column": "is_banked",
         "allowed_values": [0, 1], "severity": "warning"},
    ],
}

RULES = rules_from_mapping(DECLARED)

# The validator runs not-null, range and business value rules; the flag rule is declared apart.
DECLARED_ONLY = ("is_banked_boolean",)
EXECUTED = tuple(r for r in RULES.rows if r.name not in DECLARED_ONLY)

# Tests declared on the silver and gold models.
MODEL_UNIQUE = {
    "silver_courses": OFFERING,
    "dim_student": ENROLMENT,
    "dim_course": OFFERING,
}
MODEL_NOT_NULL = {
    "silver_courses": [*OFFERING, "length"],
    "silver_assessments": ["id_assessment", "assessment_type", "weight"],
    "silver_vle": ["id_site", "activity_type"],
    "silver_student_info": ["id_student", "final_result"],
    "silver_student_registration": ["id_student", "date_registration"],
    "silver_student_assessment": ["id_assessment", "id_student"],
    "silver_student_vle": ["id_student", "id_site", "date"],
    "dim_student": ["id_student"],
    "fact_student_interaction": ["id_student", "date"],
    "fact_student_assessment": ["id_student", "id_assessment", "score"],
    "fact_engagement_summary": ["id_student", "week_number"],
    "rpt_student_performance": ["id_student"],
    "rpt_quality_metrics": ["run_date", "table_name", "pass_rate"],
}
MODEL_ACCEPTED = {
    "silver_assessments": ("assessment_type", ASSESSMENT_TYPES),
    "silver_vle": ("activity_category",
                   ["communication", "content", "assessment", "reference", "tool", "other"]),
    "silver_student_info": ("final_result", FINAL_RESULTS),
    "silver_student_assessment": ("assessment_result", ["passed", "failed", "not_submitted"]),
}
