"""Registry of the seven base tables: columns, types, keys and personal fields."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

TEXT, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()


@dataclass(frozen=True)
class TableSpec:
    """One source file and the bronze table it becomes.

    ``columns`` maps column name to its stored type. A ``LONG`` column listed in
    ``zero_filled`` turns bad or missing cells into 0; every other numeric column
    keeps them as NULL.
    """

    source: str
    table: str
    columns: dict[str, T.DataType]
    pk: tuple[str, ...]
    aliases: dict[str, str]
    pii: tuple[str, ...] = ()
    zero_filled: tuple[str, ...] = ()

    @property
    def struct(self) -> T.StructType:
        fields = [T.StructField(n, t) for n, t in self.columns.items()]
        fields += [
            T.StructField("_ingested_at", T.TimestampType()),
            T.StructField("_source_file", TEXT),
        ]
        return T.StructType(fields)


_ENROLMENT_KEY = ("id_student", "code_module", "code_presentation")

# Source names, column names, key columns and personal fields of the data model.
SPECS: dict[str, TableSpec] = {
    s.source: s
    for s in (
        TableSpec(
            "courses", "courses",
            {"code_module": TEXT, "code_presentation": TEXT, "length": LONG},
            ("code_module", "code_presentation"),
            {"module_presentation_length": "length"},
            zero_filled=("length",),
        ),
        TableSpec(
            "assessments", "assessments",
            {"code_module": TEXT, "code_presentation": TEXT, "id_assessment": LONG,
             "assessment_type": TEXT, "date": LONG, "weight": DOUBLE},
            ("id_assessment",), {}, zero_filled=("id_assessment", "date"),
        ),
        TableSpec(
            "vle", "vle",
            {"id_site": LONG, "code_module": TEXT, "code_presentation": TEXT,
             "activity_type": TEXT, "week_from": LONG, "week_to": LONG},
            ("id_site",), {}, zero_filled=("id_site", "week_from", "week_to"),
        ),
        TableSpec(
            "studentInfo", "student_info",
            {"code_module": TEXT, "code_presentation": TEXT, "id_student": LONG,
             "gender": TEXT, "region": TEXT, "highest_education": TEXT, "imd_band": TEXT,
             "age_band": TEXT, "num_of_prev_attempts": LONG, "studied_credits": LONG,
             "disability": TEXT, "final_result": TEXT},
            _ENROLMENT_KEY, {}, pii=("region", "imd_band"),
            zero_filled=("id_student", "num_of_prev_attempts", "studied_credits"),
        ),
        TableSpec(
            "studentRegistration", "student_registration",
            {"code_module": TEXT, "code_presentation": TEXT, "id_student": LONG,
             "date_registration": LONG, "date_unregistration": DOUBLE},
            _ENROLMENT_KEY, {}, zero_filled=("id_student", "date_registration"),
        ),
        TableSpec(
            "studentAssessment", "student_assessment",
            {"id_assessment": LONG, "id_student": LONG, "date_submitted": LONG,
             "is_banked": LONG, "score": DOUBLE},
            ("id_assessment", "id_student"), {}, zero_filled=("id_assessment", "id_student"),
        ),
        TableSpec(
            "studentVle", "student_vle",
            {"code_module": TEXT, "code_presentation": TEXT, "id_student": LONG,
             "id_site": LONG, "date": LONG, "sum_click": LONG},
            ("id_student", "id_site", "date"), {},
            zero_filled=("id_student", "id_site", "date", "sum_click"),
        ),
    )
}

BY_TABLE: dict[str, TableSpec] = {s.table: s for s in SPECS.values()}


def spec_for(source: str) -> TableSpec:
    """Spec of a source name; an unknown name is a caller error."""
    if source not in SPECS:
        raise ValueError(f"unknown table {source!r}, expected one of {sorted(SPECS)}")
    return SPECS[source]


# Side tables written by the pipeline.
INGESTION_LOG = T.StructType([
    T.StructField("table_name", TEXT, False),
    T.StructField("file_name", TEXT, False),
    T.StructField("row_count", LONG, False),
    T.StructField("errors", TEXT),
    T.StructField("_ingested_at", T.TimestampType(), False),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_merged", T.LongType()),
])

AUDIT_EVENT = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("principal", TEXT),
    T.StructField("action", TEXT),
    T.StructField("resource", TEXT),
    T.StructField("detail", TEXT),
])
