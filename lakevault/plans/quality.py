"""Assertions, model tests and declared checks over the warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault import functions as L
from lakevault.operators import integrity, rules
from lakevault.plans import rulebook
from lakevault.plans.bronze import FINAL_RESULTS
from lakevault.plans.catalog import MODELS, Tables

OFFERING = ["code_module", "code_presentation"]
WEIGHT_SUM, WEIGHT_TOLERANCE = 100, 1


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _source(t: Tables, table: str, on: str) -> DataFrame:
    """The bronze view, or the unfiltered table behind it with ``on="raw"``.

    Some views already drop the rows an assertion looks for, so on the views these can never
    fire; on the raw tables they can.
    """
    if on not in ("view", "raw"):
        raise ValueError(f"on must be 'view' or 'raw', not {on!r}")
    return t[table] if on == "raw" else t[f"bronze_{table}"]


def assert_accepted_values(t: Tables, on: str = "view") -> DataFrame:
    """Failing rows ``(check_name, id, value)``; NULL is accepted."""
    checks = [
        ("invalid_final_result", "student_info", "id_student", "final_result", FINAL_RESULTS),
        ("invalid_assessment_type", "assessments", "id_assessment", "assessment_type",
         rulebook.ASSESSMENT_TYPES),
        ("invalid_activity_type", "vle", "id_site", "activity_type",
         rulebook.ASSERTED_ACTIVITY_TYPES),
    ]
    return _union([
        _source(t, table, on).filter(~F.col(value).isin(accepted)).select(
            F.lit(check).alias("check_name"), F.col(key).alias("id"), F.col(value).alias("value"))
        for check, table, key, value, accepted in checks
    ])


def assert_range_checks(t: Tables, on: str = "view") -> DataFrame:
    """Failing rows ``(check_name, id, value)`` of the score, weight and click ranges."""
    checks = [
        ("score_out_of_range", "student_assessment", "id_assessment", "score",
         "score < 0 or score > 100"),
        ("weight_out_of_range", "assessments", "id_assessment", "weight",
         "weight < 0 or weight > 100"),
        ("negative_sum_click", "student_vle", "id_student", "sum_click", "sum_click < 0"),
    ]
    return _union([
        _source(t, table, on).filter(bad).select(
            F.lit(check).alias("check_name"), F.col(key).alias("id"),
            F.col(value).cast("string").alias("value"))
        for check, table, key, value, bad in checks
    ])


def assert_referential_integrity(t: Tables) -> DataFrame:
    """Orphan rows ``(check_name, value)`` of three references between the bronze views."""
    checks = [
        ("orphan_student_assessment_assessment", "student_assessment", "assessments",
         "id_assessment"),
        ("orphan_student_vle_site", "student_vle", "vle", "id_site"),
        ("orphan_registration_student", "student_registration", "student_info", "id_student"),
    ]
    return _union([
        integrity.orphans(t[f"bronze_{child}"].select(key), [key], t[f"bronze_{parent}"], [key])
        .select(F.lit(check).alias("check_name"), F.col(key).cast("string").alias("value"))
        for check, child, parent, key in checks
    ])


def assert_unique(t: Tables) -> DataFrame:
    """The inline unique-key assertions of the models ``(model, test, columns, failed)``."""
    return _union([
        integrity.unique_check(t[m.name], m.name, m.unique) for m in MODELS.values() if m.unique])


def assert_non_null(t: Tables) -> DataFrame:
    """The inline non-null assertions of the vault models, one pass per model."""
    return _union([
        integrity.non_null_check(t[m.name], m.name, m.non_null)
        for m in MODELS.values() if m.non_null])


def model_tests(t: Tables) -> DataFrame:
    """The tests declared on silver and gold models, with the verdict per test."""
    parts = [
        integrity.unique_check(t[name], name, key, ignore_null=True)
        for name, key in rulebook.MODEL_UNIQUE.items()
    ]
    parts += [
        integrity.column_tests(t[name], name, columns, rulebook.MODEL_ACCEPTED.get(name))
        for name, columns in rulebook.MODEL_NOT_NULL.items()
    ]
    return _union(parts).withColumn("success", F.col("failed") == 0)


def weight_sum(assessments: DataFrame) -> DataFrame:
    """Offerings whose weights do not add up to 100 (by more than 1) or that have no exam."""
    per_offering = assessments.groupBy(*OFFERING).agg(
        F.sum(F.col("weight").cast(L.EXACT)).cast("double").alias("total_weight"),
        F.count_if(F.col("assessment_type") == "Exam").alias("exams"),
    )
    off = F.abs(F.col("total_weight") - WEIGHT_SUM) > WEIGHT_TOLERANCE
    return per_offering.filter(off | (F.col("exams") == 0))


def no_future_dates(assessments: DataFrame, courses: DataFrame) -> DataFrame:
    """Assessments due after the end of their offering.

    The declared rule compares with a column courses does not have; the length of the offering
    is what its day offsets can be held against.
    """
    length = courses.filter("length is not null").select(*OFFERING, "length")
    return assessments.join(length, OFFERING).filter("date > length").select(
        "id_assessment", *OFFERING, "date", "length")


def raw_tables(t: Tables) -> Mapping[str, DataFrame]:
    """The seven base tables by name, the input of the declared rules."""
    names = ["student_info", "student_assessment", "student_vle", "student_registration",
             "assessments", "courses", "vle"]
    return {n: t[n] for n in names}


def validate_silver(t: Tables) -> DataFrame:
    """The executed rules on the silver models, as far as these carry the columns."""
    tables = {name: t[f"silver_{name}"] for name in raw_tables(t)}
    return rules.validate_all(tables, rules.applicable(tables, rulebook.EXECUTED), "silver")


def _outcomes(rows: DataFrame, layer: str, severity: str) -> DataFrame:
    """(table_name, rule, column, evaluated_rows, failed_rows) rows as outcomes like those of rules."""
    return rows.select(
        "table_name", F.lit(layer).alias("layer"), "rule", "column", F.lit(severity).alias("severity"),
        "evaluated_rows", "failed_rows", (F.col("failed_rows") == 0).alias("success"))


def _counted(failing: DataFrame, evaluated: DataFrame, table: str, rule: str, column: str) -> DataFrame:
    """One outcome from the failing rows of a check and the rows it looked at."""
    looked = evaluated.agg(F.count(F.lit(1)).alias("evaluated_rows")).withColumn("failed_rows", F.lit(0))
    bad = failing.agg(F.count(F.lit(1)).alias("failed_rows")).withColumn("evaluated_rows", F.lit(0))
    return looked.unionByName(bad).agg(
        F.sum("evaluated_rows").alias("evaluated_rows"), F.sum("failed_rows").alias("failed_rows")
    ).select(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"),
             F.lit(column).alias("column"), "evaluated_rows", "failed_rows")


#: Assertions on bronze views by the rule they are an outcome of: column and table.
_ASSERTED = {
    "invalid_final_result": ("student_info", "final_result"),
    "invalid_assessment_type": ("assessments", "assessment_type"),
    "invalid_activity_type": ("vle", "activity_type"),
    "score_out_of_range": ("student_assessment", "score"),
    "weight_out_of_range": ("assessments", "weight"),
    "negative_sum_click": ("student_vle", "sum_click"),
}


def validate_assertions(t: Tables) -> DataFrame:
    """The outcomes of the value and range assertions on the bronze views, of which all are
    critical: in the models they stop whatever depends on them."""
    failing = assert_accepted_values(t).select("check_name").unionByName(
        assert_range_checks(t).select("check_name")).groupBy("check_name").agg(
        F.count(F.lit(1)).alias("failed_rows")).withColumn("evaluated_rows", F.lit(0))
    tables = list(dict.fromkeys(table for table, _ in _ASSERTED.values()))
    looked = _union([
        t[f"bronze_{table}"].agg(F.count(F.lit(1)).alias("evaluated_rows")).select(
            F.explode(F.array(*[F.lit(c) for c, (of, _) in _ASSERTED.items() if of == table])).alias(
                "check_name"), F.lit(0).alias("failed_rows"), "evaluated_rows")
        for table in tables])
    names = F.create_map(*[F.lit(x) for c, (table, _) in _ASSERTED.items() for x in (c, table)])
    columns = F.create_map(*[F.lit(x) for c, (_, column) in _ASSERTED.items() for x in (c, column)])
    counted = failing.unionByName(looked).groupBy("check_name").agg(
        F.sum("evaluated_rows").alias("evaluated_rows"), F.sum("failed_rows").alias("failed_rows"))
    return _outcomes(counted.select(
        names[F.col("check_name")].alias("table_name"), F.col("check_name").alias("rule"),
        columns[F.col("check_name")].alias("column"), "evaluated_rows", "failed_rows"),
        "bronze", "critical")


def validate_references(t: Tables) -> DataFrame:
    """The outcomes of the declared references, all in one pass; an orphan is critical."""
    refs = rulebook.RULES.references
    told = F.create_map(*[F.lit(x) for r in refs for x in (r.label, F.array(
        F.lit(r.child), F.lit(f"references {r.parent}"), F.lit(",".join(r.child_columns))))])
    parts = told[F.col("rule")]
    totals = integrity.reference_totals(raw_tables(t), refs)
    return _outcomes(totals.select(
        parts[0].alias("table_name"), parts[1].alias("rule"), parts[2].alias("column"),
        F.col("child_rows").alias("evaluated_rows"), F.col("orphan_rows").alias("failed_rows")),
        "bronze", "critical")


def validate_declared(t: Tables) -> DataFrame:
    """The outcomes of the declared checks that take more than a row: unique keys and due dates
    (critical), weight sums (a warning, as declared)."""
    keys = rulebook.RULES.unique
    unique = _outcomes(_union([
        _counted(integrity.duplicate_keys(t[table], key), t[table], table, "unique", ",".join(key))
        for table, key in keys.items()]), "bronze", "critical")
    due = _outcomes(_counted(no_future_dates(t["assessments"], t["courses"]), t["assessments"],
                             "assessments", "no_future_dates", "date"), "bronze", "critical")
    weights = _outcomes(_counted(
        weight_sum(t["assessments"]), t["assessments"].select(*OFFERING).distinct(),
        "assessments", "assessment_weight_sum", "weight"), "bronze", "warning")
    return _union([unique, due, weights])


def validate_bronze(t: Tables) -> DataFrame:
    """Everything that is declared or asserted on the base tables and their views."""
    rows = rules.validate_all(raw_tables(t), rulebook.EXECUTED)
    return _union([rows, validate_assertions(t), validate_references(t), validate_declared(t)])


def validate_vault(t: Tables) -> DataFrame:
    """The inline unique and non-null assertions of the vault models as outcomes."""
    tests = assert_unique(t).unionByName(assert_non_null(t))
    rows = _union([t[m.name].agg(F.count(F.lit(1)).alias("evaluated_rows")).select(
        F.lit(m.name).alias("model"), "evaluated_rows")
        for m in MODELS.values() if m.unique or m.non_null])
    return _outcomes(tests.join(rows, "model").select(
        F.col("model").alias("table_name"), F.col("test").alias("rule"),
        F.col("columns").alias("column"), "evaluated_rows", F.col("failed").alias("failed_rows")),
        "dv", "critical")
