"""Every operator as a named query over one folder of supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakevault import functions as L
from lakevault.given import (
    DETECTED_AT,
    FIRST_LOAD_BEFORE,
    LOAD_TS,
    SECOND_LOAD_TS,
    Given,
    second_load,
)
from lakevault.operators import anomaly, drift, ingest, integrity, profile, rules
from lakevault.operators.incremental import (
    append_new_versions,
    latest_version,
    newer_than_stored,
    upsert_by_key,
)
from lakevault.plans import (
    MODELS,
    Model,
    Tables,
    Unhashed,
    business,
    dashboards,
    engagement_state,
    metrics,
    quality,
    rulebook,
)
from lakevault.schemas import SPECS
from lakevault.sources import audit, csv_files
from lakevault.sources.bucketed import BucketedVault, as_bytes, as_hex
from lakevault.sources.shared import new_path
from lakevault.sources.warehouse import COMPRESSION, Warehouse
from lakevault.streaming import landing, repeats, vault, weekly

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_DATE = date(2024, 1, 1)
NOW = datetime(2024, 1, 1, 17, 30, 0)
AUDIT_DAY = "2024-01-16"
STORED_UNTIL = "2024-01-20"


def query(fn: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
    """Register a function of :class:`Given` under its own name."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Given(spark, sf_dir))
    return fn


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Statistics rounded for comparison: their last digits depend on the summation order."""
    return df.withColumns({c: L.round_half_up(F.col(c), digits) for c in cols})


# --- models of every layer -----------------------------------------------------------------

def _model_query(name: str) -> Query:
    return lambda spark, sf_dir: Given(spark, sf_dir).tables()[name]


for _name in MODELS:
    QUERIES[_name] = _model_query(_name)


# --- ingestion -----------------------------------------------------------------------------

def _ingested(g: Given, source: str, **options) -> DataFrame:
    spec = SPECS[source]
    raw = ingest.clean_header(g.text[source], spec)
    return ingest.to_bronze(raw, spec, LOAD_TS, f"{source}.csv", **options)


@query
def ingest_courses(g: Given) -> DataFrame:
    return _ingested(g, "courses")


@query
def ingest_registration(g: Given) -> DataFrame:
    return _ingested(g, "studentRegistration")


@query
def ingest_clicks(g: Given) -> DataFrame:
    return _ingested(g, "studentVle")


def _load_counts(g: Given) -> DataFrame:
    return union([
        _ingested(g, source).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(source).alias("source"), "rows",
            F.lit("; ".join(ingest.schema_errors(
                ingest.clean_header(g.text[source], spec).columns, spec)) or None)
            .cast("string").alias("errors"))
        for source, spec in SPECS.items()
    ])


@query
def ingest_summary(g: Given) -> DataFrame:
    return _load_counts(g).withColumnRenamed("source", "table")


@query
def ingestion_log(g: Given) -> DataFrame:
    names = F.create_map(*[F.lit(x) for s in SPECS.values() for x in (s.source, s.table)])
    return _load_counts(g).select(
        names[F.col("source")].alias("table_name"),
        F.concat("source", F.lit(".csv")).alias("file_name"),
        F.col("rows").alias("row_count"), "errors",
        F.lit(LOAD_TS).cast("timestamp").alias("_ingested_at"))


@query
def schema_check(g: Given) -> DataFrame:
    """Supplied tables offered as sources: every header problem and the rows rejected for it."""
    offered = {
        "courses": g.text["courses"], "studentInfo": g.parquet("customer"),
        "studentVle": g.text["studentVle"].withColumnRenamed("date", "clicked_on"),
    }
    problems = ingest.schema_check(g.spark, {s: df.columns for s, df in offered.items()}, SPECS)
    rows = union([
        df.agg(F.count(F.lit(1)).alias("rejected_rows")).withColumn("table", F.lit(source))
        for source, df in offered.items()])
    return problems.join(rows, "table")


@query
def coerce_numeric(g: Given) -> DataFrame:
    """Text cells of many shapes to integers (0 or NULL when bad) and doubles."""
    n, qty = F.col("l_linenumber"), F.col("l_quantity").cast("bigint").cast("string")
    clicks = (
        F.when(n == 1, qty).when(n == 2, "NA").when(n == 3, "?")
        .when(n == 4, F.concat(F.lit(" "), qty, F.lit(" ")))
        .when(n == 5, F.concat(qty, F.lit(".7"))).when(n == 6, F.concat(qty, F.lit("d")))
        .when(n == 7, F.concat(F.lit("90071992547410"), F.lpad(qty, 2, "0")))
    )
    score = (
        F.when(n == 1, F.concat(qty, F.lit(".5"))).when(n == 2, "NaN").when(n == 3, "x")
        .when(n == 4, F.concat(F.lit(" "), qty))
        .when(n == 5, F.concat(F.lit("-"), qty, F.lit(".25")))
        .when(n == 6, F.concat(qty, F.lit("F"))).when(n == 7, "")
    )
    return g.parquet("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", clicks.alias("a"), score.alias("b"),
    ).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        L.to_long_or_zero(F.col("a")).alias("sum_click"),
        L.to_long(F.col("a")).alias("date_submitted"),
        L.to_double(F.col("b")).alias("score"))


@query
def dedup_sum_clicks(g: Given) -> DataFrame:
    return ingest.dedup_sum(g.clicks_in_order, SPECS["studentVle"].pk, "line")


@query
def dedup_null_sum(g: Given) -> DataFrame:
    return rounded(_summed_submissions(g, "zero"), "score", digits=4)


@query
def dedup_null_sum_keep(g: Given) -> DataFrame:
    return rounded(_summed_submissions(g, "keep"), "score", digits=4)


def _summed_submissions(g: Given, null_sum: str) -> DataFrame:
    return ingest.dedup_sum(g.student_assessment_dup, SPECS["studentAssessment"].pk, "line",
                            null_sum)


@query
def pii_hash(g: Given) -> DataFrame:
    spec = SPECS["studentInfo"]
    return ingest.pseudonymise(g.student_info_named, spec.pii).select(*spec.pk, *spec.pii)


# --- incremental loads ---------------------------------------------------------------------

def _loads(g: Given) -> tuple[Tables, Tables]:
    first = Given(g.spark, g.sf_dir, FIRST_LOAD_BEFORE).tables()
    return first, Tables(second_load(g), SECOND_LOAD_TS)


def _after_two_loads(g: Given, all_versions: bool) -> Tables:
    """Tables whose vault went through both loads; their keys meet as bytes, half their digits, and
    where a model is known unhashed they are taken where they meet."""
    first, second = _loads(g)

    def merged(m: Model) -> DataFrame | Unhashed:
        made = [t.unhashed(m.name) for t in (first, second)]
        if all(made):
            old, new = (rows.placed(m.key[0], _no_key(rows, load)) for load, rows in enumerate(made))
        else:
            old, new = as_bytes(first[m.name]), as_bytes(second[m.name])
        both = upsert_by_key(old, new, m.key) if m.kind == "upsert" else append_new_versions(
            old, new, m.key[0])
        if all(made):
            return Unhashed(both.drop(*made[1].hashes), made[1].hashes, made[1].columns,
                            made[1].repeats)
        return as_hex(both)

    stored = {m.name: partial(merged, m) for m in MODELS.values() if m.kind in ("upsert", "append")}
    return second.with_frames(stored, all_versions=all_versions)


def _no_key(rows: Unhashed, load: int) -> Column:
    """Bytes in place of a NULL key: none of a key's length, and others in each load, since a NULL key
    meets none."""
    digits = F.lpad(F.hex(F.xxhash64(*rows.parts)), 16, "0")
    known = F.concat(F.lit(bytearray([load])), F.unhex(digits))
    return F.coalesce(known, F.lit(bytearray([load])))  # known never to be NULL


@query
def hub_upsert_2nd_load(g: Given) -> DataFrame:
    """The student hub after a batch with the later orders: kept, restamped and new students."""
    first = Given(g.spark, g.sf_dir, orders_before=FIRST_LOAD_BEFORE).tables()
    batch = Given(g.spark, g.sf_dir, orders_from=FIRST_LOAD_BEFORE).tables(SECOND_LOAD_TS)
    return upsert_by_key(first["hub_student"], batch["hub_student"], ["hk_student"])


@query
def sat_append_2nd_load(g: Given) -> DataFrame:
    return _after_two_loads(g, False)["sat_assessment_details"]


@query
def sat_details_2nd_load(g: Given) -> DataFrame:
    return _after_two_loads(g, False)["sat_student_details"]


@query
def latest_student_details(g: Given) -> DataFrame:
    return latest_version(_after_two_loads(g, False)["sat_student_details"], "hk_student")


@query
def bv_course_offering_2nd_load(g: Given) -> DataFrame:
    return _after_two_loads(g, False)["bv_course_offering"]


@query
def bv_course_offering_all_versions(g: Given) -> DataFrame:
    return _after_two_loads(g, True)["bv_course_offering"]


@query
def bv_student_assessment_all_versions(g: Given) -> DataFrame:
    return _after_two_loads(g, True)["bv_student_assessment"]


@query
def bv_engagement_weekly_all_versions(g: Given) -> DataFrame:
    """Weekly engagement joined to every site version; half the sites get a second version."""
    t = g.tables()
    moved = F.when(F.col("week_from") % 2 == 0, F.col("week_to") + 1).otherwise(F.col("week_to"))
    later = Tables({"vle": g.vle.withColumn("week_to", moved)}, SECOND_LOAD_TS)
    sat = append_new_versions(t["sat_vle_details"], later["sat_vle_details"], "hk_vle")
    return t.with_frames({"sat_vle_details": sat}, all_versions=True)["bv_engagement_weekly"]


@query
def metrics_guard(g: Given) -> DataFrame:
    """A re-run of all days against a table that holds the first ones: only later days enter."""
    history = g.metrics_history
    stored = history.filter(F.col("run_date") <= F.lit(STORED_UNTIL).cast("date"))
    again = history.withColumn("expectations_evaluated", F.col("expectations_evaluated") + 1)
    return upsert_by_key(stored, newer_than_stored(again, stored), metrics.METRIC_KEY).select(
        *metrics.METRIC_KEY, "expectations_evaluated")


@query
def bv_quality_metrics(g: Given) -> DataFrame:
    return business.bv_quality_metrics(g.tables(), RUN_DATE)


@query
def fact_engagement_2nd_load(g: Given) -> DataFrame:
    """Weekly engagement refreshed load by load: the clicks of the earlier orders, then the later."""
    warehouse = Warehouse(g.spark, new_path(g.spark, "refreshed"))
    sites = g.tables()["silver_vle"]
    loads = ({"orders_before": FIRST_LOAD_BEFORE}, {"orders_from": FIRST_LOAD_BEFORE})
    for number, part in enumerate(loads):
        clicks = Given(g.spark, g.sf_dir, **part).tables()["bronze_student_vle"]
        engagement_state.refresh(warehouse, clicks, sites, number)
    return warehouse.read(engagement_state.LAYER, engagement_state.ROLLUP)


@query
def sat_append_bucketed(g: Given) -> DataFrame:
    """The assessment satellite after both loads, stored in buckets of its key."""
    stored = BucketedVault(g.spark, new_path(g.spark, "buckets"), buckets=8)
    for t in _loads(g):
        stored.load(t["sat_assessment_details"], "sat_assessment_details")
    return as_hex(stored.read("sat_assessment_details"))


@query
def bv_student_assessment_bucketed(g: Given) -> DataFrame:
    """Submissions from hubs, a link and satellites stored in buckets of their keys."""
    stored, t = BucketedVault(g.spark, new_path(g.spark, "buckets"), buckets=8), g.tables()
    names = ["link_student_assessment", "sat_student_assessment_result", "hub_student",
             "hub_assessment", "sat_assessment_details"]
    for name in names:
        stored.load(t.unhashed(name) or t[name], name)
    return stored.tables(t, names)["bv_student_assessment"]


# --- streams -------------------------------------------------------------------------------

#: Longer than the supplied clicks span: no click is late.
NEVER_LATE = "20000 days"
LATE_AFTER = "1000 days"


class Landing:
    """A folder in which files land, the checkpoint of a stream over it and a warehouse."""

    def __init__(self, g: Given, name: str):
        self.spark, self.root = g.spark, new_path(g.spark, name)
        self.folder, self.checkpoint = f"{self.root}/landing", f"{self.root}/checkpoint"
        self.warehouse = Warehouse(g.spark, f"{self.root}/warehouse")
        #: Files that land together: a part of the rows is written and read by as many tasks.
        self.width = g.spark.sparkContext.defaultParallelism

    def land(self, rows: DataFrame, parts: int) -> StructType:
        rows.repartition(parts * self.width).write.mode("append").option(
            "compression", COMPRESSION).parquet(self.folder)
        return rows.schema

    def stream(self, schema: StructType, parts_per_batch: int | None = None) -> DataFrame:
        files = parts_per_batch * self.width if parts_per_batch else None
        return landing.landed(self.spark, self.folder, schema, files_per_batch=files)


@query
def stream_txn_student_vle_click(g: Given) -> DataFrame:
    """The click transactions, taken from landed files one part at a time in two runs."""
    at = Landing(g, "stream_txn")
    sink = vault.into_vault(at.warehouse.root, "student_vle", ["txn_student_vle_click"], LOAD_TS)
    for late in (False, True):
        schema = at.land(g.student_vle.filter((F.col("id_site") % 5 == 0) == F.lit(late)), 2)
        landing.drain(at.stream(schema, 1), sink, at.checkpoint)
    return at.warehouse.read("dv", "txn_student_vle_click")


@query
def stream_sat_append_2nd_load(g: Given) -> DataFrame:
    """The assessment satellite after both loads landed as files."""
    at = Landing(g, "stream_sat")
    loads = ((g.assessments, LOAD_TS), (second_load(g)["assessments"](), SECOND_LOAD_TS))
    for rows, load_ts in loads:
        schema = at.land(rows, 2)
        landing.drain(at.stream(schema, 1), vault.into_vault(
            at.warehouse.root, "assessments", ["sat_assessment_details"], load_ts), at.checkpoint)
    return at.warehouse.read("dv", "sat_assessment_details")


def _weekly(at: Landing, schema: StructType, delay: str, parts_per_batch: int | None) -> None:
    clicks = Tables({"student_vle": at.stream(schema, parts_per_batch)}, LOAD_TS)
    landing.drain(weekly.states(clicks["bronze_student_vle"], delay),
                  weekly.into_states(at.warehouse.root), at.checkpoint, "update")


@query
def stream_engagement_weekly(g: Given) -> DataFrame:
    """Weekly engagement from clicks that land in no order, a part a batch."""
    at = Landing(g, "stream_weekly")
    _weekly(at, at.land(g.student_vle, 3), NEVER_LATE, 1)
    return engagement_state.summary(at.warehouse.read(weekly.LAYER, weekly.NAME),
                                    g.tables()["silver_vle"])


@query
def stream_late_clicks(g: Given) -> DataFrame:
    """Clicks of some sites land after all others; those of weeks closed by then are counted."""
    at = Landing(g, "stream_late")
    for straggler in (False, True):
        chosen = g.student_vle.filter((F.col("id_site") % 7 == 0) == F.lit(straggler))
        _weekly(at, at.land(chosen, 2), LATE_AFTER, None)
    return weekly.late_clicks(g.tables()["bronze_student_vle"],
                              at.warehouse.read(weekly.LAYER, weekly.NAME))


@query
def stream_dedup_sum_clicks(g: Given) -> DataFrame:
    """Clicks with repeated keys, landing in two halves that share many keys, summed as they come."""
    at, key = Landing(g, "stream_dedup"), SPECS["studentVle"].pk
    for half in (0, 1):
        schema = at.land(g.clicks_in_order.filter(F.pmod("sum_click", F.lit(2)) == half), 1)
        landing.drain(repeats.summed(at.stream(schema), key, "line"),
                      repeats.into_log(at.warehouse.root, "bronze", "clicks_log"),
                      at.checkpoint, "update")
    return repeats.newest(at.warehouse.read("bronze", "clicks_log"), key)


# --- assertions and rules ------------------------------------------------------------------

@query
def assert_accepted_values(g: Given) -> DataFrame:
    return quality.assert_accepted_values(g.tables())


@query
def assert_accepted_values_raw(g: Given) -> DataFrame:
    return quality.assert_accepted_values(g.tables(), on="raw")


@query
def assert_range_checks(g: Given) -> DataFrame:
    return quality.assert_range_checks(g.tables())


@query
def assert_range_checks_raw(g: Given) -> DataFrame:
    return quality.assert_range_checks(g.tables(), on="raw")


@query
def assert_referential_integrity(g: Given) -> DataFrame:
    return quality.assert_referential_integrity(g.tables())


@query
def assert_unique(g: Given) -> DataFrame:
    """The models' own assertions, and the same check on the registrations before ingestion."""
    return quality.assert_unique(g.tables()).unionByName(integrity.unique_check(
        g.registration_dup, "registration_dup", SPECS["studentRegistration"].pk))


@query
def assert_non_null(g: Given) -> DataFrame:
    return quality.assert_non_null(g.tables())


def _results(t: Tables) -> DataFrame:
    return rules.validate_all(quality.raw_tables(t), rulebook.EXECUTED)


def _run_metrics(t: Tables, tests: DataFrame) -> DataFrame:
    return metrics.measured(quality.raw_tables(t), DETECTED_AT, RUN_DATE, _results(t), tests)


def _tests(t: Tables) -> DataFrame:
    """Model tests; the metrics model under test is the history table."""
    return quality.model_tests(t)


@query
def model_tests(g: Given) -> DataFrame:
    return _tests(_with_history(g))


def _with_history(g: Given) -> Tables:
    return Tables(g.base | {"rpt_quality_metrics": lambda: g.metrics_history}, LOAD_TS)


def _rule_group(g: Given, keep: Callable[[rules.Rule], bool]) -> DataFrame:
    chosen = [r for r in rulebook.RULES.rows if keep(r)]
    named = {r.table for r in chosen}
    tables = {n: df for n, df in quality.raw_tables(g.tables()).items() if n in named}
    return rules.validate_all(tables, chosen)


@query
def rules_not_null(g: Given) -> DataFrame:
    return _rule_group(g, lambda r: r.kind == "not_null")


@query
def rules_range(g: Given) -> DataFrame:
    return _rule_group(g, lambda r: r.kind == "range")


@query
def rules_allowed(g: Given) -> DataFrame:
    return _rule_group(g, lambda r: r.kind == "allowed")


@query
def rules_unique(g: Given) -> DataFrame:
    return integrity.unique_counts(quality.raw_tables(g.tables()), rulebook.RULES.unique)


@query
def rules_unique_raw(g: Given) -> DataFrame:
    """The same counter on the sources that do hold repeated keys."""
    return integrity.unique_counts(
        {"registration_dup": g.registration_dup, "assessment_dup": g.student_assessment_dup,
         "student_vle": g.student_vle},
        {"registration_dup": SPECS["studentRegistration"].pk,
         "assessment_dup": SPECS["studentAssessment"].pk, "student_vle": SPECS["studentVle"].pk})


@query
def rules_ri(g: Given) -> DataFrame:
    return integrity.reference_counts(quality.raw_tables(g.tables()), rulebook.RULES.references)


@query
def rule_weight_sum(g: Given) -> DataFrame:
    return quality.weight_sum(g.assessments)


@query
def rule_no_future_dates(g: Given) -> DataFrame:
    return quality.no_future_dates(g.assessments, g.courses)


@query
def drift_categorical(g: Given) -> DataFrame:
    out = drift.categorical(*g.drift_frames, "event_type", 5.0)
    return rounded(out, "baseline_pct", "current_pct", "drift_pct")


@query
def drift_final_result(g: Given) -> DataFrame:
    """Outcomes of enrolments starting before 2000 against the later ones."""
    info = g.student_info
    early = F.col("code_presentation") < "2000"
    out = drift.categorical(info.filter(early), info.filter(~early), "final_result", 5.0)
    return rounded(out, "baseline_pct", "current_pct", "drift_pct")


@query
def rules_drift(g: Given) -> DataFrame:
    """The declared drift checks: presentations and click days of the earlier half against the
    later."""
    early = {"student_info": F.col("code_presentation") < "2000",
             "student_vle": F.col("code_presentation") < "2000"}
    loads = [{name: getattr(g, name).filter(c if first else ~c) for name, c in early.items()}
             for first in (True, False)]
    return rounded(drift.run(*loads, rulebook.RULES.drift), "drift")


@query
def drift_from_profiles(g: Given) -> DataFrame:
    """The same checks from stored profiles alone: the earlier load's in two parts, merged."""
    warehouse, checks = Warehouse(g.spark, new_path(g.spark, "profiles")), rulebook.RULES.drift
    early, odd = F.col("code_presentation") < "2000", F.col("id_student") % 2 == 1
    for name, kept in (("early_odd", early & odd), ("early_even", early & ~odd), ("late", ~early)):
        rows = {c.table: getattr(g, c.table).filter(kept) for c in checks}
        warehouse.overwrite(profile.profile(rows, checks), "quality", name)
    before = profile.merged(*(warehouse.read("quality", n) for n in ("early_odd", "early_even")))
    return rounded(profile.drift(before, warehouse.read("quality", "late"), checks), "drift")


@query
def drift_numeric(g: Given) -> DataFrame:
    out = drift.numeric(*g.drift_frames, "value", 3.0)
    return rounded(out, "baseline_mean", "baseline_std", "current_mean", "drift_z")


@query
def validate_table(g: Given) -> DataFrame:
    return rules.validate_table(g.student_assessment, "student_assessment", rulebook.EXECUTED)


@query
def validate_all(g: Given) -> DataFrame:
    return _results(g.tables())


@query
def validate_silver(g: Given) -> DataFrame:
    return quality.validate_silver(g.tables())


@query
def quality_summary(g: Given) -> DataFrame:
    return rules.summarize(_results(g.tables()))


@query
def quality_summary_tables(g: Given) -> DataFrame:
    return rules.summarize_tables(_results(g.tables()))


@query
def quality_top_failures(g: Given) -> DataFrame:
    return rules.top_failures(_results(g.tables()))


# --- anomalies and audit -------------------------------------------------------------------

@query
def click_anomalies(g: Given) -> DataFrame:
    return rounded(anomaly.click_anomalies(g.student_vle, DETECTED_AT), "anomaly_score")


@query
def click_anomalies_per_course(g: Given) -> DataFrame:
    return rounded(anomaly.click_anomalies_per_course(g.student_vle, DETECTED_AT), "anomaly_score")


@query
def score_anomalies(g: Given) -> DataFrame:
    """On the submissions with repeated keys summed: only these scores leave the fences."""
    flagged = anomaly.score_anomalies(_summed_submissions(g, "zero"), DETECTED_AT)
    return rounded(flagged, "score", digits=4)


@query
def vle_before_registration(g: Given) -> DataFrame:
    return anomaly.vle_before_registration(g.student_vle, g.student_registration)


@query
def assessment_before_registration(g: Given) -> DataFrame:
    return anomaly.assessment_before_registration(g.student_assessment, g.student_registration)


@query
def assessment_before_registration_strict(g: Given) -> DataFrame:
    return anomaly.assessment_before_registration_strict(
        g.student_assessment, g.assessments, g.student_registration)


@query
def activity_after_unregistration(g: Given) -> DataFrame:
    return anomaly.activity_after_unregistration(g.student_vle, g.student_registration)


@query
def zero_activity_exam(g: Given) -> DataFrame:
    return anomaly.zero_activity_exam(g.student_assessment, g.assessments, g.student_vle)


@query
def registration_window(g: Given) -> DataFrame:
    return anomaly.outside_registration_window(g.student_registration)


@query
def anomaly_flags(g: Given) -> DataFrame:
    return rounded(anomaly.detect_all(
        DETECTED_AT, g.student_vle, g.student_assessment, g.student_registration), "score")


def _summary(g: Given) -> DataFrame:
    return anomaly.summary(DETECTED_AT, g.student_vle, g.student_assessment,
                           g.student_registration)


@query
def anomaly_summary(g: Given) -> DataFrame:
    return _summary(g)


@query
def anomaly_total(g: Given) -> DataFrame:
    return anomaly.total(_summary(g))


@query
def anomaly_samples(g: Given) -> DataFrame:
    flags = anomaly.detect_all(DETECTED_AT, g.student_vle, g.student_assessment)
    return rounded(anomaly.samples(flags), "score")


@query
def audit_today(g: Given) -> DataFrame:
    """One day's events out of JSON lines, with blank and broken lines among them."""
    events = g.parquet("events").select(
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("timestamp"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("principal"),
        F.col("event_type").alias("action"),
        F.concat(F.lit("event/"), F.col("event_id").cast("string")).alias("resource"),
        F.col("props").alias("detail"))
    lines = audit.to_lines(events)
    noise = lines.select(F.explode(F.array(F.lit("  "), F.substring("value", 1, 25))).alias("value"))
    return audit.on_day(audit.from_lines(lines.union(noise)), AUDIT_DAY)


# --- metrics and dashboards ----------------------------------------------------------------

@query
def rpt_quality_metrics(g: Given) -> DataFrame:
    t = _with_history(g)
    return _run_metrics(t, _tests(t))


for _name, _fn in {
    "pass_rate_by_table": metrics.pass_rate_by_table,
    "pass_rate_rolling30": metrics.pass_rate_rolling,
    "anomaly_trend": metrics.anomaly_trend,
    "row_count_delta": metrics.row_count_delta,
    "anomaly_spike": metrics.anomaly_spikes,
    "quality_band": metrics.quality_band,
    "pipeline_latency": metrics.pipeline_latency,
}.items():
    QUERIES[_name] = lambda spark, sf_dir, fn=_fn: fn(Given(spark, sf_dir).metrics_history)


@query
def freshness_completeness(g: Given) -> DataFrame:
    pairs = {
        "student_registration": (g.text["studentRegistration"], g.student_registration),
        "student_assessment": (g.text["studentAssessment"], g.student_assessment),
        "student_vle": (g.text["studentVle"], g.student_vle),
    }
    return union([
        metrics.freshness_completeness(source, stored, name, NOW)
        for name, (source, stored) in pairs.items()])


@query
def freshness_from_log(g: Given) -> DataFrame:
    """The same of real loads, from what each load's one job counted into the log."""
    warehouse = Warehouse(g.spark, new_path(g.spark, "loads"))
    for source in ("studentRegistration", "studentAssessment", "studentVle"):
        raw = ingest.clean_header(g.text[source], SPECS[source])
        _, errors = csv_files.store_bronze(warehouse, raw, SPECS[source], LOAD_TS, f"{source}.csv")
        if errors:
            raise RuntimeError(errors[0])
    return metrics.freshness_from_log(warehouse.read("bronze", "ingestion_log"), NOW)


@query
def failed_tests(g: Given) -> DataFrame:
    t = _with_history(g)
    return metrics.failed_tests(_tests(t), _results(t))


for _name, _fn in {
    "pass_rate": dashboards.pass_rate,
    "avg_engagement_score": dashboards.avg_engagement_score,
    "dropout_signal": dashboards.dropout_signal,
    "student_overview": dashboards.students_by_result,
    "student_overview_attempts": dashboards.previous_attempts,
    "student_overview_slices": dashboards.student_slices,
    "course_performance": dashboards.results_by_module,
    "course_performance_presentations": dashboards.presentation_comparison,
    "course_performance_scores": dashboards.score_by_assessment_type,
    "engagement_analysis": dashboards.daily_clicks,
    "engagement_analysis_activities": dashboards.clicks_by_activity,
    "engagement_analysis_active_days": dashboards.active_days_by_result,
    "at_risk": dashboards.weekly_clicks_by_result,
    "at_risk_trajectory": dashboards.score_trajectory,
    "at_risk_drop_off": dashboards.interaction_drop_off,
}.items():
    QUERIES[_name] = lambda spark, sf_dir, fn=_fn: fn(Given(spark, sf_dir).tables())
