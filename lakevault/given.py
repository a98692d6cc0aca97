"""The base tables of the data model derived from the supplied order and event tables.

Every frame covers its whole source table. Rows that should break a reference are kept and given
a negative id on the parent side, they are not left out.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakevault.functions import pseudonym
from lakevault.operators.ingest import FILE_ORDER
from lakevault.operators.rules import pass_rate
from lakevault.plans import Tables
from lakevault.plans.rulebook import ASSERTED_ACTIVITY_TYPES
from lakevault.schemas import BY_TABLE, SPECS

LOAD_TS = datetime(2024, 1, 1, 5, 0, 0)
SECOND_LOAD_TS = datetime(2024, 1, 2, 5, 0, 0)
DETECTED_AT = datetime(2024, 1, 1, 6, 0, 0)

# Orders before this day make up the first load, all orders the second.
FIRST_LOAD_BEFORE = "2000-01-01"
# Events before this day are the drift baseline, later ones the current rows.
BASELINE_BEFORE = "2024-01-16"

FIRST_YEAR, YEARS, TERMS, MODULES = 1995, 7, 3, 5
ENROLMENT = ["id_student", "code_module", "code_presentation"]

REGISTERED = [
    "cast(date_diff(order_day, pres_start) - 100 as bigint) as date_registration",
    "case o_orderstatus when 'F' then"
    " cast(date_diff(order_day, pres_start) - 100 + o_orderkey % 90 as double)"
    " when 'P' then 0D end as date_unregistration",
]
# Schemas of the supplied files by path.
_SCHEMAS: dict[str, StructType] = {}

LINE_DAY = "abs(date_diff(to_date(l_shipdate), pres_start)) % 300"


class Given:
    """Lazy frames over one folder of supplied parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, orders_before: str | None = None,
                 orders_from: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.orders_before = orders_before
        self.orders_from = orders_from

    def parquet(self, name: str) -> DataFrame:
        """A supplied table; its schema is looked up once per process, later reads name it."""
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    @cached_property
    def off(self) -> DataFrame:
        """One enrolment row per order: student, offering and its start day."""
        orders = self.parquet("orders")
        if self.orders_before:
            orders = orders.filter(f"o_orderdate < date '{self.orders_before}'")
        if self.orders_from:
            orders = orders.filter(f"o_orderdate >= date '{self.orders_from}'")
        return orders.selectExpr(
            "o_orderkey", "o_custkey", "o_orderstatus", "to_date(o_orderdate) as order_day",
            "left(o_orderpriority, 1) as module", "(month(o_orderdate) - 1) div 4 as term",
        ).selectExpr(
            "o_custkey as id_student",
            "concat('M', module) as code_module",
            "concat(year(order_day), substr('BJK', cast(term as int) + 1, 1)) as code_presentation",
            f"cast(module as bigint) * 100 + (year(order_day) - {FIRST_YEAR}) * {TERMS} + term"
            " as offering_no",
            "make_date(year(order_day), cast(term as int) * 4 + 1, 1) as pres_start",
            "order_day", "o_orderkey", "o_orderstatus",
        )

    def _lineage(self, df: DataFrame, source: str) -> DataFrame:
        return df.selectExpr(*SPECS[source].columns, f"timestamp'{LOAD_TS}' as _ingested_at",
                             f"'{source}.csv' as _source_file")

    @cached_property
    def courses(self) -> DataFrame:
        return self._lineage(self.off.selectExpr(
            "code_module", "code_presentation",
            "cast(if(offering_no % 37 = 0, 0, 200 + offering_no % 70) as bigint) as length",
        ).distinct(), "courses")

    @cached_property
    def registration_dup(self) -> DataFrame:
        """Every order as a registration, with repeated keys."""
        return self.off.selectExpr(*ENROLMENT, *REGISTERED, "o_orderkey")

    @cached_property
    def _first_orders(self) -> DataFrame:
        """The order with the lowest number per enrolment.

        All aggregates are fixed-width (the status as its character code), which keeps the
        grouping a hash aggregation.
        """
        return self.off.groupBy(*ENROLMENT).agg(
            F.min("o_orderkey").alias("o_orderkey"),
            F.min("pres_start").alias("pres_start"),
            F.min_by("order_day", "o_orderkey").alias("order_day"),
            F.expr("char(min_by(ascii(o_orderstatus), o_orderkey))").alias("o_orderstatus"),
        )

    @cached_property
    def student_registration(self) -> DataFrame:
        return self._lineage(
            self._first_orders.selectExpr(*ENROLMENT, *REGISTERED), "studentRegistration")

    @cached_property
    def student_info_named(self) -> DataFrame:
        """Demographics with the personal fields in clear text."""
        people = self.parquet("customer").join(
            self.parquet("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        return self._first_orders.join(people.hint("merge"), F.col("id_student") == F.col("c_custkey")).selectExpr(
            "code_module", "code_presentation",
            "if(o_orderkey % 53 = 0 or id_student % 211 = 0, -id_student, id_student)"
            " as id_student",
            "if(c_custkey % 2 = 0, 'F', 'M') as gender",
            "n_name as region",
            "concat('L', n_regionkey) as highest_education",
            "if(c_acctbal < 0, '?', c_mktsegment) as imd_band",
            "case when c_acctbal < 3000 then '0-35' when c_acctbal < 7000 then '35-55'"
            " else '55<=' end as age_band",
            "o_orderkey % 4 as num_of_prev_attempts",
            "cast(30 * (1 + c_nationkey % 6) as bigint) as studied_credits",
            "if(c_custkey % 10 = 0, 'Y', 'N') as disability",
            "case when o_orderkey % 97 = 0 then 'Deferred'"
            " when o_orderstatus = 'F' then 'Withdrawn' when o_orderstatus = 'P' then 'Fail'"
            " when o_orderkey % 5 = 0 then 'Distinction' else 'Pass' end as final_result",
        )

    @cached_property
    def student_info(self) -> DataFrame:
        return self._lineage(self.student_info_named.withColumns(
            {c: pseudonym(c) for c in SPECS["studentInfo"].pii}), "studentInfo")

    @cached_property
    def assessments(self) -> DataFrame:
        return self._lineage(self.parquet("part").selectExpr(
            f"concat('M', p_partkey % {MODULES} + 1) as code_module",
            f"concat({FIRST_YEAR} + p_partkey % {YEARS},"
            " substr('BJK', cast(p_size % 3 + 1 as int), 1)) as code_presentation",
            "if(p_partkey % 41 = 0, -p_partkey, p_partkey) as id_assessment",
            "case when p_type in ('ECONOMY', 'SMALL') then 'TMA'"
            " when p_type in ('MEDIUM', 'STANDARD') then 'CMA'"
            " when p_type = 'LARGE' then 'Exam' else 'Quiz' end as assessment_type",
            "cast(p_size * 5 as bigint) as date",
            "p_size * 2.5D as weight",
        ), "assessments")

    @cached_property
    def vle(self) -> DataFrame:
        """One site per supplier and offering of the calendar (a fixed grid, generated per row).

        A small file gives very many rows, so suppliers are spread before they are multiplied.
        """
        types = ", ".join(f"'{t}'" for t in [*ASSERTED_ACTIVITY_TYPES, "mystery"])
        per_module = YEARS * TERMS
        site = (f"(s_suppkey * 1000 + (slot div {per_module} + 1) * 100 + slot % {per_module})")
        spread = self.spark.sparkContext.defaultParallelism
        return self._lineage(self.parquet("supplier").select("s_suppkey").repartition(spread).selectExpr(
            "s_suppkey", f"explode(sequence(0, {MODULES * per_module - 1})) as slot",
        ).selectExpr(
            f"if(s_suppkey % 29 = 0, -{site}, {site}) as id_site",
            f"concat('M', slot div {per_module} + 1) as code_module",
            f"concat({FIRST_YEAR} + slot % {per_module} div {TERMS},"
            f" substr('BJK', cast(slot % {TERMS} + 1 as int), 1)) as code_presentation",
            f"element_at(array({types}), cast(s_suppkey % {len(ASSERTED_ACTIVITY_TYPES) + 1} + 1"
            " as int)) as activity_type",
            "if(s_suppkey % 4 <> 0, s_suppkey % 30, null) as week_from",
            "if(s_suppkey % 4 <> 0, s_suppkey % 30 + 1, null) as week_to",
        ), "vle")

    @cached_property
    def _lines(self) -> DataFrame:
        """Order lines with their enrolment: two tables that grow together, so never broadcast."""
        return self.parquet("lineitem").hint("merge").join(
            self.off, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def student_assessment_dup(self) -> DataFrame:
        """Every order line as a submission, with repeated keys; ``line`` is the row order."""
        return self._lines.selectExpr(
            "l_partkey as id_assessment", "id_student",
            f"cast({LINE_DAY} - 20 as bigint) as date_submitted",
            "if(l_returnflag = 'R', 1L, 0L) as is_banked",
            "if(l_linenumber <> 7, l_quantity * 2.1D, null) as score",
            "struct(l_orderkey, l_linenumber, l_suppkey, l_extendedprice) as line",
        )

    @cached_property
    def student_assessment(self) -> DataFrame:
        """The first submission per assessment and student."""
        first = self.student_assessment_dup.groupBy("id_assessment", "id_student").agg(
            F.expr("min_by(struct(date_submitted, is_banked, score), line)").alias("row"))
        return self._lineage(first.select("id_assessment", "id_student", "row.*"),
                             "studentAssessment")

    @cached_property
    def clicks_in_order(self) -> DataFrame:
        """Order lines as clicks, some of them twice, with the order number as row order."""
        return self._lines.selectExpr(
            "*", "explode(sequence(1, if(l_orderkey % 250 = 0, 2, 1))) as copy",
        ).selectExpr(
            "code_module", "code_presentation", "id_student",
            "l_suppkey * 1000 + offering_no as id_site",
            f"cast({LINE_DAY} - 30 as bigint) as date",
            "cast(case when l_orderkey % 500 = 0 and l_linenumber = 1 then l_quantity * 150"
            " when l_orderkey % 701 = 0 then -1 else l_quantity end as bigint) as sum_click",
            "l_orderkey as line",
        )

    @cached_property
    def student_vle(self) -> DataFrame:
        return self._lineage(self.clicks_in_order, "studentVle")

    @property
    def base(self) -> dict[str, Callable[[], DataFrame]]:
        """The seven bronze tables by name, each built when it is asked for."""
        return {name: partial(getattr, self, name) for name in BY_TABLE}

    def tables(self, load_ts: datetime = LOAD_TS, all_versions: bool = False) -> Tables:
        return Tables(self.base, load_ts, all_versions)

    @cached_property
    def text(self) -> dict[str, DataFrame]:
        """The sources as a file reader delivers them: text cells, raw headers, repeated keys."""
        frames = {
            "courses": self.courses, "assessments": self.assessments, "vle": self.vle,
            "studentInfo": self.student_info_named,
            "studentRegistration": self.registration_dup.withColumnRenamed(
                "o_orderkey", FILE_ORDER),
            "studentAssessment": self.student_assessment_dup.withColumnRenamed("line", FILE_ORDER),
            "studentVle": self.clicks_in_order.withColumnRenamed("line", FILE_ORDER),
        }
        out = {}
        for source, df in frames.items():
            order = F.col(FILE_ORDER) if FILE_ORDER in df.columns else F.lit(0).alias(FILE_ORDER)
            cells = [F.col(c).cast("string").alias(c) for c in SPECS[source].columns]
            out[source] = df.select(*cells, order)
        out["courses"] = out["courses"].withColumnsRenamed(
            {"code_module": " code_module", "length": "module_presentation_length "})
        return out

    @cached_property
    def metrics_history(self) -> DataFrame:
        """Thirty days of quality metrics, one table per event type."""
        value = F.col("value")
        evaluated = F.count(F.lit(1))
        failed, anomalies = F.count_if(value > 100), F.count_if(value > 200)
        clicks = F.count_if(value > 300)
        return self.parquet("events").groupBy(
            F.to_date("ts").alias("run_date"), F.col("event_type").alias("table_name"),
        ).agg(
            evaluated.alias("expectations_evaluated"),
            (evaluated - failed).alias("expectations_passed"),
            failed.alias("expectations_failed"), anomalies.alias("anomalies_detected"),
            clicks.alias("click_anomalies"), (anomalies - clicks).alias("score_anomalies"),
            F.count_distinct("user_id").alias("row_count"),
            F.max(F.floor("value")).alias("pipeline_duration_sec"),
        ).withColumns({
            "layer": F.lit("bronze"),
            "pass_rate": pass_rate(F.col("expectations_passed"), F.col("expectations_evaluated")),
            "temporal_anomalies": F.lit(0).cast("bigint"),
            "dbt_tests_passed": F.lit(0).cast("bigint"),
            "dbt_tests_failed": F.lit(0).cast("bigint"),
        })

    @cached_property
    def drift_frames(self) -> tuple[DataFrame, DataFrame]:
        events = self.parquet("events")
        cut = F.to_date("ts") < F.lit(BASELINE_BEFORE).cast("date")
        return events.filter(cut), events.filter(~cut)


def second_load(full: Given) -> dict[str, Callable[[], DataFrame]]:
    """Base tables of the second load: all orders, some weights and bands changed."""
    def assessments() -> DataFrame:
        return full.assessments.withColumn(
            "weight", F.expr("if(id_assessment % 10 = 0, weight + 1, weight)"))

    def student_info() -> DataFrame:
        changed = F.when(F.col("id_student") % 10 == 0, pseudonym(F.lit("changed")))
        return full.student_info.withColumn("imd_band", changed.otherwise(F.col("imd_band")))

    return full.base | {"assessments": assessments, "student_info": student_info}
