"""Measured quality metrics and the queries of the monitoring page."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakevault.operators import anomaly
from lakevault.operators.rules import pass_rate, summarize_tables

METRIC_KEY = ["run_date", "table_name", "layer"]
METRIC_COLUMNS = [
    *METRIC_KEY, "expectations_evaluated", "expectations_passed", "expectations_failed",
    "pass_rate", "anomalies_detected", "click_anomalies", "score_anomalies",
    "temporal_anomalies", "row_count", "pipeline_duration_sec", "dbt_tests_passed",
    "dbt_tests_failed",
]

# Pass-rate bands of the status light.
CRITICAL_UP_TO, WARNING_UP_TO = 90, 95
SPIKE_PERCENT = 5
ROLLING_DAYS = 30


def anomaly_counts(counts: DataFrame) -> DataFrame:
    """Flag counts of :func:`anomaly.summary` as one row per table, split by detector family."""
    kind = F.col("anomaly_type")
    table = F.when(kind.isin("click_outlier", "vle_before_registration"), "student_vle").otherwise(
        "student_assessment")

    def only(cond: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("count"))), F.lit(0)).alias(name)

    return counts.groupBy(table.alias("table_name")).agg(
        only(kind == "click_outlier", "click_anomalies"),
        only(kind == "score_outlier", "score_anomalies"),
        only(~F.col("in_total"), "temporal_anomalies"),
    )


def quality_metrics(results: DataFrame, counts: DataFrame, tests: DataFrame, run_date: date,
                    duration_sec: int = 0) -> DataFrame:
    """Metrics row per (run_date, table, layer) of one run.

    ``results`` are rule outcomes, ``counts`` the anomaly summary, ``tests`` the model tests;
    anomalies and tests count for the bronze table they look at or whose model they test. All inputs
    hold a few rows per table.
    """
    table = F.regexp_replace("model", "^silver_", "")
    per_table = tests.groupBy(table.alias("table_name")).agg(
        F.count_if("success").alias("dbt_tests_passed"),
        F.count_if(~F.col("success")).alias("dbt_tests_failed"))
    bronze = F.lit("bronze").alias("layer")
    joined = (
        summarize_tables(results)
        .join(anomaly_counts(counts).select("*", bronze), ["table_name", "layer"], "left")
        .join(per_table.select("*", bronze), ["table_name", "layer"], "left")
        .na.fill(0)
    )
    detected = F.col("click_anomalies") + F.col("score_anomalies") + F.col("temporal_anomalies")
    return joined.withColumns({
        "run_date": F.lit(run_date).cast("date"),
        "pass_rate": pass_rate(F.col("expectations_passed"), F.col("expectations_evaluated")),
        "anomalies_detected": detected,
        "pipeline_duration_sec": F.lit(duration_sec).cast("bigint"),
    }).select(*METRIC_COLUMNS)


def measured(tables, detected_at: datetime, run_date: date, results: DataFrame,
             tests: DataFrame) -> DataFrame:
    """Metrics of the current base tables."""
    counts = anomaly.summary(detected_at, tables["student_vle"], tables["student_assessment"],
                             tables["student_registration"])
    return quality_metrics(results, counts, tests, run_date)


def pass_rate_by_table(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("table_name").agg(
        F.sum("expectations_passed").alias("passed"),
        F.sum("expectations_evaluated").alias("evaluated"),
    ).withColumn("pass_rate", pass_rate(F.col("passed"), F.col("evaluated")))


def pass_rate_rolling(metrics: DataFrame, days: int = ROLLING_DAYS) -> DataFrame:
    """Pass rate per table over the last ``days`` calendar days, missing days included."""
    day = F.date_diff("run_date", F.lit("1970-01-01").cast("date"))
    daily = metrics.groupBy("table_name", "run_date").agg(
        F.sum("expectations_passed").alias("_p"), F.sum("expectations_evaluated").alias("_e"))
    back = Window.partitionBy("table_name").orderBy(day).rangeBetween(-(days - 1), 0)
    return daily.withColumns({
        "passed": F.sum("_p").over(back), "evaluated": F.sum("_e").over(back),
    }).select("table_name", "run_date", "passed", "evaluated",
              pass_rate(F.col("passed"), F.col("evaluated")).alias("pass_rate"))


def anomaly_trend(metrics: DataFrame) -> DataFrame:
    """Anomalies per day, in total and by family."""
    names = ["anomalies_detected", "click_anomalies", "score_anomalies", "temporal_anomalies"]
    return metrics.groupBy("run_date").agg(*[F.sum(n).alias(n) for n in names])


def row_count_delta(metrics: DataFrame) -> DataFrame:
    """Row count per table and run against the previous run."""
    runs = Window.partitionBy("table_name", "layer").orderBy("run_date")
    before = F.lag("row_count").over(runs)
    return metrics.select(
        *METRIC_KEY, "row_count", before.alias("previous_row_count"),
        (F.col("row_count") - before).alias("row_delta"))


def anomaly_spikes(metrics: DataFrame, percent: float = SPIKE_PERCENT) -> DataFrame:
    """Tables and days whose anomalies grew by more than ``percent`` against the previous run."""
    runs = Window.partitionBy("table_name", "layer").orderBy("run_date")
    growth = (F.col("anomalies_detected") - F.col("previous")) * 100
    return (
        metrics.select(*METRIC_KEY, "anomalies_detected",
                       F.lag("anomalies_detected").over(runs).alias("previous"))
        .filter(growth > F.col("previous") * percent)
    )


def quality_band(metrics: DataFrame) -> DataFrame:
    """Status of each run: critical up to 90 %, warning up to 95 %, healthy above."""
    daily = metrics.groupBy("run_date").agg(
        F.sum("expectations_passed").alias("passed"),
        F.sum("expectations_evaluated").alias("evaluated"),
    ).withColumn("pass_rate", pass_rate(F.col("passed"), F.col("evaluated")))
    rate = F.col("pass_rate")
    return daily.withColumn(
        "status", F.when(rate <= CRITICAL_UP_TO, "critical").when(rate <= WARNING_UP_TO, "warning")
        .otherwise("healthy"))


def pipeline_latency(metrics: DataFrame) -> DataFrame:
    """Duration of each run; every row of a run carries it."""
    return metrics.groupBy("run_date").agg(
        F.max("pipeline_duration_sec").alias("pipeline_duration_sec"))


def freshness_completeness(source: DataFrame, stored: DataFrame, table: str, now: datetime,
                           ) -> DataFrame:
    """Age of the newest load and stored against source rows, one row per table."""
    rows = stored.agg(F.count(F.lit(1)).alias("bronze_rows"),
                      F.max("_ingested_at").alias("last_ingested_at"))
    read = source.agg(F.count(F.lit(1)).alias("n")).scalar()
    age = (F.unix_timestamp(F.lit(now).cast("timestamp"))
           - F.unix_timestamp("last_ingested_at")) / 3600.0
    return rows.select(
        F.lit(table).alias("table_name"), read.alias("source_rows"), "bronze_rows",
        "last_ingested_at", age.alias("age_hours"),
        (F.col("bronze_rows") == read).alias("complete"))


def freshness_from_log(log: DataFrame, now: datetime) -> DataFrame:
    """Age and completeness of each table's newest load, from the ingestion log alone: what was read
    must have been written or merged into a row of the same key."""
    newest = log.groupBy("table_name").agg(F.max_by(
        F.struct("rows_read", "row_count", "rows_merged", "_ingested_at"), "_ingested_at").alias("l"))
    age = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("l._ingested_at")) / 3600.0
    return newest.select(
        "table_name", F.col("l.rows_read").alias("source_rows"), F.col("l.row_count").alias("bronze_rows"),
        F.col("l.rows_merged").alias("merged_rows"), F.col("l._ingested_at").alias("last_ingested_at"),
        age.alias("age_hours"),
        (F.col("l.rows_read") == F.col("l.row_count") + F.col("l.rows_merged")).alias("complete"))


def failed_tests(tests: DataFrame, results: DataFrame) -> DataFrame:
    """Failed model tests and rule outcomes in one list."""
    a = tests.filter("not success").select(
        F.col("test"), F.col("model").alias("table_name"),
        F.concat_ws(": ", "columns", F.concat(F.col("failed").cast("string"), F.lit(" rows")))
        .alias("detail"))
    b = results.filter("not success").select(
        F.col("rule").alias("test"), "table_name",
        F.concat_ws(": ", "column", F.concat(F.col("failed_rows").cast("string"),
                                             F.lit(" rows"))).alias("detail"))
    return a.unionByName(b)
