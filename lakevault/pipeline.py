"""Whole run: load files, refresh both model paths, check, detect, record metrics."""

from __future__ import annotations

import argparse
import json
import time
import warnings
from collections.abc import Collection, Mapping
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.operators import anomaly, profile, rules
from lakevault.plans import MODELS, Model, Tables, business, metrics, quality, rulebook
from lakevault.schemas import BY_TABLE
from lakevault.session import get_session
from lakevault.sources.audit import AuditLog
from lakevault.sources.csv_files import LoadResult, load_all_tables
from lakevault.sources.warehouse import Warehouse

VAULT = ("dv", "bv")
# Large facts, stored by presentation so that a filter on it prunes folders.
PARTITIONED = {
    "silver_student_vle": ["code_presentation"],
    "fact_student_interaction": ["code_presentation"],
    "fact_engagement_summary": ["code_presentation"],
}


def store_model(warehouse: Warehouse, m: Model, batch: DataFrame) -> None:
    """Write a model the way its kind says."""
    if m.kind == "table":
        warehouse.overwrite(batch, m.layer, m.name, PARTITIONED.get(m.name, ()))
    elif m.kind == "upsert":
        warehouse.upsert(batch, m.layer, m.name, m.key)
    elif m.kind == "append":
        warehouse.append_versions(batch, m.layer, m.name, m.key[0])


def refresh_models(warehouse: Warehouse, load_ts: datetime, all_versions: bool = False,
                   stored: Mapping[str, DataFrame] | None = None,
                   layers: Collection[str] | None = None) -> Tables:
    """Build and store the models (of some layers) in declaration order; later models read the
    stored ones, at first bronze or what ``stored`` has.

    Each stored table is a lineage cut: a model used by several others is computed once, and a
    lost executor costs one model's tasks, not the chain behind it.
    """
    frames = dict(stored or {name: warehouse.read("bronze", name) for name in BY_TABLE})
    for m in MODELS.values():
        if m.kind == "view" or layers is not None and m.layer not in layers:
            continue
        store_model(warehouse, m, m.build(Tables(frames, load_ts, all_versions)))
        frames[m.name] = warehouse.read(m.layer, m.name)
    return Tables(frames, load_ts, all_versions)


def run(spark: SparkSession, data_dir: str, root: str, load_ts: datetime | None = None,
        fail_on_critical: bool = True, config: Mapping | None = None) -> dict[str, LoadResult]:
    """One pipeline run over the CSV files of ``data_dir``; everything lands under ``root``.

    With the gate on (the default) a critical rule, assertion, reference or declared check that fails
    on bronze stops the run before any model is built, a rule that fails on silver before anything
    behind silver is, and an assertion of the vault models before the marts are; what is not built
    stays as the last good run left it. Column profiles are compared with those of the last good run
    and kept by this one at its end; drift and jumps in the number of anomalies are warnings. ``config`` has the thresholds of the detectors,
    ``sources`` (files by source) and ``multi_line`` (sources whose cells may hold line breaks).
    """
    started = time.monotonic()
    load_ts = load_ts or datetime.now(UTC)
    config = config or {}
    warehouse = Warehouse(spark, root)
    audit = AuditLog(spark, f"{root.rstrip('/')}/audit")

    loaded = load_all_tables(spark, warehouse, data_dir, load_ts, audit.log,
                             config.get("sources"), config.get("multi_line", ()))
    missing = [name for name in BY_TABLE if not warehouse.exists("bronze", name)]
    if missing:
        raise RuntimeError(f"no bronze data for {missing}")

    def validated(name: str, outcomes: DataFrame) -> DataFrame:
        warehouse.overwrite(outcomes, "gold", f"rule_results_{name}")
        results = warehouse.read("gold", f"rule_results_{name}")
        audit.log("validate", name, rules.summarize(results).first().asDict())
        if fail_on_critical:
            rules.require_critical(results)
        return results

    bronze = {name: warehouse.read("bronze", name) for name in BY_TABLE}
    checked = validated("bronze", quality.validate_bronze(Tables(bronze, load_ts)))
    day = f"{load_ts:%Y%m%d}"
    note_drift(warehouse, audit, bronze, load_ts, day)
    t = refresh_models(warehouse, load_ts, layers=["silver"])
    results = checked.unionByName(validated("silver", quality.validate_silver(t)))
    silver = {m.name: t[m.name] for m in MODELS.values() if m.layer == "silver"}
    t = refresh_models(warehouse, load_ts, stored={**bronze, **silver}, layers=VAULT)
    validated("vault", quality.validate_vault(t))
    vault = {m.name: t[m.name] for m in MODELS.values() if m.layer in VAULT}
    t = refresh_models(warehouse, load_ts, stored={**bronze, **silver, **vault},
                       layers={m.layer for m in MODELS.values()} - {"silver", *VAULT})
    warehouse.overwrite(results, "gold", "rule_results")
    results = warehouse.read("gold", "rule_results")

    flags = anomaly.detect_all(load_ts, t["student_vle"], t["student_assessment"],
                               t["student_registration"], config.get("anomaly"))
    warehouse.replace_run(flags, "gold", "anomaly_flags", day)
    mine = warehouse.read("gold", "anomaly_flags").filter(
        F.col("detected_at") == F.lit(load_ts).cast("timestamp"))
    warehouse.overwrite(anomaly.count_flags(mine), "gold", "anomaly_summary")
    counts = warehouse.read("gold", "anomaly_summary")
    audit.log("anomaly_detected", "student_vle, student_assessment",
              {r["anomaly_type"]: r["count"] for r in counts.collect()})

    # The metrics model tests itself, so it is built from the other tests and added last.
    run_date = load_ts.date()
    tested = {"rpt_quality_metrics": metrics.quality_metrics(
        results, counts, results.limit(0).selectExpr("'' as model", "true as success"), run_date)}
    warehouse.overwrite(quality.model_tests(t.with_frames(
        {m.name: t[m.name] for m in MODELS.values() if m.kind != "view"} | tested)),
        "gold", "test_results")
    tests = warehouse.read("gold", "test_results")
    warehouse.upsert_daily(
        metrics.quality_metrics(results, counts, tests, run_date,
                                int(time.monotonic() - started)),
        "gold", "rpt_quality_metrics", metrics.METRIC_KEY)
    warehouse.upsert_daily(business.bv_quality_metrics(t, run_date), "bv", "bv_quality_metrics",
                           metrics.METRIC_KEY)
    note_spikes(warehouse, audit, run_date)
    warehouse.replace_run(warehouse.read("quality", "profiles_of_run"), "quality", "column_profiles", day)
    return loaded


def note_drift(warehouse: Warehouse, audit: AuditLog, bronze: Mapping[str, DataFrame],
               load_ts: datetime, day: str) -> None:
    """Profile the checked columns of this load, and compare with the last good load before it."""
    stamp = F.lit(load_ts).cast("timestamp")
    warehouse.overwrite(profile.profile(bronze, rulebook.RULES.drift).withColumn("load_ts", stamp),
                        "quality", "profiles_of_run")
    if not warehouse.exists("quality", "column_profiles"):
        return
    earlier = warehouse.read("quality", "column_profiles").filter(F.col("load_ts") < stamp)
    last = earlier.select(F.max("load_ts")).first()[0]
    if last is None:
        return
    found = profile.drift(earlier.filter(F.col("load_ts") == F.lit(last)),
                          warehouse.read("quality", "profiles_of_run"), rulebook.RULES.drift)
    warehouse.replace_run(found.withColumn("load_ts", stamp), "quality", "drift_results", day)
    rows = warehouse.read("quality", "drift_results").filter(F.col("load_ts") == stamp).collect()
    audit.log("drift", "column_profiles", {f"{r.table_name}.{r.column}": r.drift for r in rows})
    for r in rows:  # as many as there are declared checks
        if r.exceeds:
            warnings.warn(f"{r.table_name}.{r.column} drifted by {r.drift:.2f}, allowed are "
                          f"{r.allowed}", stacklevel=2)


def note_spikes(warehouse: Warehouse, audit: AuditLog, run_date: date) -> None:
    """Warn of tables of this run's day with many more anomalies than on the day before."""
    history = warehouse.read("gold", "rpt_quality_metrics")
    rows = metrics.anomaly_spikes(history).filter(F.col("run_date") == F.lit(run_date)).collect()
    for r in rows:  # at most one for each table
        warnings.warn(f"{r.layer}.{r.table_name}: {r.anomalies_detected} anomalies after "
                      f"{r.previous}", stacklevel=2)
    if rows:
        audit.log("anomaly_spike", "rpt_quality_metrics",
                  {f"{r.layer}.{r.table_name}": r.anomalies_detected for r in rows})


def main() -> None:
    parser = argparse.ArgumentParser(description="Run the whole pipeline over a folder of CSVs.")
    parser.add_argument("data_dir")
    parser.add_argument("warehouse")
    parser.add_argument("--no-gate", action="store_true",
                        help="go on when a critical rule fails")
    parser.add_argument("--config", help="JSON file of thresholds and source files")
    args = parser.parse_args()
    spark = get_session()
    config = None
    if args.config:
        with open(args.config, encoding="utf-8") as f:
            config = json.load(f)
    for source, (rows, errors) in run(spark, args.data_dir, args.warehouse,
                                      fail_on_critical=not args.no_gate, config=config).items():
        print(f"{source:22s} {rows:>14,}  {'; '.join(errors) or 'ok'}")


if __name__ == "__main__":
    main()
