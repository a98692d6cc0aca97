"""Distribution drift of a column against a baseline frame.

The declared checks give limits but no formulas; the ones here are this package's own: largest
change of a category's share in percentage points, and shift of the mean in baseline deviations.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.operators.rules import Drift


def _shares(df: DataFrame, column: str, name: str) -> DataFrame:
    """Share of each category in percent. The total is a sum over the few category rows."""
    counts = df.groupBy(F.col(column).alias("category")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.select("category", (F.col("n") * 100.0 / total).alias(name))


def categorical(baseline: DataFrame, current: DataFrame, column: str, limit: float) -> DataFrame:
    """Per category: both shares, their absolute difference and whether it exceeds the limit."""
    a = _shares(baseline, column, "baseline_pct")
    b = _shares(current, column, "current_pct").withColumnRenamed("category", "_category")
    both = a.join(b, F.col("category").eqNullSafe(F.col("_category")), "full")
    base, now = F.coalesce("baseline_pct", F.lit(0.0)), F.coalesce("current_pct", F.lit(0.0))
    return both.select(
        F.coalesce("category", "_category").alias("category"),
        base.alias("baseline_pct"), now.alias("current_pct"),
        F.abs(now - base).alias("drift_pct"),
    ).withColumn("exceeds", F.col("drift_pct") > limit)


def numeric(baseline: DataFrame, current: DataFrame, column: str, limit: float) -> DataFrame:
    """One row: both means, the baseline deviation, the shift in deviations and the verdict.

    A baseline without spread has no defined shift, which counts as no drift.
    """
    base = baseline.agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("s"))
    now = current.agg(F.avg(column).alias("current_mean"))
    stats = base.select(F.struct("m", "s")).scalar()
    shift = F.abs(F.col("current_mean") - F.col("baseline_mean")) / F.nullif(
        F.col("baseline_std"), F.lit(0.0))
    return now.select(
        stats["m"].alias("baseline_mean"), stats["s"].alias("baseline_std"), "current_mean",
    ).withColumn("drift_z", shift).withColumn(
        "exceeds", F.coalesce(F.col("drift_z") > limit, F.lit(False)))


def _table_drift(baseline: DataFrame, current: DataFrame, checks: Sequence[Drift]) -> DataFrame:
    """(column, kind, drift, allowed, exceeds) of all checks of one table, from one reading of each
    frame: rows become one entry per checked column, which reduce by category before they move."""
    columns = list(dict.fromkeys(c.column for c in checks))
    kinds = {c.column: c.kind for c in checks}
    both = baseline.select(*columns).withColumn("_now", F.lit(False)).unionByName(
        current.select(*columns).withColumn("_now", F.lit(True)))
    entries = F.array(*[F.struct(
        F.lit(c).alias("column"),
        (F.col(c).cast("string") if kinds[c] == "categorical" else F.lit(None).cast("string"))
        .alias("category"),
        (F.col(c).cast("double") if kinds[c] == "numeric" else F.lit(None).cast("double"))
        .alias("number")) for c in columns])
    now, before = F.col("_now"), ~F.col("_now")
    counted = both.select("_now", F.inline(entries)).groupBy("column", "category").agg(
        F.count_if(before).alias("n0"), F.count_if(now).alias("n1"),
        F.avg(F.when(before, F.col("number"))).alias("m0"),
        F.stddev_pop(F.when(before, F.col("number"))).alias("s0"),
        F.avg(F.when(now, F.col("number"))).alias("m1"))
    totals = counted.groupBy("column").agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    share = [F.coalesce(F.col(n) * 100.0 / F.nullif(F.col(t), F.lit(0)), F.lit(0.0))
             for n, t in (("n0", "t0"), ("n1", "t1"))]
    shift = F.abs(F.col("m1") - F.col("m0")) / F.nullif(F.col("s0"), F.lit(0.0))
    measured = counted.join(totals, "column").groupBy("column").agg(
        F.max(F.abs(share[1] - share[0])).alias("categorical"), F.max(shift).alias("numeric"))
    limits = F.array(*[F.struct(
        F.lit(c.column).alias("c"), F.lit(c.kind).alias("kind"), F.lit(float(c.limit)).alias("allowed"))
        for c in checks])
    out = measured.withColumn("_x", F.explode(limits)).filter(F.col("_x.c") == F.col("column"))
    drift = F.when(F.col("_x.kind") == "categorical", F.col("categorical")).otherwise(F.col("numeric"))
    return out.select(
        "column", F.col("_x.kind").alias("kind"), drift.alias("drift"),
        F.col("_x.allowed").alias("allowed"),
        F.coalesce(drift > F.col("_x.allowed"), F.lit(False)).alias("exceeds"))


def run(baseline: Mapping[str, DataFrame], current: Mapping[str, DataFrame],
        checks: Sequence[Drift]) -> DataFrame:
    """(table_name, column, kind, drift, allowed, exceeds) of every declared check whose table both
    loads have: the largest change of a share in points, or the shift of the mean in deviations."""
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        if table in baseline and table in current:
            parts.append(_table_drift(
                baseline[table], current[table], [c for c in checks if c.table == table]
            ).select(F.lit(table).alias("table_name"), "*"))
    if not parts:
        raise ValueError("no checked table is in both loads")
    return reduce(DataFrame.unionByName, parts)
