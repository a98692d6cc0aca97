"""Column profiles that add up, so that drift needs no rows of an earlier load.

A categorical column is profiled by the count of each value, a numeric one by the number of its
values, their mean and the sum of squared deviations from it. Profiles of parts merge into the
profile of the whole, and ``drift`` compares two of them as ``operators.drift.run`` compares rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.operators.rules import Drift

KEY = ["table_name", "column", "kind", "category"]


def _entry(column: str, kind: str):
    numeric = kind == "numeric"
    text = F.lit(None) if numeric else F.col(column)
    return F.struct(
        F.lit(column).alias("column"), F.lit(kind).alias("kind"),
        text.cast("string").alias("category"),
        (F.col(column) if numeric else F.lit(None)).cast("double").alias("number"))


def profile(tables: Mapping[str, DataFrame], checks: Sequence[Drift]) -> DataFrame:
    """(table_name, column, kind, category, n, mean, m2) of every checked column of the tables at
    hand. A table is read once; its rows reduce to one row per value of a category before they
    move, and to one row per numeric column."""
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        if table not in tables:
            continue
        columns = list(dict.fromkeys((c.column, c.kind) for c in checks if c.table == table))
        number = F.col("number")
        parts.append(tables[table].select(F.inline(F.array(*(_entry(*c) for c in columns)))).groupBy(
            "column", "kind", "category").agg(
            F.when(F.col("kind") == "numeric", F.count(number)).otherwise(F.count(F.lit(1))).alias("n"),
            F.avg(number).alias("mean"), (F.var_pop(number) * F.count(number)).alias("m2")).select(
            F.lit(table).alias("table_name"), "*"))
    if not parts:
        raise ValueError("no checked table is at hand")
    return reduce(DataFrame.unionByName, parts)


def merged(*profiles: DataFrame) -> DataFrame:
    """The profile of all rows together. Means are shifted by one that all share, so the sums of
    squares lose no digits to it."""
    rows = reduce(DataFrame.unionByName, profiles)
    centre = rows.groupBy(*[F.col(c).alias(f"_{c}") for c in KEY]).agg(F.min("mean").alias("_c"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY])
    off = F.col("mean") - F.col("_c")
    n, first = F.sum("n"), F.sum(F.col("n") * off)
    return rows.join(centre, same).groupBy(*KEY).agg(
        n.alias("n"), (F.max("_c") + first / F.nullif(n, F.lit(0))).alias("mean"),
        (F.sum("m2") + F.sum(F.col("n") * off * off) - first * first / F.nullif(n, F.lit(0))).alias("m2"))


def drift(baseline: DataFrame, current: DataFrame, checks: Sequence[Drift]) -> DataFrame:
    """(table_name, column, kind, drift, allowed, exceeds) of every declared check that both
    profiles have: the largest change of a share in points, or the shift of the mean in baseline
    deviations. A baseline without spread has no defined shift, which counts as no drift."""
    both = baseline.select(*KEY, "n", "mean", "m2", F.lit(0).alias("load")).unionByName(
        current.select(*KEY, "n", "mean", "m2", F.lit(1).alias("load")))

    def of(load: int, value):
        return F.when(F.col("load") == load, value)

    by_value = both.groupBy(*KEY).agg(
        *(F.coalesce(F.sum(of(k, F.col("n"))), F.lit(0)).alias(f"n{k}") for k in (0, 1)),
        *(F.max(of(k, F.col("mean"))).alias(f"mean{k}") for k in (0, 1)),
        F.max(of(0, F.sqrt(F.col("m2") / F.nullif(F.col("n"), F.lit(0))))).alias("spread"))
    totals = by_value.groupBy("table_name", "column", "kind").agg(
        F.sum("n0").alias("t0"), F.sum("n1").alias("t1")).filter("t0 > 0 or t1 > 0")
    share = [F.coalesce(F.col(f"n{k}") * 100.0 / F.nullif(F.col(f"t{k}"), F.lit(0)), F.lit(0.0))
             for k in (0, 1)]
    shift = F.abs(F.col("mean1") - F.col("mean0")) / F.nullif(F.col("spread"), F.lit(0.0))
    found = by_value.join(totals, ["table_name", "column", "kind"]).groupBy(
        "table_name", "column", "kind").agg(F.max(F.when(
            F.col("kind") == "numeric", shift).otherwise(F.abs(share[1] - share[0]))).alias("drift"))
    limits = F.array(*(F.struct(
        F.lit(c.table).alias("t"), F.lit(c.column).alias("c"), F.lit(c.kind).alias("k"),
        F.lit(float(c.limit)).alias("allowed")) for c in checks))
    return found.withColumn("_x", F.explode(limits)).filter(
        (F.col("_x.t") == F.col("table_name")) & (F.col("_x.c") == F.col("column"))
        & (F.col("_x.k") == F.col("kind"))).select(
        "table_name", "column", "kind", "drift", F.col("_x.allowed").alias("allowed"),
        F.coalesce(F.col("drift") > F.col("_x.allowed"), F.lit(False)).alias("exceeds"))
