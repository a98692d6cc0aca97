"""Exact quantiles of a column of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 100_000


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float]) -> Column:
    """Scalar struct ``(q0, q1, ...)`` of linearly interpolated quantiles, NULL values left out.

    Spark's own exact percentile keeps a map of all distinct values in one task. Here a first pass
    brackets each quantile between two approximate ones, whose ranks are off by a share of at most
    1 / ``ACCURACY`` of the rows. A second pass counts equal values: per quantile, all rows below
    its bracket as one value and those inside by value, reduced before the shuffle. Only values
    inside a bracket are sorted, about 6 / ``ACCURACY`` of the rows however the values lie.
    """
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    slack = 2 / ACCURACY
    near = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-slack, slack)]
    first = values.agg(F.count("v").alias("rows"),
                       F.percentile_approx("v", near, ACCURACY).alias("ends"))
    known = values.select("v", F.inline(F.array(F.struct(  # derived once, not in each use
        first.select(F.struct("*")).scalar().alias("_k")))))

    def key(i: int) -> Column:
        low, high = F.col("_k.ends")[2 * i], F.col("_k.ends")[2 * i + 1]
        place = F.when(F.col("v") < low, -1).when(F.col("v") <= high, 0).otherwise(1)
        return F.struct(F.lit(i).alias("i"), place.alias("place"),
                        F.when(place == 0, F.col("v")).alias("inside"))

    kept = known.select("_k.rows", "v", F.explode(F.array(*map(key, range(len(probs))))).alias("x"))
    # outside a bracket only its neighbours can matter: the largest below, the least above
    counted = kept.groupBy("x.i", "x.place", "x.inside").agg(
        F.count(F.lit(1)).alias("n"), F.max("rows").alias("rows"),
        F.when(F.col("place") < 0, F.max("v")).otherwise(F.min("v")).alias("v"))
    order = Window.partitionBy("i").orderBy("place", "v")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = counted.withColumn("upto", upto)

    def at(i: int, rank: Column) -> Column:
        return F.min(F.when((F.col("i") == i) & (F.col("upto") > rank), F.col("v")))

    results = []
    for i, p in enumerate(probs):
        position = (F.col("rows") - 1) * float(p)
        results.append((at(i, F.floor(position)), at(i, F.ceil(position)), position))
    picked = placed.agg(
        F.max("rows").alias("rows"),
        *[c.alias(f"v{2 * i + k}") for i, r in enumerate(results) for k, c in enumerate(r[:2])])
    out = []
    for i, (_, _, position) in enumerate(results):
        low, high = F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}")
        out.append((low + (high - low) * (position - F.floor(position))).alias(f"q{i}"))
    return picked.select(F.struct(*out)).scalar()
