"""Click rollups per student, offering and day or week."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakevault.functions import ratio, week_number
from lakevault.functions.scalars import DAYS_PER_WEEK
from lakevault.operators.hashed import head_of, headed, met


def rollup(clicks: DataFrame, sites: DataFrame, by: Sequence[str], site_key: str,
           join_on: Sequence[str], period: str, unique_sites: bool = False,
           made: Column | None = None) -> DataFrame:
    """Clicks summed per ``by`` columns and period, with distinct site and activity counts.

    One grouping with three distinct counts would copy every click row once per distinct column
    before the shuffle. Instead the clicks meet their site, collapse there to one row per (group,
    site), with the days seen as a bit set (a week has only seven), and leave without the site's key,
    which leaves a single distinct count for the second reduction.

    The clicks are read once and shuffled twice, by site and by ``by``; both groupings, and what is
    grouped or joined by ``by`` behind them, stay where the rows are. A hot site is split by adaptive
    skew joins; only its reduced rows go on.

    ``sites`` may hold several rows per site (all satellite versions): sums then multiply as in a
    plain join, while distinct counts do not. ``unique_sites=True`` skips the numbering that
    guards the site count when the caller knows each site occurs once. ``made`` makes the one key of
    ``join_on`` from clicks that do not carry it, which ``site_key`` and ``by`` stand for.
    """
    weekly = period == "week_number"
    if not weekly and period != "date":
        raise ValueError(f"period must be 'date' or 'week_number', not {period!r}")
    group = [*by, period]
    rows = clicks.withColumn("week_number", week_number(F.col("date"))) if weekly else clicks
    moved_by = list(join_on)
    if made is not None:
        moved_by = [head_of(join_on[0])]
        rows = headed(rows, join_on[0], made)
    per_site_key = list(dict.fromkeys([*group, site_key, *moved_by]))
    rows = rows.select(*dict.fromkeys([*per_site_key, "date", "sum_click"]))
    with_site = _with_site(rows, sites, join_on, unique_sites, made)
    states = with_site.groupBy(*per_site_key, "_copy", "activity_type").agg(*site_states())
    return _per_group(states, by, site_key, period)


#: What is kept of the clicks of a (group, period, site): how two such states become one.
STATES = {"_clicks": F.sum, "_rows": F.sum, "_max": F.max, "_days": F.bit_or, "_seen": F.sum}


def site_states() -> list[Column]:
    """The state of a (group, period, site), as aggregates over its clicks."""
    day_bit = F.expr(f"shiftleft(1, cast(pmod(`date`, {DAYS_PER_WEEK}) as int))")
    return [F.sum("sum_click").alias("_clicks"), F.count("sum_click").alias("_rows"),
            F.max("sum_click").alias("_max"), F.bit_or(day_bit).alias("_days"),
            F.count(F.lit(1)).alias("_seen")]


def merged_states(stored: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The states of both, one for each key."""
    return stored.select(*new.columns).unionByName(new).groupBy(*key).agg(
        *[how(c).alias(c) for c, how in STATES.items()]).select(*new.columns)


def newer_rows(stored: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows of both; of a key that both have, the new ones, NULL being a key like any other."""
    mine = new.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)])
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)]
    return stored.select(*new.columns).join(mine.hint("merge"), same, "left_anti").unionByName(new)


def from_states(states: DataFrame, sites: DataFrame, by: Sequence[str], site_key: str,
                join_on: Sequence[str], period: str, unique_sites: bool = False) -> DataFrame:
    """The rollup per group and period from the states of its sites."""
    return _per_group(_with_site(states, sites, join_on, unique_sites), by, site_key, period)


def _with_site(rows: DataFrame, sites: DataFrame, join_on: Sequence[str], unique_sites: bool,
               made: Column | None = None) -> DataFrame:
    """Rows with the activity type of each row of their site, which ``_copy`` numbers."""
    # never a broadcast: sites grow with the courses, and a plan's guess of their size can be far off
    meta = sites.select(*join_on, "activity_type")
    if unique_sites:
        meta = meta.withColumn("_copy", F.lit(1))
    else:
        order = Window.partitionBy(*join_on).orderBy("activity_type")
        meta = meta.withColumn("_copy", F.row_number().over(order))
    if made is not None:
        return met(rows, meta, join_on[0], made)
    return rows.join(meta.hint("merge"), list(join_on), "left")


def _per_group(states: DataFrame, by: Sequence[str], site_key: str, period: str) -> DataFrame:
    """The rollup from the states of sites that carry their activity type."""
    group = [*by, period]
    first_copy = F.col(site_key).isNotNull() & (F.coalesce(F.col("_copy"), F.lit(1)) == 1)
    moved = states.select(*group, *STATES, "activity_type", first_copy.alias("_first"))
    out = moved.repartition(*by).groupBy(*group).agg(
        F.bit_or("_days").alias("_days"),
        F.sum("_clicks").alias("total_clicks"),
        F.sum("_rows").alias("_rows"),
        F.count_if("_first").alias("unique_resources"),
        F.count_distinct("activity_type").alias("unique_activity_types"),
        F.max("_max").alias("max_daily_clicks"),
    )
    if period != "week_number":
        return out.select(*group, "total_clicks", "unique_resources", "unique_activity_types")
    return out.select(
        *group,
        F.coalesce(F.bit_count("_days"), F.lit(0)).cast("bigint").alias("active_days"),
        "total_clicks",
        ratio(F.col("total_clicks"), F.col("_rows")).alias("avg_daily_clicks"),
        "unique_resources", "unique_activity_types", "max_daily_clicks",
    )
