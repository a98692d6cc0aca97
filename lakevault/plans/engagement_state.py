"""Weekly engagement that is refreshed by load: stored states, re-aggregated where a load touches.

The states of a (student, offering, week, site) add up: a load's clicks become states, merge with
the stored ones of the same weeks, and only these weeks are rolled up again. Parts of the stored
tables are ``WEEKS_PER_PART`` weeks of a presentation, so that a load of a few weeks reads and writes
these, whatever else is stored. Smaller parts are more files, larger ones are more rows to copy; with
one week a part, a week without new clicks is never read. Both tables remember the loads they hold: a
load that is run again adds nothing, and one that died between the two tables goes on with the second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault import functions as L
from lakevault.operators import engagement
from lakevault.sources.shared import stored as kept
from lakevault.sources.warehouse import Warehouse

ENROLMENT = ["id_student", "code_module", "code_presentation"]
KEY = [*ENROLMENT, "week_number", "id_site"]
WEEKS_PER_PART = 13
LAYER, NAME, ROLLUP = "gold", "engagement_state", "engagement_weekly"


def part(weeks: int = WEEKS_PER_PART) -> Column:
    """The part of the stored tables that a row belongs to, from its key; ``weeks`` must stay as it
    is as long as a table lives."""
    block = F.floor(F.col("week_number") / weeks).cast("string")
    name = F.concat_ws("-", F.coalesce("code_presentation", F.lit("none")),
                       F.coalesce(block, F.lit("none")))
    return F.regexp_replace(name, "[^0-9A-Za-z-]", "_")


def states_of(clicks: DataFrame) -> DataFrame:
    """The states of a load's clicks."""
    return clicks.withColumn("week_number", L.week_number(F.col("date"))).groupBy(*KEY).agg(
        *engagement.site_states())


def summary(stored: DataFrame, sites: DataFrame) -> DataFrame:
    """Weekly engagement from states, as ``fact_engagement_summary`` has it."""
    return engagement.from_states(stored, sites, ENROLMENT, "id_site",
                                  ["id_site", "code_module", "code_presentation"], "week_number")


def refresh(warehouse: Warehouse, clicks: DataFrame, sites: DataFrame, load: int,
            source: str = "loads", weeks: int = WEEKS_PER_PART) -> list[str]:
    """Add the clicks of a load, numbered upwards within its ``source``, to the stored states and
    roll up the weeks that it touches; returns the parts that were written."""
    once = (source, load)
    states = kept(states_of(clicks), "load-states")  # asked for three times
    touched = warehouse.upsert(states, LAYER, NAME, KEY, part(weeks), once, engagement.merged_states)
    rollup = [*ENROLMENT, "week_number"]
    changed = states.select("code_presentation", "week_number").distinct()
    same = F.col("code_presentation").eqNullSafe(F.col("_p")) & F.col("week_number").eqNullSafe(F.col("_w"))
    stored = warehouse.read_parts(LAYER, NAME, touched).join(
        changed.toDF("_p", "_w"), same, "left_semi")
    warehouse.upsert(summary(stored, sites), LAYER, ROLLUP, rollup, part(weeks), once,
                     engagement.newer_rows)
    return touched
