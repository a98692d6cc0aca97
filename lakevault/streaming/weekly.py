"""Weekly engagement as a stateful stream.

State is kept for each (student, offering, week, site): clicks, their number, the largest, the days
as a bit set. The event time of a click is the end of its week, seven days counted from the start of
its presentation, and a week is open until a click has come whose week ends ``delay`` later. A click
of a week that is closed is late: the stream drops it, and ``late_clicks`` counts it.

Every batch hands on the states it changed, whole, and the sink replaces these in a stored table, in
the parts (presentation, week) that they belong to. A closed week is never read again. The rollup
per week is taken from the stored states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault import functions as L
from lakevault.functions.scalars import DAYS_PER_WEEK
from lakevault.operators import engagement
from lakevault.plans.engagement_state import KEY, LAYER, NAME, part
from lakevault.sources.shared import stored
from lakevault.sources.warehouse import Warehouse
from lakevault.streaming.landing import Batch, Sink

WEEK_END = "week_end"


def presentation_day(presentation: Column) -> Column:
    """First day of the month that a code such as 2013J names: A is January, L is December. NULL for
    a code of another form; such clicks are never late and close no week."""
    month = F.ascii(F.substring(presentation, 5, 1)) - 64
    fine = presentation.rlike("^[0-9]{4}[A-L]$")
    return F.when(fine, F.make_date(F.left(presentation, F.lit(4)).try_cast("int"), month, F.lit(1)))


def week_end(date: Column, presentation: Column) -> Column:
    """The first moment after the week that a click's day belongs to."""
    days = ((L.week_number(date) + 1) * DAYS_PER_WEEK).cast("int")
    return F.date_add(presentation_day(presentation), days).cast("timestamp")


def states(clicks: DataFrame, delay: str) -> DataFrame:
    """The changing states of a stream of clicks, for output mode ``update``."""
    rows = clicks.withColumns({
        "week_number": L.week_number(F.col("date")),
        WEEK_END: week_end(F.col("date"), F.col("code_presentation"))})
    return rows.withWatermark(WEEK_END, delay).groupBy(WEEK_END, *KEY).agg(*engagement.site_states())


def into_states(root: str) -> Sink:
    """A sink that replaces changed states in the stored table."""
    def write(rows: DataFrame, batch: Batch) -> None:
        # the upsert asks for its rows several times; each time the state would be read and written
        changed = stored(rows.drop(WEEK_END), "changed-states")
        Warehouse(rows.sparkSession, root).upsert(
            changed, LAYER, NAME, KEY, part(), batch, engagement.newer_rows)
    return write


def late_clicks(landed: DataFrame, stored: DataFrame,
                by: Sequence[str] = ("code_module", "code_presentation")) -> DataFrame:
    """(by, week_number, landed, accepted, late): clicks of each week that have landed, that are in
    the states, and that came too late."""
    group = [*by, "week_number"]
    came = landed.withColumn("week_number", L.week_number(F.col("date"))).groupBy(*group).agg(
        F.count(F.lit(1)).alias("landed"), F.lit(0).cast("long").alias("accepted"))
    kept = stored.groupBy(*group).agg(F.lit(0).cast("long").alias("landed"),
                                      F.sum("_seen").alias("accepted"))
    return came.unionByName(kept).groupBy(*group).agg(
        F.sum("landed").alias("landed"), F.sum("accepted").alias("accepted")).withColumn(
        "late", F.col("landed") - F.col("accepted"))
