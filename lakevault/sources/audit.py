"""Append-only audit log: JSON lines in one folder per UTC day."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakevault.schemas import AUDIT_EVENT

DAY_COLUMNS = ("year", "month", "day")


def with_day(events: DataFrame) -> DataFrame:
    """Folder columns of the UTC day of an event, zero-padded as text."""
    ts = F.col("timestamp")
    return events.withColumns({
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    })


def to_lines(events: DataFrame) -> DataFrame:
    """Events as JSON text, one per row."""
    return events.select(F.to_json(F.struct(*AUDIT_EVENT.names)).alias("value"))


def from_lines(lines: DataFrame) -> DataFrame:
    """Events from JSON text; blank lines are ignored."""
    text = F.trim("value")
    return lines.filter(text != "").select(
        F.from_json(text, AUDIT_EVENT).alias("event")).select("event.*")


def on_day(events: DataFrame, day: str) -> DataFrame:
    """Events of one UTC day given as ``yyyy-MM-dd``."""
    return events.filter(F.to_date("timestamp") == F.lit(day).cast("date"))


class AuditLog:
    """Audit trail under ``root``; events are only ever appended."""

    def __init__(self, spark: SparkSession, root: str, principal: str = "pipeline"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.principal = principal

    def append(self, events: DataFrame) -> None:
        """Add a frame of events."""
        with_day(events.select(*AUDIT_EVENT.names)).write.mode("append").partitionBy(
            *DAY_COLUMNS).json(self.root)

    def log(self, action: str, resource: str, detail: dict | None = None,
            principal: str | None = None, now: datetime | None = None) -> None:
        """Add one event."""
        row = (now or datetime.now(UTC), principal or self.principal, action, resource,
               json.dumps(detail or {}, default=str))
        self.append(self.spark.createDataFrame([row], AUDIT_EVENT))

    def read_day(self, day: datetime) -> DataFrame:
        """Events of one UTC day; only that day's folder is read, an absent one is empty."""
        folder = f"{self.root}/year={day:%Y}/month={day:%m}/day={day:%d}"
        target = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = target.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(target):
            return self.spark.createDataFrame([], AUDIT_EVENT)
        return self.spark.read.schema(AUDIT_EVENT).json(folder)

    def read_today(self) -> DataFrame:
        return self.read_day(datetime.now(UTC))
