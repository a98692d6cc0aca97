"""Declared quality rules compiled into one aggregation per table."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESULT_COLUMNS = ["table_name", "layer", "rule", "column", "severity",
                  "evaluated_rows", "failed_rows", "success"]
TOP_FAILURES = 10


@dataclass(frozen=True)
class Rule:
    """One expectation on one column. NULL passes every rule but ``not_null``."""

    table: str
    kind: str  # not_null | range | allowed
    column: str
    severity: str = "critical"
    name: str = ""
    low: float | None = None
    high: float | None = None
    allowed: tuple = ()

    @property
    def label(self) -> str:
        return self.name or self.kind

    def violated(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "range":
            bounds = []
            if self.low is not None:
                bounds.append(c < self.low)
            if self.high is not None:
                bounds.append(c > self.high)
            return reduce(or_, bounds)
        if self.kind == "allowed":
            return ~c.isin(list(self.allowed))
        raise ValueError(f"rule kind {self.kind!r} is not a row rule")


@dataclass(frozen=True)
class Reference:
    """Every child key must exist among the parent keys."""

    child: str
    child_columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]

    @property
    def label(self) -> str:
        return f"{self.child}({','.join(self.child_columns)})->" \
               f"{self.parent}({','.join(self.parent_columns)})"


@dataclass(frozen=True)
class Drift:
    """Allowed change of one column against a baseline frame."""

    table: str
    column: str
    kind: str  # categorical | numeric
    limit: float


@dataclass(frozen=True)
class RuleSet:
    rows: tuple[Rule, ...] = ()
    unique: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    references: tuple[Reference, ...] = ()
    drift: tuple[Drift, ...] = ()


def rules_from_mapping(declared: Mapping) -> RuleSet:
    """Rule set from the declarative layout (lists under ``not_null_checks`` and so on)."""
    rows = [
        Rule(e["table"], "not_null", c)
        for e in declared.get("not_null_checks", []) for c in e["columns"]
    ]
    rows += [
        Rule(e["table"], "range", e["column"], low=e.get("min"), high=e.get("max"))
        for e in declared.get("range_checks", [])
    ]
    for section in ("business_rules", "custom_checks"):
        rows += [
            Rule(e["table"], "allowed", e["column"], e.get("severity", "warning"),
                 e.get("name", "allowed_values"), allowed=tuple(e["allowed_values"]))
            for e in declared.get(section, []) if "allowed_values" in e
        ]

    def cols(value) -> tuple[str, ...]:
        return (value,) if isinstance(value, str) else tuple(value)

    return RuleSet(
        rows=tuple(rows),
        unique={e["table"]: cols(e["columns"]) for e in declared.get("unique_checks", [])},
        references=tuple(
            Reference(e["child_table"], cols(e["child_column"]),
                      e["parent_table"], cols(e["parent_column"]))
            for e in declared.get("referential_integrity", [])
        ),
        drift=tuple(
            Drift(e["table"], e["column"], e["profile_type"],
                  e.get("max_drift_percent", e.get("max_drift_zscore")))
            for e in declared.get("distribution_checks", [])
        ),
    )


def rules_from_file(path: str) -> RuleSet:
    """Rule set from a YAML (when a YAML reader is installed) or JSON file."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        declared = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("reading YAML rules needs a YAML package, use JSON") from e
        declared = yaml.safe_load(text)
    return rules_from_mapping(declared.get("rules", declared))


def validate_table(df: DataFrame, table: str, rules: Sequence[Rule], layer: str = "bronze",
                   ) -> DataFrame:
    """Outcome of every rule of a table, one row per rule, from one pass over the rows.

    All counters sit in a single ungrouped aggregation, so a table is read once however many
    rules it has, and only the columns some rule names are read. A rule on a column the frame
    does not have fails with an unknown number of rows.
    """
    todo = [r for r in rules if r.table == table]
    counts = [F.count(F.lit(1)).alias("_all")]
    for i, r in enumerate(todo):
        if r.column in df.columns:
            counts.append(F.count_if(r.violated()).alias(f"_r{i}"))
        else:
            counts.append(F.max(F.lit(None).cast("bigint")).alias(f"_r{i}"))
    if not todo:
        todo_rows = F.array().cast("array<struct<rule:string,column:string,severity:string,"
                                   "failed_rows:bigint>>")
    else:
        todo_rows = F.array(*[
            F.struct(
                F.lit(r.label).alias("rule"), F.lit(r.column).alias("column"),
                F.lit(r.severity).alias("severity"), F.col(f"_r{i}").alias("failed_rows"))
            for i, r in enumerate(todo)
        ])
    return df.agg(*counts).select(
        F.col("_all").alias("evaluated_rows"), F.inline(todo_rows)
    ).select(
        F.lit(table).alias("table_name"), F.lit(layer).alias("layer"), "rule", "column",
        "severity", "evaluated_rows", "failed_rows",
        F.coalesce(F.col("failed_rows") == 0, F.lit(False)).alias("success"),
    )


def validate_all(tables: Mapping[str, DataFrame | None], rules: Sequence[Rule],
                 layer: str = "bronze") -> DataFrame:
    """Outcomes of several tables; absent and empty tables are left out."""
    parts = [validate_table(df, name, rules, layer) for name, df in tables.items()
             if df is not None]
    return reduce(DataFrame.unionByName, parts).filter("evaluated_rows > 0")


def applicable(tables: Mapping[str, DataFrame | None], rules: Sequence[Rule]) -> list[Rule]:
    """The rules whose column the named table has: for models that carry a part of the columns."""
    return [r for r in rules if tables.get(r.table) is not None
            and r.column in tables[r.table].columns]


def pass_rate(passed: Column, evaluated: Column) -> Column:
    """Percentage with two decimals, 0 when nothing was evaluated."""
    share = (passed * 100).cast("decimal(18,6)") / F.nullif(evaluated, F.lit(0))
    return F.coalesce(F.round(share, 2), F.lit(0)).cast("decimal(5,2)")


def summarize(results: DataFrame) -> DataFrame:
    """Pipeline totals over all outcomes, always one row."""
    failed = F.count_if(~F.col("success"))
    totals = results.agg(
        F.count(F.lit(1)).alias("total_expectations"),
        F.count_if("success").alias("total_passed"),
        failed.alias("total_failed"),
    )
    return totals.select(
        (F.col("total_failed") == 0).alias("pipeline_success"), "total_expectations",
        "total_passed", "total_failed",
        pass_rate(F.col("total_passed"), F.col("total_expectations")).alias("pass_rate"),
    )


def summarize_tables(results: DataFrame) -> DataFrame:
    """Passed, failed and success per table."""
    return results.groupBy("table_name", "layer").agg(
        F.count(F.lit(1)).alias("expectations_evaluated"),
        F.count_if("success").alias("expectations_passed"),
        F.count_if(~F.col("success")).alias("expectations_failed"),
        F.every("success").alias("success"),
        F.max("evaluated_rows").alias("row_count"),
    )


def top_failures(results: DataFrame, limit: int = TOP_FAILURES) -> DataFrame:
    """The first failing rules per table, in rule and column order."""
    order = Window.partitionBy("table_name", "layer").orderBy("rule", "column")
    return (
        results.filter(~F.col("success"))
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") <= limit)
        .select("table_name", "layer", "position", "rule", "column", "severity", "failed_rows")
    )


class CriticalRuleFailed(RuntimeError):
    """Raised by :func:`require_critical` when a critical rule has failing rows."""


def require_critical(results: DataFrame) -> None:
    """Gate of the pipeline: stop when any critical rule failed, and name all of them. There is one
    result row for each declared rule."""
    bad = results.filter("severity = 'critical' and not success").select(
        "layer", "table_name", "rule", "column").orderBy(
        "layer", "table_name", "column", "rule").collect()
    if bad:
        raise CriticalRuleFailed("; ".join(
            f"{r.layer}.{r.table_name}.{r.column}: {r.rule}" for r in bad))
