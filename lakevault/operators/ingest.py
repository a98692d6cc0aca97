"""Raw text frame to typed bronze frame: header cleaning, validation, coercion, duplicate keys."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakevault.functions import blank_na, pseudonym, to_double, to_long, to_long_or_zero
from lakevault.schemas import TableSpec

FILE_ORDER = "_file_order"


def clean_header(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Strip blanks from the header, then apply the aliases that are present.

    Stripping comes first, so a padded alias header is accepted too.
    """
    return df.toDF(*[c.strip() for c in df.columns]).withColumnsRenamed(spec.aliases)


def schema_problems(columns: Sequence[str], spec: TableSpec) -> list[tuple[str, str]]:
    """(kind, column) for every expected column that is absent and every extra one present."""
    actual = {c for c in columns if c != FILE_ORDER}
    expected = set(spec.columns)
    return (
        [("missing", c) for c in sorted(expected - actual)]
        + [("unexpected", c) for c in sorted(actual - expected)]
    )


def schema_errors(columns: Sequence[str], spec: TableSpec) -> list[str]:
    """One message per kind of schema problem, empty when the header is as declared."""
    problems = schema_problems(columns, spec)
    return [
        f"{kind} columns: {[c for k, c in problems if k == kind]}"
        for kind in ("missing", "unexpected")
        if any(k == kind for k, _ in problems)
    ]


def schema_check(spark: SparkSession, headers: dict[str, Sequence[str]],
                 specs: dict[str, TableSpec]) -> DataFrame:
    """Schema problems of several sources as rows ``(table, kind, column)``."""
    rows = [
        (source, kind, column)
        for source, columns in headers.items()
        for kind, column in schema_problems(
            [specs[source].aliases.get(c.strip(), c.strip()) for c in columns], specs[source])
    ]
    return spark.createDataFrame(rows, "table string, kind string, column string")


def coerce(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Text cells to the declared types.

    Zero-filled integers never hold NULL afterwards, and the schema says so, which lets
    :func:`dedup_sum` skip its duplicate probe where no NULL can occur. The untyped day and
    flag columns of submissions are stored as nullable integers.
    """
    casts: dict[str, Column] = {}
    for name, kind in spec.columns.items():
        cell = F.col(name)
        if name in spec.zero_filled:
            casts[name] = to_long_or_zero(cell)
        elif isinstance(kind, T.LongType):
            casts[name] = to_long(cell)
        elif isinstance(kind, T.DoubleType):
            casts[name] = to_double(cell)
        else:
            casts[name] = blank_na(cell)
    keep = [F.col(FILE_ORDER)] if FILE_ORDER in df.columns else []
    return df.select(*[c.alias(n) for n, c in casts.items()], *keep)


def dedup_sum(df: DataFrame, pk: Sequence[str], order_by: str, null_sum: str = "zero",
              read: Observation | None = None) -> DataFrame:
    """One row per key: numeric columns summed, others the first non-null by ``order_by``. ``read``
    observes on the way how many rows and keys (``rows``, ``keys``) there were.

    ``null_sum="zero"`` keeps the data-dependent rule of the reference semantics: as soon as the
    table holds any duplicate key, every missing number becomes 0 (also on keys that occur once)
    and rows with a NULL key are dropped; without duplicates nothing changes.
    ``null_sum="keep"`` leaves a sum of nothing as NULL.

    The duplicate probe is the largest number of rows that a key of the same grouping has, read back
    as a scalar subquery. It looks at all columns of the grouping, so that both are one shuffle and
    the input is read once. It is left out when the schema proves that no key or number can be NULL,
    as for clicks, where the answer could not matter.
    """
    pk = list(pk)
    values = [f for f in df.schema.fields if f.name not in pk and f.name != order_by]
    numeric = {f.name for f in values if isinstance(f.dataType, T.NumericType)}
    aggs = []
    for f in values:
        if f.name in numeric:
            aggs.append(F.sum(f.name).cast(f.dataType).alias(f.name))
        else:
            first = f"min_by(`{f.name}`, `{order_by}`) filter (where `{f.name}` is not null)"
            aggs.append(F.expr(first).alias(f.name))
    counted = df.groupBy(*pk).agg(*aggs, F.count(F.lit(1)).alias("_n"))
    out = counted.observe(read, F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("keys")
                          ) if read else counted

    nullable = {f.name for f in df.schema.fields if f.nullable}
    if nullable & (set(pk) | numeric):
        probe = counted.agg(F.max("_n").alias("n"), F.bit_xor(F.xxhash64(*counted.columns)).alias("all"))
        repeated = F.coalesce(probe.select(F.struct("n", "all")).scalar()["n"] > 1, F.lit(False))
        # a row of its own, so that the probe is asked once and not in each use
        out = out.select("*", F.inline(F.array(F.struct(repeated.alias("_dup")))))
        has_dup = F.col("_dup")
        # every key has rows; asking keeps the count in the grouping, which makes it that of the probe
        out = out.filter((F.col("_n") > 0) & (~has_dup | _all_present(pk)))
        if null_sum == "zero":
            out = out.withColumns({
                c: F.when(has_dup, F.coalesce(F.col(c), F.lit(0))).otherwise(F.col(c))
                .cast(df.schema[c].dataType)
                for c in numeric & nullable
            })
    return out.select(*[f.name for f in df.schema.fields if f.name != order_by])


def _all_present(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def pseudonymise(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Replace personal fields by their pseudonym."""
    return df.withColumns({c: pseudonym(c) for c in fields if c in df.columns})


def to_bronze(raw: DataFrame, spec: TableSpec, load_ts: datetime, source_file: str,
              null_sum: str = "zero", read: Observation | None = None) -> DataFrame:
    """Cleaned text frame to bronze rows, one lazy plan.

    ``raw`` must carry the declared columns plus :data:`FILE_ORDER`; the only shuffles are the
    ones of the duplicate-key step.
    """
    typed = dedup_sum(coerce(raw, spec), spec.pk, FILE_ORDER, null_sum, read)
    return (
        pseudonymise(typed, spec.pii)
        .select(*spec.columns)
        .withColumns({
            "_ingested_at": F.lit(load_ts).cast("timestamp"),
            "_source_file": F.lit(source_file),
        })
    )
