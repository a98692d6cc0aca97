"""Key, reference and value checks that return rows or counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakevault.operators.rules import Reference


# Key types of at most eight bytes: as short as the hash that would stand for them.
_SHORT = ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "boolean")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows (NULL keys included).

    Wide keys are screened first: rows are counted by a 64-bit hash of the key, which is all that is
    shuffled, and only rows whose hash was seen twice are grouped by the key itself. Equal keys have
    equal hashes, so nothing is missed; different keys of one hash part in the second step. Where
    no hash repeats, that step has no rows.
    """
    key = list(key)
    if len(key) == 1 and df.schema[key[0]].dataType.simpleString() in _SHORT:
        suspects = df.select(*key)
    else:
        hashed = df.select(*key, F.xxhash64(*key).alias("_hash"))
        twice = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        suspects = hashed.join(twice.select("_hash").hint("merge"), "_hash", "left_semi")
    return suspects.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unique_check(df: DataFrame, name: str, key: Sequence[str], ignore_null: bool = False,
                 ) -> DataFrame:
    """One row ``(model, test, columns, failed)``; failed counts the repeated keys."""
    rows = df.dropna(subset=list(key)) if ignore_null else df
    return duplicate_keys(rows, key).agg(F.count(F.lit(1)).alias("failed")).select(
        F.lit(name).alias("model"), F.lit("unique").alias("test"),
        F.lit(",".join(key)).alias("columns"), "failed")


def non_null_check(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """One row per column ``(model, test, columns, failed)`` from one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "columns", "failed").select(
        F.lit(name).alias("model"), F.lit("not_null").alias("test"), "columns", "failed")


def column_tests(df: DataFrame, name: str, not_null: Sequence[str] = (),
                 accepted: tuple[str, Sequence[str]] | None = None) -> DataFrame:
    """The declared not-null (rows missing any listed column) and accepted-value tests, one pass."""
    checks: list[tuple[str, str, Column]] = []
    if not_null:
        missing = reduce(or_, [F.col(c).isNull() for c in not_null])
        checks.append(("not_null", ",".join(not_null), missing))
    if accepted:
        column, values = accepted
        checks.append(("accepted_values", column, ~F.col(column).isin(list(values))))
    counted = df.agg(*[F.count_if(cond).alias(f"_c{i}") for i, (_, _, cond) in enumerate(checks)])
    rows = F.array(*[
        F.struct(F.lit(test).alias("test"), F.lit(cols).alias("columns"),
                 F.col(f"_c{i}").alias("failed"))
        for i, (test, cols, _) in enumerate(checks)
    ])
    return counted.select(F.lit(name).alias("model"), F.inline(rows))


def orphans(child: DataFrame, child_key: Sequence[str], parent: DataFrame,
            parent_key: Sequence[str]) -> DataFrame:
    """Child rows without a parent; a NULL key has none. A hot key splits under the skew join;
    parents are not broadcast, whatever a plan guesses of their size."""
    keys = parent.select(*[F.col(p).alias(c) for c, p in zip(child_key, parent_key, strict=True)])
    return child.join(keys.hint("merge"), list(child_key), "left_anti")


def _key_text(columns: Sequence[str]) -> Column:
    """A key as one text, different for different keys and the same for equal ones of any types."""
    return F.concat(*[F.coalesce(
        F.concat(F.char_length(F.col(c).cast("string")).cast("string"), F.lit(":"),
                 F.col(c).cast("string")), F.lit("-")) for c in columns])


def _whole(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def reference_totals(tables: Mapping[str, DataFrame], refs: Sequence[Reference]) -> DataFrame:
    """(rule, child_rows, orphan_rows, orphan_keys) per declared reference, all in one pass.

    Each table is read once, whatever references name it: a row gives one entry per reference, a
    counted one where it is the child and a mark where it is the parent. Entries reduce by
    (reference, key) ahead of the one shuffle, so a key that holds much of a table meets its parent
    as one row. A key with a NULL has no parent.
    """
    entries: dict[str, list[Column]] = {}
    for i, ref in enumerate(refs):
        for table, columns, child in ((ref.child, ref.child_columns, 1),
                                      (ref.parent, ref.parent_columns, 0)):
            known = F.lit(0) if child else _whole(columns).cast("int")
            entries.setdefault(table, []).append(F.struct(
                F.lit(i).alias("ref"), _key_text(columns).alias("key"),
                F.lit(child).cast("long").alias("rows"), known.alias("known")))
    told = reduce(DataFrame.unionByName, [
        tables[table].select(F.inline(F.array(*own))) for table, own in entries.items()])
    by_key = told.groupBy("ref", "key").agg(F.sum("rows").alias("rows"), F.max("known").alias("known"))
    lost = (F.col("known") == 0) & (F.col("rows") > 0)
    totals = by_key.groupBy("ref").agg(
        F.sum("rows").alias("child_rows"),
        F.coalesce(F.sum(F.when(lost, F.col("rows"))), F.lit(0)).alias("orphan_rows"),
        F.count_if(lost).alias("orphan_keys"))
    # a reference between empty tables has no entry and still one row
    labels = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(r.label).alias("rule"))
                       for i, r in enumerate(refs)])
    zero = F.lit(0).cast("long")
    every = totals.sparkSession.range(1).select(F.inline(labels)).select(
        F.col("i").alias("ref"), "rule", zero.alias("child_rows"), zero.alias("orphan_rows"),
        zero.alias("orphan_keys"))
    counts = ["child_rows", "orphan_rows", "orphan_keys"]
    return totals.select("ref", F.lit(None).cast("string").alias("rule"), *counts).unionByName(
        every).groupBy("ref").agg(F.max("rule").alias("rule"), *[F.sum(c).alias(c) for c in counts]
                                  ).drop("ref")


def reference_counts(tables: Mapping[str, DataFrame], refs: Sequence[Reference]) -> DataFrame:
    """Orphan rows and orphan keys per declared reference."""
    return reference_totals(tables, refs).select("rule", "orphan_rows", "orphan_keys")


def unique_counts(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Repeated keys and the rows they hold per table with a declared unique key."""
    parts = [
        duplicate_keys(tables[name], key).agg(
            F.count(F.lit(1)).alias("duplicate_keys"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("duplicate_rows"),
        ).select(F.lit(name).alias("table_name"), F.lit(",".join(key)).alias("columns"),
                 "duplicate_keys", "duplicate_rows")
        for name, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, parts)
