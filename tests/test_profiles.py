"""Profiles that merge, references in one pass, screened keys, swept days: against plain versions."""

from __future__ import annotations

import collections
import random

import pytest
from pyspark.sql import functions as F

from lakevault.operators import anomaly, drift, ingest, integrity, profile
from lakevault.operators.rules import Drift, Reference

CHECKS = (Drift("t", "kind", "categorical", 5.0), Drift("t", "size", "numeric", 3.0),
          Drift("u", "kind", "categorical", 5.0))
FORM = "kind string, size double"


def table(spark, seed, rows=300):
    rng = random.Random(seed)
    return spark.createDataFrame([
        (rng.choice(["a", "b", "c", None, "d" * (seed % 2)]),
         rng.choice([None, rng.gauss(1e6 + seed, 1)])) for _ in range(rows)], FORM)


def found(df):
    return {(r["table_name"], r["column"]): (r["kind"], r["drift"], r["allowed"], r["exceeds"])
            for r in df.collect()}


def test_profiles_tell_the_drift_of_rows(spark):
    old, new = table(spark, 1), table(spark, 2)
    checks = CHECKS[:2]
    from_rows = found(drift.run({"t": old}, {"t": new}, checks))
    from_profiles = found(profile.drift(profile.profile({"t": old}, checks),
                                        profile.profile({"t": new}, checks), checks))
    assert from_profiles.keys() == from_rows.keys()
    for k, (kind, value, allowed, exceeds) in from_rows.items():
        assert from_profiles[k] == (kind, pytest.approx(value, rel=1e-9), allowed, exceeds)


def test_merged_profiles_are_those_of_all_rows(spark):
    parts = [table(spark, s, 50 + 100 * s) for s in range(3)] + [spark.createDataFrame([], FORM)]
    whole = parts[0].union(parts[1]).union(parts[2])
    merged = profile.merged(*(profile.profile({"t": p}, CHECKS) for p in parts))
    want = {tuple(r)[:4]: r for r in profile.profile({"t": whole}, CHECKS).collect()}
    got = {tuple(r[c] for c in profile.KEY): r for r in merged.collect()}
    assert got.keys() == want.keys()
    for k, r in want.items():
        assert got[k]["n"] == r["n"]
        if r["mean"] is not None:
            assert got[k]["mean"] == pytest.approx(r["mean"])
            assert got[k]["m2"] == pytest.approx(r["m2"], rel=1e-9)


def test_profiles_without_rows_or_spread(spark):
    none = profile.profile({"t": spark.createDataFrame([], FORM)}, CHECKS)
    flat = profile.profile({"t": spark.createDataFrame([("a", 1.0)] * 3, FORM)}, CHECKS)
    other = profile.profile({"t": spark.createDataFrame([("b", 9.0)], FORM)}, CHECKS)
    assert found(profile.drift(none, none, CHECKS)) == {}
    assert found(profile.drift(flat, other, CHECKS)) == {
        ("t", "kind"): ("categorical", 100.0, 5.0, True), ("t", "size"): ("numeric", None, 3.0, False)}
    with pytest.raises(ValueError, match="no checked table"):
        profile.profile({"x": none}, CHECKS)


REFS = [Reference("child", ("a",), "parent", ("k",)),
        Reference("child", ("a", "b"), "pairs", ("x", "y")), Reference("pairs", ("x",), "parent", ("k",)),
        Reference("empty", ("a",), "parent", ("k",))]


def test_references_against_joins(spark):
    rng = random.Random(4)
    some = [None, "1", "2", "11", "1:1", "", "-", "3"]
    child = [(rng.choice(some), rng.choice(some)) for _ in range(400)]
    pairs = [(rng.choice(some), rng.choice(some)) for _ in range(20)]
    tables = {
        "child": spark.createDataFrame(child, "a string, b string"),
        "pairs": spark.createDataFrame(pairs, "x string, y string"),
        "parent": spark.createDataFrame([(1,), (2,), (None,), (2,)], "k long"),
        "empty": spark.createDataFrame([], "a long")}
    got = {r["rule"]: tuple(r)[1:] for r in integrity.reference_totals(tables, REFS).collect()}

    def lost(rows, known):
        keys = collections.Counter(r for r in rows if None in r or r not in known)
        return len(rows), sum(keys.values()), len(keys)

    ids, known = {("1",), ("2",)}, {p for p in pairs if None not in p}
    assert got == {
        REFS[0].label: lost([(a,) for a, _ in child], ids), REFS[1].label: lost(child, known),
        REFS[2].label: lost([(x,) for x, _ in pairs], ids), REFS[3].label: (0, 0, 0)}


def test_every_table_of_references_is_read_once(spark):
    tables = {n: spark.range(3).select(F.col("id").alias("a"), F.col("id").alias("b"), F.col(
        "id").alias("x"), F.col("id").alias("y"), F.col("id").alias("k")) for n in
        ("child", "pairs", "parent", "empty")}
    plan = integrity.reference_counts(tables, REFS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 3") == 4 and "Join" not in plan


@pytest.mark.parametrize("key", [["a"], ["a", "b"], ["m"]])
def test_screened_keys_against_counting(spark, key):
    rng = random.Random(7)
    rows = [(rng.choice(["x", "y", None, *map(str, range(300))]), rng.choice(["p", None]), rng.randrange(300))
            for _ in range(400)]
    df = spark.createDataFrame(rows, "a string, b string, m long")
    at = [df.columns.index(c) for c in key]
    want = collections.Counter(tuple(r[i] for i in at) for r in rows)
    got = {tuple(r)[:-1]: r["n"] for r in integrity.duplicate_keys(df, key).collect()}
    assert got == {k: n for k, n in want.items() if n > 1}


def test_keys_that_share_a_hash_are_told_apart(spark, monkeypatch):
    df = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "2"), ("c", "2")], "a string, b string")
    monkeypatch.setattr(integrity.F, "xxhash64", lambda *cols: F.lit(5).cast("long"))
    assert [tuple(r) for r in integrity.duplicate_keys(df, ["a", "b"]).collect()] == [("c", "2", 2)]


def test_a_wide_key_shuffles_its_hash_alone(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("a"), F.md5(F.lit("x")).alias("b"))
    plan = integrity.duplicate_keys(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_hash" in plan and plan.index("hashpartitioning(a") < plan.index(
        "hashpartitioning(_hash")


@pytest.mark.parametrize("days", [1, 7, 256])
def test_swept_days_against_pairs(spark, days, monkeypatch):
    monkeypatch.setattr(anomaly, "SWEEP_DAYS", days)
    rng = random.Random(days)
    subs = [(rng.choice([1, 2, None]), rng.choice([None, *range(-20, 20)])) for _ in range(200)]
    regs = [(rng.choice([1, 2, 3, None]), rng.choice([None, *range(-20, 20)])) for _ in range(60)]
    s = spark.createDataFrame(subs, "id_student long, date_submitted long")
    r = spark.createDataFrame(regs, "id_student long, date_registration long")
    want = sum(a == b and a is not None and d is not None and e is not None and d < e
               for a, d in subs for b, e in regs)
    out = anomaly.assessment_before_counts(s, r)
    assert out.first()["count"] == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert anomaly.assessment_before_counts(s.limit(0), r).first()["count"] == 0


def test_repeated_keys_are_probed_in_the_same_shuffle(spark, tmp_path):
    rows = [(1, None, 1), (1, 2.0, 2), (2, None, 3), (None, 4.0, 4)]
    spark.createDataFrame(rows, "k long, score double, line long").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = ingest.dedup_sum(df, ["k"], "line")
    assert sorted(map(tuple, out.collect())) == [(1, 2.0), (2, 0.0)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert "ReusedExchange" in plan, final
    apart = df.filter("line > 1")
    assert sorted(map(str, ingest.dedup_sum(apart, ["k"], "line").collect())) == sorted(
        map(str, apart.drop("line").collect()))
