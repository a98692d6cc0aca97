"""Eigenpairs against a full decomposition, whitening against numpy, odd input."""

from __future__ import annotations

import math

import numpy as np
import pytest

from lakevault.llm import whitening
from lakevault.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def brute(rows, components=8):
    """Whitened rows from the full covariance matrix: (key, n, deviations, values, vectors, w)."""
    kept = [(k, v) for k, v in rows if v is not None
            and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x, strict=True)]
    exact = [[n * a - s for a, s in zip(v, sums, strict=True)] for v in x]
    c = np.array(exact, dtype=float) / n
    cov = c.T @ c / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    return ([k for k, _ in kept], n, [sum(d * d for d in v) for v in exact], values / np.trace(cov),
            c @ vectors / np.sqrt(values))


def test_query_against_a_full_decomposition(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()
    keys, n, deviations, shares, w = brute([(r[0], r[1]) for r in rows])
    got = {(r["vec_id"], r["component"]): r for r in
           QUERIES["op12_embedding_whitening"](spark, SF_DIR).collect()}
    assert len(got) == 8 * len(keys)
    assert {r["n"] for r in got.values()} == {n}
    assert len({r["identity_error"] for r in got.values()}) == 1
    assert next(iter(got.values()))["identity_error"] < 1e-10
    for c in range(8):
        mine = np.array([got[k, c + 1]["whitened"] for k in keys])
        sign = np.sign(mine @ w[:, c])
        assert np.abs(mine * sign - w[:, c]).max() < 1e-8
        assert got[keys[0], c + 1]["explained"] == pytest.approx(shares[c], rel=1e-10)
    assert all(got[k, 1]["deviation"] == d for k, d in zip(keys, deviations, strict=True))


@pytest.mark.parametrize("shape", ["steps", "flat", "pairs", "low rank", "small"])
def test_eigenpairs_of_hard_spectra(shape):
    rng = np.random.default_rng(3)
    d = 6 if shape == "small" else 80
    values = {"steps": 2.0 ** -np.arange(d), "flat": 1 + 0.001 * np.arange(d)[::-1],
              "pairs": np.repeat(np.arange(d // 2, 0, -1.0), 2), "small": np.arange(d, 0, -1.0),
              "low rank": np.r_[np.arange(9, 4, -1.0), np.zeros(d - 5)]}[shape]
    base = np.linalg.qr(rng.standard_normal((d, d)))[0]
    matrix = (base * values) @ base.T
    found, vectors = whitening.eigenpairs(lambda q: matrix @ q, d)
    k = min(8, d)
    assert found == pytest.approx(values[:k], rel=1e-9, abs=1e-9)
    assert vectors.T @ vectors == pytest.approx(np.eye(k), abs=1e-12)
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-10 * values[0]


def test_a_missed_direction_is_found():
    """The first block cannot see the largest eigenvector; the fresh vectors of the certificate do."""
    d = 60
    values = np.r_[100.0, np.linspace(50, 1, d - 1)]
    hidden = np.zeros(d)
    hidden[0] = 1
    calls = []

    def times(q):
        calls.append(q.shape)
        q = q.copy()
        if len(calls) <= 1:
            q[0] = 0
        return values[:, None] * q

    found, _ = whitening.eigenpairs(times, d)
    assert found[0] == pytest.approx(100.0, rel=1e-9)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = np.random.default_rng(1).normal(size=(40, 10)).astype(np.float32).astype(float).tolist()
    rows = [(i, v, "a") for i, v in enumerate(good)] + [(None, good[0], "b"), (1, good[1], "c")]
    bad = [(100, None, "x"), (101, [None] * 10, "x"), (102, [nan] + [0.0] * 9, "x"),
           (103, [0.0] * 9 + [inf], "x"), (104, [0.0] * 9 + [-inf], "x")]
    form = "vec_id long, embedding array<float>, x string"
    got = whitening.whiten(spark.createDataFrame(rows + bad, form)).collect()
    keys, n, deviations, _, w = brute([(k, v) for k, v, _ in rows])
    assert len(got) == 8 * n == 8 * 42
    assert sorted(int(r["deviation"]) for r in got if r["component"] == 1) == sorted(deviations)
    by_key = {}
    for r in got:
        by_key.setdefault((r["vec_id"], r["component"]), []).append(r["whitened"])
    assert all(len(set(by_key[1, c])) == 1 and len(by_key[1, c]) == 2 for c in range(1, 9))
    for c in range(8):
        mine = np.array([by_key[k, c + 1][0] for k in keys])
        assert np.abs(np.abs(mine) - np.abs(w[:, c])).max() < 1e-8


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 1.0])], [(1, []), (2, [])],
                                  [(i, [0.25, 0.5]) for i in range(20)]])
def test_nothing_to_whiten(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = whitening.whiten(df)
    assert out.collect() == []
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"]


def test_components_without_spread_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 3.0, float(i * i)]) for i in range(30)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in got} == {1, 2}
    assert got[0]["identity_error"] < 1e-8


def test_lengths_must_agree(spark):
    rows = [(1, [1.0]), (2, [1.0, 2.0])]
    with pytest.raises(Exception, match="differ in length"):
        whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))


def test_deviations_beyond_63_bits_are_exact(spark):
    rows = [(i, [float(i % 3) * 1e9, float(i), float(i * i)]) for i in range(50)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    _, _, deviations, _, _ = brute(rows, 3)
    assert max(deviations) > 2 ** 63
    assert sorted(int(r["deviation"]) for r in got if r["component"] == 1) == sorted(deviations)
