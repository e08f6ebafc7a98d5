"""Whitening: eigenpairs against numpy's, whole results against a numpy model."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inboxlens.llm import queries
from inboxlens.llm.whitening import below, fit_whitening, leading_eigenpairs, tridiagonal, whiten
from tests.conftest import SF_ORACLE

SCHEMA = "vec_id long, embedding array<double>, component string, x string, n string"


def frame(spark, vectors, first=0):
    return spark.createDataFrame([(first + i, v, "c", "x", "n") for i, v in enumerate(vectors)], SCHEMA)


def brute(rows, k=4, scale=256):
    """``{place: (deviation, whitened)}``, explained and n by numpy's own solver."""
    fine = {i: v for i, v in enumerate(rows) if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    d = max(map(len, fine.values()))
    xs = {i: tuple(math.floor(scale * float(c)) for c in v) + (0,) * (d - len(v)) for i, v in fine.items()}
    fit = sorted(set(xs.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]

    def centred(x):
        return [(n * c - s) / n for c, s in zip(x, sums)]  # whole numbers until the division

    z = np.array([centred(x) for x in fit])
    e, v = np.linalg.eigh(z.T @ z / n)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    out = {i: (sum((n * c - s) ** 2 for c, s in zip(x, sums)), np.array(centred(x)) @ v / np.sqrt(e))
           for i, x in xs.items()}
    return out, e / np.trace(z.T @ z / n), n


def check(df, rows, k=4):
    want, explained, n = brute(rows, k)
    got = df.collect()
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(by) == set(want) and all(sorted(r) == list(range(1, k + 1)) for r in by.values())
    assert {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and 0 <= got[0]["identity_error"] <= 1e-4
    for i, (deviation, _) in want.items():
        assert {int(r["deviation"]) for r in by[i].values()} == {deviation}
    for c in range(k):
        mine = np.array([by[i][c + 1]["whitened"] for i in want])
        theirs = np.array([w[c] for _, w in want.values()])
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < 1e-8
        assert {r[c + 1]["explained"] for r in by.values()} == {by[next(iter(want))][c + 1]["explained"]}
        assert by[next(iter(want))][c + 1]["explained"] == pytest.approx(explained[c], rel=1e-10)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 24), st.integers(0, 10_000), st.sampled_from([1e-12, 1.0, 1e12]))
def test_eigenpairs(d, seed, size):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(d, d))
    a = size * (a + a.T)
    e, v = leading_eigenpairs(a, 4)
    k, norm = min(4, d), np.linalg.norm(a, 2)
    assert np.abs(e - np.linalg.eigvalsh(a)[::-1][:k]).max() <= 1e-12 * norm
    assert np.abs(v.T @ v - np.eye(k)).max() < 1e-12
    assert np.abs(a @ v - v * e).max() <= 1e-11 * norm


@pytest.mark.parametrize("values", [[5, 5, 5, 5, 1, 0], [3, 3 - 1e-13, 3 - 2e-13, 1, 1, 1], [1, 0, 0, 0, 0, 0],
                                    [7, 7, 7, 7, 7, 7], [1e8, 1, 1e-4, 1e-5, 0, 0]])
def test_clustered_eigenvalues(values):
    q, _ = np.linalg.qr(np.random.default_rng(1).normal(size=(6, 6)))
    for a in (q * values @ q.T, np.diag(np.array(values, dtype=float))):
        e, v = leading_eigenpairs((a + a.T) / 2, 4)
        assert np.allclose(e, sorted(values, reverse=True)[:4], atol=1e-12 * max(values))
        assert np.abs(v.T @ v - np.eye(4)).max() < 1e-12
        assert np.abs(a @ v - v * e).max() < 1e-12 * max(values)


def test_tridiagonal_and_counts():
    a = np.random.default_rng(2).normal(size=(9, 9))
    a = a + a.T
    diagonal, beside, _ = tridiagonal(a)
    e = np.linalg.eigvalsh(a)
    t = np.diag(diagonal) + np.diag(beside, 1) + np.diag(beside, -1)
    assert np.allclose(np.linalg.eigvalsh(t), e)
    at = np.linspace(-10, 10, 41)
    assert below(diagonal, beside, at).tolist() == [(e < x).sum() for x in at]


def test_rows_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [v.tolist() for v in rng.normal(size=(60, 6))]
    rows += [rows[0]] * 40 + [None, [1.0, None, 0.0, 0.0, 0.0, 0.0], [math.nan] * 6, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0],
                              [-0.0, 0.001, 0.0, 0.0, 0.0, 0.0], [], [0.5, -0.25], [100.0] * 6]
    df = frame(spark, rows)
    check(whiten(df), rows)
    # repeated rows and null ids are rows too
    twice = whiten(df.union(df).withColumn("vec_id", F.when(F.col("vec_id") > 0, F.col("vec_id"))))
    assert twice.count() == 2 * 4 * (len(rows) - 4)
    assert twice.where("vec_id is null").count() == 8


def test_distant_mean_and_large_sums(spark):
    rng = np.random.default_rng(4)
    rows = (1e9 + rng.normal(size=(50, 5))).tolist()
    check(whiten(frame(spark, rows)), rows)
    big = [[s * 1e12, float(i)] for i, s in enumerate([-1, 1, 1, -1, 1])]  # beyond 64 bits
    out = {r["vec_id"]: int(r["deviation"]) for r in whiten(frame(spark, big), 1).collect()}
    assert out == {i: d for i, (d, _) in brute(big, 1)[0].items()} and max(out.values()) > 2 ** 63


def test_few_dimensions_no_variance_and_empty(spark):
    rows = [[0.0, 0.0], [1.0, 2.0], [3.0, 1.0], [5.0, -2.0]]
    check(whiten(frame(spark, rows)), rows, 2)
    line = whiten(frame(spark, [[float(i), 2.0 * i, 0.0] for i in range(9)])).collect()
    assert {r["component"] for r in line} == {1} and line[0]["explained"] == pytest.approx(1)
    for same in ([[1.0, 2.0]] * 3, [[]], [None], []):
        assert fit_whitening(frame(spark, same)) is None
        assert whiten(frame(spark, same)).collect() == []


def test_query_on_whole_table(spark):
    df = queries.op13_whitening(spark, SF_ORACLE)
    assert dict(df.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
                               "whitened": "double", "explained": "double", "identity_error": "double"}
    table = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r["vec_id"] for r in table] == list(range(len(table)))
    check(df, [r["embedding"] for r in table])
