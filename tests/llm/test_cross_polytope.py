"""Nearest neighbours against brute force."""

import numpy as np
import pytest

from inboxlens.llm.cross_polytope import Params, nearest, rotations, signed_axes

ROW = "vec_id long, embedding array<{}>, label int"


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0)
                                  for i, v in rows], ROW.format(kind))


def brute(rows, every=20, k=20):
    out = {}
    for q, v in rows:
        if q % every == 0:
            scored = sorted(((-float(np.dot(v.astype(float), w.astype(float))), i) for i, w in rows if i != q))[:k]
            out[q] = [(i, -s) for s, i in scored]
    return out


def vectors(n, d, seed=1, spread=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if spread:
        x *= rng.uniform(0.2, 3, n)[:, None]
    return [(i, v.astype(np.float32)) for i, v in enumerate(x)]


@pytest.mark.parametrize("d,spread", [(64, False), (48, True), (3, True)])
def test_recall(spark, d, spread):
    rows = vectors(700, d, spread=spread)
    want = brute(rows)
    got = {}
    for r in nearest(frame(spark, rows)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    found = 0
    for q, own in got.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, len(own) + 1))
        found += len({i for _, i, _ in own} & {i for i, _ in want[q]})
        for (_, i, s), (_, j, t) in zip(own, own[1:], strict=False):
            assert s > t or (s == t and i < j)
        exact = dict(rows)
        for _, i, s in own:
            assert s == pytest.approx(float(exact[q].astype(float) @ exact[i].astype(float)), abs=1e-12)
    assert found >= 0.9 * sum(map(len, want.values()))


def test_copies_and_split_buckets(spark):
    """A third of all rows is one vector; its bucket is dealt over several tasks."""
    rows = vectors(300, 16)
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    p = Params(bucket_rows=16)
    a = sorted(tuple(r) for r in nearest(frame(spark, rows), p=p).collect())
    b = sorted(tuple(r) for r in nearest(frame(spark, rows), p=Params()).collect())
    assert a == b
    first = [r[2] for r in a if r[0] == 0]
    assert first == list(range(1000, 1020))  # ties go to the smaller vec_id


def test_vectors_that_take_no_part(spark):
    good = vectors(40, 4)
    odd = [(100, None), (120, [0, 0, 0, 0]), (140, [1, None, 0, 0]), (160, [1, float("nan"), 0, 0]),
           (180, [float("inf"), 0, 0, 0]), (200, [1, 2, 3]), (220, [])]
    rows = [(i, v.tolist()) for i, v in good] + odd + [(None, [1, 0, 0, 0])] + [(0, good[0][1].tolist())]
    got = nearest(frame(spark, rows, "double"), k=50).collect()
    assert {r.query_id for r in got} == {0, 20} and {r.vec_id for r in got} <= {i for i, _ in good}
    assert nearest(spark.createDataFrame([], ROW.format("float"))).count() == 0
    assert nearest(frame(spark, [(0, [1.0])])).count() == 0
    pair = nearest(frame(spark, [(0, [1.0]), (1, [2.0])])).collect()
    assert [tuple(r) for r in pair] == [(0, 1, 1, 2.0)]


@pytest.mark.parametrize("times", [3, 100, 1e-3])
def test_one_row_of_another_length(spark, times):
    rows = vectors(700, 64)
    rows[7] = (7, rows[7][1] * np.float32(times))
    want, got = brute(rows), {}
    for r in nearest(frame(spark, rows)).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(got) == set(want) and all(len(own) == 20 for own in got.values())
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) >= 0.9 * 20 * len(want)


def test_queries_with_too_few_found_are_compared_with_all(spark):
    """One probe in one table finds few; two rows of every three have another length."""
    rows = [(i, v * np.float32((1, 4, 9)[i % 3])) for i, v in vectors(400, 64)]
    p, want = Params(tables=1, probes=1, small_band=8, bucket_rows=64), brute(rows)
    got = {}
    for r in nearest(frame(spark, rows), p=p).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want) and all(len(own) == 20 for own in got.values())
    exact = [q for q in want if [i for _, i, _ in sorted(got[q])] == [i for i, _ in want[q]]]
    assert len(exact) >= 0.8 * len(want)


def test_lengths_beyond_the_square_root_of_a_double(spark):
    rows = [(i, v.astype(float) * (1e-200 if i % 2 else 1.0)) for i, v in vectors(60, 8)]
    got = nearest(frame(spark, rows, "double"), k=59).collect()
    assert sorted((r.query_id, r.vec_id) for r in got) == [(q, i) for q in (0, 20, 40) for i in range(60) if i != q]


def test_rotations_keep_angles():
    x = np.array([v for _, v in vectors(20, 32)], dtype=float)
    for y in rotations(x, Params(tables=2)):
        assert np.allclose(y @ y.T, x @ x.T * np.linalg.norm(y[0]) ** 2)
    assert signed_axes(np.array([[0.1, -3.0, 2.0]]), 4).tolist() == [[3, 4, 0, 1]]
