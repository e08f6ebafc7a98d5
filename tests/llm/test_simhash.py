"""SimHash groups against all pairs."""

import numpy as np
from xxhash import xxh64_intdigest

from inboxlens.llm.components import components
from inboxlens.llm.simhash_trie import first_of_groups, forest, simhash_groups, walk

from .helpers import DOCS, EDGES, corpus, docs_df


def fingerprint(text, shingle=3):
    w = (text or "").encode().lower().split()
    runs = [b" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    h = [xxh64_intdigest(x, 42) for x in runs]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def roots(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute(rows, bits):
    fps = [fingerprint(r[1]) for r in rows]
    near = [(i, j) for i in range(len(rows)) for j in range(i) if bin(fps[i] ^ fps[j]).count("1") <= bits]
    root = roots(len(rows), near)
    least = {}
    for r, at in zip(rows, root, strict=True):
        if r[0] is not None:
            least[at] = min(least.get(at, r[0]), r[0])
    return sorted(((r[0], f"{f:016x}", least.get(at)) for r, f, at in zip(rows, fps, root, strict=True)), key=repr)


def test_groups_equal_all_pairs(spark):
    rows = corpus(n=90) + [(1000 + i, *r[1:]) if r[0] is not None else r for i, r in enumerate(EDGES)]
    for bits in (0, 2, 5):
        got = simhash_groups(docs_df(spark, rows, extra=("fp", "component_id")), 3, bits, node_limit=8)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, bits)


def test_no_documents(spark):
    assert simhash_groups(spark.createDataFrame([], DOCS)).count() == 0


def test_walk_finds_each_pair_of_its_half():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2 ** 63, 150, dtype=np.uint64) * np.uint64(2)
    near = [base ^ (np.uint64(1) << rng.integers(0, 64, 150, dtype=np.uint64)) for _ in range(3)]
    near.append(near[0] ^ (np.uint64(1) << rng.integers(0, 64, 150, dtype=np.uint64)))
    v = np.unique(np.concatenate([base, *near]))
    diff = v[:, None] ^ v[None, :]
    ok = (np.bitwise_count(diff) <= 2) & (np.bitwise_count(diff >> np.uint64(32)) <= 1)
    want = {(i, j) for i, j in np.argwhere(ok).tolist() if i < j}
    for depth in (0, 3, 9):
        got = set()
        prefix = v >> np.uint64(64 - depth) if depth else np.zeros(len(v), dtype=np.uint64)
        for node in np.unique(prefix):
            at = np.flatnonzero((np.bitwise_count(prefix ^ node) <= 1) & (prefix <= node))
            for i, j in walk(v[at], prefix[at] != node, 32, 1, 2, depth, slice_size=50):
                got |= {(min(a, b), max(a, b)) for a, b in zip(at[i].tolist(), at[j].tolist(), strict=True)}
        assert got == want


def test_forest_joins_pairs():
    pairs = [(np.array([5, 1]), np.array([6, 2])), (np.array([2]), np.array([5]))]
    assert forest(8, iter(pairs)).tolist() == [0, 1, 1, 3, 4, 1, 1, 7]


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(300 - i, 299 - i) for i in range(20)] + [(7, 7), (0, 1)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, **{i: 200 for i in (200, 201, 202)},
            **{i: 280 for i in range(280, 301)}}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_extra_columns_keep_their_names(spark):
    docs = spark.createDataFrame([(1, "a b c d", 7, 8, 9), (1, "a b c d", 7, 8, 9), (2, "x y z w", 5, 5, 5)],
                                 "doc_id long, text string, __id long, __uid long, __N long")
    got = first_of_groups(docs)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a b c d", 7, 8, 9), (2, "x y z w", 5, 5, 5)]
