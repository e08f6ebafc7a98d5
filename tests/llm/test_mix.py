"""Source mixing against its targets and the balance conditions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from inboxlens.llm import entropy_mix
from inboxlens.llm.common import WORD
from inboxlens.llm.entropy_mix import mix, mixed_documents, targets, word_count

from .helpers import DOCS, EDGES, TRICKY, corpus, docs_df


def water(sizes, weights=(1, 2, 3), cap=3.0):
    """Targets by resharing the excess until none is above its stop."""
    w = np.array([weights[i % len(weights)] for i in range(len(sizes))], dtype=float)
    s = np.array(sizes, dtype=float)
    full, t = np.zeros(len(s), bool), np.zeros(len(s))
    while True:
        t[~full] = (s.sum() - cap * s[full].sum()) * w[~full] / w[~full].sum() if (~full).any() else 0
        t[full] = cap * s[full]
        over = ~full & (t > cap * s)
        if not over.any():
            return t
        full |= over


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1000, 1, 2, 3], [5], [0, 10, 0, 7], [1, 1, 100, 1, 1, 1, 900]])
def test_targets(spark, sizes):
    rows = [(None if i == len(sizes) - 1 else f"s{i}", s) for i, s in enumerate(sizes)]
    got = targets(spark.createDataFrame(rows, "source string, source_size long"), (1, 2, 3), 3.0)
    assert [r.target for r in got.orderBy("sid").collect()] == pytest.approx(water(sizes).tolist())


def test_word_count(spark):
    texts = [*TRICKY, None, "  a  b ", "a\nb", "\x0ba\x1cb\x0c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = df.select(word_count(df).alias("n"),
                    F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))).alias("want"))
    assert all(r.n == r.want for r in got.collect())


def test_mix(spark):
    rows = [(i, t, f"s{i % 5}" if i % 11 else None) for i, t, _ in corpus(n=900)]
    rows += [(i, t, "s0") for i, t, _ in rows[:600]]
    rows = [(i, r[1], r[2]) for i, r in enumerate(rows)]
    docs = docs_df(spark, rows, extra=("size", "lam", "target", "copies"))
    got = mix(docs).toPandas()
    assert len(got) == len(rows) and (got["taken"] <= 3 * got["size"]).all()
    assert (got["taken"] == got["size"] * got["copies"]).all()
    source = {i: s for i, _, s in rows}
    got["source"] = [source[i] for i in got["doc_id"]]
    names = sorted({s for s in source.values() if s}) + [None]
    sizes = [int(got["size"][got["source"].isna() if n is None else got["source"] == n].sum()) for n in names]
    for n, size, target in zip(names, sizes, water(sizes), strict=True):
        own = got[got["source"].isna() if n is None else got["source"] == n]
        assert (own["source_size"] == size).all() and own["target"].to_numpy() == pytest.approx(target)
        assert abs(own["taken"].sum() - target) <= 0.02 * target
        assert (own["size"] * own["rate"]).sum() == pytest.approx(target, rel=1e-6)
        # the odds of the rate are an exponential of the size: one multiplier a source
        if target < 3 * size * (1 - 1e-9):
            tilt = [math.log(2 * r / (3 - r)) / s for r, s in zip(own["rate"], own["size"], strict=True) if s]
            assert max(tilt) - min(tilt) <= 1e-6 * max(1.0, abs(tilt[0]))
        assert ((own["copies"] - own["rate"]).abs() < 1).all()
    again = mix(docs.repartition(5, "n_chars")).toPandas().set_index("doc_id")["taken"].to_dict()
    assert again == got.set_index("doc_id")["taken"].to_dict()
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    times = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert times == {d: c for d, c in zip(got["doc_id"], got["copies"], strict=True) if c}


def test_edges(spark):
    got = mix(docs_df(spark, EDGES)).collect()
    assert len(got) == len(EDGES) and all(r.taken <= 3 * r.size for r in got)
    assert mix(spark.createDataFrame([], DOCS)).count() == 0
    assert mixed_documents(spark.createDataFrame([], DOCS)).count() == 0
    blank = mix(docs_df(spark, [(1, "", "a"), (2, None, "b")])).collect()
    assert all(r.size == r.taken == 0 for r in blank)


def by_hand(spark, out):
    """Taken words by (source, doc_id, size), rounded document by document."""
    ids = sorted({r.doc_id for r in out}, key=lambda d: (d is not None, d or 0))
    h = {r.doc_id: (r.h % 2 ** 64 >> 11) / 2 ** 53 for r in spark.createDataFrame(
        [(i,) for i in ids], "doc_id long").select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    taken = {}
    for source in {r.source for r in out}:
        rows = [r for r in out if r.source == source]
        whole = [min(math.floor(r.rate), 3) for r in rows]
        gap = rows[0].target - sum(w * r.size for w, r in zip(whole, rows, strict=True))
        order = sorted((h[r.doc_id] - (r.rate - w), i) for i, (r, w) in enumerate(zip(rows, whole, strict=True)) if w < 3)
        more = set()
        for _ in range(4):
            room = gap
            for _, i in order:
                if i in more or not 0 < rows[i].size <= gap:
                    continue
                if rows[i].size > room:
                    break
                room -= rows[i].size
                more.add(i)
            gap = room
        for i, (r, w) in enumerate(zip(rows, whole, strict=True)):
            k = (source, r.doc_id, r.size)
            taken[k] = taken.get(k, 0) + (w + (i in more)) * r.size
    return taken


@pytest.mark.parametrize("shape", ["null ids", "sizes", "repeats"])
def test_rounding_by_hand_with_ties(spark, shape):
    words = lambda n: " ".join(["w"] * n)
    ids = {"null ids": lambda i: None,
           "sizes": lambda i: None, "repeats": lambda i: i // 3}[shape]
    rows = [(ids(i), words(10 if shape != "sizes" else 1 + i * i % 37), "a") for i in range(500)]
    rows += [(10_000 + i, words(3 + i % 9), "b") for i in range(200)] + [(i % 5, words(400), "c") for i in range(30)]
    docs = docs_df(spark, rows)
    out = mix(docs).collect()
    got, most = {}, {}
    for r in out:
        k = (r.source, r.doc_id, r.size)
        got[k] = got.get(k, 0) + r.taken
        most[r.source] = max(most.get(r.source, 0), r.size)
    assert got == by_hand(spark, out)
    for source in most:
        assert abs(sum(v for k, v in got.items() if k[0] == source) - [r for r in out if r.source == source][0].target) <= most[source]
    again = {}
    for r in mix(docs.repartition(7)).collect():
        again[r.source, r.doc_id, r.size] = again.get((r.source, r.doc_id, r.size), 0) + r.taken
    assert again == got
    assert mixed_documents(docs).count() == sum(r.copies for r in out)


def test_ties_of_a_table(spark, scratch):
    docs_df(spark, [(None, "a b c d e", "s")] * 900 + [(i, "a b", "t") for i in range(300)]).repartition(4) \
        .write.parquet(f"{scratch}/docs")
    docs = spark.read.parquet(f"{scratch}/docs")
    out = mix(docs).collect()
    assert all(abs(sum(r.taken for r in out if r.source == s) - t) <= 5 for s, t in {(r.source, r.target) for r in out})
    assert mixed_documents(docs).count() == sum(r.copies for r in out)
    with_field = docs.withColumn("_metadata", F.lit(1)).withColumn("key", F.lit(2)).withColumn("at", F.lit(3))
    assert mixed_documents(with_field).columns == with_field.columns


def test_the_driver_lets_go_of_each_rounds_broadcasts(spark, monkeypatch):
    rows = [(i, "w " * (i % 9), f"s{i % 3}") for i in range(60)]
    calls = []
    monkeypatch.setattr(entropy_mix, "release", lambda spark: calls.append(1))
    assert entropy_mix.mixed_documents(docs_df(spark, rows)).count() > 0
    assert len(calls) >= 5  # before each of four rounds, and after the last
