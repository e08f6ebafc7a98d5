"""Held-out accuracy of the classifiers, and their defined results."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from inboxlens.llm import factorization, subword_quality
from inboxlens.llm.common import blocks
from inboxlens.llm.wordhash import subwords, word_hashes

from .helpers import DOCS, TRICKY, docs_df, text

LABELS = "doc_id long, quality int, toxic int"
SMALL = subword_quality.Params(sample=300, buckets_log2=14, epochs=6)


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def labelled():
    """Junk is shouted; toxic texts hold an insult together with a group."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(500):
        t, good, toxic = text(rng, rng.randint(2, 9)), int(i % 4 != 0), 0
        if not good:
            t = " ".join(w.upper() + "!!" for w in t.split())
        words = t.split()
        insult, group = i % 3 == 0, i % 5 < 2
        for on, w in ((insult, "clodpate"), (group, "villagers")):
            if on:
                words.insert(rng.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
        labels.append((i, good, int(insult and group)))
    return rows, labels


def outcome(got, labels, column):
    truth = {x[0]: x[column] for x in labels}
    out = [r for r in got if held(r.doc_id)]
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in got)
    return np.mean([r.predicted == truth[r.doc_id] for r in out])


def test_quality_of_held_out_documents(spark, labelled):
    rows, labels = labelled
    got = subword_quality.score_quality(docs_df(spark, rows), spark.createDataFrame(labels, LABELS), p=SMALL).collect()
    assert len(got) == len(rows) and outcome(got, labels, 1) >= 0.97
    again = subword_quality.score_quality(docs_df(spark, rows[::-1]), spark.createDataFrame(labels, LABELS), p=SMALL)
    assert {r.doc_id: r.score for r in again.collect()} == pytest.approx({r.doc_id: r.score for r in got})


def test_interactions_decide_toxicity(spark, labelled):
    """An insult alone and a group alone are harmless: no additive score separates them."""
    rows, labels = labelled
    p = factorization.Params(epochs=60, least_evidence=10.0)
    got = factorization.score_toxicity(docs_df(spark, rows), spark.createDataFrame(labels, LABELS), p=p).collect()
    assert outcome(got, labels, 2) >= 0.95


def test_accepted_rows_pass_as_they_are(spark, labelled):
    rows, labels = labelled
    docs = docs_df(spark, rows, extra=("score", "held_out"))
    got = subword_quality.accepted(docs, spark.createDataFrame(labels, LABELS), p=SMALL)
    assert got.columns == docs.columns
    good = {x[0] for x in labels if x[1]}
    kept = {r.doc_id for r in got.collect()}
    assert len(kept & good) >= 0.98 * len(good) and len(kept - good) <= 0.02 * len(rows)


@pytest.mark.parametrize("score", [subword_quality.score_quality, factorization.score_toxicity])
def test_edges(spark, labelled, score):
    rows, labels = labelled
    odd = [(None, "no number"), (9001, None), (9002, ""), (9003, "twice"), (9003, "twice")]
    odd += [(9100 + i, t) for i, t in enumerate(TRICKY)]
    docs = docs_df(spark, rows[:200] + odd, extra=("score", "label"))
    marks = spark.createDataFrame([*labels[:200], (None, 1, 1), (9003, None, None), (9002, 1, 0), (9002, 0, 0)], LABELS)
    got = score(docs, marks).collect()
    assert len(got) == 200 + len(odd)
    by = {}
    for r in got:
        assert 0 <= r.score <= 1
        by.setdefault(r.doc_id, []).append(r.score)
    assert by[9001] == by[9002] and len(set(by[9003])) == 1
    none = spark.createDataFrame([], LABELS)
    default = {r.score for r in score(docs, none).collect()}
    assert default == {0.5 if score is subword_quality.score_quality else 0.0}
    assert score(spark.createDataFrame([], DOCS), marks).count() == 0


def test_a_repeated_document_takes_one_place_of_the_sample(spark, labelled):
    rows, labels = labelled
    p, marks = subword_quality.Params(), spark.createDataFrame(labels, LABELS)

    def sample(own):
        got = subword_quality.sample_counts(docs_df(spark, own), marks, "quality", 5, 20,
                                            lambda t: subword_quality.counts_of(t, p), subword_quality.COUNTS)
        return [r["doc_id"] for r in got]

    once = sample(rows)
    first = spark.createDataFrame([(i,) for i in once], "i long").orderBy(F.xxhash64("i")).first().i
    assert len(once) == 20 and sample(rows + [rows[first]] * 60) == once


def test_word_table_averages_features():
    p = subword_quality.Params(buckets_log2=8, dim=4)
    weights = np.random.default_rng(1).normal(size=(256, 2))
    texts = [b"ab abc ab ab", b"", b"  x\ny ", b"z" * 500]
    got = subword_quality.WordTable(weights, p, most_words=2).averages(texts)
    for t, g in zip(texts, got, strict=True):
        bucket, n = subword_quality.counts_of(t, p)
        want = (weights[bucket] * n[:, None]).sum(axis=0) / max(1, n.sum())
        assert g == pytest.approx(want)


def test_machine_logit_equals_all_pairs():
    rng = np.random.default_rng(3)
    m = factorization.Machine(np.arange(6), rng.normal(size=6), rng.normal(size=(6, 3)), 0.3, 0.25)
    ids = np.array([0, 2, 5])
    x = 3 ** -0.25
    want = 0.3 + x * m.linear[ids].sum() + x * x * sum(
        m.vectors[i] @ m.vectors[j] for a, i in enumerate(ids) for j in ids[a + 1:])
    got = m.logits(ids, (np.array([3]), np.array([0]), np.array([1])), 2)
    assert got == pytest.approx([0.3, want])


def test_hashes_of_words_and_ngrams():
    words = [b"a", b"abcd", "é".encode(), b"abcd" * 50]
    own = word_hashes(words)
    assert [int(word_hashes([w])[0]) for w in words] == own.tolist()
    hashes, owner = subwords(words, 3, 4)
    for i, w in enumerate(words):
        alone, _ = subwords([w], 3, 4)
        assert sorted(alone.tolist()) == sorted(hashes[owner == i].tolist())
        assert len(alone) == 1 + max(0, len(w) + 2 - 2) + max(0, len(w) + 2 - 3)


def test_blocks_cover_every_text():
    texts = ["a" * n for n in (5, 50, 0, 3, 200, 1)]
    got = list(blocks(texts, 52))
    assert [i for a, b in got for i in range(a, b)] == list(range(6))
    assert all(b - a == 1 or sum(map(len, texts[a:b])) <= 52 for a, b in got)


def test_the_driver_keeps_no_sample_after_training(spark, labelled, monkeypatch):
    rows, labels = labelled
    calls = []
    monkeypatch.setattr(subword_quality, "give_back", lambda: calls.append("memory"))
    monkeypatch.setattr(subword_quality, "release", lambda spark: calls.append("spark"), raising=False)
    subword_quality.accepted(docs_df(spark, rows), spark.createDataFrame(labels, LABELS), p=SMALL)
    assert calls == ["memory", "spark"]
