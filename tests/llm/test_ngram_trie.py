"""Language-model scores against counting in a dictionary."""

import collections
import math
import zlib

import numpy as np
import pytest

from inboxlens.llm.elias_fano import EliasFano, encode
from inboxlens.llm.ngram_trie import (END, Counter, Reader, TripleCounter, _packed, _unpacked, chained, count_words,
                                     hash_words, merged, parts, ranked, score, score_documents, score_tokens,
                                     token_blocks, train, unpacked, unpacked_triples)
from inboxlens.llm.wordhash import TokenHashes

from .helpers import DOCS, EDGES, corpus, docs_df


def words_of(text):
    return (text or "").encode().lower().split()


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


class Model:
    def __init__(self, texts):
        self.c, self.pairs, self.after = collections.Counter(), collections.Counter(), collections.defaultdict(list)
        for t in texts:
            w = [*words_of(t), END]
            self.c.update(w)
            self.pairs.update(zip([END, *w], w, strict=False))
        self.n, self.v = sum(self.c.values()), len(self.c)
        for (a, _), c in self.pairs.items():
            self.after[a].append(c)
        ones, twos = collections.Counter(), collections.Counter()
        for own in self.after.values():
            k = min(23, int(math.log2(sum(own))))
            ones[k] += own.count(1)
            twos[k] += own.count(2)
        self.d = {k: min(0.95, max(0.1, ones[k] / (ones[k] + 2 * twos[k]))) if ones[k] else 0.5 for k in range(24)}

    def base(self, w):
        return (self.c[w] + 0.1) / (self.n + 0.1 * (self.v + 1))

    def prob(self, a, w):
        if a not in self.after:
            return self.base(w)
        own = self.after[a]
        total = sum(own)
        d = self.d[min(23, int(math.log2(total)))]
        c = self.pairs[a, w]
        return (c - d if c else 0) / total + d * len(own) / total * self.base(w)

    def score(self, text):
        w = [*words_of(text), END]
        return (len(w), sum(x in self.c for x in w), sum(math.log10(self.base(x)) for x in w),
                sum(math.log10(self.prob(a, x)) for a, x in zip([END, *w], w, strict=False)))


def test_scores_equal_a_dictionary_model(spark):
    rows = corpus(n=80) + [(1000 + i if r[0] is not None else None, *r[1:]) for i, r in enumerate(EDGES)]
    model = Model([r[1] for r in rows if not is_held_out(r[0])])
    got = score_documents(docs_df(spark, rows, extra=("score", "shard")), 10).collect()
    want = sorted(((r[0], *model.score(r[1])) for r in rows), key=lambda x: (x[0] is None, x))
    got = sorted(got, key=lambda r: (r.doc_id is None, r.doc_id, r.n_tokens, r.n_known, r.base_score))
    assert len(got) == len(want)
    for g, (d, n, known, base, score) in zip(got, want, strict=True):
        assert (g.doc_id, g.n_tokens, g.n_known, g.train_tokens) == (d, n, known, model.n)
        assert g.held_out == is_held_out(d)
        assert g.base_score == pytest.approx(base, rel=1e-9)
        # each probability is quantised downwards by less than a step
        assert score - n * 3e-4 <= g.score <= score + 1e-9 * abs(score) + 1e-9


def test_probabilities_of_a_context_add_up_to_at_most_one(spark):
    rows = corpus(n=40)
    words, pairs = train(docs_df(spark, rows), shards=5)
    reader, model = Reader(words), Model([r[1] for r in rows])
    every = list(model.c)
    ids, counts = words.lookup(hash_words(every), reader.opened)
    assert sorted(ids.tolist()) == list(range(model.v)) and counts.tolist() == [model.c[w] for w in every]
    base = 10 ** words.log10(counts)
    for a in [END, *every[:20]]:
        i = every.index(a)
        prob, weight = pairs.lookup(np.full(len(ids), ids[i]), ids, reader.opened)
        total = np.where(np.isnan(prob), 10 ** weight * base, 10 ** prob).sum() + 10 ** weight[0] * 10 ** float(words.log10(0))
        assert 0.98 < total <= 1 + 1e-9
        own, probs = pairs.successors(int(ids[i]), reader.opened)
        seen = {every[j] for j in np.flatnonzero(np.isin(ids, own))}
        assert seen == {w for x, w in model.pairs if x == a} and len(own) == len(probs)


def test_parts_and_merge_round_trip():
    rng = np.random.default_rng(4)
    keys, counts = merged(rng.integers(0, 1000, 500), np.ones(500, dtype=np.int64))
    assert counts.sum() == 500 and (np.diff(keys) > 0).all()
    back = [(k + s * 128, c) for s, *raw in parts(keys, counts, 128) for k, c in [unpacked(*raw)]]
    assert np.concatenate([k for k, _ in back]).tolist() == keys.tolist()
    assert np.concatenate([c for _, c in back]).tolist() == counts.tolist()


def test_nothing_to_learn_from(spark):
    assert score_documents(spark.createDataFrame([], DOCS)).count() == 0
    held = next(i for i in range(100) if is_held_out(i))
    (row,) = score_documents(docs_df(spark, [(held, "two words")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert row.score == row.base_score == pytest.approx(0.0)


def test_three_levels_equal_a_dictionary_model(spark):
    rows = corpus(n=80) + [(1000 + i if r[0] is not None else None, *r[1:]) for i, r in enumerate(EDGES)]
    texts = [r[1] for r in rows if not is_held_out(r[0])]
    model, triples, after = Model(texts), collections.Counter(), collections.defaultdict(list)
    for t in texts:
        w = [END, *words_of(t), END]
        triples.update(zip(w, w[1:], w[2:], strict=False))
    for (a, b, _), c in triples.items():
        after[a, b].append(c)
    ones, twos = collections.Counter(), collections.Counter()
    for own in after.values():
        k = int(math.log2(sum(own)))
        ones[k] += own.count(1)
        twos[k] += own.count(2)

    def prob(a, b, w):
        if (a, b) not in after:
            return model.prob(b, w)
        own, k = after[a, b], int(math.log2(sum(after[a, b])))
        d = min(0.95, max(0.1, ones[k] / (ones[k] + 2 * twos[k]))) if ones[k] else 0.5
        c = triples[a, b, w]
        return (c - d if c else 0) / sum(own) + d * len(own) / sum(own) * model.prob(b, w)

    def score(text):
        w = [END, *words_of(text), END]
        return math.log10(model.prob(END, w[1])) + sum(math.log10(prob(*x)) for x in zip(w, w[1:], w[2:], strict=False))

    got = score_documents(docs_df(spark, rows), 10, order=3).collect()
    want = {}
    for r in rows:
        want.setdefault(r[0], []).append((len(words_of(r[1])) + 1, score(r[1])))
    assert len(got) == len(rows)
    for r in got:
        # each probability is quantised downwards, a triple's over a pair's that was
        assert any(n == r.n_tokens and x - n * 8e-4 <= r.score <= x + 1e-9 * abs(x) + 1e-9 for n, x in want[r.doc_id])
    assert score_documents(spark.createDataFrame([], DOCS), order=3).count() == 0


def test_a_triple_is_found_with_one_select(spark, monkeypatch):
    rows = corpus(n=40)
    words, pairs, triples = train(docs_df(spark, rows), shards=3, order=3)
    reader, seen = Reader(words), []
    ids, _, before, lengths = reader.tokens([(r[1] or "").encode() for r in rows])
    place = pairs.search(before, ids, reader.opened)[2]
    context = np.append(-1, place[:-1])
    context[np.cumsum(lengths) - lengths] = -1
    on = np.flatnonzero(context >= 0)
    select = EliasFano._select
    monkeypatch.setattr(EliasFano, "_select", lambda e, i, zeros: (seen.append(len(i)), select(e, i, zeros))[1])
    assert (triples.search(context[on], ids[on], reader.opened)[2] >= 0).all()
    distinct = len(np.unique(context[on] * words.distinct + ids[on]))
    assert 0 < sum(seen) <= 1.2 * distinct


def test_a_counter_sends_every_key_once_merged():
    rng = np.random.default_rng(5)
    for lists in (1, 4):
        counter, want, got = Counter(64, most=200), collections.Counter(), collections.Counter()
        batches = []
        for _ in range(lists):
            keys = rng.integers(0, 500, 120)
            want.update(keys.tolist())
            batches += counter.add(*np.unique(keys, return_counts=True))
        batches += counter.rows()
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = unpacked(row["n"], row["keys"], row["counts"])
                for k, c in zip((keys + row["shard"] * 64).tolist(), counts.tolist(), strict=True):
                    got[k] += c
        assert got == want


@pytest.mark.parametrize("share", [0.0005, 0.02, 0.5, 0.98, 3.0])
def test_elias_fano_of_dense_and_sparse_stretches(share):
    rng = np.random.default_rng(7)
    n = 20_000
    some = rng.integers(0, int(n / share), n)
    run = np.arange(3000) + int(n / share) // 2  # a full stretch among the others
    values = np.sort(np.concatenate([some, run, np.repeat(run[:5], 400)]))
    universe = int(values[-1]) + 1000
    e = EliasFano(encode(values, universe))
    assert (e.get(np.arange(len(values))) == values).all()
    probes = np.unique(np.concatenate([values, values + 1, rng.integers(0, universe, 5000)]))
    want = np.searchsorted(values, probes)
    assert (e.successor(probes) == want).all()
    hit = values[np.minimum(want, len(values) - 1)] == probes
    assert (e.find(probes) == np.where(hit, want, -1)).all()


@pytest.mark.parametrize("high", [1, 3, 1 << 20, 1 << 44, 1 << 62])
def test_ranked_equals_unique(high):
    rng = np.random.default_rng(high % 97)
    few = rng.integers(0, high, 200)
    for x in (few, rng.choice(few, 5000), np.sort(rng.integers(0, high, 3000)),
              high - 1 - rng.integers(0, min(high, 64), 4000),  # equal but for their last bits
              np.zeros(0, dtype=np.int64)):
        got, back = ranked(x)
        want, place = np.unique(x, return_inverse=True)
        assert got.tolist() == want.tolist() and back.tolist() == place.tolist()


def test_a_value_alone_in_its_run_is_compared_once(monkeypatch):
    values = np.arange(1, 2001, dtype=np.int64) * 64 + 5
    level, read = EliasFano(encode(values)), []
    low = EliasFano._low
    monkeypatch.setattr(EliasFano, "_low", lambda self, i: read.append(len(i)) or low(self, i))
    x = np.arange(int(values[-1]) + 100)
    want = np.where(np.isin(x, values), (x - 5) // 64 - 1, -1)
    assert level.find(x).tolist() == want.tolist()
    assert sum(read) <= len(x)


@pytest.mark.parametrize("width", [1, 56, 57, 58, 61])
def test_low_bits_of_every_width(width):
    rng, n = np.random.default_rng(width), 40 if width < 58 else 3
    values = np.sort(rng.integers(0, 1 << 62, n)) >> (61 - width)
    level = EliasFano(encode(values, n << width))
    assert level.low_bits == width
    assert level.get(np.arange(n)).tolist() == values.tolist()
    assert level.find(values).tolist() == np.searchsorted(values, values).tolist()
    assert level.successor(values + 1).tolist() == np.searchsorted(values, values + 1).tolist()


def test_backoff_is_the_weight_that_a_lookup_gives(spark):
    words, pairs, triples = train(docs_df(spark, corpus(n=30)), shards=3, order=3)
    for level, contexts in ((pairs, words.distinct), (triples, pairs.total)):
        some = np.random.default_rng(3).integers(0, contexts, 500)
        want = level.lookup(some, np.zeros(500, dtype=np.int64), {})[1]
        assert level.backoff(some, {}).tolist() == want.tolist()


def test_triples_are_counted_without_a_search_of_the_pairs(spark, monkeypatch):
    rows = corpus(n=60)
    words, pairs, triples = train(docs_df(spark, rows), shards=4, order=3)
    reader = Reader(words)
    ids, _, before, lengths = reader.tokens([(r[1] or "").encode() for r in rows])
    pair = chained(before * words.distinct + ids, lengths)
    word = ids[pair >= 0]
    place = chained(pairs.search(before, ids, reader.opened)[2], lengths)
    want = collections.Counter((place[place >= 0] * words.distinct + word).tolist())
    pair = pair[pair >= 0]
    width = triples.step // words.distinct
    own = pairs.between(0, pairs.total, reader.opened)
    assert (np.diff(own) > 0).all() and len(own) == pairs.total
    monkeypatch.setattr(EliasFano, "find", None)  # no lookup from here on
    bounds = pairs.keys_at(np.arange(width, pairs.total, width), reader.opened)
    assert bounds.tolist() == own[width::width].tolist()
    counter, batches = TripleCounter(words.distinct, bounds, most=700), []
    for a in range(0, len(pair), 500):
        batches += counter.add(pair[a:a + 500], word[a:a + 500])
    batches += counter.rows()
    assert len(batches) > 2
    got, raw = collections.Counter(), [r for b in batches for r in b.to_pylist()]
    for r in raw:
        some = pairs.between(r["shard"] * width, (r["shard"] + 1) * width, reader.opened)
        keys, counts = unpacked_triples(r["n"], r["keys"], r["counts"], words.distinct, some)
        assert len(keys) == r["n"] and (np.diff(keys) > 0).all() and keys[-1] < triples.step
        for k, c in zip((keys + r["shard"] * triples.step).tolist(), counts.tolist(), strict=True):
            got[k] += c
    assert got == want and {r["shard"] for r in raw} == set(triples.files)


@pytest.mark.parametrize("share", [0.0005, 0.5, 3.0])
def test_a_stretch_of_elias_fano(share):
    rng = np.random.default_rng(11)
    values = np.sort(rng.integers(0, int(5000 / share), 5000))
    level = EliasFano(encode(values))
    for a, b in ((0, 5000), (0, 1), (4999, 5000), (17, 17), (63, 64), (100, 4000), *rng.integers(0, 5000, (40, 2)).tolist()):
        assert level.between(a, b).tolist() == values[a:b].tolist()


def test_hashes_do_not_depend_on_slices(monkeypatch):
    rng = np.random.default_rng(13)
    letters = np.frombuffer(bytes(range(256)) + b" \t\n\v\f\r" * 12, dtype=np.uint8)
    texts = [rng.choice(letters, n).tobytes() for n in (0, 1, 3000, 200_000)] + [b"x" * 90_000, b"  A x" * 30_000, b""]
    hashes, lengths = TokenHashes()(texts)
    assert lengths.tolist() == [len(t.split()) for t in texts]
    number = {}
    for w, h in zip([w.lower() for t in texts for w in t.split()], hashes.tolist(), strict=True):
        assert number.setdefault(w, h) == h
    assert len(set(number.values())) == len(number)
    monkeypatch.setattr("inboxlens.llm.wordhash._SLICE", 1 << 9)
    again = TokenHashes()(texts)
    assert again[0].tolist() == hashes.tolist() and again[1].tolist() == lengths.tolist()


def test_word_ids_are_written_once_and_scored(spark):
    rows = [(None if i == 3 else i, t, i % 3 == 0) for i, (_, t, *_) in enumerate(corpus(n=60) + EDGES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(2)
    learnt = docs.where("not held_out")
    words = count_words(learnt.selectExpr("cast(coalesce(text, '') as binary) text"), 4)
    tokens, reader, got = token_blocks(docs, words).cache(), Reader(words), []
    for r in tokens.collect():
        ids, at = _unpacked(bytes(r.ids), sum(r.n_tokens)) - 1, 0
        for doc, n, known, base in zip(r.doc_id, r.n_tokens, r.n_known, r.base_score, strict=True):
            got.append((doc, r.held_out, n, known, round(base, 6), ids[at:at + n].tolist()))
            at += n
        assert at == len(ids)
    want = []
    for doc, text, held in rows:
        ids, counts, _, (n,) = reader.tokens([(text or "").encode()])
        assert (words.counts_at(ids[ids >= 0], {}) == counts[ids >= 0]).all()
        want.append((doc, held, n, int((counts > 0).sum()), round(float(words.log10(counts).sum()), 6), ids.tolist()))
    assert sorted(got, key=str) == sorted(want, key=str)
    _, *levels = train(learnt, shards=4, order=3)
    both = [sorted(map(str, f.collect())) for f in (score(docs, words, *levels), score_tokens(tokens, words, *levels))]
    assert both[0] == both[1] and len(both[0]) == len(rows)


@pytest.mark.parametrize("most", [0, 1, 255, 256, 1 << 23, 1 << 40, (1 << 63) - 1])
def test_packed_numbers_take_the_planes_they_need(most):
    x = np.random.default_rng(3).integers(0, most, 1000, endpoint=True)
    x[0] = most
    raw = _packed(x)
    assert raw[0] == max(1, -(-most.bit_length() // 8)) and _unpacked(raw, len(x)).tolist() == x.tolist()
    assert _unpacked(_packed(-x), len(x)).tolist() == (-x).tolist()
