"""I-Match fingerprints against a plain reading of their rules."""

import hashlib
import re

import pytest
import xxhash

from inboxlens.llm.imatch import DEALS, SPLIT, fingerprints, lexicon, neighbours

from .helpers import DOCS, EDGES, corpus, docs_df
from .test_line_dedup import signed, spark_hash

LOW, HIGH = 0.05, 0.4


def terms(text):
    return {spark_hash(w) for w in re.split(SPLIT, text.lower()) if w}


def chain(values):
    h = 42
    for v in values:
        h = spark_hash(v, h)
    return h


def int_hash(value, seed):
    return signed(xxhash.xxh64_intdigest(value.to_bytes(4, "little", signed=True), seed % 2 ** 64))


def parts(found, words):
    out = []
    for into, used in DEALS:
        own = [[] for _ in range(used)]
        for m in found & words:
            n = int_hash(into, spark_hash(m)) % into
            if n < used:
                own[n].append((n << 48) | ((m % 2 ** 64) >> 16))
        out += [chain(sorted(x)) if x else None for x in own]
    return out


def show(p, found):
    if all(x is None for x in p):
        return "x" + f"{chain(sorted(found)) % 2 ** 64:016x}"
    return "".join("........" if x is None else f"{x % 2 ** 32:08x}" for x in p)


def like(a, b, fa, fb):
    if fa == fb:
        return 1.0
    some = [(x, y) for x, y in zip(a, b, strict=True) if x is not None or y is not None]
    return sum(x == y for x, y in some) / len(some) if some else 0.0


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    texts = [r[1] or "" for r in order]
    every = [terms(t) for t in texts]
    df = {}
    for found in every:
        for m in found:
            df[m] = df.get(m, 0) + 1
    n = len(rows)
    words = {m for m, c in df.items() if max(2, LOW * n) <= c <= max(2, HIGH * n)}
    out = []
    for i, (r, t) in enumerate(zip(order, texts, strict=True)):
        j = (i + 1) % n
        edited = t[:len(t) - len(t) // 2] + texts[j][:len(t) // 2]
        new = terms(edited)
        a, b, c = (parts(x, words) for x in (every[i], new, every[j]))
        fa, fb, fc = show(a, every[i]), show(b, new), show(c, every[j])
        out.append((r[0], len(t), hashlib.sha256(edited.encode()).hexdigest(), fa, fb,
                    round(like(a, b, fa, fb), 9), round(like(a, c, fa, fc), 9)))
    return sorted(out, key=repr)


def test_equals_the_rules(spark):
    rows = corpus(n=70) + [(1000 + i if r[0] is not None else None, *r[1:]) for i, r in enumerate(EDGES)]
    got = fingerprints(docs_df(spark, rows, extra=("h", "rid", "own")), LOW, HIGH)
    assert sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in got.collect()), key=repr) == brute(rows)


def test_beyond_the_broadcast_bound_the_result_is_the_same(spark):
    docs = docs_df(spark, corpus(n=30))
    a, b = (sorted(fingerprints(docs, LOW, HIGH, most_terms=m).collect()) for m in (10 ** 6, 1))
    assert a == b


@pytest.mark.parametrize("n", [1, 2, 7])
def test_neighbours_go_round(spark, n, monkeypatch):
    from inboxlens.llm import imatch

    monkeypatch.setattr(imatch, "_BUCKET", 2)
    rows = [(3 * i - 4, f"text {i}") for i in range(n)]
    got = {r.doc_id: r.next_text for r in neighbours(docs_df(spark, rows)).collect()}
    assert got == {rows[i][0]: rows[(i + 1) % n][1] for i in range(n)}


def test_no_documents(spark):
    empty = spark.createDataFrame([], DOCS)
    assert fingerprints(empty).count() == 0
    assert lexicon(empty, LOW, HIGH).count() == 1  # the mark that stands for the text itself
