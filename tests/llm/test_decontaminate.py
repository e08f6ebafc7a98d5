"""Benchmark passages against a plain search of every window."""

import random
import re

import pytest

from inboxlens.llm.decontaminate import contamination
from tests.llm.helpers import TRICKY, docs_df

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLS = ("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated")


def split(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return WORD.findall(low)


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        ws, hit, names = split(text), set(), set()
        for item, other in items:
            of = split(other)
            n = min(window, len(of))
            for at in range(len(of) - n + 1 if of else 0):
                for p in range(len(ws) - n + 1):
                    if ws[p:p + n] == of[at:at + n]:
                        hit |= set(range(p, p + n))
                        names.add("" if item is None else str(item))
        out.append((doc_id, len(ws), len(hit), len(names), sorted(names, key=str.encode), bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items, **more):
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = contamination(docs_df(spark, docs, extra=("p", "h", "ws", "sid")), bench, **more)
    return sorted((tuple(r[c] for c in COLS) for r in out.collect()), key=repr)


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "naïve", "x1", "Éa", "über", "a", "rare", "word", "9", "no", "so"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", ".\n", "  ", "-"]) for _ in range(n))

    items = [(i, text(rng.choice([1, 2, 4, 5, 7, 9, 10, 11, 25, 40]) if i else 30)) for i in range(12)]
    docs = []
    for i in range(40):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            item = split(items[rng.randrange(12)][1])
            a = rng.randrange(len(item))
            parts += [" ".join(item[a:a + rng.randint(1, 20)]).upper(), text(rng.randint(0, 12))]
        docs.append((i, " ".join(parts)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_every_window_is_found(spark, seed):
    docs, items = made(seed)
    expected = brute(docs, items)
    assert any(r[2] for r in expected)
    assert run(spark, docs, items) == expected


def test_slices_of_the_benchmark_give_the_same(spark):
    docs, items = made(3)
    assert run(spark, docs, items, slice_bytes=2000) == brute(docs, items)


def test_long_texts_and_rows_that_repeat(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = [(7, passage + " end"), (7, passage + " end"), (7, "other " + passage), (None, passage), (None, None),
            (8, None), (9, ""), (10, "w0 " * 20000 + passage), (11, " ".join(f"w{i}" for i in range(9))),
            *((100 + i, t) for i, t in enumerate(TRICKY))]
    items = [(1, passage), (2, passage), (2, "w3 w4"), (None, "of"), (3, None), (4, ""), (5, " .,! "), (6, "a A"),
             (10, "w0 w0 w0 w0 w0 w0 w0 w0 w0 w0 w0 w0")]
    assert run(spark, docs, items) == brute(docs, items)


def test_copies_of_one_document(spark):
    passage = " ".join(f"v{i}" for i in range(25))
    docs = [(i % 3, f"begin {passage} end") for i in range(600)] + [(i, "clean words only here") for i in range(600, 700)]
    out = run(spark, docs, [(1, passage), (2, "nothing of it is there at all in any of the documents")])
    assert out == brute(docs[:3], [(1, passage)])[:1] * 200 + brute(docs[1:2], [(1, passage)]) * 200 \
        + brute(docs[2:3], [(1, passage)]) * 200 + brute(docs[600:], [(1, passage)])


def test_empty_tables(spark):
    assert run(spark, [(1, "some words")], []) == [(1, 2, 0, 0, [], False)]
    assert run(spark, [], [(1, "some words")]) == []
