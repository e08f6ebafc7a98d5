"""Small fixtures of the corpus operators' tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TRICKY = ["", " ", "\n", " \t ", "a", "A a A", "é Ünï  çode ß", "x\x01y. z", "of of of of", "\x1c\x85  nb",
          "don't it's 12 345!!", "ﬁn ´ é", "Σς İ", "<|endoftext|> end", "a" * 3000, "word " * 4000]


def docs_df(spark, rows, extra=()):
    """``rows``: (doc_id, text[, source]); ``extra``: names of further string columns."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]),
             *["kept"] * len(extra)) for r in rows]
    return spark.createDataFrame(full, DOCS + "".join(f", `{c}` string" for c in extra))


def sentences(rng: random.Random, n: int, words: int = 9) -> list[str]:
    def word():
        return "".join(rng.choice(["an", "th", "er", "on", "re", "st", "la", "en", "ou", "é"]) for _ in range(rng.randint(1, 4)))

    return [" ".join(word() for _ in range(rng.randint(3, 2 * words))).capitalize() + "." for _ in range(n)]


def text(rng: random.Random, n: int) -> str:
    return "".join(s + rng.choice([" ", " ", " ", "\n"]) for s in sentences(rng, n)).strip()


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Texts with exact copies, near copies, shared passages and the tricky ones."""
    rng = random.Random(seed)
    rows = [(i, text(rng, rng.randint(1, 25)), f"s{i % 3}") for i in range(n)]
    passage = " ".join(sentences(rng, 8))
    for i in range(0, n, 7):
        rows[i] = (i, rows[i][1] + " " + passage + " " + text(rng, 3), "s0")
    for i in range(3, n, 11):
        rows[i] = (i, rows[i - 2][1], "s1")
    for i in range(5, n, 13):
        near = rows[i - 1][1].split(" ")
        near[len(near) // 2] = "changed"
        rows[i] = (i, " ".join(near), "s2")
    return rows + [(n + i, t, "s0") for i, t in enumerate(TRICKY)]


#: Null ids and texts, repeated rows, ids that share texts and the other way round.
EDGES = [(None, "A text without number. It is long enough to be more than nothing at all, or so one hopes.", None),
         (1, None, "a"), (2, "", "a"), (3, "one two three", None), (3, "one two three", None), (4, "one two three", "b"),
         (4, "another text under one number", "b"), (None, None, None)]
