"""Toxicity: a factorization machine over hashed terms.

A document is the set of its distinct terms, each hashed to 64 bits: its lower-cased words
(punctuation at a word's ends dropped) and the words' first four and five bytes, which
inflected and compound forms of a stem share.  The logit is

    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

where ``x_i`` is the number of the document's known terms to the power of ``-damping``, so
the learned vectors of a pair of terms, such as an insult and the mention of a group,
weigh beyond what each adds alone.  The pairwise sum is taken in linear time from the sums of
vectors.  The machine is trained with AdaGrad in numpy on a bounded sample of labelled
rows (``sample`` documents, those with the least hash of their doc_id).  Of their terms it
keeps those that at least ``least_documents`` hold and whose share among toxic documents
differs beyond chance (a likelihood ratio of ``least_evidence``): the many terms that say
nothing would drown a few telling ones in a long text.  The sample bounds the model that
Spark broadcasts.

Rows: a null text is an empty one and gets the score of the bias; rows without label or
with a null label teach nothing; without two classes to learn from every score is the
mean label (0 without labels); repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, held_out, text_of
from .subword_quality import COUNTS, sample_counts
from .wordhash import word_hashes

_MARKS = b".,;:!?\"'()[]{}<>*#$%&@-_/\\|~^+=`"


@dataclass(frozen=True)
class Params:
    factors: int = 8
    epochs: int = 12
    rate: float = 0.05
    decay: float = 1e-4
    least_documents: int = 8
    sample: int = 6000
    damping: float = 0.0
    least_evidence: float = 25.0
    seed: int = 1


def forms(words: list[bytes]):
    """Hashes of each word's three terms (words x 3): itself without the marks at its
    ends, and its first four and five bytes; a word of marks only gives zeros."""
    import numpy as np

    bare = [w.strip(_MARKS) for w in words]
    out = np.empty((len(words), 3), dtype=np.int64)
    out[:, 0] = word_hashes(bare).view(np.int64)
    for k, n in ((1, 4), (2, 5)):
        # a newline sets a prefix apart from a word: no word holds one
        out[:, k] = word_hashes([w[:n] + b"\n" if len(w) > n else w for w in bare]).view(np.int64)
    out[[not b for b in bare]] = 0
    return out


def term_set(text: bytes):
    """Distinct hashed terms, ascending, as signed integers (and no counts)."""
    import numpy as np

    found = list(set(text.lower().split()))
    hashes = np.unique(forms(found)) if found else np.zeros(0, dtype=np.int64)
    return hashes[hashes != 0], np.zeros(0, dtype=np.int32)


@dataclass
class Machine:
    known: object    # hashes of the terms, ascending
    linear: object   # weight of each
    vectors: object  # terms x factors
    bias: float
    damping: float

    def logits(self, ids, starts, n):
        """``ids``: known-term numbers of ``n`` documents one after the other;
        ``starts``: the first place of each document that has any (others: bias)."""
        import numpy as np

        sizes, owner, some = starts
        out = np.full(n, self.bias)
        if len(ids):
            x = np.asarray(sizes, dtype=np.float64) ** -self.damping
            v = self.vectors[ids]
            total = np.add.reduceat(v, owner, axis=0)
            squares = np.add.reduceat(v * v, owner, axis=0)
            lin = np.add.reduceat(self.linear[ids], owner)
            pair = 0.5 * (total ** 2 - squares).sum(axis=1)
            out[some] += lin * x + pair * x * x
        return out


def evident(docs: list[tuple], y, p: Params):
    """The terms whose share among positive documents differs from that among the others
    beyond chance: a likelihood-ratio statistic of at least ``least_evidence``."""
    import numpy as np

    known, df = np.unique(np.concatenate([d[0] for d in docs]), return_counts=True)
    toxic, hits = np.unique(np.concatenate([d[0] for d in docs if d[1]]), return_counts=True)
    a = np.zeros(len(known))  # positive documents with the term
    a[np.searchsorted(known, toxic)] = hits
    n, t = float(len(y)), float(y.sum())

    def part(o, e):
        return np.where(o > 0, o * np.log(np.maximum(o, 1e-300) / np.maximum(e, 1e-300)), 0.0)

    g = 2 * (part(a, df * t / n) + part(df - a, df * (n - t) / n)
             + part(t - a, (n - df) * t / n) + part(n - t - df + a, (n - df) * (n - t) / n))
    return known[(df >= p.least_documents) & (g >= p.least_evidence)]


def train(docs: list[tuple], p: Params) -> Machine | None:
    """``docs``: (hashed terms, label); None if there is only one class."""
    import numpy as np

    y = np.array([d[1] for d in docs], dtype=np.float64)
    if len(y) == 0 or y.min() == y.max():
        return None
    rng = np.random.default_rng(p.seed)
    # copies of one document are one witness
    distinct = {(d[0].tobytes(), d[1]): d for d in docs}
    docs = list(distinct.values())
    y = np.array([d[1] for d in docs], dtype=np.float64)
    known = evident(docs, y, p)
    m = len(known)
    w, v = np.zeros(m), rng.normal(0, 0.01, (m, p.factors))
    gw, gv, gb = np.full(m, 1e-6), np.full((m, p.factors), 1e-6), 1e-6
    bias = float(np.log(y.mean() / (1 - y.mean())))
    own = []
    for d in docs:
        at = np.searchsorted(known, d[0])
        at[at == m] = 0
        own.append(at[known[at] == d[0]] if m else at[:0])
    for _ in range(p.epochs):
        for i in rng.permutation(len(docs)):
            idx = own[i]
            if not len(idx):
                continue
            x = len(idx) ** -p.damping
            vi = v[idx]
            total = vi.sum(axis=0)
            z = bias + x * w[idx].sum() + 0.5 * x * x * ((total ** 2).sum() - (vi ** 2).sum())
            g = 1 / (1 + np.exp(-z)) - y[i]
            gb += g * g
            bias -= p.rate * g / np.sqrt(gb)
            d = g * x + p.decay * w[idx]
            gw[idx] += d * d
            w[idx] -= p.rate * d / np.sqrt(gw[idx])
            d = g * x * x * (total - vi) + p.decay * vi
            gv[idx] += d * d
            v[idx] = vi - p.rate * d / np.sqrt(gv[idx])
    return Machine(known, w, v, bias, p.damping)


class TermTable:
    """Words met so far with the numbers of their terms in the machine (-1: not known)."""

    def __init__(self, machine: Machine, most_words: int = 300_000):
        self.machine, self.most_words = machine, most_words
        self.number: dict[bytes, int] = {}
        self.terms = machine.known[:0].reshape(0, 1).repeat(3, axis=1)

    def logits(self, texts: list[bytes]):
        import numpy as np

        known = self.machine.known
        m = len(known)
        if len(self.number) > self.most_words:
            self.number.clear()
        split = [t.lower().split() for t in texts]
        old = len(self.number)
        for w in set().union(*split).difference(self.number):
            self.number[w] = len(self.number)
        if len(self.number) > old:
            hashes = forms(list(self.number)[old:])
            at = np.searchsorted(known, hashes)
            at[at == m] = 0
            hit = (known[at] == hashes) & (hashes != 0) if m else hashes != hashes
            if len(self.number) > len(self.terms):
                self.terms = np.concatenate(
                    [self.terms, np.zeros((len(self.number), 3), dtype=np.int64)])
            self.terms[old:len(self.number)] = np.where(hit, at, -1)
        number = self.number
        lengths = np.array([len(s) for s in split])
        ids = np.array([number[w] for s in split for w in s], dtype=np.int64)
        # each document's distinct words first: most terms stand in many of its words
        doc, ids = np.divmod(np.unique(np.repeat(np.arange(len(texts)), lengths) * len(number) + ids),
                             max(1, len(number)))
        found = self.terms[ids]
        pair = np.unique((doc[:, None] * max(1, m) + found)[found >= 0])
        doc, ids = np.divmod(pair, max(1, m))
        some, owner, sizes = np.unique(doc, return_index=True, return_counts=True)
        return self.machine.logits(ids, (sizes, owner, some), len(texts))


def score_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5,
                   threshold: float = 0.5, p: Params | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    import numpy as np
    import pandas as pd

    p = p or Params()
    spark = docs.sparkSession
    rows = sample_counts(docs, labels, label, folds, p.sample, term_set, COUNTS)
    taught = [(np.frombuffer(r["idx"], dtype=np.int64), int(r["label"])) for r in rows]
    mean = float(np.mean([t[1] for t in taught])) if taught else 0.0
    machine = train(taught, p)
    # plain arrays: what is broadcast is unpickled without this package
    parts = (machine.known, machine.linear, machine.vectors, machine.bias, machine.damping) if machine else None
    shipped = spark.sparkContext.broadcast((parts, mean))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        parts, mean = shipped.value
        table = TermTable(Machine(*parts)) if parts else None
        for batch in batches:
            texts = batch.tolist()
            values = [np.zeros(0)]
            for a, b in blocks(texts):
                values.append(np.full(b - a, mean) if table is None
                              else 1 / (1 + np.exp(-table.logits(texts[a:b]))))
            yield pd.Series(np.concatenate(values))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    score = F.pandas_udf(run, "double")
    scored = docs.select("doc_id", held_out("doc_id", folds).alias("held_out"),
                         score(text_of(docs).cast("binary")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
