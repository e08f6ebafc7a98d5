"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors: one for each occurrence of a word, one for
each of the word's character n-grams (both hashed into a fixed number of buckets), and one
for each word that repeats the word before it.  A softmax over the averaged vector gives
the class.  The vectors and the output are trained together by stochastic gradient
descent in numpy on a bounded sample of labelled rows (``sample`` documents, those with
the least hash of their doc_id); Spark makes the sample's bucket counts and scores every
document with the broadcast model, whose size is fixed by its parameters.

Rows: a null text is an empty one and gets the score of the prior; rows without label or
with a null label teach nothing; without two classes to learn from every score is the
mean label (0.5 without labels); repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, give_back, held_out, release, slices, text_of
from .wordhash import subwords, word_hashes

REPEAT = b"\n"  # no word holds it: the feature of a word that repeats its predecessor


@dataclass(frozen=True)
class Params:
    buckets_log2: int = 17
    dim: int = 16
    least: int = 3
    most: int = 5
    epochs: int = 8
    rate: float = 1.0
    sample: int = 2000
    seed: int = 1


class WordTable:
    """Words met so far with the sums of their features' rows of ``weights``."""

    def __init__(self, weights, p: Params, most_words: int = 100_000):
        import numpy as np

        self.weights, self.p, self.most_words = weights, p, most_words
        self.repeat = self._sums([REPEAT])[0]
        self.number: dict[bytes, int] = {}
        self.sums = np.zeros((1024, weights.shape[1] + 1))

    def _sums(self, words: list[bytes]):
        """Sum of the weights of each word's features, and their number."""
        import numpy as np

        if words == [REPEAT]:
            hashes, owner = word_hashes(words), np.zeros(1, dtype=np.int64)
        else:
            hashes, owner = subwords(words, self.p.least, self.p.most)
        bucket = (hashes >> np.uint64(64 - self.p.buckets_log2)).astype(np.int64)
        out = np.empty((len(words), self.weights.shape[1] + 1))
        for c in range(self.weights.shape[1]):
            out[:, c] = np.bincount(owner, weights=self.weights[bucket, c], minlength=len(words))
        out[:, -1] = np.bincount(owner, minlength=len(words))
        return out

    def averages(self, texts: list[bytes]):
        """Mean feature row of each text (zero for a text without words)."""
        import numpy as np

        if len(self.number) > self.most_words:
            self.number.clear()
        split = [t.split() for t in texts]
        number, old = self.number, len(self.number)
        for w in set().union(*split).difference(number):
            number[w] = len(number)
        if len(number) > old:
            if len(number) > len(self.sums):
                self.sums = np.concatenate([self.sums, np.zeros((len(number), self.sums.shape[1]))])
            self.sums[old:len(number)] = self._sums(list(number)[old:])
        lengths = np.array([len(s) for s in split])
        ids = np.array([number[w] for s in split for w in s], dtype=np.int64)
        out = np.zeros((len(texts), self.sums.shape[1]))
        if len(ids):
            full = np.flatnonzero(lengths)
            starts = (np.cumsum(lengths) - lengths)[full]
            same = np.append(False, ids[1:] == ids[:-1])
            same[starts] = False
            out[full] = np.add.reduceat(self.sums[ids], starts)
            out[full] += np.add.reduceat(same.astype(np.float64), starts)[:, None] * self.repeat
        return out[:, :-1] / np.maximum(out[:, -1:], 1.0)


def counts_of(text: bytes, p: Params):
    """The text's feature buckets and how often each occurs."""
    import numpy as np

    found = text.split()
    if not found:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
    distinct: dict[bytes, int] = {}
    for w in found:
        distinct[w] = distinct.get(w, 0) + 1
    hashes, owner = subwords(list(distinct), p.least, p.most)
    times = np.fromiter(distinct.values(), dtype=np.int64)[owner]
    again = sum(a == b for a, b in zip(found, found[1:], strict=False))
    if again:
        hashes = np.append(hashes, word_hashes([REPEAT]))
        times = np.append(times, again)
    bucket, inverse = np.unique((hashes >> np.uint64(64 - p.buckets_log2)).astype(np.int32),
                                return_inverse=True)
    return bucket, np.bincount(inverse, weights=times).astype(np.int32)


def train(docs: list[tuple], p: Params):
    """``docs``: (buckets, counts, label).  The bucket's logits (buckets x 2) and the
    bias; None if there is only one class."""
    import numpy as np

    y = np.array([d[2] for d in docs], dtype=np.int64)
    if len(y) == 0 or y.min() == y.max():
        return None
    rng = np.random.default_rng(p.seed)
    vectors = rng.uniform(-1, 1, (1 << p.buckets_log2, p.dim)).astype(np.float32) / p.dim
    out = np.zeros((p.dim, 2), dtype=np.float32)
    bias = np.log(np.bincount(y, minlength=2) / len(y)).astype(np.float32)
    steps, at = p.epochs * len(docs), 0
    for _ in range(p.epochs):
        for i in rng.permutation(len(docs)):
            rate = p.rate * (1 - at / steps)
            at += 1
            idx, counts, _ = docs[i]
            if not len(idx):
                continue
            x = (counts / counts.sum()).astype(np.float32)
            hidden = x @ vectors[idx]
            z = hidden @ out + bias
            prob = np.exp(z - z.max())
            prob /= prob.sum()
            prob[y[i]] -= 1
            back = out @ prob
            out -= rate * np.outer(hidden, prob)
            bias -= 0.1 * rate * prob / 10
            vectors[idx] -= rate * x[:, None] * back[None, :]
    return (vectors @ out).astype(np.float64), bias.astype(np.float64)


def sample_counts(docs: DataFrame, labels: DataFrame, label: str, folds: int, size: int, counts,
                  kinds: str) -> list:
    """Rows ``(buckets, counts, label)`` of the ``size`` labelled training documents with
    the least hash of their doc_id; ``counts`` maps a text (bytes) to its features."""
    taught = labels.where(F.col(label).isNotNull() & ~held_out("doc_id", folds)
                          & F.col("doc_id").isNotNull())
    taught = taught.groupBy("doc_id").agg(F.min(label).alias("label"))  # one label a document
    # the sample is chosen on ids alone: only its own texts move; repeated rows take one place
    chosen = (docs.select("doc_id").distinct().join(taught, "doc_id")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(size))
    texts = (docs.select("doc_id", text_of(docs).cast("binary").alias("text"))
             .join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label"))

    def featurise(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches, 256):
            found = [counts(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").to_pylist(),
                "label": batch.column("label").to_pylist(),
                "idx": [a.tobytes() for a, _ in found], "n": [b.tobytes() for _, b in found],
            }, schema=pa.schema([("doc_id", pa.int64()), ("label", pa.int32()),
                                 ("idx", pa.binary()), ("n", pa.binary())]))

    rows = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        F.col("label").cast("int").alias("label")).mapInArrow(featurise, kinds)
    # repeated rows of a document teach once
    once = rows.groupBy("doc_id").agg(F.min(F.struct("label", "idx", "n")).alias("r")).select("doc_id", "r.*")
    return sorted(once.collect(), key=lambda r: r["doc_id"])


COUNTS = "doc_id long, label int, idx binary, n binary"


def scorer(docs: DataFrame, labels: DataFrame, label: str, folds: int, p: Params):
    """A column function that scores texts (binary), trained on the labelled ``docs``."""
    import numpy as np
    import pyarrow as pa

    spark = docs.sparkSession
    rows = sample_counts(docs, labels, label, folds, p.sample, lambda t: counts_of(t, p), COUNTS)
    taught = [(np.frombuffer(r["idx"], dtype=np.int32), np.frombuffer(r["n"], dtype=np.int32),
               int(r["label"])) for r in rows]
    mean = float(np.mean([t[2] for t in taught])) if taught else 0.5
    shipped = spark.sparkContext.broadcast((train(taught, p), mean))
    rows = taught = None  # the driver holds the model alone from here on
    give_back()
    release(spark)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, mean = shipped.value
        table = WordTable(model[0], p) if model else None
        for batch in batches:
            values = [np.zeros(0)]
            for at in range(0, len(batch), 512):  # few texts are Python objects at once
                texts = batch.slice(at, 512).to_pylist()
                for a, b in blocks(texts, 500_000):
                    if model is None:
                        values.append(np.full(b - a, mean))
                        continue
                    z = table.averages(texts[a:b]) + model[1]
                    values.append(1 / (1 + np.exp(z[:, 0] - z[:, 1])))
            yield pa.array(np.concatenate(values))
        table = batch = texts = None
        give_back()

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "double")


def score_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5,
                  threshold: float = 0.3, p: Params | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    score = scorer(docs, labels, label, folds, p or Params())
    scored = docs.select("doc_id", held_out("doc_id", folds).alias("held_out"),
                         score(text_of(docs).cast("binary")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5,
             threshold: float = 0.3, p: Params | None = None) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, as they are."""
    score = scorer(docs, labels, label, folds, p or Params())
    return docs.where(score(text_of(docs).cast("binary")) >= threshold)
