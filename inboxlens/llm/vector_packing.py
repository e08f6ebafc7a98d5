"""Vector best-fit packing of documents into training sequences.

A sequence has three capacities: tokens, documents, and attention cost (the sum of the
squared piece lengths).  A document that is longer than a sequence is cut into whole
sequences and one shorter first piece; every piece is an item with the vector
(length, 1, length squared).  Items are taken by falling length; each goes to the open
sequence that fits it under every constraint and is best by the weighted residual norm
(``norm``: least remains) or the weighted dot-product of item and residual (``dot``:
largest), else to a new one.

The pieces are dealt at random into groups of a bounded number, so a group is one small
task however many documents there are; with thousands of pieces in a group only its last
few sequences stay partly empty.

Rows: a null text is an empty one (a single end id); repeated rows are documents of their
own, told apart by ``row``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, give_back, materialise, slices, text_of
from .tokens import encoder

PIECE = ("doc_id long, row long, piece int, start long, length long, ids_crc32 long")
PLACE = "sequence_id long, offset long"


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int,
           with_ids: bool = False) -> DataFrame:
    """Every document's pieces of at most ``capacity`` tokens (the end id counts)."""
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"),
                       F.monotonically_increasing_id().alias("row"))

    def cut(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        encode = encoder(vocabulary)
        end = int(end_id).to_bytes(4, "little")
        names = ["doc_id", "row", "piece", "start", "length", "ids_crc32"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        if with_ids:
            names, kinds = [*names, "ids"], [*kinds, pa.binary()]
        schema = pa.schema(list(zip(names, kinds, strict=True)))
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            doc_ids, numbers = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
            for a, b in blocks(texts):
                out: list[tuple] = []
                for i, ids in zip(range(a, b), encode(texts[a:b]), strict=True):
                    ids += end
                    n = len(ids) // 4
                    first = (n - 1) % capacity + 1
                    for k, stop in enumerate(range(first, n + 1, capacity)):
                        start = stop - (capacity if k else first)
                        own = ids[4 * start:4 * stop]
                        out.append((doc_ids[i], numbers[i], k, start, stop - start, zlib.crc32(own), own))
                columns = list(zip(*out, strict=True))[:len(names)]
                yield pa.RecordBatch.from_pydict(dict(zip(names, columns, strict=True)), schema=schema)
        encode = texts = None
        give_back()

    return cols.mapInArrow(cut, PIECE + (", ids binary" if with_ids else ""))


def best_fit(lengths, capacity: int, max_documents: int, max_attention: float,
             measure: str = "norm", weights=(1.0, 1.0, 1.0)):
    """Bin number of each item (``lengths`` fall); see the module's text."""
    import numpy as np

    caps = np.array([capacity, max_documents, max_attention], dtype=np.float64)
    w = np.asarray(weights, dtype=np.float64) / caps ** 2
    bins = np.empty(len(lengths), dtype=np.int64)
    least = int(lengths[-1]) if len(lengths) else 0
    left = np.empty((3, max(len(lengths), 1)))  # residuals of the open sequences
    names = np.empty(max(len(lengths), 1), dtype=np.int64)
    used = made = placed = 0
    for i, n in enumerate(lengths):
        item = np.array([n, 1.0, float(n) * n])
        if (item > caps).any():
            raise ValueError("an item is larger than a sequence")
        best = -1
        if used:
            open_ = left[:, :used]
            rest = open_ - item[:, None]
            fits = np.flatnonzero(rest.min(axis=0) >= 0)
            if len(fits):
                if measure == "norm":
                    best = fits[np.argmin(w @ rest[:, fits] ** 2)]
                else:
                    best = fits[np.argmax((w * item) @ open_[:, fits])]
        if best < 0:
            left[:, used], names[used], best = caps, made, used
            used, made = used + 1, made + 1
        bins[i] = names[best]
        left[:, best] -= item
        placed += 1
        if placed % 256 == 0:  # sequences that can take no more are closed
            on = np.flatnonzero((left[0, :used] >= least) & (left[1, :used] >= 1)
                                & (left[2, :used] >= float(least) * least))
            left[:, :len(on)], names[:len(on)] = left[:, on], names[on]
            used = len(on)
    return bins


def pack(found: DataFrame, capacity: int, max_documents: int, max_attention: float,
         measure: str = "norm", weights=(1.0, 1.0, 1.0), group_size: int = 8192) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to materialised pieces."""
    n = found.count()
    groups = max(1, -(-n // group_size))
    if groups >= 2 ** 31:
        raise ValueError("too many groups: raise group_size")
    dealt = found.withColumn("grp", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)))

    def place(pdf):
        import numpy as np

        pdf = pdf.sort_values(["length", "row", "piece"], ascending=[False, True, True],
                              ignore_index=True)
        bins = best_fit(pdf["length"].to_numpy(), capacity, max_documents, max_attention,
                        measure, weights)
        lengths = pdf["length"].to_numpy()
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.searchsorted(bins[order], bins[order], side="left")
        offset = np.empty(len(bins), dtype=np.int64)
        offset[order] = before - before[first]
        pdf["sequence_id"] = pdf["grp"].to_numpy() * np.int64(2 ** 32) + bins
        pdf["offset"] = offset
        return pdf.drop(columns="grp")

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema)
    return dealt.groupBy("grp").applyInPandas(place, f"{kinds}, {PLACE}")


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 2048,
                   max_documents: int | None = None, max_attention: float | None = None,
                   measure: str = "norm", weights=(1.0, 1.0, 1.0), group_size: int = 8192,
                   with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack.  A constraint that is not given is as wide as the tokens
    allow (``capacity`` documents, ``capacity`` squared attention)."""
    found = materialise(pieces(docs, vocabulary, end_id, capacity, with_ids), "pieces")
    return pack(found, capacity, max_documents or capacity, max_attention or float(capacity) ** 2,
                measure, weights, group_size)
