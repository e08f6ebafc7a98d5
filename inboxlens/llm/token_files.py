"""Token-id files with Elias-Fano document boundaries.

``write_tokens`` encodes every document, deals the rows out by ranges of doc_id and lets
each task write one file of its range: the concatenated ids (16 bits each where the
vocabulary allows, else 32) and two Elias-Fano sequences, the documents' ends and their
doc_ids.  A file is written under a temporary name and renamed, so a task that is lost
and run again leaves a whole file.  ``read_tokens`` opens the files of a manifest and
returns any document by a select on the ends.

Rows: a null text is an empty one (a single end id); repeated rows and equal doc_ids are
documents of their own, in an order by doc_id and then by text; a row without doc_id
comes before all others.  An empty table gives no files and an empty manifest.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, filesystem, put_file, shared_path, slices, text_of
from .elias_fano import EliasFano, encode
from .tokens import encoder

MANIFEST = "low long, file string, n_docs long, n_tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"

_MAGIC = 0x53444946  # marks a file of this format
_HEAD = 8            # 64-bit words before the ids


def write_file(uri: str, doc_ids: list[int | None], parts: list[bytes], width: int) -> None:
    """One token file; ``parts`` holds each document's 32-bit ids."""
    import numpy as np

    nulls = sum(d is None for d in doc_ids)
    known = np.array([d for d in doc_ids if d is not None], dtype=np.int64)
    least = int(known[0]) if len(known) else 0
    lengths = np.array([len(p) // 4 for p in parts], dtype=np.int64)
    total = int(lengths.sum())
    ends = encode(np.cumsum(lengths), total + 1)
    # a span over 2^63 (ids of both signs) would not fit: the ids are then kept plainly
    wide = len(known) and int(known[-1]) - least >= 2 ** 62
    names = known.tobytes() if wide else encode(known - least)
    pad = -total * width % 8
    head = np.array([_MAGIC, len(parts), total, width, nulls, least, len(ends), int(bool(wide))],
                    dtype=np.int64)
    put_file(uri, [head.tobytes(),
                   *(np.frombuffer(p, dtype="<u4").astype("<u2").tobytes() if width == 2 else p for p in parts),
                   b"\0" * pad, ends, names])


class TokenFile:
    """A token file, read through its Elias-Fano boundaries."""

    def __init__(self, uri: str):
        import numpy as np

        fs, path = filesystem(uri)
        self._file = fs.open_input_file(path)
        head = np.frombuffer(self._file.read_at(8 * _HEAD, 0), dtype=np.int64)
        if int(head[0]) != _MAGIC:
            raise ValueError(f"not a token file: {uri}")
        _, self.n_docs, self.n_tokens, self.width, nulls, least, size, wide = (int(x) for x in head)
        at = 8 * _HEAD + self.n_tokens * self.width + (-self.n_tokens * self.width % 8)
        tail = self._file.read_at(self._file.size() - at, at)
        self.ends = EliasFano(tail)
        names = (np.frombuffer(tail[size:], dtype=np.int64) if wide
                 else EliasFano(tail[size:]).all() + least)
        self.doc_ids = [None] * nulls + names.tolist()[:self.n_docs - nulls]

    def bounds(self, first: int, last: int):
        """Starts and ends, in ids, of the documents at positions first .. last - 1."""
        import numpy as np

        ends = self.ends.get(np.arange(max(first - 1, 0), last))
        return (ends[:-1], ends[1:]) if first else (np.append(0, ends[:-1]), ends)

    def ids(self, start: int, end: int):
        """The ids from place ``start`` to ``end`` as unsigned 32-bit integers."""
        import numpy as np

        raw = self._file.read_at((end - start) * self.width, 8 * _HEAD + start * self.width)
        return np.frombuffer(raw, dtype=f"<u{self.width}").astype("<u4")


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int, width: int = 2,
                 partitions: int | None = None) -> DataFrame:
    """Write the token files below the shared folder; returns their manifest
    (one row a file: least doc_id, file, documents, ids), ordered by ``low``.

    ``vocabulary``: file of a ``tokenizers`` vocabulary; ``end_id`` closes each document;
    ``width``: bytes an id takes (2 or 4).  The manifest is read from small files that
    lie beside the token files.
    """
    spark = docs.sparkSession
    root = shared_path(spark, "tokens")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The text rides along: it compresses better than ids, and only one shuffle is made.
    dealt = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"))
             .repartitionByRange(n, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
             .withColumn("part", F.spark_partition_id()))

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        encode = None
        doc_ids: list = []
        parts: list[bytes] = []
        part = 0
        end = int(end_id).to_bytes(4, "little")
        for batch in slices(batches):
            encode = encode or encoder(vocabulary)
            texts = batch.column("text").to_pylist()
            if texts:
                part = batch.column("part")[0].as_py()
            doc_ids += batch.column("doc_id").to_pylist()
            for a, b in blocks(texts):
                parts += [ids + end for ids in encode(texts[a:b])]
        if parts:
            file = f"{root}/tokens-{part:06d}.bin"
            write_file(file, doc_ids, parts, width)
            yield pa.RecordBatch.from_pydict({
                "low": [part], "file": [file], "n_docs": [len(parts)],
                "n_tokens": [sum(map(len, parts)) // 4],
            }, schema=pa.schema([("low", pa.int64()), ("file", pa.string()),
                                 ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    dealt.mapInArrow(write, MANIFEST).write.parquet(f"{root}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def read_tokens(spark: SparkSession, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Every document of a manifest's files: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32 (of the ids as 32-bit integers) and, if wanted, ids.

    The manifest has one row a file; the files' first places are its running sum.
    """
    files = manifest.orderBy("low").collect()  # one small row for each file
    places, before = [], 0
    for f in files:
        places.append((before, f["file"]))
        before += f["n_tokens"]
    schema = T.StructType([T.StructField("before", T.LongType()), T.StructField("file", T.StringType())])
    dealt = spark.createDataFrame(places, schema).repartition(max(1, len(places)))

    def read(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        for batch in batches:
            for before, file in zip(batch.column("before").to_pylist(),
                                    batch.column("file").to_pylist(), strict=True):
                tokens = TokenFile(file)
                for first in range(0, tokens.n_docs, 2048):
                    last = min(first + 2048, tokens.n_docs)
                    starts, ends = tokens.bounds(first, last)
                    base = int(starts[0])
                    rows: dict = {"doc_id": tokens.doc_ids[first:last],
                                  "start": (starts + before).tolist(),
                                  "n_tokens": (ends - starts).tolist(), "ids_crc32": []}
                    if with_ids:
                        rows["ids"] = []
                    ids = tokens.ids(base, int(ends[-1]))
                    for s, e in zip((starts - base).tolist(), (ends - base).tolist(), strict=True):
                        rows["ids_crc32"].append(zlib.crc32(ids[s:e].tobytes()))
                        if with_ids:
                            rows["ids"].append(ids[s:e].tolist())
                    kinds = [("doc_id", pa.int64()), ("start", pa.int64()),
                             ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
                    kinds += [("ids", pa.list_(pa.int64()))] if with_ids else []
                    yield pa.RecordBatch.from_pydict(rows, schema=pa.schema(kinds))

    return dealt.mapInArrow(read, DOCUMENTS + (", ids array<long>" if with_ids else ""))
