"""Helpers shared by the corpus operators: the shared folder, words, text blocks."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_root

# A word, and the ASCII white space between words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder (``spark.checkpoint.dir``)."""
    return f"{scratch_root(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read again: cuts the lineage."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of steps that are materialised."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def held_out(doc_id: Column | str, folds: int) -> Column:
    """True on the rows whose crc32(doc_id as text) is divisible by ``folds``."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string")) % folds == 0, F.lit(False))


def text_of(docs: DataFrame) -> Column:
    """The document's text; a null text counts as empty."""
    return F.coalesce(F.col("text"), F.lit(""))


def slices(batches: Iterator, rows: int = 1024) -> Iterator:
    """The record batches in smaller ones, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def blocks(texts: list[str], most: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts with about ``most`` characters together, so
    that what a task holds is bounded by this or by one text."""
    at = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield at, i
            at, size = i, 0
        size += len(text)
    if at < len(texts):
        yield at, len(texts)


def give_back() -> None:
    """Return what a finished task has freed to the system: Python workers are used again by
    later stages and would go on holding it."""
    import ctypes

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def spare(name: str, columns: list[str]) -> str:
    """``name``, made longer until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def filesystem(uri: str):
    """The file system of a file that a task writes or reads itself, and its path there."""
    from pyarrow import fs

    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def put_file(uri: str, parts) -> None:
    """Write a file whole: under another name first, so a lost task leaves no half."""
    import os
    import uuid as ids

    fs, path = filesystem(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{ids.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        for p in parts:
            out.write(p)
    fs.move(part, path)


def map_file(uri: str):
    """The file's bytes as an array: a memory map of a file on a path, else a copy."""
    import numpy as np
    from pyarrow import fs as kinds

    fs, path = filesystem(uri)
    if isinstance(fs, kinds.LocalFileSystem):
        return np.asarray(np.memmap(path, dtype=np.uint8, mode="r"))  # slices of a plain array cost less
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=np.uint8)
