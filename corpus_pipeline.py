"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``.  ``run`` applies them in order; every stage's rows are
written to the shared folder and read again as the next one's input.

1. quality: the documents that the quality classifier accepts.
2. line_dedup: later repeated runs of lines are deleted from the texts (a later copy may
   lose all of its text); every document stays.
3. near_dedup: of each SimHash group the document with the least doc_id stays (of rows that
   share it, one); the documents without words are one group.
4. mix: documents repeated as often as the entropy-balanced mix takes them.
5. pack: the pieces of the documents, each with its sequence and place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inboxlens.llm.common import shared_path
from inboxlens.llm.entropy_mix import mixed_documents
from inboxlens.llm.line_dedup import dedup_lines
from inboxlens.llm.queries import table, vocabulary
from inboxlens.llm.simhash_trie import first_of_groups
from inboxlens.llm.subword_quality import accepted
from inboxlens.llm.vector_packing import pack_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accepted(docs, table(spark, sf_dir, "labels"), label="quality", folds=5, threshold=0.3)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs, k=2, window=2, min_chars=120)
    # n_chars stays true to the text
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`")
                        for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return first_of_groups(docs, shingle=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs, weights=(1, 2, 3), cap=3.0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix", mix),
    ("pack", pack),
]

#: No SQL states the trained classifier, the hash-based winnowing or the packing; the tests
#: hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
