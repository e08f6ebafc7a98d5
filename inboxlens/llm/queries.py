"""One query for each corpus operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .common import materialise
from .conversation_repair import digests, report
from .cross_polytope import nearest
from .decontaminate import contamination
from .entropy_mix import mix
from .factorization import score_toxicity
from .imatch import fingerprints
from .line_dedup import dedup_lines
from .ngram_trie import score_documents
from .simhash_trie import simhash_groups
from .subword_quality import score_quality
from .token_files import read_tokens, write_tokens
from .vector_packing import pack_documents
from .whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents"), k=2, window=2, min_chars=120, counts=True)
    return out.select("doc_id", "text", "removed")


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"), least_share=0.001, most_share=0.1)


def op3_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), folds=10, order=3)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = write_tokens(docs, vocabulary("word_bpe_49k.json"), end_id=1)
    return read_tokens(spark, manifest)


def op5_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                         label="quality", folds=5, threshold=0.3)


def op6_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), cap=3.0)
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op10_factorization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                          label="toxic", folds=5, threshold=0.5)


def op7_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op8_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = pack_documents(docs, vocabulary("byte_bpe_50k.json"), end_id=0, capacity=2048)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "row")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults by crc32("conv_id:turn") mod 20: 0 drops the row, 1
    empties its text, 2 removes what ends sentences, 3 repeats it, 4 gives it to the user."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    by = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), by.alias("by")).where("by <> 0")
    text = F.when(F.col("by") == 1, F.lit("")).when(F.col("by") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("by") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(F.sequence(F.lit(1), F.when(F.col("by") == 3, 2).otherwise(1))).alias("again"))
    return rows.drop("again")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    original = table(spark, sf_dir, "conversations")
    rows = damaged(original)
    return digests(rows, materialise(report(rows, original), "reports"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whiten(table(spark, sf_dir, "embeddings"), components=4, scale=256)
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_imatch": op2_imatch,
    "op3_ngram_trie": op3_ngram_trie,
    "op4_token_files": op4_token_files,
    "op5_subword_quality": op5_subword_quality,
    "op6_entropy_mix": op6_entropy_mix,
    "op10_factorization": op10_factorization,
    "op7_cross_polytope": op7_cross_polytope,
    "op8_simhash_trie": op8_simhash_trie,
    "op9_vector_packing": op9_vector_packing,
    "op11_decontamination": op11_decontamination,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op11_decontamination": oracle.DECONTAMINATION,
    "op12_conversation_repair": oracle.CONVERSATION_REPAIR,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
