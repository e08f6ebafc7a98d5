"""Typed ingest of landed records (S6): files read with a declared schema.

Records are never inferred: a schema is passed, and non-null fields of the
declared schema are enforced by splitting rows into valid and rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..streaming.changelog import path_exists
from ..streaming.ledger import Target


def read_records(spark: SparkSession, path: str, schema: StructType, fmt: str = "json") -> DataFrame:
    return spark.read.schema(schema).format(fmt).load(path)


def append_rows(path: str):
    """Appends rows to a folder of files."""
    return lambda rows: rows.write.mode("append").parquet(path)


def append_target(path: str) -> Target:
    """A folder that micro-batches are appended to, each once (``ledger.once_sink``); the
    rows carry ``epoch`` and ``batch_id``."""
    def held(spark: SparkSession, epoch: int, batch_id: int, since: int) -> DataFrame | None:
        if not path_exists(spark, path):
            return None
        rows = spark.read.option("mergeSchema", "true").parquet(path)
        if "epoch" not in rows.columns:  # nothing but rows from elsewhere
            return None
        return rows.where((F.col("epoch") == epoch) & (F.col("batch_id") == batch_id))

    return Target(append_rows(path), held)


def parse_records(lines: DataFrame, schema: StructType) -> DataFrame:
    """Lines of JSON (``value``) -> the declared fields, the line itself (``_raw``) and
    ``_corrupt`` (null where the line is a record)."""
    open_ = StructType([StructField(f.name, f.dataType) for f in schema.fields]
                       + [StructField("_corrupt", StringType())])
    row = F.from_json("value", open_, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return lines.select(row.alias("r"), F.col("value").alias("_raw")).select("r.*", "_raw")


def split_records(parsed: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Parsed records -> (valid, rejected): a line that is no record or lacks a declared
    non-null field goes to ``rejected (raw, reason)`` as it came."""
    required = [f.name for f in schema.fields if not f.nullable]
    bad = F.col("_corrupt").isNotNull()
    # an empty line or a JSON null has neither fields nor an error
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    reason = F.when(bad, F.lit("record")).when(F.size(names) > 0, F.array_join(names, ","))
    marked = parsed.withColumn("_reason", reason)
    valid = marked.filter(F.col("_reason").isNull()).select(*[f.name for f in schema.fields])
    rejected = (marked.filter(F.col("_reason").isNotNull())
                .select(F.col("_raw").alias("raw"), F.col("_reason").alias("reason")))
    return valid, rejected


def read_records_split(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Landed JSON lines -> (valid, rejected); see ``split_records``."""
    return split_records(parse_records(spark.read.text(path), schema), schema)


def read_record_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "json",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def enforce_not_null(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Split rows on the declared non-nullable fields: (valid, rejected with reason)."""
    required = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
    reasons = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required])) \
        if required else F.array().cast("array<string>")
    marked = df.withColumn("__reasons", reasons)
    valid = marked.filter(F.size("__reasons") == 0).drop("__reasons")
    rejected = (marked.filter(F.size("__reasons") > 0)
                .withColumn("reason", F.array_join("__reasons", ",")).drop("__reasons"))
    return valid, rejected


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast ``df`` to the declared column order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
