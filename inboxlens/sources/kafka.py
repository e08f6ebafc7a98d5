"""Topic I/O: thin option builders plus the message columns (key, value, topic).

The connector (``spark-sql-kafka-0-10_2.13`` matching the Spark version) must be
on the classpath; it is not part of this environment, so only the column
transformations are tested here.  Formats and options are arguments; nothing
is read from the environment and credentials are never logged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..streaming.ledger import TAGS, Target


def source_options(bootstrap: str, topic: str, starting: str = "earliest",
                   ending: str | None = None, extra: dict | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting}
    if ending is not None:
        opts["endingOffsets"] = ending
    opts.update(extra or {})
    return opts


def read_topic_stream(spark: SparkSession, bootstrap: str, topic: str,
                      max_offsets_per_trigger: int | None = None, **extra) -> DataFrame:
    """Streaming source over a topic, from the earliest offset (S1)."""
    opts = source_options(bootstrap, topic, extra=extra)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**opts).load()


def read_topic_batch(spark: SparkSession, bootstrap: str, topic: str, **extra) -> DataFrame:
    """Bounded read of everything in a topic, earliest to latest (S3)."""
    return (spark.read.format("kafka")
            .options(**source_options(bootstrap, topic, "earliest", "latest", extra)).load())


def message_values(df: DataFrame, text: bool = True) -> DataFrame:
    """Raw records -> (key, value) text columns (P1); offsets kept for ordering.  With
    ``text=False`` the payload keeps its bytes (text that is no UTF-8 survives)."""
    cols = [F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value") if text else F.col("value")]
    cols += [F.col(c) for c in ("topic", "partition", "offset") if c in df.columns]
    return df.select(*cols)


def keyed_messages(df: DataFrame, key_cols: Sequence[str], batch_id: int | None = None) -> DataFrame:
    """Rows -> (key, value): key = JSON of the group keys, value = JSON of the row.

    Keying changelog messages by their group keys keeps all updates of one key in
    one partition, in order; ``batch_id`` (when given) lets consumers compact.
    """
    row = F.struct(*[F.col(c) for c in df.columns],
                   *([F.lit(batch_id).alias("batch_id")] if batch_id is not None else []))
    return df.select(F.to_json(F.struct(*[F.col(c) for c in key_cols])).alias("key"),
                     F.to_json(row).alias("value"))


def decode_changelog(messages: DataFrame, schema: StructType) -> DataFrame:
    """Changelog messages -> the aggregate's typed rows and ``batch_id`` (S3): what
    ``keyed_messages`` encoded.  A message that is not one of them raises."""
    full = StructType([*schema.fields, StructField("batch_id", LongType())])
    row = F.from_json(F.col("value").cast("string"), full, {"mode": "FAILFAST"})
    return messages.select(row.alias("r")).select("r.*")


def with_headers(messages: DataFrame) -> DataFrame:
    """The tags of a message's micro-batch as its headers."""
    tags = [F.struct(F.lit(t).alias("key"), F.col(t).cast("string").cast("binary").alias("value")) for t in TAGS]
    return messages.withColumn("headers", F.array(*tags)).drop(*TAGS)


def from_headers(records: DataFrame) -> DataFrame:
    """Records read with their headers -> (topic, key, value) with the tags as columns."""
    def header(name: str):
        return F.get(F.filter("headers", lambda h: h["key"] == name), F.lit(0))["value"]

    tags = [header(t).cast("string").try_cast("long").alias(t) for t in TAGS]
    return records.select(F.col("topic"), F.col("key").cast("string").alias("key"),
                          F.col("value").cast("string").alias("value"), *tags)


def append_target(bootstrap: str, topic: str | None = None, topics: Sequence[str] = (),
                  margin_ms: int = 600_000) -> Target:
    """A topic that micro-batches of (key, value[, topic]) text messages are appended to, each
    once (S8, ``ledger.once_sink``).  Without ``topic`` they go to the one that each names,
    among ``topics``.  After a failure the messages since the batch was begun, less a margin
    for the clocks, are read back."""
    def held(spark: SparkSession, epoch: int, batch_id: int, since: int) -> DataFrame:
        records = (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap)
                   .option("subscribe", ",".join([topic] if topic else topics))
                   .option("includeHeaders", "true").option("startingTimestamp", str(since - margin_ms))
                   .option("startingOffsetsByTimestampStrategy", "latest").load())
        return from_headers(records).where((F.col("epoch") == epoch) & (F.col("batch_id") == batch_id))

    return Target(lambda rows: write_topic_batch(with_headers(rows), bootstrap, topic), held)


def id_keyed_messages(df: DataFrame, id_col: str) -> DataFrame:
    """Rows -> (key = id as text, value = JSON of the row) (S9, P5, P6)."""
    return df.select(F.col(id_col).cast("string").alias("key"),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))


def write_topic_batch(messages: DataFrame, bootstrap: str, topic: str | None = None) -> None:
    """Batch write of (key, value[, topic]) messages (S9).  Without ``topic`` each
    row goes to the topic named in its ``topic`` column (T11 routing)."""
    w = messages.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
    if topic is not None:
        w = w.option("topic", topic)
    w.save()


def write_topic_stream(messages: DataFrame, bootstrap: str, topic: str, checkpoint: str,
                       mode: str = "update") -> StreamingQuery:
    """Streaming sink of (key, value) messages in update mode (S10)."""
    return (messages.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
            .option("checkpointLocation", checkpoint).outputMode(mode).start())


def changelog_topic_sink(bootstrap: str, topic: str, key_cols: Sequence[str]):
    """``foreachBatch`` function publishing an update-mode aggregate to a topic.

    Each message is keyed by the JSON of the group keys (all updates of a key go
    to one partition, in order) and carries ``batch_id`` so consumers can keep
    the latest value per key.  A replayed batch re-publishes the same messages,
    which compaction by (key, batch_id) makes harmless.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        write_topic_batch(keyed_messages(batch, key_cols, batch_id), bootstrap, topic)
    return write
