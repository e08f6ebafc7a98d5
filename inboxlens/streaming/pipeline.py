"""Structured Streaming jobs: topic (or landed files) -> decode -> silver -> sinks.

* ``event_stream``: raw messages -> typed valid events with the event-time
  watermark (the same decode functions as batch).
* ``run_changelog``: one silver aggregate in update mode, checkpointed, into a
  ``foreachBatch`` changelog sink; ``availableNow`` runs it to completion.
* ``await_all``: waits for several queries; the first failure stops the rest.
* ``fanout_sink``: one decoded micro-batch to tables, topics and the quarantine.
* ``enriched_sink``: a micro-batch joined with the look-up tables of the moment.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (BinaryType, BooleanType, DateType, StringType, StructField,
                               StructType)

from ..functions import utc
from ..operators import joins, silver
from ..operators.decode import decode_events, encode_events, quarantine, valid_events
from ..schemas import EVENT_SCHEMA, WATERMARK_DELAY
from .changelog import changelog_sink, init_changelog, open_epoch, read_changelog
from .landing import MESSAGE_SCHEMA, Landing

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_settings(spark: SparkSession, state_partitions: int | None = None) -> dict:
    """Settings a stateful query is started with.

    The state partition count is fixed by the first run of a checkpoint; it
    defaults to the cluster's default parallelism (all executor cores), which
    grows with the cluster, rather than whatever ``spark.sql.shuffle.partitions``
    a batch job left behind.  State lives in RocksDB (off-heap, spills to local
    disk, checkpointed incrementally with changelogs) so large keyed state does
    not sit on the JVM heap.
    """
    n = state_partitions or _default_parallelism(spark)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def _default_parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # no SparkContext in this client (e.g. a Connect session)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


@contextmanager
def started_with(spark: SparkSession, settings: dict | None):
    """Apply ``settings`` while a stream starts, then restore the session.

    A streaming query copies the session configuration when it starts, so the
    settings stay in force for that query only.
    """
    if not settings:
        yield
        return
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: What a stream takes in at most per micro-batch unless told otherwise: the first batch
#: of a long topic must not be the whole topic.
MAX_OFFSETS = 1_000_000
MAX_BYTES = str(1 << 30)
TRIGGER = "2 seconds"


def message_stream(spark: SparkSession, landing: Landing) -> DataFrame:
    """The landed topic as a stream of (key, value) messages."""
    r = spark.readStream.schema(MESSAGE_SCHEMA)
    if landing.files_per_trigger:
        r = r.option("maxFilesPerTrigger", landing.files_per_trigger)
    else:
        r = r.option("maxBytesPerTrigger", MAX_BYTES)
    return r.parquet(landing.path)


def _triggered(writer, available_now: bool, trigger: str):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)


def event_stream(spark: SparkSession, landing: Landing,
                 watermark: str | None = WATERMARK_DELAY) -> DataFrame:
    """Typed, contract-valid events with a watermark on ``event_date``."""
    events = valid_events(decode_events(message_stream(spark, landing)))
    return events.withWatermark("event_date", watermark) if watermark else events


# The decoded-events table: typed event columns; for rejected rows also the payload as it
# came and the reason (null when valid); the ``valid`` and ``event_day`` partition columns.
DECODED_SCHEMA = StructType(
    [StructField("key", StringType()), StructField("value", BinaryType())] + list(EVENT_SCHEMA.fields)
    + [StructField("reason", StringType()), StructField("valid", BooleanType()),
       StructField("event_day", DateType())])

# Client clocks are not to be trusted: days outside of this range share one partition.
FIRST_DAY, LAST_DAY = "2000-01-01", "2099-12-31"


def event_day() -> Column:
    """The UTC day of an event, null for days that only a wrong clock can give."""
    d = utc.day("event_date")
    return F.when(d.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")), d)


def run_decode(raw: DataFrame, table_path: str, checkpoint: str, name: str,
               available_now: bool = True, wait: bool = True, trigger: str = TRIGGER) -> StreamingQuery:
    """Decode the topic once into a table that every aggregate can stream from.

    Valid and rejected rows go to one parquet file sink partitioned by
    ``valid`` (the quarantine is ``valid=false``, payload included) and by
    ``event_day``, so batch readers of the table prune by date.  Rows are clustered
    by day and rejection before the write, so a micro-batch leaves a file for each
    day rather than one for each day and task; a day's rows are spread over a few
    tasks by their key.  The file sink commits files through its metadata log, so
    downstream file streams see each committed file exactly once, also after a
    restart of this query.
    """
    # create the table folder up front (an empty typed frame in a hidden
    # sub-folder, which file listings skip) so that aggregates started at the
    # same time can already open it as a stream source
    raw.sparkSession.createDataFrame([], DECODED_SCHEMA).write.mode("ignore") \
        .parquet(f"{table_path}/_init")
    decoded = decode_events(raw)
    bad = F.size("violations") > 0
    rows = decoded.select(
        "key", F.when(bad, F.col("value").cast("binary")).alias("value"),
        *[F.col(f.name) for f in EVENT_SCHEMA.fields],
        F.when(bad, F.array_join("violations", ",")).alias("reason"),
        (~bad).alias("valid"), event_day().alias("event_day"))
    spread = F.pmod(F.xxhash64("key", "event_date"), F.lit(4))
    rows = rows.repartition(_default_parallelism(raw.sparkSession), "valid", "event_day", spread)
    writer = (rows.writeStream.queryName(name).format("parquet").partitionBy("valid", "event_day")
              .option("path", table_path).option("checkpointLocation", checkpoint))
    q = _triggered(writer, available_now, trigger).start()
    if available_now and wait:
        _await(q)
    return q


def decoded_event_stream(spark: SparkSession, table_path: str,
                         watermark: str | None = WATERMARK_DELAY,
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Valid typed events streamed from the decoded-events table (no JSON work)."""
    r = spark.readStream.schema(DECODED_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    else:  # a new aggregate, or one after a pause, takes the history in parts
        r = r.option("maxBytesPerTrigger", MAX_BYTES)
    events = (r.parquet(table_path).filter(F.col("valid"))
              .select(*[F.col(f.name) for f in EVENT_SCHEMA.fields]))
    return events.withWatermark("event_date", watermark) if watermark else events


def run_changelog(agg: DataFrame, sink: str, checkpoint: str, name: str,
                  mode: str = "update", available_now: bool = True,
                  wait: bool = True, partition_by: tuple[str, ...] = (),
                  settings: dict | None = None, trigger: str = TRIGGER,
                  publish: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Start ``agg`` into a changelog sink.

    ``available_now`` processes what is there and stops (tests, scheduled
    catch-up runs); otherwise a processing-time trigger runs live.
    ``wait`` blocks until an ``available_now`` run has finished.  ``publish`` takes each
    micro-batch as well (e.g. ``kafka.changelog_topic_sink``): the batch is then kept for
    both writes.
    """
    spark = agg.sparkSession
    epoch = open_epoch(spark, sink, checkpoint)
    init_changelog(spark, sink, agg.schema, partition_by, epoch)
    write = changelog_sink(sink, partition_by, epoch)
    sinks = [write] if publish is None else [write, publish]
    writer = (agg.writeStream.queryName(name).outputMode(mode)
              .option("checkpointLocation", checkpoint).foreachBatch(to_all(sinks)))
    with started_with(spark, settings):
        q = _triggered(writer, available_now, trigger).start()
    if available_now and wait:
        _await(q)
    return q


def to_all(sinks: Sequence[Callable[[DataFrame, int], None]]):
    """A ``foreachBatch`` function that hands each micro-batch to every sink; with more
    than one the batch is computed once and kept meanwhile."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if len(sinks) == 1:
            sinks[0](batch, batch_id)
            return
        batch.persist()
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()
    return write


def await_all(queries: Sequence[StreamingQuery]) -> None:
    """Wait until every query has ended.  As soon as one fails, whichever it is, the
    others are stopped and the failure is raised."""
    try:
        while True:
            for q in queries:
                if not q.isActive and q.exception() is not None:
                    raise RuntimeError(f"stream {q.name} failed: {q.exception()}")
            running = [q for q in queries if q.isActive]
            if not running:
                break
            running[0].awaitTermination(1)  # wake up every second: any of them may have failed
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
    for q in queries:
        STREAM_STATS[q.name] = throughput(q)


def _await(q: StreamingQuery) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {q.name} failed: {q.exception()}")
    STREAM_STATS[q.name] = throughput(q)


# name -> {"rows", "batches", "seconds", "rows_per_sec"} of finished availableNow runs
STREAM_STATS: dict[str, dict] = {}


def throughput(q: StreamingQuery) -> dict:
    """Input rows, micro-batches and rows per second of trigger time, from the
    query's progress reports."""
    progress = q.recentProgress
    rows = sum(p["numInputRows"] for p in progress)
    ms = sum(p["durationMs"].get("triggerExecution", 0) for p in progress)
    return {"rows": rows, "batches": sum(1 for p in progress if p["numInputRows"] > 0),
            "seconds": ms / 1000.0, "rows_per_sec": round(rows * 1000.0 / ms, 1) if ms else None}


def folder_sink(path: str, epoch: int):
    """A ``foreachBatch`` function that keeps each micro-batch in
    ``path/epoch=E/batch_id=N`` (``changelog.open_epoch``): a replayed batch overwrites its
    own folder, a new checkpoint, whose batch ids begin at 0 again, nothing of the old one's.
    ``read_batches`` reads them back."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}/batch_id={batch_id}")
    return write


def read_batches(spark: SparkSession, path: str, every: bool = False) -> DataFrame:
    """The rows of a ``folder_sink`` or ``enriched_sink``: of the newest epoch, which began
    with the oldest message the source has, or of every one."""
    rows = spark.read.parquet(path) if every else read_changelog(spark, path)
    return rows.drop("epoch", "batch_id")


def fanout_sink(valid_sinks: Sequence, message_sinks: Sequence, quarantine_sinks: Sequence):
    """``foreachBatch`` over decoded rows: the typed valid events to every table sink, their
    encoded messages to every topic sink, and the rejected rows, payload included, to every
    quarantine sink (functions of (batch, batch id): ``folder_sink``, or
    ``ledger.once_sink`` over ``kafka.append_target`` or ``jdbc.append_target``).  The decoded
    batch is computed once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            events = valid_events(batch)
            for sink in valid_sinks:
                sink(events, batch_id)
            for sink in message_sinks:
                sink(encode_events(events).select("key", "value"), batch_id)
            for sink in quarantine_sinks:
                sink(quarantine(batch).select("key", "value", "reason"), batch_id)
        finally:
            batch.unpersist()
    return write


def run_fanout(spark: SparkSession, raw: DataFrame, checkpoint: str, valid_sinks: Sequence,
               message_sinks: Sequence, quarantine_sinks: Sequence, available_now: bool = True,
               trigger: str = TRIGGER, wait: bool = True) -> StreamingQuery:
    """Decode a stream of messages and fan it out; see ``fanout_sink``."""
    writer = (decode_events(raw).writeStream.queryName(f"fanout_{uuid.uuid4().hex[:8]}")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(fanout_sink(valid_sinks, message_sinks, quarantine_sinks)))
    q = _triggered(writer, available_now, trigger).start()
    if available_now and wait:
        _await(q)
    return q


def enriched_sink(path: str, products: Callable[[], DataFrame], campaigns: Callable[[], DataFrame],
                  epoch: int, target_rows: int = 1_000_000):
    """``foreachBatch`` that enriches a micro-batch with the look-up tables *as they are
    now* and keeps it in ``path/epoch=E/batch_id=N``.

    ``products`` and ``campaigns`` read their table anew for each batch, so a row that was
    added meanwhile is found.  Micro-batches have no adaptive skew split, so the batch's own
    key counts say which keys are split, and over how many sub-keys
    (``joins.hot_keys``)."""
    keep = folder_sink(path, epoch)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            p, c = products(), campaigns()
            joins.assert_unique(p, "id")  # a left look-up must not multiply events
            joins.assert_unique(c, "uuid_campaign")
            out = silver.enrich_events(batch, p, c, joins.hot_keys(batch, "product_id", target_rows),
                                       joins.hot_keys(batch, "campaign_id", target_rows))
            keep(out, batch_id)
        finally:
            batch.unpersist()
    return write


def run_enriched(events: DataFrame, path: str, checkpoint: str, name: str, products, campaigns,
                 available_now: bool = True, trigger: str = TRIGGER, wait: bool = True,
                 settings: dict | None = None) -> StreamingQuery:
    """Stream events through ``enriched_sink``."""
    epoch = open_epoch(events.sparkSession, path, checkpoint)
    writer = (events.writeStream.queryName(name).option("checkpointLocation", checkpoint)
              .foreachBatch(enriched_sink(path, products, campaigns, epoch)))
    with started_with(events.sparkSession, settings):
        q = _triggered(writer, available_now, trigger).start()
    if available_now and wait:
        _await(q)
    return q


def with_freshness(df: DataFrame) -> DataFrame:
    """Stamp a gold result with the time it was computed (``computed_at``)."""
    return df.withColumn("computed_at", F.current_timestamp())
