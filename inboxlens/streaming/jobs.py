"""Streaming queries of the catalogue.

Each runs a real Structured Streaming query over the landed event topic of a
scale directory (``availableNow``: several micro-batches, then stop), into a
checkpointed changelog sink under ``spark.checkpoint.dir``, and returns the
compacted sink as a batch DataFrame.  Each result must equal its batch query.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import utc
from ..operators import decode, dims, gold, routing, silver
from ..schemas import EVENT_SCHEMA
from ..session import fresh_dir
from ..sources import bookmarks, files, fixture, kafka
from .changelog import init_changelog, latest_per_key, open_epoch, read_changelog, totals_per_key
from .customers import RECORD_SCHEMA, read_customers, run_customers
from .landing import MESSAGE_SCHEMA, land_messages, landed_events
from .late import read_late, read_windows, run_windows
from .ledger import once_sink
from .pipeline import (event_stream, folder_sink, message_stream, read_batches, run_changelog, run_enriched,
                       run_fanout, state_settings)
from .reach import STATED_ERROR, reach, read_sketches, run_reach


def _run(spark: SparkSession, sf_dir: str, build, name: str, mode: str = "update") -> DataFrame:
    """Stream ``build(events)`` over the landed topic; return the raw changelog."""
    landing = landed_events(spark, sf_dir)
    root = fresh_dir(spark, f"stream-{name}")
    agg = build(event_stream(spark, landing))
    sink = os.path.join(root, "changelog")
    qname = f"{name}_{uuid.uuid4().hex[:8]}"
    run_changelog(agg, sink, os.path.join(root, "checkpoint"), qname,
                  mode=mode, settings=state_settings(spark))
    LAST_RUN[name] = qname
    return read_changelog(spark, sink)


# job name -> query name of its latest run (throughput in pipeline.STREAM_STATS)
LAST_RUN: dict[str, str] = {}


def stream_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals only grow, so the maximum per key compacts the changelog."""
    log = _run(spark, sf_dir, silver.campaign_city_counts, "city")
    return totals_per_key(log, ["campaign_id", "city"]).select("campaign_id", "city", "count")


def stream_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _run(spark, sf_dir, silver.campaign_type_counts, "types")
    return totals_per_key(log, ["campaign_id"])


def stream_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _run(spark, sf_dir, silver.engagement_counts, "engagement")
    return totals_per_key(log, ["campaign_id", "customer_id", "type_event"])


def changelog_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """General compaction: the row of the latest micro-batch per key."""
    log = _run(spark, sf_dir, silver.engagement_counts, "engagement_latest")
    return latest_per_key(log, ["campaign_id", "customer_id", "type_event"])


def stream_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily event-time windows with the 1-minute watermark, in update mode."""
    log = _run(spark, sf_dir, lambda ev: silver.activity_windows(ev, "1 day"), "activity")
    out = totals_per_key(log, ["campaign_id", "type_event", "window_start", "window_end"])
    return out.select("campaign_id", "type_event", utc.wall("window_start").alias("window_start"),
                      utc.wall("window_end").alias("window_end"), "events")


def stream_product_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live product counts, compacted, then the batch ranking (top-k, join, rank)."""
    log = _run(spark, sf_dir, silver.product_counts, "products")
    return gold.product_ranking(totals_per_key(log, ["product_id"]), fixture.products(spark, sf_dir))


def gold_city_from_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City roll-up and top-k from the compacted (campaign, city) totals of a stream."""
    return gold.city_top_from_silver(stream_city(spark, sf_dir))


def topic_changelog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changelog as the topic carries it: each micro-batch of a running aggregate as
    keyed messages; read back, decoded to typed rows and compacted."""
    landing = landed_events(spark, sf_dir)
    root = fresh_dir(spark, "topic-changelog")
    topic = f"{root}/topic"
    keys = ["campaign_id", "city"]
    epoch = open_epoch(spark, topic, f"{root}/checkpoint")
    init_changelog(spark, topic, MESSAGE_SCHEMA, epoch=epoch)
    keep = folder_sink(topic, epoch)
    agg = silver.campaign_city_counts(event_stream(spark, landing))
    run_changelog(agg, f"{root}/changelog", f"{root}/checkpoint", f"topic_{uuid.uuid4().hex[:8]}",
                  settings=state_settings(spark),
                  publish=lambda batch, n: keep(kafka.keyed_messages(batch, keys, n), n))
    messages = read_batches(spark, topic).select("key", "value")
    rows = kafka.decode_changelog(messages, agg.schema)
    return latest_per_key(rows, keys).select("campaign_id", "city", "count")


def fanout_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream, several sinks per micro-batch (table, topic, quarantine), the topic only
    appended to; read back and decoded it must give the original events."""
    landing = landed_events(spark, sf_dir)
    root = fresh_dir(spark, "fanout")
    epoch = open_epoch(spark, f"{root}/table", f"{root}/checkpoint")
    files.append_rows(f"{root}/topic")(spark.createDataFrame([], MESSAGE_SCHEMA))
    topic = once_sink(files.append_target(f"{root}/topic"), f"{root}/ledger", epoch)
    run_fanout(spark, message_stream(spark, landing), f"{root}/checkpoint", [folder_sink(f"{root}/table", epoch)],
               [topic], [folder_sink(f"{root}/quarantine", epoch)])
    topic = spark.read.schema(MESSAGE_SCHEMA).parquet(f"{root}/topic")
    back = decode.valid_events(decode.decode_events(topic))
    return back.withColumn("event_date", utc.wall("event_date"))


def stream_enriched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment in micro-batches: each left-joins the product and campaign tables as they
    are at that moment."""
    landing = landed_events(spark, sf_dir)
    root = fresh_dir(spark, "stream-enriched")
    products, campaigns = (lambda: fixture.products(spark, sf_dir)), (lambda: fixture.campaigns(spark, sf_dir))
    empty = silver.enrich_events(spark.createDataFrame([], EVENT_SCHEMA), products(), campaigns())
    init_changelog(spark, f"{root}/enriched", empty.schema,
                   epoch=open_epoch(spark, f"{root}/enriched", f"{root}/checkpoint"))
    name = f"enriched_{uuid.uuid4().hex[:8]}"
    run_enriched(event_stream(spark, landing), f"{root}/enriched", f"{root}/checkpoint", name,
                 products, campaigns, settings=state_settings(spark))
    LAST_RUN["enriched"] = name
    out = read_batches(spark, f"{root}/enriched")
    return out.withColumn("event_date", utc.wall("event_date"))


def stream_route_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule-based routing of the raw topic (damaged messages included): one
    write per micro-batch, partitioned by the computed ``topic`` column."""
    landing = landed_events(spark, sf_dir, corrupt=True)
    root = fresh_dir(spark, "stream-route")
    routed = routing.route_events(decode.decode_events(message_stream(spark, landing)))
    sink = os.path.join(root, "topics")
    run_changelog(routed, sink, os.path.join(root, "checkpoint"), f"route_{uuid.uuid4().hex[:8]}",
                  mode="append", partition_by=("topic",), settings=state_settings(spark))
    return read_changelog(spark, sink).select("topic", "key", "value", "type_event")


def customer_messages(customers: DataFrame) -> DataFrame:
    """The customers topic of a whole table, in the order of ``event_date``: every row in an
    older version, then as it is, then every third of the older ones sent again, and a record
    without a campaign for every eleventh id.  Of one key the newer message has the greater
    offset."""
    third, eleventh = F.col("id") % 3 == 0, F.col("id") % 11 == 0
    older = customers.withColumns({"name_customer": F.lit("old"), "country": F.lit(None).cast("string")})
    parts = [(older, 0, 0), (customers, 1, 1), (older.where(third), 0, 2),
             (customers.where(eleventh).withColumn("campaign_id", F.lit(None).cast("string")), 2, 2)]
    out = None
    for rows, version, at in parts:
        part = kafka.id_keyed_messages(rows, "id").select(
            "key", "value", F.pmod(F.xxhash64("key"), F.lit(4)).cast("int").alias("partition"),
            (F.col("key").cast("long") * 3 + version).alias("offset"),
            F.timestamp_seconds(F.lit(at)).alias("event_date"))
        out = part if out is None else out.unionByName(part)
    return out


def stream_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers table as a stream of customer records leaves it: upserts by key, with
    older and repeated versions and records that break the contract among them."""
    users = dims.flatten_users(fixture.user_records(spark, sf_dir))
    table = dims.customers_table(fixture.events(spark, sf_dir, geo=False), users)
    landing = land_messages(spark, customer_messages(table), slices=3, columns=RECORD_SCHEMA.names)
    root = fresh_dir(spark, "customers")
    messages = (spark.readStream.schema(RECORD_SCHEMA)
                .option("maxFilesPerTrigger", landing.files_per_trigger).parquet(landing.path))
    run_customers(messages, f"{root}/table", f"{root}/checkpoint", f"customers_{uuid.uuid4().hex[:8]}", buckets=8)
    return read_customers(spark, f"{root}/table")


def stream_sessions(spark: SparkSession, sf_dir: str, gap: str = "12 hours") -> DataFrame:
    """Sessions in append mode, each emitted once when the watermark passes its end.  Last
    comes a message of a customer of its own, so much later that it closes all others."""
    closing = (fixture.events(spark, sf_dir)
               .agg(F.max("event_date").alias("newest"))
               .select(F.lit(-1).cast("long").alias("customer_id"), F.lit("closing").alias("campaign_id"),
                       F.lit("SENT").alias("type_event"), (F.col("newest") + F.expr("INTERVAL 7 DAYS")).alias("event_date"),
                       *[F.lit(None).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields[4:]]))
    landing = land_messages(spark, fixture.event_messages(spark, sf_dir))
    land_messages(spark, decode.encode_events(closing), slices=1, files_per_slice=1, path=landing.path)
    root = fresh_dir(spark, "stream-sessions")
    run_changelog(silver.session_counts(event_stream(spark, landing), gap), f"{root}/changelog", f"{root}/checkpoint",
                  f"sessions_{uuid.uuid4().hex[:8]}", mode="append", settings=state_settings(spark))
    out = read_changelog(spark, f"{root}/changelog")
    return out.select("customer_id", utc.wall("session_start").alias("session_start"),
                      utc.wall("session_end").alias("session_end"), "events")


def stream_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct clickers and openers from the sketches of all micro-batches, per campaign and
    in all (null campaign), each beside the exact count: whether it is within three times the
    stated error (and one person)."""
    landing = landed_events(spark, sf_dir)
    root = fresh_dir(spark, "reach")
    run_reach(event_stream(spark, landing, watermark=None), f"{root}/sketches", f"{root}/checkpoint",
              f"reach_{uuid.uuid4().hex[:8]}")
    sketches = read_sketches(spark, f"{root}/sketches")
    found = reach(sketches).unionByName(reach(sketches, ()).withColumn("campaign_id", F.lit(None).cast("string")))
    ev = fixture.events(spark, sf_dir, geo=False)
    whole = gold.user_ctr(ev.withColumn("campaign_id", F.lit(None).cast("string")))
    exact = gold.user_ctr(ev).unionByName(whole).select(
        "campaign_id", *[F.col(k).alias(f"exact_{k}") for k in ("clickers", "openers")])
    both = exact.join(found.withColumnRenamed("campaign_id", "c"), F.col("campaign_id").eqNullSafe(F.col("c")), "left")

    def within(k: str):
        near = F.abs(F.coalesce(F.col(k), F.lit(0)) - F.col(f"exact_{k}")) <= 1 + 3 * STATED_ERROR * F.col(f"exact_{k}")
        return near.alias(f"{k}_within")

    return both.select("campaign_id", F.col("exact_clickers").alias("clickers"), F.col("exact_openers").alias("openers"),
                       within("clickers"), within("openers"))


def stream_late_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows of a topic of which every seventh customer's events come after all others,
    by a stream that was stopped in between: ``events`` counted into each window and ``late``
    rows that came after it had ended."""
    messages = fixture.event_messages(spark, sf_dir)
    behind = F.col("key").cast("long") % 7 == 0
    landing = land_messages(spark, messages.where(~F.coalesce(behind, F.lit(False))), slices=3)
    root = fresh_dir(spark, "late-activity")

    def run() -> None:
        run_windows(event_stream(spark, landing, watermark=None), f"{root}/activity", f"{root}/checkpoint",
                    f"late_{uuid.uuid4().hex[:8]}")

    run()
    land_messages(spark, messages.where(behind), slices=1, path=landing.path)
    run()  # the delayed messages are the next micro-batch
    late = silver.activity_windows(read_late(spark, f"{root}/activity"), "1 day")
    none = F.lit(0).cast("long")
    parts = read_windows(spark, f"{root}/activity").withColumn("late", none).unionByName(
        late.withColumnRenamed("events", "late").withColumn("events", none))
    out = parts.groupBy("campaign_id", "type_event", "window_start", "window_end").agg(
        F.sum("events").cast("long").alias("events"), F.sum("late").cast("long").alias("late"))
    return out.select("campaign_id", "type_event", utc.wall("window_start").alias("window_start"),
                      utc.wall("window_end").alias("window_end"), "events", "late")


def topic_bookmarked_types(spark: SparkSession, sf_dir: str, reads: int = 3) -> DataFrame:
    """Campaign type counts from bounded reads of the topic, each from the bookmark that the
    read before left: messages land between the reads, every one is counted once."""
    messages = fixture.event_messages(spark, sf_dir)
    root = fresh_dir(spark, "bookmarked")
    numbered = messages.select(
        "key", "value", "event_date", F.pmod(F.xxhash64("key"), F.lit(4)).cast("int").alias("partition"),
        F.coalesce(F.unix_micros("event_date"), F.lit(0)).alias("offset"))
    # the time is the offset: a message that lands later has a greater one
    bounds = messages.agg(*[F.expr(f"approx_percentile(unix_micros(event_date), {i / reads})").alias(f"b{i}")
                            for i in range(1, reads)]).first()
    cuts = [None, *[bounds[f"b{i}"] for i in range(1, reads)], None]
    topic = bookmarks.folder_topic(f"{root}/topic")
    for i in range(reads):
        part = numbered
        if cuts[i] is not None:
            part = part.where(F.col("offset") >= cuts[i])
        if cuts[i + 1] is not None:
            part = part.where(F.col("offset") < cuts[i + 1])
        part.drop("event_date").write.mode("append").parquet(f"{root}/topic")
        rows, done = bookmarks.take(spark, topic, f"{root}/bookmark")
        counts = silver.campaign_type_counts(decode.valid_events(decode.decode_events(rows)))
        counts.write.mode("overwrite").parquet(f"{root}/counts/read={i}")
        done()
    parts = spark.read.parquet(f"{root}/counts")
    return parts.groupBy("campaign_id").agg(
        *[F.sum(c).cast("long").alias(c) for c in ("DELIVERED", "CLICKED", "SPAM", "OPENED", "SENT")])


STREAM_QUERIES = {
    "stream_city": stream_city,
    "stream_types": stream_types,
    "stream_engagement": stream_engagement,
    "changelog_latest": changelog_latest,
    "stream_activity": stream_activity,
    "stream_product_popularity": stream_product_popularity,
    "gold_city_from_silver": gold_city_from_silver,
    "topic_changelog_roundtrip": topic_changelog_roundtrip,
    "fanout_roundtrip": fanout_roundtrip,
    "stream_enriched_events": stream_enriched_events,
    "stream_route_events": stream_route_events,
    "stream_customers": stream_customers,
    "stream_sessions": stream_sessions,
    "stream_reach": stream_reach,
    "stream_late_activity": stream_late_activity,
    "topic_bookmarked_types": topic_bookmarked_types,
}
