"""Job entry points for ``spark-submit``.

    spark-submit --py-files inboxlens.zip run_job.py silver --source kafka --bootstrap host:9092 \\
        --topic events --root s3://bucket/analytics
    spark-submit --py-files inboxlens.zip run_job.py gold --root s3://bucket/analytics \\
        --campaigns s3://bucket/dims/campaign --products s3://bucket/dims/product

``silver`` decodes the topic once into ``<root>/silver/events`` (``valid=true|false``: the
rejected messages keep their payload) and runs the running aggregates from that table, each
checkpointed under ``<root>/silver/<name>``; ``--publish`` also sends the three changelogs to
their topics, ``--enrich-products/--enrich-campaigns`` adds the enriched events.  The first
query that fails ends the job.  ``--available-now`` processes what is there and stops.
``customers`` keeps the customers table below ``<root>/customers`` from a topic of customer
records.  ``route`` sends each raw message to the topic its rule names, ``fanout`` to a table, a topic
and the quarantine.  ``dims`` loads landed product/user/campaign JSON into cleaned tables
and, with ``--events``, the customers table and its keyed messages.  ``gold`` brings the
snapshots of the silver changelogs up to date and recomputes the dashboard tables as a new
version below ``<root>/gold`` with a ``computed_at`` column (``refresh.read_gold``).

Event time is UTC: ``main`` sets the session's time zone.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import dims, routing
from .operators.decode import decode_events
from .plans import dims_load
from .plans.refresh import SILVER, refresh_gold, silver_paths
from .schemas import CAMPAIGN_TOPIC, CITY_TOPIC, EFFECTIVENESS_TOPIC
from .sources import files, jdbc, kafka
from .streaming import customers
from .streaming.changelog import open_epoch
from .streaming.landing import Landing
from .streaming.ledger import Target, once_sink
from .streaming.pipeline import (MAX_BYTES, MAX_OFFSETS, TRIGGER, await_all, decoded_event_stream, folder_sink,
                                 message_stream, run_changelog, run_decode, run_enriched, run_fanout,
                                 state_settings)

#: The topic of each published changelog.
TOPICS = {"city": CITY_TOPIC, "types": CAMPAIGN_TOPIC, "engagement": EFFECTIVENESS_TOPIC}


def raw_from(spark: SparkSession, args) -> DataFrame:
    """The topic, or a landed folder, as a rate-limited stream of (key, value)."""
    if args.source == "kafka":
        return kafka.message_values(kafka.read_topic_stream(
            spark, args.bootstrap, args.topic,
            max_offsets_per_trigger=args.max_per_trigger or MAX_OFFSETS), text=False)
    return message_stream(spark, Landing(args.path, args.max_per_trigger or 0, 0))


def run_silver(spark: SparkSession, args) -> dict[str, str]:
    """Decode once, then all running aggregates; returns the changelog of each."""
    live = {"available_now": args.available_now, "trigger": args.trigger}
    settings = state_settings(spark, args.state_partitions)
    table = os.path.join(args.root, "silver", "events")
    running, sinks = [], {}
    try:
        running.append(run_decode(raw_from(spark, args), table,
                                  os.path.join(args.root, "silver", "events_checkpoint"),
                                  "silver_decode", wait=args.available_now, **live))
        events = decoded_event_stream(spark, table)
        for name, (build, keys) in SILVER.items():
            sinks[name], checkpoint, _ = silver_paths(args.root, name)
            publish = None
            if args.publish and name in TOPICS:
                publish = kafka.changelog_topic_sink(args.publish, TOPICS[name], keys)
            running.append(run_changelog(build(events), sinks[name], checkpoint, f"silver_{name}", wait=False,
                                         settings=settings, publish=publish, **live))
        if args.enrich_products and args.enrich_campaigns:
            base = os.path.join(args.root, "silver", "enriched")
            running.append(run_enriched(
                events, os.path.join(base, "events"), os.path.join(base, "checkpoint"), "silver_enriched",
                lambda: spark.read.parquet(args.enrich_products),
                lambda: spark.read.parquet(args.enrich_campaigns), wait=False, settings=settings, **live))
    except BaseException:
        for q in running:
            q.stop()
        raise
    await_all(running)
    return sinks


def run_live_customers(spark: SparkSession, args) -> None:
    """The customers table kept from a topic (or landed folder) of customer records; read it
    with ``streaming.customers.read_customers``."""
    if args.source == "kafka":
        messages = raw_from(spark, args).select(*customers.RECORD_SCHEMA.names)
    else:
        limit = ("maxFilesPerTrigger", args.max_per_trigger) if args.max_per_trigger else ("maxBytesPerTrigger", MAX_BYTES)
        messages = spark.readStream.schema(customers.RECORD_SCHEMA).option(*limit).parquet(args.path)
    base = os.path.join(args.root, "customers")
    q = customers.run_customers(messages, os.path.join(base, "table"), os.path.join(base, "checkpoint"), "customers",
                                buckets=args.buckets, available_now=args.available_now, trigger=args.trigger, wait=False)
    await_all([q])


def run_route(spark: SparkSession, args) -> None:
    """Each raw message, payload included, to the topic that its rule names."""
    rules = (routing.read_rules(spark.read.schema(routing.RULE_SCHEMA).json(args.rules)) if args.rules
             else routing.default_rules())
    routed = routing.route_events(decode_events(raw_from(spark, args)), rules)
    folder, checkpoint = os.path.join(args.root, "routed"), os.path.join(args.root, "route_checkpoint")
    epoch = open_epoch(spark, folder, checkpoint)
    if args.to:
        sink = once_sink(kafka.append_target(args.to, topics=routing.topics(rules)),
                         os.path.join(args.root, "route_ledger"), epoch)

        def write(batch: DataFrame, batch_id: int) -> None:
            value = F.col("value").cast("string").alias("value")
            sink(batch.select("topic", "key", value), batch_id)
    else:
        write = folder_sink(folder, epoch)
    writer = (routed.writeStream.queryName("route").foreachBatch(write)
              .option("checkpointLocation", checkpoint))
    q = (writer.trigger(availableNow=True) if args.available_now
         else writer.trigger(processingTime=args.trigger)).start()
    await_all([q])


def run_fan(spark: SparkSession, args) -> None:
    """The topic fanned out to a table, a topic (or folder) and the quarantine."""
    base = os.path.join(args.root, "fanout")
    folders = {name: os.path.join(base, name) for name in ("events", "topic", "quarantine")}
    checkpoint = os.path.join(base, "checkpoint")
    epoch = open_epoch(spark, list(folders.values()), checkpoint)

    def once(target: Target, name: str):
        return once_sink(target, os.path.join(base, "ledger", name), epoch)

    tables = [folder_sink(folders["events"], epoch)]
    if args.jdbc_url:
        conn = jdbc.connection_options(args.jdbc_url, args.jdbc_user,
                                       os.environ.get(args.jdbc_password_env or "", None))
        tables.append(once(jdbc.append_target(conn, args.jdbc_table), "table"))
    messages = [once(kafka.append_target(args.to, args.to_topic), "topic") if args.to
                else folder_sink(folders["topic"], epoch)]
    q = run_fanout(spark, raw_from(spark, args), checkpoint, tables, messages,
                   [folder_sink(folders["quarantine"], epoch)], available_now=args.available_now,
                   trigger=args.trigger, wait=False)
    await_all([q])


def run_gold(spark: SparkSession, args) -> dict[str, str]:
    def table(path: str | None) -> DataFrame | None:
        return spark.read.parquet(path) if path else None

    return refresh_gold(spark, args.root, table(args.campaigns), table(args.products), table(args.customers),
                        prune=args.prune)


def run_dims(spark: SparkSession, args) -> dict[str, str]:
    """Dimension load: landed JSON lines -> cleaned, typed tables (overwrite).

    Each table is split on its declared non-null fields; what is rejected is written
    beside it as ``<table>_quarantine`` (the line and the reason).  With ``--events`` (the
    decoded events table) and users, the customers table and its messages keyed by id are
    written too.  With ``--jdbc-url`` the tables are also written over JDBC (overwrite, the
    table is recreated).
    """
    paths: dict[str, str] = {}

    def write(name: str, df: DataFrame) -> None:
        paths[name] = os.path.join(args.out, name)
        df.write.mode("overwrite").parquet(paths[name])

    def both(name: str, split: tuple[DataFrame, DataFrame]) -> None:
        write(name, split[0])
        write(f"{name}_quarantine", split[1])

    if args.products:
        both("product", dims_load.products(spark.read.text(args.products)))
    if args.users:
        both("users", dims_load.users(spark.read.text(args.users)))
    if args.campaigns:
        lines = spark.read.text(args.campaigns)
        both("campaign", dims_load.campaigns(lines))
        both("campaign_product_interactions",
             dims_load.links(files.parse_records(lines, dims_load.LANDED["campaign"])))
    if args.events and args.users:
        events = spark.read.parquet(args.events).filter("valid")
        write("customers", dims.customers_table(events, spark.read.parquet(paths["users"])))
        messages = kafka.id_keyed_messages(spark.read.parquet(paths["customers"]), "id")
        write("customers_messages", messages)
        if args.publish:
            kafka.write_topic_batch(spark.read.parquet(paths["customers_messages"]), args.publish,
                                    args.customers_topic)
    if args.jdbc_url:
        conn = jdbc.connection_options(args.jdbc_url, args.jdbc_user,
                                       os.environ.get(args.jdbc_password_env or "", None))
        for name, path in paths.items():
            if not name.endswith(("_quarantine", "_messages")):
                jdbc.write_table(spark.read.parquet(path), conn, name, mode="overwrite")
    return paths


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="inboxlens.apps")
    sub = p.add_subparsers(dest="job", required=True)

    def stream(name: str) -> argparse.ArgumentParser:
        s = sub.add_parser(name)
        s.add_argument("--source", choices=["kafka", "files"], default="kafka")
        s.add_argument("--bootstrap")
        s.add_argument("--topic")
        s.add_argument("--path", help="landed message folder (source=files)")
        s.add_argument("--root", required=True)
        s.add_argument("--max-per-trigger", type=int, default=None,
                       help="offsets or files of a micro-batch (default: a million offsets, 1 GB of files)")
        s.add_argument("--trigger", default=TRIGGER, help="processing time of the live trigger")
        s.add_argument("--available-now", action="store_true")
        return s

    def database(s: argparse.ArgumentParser) -> None:
        s.add_argument("--jdbc-url")
        s.add_argument("--jdbc-user")
        s.add_argument("--jdbc-password-env", help="name of the variable holding the password")

    s = stream("silver")
    s.add_argument("--state-partitions", type=int, default=None)
    s.add_argument("--publish", metavar="BOOTSTRAP", help="also publish the changelogs to their topics")
    s.add_argument("--enrich-products", help="product table for the enriched events")
    s.add_argument("--enrich-campaigns", help="campaign table for the enriched events")
    s = stream("customers")
    s.add_argument("--buckets", type=int, default=64, help="buckets of a new table")
    s = stream("route")
    s.add_argument("--rules", help="rule table, JSON lines of priority, predicate, topic (default: built in)")
    s.add_argument("--to", metavar="BOOTSTRAP", help="broker of the destination topics (default: a folder)")
    s = stream("fanout")
    s.add_argument("--to", metavar="BOOTSTRAP", help="broker of the message topic (default: a folder)")
    s.add_argument("--to-topic")
    s.add_argument("--jdbc-table")
    database(s)
    g = sub.add_parser("gold")
    g.add_argument("--root", required=True)
    g.add_argument("--campaigns", required=True)
    g.add_argument("--products")
    g.add_argument("--customers", help="customers table of the dimension load, for the header")
    g.add_argument("--prune", action=argparse.BooleanOptionalAction, default=True,
                   help="delete changelog batches that the snapshot before holds, and what is older")
    d = sub.add_parser("dims")
    d.add_argument("--products", help="landed product JSON")
    d.add_argument("--users", help="landed nested user JSON")
    d.add_argument("--campaigns", help="landed campaign JSON")
    d.add_argument("--events", help="decoded events table, for the customers table")
    d.add_argument("--out", required=True)
    d.add_argument("--publish", metavar="BOOTSTRAP", help="also publish the customers' messages")
    d.add_argument("--customers-topic")
    database(d)
    return p


JOBS = {"silver": run_silver, "customers": run_live_customers, "route": run_route, "fanout": run_fan,
        "gold": run_gold, "dims": run_dims}


def main(argv=None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"inboxlens-{args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # dates and times are read and shown in UTC
    JOBS[args.job](spark, args)


if __name__ == "__main__":
    main()
