"""Connector column helpers, typed ingest, and the gold refresh job."""

import json
import os

from pyspark.sql import functions as F

from inboxlens.operators import gold
from inboxlens.operators.decode import encode_events
from inboxlens.schemas import PRODUCT_SCHEMA
from inboxlens.sources import files, kafka
from inboxlens.streaming.landing import land_messages
from tests.helpers import event, events_df, rows


def test_keyed_messages_carry_group_keys_and_batch(spark):
    df = spark.createDataFrame([("a", "X", 3)], "campaign_id string, city string, count long")
    m = kafka.keyed_messages(df, ["campaign_id", "city"], batch_id=7).first()
    assert json.loads(m["key"]) == {"campaign_id": "a", "city": "X"}
    assert json.loads(m["value"]) == {"campaign_id": "a", "city": "X", "count": 3, "batch_id": 7}


def test_id_keyed_messages_and_raw_values(spark):
    df = spark.createDataFrame([(5, "a", None)], "id int, campaign_id string, tags string")
    m = kafka.id_keyed_messages(df, "id").first()
    assert m["key"] == "5" and json.loads(m["value"]) == {"id": 5, "campaign_id": "a"}
    raw = spark.createDataFrame([(b"k", b'{"a":1}', "t", 0, 9)],
                                "key binary, value binary, topic string, partition int, offset long")
    assert tuple(kafka.message_values(raw).first()) == ("k", '{"a":1}', "t", 0, 9)
    opts = kafka.source_options("h:9092", "events", ending="latest")
    assert opts == {"kafka.bootstrap.servers": "h:9092", "subscribe": "events",
                    "startingOffsets": "earliest", "endingOffsets": "latest"}


def test_typed_ingest_enforces_declared_not_null(spark, scratch):
    path = os.path.join(scratch, "products.json")
    with open(path, "w") as fh:
        fh.write('{"id": 1, "title": "t", "category": "c", "price": 2.5}\n')
        fh.write('{"id": 2, "category": "c", "price": 1.0}\n')
    df = files.read_records(spark, path, PRODUCT_SCHEMA)
    valid, rejected = files.enforce_not_null(df, PRODUCT_SCHEMA)
    assert [r["id"] for r in valid.collect()] == [1]
    assert [(r["id"], r["reason"]) for r in rejected.collect()] == [(2, "title")]
    assert files.conform(valid, PRODUCT_SCHEMA).columns == [f.name for f in PRODUCT_SCHEMA.fields]


def test_changelog_topic_sink_builds_keyed_messages(spark, monkeypatch):
    sent = {}

    def fake_write(messages, bootstrap, topic=None):
        sent["rows"] = [tuple(r) for r in messages.collect()]
        sent["topic"] = topic

    monkeypatch.setattr(kafka, "write_topic_batch", fake_write)
    sink = kafka.changelog_topic_sink("h:9092", "events-city-aggregation", ["campaign_id", "city"])
    sink(spark.createDataFrame([("a", "X", 2)], "campaign_id string, city string, count long"), 4)
    assert sent["topic"] == "events-city-aggregation"
    key, value = sent["rows"][0]
    assert json.loads(key) == {"campaign_id": "a", "city": "X"}
    assert json.loads(value)["batch_id"] == 4


def test_job_entry_points_silver_then_gold(spark, scratch):
    from inboxlens import apps
    evs = [event(customer_id=i % 4, campaign_id=f"c{i % 2}", type_event=t, minutes=i, city="X",
                 product_id=(i % 3 if t == "CLICKED" else None))
           for i, t in enumerate(["OPENED", "CLICKED", "SENT"] * 6)]
    ev = events_df(spark, evs)
    path = os.path.join(scratch, "in")
    land_messages(spark, encode_events(ev), slices=2, files_per_slice=1, path=path)
    root = os.path.join(scratch, "app")
    apps.run_silver(spark, apps.parser().parse_args(
        ["silver", "--source", "files", "--path", path, "--root", root, "--available-now",
         "--state-partitions", "2"]))
    dims = os.path.join(scratch, "dims")
    spark.createDataFrame([("c0", "n0"), ("c1", "n1")], "uuid_campaign string, name string") \
        .write.parquet(os.path.join(dims, "campaign"))
    spark.createDataFrame([(p, f"t{p}", "cat", None) for p in range(3)],
                          "id int, title string, category string, image string") \
        .write.parquet(os.path.join(dims, "product"))
    paths = apps.run_gold(spark, apps.parser().parse_args(
        ["gold", "--root", root, "--campaigns", os.path.join(dims, "campaign"),
         "--products", os.path.join(dims, "product")]))
    eff = spark.read.parquet(paths["campaign_effectiveness"]).drop("computed_at")
    campaigns = spark.read.parquet(os.path.join(dims, "campaign"))
    assert rows(eff) == rows(gold.campaign_effectiveness(gold.engagement_rows(ev), campaigns))
    best = spark.read.parquet(paths["best_product"]).first()
    assert best["rank"] == 1


def test_published_changelogs_use_the_declared_topics(spark, scratch, monkeypatch):
    from inboxlens import apps
    sent = []
    monkeypatch.setattr(kafka, "write_topic_batch",
                        lambda messages, bootstrap, topic=None: sent.extend(
                            (topic, r["key"], r["value"]) for r in messages.collect()))
    evs = [event(customer_id=i, campaign_id="c", type_event="OPENED", minutes=i, city="X") for i in range(6)]
    path = os.path.join(scratch, "in")
    land_messages(spark, encode_events(events_df(spark, evs)), slices=2, files_per_slice=1, path=path)
    apps.run_silver(spark, apps.parser().parse_args(
        ["silver", "--source", "files", "--path", path, "--root", os.path.join(scratch, "app"), "--available-now",
         "--state-partitions", "2", "--publish", "broker:9092"]))
    assert {t for t, _, _ in sent} == set(apps.TOPICS.values())
    city = [json.loads(v) for t, _, v in sent if t == "events-city-aggregation"]
    assert max(r["count"] for r in city) == 6
    messages = spark.createDataFrame([(k, v) for t, k, v in sent if t == "events-city-aggregation"],
                                     "key string, value string")
    schema = spark.createDataFrame([], "campaign_id string, city string, count long").schema
    back = kafka.decode_changelog(messages, schema)
    assert back.columns == ["campaign_id", "city", "count", "batch_id"] and back.count() == len(city)


def test_route_and_fanout_jobs_keep_every_message(spark, scratch):
    from inboxlens import apps
    good = encode_events(events_df(spark, [event(customer_id=i, type_event=t, minutes=i) for i, t in enumerate(
        ["OPENED", "SENT", "SPAM", "ODD"])])).select("key", "value")
    bad = spark.createDataFrame([("9", "not json"), ("8", '{"customer_id":1}')], "key string, value string")
    path, root = os.path.join(scratch, "in"), os.path.join(scratch, "app")
    good.unionByName(bad).coalesce(1).write.parquet(path)
    common = ["--source", "files", "--path", path, "--root", root, "--available-now"]
    apps.run_route(spark, apps.parser().parse_args(["route", *common]))
    routed = spark.read.parquet(os.path.join(root, "routed"))
    assert rows(routed, "key", "value") == rows(good.unionByName(bad))
    assert {r["key"]: r["topic"] for r in routed.collect()} == {
        "0": "engagement", "1": "delivery", "2": "error", "3": "unknown", "8": "quarantine", "9": "quarantine"}
    apps.run_fan(spark, apps.parser().parse_args(["fanout", *common]))
    out = {n: spark.read.parquet(os.path.join(root, "fanout", n)) for n in ("events", "topic", "quarantine")}
    assert out["events"].count() + out["quarantine"].count() == 6
    assert rows(out["quarantine"], "key", "value") == rows(bad)
    assert rows(out["topic"], "key", "value") == rows(good)


def test_dimension_load_job(spark, scratch):
    from inboxlens import apps
    src = os.path.join(scratch, "landed")
    os.makedirs(src)

    def land(name, *records):
        with open(os.path.join(src, name), "w") as fh:
            fh.writelines((r if isinstance(r, str) else json.dumps(r)) + "\n" for r in records)
        return os.path.join(src, name)

    ann = {"user_key": 0, "name": {"first": "Ann", "last": "Lee"}, "gender": "f",
           "location": {"country": "UK", "city": "Leeds", "state": "WY", "timezone": {"description": "GMT"}},
           "email_number": 4, "email_domain": "mail"}
    campaign = {"uuid_campaign": "u1", "name": "n", "created_by": "Bob", "tags": ["BTC", "ETH"], "product_id": 7}
    nameless = {"name": {"first": "No", "last": "Key"}}
    unlinked = {"uuid_campaign": "u2", "name": "n", "created_by": "Bob"}
    products = land("products.json", {"id": 1, "title": "a", "category": "c", "price": "12.5"},
                    {"id": 2, "title": "b", "category": "c", "price": "12,5"}, {"id": 3, "title": "c", "category": "c"})
    users, campaigns = land("users.json", ann, nameless, "{broken"), land("campaigns.json", campaign, unlinked, "oops")
    events = os.path.join(scratch, "events")
    events_df(spark, [event(customer_id=0, campaign_id="u1"), event(customer_id=0, campaign_id="u1"),
                      event(customer_id=5, campaign_id="u1")]).withColumn("valid", F.lit(True)).write.parquet(events)
    paths = apps.run_dims(spark, apps.parser().parse_args(
        ["dims", "--products", products, "--users", users, "--campaigns", campaigns, "--events", events,
         "--out", os.path.join(scratch, "dims")]))
    got = {name: spark.read.parquet(p) for name, p in paths.items()}
    assert {r["id"]: r["price"] for r in got["product"].collect()} == {1: 12.5, 2: 0.0}
    rejected = {name: sorted((r["raw"], r["reason"]) for r in df.collect())
                for name, df in got.items() if name.endswith("_quarantine")}
    assert rejected == {
        "product_quarantine": [(json.dumps({"id": 3, "title": "c", "category": "c"}), "price")],
        "users_quarantine": sorted([(json.dumps(nameless), "user_key"), ("{broken", "record")]),
        "campaign_quarantine": [("oops", "record")],
        "campaign_product_interactions_quarantine": [(json.dumps(unlinked), "product_id")]}
    u = got["users"].first()
    assert (u["name_customer"], u["email"]) == ("Ann Lee", "Ann-4@mail.com.co")
    assert {r["uuid_campaign"]: r["tags"] for r in got["campaign"].collect()} == {"u1": "BTC, ETH", "u2": None}
    assert [tuple(r) for r in got["campaign_product_interactions"].collect()] == [(7, "u1", "Bob")]
    assert rows(got["customers"], "id", "campaign_id", "email") == [(0, "u1", "Ann-4@mail.com.co")]
    message = got["customers_messages"].first()
    assert message["key"] == "0" and json.loads(message["value"])["campaign_id"] == "u1"


def test_record_stream_reads_landed_json(spark, scratch):
    src = os.path.join(scratch, "landed")
    os.makedirs(src)
    for i in range(2):
        with open(os.path.join(src, f"part-{i}.json"), "w") as fh:
            fh.write(json.dumps({"id": i, "title": "t", "category": "c", "price": 1.5}) + "\n")
    stream = files.read_record_stream(spark, src, PRODUCT_SCHEMA, max_files_per_trigger=1)
    out = os.path.join(scratch, "out")
    q = (stream.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(scratch, "ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1]
    assert sum(1 for p in q.recentProgress if p["numInputRows"] > 0) == 2


def test_local_path_handles_uris():
    from inboxlens.session import local_path
    assert local_path("/tmp/a") == "/tmp/a"
    assert local_path("file:/tmp/a") == "/tmp/a"
    assert local_path("file:///tmp/a") == "/tmp/a"
    assert local_path("s3a://bucket/a") is None
