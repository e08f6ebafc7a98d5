"""Whole pipeline as a user runs it: landed topic -> silver job -> gold job,
checked table by table against the batch queries over the same tables."""

import os
import re
import threading
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from inboxlens import apps
from inboxlens.operators import decode
from inboxlens.operators import dims as dims_ops
from inboxlens.operators import gold as gold_ops
from inboxlens.operators import silver as silver_ops
from inboxlens.plans import catalog, oracle
from inboxlens.plans.refresh import SILVER, gold_versions, read_gold, silver_paths
from inboxlens.session import fresh_dir
from inboxlens.sources import fixture
from inboxlens.streaming.changelog import read_changelog, totals_per_key
from inboxlens.streaming.pipeline import read_batches
from inboxlens.streaming.landing import landed_events
from tests.conftest import SF_SMALL
from tests.helpers import rows
from tools.oracle_check import canon


def test_silver_then_gold_equals_batch_queries(spark, scratch):
    landing = landed_events(spark, SF_SMALL, corrupt=True)
    root, dims = os.path.join(scratch, "app"), os.path.join(scratch, "dims")
    fixture.campaigns(spark, SF_SMALL).write.parquet(os.path.join(dims, "campaign"))
    fixture.products(spark, SF_SMALL).write.parquet(os.path.join(dims, "product"))
    silver = ["silver", "--source", "files", "--path", landing.path, "--root", root, "--state-partitions", "4",
              "--max-per-trigger", str(2 * landing.files_per_trigger), "--available-now",
              "--enrich-products", os.path.join(dims, "product"), "--enrich-campaigns", os.path.join(dims, "campaign")]
    apps.run_silver(spark, apps.parser().parse_args(silver))
    # the decoded table holds every message once: valid + quarantine, payload included
    table = spark.read.parquet(os.path.join(root, "silver", "events"))
    assert table.count() == fixture.table(spark, SF_SMALL, "events").count()
    rejected = table.filter(~F.col("valid")).select("key", F.col("value").cast("string").alias("value"), "reason")
    assert rows(rejected) == rows(catalog.BATCH_QUERIES["events_quarantine"](spark, SF_SMALL))
    # the batch side: the same queries over the valid events
    decoded = decode.valid_events(decode.decode_events(fixture.event_messages(spark, SF_SMALL, corrupt=True)))
    ev = decoded.persist()
    users = dims_ops.flatten_users(fixture.user_records(spark, SF_SMALL))
    customers = dims_ops.customers_table(ev, users)
    customers.write.parquet(os.path.join(dims, "customers"))
    args = apps.parser().parse_args(
        ["gold", "--root", root, "--campaigns", os.path.join(dims, "campaign"), "--products",
         os.path.join(dims, "product"), "--customers", os.path.join(dims, "customers"), "--prune"])
    campaigns, products = fixture.campaigns(spark, SF_SMALL), fixture.products(spark, SF_SMALL)
    eff = gold_ops.campaign_effectiveness(gold_ops.engagement_rows(ev), campaigns)
    ranking = gold_ops.product_ranking(silver_ops.product_counts(ev), products)
    expected = {
        "campaign_effectiveness": eff, "click_share": gold_ops.click_share(eff), "city_top10": gold_ops.city_top(ev),
        "product_popularity": ranking, "best_product": gold_ops.best_product(ranking),
        "repeat_engagement": gold_ops.repeat_engagement(silver_ops.engagement_counts(ev)),
        "campaign_types": silver_ops.campaign_type_counts(ev), "user_ctr": gold_ops.user_ctr(ev),
        "funnel": gold_ops.funnel(ev), "deliverability": gold_ops.deliverability(ev),
        "client_mix": silver_ops.client_mix(ev), "header": gold_ops.header_counts(ev, customers)}
    for _ in range(2):  # the second refresh reads the snapshots of the first
        paths = apps.run_gold(spark, args)
        assert set(paths) == set(expected)
        for name, want in expected.items():
            got = spark.read.parquet(paths[name]).drop("computed_at")
            assert rows(got, *want.columns) == rows(want), name
    held = read_gold(spark, root)
    assert set(held) == set(expected) and len(gold_versions(spark, root)) == 2
    enriched = read_batches(spark, os.path.join(root, "silver", "enriched", "events"))
    want = silver_ops.enrich_events(ev, products, campaigns)
    assert rows(enriched, *want.columns) == rows(want)
    ev.unpersist()


def test_decode_once_table_holds_the_quarantine(spark, scratch):
    from inboxlens.streaming.pipeline import message_stream, run_decode
    landing = landed_events(spark, SF_SMALL, corrupt=True)
    table = os.path.join(scratch, "events")
    run_decode(message_stream(spark, landing), table, os.path.join(scratch, "ckpt"), "decode_q")
    rejected = spark.read.parquet(table).filter(~F.col("valid")).select(
        "key", F.col("value").cast("string").alias("value"), "reason")
    assert rows(rejected) == rows(catalog.BATCH_QUERIES["events_quarantine"](spark, SF_SMALL))
    one_day = spark.read.parquet(table).filter(F.col("event_day") == F.lit("2024-01-02").cast("date"))
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_day", plan)  # day pruning, not a scan filter


def test_live_mode_until_stopped(spark, scratch):
    landing = landed_events(spark, SF_SMALL)
    root = os.path.join(scratch, "live")
    args = apps.parser().parse_args(
        ["silver", "--source", "files", "--path", landing.path, "--root", root, "--trigger", "1 second",
         "--state-partitions", "2"])
    worker = threading.Thread(target=apps.run_silver, args=(spark, args), daemon=True)
    worker.start()

    def running():
        return [q for q in spark.streams.active if q.name.startswith("silver_")]

    try:
        deadline = time.time() + 240
        while len(running()) < 1 + len(SILVER):
            assert time.time() < deadline
            time.sleep(1)
        [q for q in running() if q.name == "silver_decode"][0].processAllAvailable()
        for q in running():
            q.processAllAvailable()
    finally:
        for q in running():
            q.stop()
        worker.join(timeout=60)
    city = totals_per_key(read_changelog(spark, silver_paths(root, "city")[0]), ["campaign_id", "city"])
    expected = catalog.BATCH_QUERIES["events_by_campaign_city"](spark, SF_SMALL)
    assert rows(city, *expected.columns) == rows(expected)


ZONE_QUERIES = ["activity_tumbling", "activity_sliding", "customer_sessions", "json_roundtrip_events",
                "events_quarantine", "enriched_events", "stream_activity"]


@pytest.fixture(scope="module")
def changing_days(spark):
    """The events moved so that they lie around both daylight-saving changes of 2024."""
    out = fresh_dir(spark, "zones")
    for t in ("customer", "nation", "region", "supplier", "part"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(f"{out}/{t}.parquet")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    moved = F.expr("if(event_id % 2 = 0, TIMESTAMP_NTZ'2024-03-09 20:00:00', TIMESTAMP_NTZ'2024-11-02 20:00:00')"
                   " + make_dt_interval(0, 0, event_id * 13 % 1440, 0)")
    ev.withColumn("ts", moved).write.parquet(f"{out}/events.parquet")
    con = duckdb.connect()
    for t in ("customer", "nation", "region", "supplier", "part", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{out}/{t}.parquet/*.parquet')")
    return out, con


@pytest.mark.parametrize("name", ZONE_QUERIES)
def test_results_do_not_depend_on_the_session_zone(spark, changing_days, name):
    out, con = changing_days
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = catalog.queries()[name](spark, out)
        got = canon(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    res = con.execute(oracle.oracle_sql()[name])
    assert got == canon([d[0] for d in res.description], res.fetchall())
