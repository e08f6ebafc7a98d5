"""Customers kept from a stream, late rows, reach sketches and bookmarked reads."""

import json
import os

import pytest
from pyspark.sql import functions as F

from inboxlens import apps
from inboxlens.functions.contract import product_rule, violations
from inboxlens.operators import gold, silver
from inboxlens.operators.decode import encode_events
from inboxlens.sources.bookmarks import bookmark, folder_topic, take
from inboxlens.streaming import customers, late, reach
from inboxlens.streaming.landing import Landing
from inboxlens.streaming.pipeline import event_stream, folder_sink
from tests.helpers import event, events_df, rows


def record(id_, campaign="a", name="n", offset=0, **more):
    value = {"id": id_, "campaign_id": campaign, "name_customer": name, **more}
    return (str(id_), json.dumps({k: v for k, v in value.items() if v is not None}), 0, offset)


def records_df(spark, *records):
    return spark.createDataFrame(list(records), customers.RECORD_SCHEMA)


def held(spark, path, version=None):
    return rows(customers.read_customers(spark, path, version), "id", "campaign_id", "name_customer")


# --- customers ---------------------------------------------------------------

def test_customers_upsert_by_offset(spark, scratch):
    write = customers.customers_sink(scratch, epoch=1, buckets=4)
    write(records_df(spark, record(1, name="x", offset=1), record(1, name="y", offset=2),
                     record(2, name="z", offset=3)), 0)
    assert held(spark, scratch) == [(1, "a", "y"), (2, "a", "z")]
    # an older message that comes again changes nothing, another campaign is another row
    write(records_df(spark, record(1, name="x", offset=1), record(2, name="w", offset=5),
                     record(2, "b", name="v", offset=4)), 1)
    assert held(spark, scratch) == [(1, "a", "y"), (2, "a", "w"), (2, "b", "v")]


def test_customers_only_touched_buckets_are_written(spark, scratch):
    write = customers.customers_sink(scratch, epoch=1, buckets=16, keep=5)
    write(records_df(spark, *[record(i, offset=i) for i in range(100)]), 0)
    write(records_df(spark, record(7, name="new", offset=200)), 1)
    assert len([d for d in os.listdir(f"{scratch}/data/epoch=1/batch_id=0") if d.startswith("bucket=")]) == 16
    assert len([d for d in os.listdir(f"{scratch}/data/epoch=1/batch_id=1") if d.startswith("bucket=")]) == 1
    assert len(held(spark, scratch)) == 100
    assert (7, "a", "new") in held(spark, scratch)
    # the version before is as it was
    assert (7, "a", "n") in held(spark, scratch, (1, 0))


def test_customers_replay_after_a_failure_before_publishing(spark, scratch, monkeypatch):
    write = customers.customers_sink(scratch, epoch=1, buckets=2)
    write(records_df(spark, record(1, name="x", offset=1)), 0)
    second = records_df(spark, record(1, name="y", offset=2), record(3, name="z", offset=3))
    with monkeypatch.context() as m:
        def fails(*a, **k):
            raise RuntimeError("lost")
        m.setattr(spark, "createDataFrame", fails)
        with pytest.raises(RuntimeError, match="lost"):
            write(second, 1)
    assert held(spark, scratch) == [(1, "a", "x")]  # data written, not published
    write(second, 1)
    once = held(spark, scratch)
    write(second, 1)
    assert held(spark, scratch) == once == [(1, "a", "y"), (3, "a", "z")]


def test_customers_new_checkpoint_reads_the_topic_again(spark, scratch):
    customers.customers_sink(scratch, epoch=1, buckets=2)(records_df(spark, record(1, name="new", offset=9)), 0)
    write = customers.customers_sink(scratch, epoch=2, buckets=8)  # the table keeps its buckets
    write(records_df(spark, record(1, name="old", offset=1), record(2, offset=2)), 0)
    assert held(spark, scratch) == [(1, "a", "new"), (2, "a", "n")]
    assert {at[2] for at in customers._manifest(spark, scratch, (2, 0)).values()} == {2}


def test_customers_prune_keeps_what_the_last_versions_name(spark, scratch):
    write = customers.customers_sink(scratch, epoch=1, buckets=4, keep=2)
    write(records_df(spark, *[record(i, offset=i) for i in range(40)]), 0)
    for n in range(1, 5):
        write(records_df(spark, record(1, name=f"v{n}", offset=100 + n)), n)
    assert customers.versions(spark, scratch) == [(1, 3), (1, 4)]
    assert len(held(spark, scratch)) == 40
    assert len(held(spark, scratch, (1, 3))) == 40
    assert not os.path.exists(f"{scratch}/data/epoch=1/batch_id=2/bucket=" + str(_bucket_of(spark, 1)))


def _bucket_of(spark, id_):
    df = spark.createDataFrame([("a", id_)], "campaign_id string, id long")
    return df.select(customers.bucket(4)).first()[0]


def test_customers_rejected_records_are_kept_whole(spark, scratch):
    write = customers.customers_sink(f"{scratch}/t", 1, 2, quarantine=folder_sink(f"{scratch}/q", 1))
    bad = ("9", "no json", 0, 1)
    write(records_df(spark, bad, record(1, None, offset=2), record(2, name=None, offset=3),
                     ("5", None, 0, 4), record(3, offset=5)), 0)
    assert held(spark, f"{scratch}/t") == [(3, "a", "n")]
    q = spark.read.parquet(f"{scratch}/q/epoch=1/batch_id=0")
    assert sorted(r["reason"] for r in q.collect()) == [
        "campaign_id", "id,campaign_id,name_customer", "name_customer", "record"]
    assert "no json" in [r["raw"] for r in q.collect()]


def test_customers_empty_batch_and_empty_table(spark, scratch):
    assert held(spark, scratch) == []
    customers.customers_sink(scratch, epoch=1)(records_df(spark), 0)
    assert held(spark, scratch) == []


def test_customers_hot_key(spark, scratch):
    batch = spark.range(3000).select(
        F.lit("1").alias("key"),
        F.to_json(F.struct(F.lit(1).alias("id"), F.lit("a").alias("campaign_id"),
                           F.concat(F.lit("v"), F.col("id")).alias("name_customer"))).alias("value"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"))
    customers.customers_sink(scratch, epoch=1, buckets=4)(batch, 0)
    assert held(spark, scratch) == [(1, "a", "v2999")]


def test_customers_job(spark, scratch):
    records_df(spark, record(1, name="x", offset=1), record(1, name="y", offset=2)).write.parquet(f"{scratch}/in")
    args = apps.parser().parse_args(["customers", "--source", "files", "--path", f"{scratch}/in", "--root", scratch,
                                     "--buckets", "2", "--available-now"])
    apps.JOBS["customers"](spark, args)
    assert held(spark, f"{scratch}/customers/table") == [(1, "a", "y")]


# --- late rows ---------------------------------------------------------------

def _land(spark, path, *batches):
    for minutes in batches:
        ev = events_df(spark, [event(minutes=m) for m in minutes])
        encode_events(ev).select("key", "value").coalesce(1).write.mode("append").parquet(path)
    return Landing(path, files_per_trigger=1, slices=len(batches))


def test_input_is_windows_and_late(spark, scratch):
    landing = _land(spark, f"{scratch}/in", [0, 5], [60], [61, 1], [62, 55])
    late.run_windows(event_stream(spark, landing, watermark=None), f"{scratch}/a", f"{scratch}/c", "late_a",
                     duration="10 minutes")
    counts = {r["window_start"].minute + 60 * r["window_start"].hour: r["events"]
              for r in late.read_windows(spark, f"{scratch}/a").collect()}
    # minute 1 comes after its window [0, 10) has ended, 55 after [50, 60) has (61 - 1 = 60)
    assert counts == {0: 2, 60: 3}
    behind = late.read_late(spark, f"{scratch}/a")
    assert sorted((r["event_date"].minute, r["batch_id"]) for r in behind.collect()) == [(1, 2), (55, 3)]


def test_late_rows_equal_those_the_watermark_drops(spark, scratch):
    """The same rows reach the windows as with Spark's own watermark in one-row batches."""
    landing = _land(spark, f"{scratch}/in", [0], [60], [60 + 2 / 60], [1 / 60], [58], [61])
    late.run_windows(event_stream(spark, landing, watermark=None), f"{scratch}/a", f"{scratch}/c", "late_b",
                     duration="10 minutes")
    assert sum(r["events"] for r in late.read_windows(spark, f"{scratch}/a").collect()) == 5
    assert late.read_late(spark, f"{scratch}/a").count() == 1


def test_late_replay_and_restart(spark, scratch):
    write = late.windows_and_late(scratch, 1, "10 minutes")
    first, second = ([event(minutes=60)], [event(minutes=0), event(minutes=61)])
    write(events_df(spark, first), 0)
    write(events_df(spark, second), 1)
    write(events_df(spark, second), 1)  # handed over again
    assert sum(r["events"] for r in late.read_windows(spark, scratch).collect()) == 2
    assert late.read_late(spark, scratch).count() == 1
    write(events_df(spark, []), 2)  # an empty batch leaves the watermark
    write(events_df(spark, [event(minutes=5)]), 3)
    assert late.read_late(spark, scratch).count() == 2


# --- reach -------------------------------------------------------------------

def _reach_events():
    clicks = [event(c, "a", "CLICKED") for c in range(300)] + [event(c, "b", "CLICKED") for c in range(150, 450)]
    return clicks + [event(c, "a", "OPENED") for c in range(500)] + [event(None, "a", "OPENED"), event(1, "c", "SENT")]


def test_reach_merges_over_batches_and_campaigns(spark, scratch):
    all_ = _reach_events()
    keep = folder_sink(scratch, 1)
    for n in range(3):  # the parts share customers
        keep(reach.reach_sketches(events_df(spark, all_[n * 200:n * 200 + 800])), n)
    sketches = reach.read_sketches(spark, scratch)
    exact = {r["campaign_id"]: (r["clickers"], r["openers"])
             for r in gold.user_ctr(events_df(spark, all_)).collect()}
    for r in reach.reach(sketches).collect():
        for got, want in zip((r["clickers"], r["openers"]), exact[r["campaign_id"]], strict=True):
            assert abs(got - want) <= 1 + 3 * reach.STATED_ERROR * want
    whole = reach.reach(sketches, ()).first()
    assert abs(whole["clickers"] - 450) <= 1 + 3 * reach.STATED_ERROR * 450  # 600 if they were added up


def test_reach_replay_counts_no_one_twice(spark, scratch):
    sketches = reach.reach_sketches(events_df(spark, _reach_events()))
    once, twice = (rows(reach.reach(s)) for s in (sketches, sketches.unionByName(sketches)))
    assert once == twice
    assert rows(reach.reach(reach.united(sketches))) == once  # compacted


def test_reach_of_many_customers_is_within_the_stated_error(spark):
    n = 200_000
    ev = spark.range(n).select(F.col("id").alias("customer_id"), F.lit("a").alias("campaign_id"),
                               F.lit("CLICKED").alias("type_event"))
    got = reach.reach(reach.reach_sketches(ev)).first()
    assert abs(got["clickers"] - n) <= 3 * reach.STATED_ERROR * n
    assert got["openers"] == 0
    size = reach.reach_sketches(ev).select(F.length("people")).first()[0]
    assert size < 2 ** (reach.LG_K + 1)  # fixed, whatever the customers


def test_reach_of_nothing(spark):
    assert reach.reach(reach.reach_sketches(events_df(spark, []))).collect() == []


# --- bookmarks ---------------------------------------------------------------

def _topic(spark, path, *messages):
    spark.createDataFrame(list(messages), "key string, value string, partition int, offset long") \
        .write.mode("append").parquet(path)


def test_successive_reads_cover_each_message_once(spark, scratch):
    topic, notes = folder_topic(f"{scratch}/t"), f"{scratch}/b"
    _topic(spark, f"{scratch}/t", ("a", "1", 0, 0), ("b", "2", 1, 5))
    first, done = take(spark, topic, notes)
    _topic(spark, f"{scratch}/t", ("c", "3", 0, 1))  # lands after the end was fixed
    assert rows(first, "value") == [("1",), ("2",)]
    done()
    assert bookmark(spark, notes) == (0, {0: 1, 1: 6})
    _topic(spark, f"{scratch}/t", ("d", "4", 2, 0))  # a new partition
    second, done = take(spark, topic, notes)
    assert rows(second, "value") == [("3",), ("4",)]
    done()
    third, _ = take(spark, topic, notes)
    assert third.count() == 0


def test_a_read_that_fails_is_repeated(spark, scratch):
    topic, notes = folder_topic(f"{scratch}/t"), f"{scratch}/b"
    _topic(spark, f"{scratch}/t", ("a", "1", 0, 0))
    take(spark, topic, notes)  # never told that it is done
    again, done = take(spark, topic, notes)
    assert rows(again, "value") == [("1",)]
    done()
    assert take(spark, topic, notes)[0].count() == 0


# --- sessions and the product rule -------------------------------------------

def test_sessions_exactly_a_gap_apart_are_one(spark):
    ev = events_df(spark, [event(minutes=0), event(minutes=10), event(minutes=21)])
    got = silver.session_counts(ev, "10 minutes").orderBy("session_start").collect()
    assert [r["events"] for r in got] == [2, 1]


def test_product_only_on_clicks(spark):
    ev = events_df(spark, [event(type_event="CLICKED", product_id=1), event(type_event="SENT", product_id=1),
                           event(type_event="SENT"), event(type_event=None, product_id=1)])
    got = [r[0] for r in ev.select(violations(rules={"product_id": product_rule()})).collect()]
    assert got == [[], ["product_id"], [], ["type_event"]]
