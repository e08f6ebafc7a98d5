"""Structured Streaming: late data, changelog compaction, restart, concurrent queries."""

import os

from pyspark.sql import functions as F

import pytest

from inboxlens.operators import gold, silver
from inboxlens.operators.decode import encode_events
from inboxlens.plans.refresh import SILVER, silver_paths
from inboxlens.streaming.changelog import (changelog_sink, latest_per_key, max_per_key, open_epoch, read_changelog,
                                           read_latest, snapshot, totals_per_key)
from inboxlens.streaming.landing import Landing, land_messages
from inboxlens.streaming.pipeline import await_all, event_stream, run_changelog, state_settings
from tests.helpers import event, events_df, rows


def _land_one_row_batches(spark, path, minutes_list):
    for m in minutes_list:
        ev = events_df(spark, [event(minutes=m)])
        encode_events(ev).select("key", "value").coalesce(1).write.mode("append").parquet(path)
    return Landing(path, files_per_trigger=1, slices=len(minutes_list))


def _run(spark, scratch, landing, build, name, mode="update"):
    sink = os.path.join(scratch, name, "log")
    q = run_changelog(build(event_stream(spark, landing)), sink,
                      os.path.join(scratch, name, "ckpt"), f"{name}_{os.path.basename(scratch)}",
                      mode=mode)
    return q, read_changelog(spark, sink)


def test_late_row_dropped_by_watermark_in_windows_only(spark, scratch):
    # 00:00, 01:00, 01:00:02, 00:00:01 -- one row per micro-batch
    landing = _land_one_row_batches(spark, os.path.join(scratch, "in"), [0, 60, 60 + 2 / 60, 1 / 60])
    q, log = _run(spark, scratch, landing, lambda ev: silver.activity_windows(ev, "10 minutes"), "win")
    windows = latest_per_key(log, ["campaign_id", "type_event", "window_start", "window_end"])
    counts = sorted((r["window_start"].hour, r["events"]) for r in windows.collect())
    assert counts == [(0, 1), (1, 2)]  # the 4th row (00:00:01) arrived too late
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress)
    assert dropped == 1
    _, log2 = _run(spark, scratch, landing, silver.campaign_type_counts, "unwindowed")
    assert latest_per_key(log2, ["campaign_id"]).first()["SENT"] == 4  # no time key: all kept


def test_late_row_kept_when_watermark_has_not_advanced_past_it(spark, scratch):
    # 00:00, 01:00, 00:00:01: the third batch is filtered with the watermark known
    # before it, so the row still counts
    landing = _land_one_row_batches(spark, os.path.join(scratch, "in"), [0, 60, 1 / 60])
    q, log = _run(spark, scratch, landing, lambda ev: silver.activity_windows(ev, "10 minutes"), "win3")
    windows = latest_per_key(log, ["campaign_id", "type_event", "window_start", "window_end"])
    counts = sorted((r["window_start"].hour, r["events"]) for r in windows.collect())
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress)
    assert counts == [(0, 2), (1, 1)]
    assert dropped == 0


def test_changelog_must_be_compacted_not_summed(spark):
    log = spark.createDataFrame([("a", "X", 1, 0), ("a", "X", 2, 1), ("a", "X", 3, 2)],
                                "campaign_id string, city string, count long, batch_id int")
    assert latest_per_key(log, ["campaign_id", "city"]).first()["count"] == 3
    assert max_per_key(log, ["campaign_id", "city"], "count").first()["count"] == 3
    assert log.agg(F.sum("count")).first()[0] == 6  # what summing every row would report


def test_replayed_batch_is_idempotent(spark, scratch):
    sink = os.path.join(scratch, "idem")
    write = changelog_sink(sink)
    batch = spark.createDataFrame([("a", 1)], "k string, v long")
    write(batch, 0)
    write(batch, 0)  # replay after a failure
    assert read_changelog(spark, sink).count() == 1


def test_restart_from_checkpoint_equals_batch(spark, scratch):
    evs = [event(customer_id=i % 7, campaign_id=f"c{i % 3}", type_event=t, minutes=i * 30)
           for i, t in enumerate(["OPENED", "CLICKED", "SENT"] * 20)]
    ev = events_df(spark, evs)
    msgs = encode_events(ev)
    path = os.path.join(scratch, "in")
    first, second = msgs.filter(F.col("event_date") < "2024-01-01 15:00:00"), \
        msgs.filter(F.col("event_date") >= "2024-01-01 15:00:00")
    land_messages(spark, first, slices=2, files_per_slice=1, path=path)
    build = silver.engagement_counts
    sink, ckpt = os.path.join(scratch, "log"), os.path.join(scratch, "ckpt")
    run_changelog(build(event_stream(spark, Landing(path, 1, 2))), sink, ckpt, "restart_a")
    land_messages(spark, second, slices=2, files_per_slice=1, path=path)
    run_changelog(build(event_stream(spark, Landing(path, 1, 2))), sink, ckpt, "restart_b")
    log = read_changelog(spark, sink)
    assert log.select("batch_id").distinct().count() >= 4  # 2 runs, several micro-batches
    got = max_per_key(log, ["campaign_id", "customer_id", "type_event"], "total_events")
    assert rows(got) == rows(silver.engagement_counts(ev))


def _start_silver(spark, landing, root, **live):
    events = event_stream(spark, landing)
    return [run_changelog(build(events), *silver_paths(root, name)[:2], f"silver_{name}_{os.path.basename(root)}",
                          wait=False, settings=state_settings(spark, 2), **live) for name, (build, _) in SILVER.items()]


def test_concurrent_silver_queries(spark, scratch):
    evs = [event(customer_id=i % 5, campaign_id=f"c{i % 2}", type_event=t, minutes=i, city=f"X{i % 3}")
           for i, t in enumerate(["OPENED", "CLICKED", "DELIVERED_EVENT", "SENT", "SPAM"] * 8)]
    ev = events_df(spark, evs)
    landing = land_messages(spark, encode_events(ev), slices=3, files_per_slice=1,
                            path=os.path.join(scratch, "in"))
    await_all(_start_silver(spark, landing, scratch))
    logs = {name: read_changelog(spark, silver_paths(scratch, name)[0]) for name in SILVER}
    totals = {name: totals_per_key(logs[name], keys) for name, (_, keys) in SILVER.items()}
    for name, (build, _) in SILVER.items():
        want = build(ev)
        assert rows(totals[name], *want.columns) == rows(want), name
    # gold reads the compacted silver table with the same plan as the batch path
    assert rows(gold.effectiveness(totals["engagement"])) == rows(gold.effectiveness(gold.engagement_rows(ev)))


def test_any_failing_query_ends_the_job(spark, scratch):
    landing = _land_one_row_batches(spark, os.path.join(scratch, "in"), [0, 60])
    events = event_stream(spark, landing)

    def broken(batch, batch_id):
        raise ValueError("sink is gone")

    def start(name, publish=None):
        base = os.path.join(scratch, name)
        return run_changelog(silver.campaign_type_counts(events), os.path.join(base, "log"),
                             os.path.join(base, "ckpt"), f"{name}_{os.path.basename(scratch)}", available_now=False,
                             wait=False, settings=state_settings(spark, 2), publish=publish)

    queries = [start("first"), start("second", broken), start("third")]
    with pytest.raises(RuntimeError, match="second"):
        await_all(queries)
    assert not any(q.isActive for q in queries)


def test_stream_settings_apply_to_the_query_only(spark, scratch):
    from inboxlens.streaming.pipeline import state_settings
    evs = [event(customer_id=i, type_event="OPENED", minutes=i) for i in range(6)]
    landing = land_messages(spark, encode_events(events_df(spark, evs)), slices=2, files_per_slice=1,
                            path=os.path.join(scratch, "in"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    q = run_changelog(silver.engagement_counts(event_stream(spark, landing)),
                      os.path.join(scratch, "log"), os.path.join(scratch, "ckpt"), "settings_q",
                      settings=state_settings(spark, state_partitions=3))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    state_ops = q.lastProgress["stateOperators"]
    assert state_ops and state_ops[0]["numShufflePartitions"] == 3


def test_stream_sessions_append_mode_match_batch_sessions(spark, scratch):
    from inboxlens.operators.sessions import sessions
    minutes = [0, 30, 13 * 60, 13 * 60 + 5, 40 * 60]
    evs = [event(customer_id=1, minutes=m) for m in minutes] + [event(customer_id=2, minutes=5)]
    # a late-enough event of another customer moves the watermark past every session
    flush = [event(customer_id=99, minutes=200 * 60)]
    path = os.path.join(scratch, "in")
    for batch in (evs, flush):
        encode_events(events_df(spark, batch)).select("key", "value").coalesce(1) \
            .write.mode("append").parquet(path)
    landing = Landing(path, files_per_trigger=1, slices=2)
    _, log = _run(spark, scratch, landing, lambda ev: silver.session_counts(ev, "12 hours"),
                  "sess", mode="append")
    got = rows(log.filter(F.col("customer_id") != 99).drop("batch_id"))
    expected = rows(sessions(events_df(spark, evs), "12 hours"))
    assert got == expected


def test_live_trigger_processes_new_files(spark, scratch):
    evs = [event(customer_id=i % 3, campaign_id="c", type_event=t, minutes=i, city="X")
           for i, t in enumerate(["OPENED", "CLICKED", "SENT"] * 4)]
    path = os.path.join(scratch, "in")
    land_messages(spark, encode_events(events_df(spark, evs)), slices=1, files_per_slice=1, path=path)
    live = _start_silver(spark, Landing(path, 0, 1), scratch, available_now=False, trigger="500 milliseconds")
    try:
        for q in live:
            q.processAllAvailable()
    finally:
        for q in live:
            q.stop()
    city = totals_per_key(read_changelog(spark, silver_paths(scratch, "city")[0]), ["campaign_id", "city"])
    assert rows(city, "campaign_id", "city", "count") == [("c", "X", 12)]


SCHEMA = "campaign_id string, city string, count long"
KEYS = ["campaign_id", "city"]


def _commit(scratch, ckpt, n):
    os.makedirs(os.path.join(ckpt, "commits"), exist_ok=True)
    with open(os.path.join(ckpt, "commits", str(n)), "w") as fh:
        fh.write("v1")


def test_snapshots_bound_changelog_reads(spark, scratch):
    log, snaps, ckpt = (os.path.join(scratch, n) for n in ("log", "snaps", "ckpt"))
    write = changelog_sink(log, epoch=open_epoch(spark, log, ckpt))

    def put(n, *values):
        write(spark.createDataFrame(list(values), SCHEMA), n)
        _commit(scratch, ckpt, n)

    put(0, ("a", "X", 1), ("b", "Y", 5))
    put(1, ("a", "X", 2))
    assert snapshot(spark, log, KEYS, snaps, ckpt) == 1
    put(2, ("a", "X", 3), ("c", "Z", 1))
    assert rows(read_latest(spark, log, KEYS, snaps), *KEYS, "count") == [("a", "X", 3), ("b", "Y", 5), ("c", "Z", 1)]
    assert snapshot(spark, log, KEYS, snaps, ckpt, prune=True) == 2
    put(3, ("b", "Y", 6))
    assert rows(read_latest(spark, log, KEYS, snaps), *KEYS, "count") == [("a", "X", 3), ("b", "Y", 6), ("c", "Z", 1)]
    # what the snapshot before held is gone, the rest is there
    assert sorted(r[0] for r in read_changelog(spark, log).select("batch_id").distinct().collect()) == [2, 3]
    # the reader only touches batches after the newest snapshot
    plan = read_changelog(spark, log).filter(F.col("batch_id") > 2)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan


def test_a_batch_in_flight_is_not_lost_to_a_snapshot(spark, scratch):
    log, snaps, ckpt = (os.path.join(scratch, n) for n in ("log", "snaps", "ckpt"))
    write = changelog_sink(log, epoch=open_epoch(spark, log, ckpt))
    write(spark.createDataFrame([("a", "X", 1)], SCHEMA), 0)
    _commit(scratch, ckpt, 0)
    write(spark.createDataFrame([("b", "Y", 1)], SCHEMA), 1)  # part of batch 1; not committed
    assert snapshot(spark, log, KEYS, snaps, ckpt) == 0
    write(spark.createDataFrame([("b", "Y", 1), ("a", "X", 5)], SCHEMA), 1)  # the batch is written again, whole
    _commit(scratch, ckpt, 1)
    assert rows(read_latest(spark, log, KEYS, snaps), *KEYS, "count") == [("a", "X", 5), ("b", "Y", 1)]
    assert snapshot(spark, log, KEYS, snaps, ckpt) == 1
    assert rows(read_latest(spark, log, KEYS, snaps), *KEYS, "count") == [("a", "X", 5), ("b", "Y", 1)]


def test_a_new_checkpoint_begins_a_new_epoch(spark, scratch):
    log, snaps = os.path.join(scratch, "log"), os.path.join(scratch, "snaps")
    old, new = os.path.join(scratch, "old"), os.path.join(scratch, "new")
    first = open_epoch(spark, log, old)
    write = changelog_sink(log, epoch=first)
    for n, total in enumerate([1, 2, 3]):
        write(spark.createDataFrame([("a", "X", total)], SCHEMA), n)
        _commit(scratch, old, n)
    assert snapshot(spark, log, KEYS, snaps, old) == 2
    assert open_epoch(spark, log, old) == first  # a restart stays in its epoch
    second = open_epoch(spark, log, new)
    assert second > first
    changelog_sink(log, epoch=second)(spark.createDataFrame([("a", "X", 9)], SCHEMA), 0)
    _commit(scratch, new, 0)
    for _ in range(2):
        assert rows(read_latest(spark, log, KEYS, snaps), *KEYS, "count") == [("a", "X", 9)]
        assert snapshot(spark, log, KEYS, snaps, new) == 0


def test_compaction_of_totals_is_a_hash_aggregate(spark, scratch):
    log = os.path.join(scratch, "log")
    changelog_sink(log, epoch=1)(spark.createDataFrame([("a", "X", 1)], SCHEMA), 0)
    plan = totals_per_key(read_changelog(spark, log), KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_a_product_added_while_the_stream_runs_is_found(spark, scratch):
    from inboxlens.streaming.pipeline import read_batches, run_enriched
    path, dims = os.path.join(scratch, "in"), os.path.join(scratch, "dims")
    product = "id int, title string, category string, price float"
    spark.createDataFrame([("c1", "n")], "uuid_campaign string, name string").write.parquet(f"{dims}/campaign")
    spark.createDataFrame([(1, "one", "c", 1.0)], product).write.parquet(f"{dims}/product")

    def land(product_id, minutes):
        ev = events_df(spark, [event(campaign_id="c1", type_event="CLICKED", product_id=product_id, minutes=minutes)])
        encode_events(ev).select("key", "value").coalesce(1).write.mode("append").parquet(path)

    land(1, 0)
    q = run_enriched(event_stream(spark, Landing(path, 1, 1)), f"{scratch}/out", f"{scratch}/ckpt",
                     f"enriched_{os.path.basename(scratch)}", lambda: spark.read.parquet(f"{dims}/product"),
                     lambda: spark.read.parquet(f"{dims}/campaign"), available_now=False, wait=False,
                     trigger="500 milliseconds", settings=state_settings(spark, 2))
    try:
        q.processAllAvailable()
        spark.createDataFrame([(2, "two", "c", 2.0)], product).write.mode("append").parquet(f"{dims}/product")
        land(2, 1)
        q.processAllAvailable()
    finally:
        q.stop()
    got = read_batches(spark, f"{scratch}/out")
    assert rows(got, "product_id", "product_title") == [(1, "one"), (2, "two")]


def test_stream_reach_sketch_matches_exact_counts_on_small_data(spark, scratch):
    from inboxlens.operators import gold
    evs = [event(customer_id=i % 37, campaign_id=f"c{i % 3}", type_event=t, minutes=i)
           for i, t in enumerate(["OPENED", "CLICKED", "OPENED", "SENT"] * 30)]
    ev = events_df(spark, evs)
    landing = land_messages(spark, encode_events(ev), slices=3, files_per_slice=1,
                            path=os.path.join(scratch, "in"))
    _, log = _run(spark, scratch, landing, silver.campaign_reach, "reach")
    got = latest_per_key(log, ["campaign_id"])
    exact = gold.user_ctr(ev).select("campaign_id", "clickers", "openers")
    assert rows(got, "campaign_id", "clickers", "openers") == rows(exact)
