"""Sinks whose batch comes again or whose checkpoint is new, and gold that breaks half-way."""

import os

import pytest
from pyspark.sql import functions as F

from inboxlens import apps
from inboxlens.operators.decode import encode_events
from inboxlens.plans import refresh
from inboxlens.sources import files, kafka
from inboxlens.streaming import changelog
from inboxlens.streaming.changelog import changelog_sink, open_epoch, read_latest, snapshot
from inboxlens.streaming.landing import Landing
from inboxlens.streaming.ledger import Target, once_sink
from inboxlens.streaming.pipeline import folder_sink, message_stream, read_batches, run_fanout
from tests.helpers import event, events_df, rows

PAIR = "key string, value long"


def failing(target, when, times=1):
    """``target`` whose append fails ``times`` times: before, amid or after the write."""
    left = [times]

    def append(df):
        if not left[0]:
            return target.append(df)
        left[0] -= 1
        if when == "amid":
            target.append(df.where(F.col("value").cast("string").endswith("1") | (F.length("key") == 1)))
        elif when == "after":
            target.append(df)
        raise OSError("lost")

    return Target(append, target.held)


@pytest.mark.parametrize("when", ["before", "amid", "after"])
@pytest.mark.parametrize("times", [1, 2])
def test_a_replayed_batch_is_appended_once(spark, scratch, when, times):
    target = failing(files.append_target(f"{scratch}/table"), when, times)
    # equal rows are rows of their own, nulls too
    batch = spark.createDataFrame([("a", 1), ("a", 1), ("bb", 1), ("bb", 2), (None, None), (None, None)], PAIR)
    write = once_sink(target, f"{scratch}/ledger", 7)
    for _ in range(times):
        with pytest.raises(OSError):
            write(batch, 0)
    for _ in range(3):  # the last ones come after the batch is noted as applied
        write(batch, 0)
    write(batch, 1)
    got = spark.read.parquet(f"{scratch}/table")
    for n in (0, 1):
        assert rows(got.where(F.col("batch_id") == n), "key", "value") == rows(batch)
    assert got.select("epoch").distinct().collect() == [(7,)]


def test_the_target_is_read_after_a_failure_only(spark, scratch):
    asked = []
    inner = files.append_target(f"{scratch}/table")
    target = failing(Target(inner.append, lambda *a: asked.append(a) or inner.held(*a)), "after")
    write = once_sink(target, f"{scratch}/ledger", 1)
    batch = spark.createDataFrame([("a", 1)], PAIR)
    with pytest.raises(OSError):
        write(batch, 0)
    assert asked == []
    write(batch, 0)
    write(batch, 1)
    assert [a[1:3] for a in asked] == [(1, 0)] and asked[0][3] > 0


def test_a_stream_that_fails_after_the_write_and_starts_again(spark, scratch):
    path = f"{scratch}/in"
    for n in range(3):
        ev = events_df(spark, [event(customer_id=n, minutes=n), event(customer_id=n, minutes=n)])
        encode_events(ev).select("key", "value").coalesce(1).write.mode("append").parquet(path)
    epoch = open_epoch(spark, f"{scratch}/copy", f"{scratch}/ckpt")
    topic = once_sink(failing(files.append_target(f"{scratch}/topic"), "after"), f"{scratch}/ledger", epoch)

    def run():
        run_fanout(spark, message_stream(spark, Landing(path, 1, 3)), f"{scratch}/ckpt",
                   [folder_sink(f"{scratch}/copy", epoch)], [topic], [])

    with pytest.raises(Exception, match="lost"):
        run()
    run()
    want = [(str(n),) for n in range(3) for _ in range(2)]
    assert rows(spark.read.parquet(f"{scratch}/topic"), "key") == sorted(want)
    assert read_batches(spark, f"{scratch}/copy").count() == 6


def test_old_notes_are_dropped(spark, scratch):
    write = once_sink(Target(lambda df: None, lambda *a: None), f"{scratch}/ledger", 1)
    batch = spark.createDataFrame([], PAIR)
    for n in range(103):
        write(batch, n)
    assert changelog.numbers_in(spark, f"{scratch}/ledger/epoch=1", "batch_id=") == list(range(3, 103))


def test_headers_carry_the_batch(spark):
    tagged = spark.createDataFrame([("t", "k", "v", 5, 9), ("t", None, None, 5, 10)],
                                   "topic string, key string, value string, epoch long, batch_id long")
    sent = kafka.with_headers(tagged)
    assert sent.columns == ["topic", "key", "value", "headers"]
    assert rows(kafka.from_headers(sent)) == rows(tagged)


def test_a_new_checkpoint_leaves_old_batches(spark, scratch):
    path = f"{scratch}/out"
    old = folder_sink(path, open_epoch(spark, path, f"{scratch}/old"))
    for n in range(3):
        old(spark.createDataFrame([("old", n)], PAIR), n)
    new = folder_sink(path, open_epoch(spark, [path, f"{scratch}/none"], f"{scratch}/new"))
    new(spark.createDataFrame([("new", 0)], PAIR), 0)
    assert rows(read_batches(spark, path)) == [("new", 0)]
    assert rows(read_batches(spark, path, every=True)) == [("new", 0), ("old", 0), ("old", 1), ("old", 2)]


@pytest.mark.parametrize("job,folder", [("route", "routed"), ("fanout", "fanout/events")])
def test_jobs_with_a_new_checkpoint(spark, scratch, job, folder):
    import inboxlens.streaming.changelog as log
    path, root = f"{scratch}/in", f"{scratch}/root"

    def land(n):
        encode_events(events_df(spark, [event(customer_id=n)])).select("key", "value").coalesce(1) \
            .write.mode("append").parquet(path)

    def run():
        apps.JOBS[job](spark, apps.parser().parse_args(
            [job, "--source", "files", "--path", path, "--root", root, "--max-per-trigger", "1", "--available-now"]))

    land(1)
    land(2)
    run()
    log.delete(spark, f"{root}/route_checkpoint")
    log.delete(spark, f"{root}/fanout/checkpoint")
    land(3)
    run()
    assert read_batches(spark, f"{root}/{folder}").count() == 3
    assert read_batches(spark, f"{root}/{folder}", every=True).count() == 5


def test_a_read_opens_only_what_follows_the_snapshot(spark, scratch, monkeypatch):
    log, snaps, ckpt = (os.path.join(scratch, n) for n in ("log", "snaps", "ckpt"))
    write = changelog_sink(log, epoch=open_epoch(spark, log, ckpt))
    os.makedirs(f"{ckpt}/commits")
    opened = []
    find = changelog.batches_after
    monkeypatch.setattr(changelog, "batches_after", lambda *a: opened.append(find(*a)) or opened[-1])
    counts = []
    for n in range(9):
        write(spark.createDataFrame([("a", n)], PAIR), n)
        open(f"{ckpt}/commits/{n}", "w").close()
        if n % 2 == 0:
            assert rows(read_latest(spark, log, ["key"], snaps)) == [("a", n)]
            assert snapshot(spark, log, ["key"], snaps, ckpt, prune=n > 5) == n
            counts.append(len(opened[-1]) if opened else 0)
    assert counts[1:] == [2, 2, 2, 2]
    assert rows(read_latest(spark, log, ["key"], snaps)) == [("a", 8)] and opened[-1] == []
    epoch = changelog.numbers_in(spark, log, "epoch=")[-1]
    assert changelog.numbers_in(spark, f"{log}/epoch={epoch}", "batch_id=") == [7, 8]
    assert changelog.numbers_in(spark, f"{snaps}/epoch={epoch}", "upto=") == [6, 8]


def test_gold_that_breaks_half_way_is_not_read(spark, scratch, monkeypatch):
    tables = {"one": spark.range(1), "two": spark.range(2)}
    monkeypatch.setattr(refresh, "snapshot_silver", lambda *a: None)
    monkeypatch.setattr(refresh, "compacted_silver", lambda *a: None)
    monkeypatch.setattr(refresh, "gold_from_silver", lambda *a: dict(tables))
    with pytest.raises(FileNotFoundError):
        refresh.read_gold(spark, scratch)
    refresh.refresh_gold(spark, scratch, None)
    before = refresh.gold_versions(spark, scratch)
    tables["one"], tables["two"] = spark.range(10), spark.range(2).select(F.raise_error(F.lit("broken")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        refresh.refresh_gold(spark, scratch, None)
    assert refresh.gold_versions(spark, scratch) == before
    held = refresh.read_gold(spark, scratch)
    assert {n: t.count() for n, t in held.items()} == {"one": 1, "two": 2}
    tables["two"] = spark.range(20)
    for _ in range(3):
        refresh.refresh_gold(spark, scratch, None, keep=2)
    assert {n: t.count() for n, t in refresh.read_gold(spark, scratch).items()} == {"one": 10, "two": 20}
    left = changelog.numbers_in(spark, f"{scratch}/gold", "version=")
    assert left == refresh.gold_versions(spark, scratch) and len(left) == 2 and before[0] not in left
