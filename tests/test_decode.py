"""Decoding of raw messages: typed rows, quarantine, round trip (FIXTURES section 3)."""

import datetime as dt

from inboxlens.operators.decode import decode_events, encode_events, quarantine, valid_events
from tests.helpers import event, events_df


def _raw(spark, values):
    return spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "key string, value string")


def test_malformed_and_bad_rows_go_to_quarantine(spark):
    raw = _raw(spark, [
        "not json",
        '{"customer_id":"x","campaign_id":"b"}',
        None,
        '{"customer_id": 1, "campaign_id": "a", "type_event": "SENT", "event_date": "bad"}',
        '{"customer_id": 1, "campaign_id": "a", "type_event": "SENT", '
        '"event_date": "2024-01-01T00:00:00Z", "city": "' + "c" * 31 + '"}',
        '{"customer_id": 1, "campaign_id": "a", "type_event": "CLICKED", '
        '"event_date": "2024-01-01T00:00:00.000001Z"}',
    ])
    decoded = decode_events(raw)
    q = {r["key"]: r["reason"] for r in quarantine(decoded).collect()}
    assert q == {
        "0": "customer_id,campaign_id,type_event,event_date",
        "1": "customer_id,type_event,event_date",
        "2": "value,customer_id,campaign_id,type_event,event_date",
        "3": "event_date",
        "4": "city",
    }
    payload = {r["key"]: r["value"] for r in quarantine(decoded).collect()}
    assert payload == {r["key"]: r["value"] for r in raw.filter("key < '5'").collect()}  # as it came
    ok = valid_events(decoded).collect()
    assert len(ok) + len(q) == raw.count()
    assert len(ok) == 1
    assert ok[0]["product_id"] is None  # absent key -> null
    assert ok[0]["event_date"] == dt.datetime(2024, 1, 1, 0, 0, 0, 1)


def test_roundtrip_keeps_every_field(spark):
    rows = [event(7, "cmp-1", "CLICKED", minutes=3, product_id=4, user_agent="curl/8.0"),
            event(8, "cmp-2", "SENT", minutes=5, city=None)]
    ev = events_df(spark, rows)
    msgs = encode_events(ev)
    assert [r["key"] for r in msgs.orderBy("key").collect()] == ["7", "8"]
    assert '"product_id"' not in msgs.filter("key = '8'").first()["value"]  # nulls omitted
    back = valid_events(decode_events(msgs.select("key", "value")))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, ev.collect()))


def test_binary_topic_records_decode(spark):
    raw = spark.createDataFrame(
        [(b"7", b'{"customer_id": 7, "campaign_id": "c", "type_event": "OPENED", '
                b'"event_date": "2024-01-02T03:04:05Z"}'), (b"8", b"\xff\xfe")],
        "key binary, value binary")
    decoded = decode_events(raw)
    ok = valid_events(decoded).collect()
    assert [(r["customer_id"], r["type_event"]) for r in ok] == [(7, "OPENED")]
    # bytes that are no text survive in the quarantine
    assert [(r["key"], bytes(r["value"])) for r in quarantine(decoded).collect()] == [("8", b"\xff\xfe")]
