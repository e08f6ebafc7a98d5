"""Routing by a rule table."""

import json

import pytest

from inboxlens import apps
from inboxlens.operators import routing
from inboxlens.operators.decode import decode_events, encode_events
from inboxlens.streaming.pipeline import read_batches
from tests.helpers import event, events_df, rows


def messages(spark):
    kinds = ["SENT", "OPENED", "SPAM", "OTHER"]
    sent = encode_events(events_df(spark, [event(customer_id=i, type_event=k) for i, k in enumerate(kinds)]))
    return sent.select("key", "value").union(spark.createDataFrame([("9", "no json")], "key string, value string"))


def routed(spark, rules=None):
    return rows(routing.route_events(decode_events(messages(spark)), rules), "key", "topic")


def test_a_changed_row_changes_the_route(spark):
    default = [("0", "delivery"), ("1", "engagement"), ("2", "error"), ("3", "unknown"), ("9", "quarantine")]
    assert routed(spark) == default
    table = spark.createDataFrame(routing.default_rules(), routing.RULE_SCHEMA)
    assert routed(spark, routing.read_rules(table)) == default
    changed = [(p, w, "opens" if t == "engagement" else t) for p, w, t in routing.default_rules()]
    assert routed(spark, changed) == [(k, "opens" if t == "engagement" else t) for k, t in default]
    first = [(0, "customer_id = 1", "vip"), *routing.default_rules()]
    assert dict(routed(spark, first[::-1]))["1"] == "vip"
    assert {t for _, t in routed(spark, [])} == {"unknown"}
    assert routing.topics(first) == ["delivery", "engagement", "error", "quarantine", "unknown", "vip"]
    with pytest.raises(ValueError):
        routing.read_rules(spark.createDataFrame([(1, None, "t")], routing.RULE_SCHEMA))


def test_the_job_reads_its_rules(spark, scratch):
    messages(spark).coalesce(1).write.parquet(f"{scratch}/in")
    with open(f"{scratch}/rules.json", "w") as f:
        for p, w, t in [(1, "type_event = 'SPAM'", "abuse"), (2, "true", "rest")]:
            f.write(json.dumps({"priority": p, "predicate": w, "topic": t}) + "\n")
    apps.JOBS["route"](spark, apps.parser().parse_args(
        ["route", "--source", "files", "--path", f"{scratch}/in", "--root", f"{scratch}/root",
         "--rules", f"{scratch}/rules.json", "--available-now"]))
    got = rows(read_batches(spark, f"{scratch}/root/routed"), "key", "topic")
    assert got == [("0", "rest"), ("1", "rest"), ("2", "abuse"), ("3", "rest"), ("9", "rest")]
