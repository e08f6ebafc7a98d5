"""Rule-based routing of decoded events to topics (one pass, computed column).

Rules are data: rows of priority, predicate and topic, the built-in ones or those of a table,
compiled to one expression.  The sink writes each row to the topic named in its ``topic``
column, so one job serves every destination.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DEFAULT_LABELS, EventLabels

# Destination topic names.
QUARANTINE_TOPIC = "quarantine"
ENGAGEMENT_TOPIC = "engagement"
DELIVERY_TOPIC = "delivery"
ERROR_TOPIC = "error"
UNKNOWN_TOPIC = "unknown"


RULE_SCHEMA = "priority int, predicate string, topic string"


def default_rules(labels: EventLabels = DEFAULT_LABELS) -> list[tuple[int, str, str]]:
    """The rules (priority, predicate in SQL over a decoded event, topic) of the event types."""
    def one_of(*names: str) -> str:
        return "type_event in (" + ", ".join("'" + n.replace("'", "\\'") + "'" for n in names) + ")"

    return [(1, "size(violations) > 0", QUARANTINE_TOPIC),
            (2, one_of(*labels.opened, *labels.clicked, *labels.forwarded), ENGAGEMENT_TOPIC),
            (3, one_of(*labels.sent, *labels.delivered), DELIVERY_TOPIC),
            (4, one_of(*labels.spam, *labels.hard_bounce), ERROR_TOPIC),
            (5, "true", UNKNOWN_TOPIC)]


def read_rules(table: DataFrame) -> list[tuple[int, str, str]]:
    """The rules of a rule table (``priority, predicate, topic``), which holds some rows a
    topic.  A row without one of them raises."""
    rows = [tuple(r) for r in table.select("priority", "predicate", "topic").collect()]
    if any(v is None for r in rows for v in r):
        raise ValueError("a rule needs a priority, a predicate and a topic")
    return rows


def topic_rule(rules: Sequence[tuple[int, str, str]]) -> Column:
    """One CASE over the rules: the first by priority (then by topic and predicate) whose
    predicate holds names the topic; without one it is ``unknown``."""
    out = None
    for _, predicate, topic in sorted(rules, key=lambda r: (r[0], r[2], r[1])):
        out = (F if out is None else out).when(F.expr(predicate), F.lit(topic))
    return F.lit(UNKNOWN_TOPIC) if out is None else out.otherwise(F.lit(UNKNOWN_TOPIC))


def topics(rules: Sequence[tuple[int, str, str]]) -> list[str]:
    """Every topic that the rules can name."""
    return sorted({r[2] for r in rules} | {UNKNOWN_TOPIC})


def route_events(decoded: DataFrame, rules: Sequence[tuple[int, str, str]] | None = None) -> DataFrame:
    """Decoded events (with ``violations``) -> messages (topic, key, value) as the topic
    writer takes them, with ``type_event`` beside them."""
    rule = topic_rule(default_rules() if rules is None else rules)
    return decoded.select(rule.alias("topic"), "key", "value", "type_event")
