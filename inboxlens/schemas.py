"""Declared schemas and the configuration constants of the event model.

Schemas are fixed and declared, never inferred.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (ArrayType, BooleanType, FloatType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampType)

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference pipeline's (labels, stage order,
# column limits, top-k, watermark, topic names, e-mail domains).
# ---------------------------------------------------------------------------
SENT = "SENT"
DELIVERED = "DELIVERED"
DELIVERED_EVENT = "DELIVERED_EVENT"
OPENED = "OPENED"
CLICKED = "CLICKED"
FORWARDED = "FORWARDED"
SPAM = "SPAM"
HARD_BOUNCE = "HARD_BOUNCE"

# Funnel stage order: SENT -> DELIVERED -> OPENED -> CLICKED -> FORWARDED.
FUNNEL_STAGES = ("SENT", "DELIVERED", "OPENED", "CLICKED", "FORWARDED")

# Column limits of the events table (varchar(n)); customer_id and campaign_id NOT NULL.
EVENT_COLUMN_LIMITS = {
    "campaign_id": 150,
    "type_event": 50,
    "gender": 50,
    "email": 50,
    "country": 20,
    "city": 30,
    "state": 30,
    "user_agent": 255,
}

TOP_K = 10
WATERMARK_DELAY = "1 minute"

CITY_TOPIC = "events-city-aggregation"
CAMPAIGN_TOPIC = "events-campaign-aggregation"
EFFECTIVENESS_TOPIC = "campaign-effectiveness"

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class EventLabels:
    """Event-type labels as a parameter object.

    ``delivered`` accepts both spellings by default: the producer's label is
    configuration, while the original aggregate counts only ``DELIVERED_EVENT``.
    """

    sent: tuple[str, ...] = (SENT,)
    delivered: tuple[str, ...] = (DELIVERED, DELIVERED_EVENT)
    opened: tuple[str, ...] = (OPENED,)
    clicked: tuple[str, ...] = (CLICKED,)
    forwarded: tuple[str, ...] = (FORWARDED,)
    spam: tuple[str, ...] = (SPAM,)
    hard_bounce: tuple[str, ...] = (HARD_BOUNCE,)

    def stages(self) -> list[tuple[str, tuple[str, ...]]]:
        """(stage name, labels) in funnel order."""
        return [(SENT, self.sent), (DELIVERED, self.delivered), (OPENED, self.opened),
                (CLICKED, self.clicked), (FORWARDED, self.forwarded)]


DEFAULT_LABELS = EventLabels()

# Wire schema of one event message (JSON value of the events topic).  event_date
# travels as text and is parsed after decoding; customer_id is widened to long so
# keys beyond 2^31 survive at scale.
EVENT_WIRE_SCHEMA = StructType([
    StructField("customer_id", LongType()),
    StructField("campaign_id", StringType()),
    StructField("type_event", StringType()),
    StructField("event_date", StringType()),
    StructField("gender", StringType()),
    StructField("email", StringType()),
    StructField("user_agent", StringType()),
    StructField("country", StringType()),
    StructField("city", StringType()),
    StructField("state", StringType()),
    StructField("product_id", IntegerType()),
])

EVENT_COLUMNS = [f.name for f in EVENT_WIRE_SCHEMA.fields]

# Typed event rows (what silver aggregates consume).
EVENT_SCHEMA = StructType([
    f if f.name != "event_date" else StructField("event_date", TimestampType())
    for f in EVENT_WIRE_SCHEMA.fields
])

PRODUCT_SCHEMA = StructType([
    StructField("id", IntegerType(), False),
    StructField("title", StringType(), False),
    StructField("description", StringType(), True),
    StructField("category", StringType(), False),
    StructField("image", StringType(), True),
    StructField("price", FloatType(), False),
])

CAMPAIGN_SCHEMA = StructType([
    StructField("uuid_campaign", StringType(), False),
    StructField("name", StringType(), False),
    StructField("created_by", StringType(), False),
    StructField("description", StringType(), True),
    StructField("valid_campaign", BooleanType(), True),
    StructField("tags", StringType(), True),
])

CUSTOMER_SCHEMA = StructType([
    StructField("id", LongType(), False),
    StructField("campaign_id", StringType(), False),
    StructField("email", StringType(), True),
    StructField("name_customer", StringType(), False),
    StructField("description_customer", StringType(), True),
    StructField("gender", StringType(), True),
    StructField("country", StringType(), True),
    StructField("city", StringType(), True),
    StructField("state", StringType(), True),
])

LINK_SCHEMA = StructType([
    StructField("product_id", IntegerType(), False),
    StructField("campaign_id", StringType(), False),
    StructField("linked_by", StringType(), False),
])

# Nested user record as landed from a user API (name, gender, location).
USER_RECORD_SCHEMA = StructType([
    StructField("name", StructType([StructField("first", StringType()),
                                    StructField("last", StringType())])),
    StructField("gender", StringType()),
    StructField("location", StructType([
        StructField("country", StringType()),
        StructField("city", StringType()),
        StructField("state", StringType()),
        StructField("timezone", StructType([StructField("description", StringType())])),
    ])),
])

# Landed (pre-cleaning) records of the dimension load.
LANDED_PRODUCT_SCHEMA = StructType([
    StructField("id", IntegerType(), False),
    StructField("title", StringType(), False),
    StructField("description", StringType()),
    StructField("category", StringType(), False),
    StructField("image", StringType()),
    StructField("price", StringType(), False),
])

# The number and the domain of the e-mail address come with the record.
LANDED_USER_SCHEMA = StructType([StructField("user_key", LongType(), False)] + USER_RECORD_SCHEMA.fields
                                + [StructField("email_number", LongType()),
                                   StructField("email_domain", StringType())])

LANDED_CAMPAIGN_SCHEMA = StructType([
    StructField("uuid_campaign", StringType(), False),
    StructField("name", StringType(), False),
    StructField("created_by", StringType(), False),
    StructField("description", StringType()),
    StructField("valid_campaign", BooleanType()),
    StructField("tags", ArrayType(StringType())),
    StructField("product_id", IntegerType()),
])
