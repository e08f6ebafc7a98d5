"""Bronze -> silver decoding, shared by batch and streaming.

``decode_events`` turns raw messages (binary or string ``value``) into typed event
rows plus a ``violations`` array; ``valid_events`` / ``quarantine`` split them.
Malformed JSON never raises: fields are extracted with ``json_tuple`` and
typed with ``try_cast``, so bad rows land in quarantine instead of failing the
job or being counted under null keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from ..functions import utc
from ..functions.contract import product_rule, violations
from ..schemas import EVENT_COLUMNS, EVENT_SCHEMA


def encode_events(events: DataFrame, key_col: str = "customer_id", extra=(),
                  event_date_text: Column | None = None) -> DataFrame:
    """Typed events -> (key, value) messages.

    key = the customer id as text; value = JSON of the event columns (null fields
    omitted).  ``event_date`` travels as ISO text in UTC with microseconds.
    ``event_date_text``, when given, overrides the rendered time where non-null.
    The typed ``event_date`` and ``extra`` columns are passed through.
    """
    rendered = utc.iso_text("event_date")
    if event_date_text is not None:
        rendered = F.coalesce(event_date_text, rendered)
    fields = [rendered.alias("event_date") if c == "event_date" else F.col(c)
              for c in EVENT_COLUMNS]
    return events.select(
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
        F.col("event_date"),
        *[F.col(c) for c in extra],
    )


def decode_events(raw: DataFrame, value_col: str = "value", keep=("key",)) -> DataFrame:
    """Raw messages -> ``key``, ``value`` (as it came), typed events and ``violations``
    (array<string>).  The payload stays with the row, so a rejected or routed message can
    be sent on or replayed whole.

    The message is parsed once with ``json_tuple`` over the declared field
    names, then each field is ``try_cast`` to its declared type: absent keys,
    JSON nulls, malformed text and values of the wrong type all become null
    (the PERMISSIVE reading of ``from_json``) and are then judged by the
    contract.  ``json_tuple`` is a generator, so the contract filter cannot be
    pushed below it and re-inline the parse into every check, which is what
    happens to a ``from_json`` projection (measured 4x slower).
    """
    keep = [c for c in keep if c in raw.columns]
    text = F.col(value_col).cast("string")
    kept = [F.col(c).cast("string").alias(c) if isinstance(raw.schema[c].dataType, BinaryType)
            else F.col(c) for c in keep]  # topic records carry binary keys
    parsed = raw.select(
        *kept,
        F.col(value_col).alias("value"),
        text.isNull().alias("__no_value"),
        F.json_tuple(text, *EVENT_COLUMNS).alias(*[f"__j_{c}" for c in EVENT_COLUMNS]))
    typed = parsed.select(
        *[F.col(c) for c in keep], "value",
        "__no_value",
        *[_typed(f"__j_{f.name}", f.dataType).alias(f.name) for f in EVENT_SCHEMA.fields])
    checks = F.concat(F.array_compact(F.array(F.when(F.col("__no_value"), F.lit("value")))),
                      violations(rules={"product_id": product_rule()}))
    return typed.withColumn("violations", checks).drop("__no_value")


def _typed(name: str, dtype) -> Column:
    if isinstance(dtype, StringType):
        return F.col(name)
    return F.expr(f"try_cast(`{name}` AS {dtype.simpleString()})")


def valid_events(decoded: DataFrame) -> DataFrame:
    """The typed events that meet the contract (key and payload dropped)."""
    return decoded.filter(F.size("violations") == 0).select(*EVENT_COLUMNS)


def quarantine(decoded: DataFrame) -> DataFrame:
    """Rejected rows, payload included, with a comma-separated ``reason`` naming the
    failed columns."""
    return (decoded.filter(F.size("violations") > 0)
            .withColumn("reason", F.array_join("violations", ","))
            .drop("violations"))
