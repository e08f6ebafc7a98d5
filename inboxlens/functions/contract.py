"""Row contract of the events table as Catalyst predicates.

The table declares ``customer_id``/``campaign_id`` NOT NULL and ``varchar(n)``
limits; the stream reader also requires ``type_event`` and a parseable
``event_date``; a product stands on clicks only.  ``violations`` returns an ``array<string>`` naming every failed
column (empty = valid), so a single pass splits valid rows from quarantine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DEFAULT_LABELS, EVENT_COLUMN_LIMITS, EventLabels

REQUIRED = ("customer_id", "campaign_id", "type_event", "event_date")


def product_rule(labels: EventLabels = DEFAULT_LABELS) -> Column:
    """Broken by an event of another type than a click that names a product.  An event
    without a type breaks the rule on the type only."""
    return F.col("product_id").isNotNull() & ~F.col("type_event").isin(*labels.clicked)


def violations(required=REQUIRED, limits=None, rules: dict[str, Column] | None = None) -> Column:
    """The columns that break the contract, in the order required, limited, ``rules`` (column
    name -> a predicate that holds where the column breaks it)."""
    limits = EVENT_COLUMN_LIMITS if limits is None else limits
    checks = []
    names = list(dict.fromkeys(list(required) + list(limits)))
    for name in names:
        bad = F.lit(False)
        if name in required:
            bad = bad | F.col(name).isNull()
        if name in limits:
            bad = bad | (F.length(F.col(name)) > F.lit(limits[name]))
        checks.append(F.when(bad, F.lit(name)))
    checks += [F.when(bad, F.lit(name)) for name, bad in (rules or {}).items()]
    # array_compact drops the nulls left by passing checks
    return F.array_compact(F.array(*checks))
