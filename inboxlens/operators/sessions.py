"""Per-customer activity sessions without a window over raw events.

Definition: events of one customer whose times are at most ``gap`` apart share a
session; a session spans [first event, last event + gap).

A ``lag`` window partitioned by customer would put all of a hot customer's
events into one task.  Instead time is cut into buckets of width ``gap``:

* two events in the same bucket are less than ``gap`` apart, so only the first
  event of a bucket can open a session;
* that event opens one iff the previous non-empty bucket is not the adjacent one
  or its last event is more than ``gap`` earlier.

So events reduce to one row per (customer, bucket) with min/max/count
(pre-aggregated map-side, whatever the skew); the ordered window then runs over
bucket summaries, whose number per customer is bounded by the time span / gap
rather than by the event count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _seconds(interval: str) -> int:
    n, unit = interval.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    return int(n) * mult[unit.rstrip("s")]


def sessions(events: DataFrame, gap: str = "12 hours", key: str = "customer_id",
             ts: str = "event_date") -> DataFrame:
    """One row per (key, session): session_start, session_end, events."""
    g = _seconds(gap)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    buckets = (events.filter(F.col(ts).isNotNull())
               .select(F.col(key), micros.alias("t"))
               .withColumn("bucket", F.call_function(
                   "div", F.col("t") - F.pmod(F.col("t"), F.lit(g * 1_000_000)),
                   F.lit(g * 1_000_000)))
               .groupBy(key, "bucket")
               .agg(F.min("t").alias("t_min"), F.max("t").alias("t_max"),
                    F.count(F.lit(1)).alias("n")))
    w = Window.partitionBy(key).orderBy("bucket")
    prev_bucket = F.lag("bucket").over(w)
    prev_max = F.lag("t_max").over(w)
    opens = (prev_bucket.isNull() | (prev_bucket < F.col("bucket") - 1)
             | (F.col("t_min") - prev_max > F.lit(g * 1_000_000)))
    marked = buckets.withColumn("opens", opens.cast("int"))
    numbered = marked.withColumn(
        "session_no", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    per = (numbered.groupBy(key, "session_no")
           .agg(F.min("t_min").alias("t_start"), F.max("t_max").alias("t_end"),
                F.sum("n").alias("events")))
    return per.select(
        F.col(key),
        F.timestamp_micros("t_start").alias("session_start"),
        (F.timestamp_micros("t_end") + F.expr(f"INTERVAL {g} SECONDS")).alias("session_end"),
        F.col("events").cast("long").alias("events"))
