"""Silver aggregates: pure ``DataFrame -> DataFrame`` over typed events.

Each function works on a batch DataFrame and on a streaming one alike (one
aggregate per function: streams refuse chained aggregates in update mode).
All are hash aggregates with a map-side partial step, so a hot key is
pre-aggregated inside every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stages import count_if, stage_rank
from ..functions.useragent import client_columns
from ..schemas import DEFAULT_LABELS, EventLabels
from .joins import left_lookup


def campaign_city_counts(events: DataFrame) -> DataFrame:
    """Events per (campaign_id, city); the count column is named ``count``."""
    return events.groupBy("campaign_id", "city").count()


def campaign_type_counts(events: DataFrame, labels: EventLabels = DEFAULT_LABELS) -> DataFrame:
    """Per campaign, five conditional counts (a pivot without ``pivot``, which
    streams refuse).  FORWARDED and HARD_BOUNCE have no column."""
    t = F.col("type_event")
    return events.groupBy("campaign_id").agg(
        count_if(t.isin(*labels.delivered)).alias("DELIVERED"),
        count_if(t.isin(*labels.clicked)).alias("CLICKED"),
        count_if(t.isin(*labels.spam)).alias("SPAM"),
        count_if(t.isin(*labels.opened)).alias("OPENED"),
        count_if(t.isin(*labels.sent)).alias("SENT"),
    )


def engagement_counts(events: DataFrame, labels: EventLabels = DEFAULT_LABELS) -> DataFrame:
    """Opens and clicks per (campaign_id, customer_id, type_event) as ``total_events``."""
    return (events.filter(F.col("type_event").isin(*labels.clicked, *labels.opened))
            .groupBy("campaign_id", "customer_id", "type_event")
            .agg(F.count("type_event").alias("total_events")))


def product_counts(events: DataFrame) -> DataFrame:
    """Events per non-null product as ``count_product``."""
    return (events.filter(F.col("product_id").isNotNull())
            .groupBy("product_id")
            .agg(F.count("product_id").alias("count_product")))


def furthest_stages(events: DataFrame, labels: EventLabels = DEFAULT_LABELS) -> DataFrame:
    """The furthest funnel stage of each (campaign, customer): the running part of the
    funnel; it only grows."""
    return (events.select("campaign_id", "customer_id", stage_rank(labels).alias("stage"))
            .groupBy("campaign_id", "customer_id").agg(F.max("stage").alias("furthest")))


def delivery_counts(events: DataFrame, labels: EventLabels = DEFAULT_LABELS) -> DataFrame:
    """Per campaign: events, SPAM and HARD_BOUNCE: the running part of deliverability."""
    t = F.col("type_event")
    return events.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("events"),
        count_if(t.isin(*labels.spam)).alias("spam"),
        count_if(t.isin(*labels.hard_bounce)).alias("hard_bounce"))


def activity_windows(events: DataFrame, duration: str, slide: str | None = None) -> DataFrame:
    """Events per (campaign_id, type_event, event-time window).

    Windows are ``[start, end)``, aligned to the epoch (UTC) whatever the session zone;
    with ``slide`` each event falls in ``duration / slide`` windows.
    """
    w = F.window("event_date", duration, slide) if slide else F.window("event_date", duration)
    return (events.groupBy("campaign_id", "type_event", w.alias("window"))
            .agg(F.count(F.lit(1)).alias("events"))
            .select("campaign_id", "type_event",
                    F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "events"))


def client_mix(events: DataFrame) -> DataFrame:
    """Events per (campaign_id, browser, OS, device family) from ``user_agent``.

    Agents repeat heavily, so events are first counted per (campaign, agent) and
    the regex rules run once per distinct pair instead of once per event.
    """
    return client_mix_from_agents(agent_counts(events))


def agent_counts(events: DataFrame) -> DataFrame:
    """Events per (campaign_id, user_agent): the running part of the client mix."""
    return events.groupBy("campaign_id", "user_agent").agg(F.count(F.lit(1)).alias("n"))


def client_mix_from_agents(per_agent: DataFrame) -> DataFrame:
    return (per_agent.select("campaign_id", *client_columns("user_agent"), "n")
            .groupBy("campaign_id", "browser_name", "os_name", "device_family")
            .agg(F.sum("n").cast("long").alias("events")))


PRODUCT_LOOKUP = {"id": "p_id", "title": "product_title", "category": "product_category",
                  "price": "product_price"}
CAMPAIGN_LOOKUP = {"uuid_campaign": "c_id", "name": "campaign_name"}


def _renamed(df: DataFrame, mapping: dict) -> DataFrame:
    return df.select(*[F.col(k).alias(v) for k, v in mapping.items()])


def enrich_events(events: DataFrame, products: DataFrame, campaigns: DataFrame,
                  hot_products: DataFrame | None = None,
                  hot_campaigns: DataFrame | None = None) -> DataFrame:
    """Events with product and campaign attributes (left joins: no event is lost).

    Both dimension keys must be unique.  ``product_id`` is null on most events,
    so the product look-up salts null keys (``left_lookup``); hot-key sets
    (``joins.hot_keys``) additionally split the busiest products/campaigns.
    """
    prod, camp = _renamed(products, PRODUCT_LOOKUP), _renamed(campaigns, CAMPAIGN_LOOKUP)
    with_product = left_lookup(events, prod, "product_id", "p_id",
                               salt_cols=["customer_id", "event_date", "campaign_id"],
                               hot=hot_products)
    return left_lookup(with_product, camp, "campaign_id", "c_id",
                       salt_cols=["customer_id", "event_date"], hot=hot_campaigns)


def session_counts(events: DataFrame, gap: str = "12 hours", key: str = "customer_id") -> DataFrame:
    """Streaming sessions: events per (key, session window) with Spark's
    ``session_window`` (events up to ``gap`` apart share a session; the window
    ends at the last event + gap).  On a stream it needs a watermark and append
    mode: a session is emitted once the watermark passes its end.  Batch jobs use
    ``operators.sessions``, which bounds the per-key ordered work."""
    w = F.session_window("event_date", gap).alias("session")
    return (events.groupBy(key, w).agg(F.count(F.lit(1)).alias("events"))
            .select(key, F.col("session.start").alias("session_start"),
                    F.col("session.end").alias("session_end"), "events"))


def campaign_reach(events: DataFrame, labels: EventLabels = DEFAULT_LABELS,
                   rsd: float = 0.01) -> DataFrame:
    """Distinct clickers and openers per campaign for a stream, where exact
    distinct counts are refused: HyperLogLog++ sketches (``approx_count_distinct``,
    relative error ``rsd``) kept in state, one fixed-size sketch per campaign and
    type however many customers there are.  For exact numbers, read the compacted
    engagement table (``gold.user_ctr_from_engagement``)."""
    t = F.col("type_event")
    return events.groupBy("campaign_id").agg(
        F.approx_count_distinct(F.when(t.isin(*labels.clicked), F.col("customer_id")), rsd)
         .alias("clickers"),
        F.approx_count_distinct(F.when(t.isin(*labels.opened), F.col("customer_id")), rsd)
         .alias("openers"))
