"""Named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the generated tables of one scale directory (whole tables) and
returns a lazy DataFrame; streaming queries run their stream to completion
(``availableNow``) into the scratch folder and return the sink read back as a
batch DataFrame.  Event-time outputs are ``TIMESTAMP_NTZ`` (wall-clock UTC).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import utc
from ..operators import decode, dims, gold, routing, sessions, silver
from ..sources import files, fixture
from . import dims_load

Query = Callable[[SparkSession, str], DataFrame]


def _ntz(*cols: str):
    def apply(df: DataFrame) -> DataFrame:
        return df.select(*[utc.wall(c).alias(c) if c in cols else F.col(c) for c in df.columns])
    return apply


# --- core silver / gold -----------------------------------------------------

def campaign_effectiveness(spark, sf):
    ev = fixture.events(spark, sf, geo=False)
    return gold.campaign_effectiveness(gold.engagement_rows(ev), fixture.campaigns(spark, sf))


def events_by_campaign_city(spark, sf):
    return silver.campaign_city_counts(fixture.events(spark, sf))


def events_by_campaign_type(spark, sf):
    return silver.campaign_type_counts(fixture.events(spark, sf, geo=False))


def engagement_by_customer(spark, sf):
    return silver.engagement_counts(fixture.events(spark, sf, geo=False))


def city_top10(spark, sf):
    return gold.city_top(fixture.events(spark, sf))


def header_counts(spark, sf):
    return gold.header_counts(fixture.events(spark, sf, geo=False), customers_table(spark, sf))


def product_popularity(spark, sf):
    counts = silver.product_counts(fixture.events(spark, sf, geo=False))
    return gold.product_ranking(counts, fixture.products(spark, sf))


def best_product(spark, sf):
    return gold.best_product(product_popularity(spark, sf))


def campaign_names(spark, sf):
    ids = fixture.events(spark, sf, geo=False).select("campaign_id")
    return gold.campaign_names(fixture.campaigns(spark, sf), ids)


# --- decode / contract / routing -------------------------------------------

def json_roundtrip_events(spark, sf):
    decoded = decode.decode_events(fixture.event_messages(spark, sf))
    return _ntz("event_date")(decode.valid_events(decoded))


def events_quarantine(spark, sf):
    decoded = decode.decode_events(fixture.event_messages(spark, sf, corrupt=True))
    return decode.quarantine(decoded).select("key", "value", "reason")


def route_events(spark, sf):
    decoded = decode.decode_events(fixture.event_messages(spark, sf, corrupt=True))
    return routing.route_events(decoded)


def enriched_events(spark, sf):
    ev = fixture.events(spark, sf)
    out = silver.enrich_events(ev, fixture.products(spark, sf), fixture.campaigns(spark, sf))
    return _ntz("event_date")(out)


# --- event time -------------------------------------------------------------

def activity_tumbling(spark, sf):
    out = silver.activity_windows(fixture.events(spark, sf, geo=False), "1 day")
    return _ntz("window_start", "window_end")(out)


def activity_sliding(spark, sf):
    out = silver.activity_windows(fixture.events(spark, sf, geo=False), "1 day", "12 hours")
    return _ntz("window_start", "window_end")(out)


def customer_sessions(spark, sf):
    out = sessions.sessions(fixture.events(spark, sf, geo=False), gap="12 hours")
    return _ntz("session_start", "session_end")(out)


# --- metrics ----------------------------------------------------------------

def user_ctr(spark, sf):
    return gold.user_ctr(fixture.events(spark, sf, geo=False))


def click_share(spark, sf):
    return gold.click_share(campaign_effectiveness(spark, sf))


def funnel(spark, sf):
    return gold.funnel(fixture.events(spark, sf, geo=False))


def deliverability(spark, sf):
    return gold.deliverability(fixture.events(spark, sf, geo=False))


def repeat_engagement(spark, sf):
    return gold.repeat_engagement(silver.engagement_counts(fixture.events(spark, sf, geo=False)))


def client_mix(spark, sf):
    return silver.client_mix(fixture.events(spark, sf, geo=False))


# --- dimensions -------------------------------------------------------------

def audience(spark, sf):
    users = dims.flatten_users(fixture.user_records(spark, sf))
    return dims.audience(fixture.events(spark, sf, geo=False), users)


def customers_table(spark, sf):
    """The customers table: its header counts are ``header_counts``."""
    users = dims.flatten_users(fixture.user_records(spark, sf))
    return dims.customers_table(fixture.events(spark, sf, geo=False), users)


def dims_quarantine(spark, sf):
    """Every landed dimension record that the load rejects, as it came, with the reason."""
    out = None
    for name, lines in fixture.landed_lines(spark, sf).items():
        schema = dims_load.LANDED[name]
        _, rejected = files.split_records(files.parse_records(lines, schema), schema)
        part = rejected.withColumn("table_name", F.lit(name))
        if name == "campaign":
            part = part.unionByName(dims_load.links(files.parse_records(lines, schema))[1]
                                    .withColumn("table_name", F.lit("campaign_product_interactions")))
        out = part if out is None else out.unionByName(part)
    return out.select("table_name", "raw", "reason")


def price_clean(spark, sf):
    valid, _ = dims.clean_prices(fixture.landed_products(spark, sf))
    return valid.select("id", "title", "category", "price")


def campaign_links(spark, sf):
    return dims.campaign_links(fixture.landed_campaign_links(spark, sf))


def tag_counts(spark, sf):
    return dims.tag_counts(fixture.landed_products(spark, sf))


BATCH_QUERIES: dict[str, Query] = {
    "campaign_effectiveness": campaign_effectiveness,
    "events_by_campaign_city": events_by_campaign_city,
    "events_by_campaign_type": events_by_campaign_type,
    "engagement_by_customer": engagement_by_customer,
    "city_top10": city_top10,
    "header_counts": header_counts,
    "product_popularity": product_popularity,
    "best_product": best_product,
    "campaign_names": campaign_names,
    "json_roundtrip_events": json_roundtrip_events,
    "events_quarantine": events_quarantine,
    "route_events": route_events,
    "enriched_events": enriched_events,
    "activity_tumbling": activity_tumbling,
    "activity_sliding": activity_sliding,
    "customer_sessions": customer_sessions,
    "user_ctr": user_ctr,
    "click_share": click_share,
    "funnel": funnel,
    "deliverability": deliverability,
    "repeat_engagement": repeat_engagement,
    "client_mix": client_mix,
    "audience": audience,
    "customers_table": customers_table,
    "dims_quarantine": dims_quarantine,
    "price_clean": price_clean,
    "campaign_links": campaign_links,
    "tag_counts": tag_counts,
}


def queries() -> dict[str, Query]:
    from ..streaming import jobs
    out = dict(BATCH_QUERIES)
    out.update(jobs.STREAM_QUERIES)
    return out
