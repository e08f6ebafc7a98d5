"""Gold results: batch DataFrame queries over events or compacted silver tables.

Top-k results are computed before any look-up join (as in the original
dashboard: the join happens after the cut, so fewer than k rows may remain),
and the look-up broadcasts the k-row side, never the dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rates import half_even_percent, rate_or_zero
from ..functions.stages import count_if
from ..schemas import DEFAULT_LABELS, FUNNEL_STAGES, TOP_K, EventLabels
from .joins import join_bounded, semi_join_ids, top_k
from .silver import delivery_counts, furthest_stages


# --- G1: city traffic -------------------------------------------------------

def city_totals(city_counts: DataFrame) -> DataFrame:
    """Roll (campaign_id, city, count) up to city; null cities are dropped."""
    return (city_counts.filter(F.col("city").isNotNull())
            .groupBy("city").agg(F.sum("count").cast("long").alias("total_events")))


def city_top(events: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top-k cities by events (ties by city), straight from events: the sum of
    per-campaign counts equals the per-city count, so one partial aggregate does."""
    totals = (events.filter(F.col("city").isNotNull())
              .groupBy("city").agg(F.count(F.lit(1)).alias("total_events")))
    return top_k(totals, [F.col("total_events").desc(), F.col("city")], k)


def city_top_from_silver(city_counts: DataFrame, k: int = TOP_K) -> DataFrame:
    return top_k(city_totals(city_counts), [F.col("total_events").desc(), F.col("city")], k)


# --- G2: campaign effectiveness --------------------------------------------

def engagement_rows(events: DataFrame, labels: EventLabels = DEFAULT_LABELS) -> DataFrame:
    """Events as (campaign_id, type_event, total_events=1) rows: the same shape as
    the silver engagement table, so one effectiveness plan serves both."""
    return (events.filter(F.col("type_event").isin(*labels.clicked, *labels.opened))
            .select("campaign_id", "type_event", F.lit(1).cast("long").alias("total_events")))


def effectiveness(engagement: DataFrame, labels: EventLabels = DEFAULT_LABELS) -> DataFrame:
    """Per campaign: CLICKED, OPENED (null when absent) and
    ``effectiveness = half_even(CLICKED / OPENED * 100, 2)``, 0.0 when OPENED is 0,
    null when a side is missing."""
    t = F.col("type_event")
    per = engagement.groupBy("campaign_id").agg(
        F.sum(F.when(t.isin(*labels.clicked), F.col("total_events"))).cast("long").alias("CLICKED"),
        F.sum(F.when(t.isin(*labels.opened), F.col("total_events"))).cast("long").alias("OPENED"))
    return per.withColumn("effectiveness", half_even_percent("CLICKED", "OPENED"))


def campaign_effectiveness(engagement: DataFrame, campaigns: DataFrame, k: int = TOP_K,
                           labels: EventLabels = DEFAULT_LABELS) -> DataFrame:
    """Top-k campaigns by CLICKED, OPENED, effectiveness (all descending, missing
    last, then campaign_id), joined to campaign names after the cut; then missing
    counts become 0 and a missing effectiveness 0.0."""
    eff = effectiveness(engagement, labels)
    best = top_k(eff, [F.col("CLICKED").desc_nulls_last(), F.col("OPENED").desc_nulls_last(),
                       F.col("effectiveness").desc_nulls_last(), F.col("campaign_id")], k)
    names = campaigns.select("uuid_campaign", "name")
    joined = join_bounded(names, best, F.col("uuid_campaign") == F.col("campaign_id"))
    return joined.select(
        "campaign_id", "name",
        F.coalesce("CLICKED", F.lit(0)).cast("long").alias("CLICKED"),
        F.coalesce("OPENED", F.lit(0)).cast("long").alias("OPENED"),
        F.coalesce("effectiveness", F.lit(0.0)).alias("effectiveness"))


def click_share(effectiveness_top: DataFrame) -> DataFrame:
    """Each campaign's share of the clicks in the (at most k-row) result."""
    total = F.sum("CLICKED").over(Window.partitionBy())
    return effectiveness_top.select(
        "campaign_id", "name", "CLICKED",
        F.when(total == 0, F.lit(None).cast("double"))
         .otherwise(F.col("CLICKED").cast("double") / total.cast("double")).alias("click_share"))


def campaign_names(campaigns: DataFrame, ids: DataFrame, id_col: str = "campaign_id") -> DataFrame:
    """uuid_campaign, name for the campaigns whose id is in ``ids`` (semi join)."""
    return semi_join_ids(campaigns.select("uuid_campaign", "name"), "uuid_campaign", ids, id_col)


# --- G3: product ranking ----------------------------------------------------

def product_ranking(product_counts: DataFrame, products: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top-k products by count (ties by id), then inner join to the product table
    (a dangling id drops out after the cut), then DENSE_RANK by count.  The rank
    window has no partition key but sees at most k rows."""
    best = top_k(product_counts, [F.col("count_product").desc(), F.col("product_id")], k)
    prod = products.select("id", "title", "category", "image")
    joined = join_bounded(prod, best, F.col("id") == F.col("product_id"))
    rank = F.dense_rank().over(Window.orderBy(F.col("count_product").desc()))
    return joined.select("product_id", "title", "category", "image", "count_product",
                         rank.alias("rank"))


def best_product(ranking: DataFrame) -> DataFrame:
    """The rank-1 product (lowest id among ties)."""
    return top_k(ranking.filter(F.col("rank") == 1), [F.col("product_id")], 1)


# --- G4: header counts ------------------------------------------------------

def header_counts(events: DataFrame, customers: DataFrame) -> DataFrame:
    """Total events, rows of the customers table, and distinct people in it, as one row."""
    return header_from_counts(events.agg(F.count(F.lit(1)).alias("total_events")), customers)


def header_from_silver(city_counts: DataFrame, customers: DataFrame) -> DataFrame:
    """The header from the compacted (campaign, city) totals, whose sum is every event."""
    total = F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("total_events")
    return header_from_counts(city_counts.agg(total), customers)


def header_from_counts(total: DataFrame, customers: DataFrame) -> DataFrame:
    """Two results of one row each, added up into one.  People are counted in two map-side
    combined steps instead of ``count(DISTINCT)``."""
    people = customers.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    counts = people.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_customers"),
                        F.count("id").alias("distinct_customers"))
    zero = F.lit(0).cast("long")
    names = ["total_events", "total_customers", "distinct_customers"]
    parts = [df.select(*[F.col(c) if c in df.columns else zero.alias(c) for c in names]) for df in (total, counts)]
    return parts[0].unionByName(parts[1]).agg(*[F.sum(c).alias(c) for c in names])


# --- A12-A16 ----------------------------------------------------------------

def user_ctr(events: DataFrame, labels: EventLabels = DEFAULT_LABELS) -> DataFrame:
    """Per campaign: distinct clickers, distinct openers and CTR = clickers/openers (%).

    Two-level aggregation instead of ``count(DISTINCT)``: per (campaign, customer)
    flags, then sums per campaign; both levels combine map-side.
    """
    t = F.col("type_event")
    flags = events.groupBy("campaign_id", "customer_id").agg(
        F.max(t.isin(*labels.clicked).cast("int")).alias("clicked"),
        F.max(t.isin(*labels.opened).cast("int")).alias("opened"))
    known = F.col("customer_id").isNotNull()
    per = flags.groupBy("campaign_id").agg(
        F.coalesce(F.sum(F.when(known, F.col("clicked"))), F.lit(0)).cast("long").alias("clickers"),
        F.coalesce(F.sum(F.when(known, F.col("opened"))), F.lit(0)).cast("long").alias("openers"))
    return per.withColumn("ctr", rate_or_zero("clickers", "openers"))


def user_ctr_from_engagement(engagement: DataFrame, campaigns: DataFrame,
                             labels: EventLabels = DEFAULT_LABELS) -> DataFrame:
    """CTR from the compacted engagement table: it has one row per (campaign,
    customer, type), so counting rows per type counts distinct people exactly
    (streams refuse exact distinct counts; this needs none).  ``campaigns`` has a row
    for every campaign seen (the compacted type counts): those without an open or a click
    are in the result too, with zeros."""
    t = F.col("type_event")
    per = engagement.filter(F.col("customer_id").isNotNull()).groupBy("campaign_id").agg(
        count_if(t.isin(*labels.clicked)).alias("clickers"),
        count_if(t.isin(*labels.opened)).alias("openers"))
    every = campaigns.select(F.col("campaign_id").alias("__c")).distinct()
    zero = F.lit(0).cast("long")
    full = every.join(per, F.col("__c").eqNullSafe(F.col("campaign_id")), "left").select(
        F.col("__c").alias("campaign_id"), F.coalesce("clickers", zero).alias("clickers"),
        F.coalesce("openers", zero).alias("openers"))
    return full.withColumn("ctr", rate_or_zero("clickers", "openers"))


def funnel(events: DataFrame, labels: EventLabels = DEFAULT_LABELS) -> DataFrame:
    """Customers reaching each funnel stage per campaign, and step rates.

    The furthest stage per (campaign, customer) is the max stage rank of its
    events; ``reached_k`` counts customers with furthest >= k.
    """
    return funnel_from_stages(furthest_stages(events, labels))


def funnel_from_stages(furthest: DataFrame) -> DataFrame:
    names = [s.lower() for s in FUNNEL_STAGES]
    per = furthest.groupBy("campaign_id").agg(
        *[count_if(F.col("furthest") >= i).alias(n) for i, n in enumerate(names, start=1)])
    rates = [rate_or_zero(names[i + 1], names[i]).alias(f"{names[i + 1]}_rate")
             for i in range(len(names) - 1)]
    return per.select("campaign_id", *names, *rates)


def deliverability(events: DataFrame, labels: EventLabels = DEFAULT_LABELS) -> DataFrame:
    """Per campaign: events, SPAM and HARD_BOUNCE counts and rates (% of events)."""
    return deliverability_from_counts(delivery_counts(events, labels))


def deliverability_from_counts(per: DataFrame) -> DataFrame:
    return per.select("campaign_id", "events", "spam", "hard_bounce",
                      rate_or_zero("spam", "events").alias("spam_rate"),
                      rate_or_zero("hard_bounce", "events").alias("bounce_rate"))


def repeat_engagement(engagement: DataFrame) -> DataFrame:
    """How many (campaign, customer) pairs opened / clicked exactly n times."""
    return (engagement.groupBy("type_event", "total_events")
            .agg(F.count(F.lit(1)).alias("pairs")))
