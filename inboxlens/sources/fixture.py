"""Adapter from the generated test tables to the campaign-event data model.

Every frame here is a lazy plan over the whole parquet tables; nothing is
collected or sampled.  The stand-in rules (which generated column plays which
role) are documented in FIXTURES.md.

* events    <- events (+ customer/nation/region for geography, left join so no
               event is lost; geography is only joined when a query needs it)
* campaigns <- supplier (all rows)
* products  <- part (all rows)
* users     <- customer (+ nation/region) as nested user records
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..functions import utc

# Stand-in labels for the generated event types (anything else -> SPAM),
# the campaign and product fan-out, and the five user agents picked by event_id % 5.
TYPE_STAND_INS = (("signup", "SENT"), ("purchase", "DELIVERED"), ("view", "OPENED"),
                  ("click", "CLICKED"))
OTHER_TYPE = "SPAM"
N_CAMPAIGNS = 20
N_LINKED_PRODUCTS = 50
N_LINK_PRODUCTS = 21
N_EMAIL_DOMAINS = 10
USER_AGENTS = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/120.0 Safari/537.36",
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; Trident/5.0)",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) AppleWebKit/605.1.15 "
    "(KHTML, like Gecko) Version/17.0 Mobile/15E148 Safari/604.1",
    "curl/8.0",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def campaign_key(k: Column) -> Column:
    return F.concat(F.lit("cmp-"), k.cast("string"))


def _type_event() -> Column:
    expr = None
    for raw, label in TYPE_STAND_INS:
        cond = F.col("event_type") == raw
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(OTHER_TYPE))


def with_geography(spark: SparkSession, sf_dir: str, df: DataFrame,
                   key: str = "customer_id") -> DataFrame:
    """Add country, city, state to rows keyed by customer id (left joins).

    The fact rows join ``customer`` first, so Catalyst sizes that join from the
    customer scan alone (broadcast while small, sort-merge join beyond); nation
    and region are fixed-size (25 and 5 rows) and join last.  Joining them to
    customer first would make the estimate the product of three table sizes and
    force a shuffle of the fact side even when customer is tiny.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (df.join(customer, F.col(key) == F.col("c_custkey"), "left")
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
              .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
              .withColumnRenamed("r_name", "country")
              .withColumnRenamed("n_name", "city")
              .withColumnRenamed("c_mktsegment", "state")
              .drop("c_custkey", "c_nationkey", "n_nationkey", "n_regionkey", "r_regionkey"))


def _event_time(e: DataFrame) -> Column:
    """``ts`` is UTC: wall time in the files, whatever zone the session has."""
    return utc.instant("ts") if isinstance(e.schema["ts"].dataType, TimestampNTZType) else F.col("ts")


def events(spark: SparkSession, sf_dir: str, geo: bool = True,
           keep_event_id: bool = False) -> DataFrame:
    """Typed events in the reference shape (``schemas.EVENT_SCHEMA``).

    With ``geo=False`` the country/city/state columns are absent rather than null,
    so a query that needs them fails loudly instead of silently grouping nulls.
    """
    e = table(spark, sf_dir, "events")
    agents = F.array(*[F.lit(a) for a in USER_AGENTS])
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    cols = [
        F.col("user_id").alias("customer_id"),
        campaign_key(k % F.lit(N_CAMPAIGNS)).alias("campaign_id"),
        _type_event().alias("type_event"),
        _event_time(e).alias("event_date"),
        F.lit(None).cast("string").alias("gender"),
        F.lit(None).cast("string").alias("email"),
        F.element_at(agents, (F.pmod(F.col("event_id"), F.lit(len(USER_AGENTS))) + 1).cast("int"))
         .alias("user_agent"),
        F.when(F.col("event_type") == "click",
               (F.col("event_id") % F.lit(N_LINKED_PRODUCTS)).cast("int")).alias("product_id"),
    ]
    if keep_event_id:
        cols.append(F.col("event_id"))
    out = e.select(*cols)
    if not geo:
        return out
    joined = with_geography(spark, sf_dir, out)
    order = ["customer_id", "campaign_id", "type_event", "event_date", "gender", "email",
             "user_agent", "country", "city", "state", "product_id"]
    if keep_event_id:
        order.append("event_id")
    return joined.select(*order)


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign dimension: one campaign per supplier row."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        campaign_key(F.col("s_suppkey")).alias("uuid_campaign"),
        F.col("s_name").alias("name"),
        F.col("s_name").alias("created_by"),
        F.lit(None).cast("string").alias("description"),
        (F.col("s_acctbal") >= 0).alias("valid_campaign"),
        F.lit(None).cast("string").alias("tags"),
    )


def landed_campaign_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign records as landed, each naming the product it promotes."""
    s = table(spark, sf_dir, "supplier")
    return s.select(
        campaign_key(F.col("s_suppkey")).alias("uuid_campaign"),
        F.col("s_name").alias("created_by"),
        (F.col("s_suppkey") % F.lit(N_LINK_PRODUCTS) + 1).cast("int").alias("product_id"),
    )


def landed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as landed from a product API: price arrives as text.

    Text is the decimal rendering of p_retailprice, with a comma decimal
    ('12,5') on every 7th key and missing on every 11th key, so the cleaning
    rules see both kinds of bad input.  Tags are the words of p_name.
    """
    p = table(spark, sf_dir, "part")
    price_text = (F.when(F.col("p_partkey") % 11 == 0, F.lit(None).cast("string"))
                  .when(F.col("p_partkey") % 7 == 0, F.lit("12,5"))
                  .otherwise(F.col("p_retailprice").cast("string")))
    return p.select(
        F.col("p_partkey").cast("int").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("description"),
        F.col("p_type").alias("category"),
        F.lit(None).cast("string").alias("image"),
        price_text.alias("price"),
        F.regexp_replace(F.col("p_name"), " ", ", ").alias("tags"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension with a numeric price (``schemas.PRODUCT_SCHEMA`` + tags)."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("description"),
        F.col("p_type").alias("category"),
        F.lit(None).cast("string").alias("image"),
        F.col("p_retailprice").cast("float").alias("price"),
    )


def user_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested user records (``schemas.USER_RECORD_SCHEMA``) keyed by ``user_key``."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    c = (table(spark, sf_dir, "customer")
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
         .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    name_parts = F.split(F.col("c_name"), "#")
    return c.select(
        F.col("c_custkey").alias("user_key"),
        F.struct(F.try_element_at(name_parts, F.lit(1)).alias("first"),
                 F.try_element_at(name_parts, F.lit(2)).alias("last")).alias("name"),
        F.lit(None).cast("string").alias("gender"),
        F.struct(F.col("r_name").alias("country"), F.col("n_name").alias("city"),
                 F.col("c_mktsegment").alias("state"),
                 F.struct(F.concat_ws("/", F.col("r_name"), F.col("n_name")).alias("description"))
                  .alias("timezone")).alias("location"),
        F.col("c_custkey").alias("email_number"),
        F.concat(F.lit("d"), (F.col("c_custkey") % N_EMAIL_DOMAINS).cast("string")).alias("email_domain"),
    )


def landed_lines(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dimension records as landed JSON lines (``value``), with the damage real feeds have:
    products without a price (every 11th key), users without a key (every 7th), campaigns
    without a name (keys 0 mod 5), without a product (2 mod 5) or cut short (1 mod 5)."""
    p = landed_products(spark, sf_dir).drop("tags")
    u = user_records(spark, sf_dir)
    key = F.col("user_key")
    u = u.select(F.when(key % 7 != 0, key).alias("user_key"), "name", "email_number")
    k = F.col("s_suppkey")
    c = table(spark, sf_dir, "supplier").select(
        k, F.to_json(F.struct(
            campaign_key(k).alias("uuid_campaign"), F.when(k % 5 != 0, F.col("s_name")).alias("name"),
            F.col("s_name").alias("created_by"),
            F.when(k % 5 != 2, (k % F.lit(N_LINK_PRODUCTS) + 1).cast("int")).alias("product_id"))).alias("line"))
    return {
        "product": p.select(F.to_json(F.struct(*p.columns)).alias("value")),
        "users": u.select(F.to_json(F.struct(*u.columns)).alias("value")),
        "campaign": c.select(F.when(k % 5 == 1, F.expr("substring(line, 1, 20)")).otherwise(F.col("line"))
                             .alias("value")),
    }


def event_messages(spark: SparkSession, sf_dir: str, corrupt: bool = False) -> DataFrame:
    """The events topic as (key, value) JSON messages built from the events table.

    With ``corrupt=True`` a deterministic share of the messages is damaged the way
    real feeds break (``event_id % 97``: 0 unparseable JSON, 1 bad timestamp text,
    2 a 31-character city, 3 no campaign id, 4 a product on an event of any type); every
    message is kept.
    """
    from ..operators.decode import encode_events

    ev = events(spark, sf_dir, geo=True, keep_event_id=True)
    if corrupt:
        m = F.col("event_id") % 97
        ev = (ev.withColumn("city", F.when(m == 2, F.rpad(F.coalesce(F.col("city"), F.lit("")), 31, "#"))
                            .otherwise(F.col("city")))
                .withColumn("campaign_id", F.when(m == 3, F.lit(None).cast("string"))
                            .otherwise(F.col("campaign_id")))
                .withColumn("product_id", F.when(m == 4, (F.col("event_id") % F.lit(N_LINKED_PRODUCTS)).cast("int"))
                            .otherwise(F.col("product_id"))))
        msgs = encode_events(ev, extra=["event_id"],
                             event_date_text=F.when(m == 1, F.lit("bad")))
        return msgs.select(
            "key",
            F.when(m == 0, F.concat(F.lit("not json "), F.col("key"))).otherwise(F.col("value"))
             .alias("value"),
            "event_date")
    return encode_events(ev, extra=[]).select("key", "value", "event_date")
