"""Dimension loads: typed ingest of landed records, cleaning and flattening.

Records arrive as landed rows (JSON/Parquet read with a declared schema); every
step is a column expression, no driver-side loops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CUSTOMER_SCHEMA
from ..sources.files import conform


def clean_prices(landed: DataFrame, price_col: str = "price") -> tuple[DataFrame, DataFrame]:
    """Price text -> float: unparseable text becomes 0.0; a missing price is a
    contract violation and goes to quarantine.  Returns (valid, quarantine)."""
    parsed = F.coalesce(F.expr(f"try_cast({price_col} AS FLOAT)"), F.lit(0.0).cast("float"))
    valid = (landed.filter(F.col(price_col).isNotNull())
             .withColumn(price_col, parsed))
    rejected = (landed.filter(F.col(price_col).isNull())
                .withColumn("reason", F.lit(price_col)))
    return valid, rejected


def campaign_links(landed_campaigns: DataFrame) -> DataFrame:
    """(product_id, campaign_id, linked_by) link rows from landed campaigns."""
    return landed_campaigns.select(
        F.col("product_id").cast("int").alias("product_id"),
        F.col("uuid_campaign").alias("campaign_id"),
        F.col("created_by").alias("linked_by"))


def tag_counts(df: DataFrame, tags_col: str = "tags", sep: str = ", ") -> DataFrame:
    """Occurrences of each tag in a ``sep``-joined tag list column."""
    return (df.select(F.explode(F.split(F.col(tags_col), sep)).alias("tag"))
            .filter(F.col("tag") != "")
            .groupBy("tag").agg(F.count(F.lit(1)).alias("n")))


def join_tags(tags: DataFrame, array_col: str, sep: str = ", ") -> DataFrame:
    """Array of tags -> one ``sep``-joined string column (as stored)."""
    return tags.withColumn(array_col, F.array_join(F.col(array_col), sep))


def flatten_users(users: DataFrame, key: str = "user_key") -> DataFrame:
    """Nested user records -> flat customer attributes.

    ``name_customer = first + ' ' + last``; the e-mail is
    ``<first>-<email_number>@<email_domain>.com.co``, null when a part is missing.
    """
    email = F.concat(F.col("name.first"), F.lit("-"), F.col("email_number").cast("string"), F.lit("@"),
                     F.col("email_domain"), F.lit(".com.co"))
    return users.select(
        F.col(key).alias("id"),
        email.alias("email"),
        F.concat_ws(" ", F.col("name.first"), F.col("name.last")).alias("name_customer"),
        F.col("location.timezone.description").alias("description_customer"),
        F.col("gender"),
        F.col("location.country").alias("country"),
        F.col("location.city").alias("city"),
        F.col("location.state").alias("state"))


def audience(events: DataFrame, users_flat: DataFrame) -> DataFrame:
    """The customers table: one row per (campaign, customer) the campaign reached,
    with the customer's attributes.  Built from the distinct pairs seen in events
    and an equi-join on the customer key (no campaign x user product)."""
    pairs = events.select("campaign_id", F.col("customer_id").alias("id")).distinct()
    return pairs.join(users_flat, "id", "inner").select(
        "id", "campaign_id", "email", "name_customer", "description_customer", "gender",
        "country", "city", "state")


def customers_table(events: DataFrame, users_flat: DataFrame) -> DataFrame:
    """The customers table in its declared columns and types, key (campaign_id, id)."""
    return conform(audience(events, users_flat), CUSTOMER_SCHEMA)
