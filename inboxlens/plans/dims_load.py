"""Dimension load: landed JSON lines -> cleaned, typed tables and their quarantine.

Every table is split on its declared non-null fields; a rejected line is kept as it came
with the reason, so it can be loaded again once it is mended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dims
from ..schemas import (CAMPAIGN_SCHEMA, LANDED_CAMPAIGN_SCHEMA, LANDED_PRODUCT_SCHEMA, LANDED_USER_SCHEMA,
                       LINK_SCHEMA, PRODUCT_SCHEMA)
from ..sources import files

LANDED = {"product": LANDED_PRODUCT_SCHEMA, "users": LANDED_USER_SCHEMA, "campaign": LANDED_CAMPAIGN_SCHEMA}


def products(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Products: price text -> float (bad text 0.0; a missing price is rejected)."""
    schema = LANDED_PRODUCT_SCHEMA
    valid, rejected = files.split_records(files.parse_records(lines, schema), schema)
    clean, _ = dims.clean_prices(valid)
    return files.conform(clean, PRODUCT_SCHEMA), rejected


def users(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nested user records flattened to customer attributes."""
    schema = LANDED_USER_SCHEMA
    valid, rejected = files.split_records(files.parse_records(lines, schema), schema)
    return dims.flatten_users(valid), rejected


def campaigns(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Campaigns, their tag list joined to text."""
    schema = LANDED_CAMPAIGN_SCHEMA
    valid, rejected = files.split_records(files.parse_records(lines, schema), schema)
    return files.conform(dims.join_tags(valid, "tags"), CAMPAIGN_SCHEMA), rejected


def links(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The campaign -> product links of parsed campaign records.  A record that is a
    campaign but names no product has no link: it goes to the links' quarantine (a record
    that is no campaign is in the campaigns' own)."""
    good = files.split_records(parsed, LANDED_CAMPAIGN_SCHEMA)[0].columns
    whole = parsed.filter(F.col("_corrupt").isNull())
    for f in LANDED_CAMPAIGN_SCHEMA.fields:
        if not f.nullable:
            whole = whole.filter(F.col(f.name).isNotNull())
    has = F.col("product_id").isNotNull()
    rejected = whole.filter(~has).select(F.col("_raw").alias("raw"), F.lit("product_id").alias("reason"))
    return files.conform(dims.campaign_links(whole.filter(has).select(*good)), LINK_SCHEMA), rejected
