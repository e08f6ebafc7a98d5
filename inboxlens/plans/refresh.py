"""Gold refresh: dashboard tables recomputed from the compacted silver totals.

A refresh first brings the snapshot of every silver changelog up to the last committed
micro-batch (reading only the batches since the snapshot before), then derives all gold
tables from the snapshots, which hold one row per key: no history is read again and
nothing needs to be kept in memory.  The tables of a refresh, stamped with ``computed_at``,
are a new version, ``<root>/gold/version=N/<name>``, that counts once all of them are
written (its marker is the last file).  Readers take the newest version that counts, so they
see all tables of one refresh or of the one before, never a mixture or half a table.  Run it
on a schedule for a refreshing dashboard.
"""

from __future__ import annotations

import os
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..operators import gold, silver
from ..streaming.changelog import numbers_in, delete, mark, path_exists, read_latest, snapshot
from ..streaming.pipeline import with_freshness

#: The running aggregates and their keys; every value of theirs only grows.
SILVER = {
    "city": (silver.campaign_city_counts, ["campaign_id", "city"]),
    "types": (silver.campaign_type_counts, ["campaign_id"]),
    "engagement": (silver.engagement_counts, ["campaign_id", "customer_id", "type_event"]),
    "products": (silver.product_counts, ["product_id"]),
    "stages": (silver.furthest_stages, ["campaign_id", "customer_id"]),
    "delivery": (silver.delivery_counts, ["campaign_id"]),
    "agents": (silver.agent_counts, ["campaign_id", "user_agent"]),
}


def silver_paths(root: str, name: str) -> tuple[str, str, str]:
    """Changelog, checkpoint and snapshot folders of a silver aggregate."""
    base = os.path.join(root, "silver", name)
    return tuple(os.path.join(base, part) for part in ("changelog", "checkpoint", "snapshots"))


def snapshot_silver(spark: SparkSession, root: str, prune: bool = False) -> dict[str, int | None]:
    """Bring every silver snapshot up to the last committed batch (independent jobs,
    submitted together)."""
    def one(name: str) -> int | None:
        log, checkpoint, snaps = silver_paths(root, name)
        return snapshot(spark, log, SILVER[name][1], snaps, checkpoint, prune)

    with ThreadPoolExecutor(max_workers=len(SILVER)) as pool:
        return dict(zip(SILVER, pool.map(one, SILVER), strict=True))


def compacted_silver(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Totals per key of each silver aggregate: newest snapshot and the batches after it."""
    out = {}
    for name, (_, keys) in SILVER.items():
        log, _, snaps = silver_paths(root, name)
        out[name] = read_latest(spark, log, keys, snaps)
    return out


def gold_from_silver(tables: dict[str, DataFrame], campaigns: DataFrame,
                     products: DataFrame | None = None,
                     customers: DataFrame | None = None) -> dict[str, DataFrame]:
    """The dashboard tables from compacted silver tables."""
    engagement = tables["engagement"]
    effectiveness = gold.campaign_effectiveness(engagement, campaigns)
    out = {
        "city_top10": gold.city_top_from_silver(tables["city"]),
        "campaign_effectiveness": effectiveness,
        "click_share": gold.click_share(effectiveness),
        "campaign_types": tables["types"],
        "repeat_engagement": gold.repeat_engagement(engagement),
        "user_ctr": gold.user_ctr_from_engagement(engagement, tables["types"]),
        "funnel": gold.funnel_from_stages(tables["stages"]),
        "deliverability": gold.deliverability_from_counts(tables["delivery"]),
        "client_mix": silver.client_mix_from_agents(tables["agents"]),
    }
    if products is not None:
        ranking = gold.product_ranking(tables["products"], products)
        out["product_popularity"] = ranking
        out["best_product"] = gold.best_product(ranking)
    if customers is not None:
        out["header"] = gold.header_from_silver(tables["city"], customers)
    return out


def _version(root: str, number: int, *parts: str) -> str:
    return os.path.join(root, "gold", f"version={number}", *parts)


def gold_versions(spark: SparkSession, root: str) -> list[int]:
    """The complete versions, oldest first."""
    return [n for n in numbers_in(spark, os.path.join(root, "gold"), "version=")
            if path_exists(spark, _version(root, n, "_COMPLETE"))]


def read_gold(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The dashboard tables of the newest complete version (or of a given one)."""
    done = gold_versions(spark, root)
    if not done:
        raise FileNotFoundError(f"no complete gold version below {root}")
    number = done[-1] if version is None else version
    names = [r["name"] for r in spark.read.parquet(_version(root, number, "_tables")).collect()]
    return {name: spark.read.parquet(_version(root, number, name)) for name in names}


def refresh_gold(spark: SparkSession, root: str, campaigns: DataFrame, products: DataFrame | None = None,
                 customers: DataFrame | None = None, prune: bool = False, keep: int = 3) -> dict[str, str]:
    """Snapshot the silver changelogs below ``root`` and write every gold table as a new
    version; the newest ``keep`` versions stay for readers that have begun.  One refresh runs
    at a time."""
    snapshot_silver(spark, root, prune)
    tables = gold_from_silver(compacted_silver(spark, root), campaigns, products, customers)
    number = max([int(time.time() * 1000), *(n + 1 for n in numbers_in(spark, os.path.join(root, "gold"), "version="))])
    paths = {name: _version(root, number, name) for name in tables}

    def write(name: str) -> None:
        with_freshness(tables[name]).write.mode("overwrite").parquet(paths[name])

    # small independent jobs: submitted together, they share the executors
    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        for done in [pool.submit(write, name) for name in tables]:
            done.result()
    spark.createDataFrame([(name,) for name in sorted(paths)], "name string").coalesce(1) \
        .write.parquet(_version(root, number, "_tables"))
    mark(spark, _version(root, number, "_COMPLETE"))
    oldest = gold_versions(spark, root)[-keep:][0]
    for n in numbers_in(spark, os.path.join(root, "gold"), "version="):
        if n < oldest:  # also what a broken refresh left
            delete(spark, _version(root, n))
    return paths
