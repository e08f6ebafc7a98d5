"""Bounded reads of a topic that continue where the last one ended (S3).

A *bookmark* is a folder of numbered JSON notes; each names, for every partition of the
topic, the offset that the next read begins with.  ``take`` fixes the end of a read before
its rows are used, hands out the messages between bookmark and end, and writes the next note
only when it is told that they are dealt with.  So successive reads cover each message once;
a read that fails is repeated over the same offsets.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.changelog import numbers_in, path_exists

Offsets = Mapping[int, int]


@dataclass(frozen=True)
class BoundedTopic:
    """``ends(spark, starts)`` gives the offset after the last message of each partition at
    this moment, ``read(spark, starts, ends)`` the messages from starts (inclusive) to ends
    (exclusive); a partition that ``starts`` does not name begins with its earliest message."""

    ends: Callable[[SparkSession, Offsets], dict[int, int]]
    read: Callable[[SparkSession, Offsets, Offsets], DataFrame]


def _ends(messages: DataFrame, starts: Offsets) -> dict[int, int]:
    """One row for each partition comes to the driver."""
    found = messages.groupBy("partition").agg(F.max("offset").alias("last")).collect()
    return {**starts, **{r["partition"]: r["last"] + 1 for r in found}}


def kafka_topic(bootstrap: str, topic: str, partitions: int) -> BoundedTopic:
    """A topic of ``partitions`` partitions (a read names them all).  Only offsets are read to
    fix the end; partitions without a bookmark begin with their earliest message."""
    def offsets(at: Offsets, other: int) -> str:
        return json.dumps({topic: {str(p): at.get(p, other) for p in range(partitions)}})

    def records(spark: SparkSession, starts: Offsets, ends: str) -> DataFrame:
        return (spark.read.format("kafka").option("kafka.bootstrap.servers", bootstrap)
                .option("subscribe", topic).option("startingOffsets", offsets(starts, -2))
                .option("endingOffsets", ends).load())

    return BoundedTopic(
        lambda spark, starts: _ends(records(spark, starts, "latest").select("partition", "offset"), starts),
        lambda spark, starts, ends: records(spark, starts, offsets(ends, -1)).where(before(ends)))


def folder_topic(path: str) -> BoundedTopic:
    """Landed messages with ``partition`` and ``offset`` columns."""
    def after(spark: SparkSession, starts: Offsets) -> DataFrame:
        found = spark.read.parquet(path)
        passed = F.lit(False)
        for p, at in starts.items():
            passed = passed | ((F.col("partition") == p) & (F.col("offset") < at))
        return found.where(~passed)

    return BoundedTopic(lambda spark, starts: _ends(after(spark, starts).select("partition", "offset"), starts),
                        lambda spark, starts, ends: after(spark, starts).where(before(ends)))


def before(ends: Offsets):
    """Holds on the messages before ``ends``; a partition that has no end yet has none."""
    inside = F.lit(False)
    for p, at in ends.items():
        inside = inside | ((F.col("partition") == p) & (F.col("offset") < at))
    return inside


def bookmark(spark: SparkSession, path: str) -> tuple[int, dict[int, int]]:
    """The number of the newest complete note (-1: none) and its offsets."""
    done = [n for n in numbers_in(spark, path, "read=") if path_exists(spark, f"{path}/read={n}/_SUCCESS")]
    if not done:
        return -1, {}
    text = spark.read.text(f"{path}/read={done[-1]}").first()["value"]
    return done[-1], {int(p): at for p, at in json.loads(text).items()}


def take(spark: SparkSession, topic: BoundedTopic, path: str) -> tuple[DataFrame, Callable[[], None]]:
    """The messages since the bookmark at ``path``, and a function to call once they are
    dealt with, which moves it."""
    number, starts = bookmark(spark, path)
    ends = topic.ends(spark, starts)

    def done() -> None:
        note = json.dumps({str(p): at for p, at in sorted(ends.items())})
        spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite") \
            .text(f"{path}/read={number + 1}")

    return topic.read(spark, starts, ends), done
