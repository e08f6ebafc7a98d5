"""Distinct clickers and openers from mergeable sketches.

Distinct counts cannot be added: not over micro-batches, and not over campaigns either.
Each micro-batch leaves one HyperLogLog sketch for each campaign and kind of event
(``hll_sketch_agg``, built-in, of fixed size) in a folder of its own; sketches are united
when they are read (``hll_union_agg``), over batches, over campaigns or both.  A union is
idempotent, so neither a replayed batch nor a new epoch counts anyone twice, and the stream
keeps no state whatever the number of customers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import DEFAULT_LABELS, EventLabels
from .changelog import init_changelog, open_epoch, read_changelog
from .pipeline import TRIGGER, _await, _triggered, folder_sink

#: log2 of a sketch's registers, and the relative standard error it gives (1.04 / sqrt(registers)).
LG_K = 14
STATED_ERROR = 1.04 / 2 ** (LG_K / 2)


def reach_sketches(events: DataFrame, labels: EventLabels = DEFAULT_LABELS, lg_k: int = LG_K) -> DataFrame:
    """``(campaign_id, kind, people)``: a sketch of the customers who clicked or opened."""
    t = F.col("type_event")
    kind = F.when(t.isin(*labels.clicked), F.lit("clickers")).when(t.isin(*labels.opened), F.lit("openers"))
    return (events.select("campaign_id", kind.alias("kind"), "customer_id")
            .filter(F.col("kind").isNotNull() & F.col("customer_id").isNotNull())
            .groupBy("campaign_id", "kind").agg(F.hll_sketch_agg("customer_id", lg_k).alias("people")))


def united(sketches: DataFrame, by: Sequence[str] = ("campaign_id", "kind")) -> DataFrame:
    """One sketch for each group of ``by``: also the compaction of a long folder of batches."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("people").alias("people"))


def reach(sketches: DataFrame, by: Sequence[str] = ("campaign_id",)) -> DataFrame:
    """Estimated distinct ``clickers`` and ``openers`` per group of ``by`` (none: in all)."""
    people = united(sketches, (*by, "kind")).select(*by, "kind", F.hll_sketch_estimate("people").alias("n"))
    return people.groupBy(*by).agg(*[F.coalesce(F.max(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k)
                                     for k in ("clickers", "openers")])


def run_reach(events: DataFrame, path: str, checkpoint: str, name: str, available_now: bool = True,
              trigger: str = TRIGGER, wait: bool = True) -> StreamingQuery:
    """Stream typed events into a folder of sketches, one set for each micro-batch."""
    spark = events.sparkSession
    epoch = open_epoch(spark, path, checkpoint)
    init_changelog(spark, path, "campaign_id string, kind string, people binary", epoch=epoch)
    keep = folder_sink(path, epoch)
    writer = (events.writeStream.queryName(name).option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, n: keep(reach_sketches(batch), n)))
    q = _triggered(writer, available_now, trigger).start()
    if available_now and wait:
        _await(q)
    return q


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return read_changelog(spark, path).select("campaign_id", "kind", "people")
