"""Appends that take effect once.

A micro-batch can be handed to its sink again: the write fails part of the way, or the job
ends between the write and the checkpoint's commit.  A folder of the batch's own is simply
written over; a table or a topic that can only be appended to would hold the rows twice.

``once_sink`` notes in a ledger folder that a batch was *begun* before its first row is sent
and *applied* after its last.  A batch applied before is not sent again.  One that was begun
only may have left any part of its rows: what the target holds of the batch is read back (its
rows carry ``epoch`` and ``batch_id``) and the rest, counted with repeats, is appended.  The
target is read in that case alone.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .changelog import delete, mark, marked_at, path_exists

TAGS = ("epoch", "batch_id")
_KEPT = 100  # batches whose notes stay; only the last one can come again


@dataclass(frozen=True)
class Target:
    """Something that rows are appended to: ``append(rows)``, and ``held(spark, epoch,
    batch_id, since)`` with the rows it has of a batch (None: it does not exist yet) that was
    begun at ``since`` (milliseconds)."""

    append: Callable[[DataFrame], None]
    held: Callable[[SparkSession, int, int, int], DataFrame | None]


def once_sink(target: Target, ledger: str, epoch: int):
    """A ``foreachBatch`` function that appends each micro-batch to ``target`` once.  One
    ledger folder serves one target."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        notes = f"{ledger}/epoch={epoch}"
        begun, applied = (f"{notes}/batch_id={batch_id}/{what}" for what in ("begun", "applied"))
        if path_exists(spark, applied):
            return
        rows = batch.withColumns({"epoch": F.lit(epoch).cast("long"), "batch_id": F.lit(batch_id).cast("long")})
        if not mark(spark, begun):
            there = target.held(spark, epoch, batch_id, marked_at(spark, begun))
            if there is not None:
                # read back before the append changes what is read
                rows = rows.exceptAll(there.select(*rows.columns)).persist()
                rows.count()
        try:
            target.append(rows)
        finally:
            rows.unpersist()
        mark(spark, applied)
        delete(spark, f"{notes}/batch_id={batch_id - _KEPT}")
    return write
