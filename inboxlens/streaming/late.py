"""Windows that account for every row: what arrives behind the watermark is kept apart.

Spark's own windowed state drops late rows and reports only their number.  Here each
micro-batch is split by a watermark that is noted per batch: the greatest event time of all
batches before it, less the delay, as Spark computes it.  Rows whose last window has ended by
then go to a *late* folder; the others are counted into their windows, one partial count for
each window and batch, which readers add up.  No state is held, a replayed batch finds the
watermark it had before and writes over its own folders, and input = windows + late.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import silver
from ..schemas import EVENT_SCHEMA, WATERMARK_DELAY
from .changelog import delete, init_changelog, numbers_in, open_epoch, path_exists, read_changelog
from .pipeline import TRIGGER, _await, _triggered

_KEPT = 100  # notes that stay; only that of the last batch is read


def _note(path: str, epoch: int, batch_id: int) -> str:
    return f"{path}/watermark/epoch={epoch}/batch_id={batch_id}"


def _newest_before(spark: SparkSession, path: str, epoch: int, batch_id: int) -> int | None:
    """The greatest event time (microseconds) of the batches before ``batch_id``."""
    done = [n for n in numbers_in(spark, f"{path}/watermark/epoch={epoch}", "batch_id=")
            if n < batch_id and path_exists(spark, f"{_note(path, epoch, n)}/_SUCCESS")]
    return spark.read.schema("newest long").parquet(_note(path, epoch, done[-1])).first()["newest"] if done else None


def _micros(interval: str) -> int:
    n, unit = interval.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1_000_000


def windows_and_late(path: str, epoch: int, duration: str, delay: str = WATERMARK_DELAY,
                     windows: Callable[[DataFrame, str], DataFrame] = silver.activity_windows):
    """A ``foreachBatch`` function over typed events: partial window counts to
    ``path/windows``, late rows as they came to ``path/late``, both by epoch and batch.
    Windows are tumbling and aligned to the epoch; a row is late once its window has ended."""
    span = _micros(duration)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            before = _newest_before(spark, path, epoch, batch_id)
            at = F.unix_micros("event_date")
            end = at - F.pmod(at, F.lit(span)) + F.lit(span)
            late = F.lit(False) if before is None else F.coalesce(
                end <= F.lit(before - _micros(delay)), F.lit(False))
            newest = batch.agg(F.max(at)).first()[0]
            windows(batch.filter(~late), duration).write.mode("overwrite") \
                .parquet(f"{path}/windows/epoch={epoch}/batch_id={batch_id}")
            batch.filter(late).write.mode("overwrite").parquet(f"{path}/late/epoch={epoch}/batch_id={batch_id}")
            newest = max((t for t in (before, newest) if t is not None), default=None)
            if newest is not None:
                spark.createDataFrame([(newest,)], "newest long").write.mode("overwrite") \
                    .parquet(_note(path, epoch, batch_id))
            delete(spark, _note(path, epoch, batch_id - _KEPT))
        finally:
            batch.unpersist()
    return write


def run_windows(events: DataFrame, path: str, checkpoint: str, name: str, duration: str = "1 day",
                delay: str = WATERMARK_DELAY, available_now: bool = True, trigger: str = TRIGGER,
                wait: bool = True) -> StreamingQuery:
    """Stream typed events (without a watermark of their own) through ``windows_and_late``."""
    spark = events.sparkSession
    epoch = open_epoch(spark, [f"{path}/windows", f"{path}/late"], checkpoint)
    empty = spark.createDataFrame([], EVENT_SCHEMA)
    init_changelog(spark, f"{path}/windows", silver.activity_windows(empty, duration).schema, epoch=epoch)
    init_changelog(spark, f"{path}/late", EVENT_SCHEMA, epoch=epoch)
    writer = (events.writeStream.queryName(name).option("checkpointLocation", checkpoint)
              .foreachBatch(windows_and_late(path, epoch, duration, delay)))
    q = _triggered(writer, available_now, trigger).start()
    if available_now and wait:
        _await(q)
    return q


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """Events per window: the partial counts of all batches added up."""
    parts = read_changelog(spark, f"{path}/windows")
    keys = [c for c in parts.columns if c not in ("epoch", "batch_id", "events")]
    return parts.groupBy(*keys).agg(F.sum("events").cast("long").alias("events"))


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """The late rows, with the batch that brought them."""
    return read_changelog(spark, f"{path}/late")
