"""Landing of the event topic as files (the producer's role, for file-based streams).

The broker connector is not part of this environment, so a stream reads a
directory of message files instead of a topic.  Messages are written once, sorted
into event-time ranges, one file a range, so the files' order is time order; a stream
that reads ``files_per_slice`` of them per trigger sees one slice of the time per
micro-batch, as a live topic would deliver them.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import fresh_dir
from .changelog import _path, path_exists

MESSAGE_SCHEMA = StructType([StructField("key", StringType()), StructField("value", StringType())])


@dataclass(frozen=True)
class Landing:
    path: str
    files_per_trigger: int
    slices: int


def land_messages(spark: SparkSession, messages: DataFrame, slices: int = 5,
                  files_per_slice: int | None = None, path: str | None = None,
                  columns: Sequence[str] = ("key", "value")) -> Landing:
    """Write (key, value, event_date) messages as ``slices`` time-ordered batches, with
    ``columns`` of theirs.

    One pass: a range partitioning by time (messages without a time first) deals the rows
    into ``slices * files_per_slice`` files, named and dated in their order.
    """
    path = path or fresh_dir(spark, "landing")
    # one writer task per core and slice: the write (and each micro-batch's read) scales
    # with the cluster instead of a fixed file count
    files_per_slice = files_per_slice or _parallelism(spark)
    (messages.repartitionByRange(slices * files_per_slice, F.col("event_date").asc_nulls_first(),
                                 F.xxhash64("value"))
     .select(*columns).write.mode("append").parquet(path))
    _date_in_order(spark, path)
    return Landing(path, files_per_slice, slices)


def _date_in_order(spark: SparkSession, path: str) -> None:
    """Date the files of the newest write in the order of their names: its tasks end in any
    order, and a stream takes files by their time first."""
    fs, p = _path(spark, path)
    files = [f for f in fs.listStatus(p) if f.getPath().getName().startswith("part-")]
    by_write = {}
    for f in files:  # part-<number>-<write id>...
        number, write = f.getPath().getName().split("-", 2)[1:]
        by_write.setdefault(write, []).append((int(number), f))
    newest = max(by_write.values(), key=lambda fs: max(f.getModificationTime() for _, f in fs), default=[])
    now = int(time.time() * 1000)
    for i, (_, f) in enumerate(sorted(newest, key=lambda x: x[0])):
        fs.setTimes(f.getPath(), now + i, -1)


def _parallelism(spark: SparkSession) -> int:
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # no SparkContext in this client (e.g. a Connect session)
        return int(spark.conf.get("spark.sql.shuffle.partitions", "8"))


_LANDINGS: dict[tuple, Landing] = {}


def landed_events(spark: SparkSession, sf_dir: str, corrupt: bool = False) -> Landing:
    """The events topic of a scale directory, landed once per application."""
    from ..sources import fixture

    key = (spark.sparkContext.applicationId, sf_dir, corrupt)
    if key not in _LANDINGS or not path_exists(spark, _LANDINGS[key].path):
        _LANDINGS[key] = land_messages(spark, fixture.event_messages(spark, sf_dir, corrupt))
    return _LANDINGS[key]
