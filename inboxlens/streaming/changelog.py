"""Update-mode changelog sink and its compaction (latest value per key).

An update-mode aggregate re-emits the new running total of every key touched
by a micro-batch.  ``changelog_sink`` stores each micro-batch's rows under
``epoch=<e>/batch_id=<n>/``, overwriting that directory, so a replayed batch
(after a failure, before its commit reached the checkpoint) replaces its own
output instead of duplicating it.  Readers must compact: summing a changelog
counts a total once per batch that touched it.

* An *epoch* is one checkpoint: with a new checkpoint (a resize, a rebuild) batch
  ids begin at 0 again, so readers take the newest epoch only.
* A batch is *committed* once the stream's checkpoint says so; before that its
  folder may still be written or replaced.  Snapshots stop at the last committed
  batch, so a row that lands late is never skipped.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_PLACE = ("epoch", "batch_id")


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists; any other failure raises."""
    fs, p = _path(spark, path)
    return fs.exists(p)


def mark(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if there is one already."""
    fs, p = _path(spark, path)
    return fs.createNewFile(p)


def marked_at(spark: SparkSession, path: str) -> int:
    """When a file was written, in milliseconds."""
    fs, p = _path(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it exists, with what is in it."""
    fs, p = _path(spark, path)
    fs.delete(p, True)


def numbers_in(spark: SparkSession, folder: str, prefix: str = "") -> list[int]:
    """The numbers in the names of a folder's entries, ascending."""
    if not path_exists(spark, folder):
        return []
    fs, p = _path(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[len(prefix):]) for n in names
                  if n.startswith(prefix) and n[len(prefix):].lstrip("-").isdigit())


def open_epoch(spark: SparkSession, sink: str | Sequence[str], checkpoint: str) -> int:
    """The epoch of a checkpoint, noted inside it at its first start; a new checkpoint
    gets a number above every epoch of the sink (or of several)."""
    sinks = [sink] if isinstance(sink, str) else sink
    note = f"{checkpoint.rstrip('/')}/epoch"
    if path_exists(spark, note):
        return spark.read.parquet(note).first()["epoch"]
    epoch = max([int(time.time() * 1000), *(e + 1 for s in sinks for e in numbers_in(spark, s, "epoch="))])
    spark.createDataFrame([(epoch,)], "epoch long").write.mode("overwrite").parquet(note)
    return epoch


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch that the checkpoint holds as committed (-1: none)."""
    return max(numbers_in(spark, f"{checkpoint.rstrip('/')}/commits"), default=-1)


def changelog_sink(path: str, partition_by: Sequence[str] = (), epoch: int = 0):
    """A ``foreachBatch`` function writing each micro-batch to its own folder
    (optionally sub-partitioned, e.g. by a computed ``topic`` column)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{path}/epoch={epoch}/batch_id={batch_id}")
    return write


def init_changelog(spark: SparkSession, path: str, schema: StructType,
                   partition_by: Sequence[str] = (), epoch: int = 0) -> None:
    """Create the sink with an empty, typed ``batch_id=-1`` part so it can always
    be read back, also when the stream delivered nothing."""
    empty = spark.createDataFrame([], schema)
    leaf = f"{path}/epoch={epoch}/batch_id=-1"
    if partition_by:  # data files must sit at the same depth as the real batches
        empty = empty.drop(*partition_by)
        leaf += "".join(f"/{c}=__empty__" for c in partition_by)
    empty.write.mode("overwrite").parquet(leaf)


def read_changelog(spark: SparkSession, path: str, epoch: int | None = None) -> DataFrame:
    """The rows and ``batch_id`` of one epoch (the newest unless given)."""
    epoch = max(numbers_in(spark, path, "epoch=")) if epoch is None else epoch
    folder = f"{path}/epoch={epoch}"
    return spark.read.parquet(folder)


def batches_after(spark: SparkSession, path: str, epoch: int, batch_id: int) -> list[str]:
    """The folders of the complete batches that follow ``batch_id``.  Batch ids have no gaps,
    so the folders are asked for by name until one is missing or unfinished: the history
    before is neither listed nor opened."""
    found = []
    while path_exists(spark, f"{path}/epoch={epoch}/batch_id={batch_id + 1}/_SUCCESS"):
        batch_id += 1
        found.append(f"{path}/epoch={epoch}/batch_id={batch_id}")
    return found


def latest_per_key(changelog: DataFrame, keys: Sequence[str],
                   order_col: str = "batch_id") -> DataFrame:
    """The value columns of the latest changelog row per key (``max_by``): the general
    case, for values that may also fall."""
    values = [c for c in changelog.columns if c not in keys and c != order_col]
    latest = F.max_by(F.struct(*[F.col(c) for c in values]), F.col(order_col)).alias("__v")
    return (changelog.groupBy(*keys).agg(latest)
            .select(*keys, *[F.col(f"__v.{c}").alias(c) for c in values]))


def totals_per_key(changelog: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Compaction for running totals, which only grow within an epoch: the maximum of
    every value column per key.  Plain maxima are a hash aggregate with a map-side part;
    ``latest_per_key`` sorts on both sides of its shuffle."""
    values = [c for c in changelog.columns if c not in keys and c not in _PLACE]
    return changelog.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])


def max_per_key(changelog: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``totals_per_key`` for one value column."""
    return changelog.groupBy(*keys).agg(F.max(value).alias(value))


# --- snapshots: bounded reads of a long-running changelog ------------------

def _newest(spark: SparkSession, path: str, snapshot_root: str) -> tuple[int | None, int | None]:
    """Newest epoch of the sink, and the last batch that its snapshot holds."""
    epochs = numbers_in(spark, path, "epoch=")
    if not epochs:
        return None, None
    held = numbers_in(spark, f"{snapshot_root}/epoch={epochs[-1]}", "upto=")
    # a snapshot counts once its write is complete
    done = [n for n in held if path_exists(spark, f"{snapshot_root}/epoch={epochs[-1]}/upto={n}/_SUCCESS")]
    return epochs[-1], done[-1] if done else None


def _after(spark: SparkSession, path: str, epoch: int, upto: int | None) -> DataFrame | None:
    if upto is None:
        return read_changelog(spark, path, epoch)
    folder = f"{path}/epoch={epoch}"
    paths = batches_after(spark, path, epoch, upto)
    return spark.read.option("basePath", folder).parquet(*paths) if paths else None


def _merged(spark: SparkSession, path: str, keys: Sequence[str], snapshot_root: str, epoch: int,
            prev: int | None, upto: int | None = None) -> DataFrame:
    """Totals of the snapshot ``prev`` and the batches after it (to ``upto``)."""
    base = None if prev is None else spark.read.parquet(f"{snapshot_root}/epoch={epoch}/upto={prev}")
    tail = _after(spark, path, epoch, prev)
    if tail is None:
        return base
    if upto is not None:
        tail = tail.filter(F.col("batch_id") <= upto)
    tail = tail.drop("batch_id")
    return totals_per_key(tail if base is None else base.unionByName(tail), keys)


def snapshot(spark: SparkSession, changelog_path: str, keys: Sequence[str], snapshot_root: str,
             checkpoint: str, prune: bool = False) -> int | None:
    """Write the totals per key up to the last committed batch N as
    ``epoch=<e>/upto=<N>/``; returns N (None if there is none).

    It starts from the previous snapshot and opens only the batches after it, so the
    work is bounded by the keys plus the new batches.  ``prune`` then deletes the
    folders of batches that the *previous* snapshot already held, the snapshots before
    that one, and older epochs: a reader that began with that snapshot does not miss them.
    """
    epoch, prev = _newest(spark, changelog_path, snapshot_root)
    upto = committed_batch(spark, checkpoint)
    if epoch is None or upto < 0:
        return None
    if prev is not None and prev >= upto:
        return prev
    _merged(spark, changelog_path, keys, snapshot_root, epoch, prev, upto).write.mode("overwrite") \
        .parquet(f"{snapshot_root}/epoch={epoch}/upto={upto}")
    if prune:
        old = [f"{changelog_path}/epoch={epoch}/batch_id={n}"
               for n in numbers_in(spark, f"{changelog_path}/epoch={epoch}", "batch_id=")
               if prev is not None and 0 <= n <= prev]
        old += [f"{changelog_path}/epoch={e}" for e in numbers_in(spark, changelog_path, "epoch=") if e < epoch]
        old += [f"{snapshot_root}/epoch={epoch}/upto={n}"
                for n in numbers_in(spark, f"{snapshot_root}/epoch={epoch}", "upto=")
                if prev is not None and n < prev]
        old += [f"{snapshot_root}/epoch={e}" for e in numbers_in(spark, snapshot_root, "epoch=") if e < epoch]
        for folder in old:
            delete(spark, folder)
    return upto


def read_latest(spark: SparkSession, changelog_path: str, keys: Sequence[str],
                snapshot_root: str | None = None) -> DataFrame:
    """Totals per key: newest snapshot + only the batches after it."""
    if snapshot_root is None:
        return totals_per_key(read_changelog(spark, changelog_path), keys)
    epoch, prev = _newest(spark, changelog_path, snapshot_root)
    return _merged(spark, changelog_path, keys, snapshot_root, epoch, prev)
