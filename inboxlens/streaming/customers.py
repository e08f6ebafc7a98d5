"""The customers table kept up to date from a stream of customer records.

Records arrive as (key, value, partition, offset) messages: the value is the JSON of a
customer row, the key its id, so all versions of a row lie in one partition of the topic and
its greatest offset is the newest.

The table is dealt into buckets by a hash of its key.  A micro-batch rewrites the buckets it
touches, into a folder of its own, and publishes a *manifest*: the folder of every bucket as
of that batch.  Readers take the newest complete manifest, so they see whole batches only and
never a half-written one.  A replayed batch starts from the manifest before it and writes over
its own folder; a new checkpoint reads the topic from its beginning again, where a row that is
not newer than the one held changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..schemas import CUSTOMER_SCHEMA
from ..sources import files
from .changelog import delete, numbers_in, open_epoch, path_exists
from .pipeline import TRIGGER, _await, _triggered, folder_sink

KEYS = ("campaign_id", "id")
RECORD_SCHEMA = StructType([StructField("key", StringType()), StructField("value", StringType()),
                            StructField("partition", IntegerType()), StructField("offset", LongType())])
_MANIFEST = "bucket int, epoch long, batch_id long, buckets int"


def bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*KEYS), F.lit(buckets)).cast("int")


def decode_records(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages -> (customer rows with their ``offset``, rejected lines with the reason): a
    record needs the declared non-null fields."""
    with_offset = StructType([*CUSTOMER_SCHEMA.fields, StructField("offset", LongType(), False)])
    # the offset rides along as a field, so a message and its place are judged as one
    parsed = messages.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("__offset"))
    open_ = StructType([StructField(f.name, f.dataType) for f in CUSTOMER_SCHEMA.fields]
                       + [StructField("_corrupt", StringType())])
    row = F.from_json("value", open_, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    parsed = parsed.select(row.alias("r"), F.col("value").alias("_raw"), F.col("__offset").alias("offset"))
    return files.split_records(parsed.select("r.*", "_raw", "offset"), with_offset)


def newest_per_key(rows: DataFrame) -> DataFrame:
    """The row of the greatest offset of each key."""
    values = [c for c in rows.columns if c not in (*KEYS, "bucket")]
    keys = [c for c in ("bucket", *KEYS) if c in rows.columns]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "offset").alias("__v"))
    return latest.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in values])


def versions(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """The (epoch, batch) of the complete manifests, ascending."""
    return [(e, n) for e in numbers_in(spark, f"{path}/manifest", "epoch=")
            for n in numbers_in(spark, f"{path}/manifest/epoch={e}", "batch_id=")
            if path_exists(spark, f"{path}/manifest/epoch={e}/batch_id={n}/_SUCCESS")]


def _manifest(spark: SparkSession, path: str, version: tuple[int, int]) -> dict[int, tuple[int, int, int]]:
    """bucket -> (epoch, batch, number of buckets): at most one row a bucket."""
    rows = spark.read.schema(_MANIFEST).parquet(
        f"{path}/manifest/epoch={version[0]}/batch_id={version[1]}").collect()
    return {r["bucket"]: (r["epoch"], r["batch_id"], r["buckets"]) for r in rows}


def _folder(path: str, bucket_no: int, place: tuple[int, ...]) -> str:
    return f"{path}/data/epoch={place[0]}/batch_id={place[1]}/bucket={bucket_no}"


def _held_schema() -> StructType:
    return StructType([*[StructField(f.name, f.dataType) for f in CUSTOMER_SCHEMA.fields],
                       StructField("offset", LongType())])


def _rows_of(spark: SparkSession, path: str, manifest: dict, wanted: list[int] | None = None) -> DataFrame:
    folders = [_folder(path, b, at) for b, at in sorted(manifest.items()) if wanted is None or b in wanted]
    if not folders:
        return spark.createDataFrame([], _held_schema())
    return spark.read.schema(_held_schema()).parquet(*folders)


def read_customers(spark: SparkSession, path: str, version: tuple[int, int] | None = None) -> DataFrame:
    """The customers table as of its newest complete version (or of one that is kept)."""
    known = versions(spark, path)
    if not known:
        return spark.createDataFrame([], CUSTOMER_SCHEMA)
    rows = _rows_of(spark, path, _manifest(spark, path, version or known[-1]))
    return rows.select(*[f.name for f in CUSTOMER_SCHEMA.fields])


def customers_sink(path: str, epoch: int, buckets: int = 64, keep: int = 2, quarantine=None):
    """A ``foreachBatch`` function that upserts each micro-batch of record messages into the
    table at ``path``; ``quarantine`` (a function of (batch, batch id)) takes the rejected ones.

    ``buckets`` holds for a new table; choose it so that a bucket is a few hundred megabytes.
    The last ``keep`` versions stay readable, folders that none of them names are deleted."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            rows, rejected = decode_records(batch)
            if quarantine is not None:
                quarantine(rejected, batch_id)
            known = versions(spark, path)
            if known and known[-1] >= (epoch, batch_id):
                return  # published before
            old = _manifest(spark, path, known[-1]) if known else {}
            n = next((at[2] for at in old.values()), buckets)
            # a hot key is reduced inside each task before it is sent to its bucket
            new = newest_per_key(rows).withColumn("bucket", bucket(n)).persist()
            touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # at most n
            if touched:
                held = _rows_of(spark, path, old, touched).withColumn("bucket", bucket(n))
                both = held.unionByName(new).repartition(min(n, len(touched)), "bucket")
                newest_per_key(both).write.mode("overwrite").partitionBy("bucket") \
                    .parquet(f"{path}/data/epoch={epoch}/batch_id={batch_id}")
            new.unpersist()
            manifest = old | {b: (epoch, batch_id, n) for b in touched}
            spark.createDataFrame([(b, *at) for b, at in manifest.items()], _MANIFEST).coalesce(1) \
                .write.mode("overwrite").parquet(f"{path}/manifest/epoch={epoch}/batch_id={batch_id}")
            prune(spark, path, keep)
        finally:
            batch.unpersist()
    return write


def prune(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete the versions before the last ``keep`` and the folders that only they name."""
    known = versions(spark, path)
    old, kept = known[:-keep], known[-keep:]
    named = {_folder(path, b, at) for v in kept for b, at in _manifest(spark, path, v).items()}
    for v in old:
        for b, at in _manifest(spark, path, v).items():
            if _folder(path, b, at) not in named:
                delete(spark, _folder(path, b, at))
        delete(spark, f"{path}/manifest/epoch={v[0]}/batch_id={v[1]}")


def run_customers(messages: DataFrame, path: str, checkpoint: str, name: str, buckets: int = 64,
                  quarantine=None, available_now: bool = True, trigger: str = TRIGGER,
                  wait: bool = True) -> StreamingQuery:
    """Stream customer records into the table at ``path``."""
    epoch = open_epoch(messages.sparkSession, [f"{path}/manifest", f"{path}/quarantine"], checkpoint)
    sink = customers_sink(path, epoch, buckets, quarantine=quarantine or folder_sink(f"{path}/quarantine", epoch))
    writer = (messages.writeStream.queryName(name).option("checkpointLocation", checkpoint)
              .foreachBatch(sink))
    q = _triggered(writer, available_now, trigger).start()
    if available_now and wait:
        _await(q)
    return q
