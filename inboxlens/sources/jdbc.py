"""Relational tables over JDBC: partitioned scans and overwrite/append writes.

A JDBC scan without partition options is a single task; ``read_table`` takes a
numeric ``partition_column`` with bounds and splits the scan into
``num_partitions`` range queries.  Filters and column selections on the result
are pushed into the SQL sent to the database by Spark itself.

Not exercised by the tests: they would need a database, which this
environment does not provide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.ledger import Target


def connection_options(url: str, user: str | None = None, password: str | None = None,
                       driver: str | None = None) -> dict:
    opts = {"url": url}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    return opts


def read_table(spark: SparkSession, conn: dict, table: str, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Whole-table scan (S4); partitioned when ``partition_column`` is given."""
    r = spark.read.format("jdbc").options(**conn).option("dbtable", table) \
        .option("fetchsize", str(fetch_size))
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
             .option("upperBound", str(upper)).option("numPartitions", str(num_partitions)))
    return r.load()


def write_table(df: DataFrame, conn: dict, table: str, mode: str = "append",
                truncate: bool = False, batch_size: int = 10_000) -> None:
    """Overwrite (S7) or append (S8) a table.

    ``overwrite`` without ``truncate`` drops and recreates the table from the
    DataFrame schema (the declared DDL is lost); ``truncate=True`` keeps it.
    """
    (df.write.format("jdbc").options(**conn).option("dbtable", table)
       .option("batchsize", str(batch_size)).option("truncate", str(truncate).lower())
       .mode(mode).save())


def append_target(conn: dict, table: str) -> Target:
    """A table that micro-batches are appended to, each once (S8, ``ledger.once_sink``).  It
    has the columns ``epoch`` and ``batch_id`` beside the rows' own; an index on them serves
    the read after a failure.  The filter goes to the database."""
    def held(spark: SparkSession, epoch: int, batch_id: int, since: int) -> DataFrame:
        return read_table(spark, conn, table).where((F.col("epoch") == epoch) & (F.col("batch_id") == batch_id))

    return Target(lambda rows: write_table(rows, conn, table), held)
