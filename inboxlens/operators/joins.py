"""Join and top-k building blocks with explicit size and skew handling.

Broadcast rules
---------------
* ``broadcast()`` is only applied to sides whose size is bounded by construction: a
  ``limit(k)`` result, or the hot keys of a fact table (``hot_keys``: at most its rows
  divided by the rows a task should take).
* Dimension look-ups are plain joins: Catalyst broadcasts a side when its size
  estimate in bytes is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks
  the real shuffle size at run time; beyond that the join is a sort-merge join
  whose hot partitions AQE's skew-join handling splits across tasks.

Null keys
---------
A left look-up on a mostly-null key (``product_id`` is set on clicks only) would
hash every null to one shuffle partition.  ``left_lookup`` joins null keys on a hash of
their row (they can never match anyway), so they spread over all partitions however
many rows there are, and can split hot keys over sub-keys counted from the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType, LongType, StringType


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows by ``order`` (a TakeOrderedAndProject: per-task top-k, then
    a final merge of at most ``k`` rows per task).  The order must end in a key so
    ties at the cut are resolved deterministically."""
    return df.orderBy(*order).limit(k)


def join_bounded(big: DataFrame, small_bounded: DataFrame, on: Column | str | list,
                 how: str = "inner") -> DataFrame:
    """Join against a side whose row count is bounded by construction (top-k)."""
    return big.join(F.broadcast(small_bounded), on, how)


def hot_keys(fact: DataFrame, key: str, target_rows: int) -> DataFrame:
    """``(key, salts)``: the non-null keys of ``fact`` with more than ``target_rows`` rows,
    and over how many sub-keys to split each so that a task gets about that many.

    A partial aggregate on one column; the result has at most ``rows / target_rows`` rows.
    """
    counts = (fact.filter(F.col(key).isNotNull())
              .groupBy(key).agg(F.count(F.lit(1)).alias("__n")))
    return (counts.filter(F.col("__n") > target_rows)
            .select(key, F.ceil(F.col("__n") / target_rows).cast("int").alias("salts")))


def _lookup_side(dim: DataFrame, dim_key: str, key_type: DataType,
                 hot: DataFrame | None) -> DataFrame:
    """The dimension side: key, null flag and salts (each hot key's row once per sub-key)."""
    d = dim.select(F.lit(False).alias("__ld_null"), F.col(dim_key).cast(key_type).alias("__ld_val"),
                   *[F.col(c) for c in dim.columns if c != dim_key])
    if hot is None:
        return d.withColumn("__ld_salt", F.lit(0).cast("long"))
    flags = _hot_flags(hot, key_type)
    return (join_bounded(d, flags, F.col("__ld_val") == F.col("__hk"), "left")
            .withColumn("__ld_salt", F.explode(
                F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("__salts"), F.lit(1)) - F.lit(1).cast("long"))))
            .drop("__hk", "__salts"))


def _hot_flags(hot: DataFrame, key_type: DataType) -> DataFrame:
    return hot.select(F.col(hot.columns[0]).cast(key_type).alias("__hk"), F.col("salts").alias("__salts"))


def left_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                salt_cols: Sequence[str] | None = None, hot: DataFrame | None = None) -> DataFrame:
    """``fact LEFT JOIN dim ON fact_key = dim_key``, keeping every fact row, one scan.

    ``dim_key`` must be unique in ``dim`` (a dimension).  The join runs on
    ``(key is null, key, salt)``:

    * a row without key takes a hash of ``salt_cols`` for its key (stable under task
      retries; all 64 bits of it), and its ``true`` flag never matches a dimension row;
    * keys listed in ``hot`` (``hot_keys``) are split over their number of sub-keys on
      the fact side, and their dimension rows are replicated once per sub-key, so one
      hot key no longer lands in one task.  Without ``hot``, batch plans rely on AQE's
      skew-join split, which streaming micro-batches do not have.
    """
    salt_cols = list(salt_cols or fact.columns)
    key_type = _common_key_type(fact.schema[fact_key].dataType, dim.schema[dim_key].dataType)
    d = _lookup_side(dim, dim_key, key_type, hot)
    h = F.xxhash64(*[F.col(c) for c in salt_cols])
    f = (fact.withColumn("__lk_null", F.col(fact_key).isNull())
             .withColumn("__lk_val", F.coalesce(F.col(fact_key).cast(key_type), h.cast(key_type))))
    sub_key = F.lit(0).cast("long")
    if hot is not None:
        f = join_bounded(f, _hot_flags(hot, key_type),
                         (F.col("__lk_val") == F.col("__hk")) & ~F.col("__lk_null"), "left")
        sub_key = F.coalesce(F.pmod(h, F.col("__salts").cast("long")), sub_key)
    f = f.withColumn("__lk_salt", sub_key)
    if hot is not None:
        f = f.drop("__hk", "__salts")
    cond = ((F.col("__lk_null") == F.col("__ld_null")) & (F.col("__lk_val") == F.col("__ld_val"))
            & (F.col("__lk_salt") == F.col("__ld_salt")))
    return f.join(d, cond, "left").drop("__lk_null", "__lk_val", "__lk_salt",
                                        "__ld_null", "__ld_val", "__ld_salt")


def _common_key_type(a: DataType, b: DataType) -> DataType:
    """Long for integers (a hash has room in it), else text."""
    return LongType() if isinstance(a, IntegralType) and isinstance(b, IntegralType) else StringType()


def semi_join_ids(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``df`` whose key is in ``ids`` (``IN (list)`` without collecting the
    list; an empty id set gives an empty result rather than a syntax error)."""
    return df.join(ids.select(F.col(id_col).alias("__id")).distinct(),
                   F.col(key) == F.col("__id"), "left_semi")


def assert_unique(dim: DataFrame, key: str) -> None:
    """Eagerly check that ``key`` is unique in a dimension (one aggregation job)."""
    dupes = dim.groupBy(key).count().filter(F.col("count") > 1).limit(1).collect()
    if dupes:
        raise ValueError(f"dimension key {key!r} is not unique, e.g. {dupes[0][key]!r}")
