"""Nearest neighbours by cross-polytope hashing.

In each of several tables a vector is turned by a pseudo-random rotation (three rounds of
random signs and a fast Hadamard transform) and hashed to the signed axis nearest to it.
A query looks into the bucket of its own axis and of the next nearest ones (multiprobe),
in every table; all vectors found there are ranked by their exact inner product with it.
Vectors of unlike lengths are dealt into bands, each of at most twice its least length;
each band has tables of its own, in which its vectors lie by direction, and a query probes
those of every band.  A band of at most ``small_band`` vectors is one bucket that every
query visits.  Scores always use the vectors as they are.

Spark routes each vector once for every table and each query once for every probe to its
bucket, where the products are taken in blocks.  A bucket of more than ``bucket_rows``
vectors is dealt over several tasks, all of which its queries visit, so a group of equal
vectors is no limit and nothing is dropped; the best of all tasks are merged.  A query for
which fewer than ``k`` are found, though there are more vectors, is compared with all.

Rows: vectors that are null, zero, hold null or non-finite components, or have another
dimension than most (ties: the smaller), and rows without vec_id, take no part; rows that
repeat a vec_id count as one (the least vector); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise

FOUND = "query_id long, vec_id long, score double"
_ALL = -1  # the one bucket of a small band


@dataclass(frozen=True)
class Params:
    tables: int = 8
    probes: int = 16
    rounds: int = 3
    bucket_rows: int = 4096
    small_band: int = 256
    seed: int = 7


def rotations(x, p: Params) -> Iterator:
    """Each table's pseudo-rotation of the rows of ``x`` (width a power of two)."""
    import numpy as np

    rng = np.random.default_rng(p.seed)
    n, width = x.shape
    for _ in range(p.tables):
        y = x
        for _ in range(p.rounds):
            y = y * rng.choice([-1.0, 1.0], width)
            step = 1
            while step < width:
                pair = y.reshape(n, -1, 2, step)
                y = np.concatenate([pair[:, :, :1] + pair[:, :, 1:], pair[:, :, :1] - pair[:, :, 1:]],
                                   axis=2).reshape(n, width)
                step *= 2
        yield y


def signed_axes(y, count: int):
    """For each row its nearest signed axes (2 i: axis i, 2 i + 1: its opposite)."""
    import numpy as np

    both = np.stack([y, -y], axis=2).reshape(len(y), -1)
    return np.argsort(-both, axis=1, kind="stable")[:, :count]


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """``(vec_id, v)`` of the rows that take part, and their dimension."""
    kind = vectors.schema["embedding"].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    v = F.col("embedding").cast("array<float>" if single else "array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .where(~bad & F.exists("v", lambda x: x != 0)))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = sizes["d"] if sizes else 1
    return rows.where(F.size("v") == dim).groupBy("vec_id").agg(F.min("v").alias("v")), dim


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, p: Params | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query, the rows
    whose vec_id is divisible by ``every``; nearness is the largest inner product."""
    p = p or Params()
    rows, dim = usable(vectors)
    rows = materialise(rows, "vectors")
    item = "f4" if isinstance(rows.schema["v"].dataType.elementType, T.FloatType) else "f8"
    # log2 of the length, by the largest component: no square leaves the range of a double
    peak = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    rows = rows.withColumn("peak", peak)
    sized = rows.withColumn("long", F.log2("peak") + 0.5 * F.log2(F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + (x.cast("double") / F.col("peak")) * (x.cast("double") / F.col("peak")))))
    most, least = sized.agg(F.max("long"), F.min("long")).first()
    level = most is None or most - least <= 1.5e-6  # all of one length, but for rounding
    band = F.lit(0) if level else F.floor(F.lit(most) - F.col("long")).cast("int")
    rows = sized.select("vec_id", "v", band.alias("band"))
    # one number for each band, and there are at most as many as doubles have exponents
    held = {r["band"]: r["count"] for r in rows.groupBy("band").count().collect()}
    small = [i for i, n in held.items() if n <= p.small_band]
    total = sum(held.values())
    width = 1 << max(0, (dim - 1).bit_length())
    probes = min(p.probes, 2 * width)

    def hashed(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(item)
            x = flat.reshape(len(ids), dim)
            bands = batch.column("band").to_numpy(zero_copy_only=False)
            whole = np.isin(bands, small)
            for a in range(0, len(ids), 2048):
                own, raw, few = ids[a:a + 2048], x[a:a + 2048], whole[a:a + 2048]
                wide = np.zeros((len(own), width))
                wide[:, :dim] = raw
                wide /= np.abs(wide).max(axis=1)[:, None]
                wide /= np.sqrt((wide ** 2).sum(axis=1))[:, None]
                asked = own % every == 0
                axes = np.stack([signed_axes(y, 1)[:, 0] for y in rotations(wide, p)], axis=1)
                seen = np.stack([signed_axes(y, probes) for y in rotations(wide[asked], p)], axis=1)
                probed = iter(seen.reshape(len(seen), -1).tolist())
                yield pa.RecordBatch.from_pydict({
                    "vec_id": own, "v": [r.tobytes() for r in raw], "band": bands[a:a + 2048],
                    "axes": [[_ALL] if f else x for f, x in zip(few, axes.tolist(), strict=True)],
                    "probes": [[*next(probed), _ALL] if q else None for q in asked],
                }, schema=pa.schema([("vec_id", pa.int64()), ("v", pa.binary()), ("band", pa.int32()),
                                     ("axes", pa.list_(pa.int32())), ("probes", pa.list_(pa.int32()))]))

    index = materialise(rows.mapInArrow(
        hashed, "vec_id long, v binary, band int, axes array<int>, probes array<int>"), "index")
    base = index.select("vec_id", "v", "band", F.posexplode("axes").alias("t", "b"))
    # at most tables x signed axes rows a band
    sizes = base.groupBy("band", "t", "b").count().select(
        "band", "t", "b", F.ceil(F.col("count") / p.bucket_rows).cast("int").alias("parts"))
    sizes = F.broadcast(sizes)
    base = base.join(sizes, ["band", "t", "b"]).select(
        "band", "t", "b", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"), "vec_id", "v")
    table = F.when(F.col("b") == _ALL, 0).otherwise(F.floor(F.col("at") / probes)).cast("int")
    asked = (index.where("probes is not null").select("vec_id", "v", F.posexplode("probes").alias("at", "b"))
             .select("vec_id", "v", table.alias("t"), "b")
             .join(sizes, ["t", "b"])  # in every band
             .select("band", "t", "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                     F.col("vec_id").alias("query_id"), F.col("v").alias("q")))

    def ranked(left, right):
        import numpy as np
        import pandas as pd

        out = []
        if len(left) and len(right):
            ids = left["vec_id"].to_numpy()
            order = np.argsort(ids)
            ids = ids[order]
            x = np.frombuffer(b"".join(left["v"].iloc[order]), dtype=item).reshape(-1, dim).astype(np.float64)
            for a in range(0, len(right), 128):
                names = right["query_id"].to_numpy()[a:a + 128]
                q = np.frombuffer(b"".join(right["q"].iloc[a:a + 128]), dtype=item).reshape(-1, dim).astype(np.float64)
                # einsum adds each product in one order, so equal vectors score alike
                s = np.einsum("qd,bd->qb", q, x)
                s[names[:, None] == ids[None, :]] = -np.inf
                best = np.argsort(-s, axis=1, kind="stable")[:, :k]  # ties: the smaller id
                score = np.take_along_axis(s, best, axis=1)
                on = np.isfinite(score)
                out.append(pd.DataFrame({"query_id": np.repeat(names, on.sum(axis=1)),
                                         "vec_id": ids[best[on]], "score": score[on]}))
        return pd.concat(out) if out else pd.DataFrame(
            {"query_id": np.zeros(0, "i8"), "vec_id": np.zeros(0, "i8"), "score": np.zeros(0)})

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def merged(found: DataFrame) -> DataFrame:
        found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                .select("query_id", "rank", "vec_id", "score"))

    place = ["band", "t", "b", "part"]
    best = materialise(merged(base.groupBy(*place).cogroup(asked.groupBy(*place)).applyInPandas(ranked, FOUND)), "best")
    enough = best.groupBy("query_id").count().where(F.col("count") >= min(k, total - 1)).select("query_id")
    short = (index.where("probes is not null").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
             .join(enough, "query_id", "left_anti"))
    short = materialise(short, "short")
    missing = short.count() if total > 1 else 0
    if not missing:
        return best
    # all rows in blocks, each with every block of the queries left
    deal, ask = (-(-n // p.bucket_rows) for n in (total, missing))
    every_row = index.select(F.pmod(F.xxhash64("vec_id"), F.lit(deal)).cast("int").alias("part"),
                             F.explode(F.sequence(F.lit(0), F.lit(ask - 1))).alias("own"), "vec_id", "v")
    left = short.select(F.explode(F.sequence(F.lit(0), F.lit(deal - 1))).alias("part"),
                        F.pmod(F.xxhash64("query_id"), F.lit(ask)).cast("int").alias("own"), "query_id", "q")
    exact = merged(every_row.groupBy("part", "own").cogroup(left.groupBy("part", "own")).applyInPandas(ranked, FOUND))
    return best.join(enough, "query_id", "left_semi").unionByName(exact)
