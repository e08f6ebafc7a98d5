"""SimHash near-duplicates by a self-join of a binary trie.

Fingerprints are the leaves of a binary trie.  Pairs of nodes at one depth are walked
together: a pair (a, b) leads to the pairs of their children, each mixed pair of children
adds one differing bit, and a pair that exceeds the Hamming budget is pruned.  Two
fingerprints within ``k`` bits differ in at most ``k // 2`` bits in one of their halves,
so the walk runs twice, with either half on top and that smaller budget on its bits.

On Spark the upper part of the trie is the partitioning: the node at depth ``d`` of a
fingerprint is its group, and each fingerprint is also sent to the nodes that the budget
still allows and that are larger than its own, so each pair of nodes meets once.  ``d`` is
the least depth at which no node holds more than ``node_limit`` distinct fingerprints.
Each task walks its nodes with numpy, in bounded slices, and returns a spanning forest of
the links it found; ``components`` joins these.

Rows: a null or blank text has fingerprint zero; equal texts share a fingerprint, so
copies meet before any join; repeated rows and equal doc_ids stay rows of their own; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, spare, text_of
from .components import components


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """``(doc_id, uid, fp)`` of every row: ``uid`` tells texts apart; a bit of the long
    ``fp`` is set if it is set in over half the hashes."""
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("uid"),
                       text_of(docs).cast("binary").alias("text"))

    def sketch(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from xxhash import xxh64_intdigest

        lanes = np.uint64(0x0101010101010101)

        def hashes(text: bytes) -> list[int]:
            found = text.lower().split()  # both know ASCII only, as the contract does
            if not found:
                return []
            if len(found) < shingle:
                return [xxh64_intdigest(b" ".join(found), 42)]
            runs = zip(*(found[i:] for i in range(shingle)), strict=False)
            return [xxh64_intdigest(x, 42) for x in map(b" ".join, runs)]

        def majority(own: list[list[int]]):
            n = np.array([len(x) for x in own], dtype=np.int64)
            h = np.array([v for x in own for v in x], dtype=np.uint64)
            # eight bits at a time in byte lanes, over runs of at most 255 hashes
            ends = np.cumsum(n)
            starts = [np.arange(e - c, e, 255) for e, c in zip(ends, n, strict=True)]
            owner = np.repeat(np.arange(len(own)), [len(s) for s in starts])
            out = np.zeros(len(own), dtype=np.uint64)
            if not len(h):
                return out
            at = np.concatenate(starts)
            for bit in range(8):
                sums = np.add.reduceat((h >> np.uint64(bit)) & lanes, at)
                sums = sums.view(np.uint8).reshape(-1, 8)
                for lane in range(8):
                    on = np.bincount(owner, weights=sums[:, lane], minlength=len(own)) * 2 > n
                    out |= on.astype(np.uint64) << np.uint64(8 * lane + bit)
            return out

        schema = pa.schema([("doc_id", pa.int64()), ("uid", pa.int64()), ("fp", pa.int64())])
        for batch in batches:
            names, uids, texts = (batch.column(c) for c in ("doc_id", "uid", "text"))
            for a in range(0, batch.num_rows, 256):
                own = [hashes(t) for t in texts.slice(a, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [names.slice(a, 256), uids.slice(a, 256), pa.array(majority(own).view(np.int64))],
                    schema=schema)

    return cols.mapInArrow(sketch, "doc_id long, uid long, fp long")


def walk(values, guests, top: int, top_budget: int, budget: int, depth: int, slice_size: int = 1 << 19):
    """Pairs (arrays of positions in the sorted ``values``) within ``budget`` bits, at
    most ``top_budget`` of them among the upper ``top`` bits.  Pairs of two ``guests``
    are left to their own node.  ``depth``: bits that are shared by construction or
    already checked here at the root, which compares whole prefixes.
    """
    import numpy as np

    n = len(values)
    prefix = values >> np.uint64(64 - depth) if depth else np.zeros(n, dtype=np.uint64)
    heads = np.flatnonzero(np.append(True, prefix[1:] != prefix[:-1])) if n else np.zeros(0, int)
    tails = np.append(heads[1:], n)
    home = np.flatnonzero(~guests[heads])
    stack = []
    for h in home:  # the one home node against itself and each guest node
        err = np.bitwise_count(prefix[heads] ^ prefix[heads[h]]).astype(np.int64)
        on = err <= min(top_budget, budget) if depth <= top else err <= budget
        g = np.flatnonzero(on)
        stack.append((np.full(len(g), heads[h]), np.full(len(g), tails[h]), heads[g], tails[g],
                      err[g], depth))
    while stack:
        alo, ahi, blo, bhi, err, d = stack.pop()
        if len(alo) > slice_size:
            half = len(alo) // 2
            stack.append(tuple(x[:half] for x in (alo, ahi, blo, bhi, err)) + (d,))
            stack.append(tuple(x[half:] for x in (alo, ahi, blo, bhi, err)) + (d,))
            continue
        # two leaves: the rest of the bits at once
        leaf = (ahi - alo == 1) & (bhi - blo == 1)
        if leaf.any():
            i, j = alo[leaf], blo[leaf]
            diff = values[i] ^ values[j]
            ok = ((np.bitwise_count(diff) <= budget) & (i != j)
                  & (np.bitwise_count(diff >> np.uint64(64 - top)) <= top_budget))
            if ok.any():
                yield i[ok], j[ok]
            keep = ~leaf
            alo, ahi, blo, bhi, err = (x[keep] for x in (alo, ahi, blo, bhi, err))
        if not len(alo):
            continue
        bit = np.uint64(63 - d)

        def split(lo, hi, bit=bit):
            # the first leaf of the node whose next bit is one
            first = (values[lo] >> bit | np.uint64(1)) << bit
            return np.clip(np.searchsorted(values, first), lo, hi)

        am, bm = split(alo, ahi), split(blo, bhi)
        same = (alo == blo) & (ahi == bhi)
        allowed = top_budget if d < top else budget
        parts = [(alo, am, blo, bm, err, None), (am, ahi, bm, bhi, err, None),
                 (alo, am, bm, bhi, err + 1, None), (am, ahi, blo, bm, err + 1, ~same)]
        new = []
        for lo1, hi1, lo2, hi2, e, also in parts:
            on = (hi1 > lo1) & (hi2 > lo2) & (e <= min(allowed, budget))
            if also is not None:
                on &= also
            new.append([x[on] for x in (lo1, hi1, lo2, hi2, e)])
        stack.append(tuple(np.concatenate(x) for x in zip(*new, strict=True)) + (d + 1,))


def forest(n: int, pairs: Iterator):
    """Least position of each position's component, after all ``pairs``."""
    import numpy as np

    label = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            on = a != b
            if not on.any():
                break
            np.minimum.at(label, np.maximum(a, b)[on], np.minimum(a, b)[on])
            while True:
                nxt = label[label]
                if (nxt == label).all():
                    break
                label = nxt
    return label


def node_join(depth: int, turn: int, small: int, max_bits: int):
    """The task's part of the self-join: one node with the guests it may link to."""
    def join(pdf):
        import numpy as np
        import pandas as pd

        v = pdf["v"].to_numpy().view(np.uint64)
        guest = (pdf["p"] != pdf["node"]).to_numpy()
        order = np.argsort(v)
        v, guest = v[order], guest[order]
        label = forest(len(v), walk(v, guest, 32, small, max_bits, depth))
        on = np.flatnonzero(label != np.arange(len(v)))
        a, b = v[label[on]], v[on]
        if turn:
            a, b = (x << np.uint64(32) | x >> np.uint64(32) for x in (a, b))
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return join


def links(fps: DataFrame, max_bits: int, node_limit: int = 1 << 16) -> DataFrame:
    """Edges ``(a, b)`` that span the components of the distinct ``fps (fp)``."""
    n = fps.count()
    small = max_bits // 2
    out = None
    for turn in (0, 1):
        turned = fps.select((F.col("fp") if not turn else F.shiftleft("fp", 32).bitwiseOR(
            F.shiftrightunsigned("fp", 32))).alias("v"))
        depth = min(32, max(0, (n // 4096).bit_length()))
        while depth < 32:
            if depth:
                node = F.shiftrightunsigned("v", 64 - depth)
                most = turned.groupBy(node.alias("p")).count().agg(F.max("count")).first()[0] or 0
            else:
                most = n
            if most <= node_limit:
                break
            depth += 4
        depth = min(depth, 32)
        dealt = turned.withColumn("p", F.shiftrightunsigned("v", 64 - depth) if depth
                                  else F.lit(0).cast("long"))
        # the nodes within the budget whose number is larger: zero bits set, up to ``small``
        reach = F.array(F.col("p"))
        for _ in range(small if depth else 0):
            step = F.flatten(F.transform(reach, lambda x, d=depth: F.transform(
                F.sequence(F.lit(0), F.lit(d - 1)),
                lambda i, x=x: x.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))))
            reach = F.array_distinct(F.concat(reach, step))
        dealt = dealt.select("v", "p", F.explode(F.filter(reach, lambda x: x >= F.col("p"))).alias("node"))
        edges = dealt.groupBy("node").applyInPandas(
            node_join(depth, turn, small, max_bits), "a long, b long")
        out = edges if out is None else out.unionByName(edges)
    return out


def grouped(docs: DataFrame, shingle: int, max_bits: int, node_limit: int) -> DataFrame:
    """``(doc_id, uid, fp, component, component_id)`` of every row: the least fingerprint and
    the least doc_id of its group."""
    rows = materialise(fingerprints(docs, shingle), "fingerprints")
    fps = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = components(links(fps.select("fp"), max_bits, node_limit))
    named = (fps.join(found.withColumnRenamed("node", "fp"), "fp", "left")
             .select("fp", "least", F.coalesce("component", "fp").alias("component")))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(least, "component").select("fp", "component", "component_id"), "fp")


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                   node_limit: int = 1 << 16) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row: the fingerprint as 16 hex
    digits and the least doc_id that its links reach."""
    return grouped(docs, shingle, max_bits, node_limit).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                    node_limit: int = 1 << 16) -> DataFrame:
    """One row of ``docs`` for each group: that of its least doc_id (no doc_id: one of the
    group's rows; rows that share the doc_id: the one with the least hash of its text)."""
    rows = grouped(docs, shingle, max_bits, node_limit)
    # names that no column of the documents has
    id_, uid, n = (spare(c, docs.columns) for c in ("__id", "__uid", "__n"))
    first = (rows.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("component").agg(F.first("doc_id").alias(id_), F.min("uid").alias(uid))
             .select(id_, uid))
    kept = docs.join(first, F.col("doc_id").cast("long").eqNullSafe(F.col(id_))
                     & (F.xxhash64("text") == F.col(uid)), "left_semi")
    repeated = rows.groupBy("doc_id", "uid").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    # rows that repeat both doc_id and text: the first by their other columns stays
    order = Window.partitionBy("doc_id", "text").orderBy(*[F.col(f"`{c}`") for c in docs.columns])
    return kept.withColumn(n, F.row_number().over(order)).where(F.col(n) == 1).drop(n)
