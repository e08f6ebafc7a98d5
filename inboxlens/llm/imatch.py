"""I-Match document fingerprints.  Built-in functions only.

The lexicon holds the terms whose document frequency lies in a band, neither so common
that every text has them nor so rare that a typing error makes one.  A text's distinct
lexicon terms are sorted, and one hash is taken over those in each of several randomised
subsets of the lexicon: larger subsets tell short texts apart, smaller ones let long texts
keep some hashes after an edit.  Two fingerprints are as alike as the share of their
subsets, empty in both left out, that agree.

The lexicon is small whatever the corpus: at most ``mean distinct terms / least share``
terms can stand in that share of the documents.  It is counted before it is broadcast;
beyond ``most_terms`` the same join is a shuffle join.

Rows: a null text is an empty one; a text without lexicon terms is fingerprinted by all its
terms (the empty text by none) and is like an equal fingerprint only; repeated rows are
documents of their own, ordered by doc_id and then by text; a null doc_id comes first; the
last document is followed by the first.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, release, text_of

SPLIT = r"""[\x00-\x20.,;:!?"'()]+"""
#: The lexicon is dealt at random into so many subsets, of which so many are hashed.
DEALS = ((8, 8), (64, 16), (512, 16))
_BUCKET = 1000  # documents of one window
_ALWAYS = 0     # stands for the text itself, so that every text meets the lexicon


def term_hashes(text: Column) -> Column:
    """Distinct hashed terms of the text, without order."""
    return F.array_distinct(F.transform(
        F.filter(F.split(F.lower(text), SPLIT), lambda w: w != ""), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, least_share: float, most_share: float) -> DataFrame:
    """``(h)``: hashes of the terms in the band, over all documents."""
    n = docs.count()
    found = (docs.select(F.explode(term_hashes(text_of(docs))).alias("h"))
             .groupBy("h").agg(F.count("*").alias("df"))
             .where((F.col("df") >= max(2.0, least_share * n)) & (F.col("df") <= max(2.0, most_share * n)))
             .select("h").unionByName(docs.sparkSession.range(1).select(F.lit(_ALWAYS).cast("long").alias("h"))))
    return materialise(found.distinct(), "lexicon")


def neighbours(docs: DataFrame) -> DataFrame:
    """``(bucket, rid, doc_id, text, next_rid, next_text)``: every row with the row after it.

    The rows are dealt into ranges that begin at doc_ids of the table, so a range's first
    document is known; it rides along as the last one of the range before.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text"),
                       F.monotonically_increasing_id().alias("rid"))
    key = F.coalesce("doc_id", F.lit(-2 ** 63).cast("long"))
    count, least = rows.select(key.alias("k")).agg(F.count("*"), F.min("k")).first()
    size = max(1, min(4096, -(-count // _BUCKET)))
    cuts = [i / size for i in range(1, size)]
    bounds = [least]
    if cuts and count:
        found = rows.select(F.percentile_approx(key, cuts, 20 * size)).first()[0]
        bounds = sorted({least, *found})
    at = F.array(*[F.lit(b).cast("long") for b in bounds]) if count else F.array(F.lit(0).cast("long"))
    last = len(bounds) - 1
    # number of the last bound that is not above the key
    own = F.size(F.filter(at, lambda b: b <= F.col("k"))) - 1
    head = F.get(at, F.col("own")) == F.col("k")
    before = F.when(F.col("own") == 0, F.lit(last)).otherwise(F.col("own") - 1)
    stop = F.lit(None).cast("int")
    dealt = (rows.withColumn("k", key).withColumn("own", own)
             .select("rid", "doc_id", "text", "k", F.explode(F.array(
                 F.struct(F.col("own").alias("bucket"), F.lit(0).alias("guest")),
                 F.struct(F.when(head, before).otherwise(stop).alias("bucket"), F.lit(1).alias("guest"))))
                 .alias("place"))
             .select("rid", "doc_id", "text", "k", "place.bucket", "place.guest").where("bucket is not null"))
    by = Window.partitionBy("bucket").orderBy("guest", "k", "text", "rid")
    return (dealt.select("bucket", "rid", "doc_id", "text", "guest", F.lead("rid").over(by).alias("next_rid"),
                         F.lead("text").over(by).alias("next_text"))
            .where("guest = 0").drop("guest"))


def _dealt(terms: Column, into: int, used: int) -> Column:
    """The terms of the used subsets in order: subset number, then the term's bits."""
    number = F.transform(terms, lambda m: F.shiftleft(F.pmod(F.xxhash64(m, F.lit(into)), F.lit(into)), 48)
                         .bitwiseOR(F.shiftrightunsigned(m, 16)))
    return F.array_sort(F.filter(number, lambda v: F.shiftrightunsigned(v, 48) < used))


def _subsets(dealt: str, used: int) -> Column:
    """32 bits of a hash for each used subset over its terms in order (null: none in the
    text), as an integer less 2^31."""
    nothing = F.xxhash64(F.slice(dealt, 1, 0))

    def one(k: Column) -> Column:
        h = F.nullif(F.xxhash64(F.filter(dealt, lambda v: F.shiftrightunsigned(v, 48) == k)), nothing)
        return (h.bitwiseAND(F.lit(2 ** 32 - 1).cast("long")) - F.lit(2 ** 31)).cast("int")

    return F.transform(F.sequence(F.lit(0), F.lit(used - 1)), one)


def _print(parts: str, every: str) -> Column:
    """The fingerprint: 8 hex digits for each subset, dots for an empty one; of a text
    without lexicon terms, an x and the hash of all its terms."""
    digits = F.transform(parts, lambda p: F.coalesce(
        F.lower(F.lpad(F.hex(p.cast("long") + F.lit(2 ** 31)), 8, "0")), F.lit("........")))
    none = F.forall(parts, lambda p: p.isNull())
    return F.when(none, F.concat(F.lit("x"), F.lower(F.lpad(F.hex(every), 16, "0")))).otherwise(
        F.array_join(digits, ""))


def likeness(a: str, b: str, equal: Column) -> Column:
    """Share of the subsets, empty in both left out, whose hashes agree; one if ``equal``."""
    same = F.filter(F.zip_with(a, b, lambda x, y: F.when(x.isNotNull() | y.isNotNull(), x.eqNullSafe(y))),
                    lambda s: s.isNotNull())
    share = F.size(F.filter(same, lambda s: s)) / F.size(same)
    return F.when(equal, F.lit(1.0)).when(F.size(same) == 0, F.lit(0.0)).otherwise(share)


def fingerprints(docs: DataFrame, least_share: float = 0.001, most_share: float = 0.1,
                 most_terms: int = 1_000_000) -> DataFrame:
    """Every document's fingerprint, that of its edited text (the last half replaced by
    the beginning of the next document), and how alike they are; see the queries."""
    spark = docs.sparkSession
    words = lexicon(docs, least_share, most_share)
    release(spark)
    if words.count() <= most_terms:
        words = F.broadcast(words)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = neighbours(docs).select("bucket", "rid", "doc_id", "next_rid", n.cast("long").alias("n_chars"), "text",
                                   edited.alias("edited"))
    always = F.array(F.lit(_ALWAYS).cast("long"))
    own, new = term_hashes(F.col("text")), term_hashes(F.col("edited"))
    # what stands beside a generator is evaluated for each of its rows: the rest comes first
    rows = rows.select("bucket", "rid", "doc_id", "next_rid", "n_chars",
                       F.sha2(F.col("edited").cast("binary"), 256).alias("sha"),
                       F.array(F.struct(F.lit(0).alias("which"), own.alias("terms")),
                               F.struct(F.lit(1).alias("which"), new.alias("terms"))).alias("both"))
    kept = ["doc_id", "next_rid", "n_chars", "sha", "every"]
    rows = rows.select("bucket", "rid", *kept[:-1], F.explode("both").alias("x"))
    rows = rows.select("bucket", "rid", "x.which", F.col("x.terms").alias("terms"), F.struct(
        *kept[:-1], F.xxhash64(F.array_sort("x.terms")).alias("every")).alias("meta"))
    rows = rows.select("bucket", "rid", "which", "meta", F.explode(F.concat(always, "terms")).alias("h"))
    first = F.col("h") == _ALWAYS  # the one row of a text that carries the rest
    found = rows.join(words, "h").select("bucket", "rid", "which", F.when(first, F.col("meta")).alias("meta"),
                                         F.when(~first, F.col("h")).alias("h"))  # lists leave nulls out
    # the rows are dealt by bucket already: grouping with it moves nothing
    own, new = F.col("which") == 0, F.col("which") == 1
    lists = found.groupBy("bucket", "rid").agg(
        F.first(F.when(own, F.col("meta")), ignorenulls=True).alias("meta"),
        F.first(F.when(new, F.col("meta")["every"]), ignorenulls=True).alias("every1"),
        F.collect_list(F.when(own, F.col("h"))).alias("t0"), F.collect_list(F.when(new, F.col("h"))).alias("t1"))
    lists = lists.select("rid", "meta.*", "every1", "t0", "t1")
    held = ["rid", *kept, "every1"]
    deals = [_dealt(F.col(t), into, used).alias(f"{t}_{into}") for t in ("t0", "t1") for into, used in DEALS]
    # a generator's output: the optimiser does not copy it into the lambdas
    lists = lists.select(*held, F.explode(F.array(F.struct(*deals))).alias("x"))
    subsets = [F.concat(*[_subsets(f"x.{t}_{into}", used) for into, used in DEALS]) for t in ("t0", "t1")]
    prints = materialise(lists.select(*held, subsets[0].alias("p0"), subsets[1].alias("p1")), "prints")
    release(spark)
    after = prints.select(F.col("rid").alias("next_rid"), F.col("p0").alias("p2"), F.col("every").alias("every2"))
    both = prints.join(after, "next_rid")
    same = [_print("p0", "every") == _print(p, e) for p, e in (("p1", "every1"), ("p2", "every2"))]
    return both.select(
        "doc_id", "n_chars", F.col("sha").alias("edited_sha256"), _print("p0", "every").alias("fingerprint"),
        _print("p1", "every1").alias("edited_fingerprint"), likeness("p0", "p1", same[0]).alias("near_edited"),
        likeness("p0", "p2", same[1]).alias("near_next"))
