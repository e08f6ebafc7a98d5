"""Documents' words that stand in a benchmark, by a prefix-filtered set join.  Built-in
functions only.

A *window* is ``window`` consecutive words of a benchmark item; an item of fewer words is
one window.  Windows are taken as sets of shingles (``width`` words, or the whole window if
it is shorter): a document holds a window when it has all of its shingles, in their places.

One pass over the documents finds the occurrences of the benchmark's shingles, each with its
place: its hash is looked up and its words are compared.  The occurrences, over all
documents, give the order of the shingles by rarity.  As all shingles of a window are needed,
its necessary prefix is one: the rarest.  Only its occurrences make candidates, the length
and position bounds (the window must begin and end inside the document) drop some, and a
candidate is verified when every other shingle of the window stands at its own place.

The benchmark's shingles are broadcast in slices of at most ``slice_bytes`` (counted
first), each of which passes over the documents; a benchmark is usually one slice.  All
that follows is joined by shuffles on the small table of occurrences.

Rows: a null text has no words; an item without words has no window; windows of several
items, and items of one item_id, count for each distinct item_id once (a null item_id
stands as an empty string); rows of one doc_id with different texts are documents of their
own and repeated rows all come back; a null doc_id is kept.  An empty benchmark hits
nothing; an empty ``documents`` gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

# What separates words once A-Z are lower case.
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_HEAD = 0  # the hash of the row that every document sends on


def words(text: Column) -> Column:
    """The words of the text (null: none), A-Z lower-cased."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    return F.split(low, _SEPARATORS)


def _inner(parts: str) -> Column:
    """``parts`` without the empty strings that a separator at either end leaves."""
    lead = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
    n = F.size(parts)
    last = F.when((n > 1) & (F.get(parts, n - 1) == ""), 1).otherwise(0)
    return F.slice(parts, lead + 1, n - lead - last)


def _worded(rows: DataFrame, *kept: Column) -> DataFrame:
    """``kept`` and ``ws``, the words, each computed once (the output of a generator is not
    copied into the expressions that use it)."""
    rows = rows.select(*kept, F.explode(F.array(words(F.col("text")))).alias("parts"))
    names = [c for c in rows.columns if c != "parts"]
    return rows.select(*names, F.explode(F.array(_inner("parts"))).alias("ws"))


def _hashes(ws: str, width: int) -> Column:
    """One hash for each ``width`` consecutive words, in order."""
    n = F.size(ws) - (width - 1)
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(F.lit(width), *[F.get(ws, i + j) for j in range(width)]))


def windows(benchmark: DataFrame, window: int, width: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The distinct shingles ``(sid, width, gram, h)``, the windows' shingles
    ``(wid, len, j, sid)`` and the windows' items ``(wid, item)``."""
    items = _worded(benchmark, F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"))
    items = items.where(F.size("ws") > 0)
    long = F.least(F.size("ws"), F.lit(window))
    items = items.select("item", "ws", long.alias("len"),
                         F.explode(F.sequence(F.lit(0), F.size("ws") - long)).alias("at"))
    # words hold no space, so the joined text is the window
    cut = items.select("item", "len", F.concat_ws(" ", F.slice("ws", F.col("at") + 1, F.col("len"))).alias("w"))
    named = materialise(cut.select("len", "w").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    members = materialise(cut.join(named, ["len", "w"]).select("wid", "item").distinct(), "members")
    w = F.least(F.col("len"), F.lit(width))
    parts = (named.select("wid", "len", w.alias("width"), F.split("w", " ").alias("ws"))
             .select("wid", "len", "width", "ws", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("width"))).alias("j"))
             .select("wid", "len", "width", "j", F.slice("ws", F.col("j") + 1, F.col("width")).alias("g")))
    gram = F.concat_ws(" ", "g")
    parts = parts.select("wid", "len", "width", "j", gram.alias("gram"))
    hashed = reduce(lambda e, k: e.when(F.col("width") == k, F.xxhash64(F.lit(k), *[F.get("g", F.lit(i)) for i in range(k)])),
                    range(1, width + 1), F.when(F.lit(False), F.lit(0).cast("long")))
    grams = materialise(parts.select("gram", "width").distinct()
                        .withColumn("sid", F.monotonically_increasing_id())
                        .withColumn("g", F.split("gram", " ")).withColumn("h", hashed).drop("g"), "grams")
    sets = materialise(parts.join(grams, ["gram", "width"]).select("wid", "len", "j", "sid"), "sets")
    return grams, sets, members


def occurrences(docs: DataFrame, grams: DataFrame, slice_bytes: int) -> DataFrame:
    """``(doc_id, uid, n_words, p, sid)``: every place of a benchmark shingle in a document,
    and one row without ``sid`` for each document."""
    spark = docs.sparkSession
    found = grams.agg(F.sum(F.octet_length("gram") + 32), F.collect_set("width")).first()
    size, widths = found[0] or 0, sorted(found[1], reverse=True)  # at most ``width`` of them
    texts = _worded(docs, F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("uid"))
    n = F.size("ws")
    head = spark.range(1).select(F.lit(None).cast("long").alias("sid"), F.lit(0).alias("width"),
                                 F.lit("").alias("gram"), F.lit(_HEAD).cast("long").alias("h"))
    slices, out = max(1, -(-size // slice_bytes)), None
    for number in range(slices):
        own = grams.where(F.pmod(F.xxhash64("sid"), F.lit(slices)) == number).select("sid", "width", "gram", "h")
        lists = [_hashes("ws", k) for k in widths]
        if number == 0:
            own = own.unionByName(head)
            lists = [F.array(F.lit(_HEAD).cast("long"))] + lists
        lists = lists or [F.array().cast("array<bigint>")]
        rows = texts.select("doc_id", "uid", "ws", F.posexplode(F.concat(*lists)).alias("q", "h"))
        # the hashes of one width follow those of the widths before
        place, before = F.when(F.col("width") == 0, F.col("q")), F.lit(1 if number == 0 else 0)
        for k in widths:
            place = place.when(F.col("width") == k, F.col("q") - before)
            before = before + F.greatest(n - (k - 1), F.lit(0))
        met = rows.join(F.broadcast(own), "h").withColumn("p", place)
        inside = (F.col("p") >= 0) & (F.col("p") + F.col("width") <= n)
        same = F.concat_ws(" ", F.slice("ws", F.greatest(F.col("p"), F.lit(0)) + 1, F.col("width"))) == F.col("gram")
        met = met.where(((F.col("width") == 0) & (F.col("q") == 0)) | ((F.col("width") > 0) & inside & same))
        met = met.select("doc_id", "uid", n.cast("long").alias("n_words"), "p", "sid")
        out = met if out is None else out.unionByName(met)
    return materialise(out, "occurrences")


def verified(occ: DataFrame, sets: DataFrame) -> DataFrame:
    """``(doc_id, uid, start, len, wid)``: the windows that stand in documents, and where."""
    here = occ.where("sid is not null").distinct()  # repeated rows are one document here
    rarity = here.groupBy("sid").agg(F.count("*").alias("df"))
    ranked = (sets.join(rarity, "sid", "left").groupBy("wid", "len")
              .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "sid", "j")).alias("rarest"),
                   F.count("*").alias("need")))
    prefix = ranked.where("rarest.df > 0").select("wid", "len", "need", "rarest.sid", F.col("rarest.j").alias("off"))
    start = F.col("p") - F.col("off")
    candidates = (here.join(prefix, "sid").withColumn("start", start)
                  .where((F.col("start") >= 0) & (F.col("start") + F.col("len") <= F.col("n_words")))
                  .select("doc_id", "uid", "start", "len", "wid", "need"))
    candidates = materialise(candidates, "candidates")
    due = (candidates.join(sets.select("wid", "j", "sid"), "wid")
           .select("doc_id", "uid", "start", "len", "wid", "need", (F.col("start") + F.col("j")).alias("p"), "sid"))
    places = here.select(F.col("doc_id").alias("d"), F.col("uid").alias("u"), "p", "sid")
    met = due.join(places, due["doc_id"].eqNullSafe(places["d"]) & (due["uid"].eqNullSafe(places["u"]))
                   & (due["p"] == places["p"]) & (due["sid"] == places["sid"]), "left_semi")
    return (met.groupBy("doc_id", "uid", "start", "len", "wid", "need").agg(F.count("*").alias("n"))
            .where("n = need").select("doc_id", "uid", "start", "len", "wid"))


def _covered(spans: str) -> Column:
    """How many words the spans (start, len) cover."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, s: Column) -> Column:
        end = s["start"] + s["len"]
        fresh = F.greatest(F.lit(0), end - F.greatest(s["start"], acc["end"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + fresh).alias("n"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, width: int = 5,
                  slice_bytes: int = 64 << 20) -> DataFrame:
    """One row for each document: ``doc_id, n_words, n_hit, n_items, items, contaminated``;
    ``items`` are the item_ids as strings, in their order."""
    grams, sets, members = windows(benchmark, window, min(width, window))
    occ = occurrences(docs, grams, slice_bytes)
    found = materialise(verified(occ, sets), "verified")
    one = ["doc_id", "uid"]
    # a document's spans and items are no more than its own words and the items they stand in
    hits = found.groupBy(*one).agg(F.collect_set(F.struct("start", "len")).alias("spans"))
    hits = hits.select(*one, _covered("spans").alias("n_hit"))
    named = (found.select(*one, "wid").distinct().join(members, "wid").groupBy(*one)
             .agg(F.array_sort(F.collect_set("item")).alias("items")))
    heads = occ.where("sid is null").groupBy(*one).agg(F.max("n_words").alias("n_words"), F.count("*").alias("rows"))
    long, none = F.lit(None).cast("long"), F.lit(None).cast("array<string>")
    parts = heads.select(*one, "n_words", "rows", long.alias("n_hit"), none.alias("items")).unionByName(
        hits.select(*one, long.alias("n_words"), long.alias("rows"), "n_hit", none.alias("items"))).unionByName(
        named.select(*one, long.alias("n_words"), long.alias("rows"), long.alias("n_hit"), "items"))
    whole = parts.groupBy(*one).agg(
        F.max("n_words").alias("n_words"), F.max("rows").alias("rows"),
        F.coalesce(F.max("n_hit"), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.first("items", ignorenulls=True), F.array().cast("array<string>")).alias("items"))
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))  # one for each repeated row
    return whole.select("doc_id", "n_words", "n_hit", "items", again.alias("copy")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
        (F.col("n_hit") > 0).alias("contaminated"))
