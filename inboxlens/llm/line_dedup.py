"""Repeated runs of lines, found by winnowing over line hashes.  Built-in functions only.

A *unit* is a line, cut further after a full stop, question or exclamation mark and a
space, so that a passage pasted into the middle of a line still holds whole units.  Each
``k`` consecutive unit hashes give one gram hash, and of every ``window`` consecutive grams
the least (the rightmost of equals) is kept: a run of at least ``window + k - 1`` units
that stands in two places has a kept gram in common.  A gram or a unit that alone has
``min_chars`` characters is kept as well, so a shorter run that has them is not missed.

A text that an earlier document has whole is deleted whole, if it has ``min_chars``
characters; only the first of equal texts goes on.  A kept gram's first place in a document
is joined with its first occurrence in the corpus (least doc_id, then least position), and
each further place in the document with the place before; never with all others, so a gram
that stands in a third of the documents makes one row for each.  The pair of positions fixes a diagonal of the two documents; along it
the match is extended both ways to maximal runs of equal units.  Runs of ``min_chars``
characters or more are deleted from the later place.  A deleted unit always has an equal
one earlier, so the first place of a passage stays.

Rows: a null text stays null and an empty text empty; a null doc_id comes before all
others; repeated rows are treated alike and stay, rows of one doc_id delete nothing from
one another, and other columns are passed through.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, release, text_of

_CUT = "\x01"
_ENDS = ("\n", ". ", "? ", "! ")
_PLACES = r"(?<=\n)|(?<=[.?!] )"  # the same
_FAR = 2 ** 30    # beyond any text
_PLACE = 2 ** 61  # a position (31 bits) and two hashes of 15 bits fit below


def _cut(text: Column, ends: dict[str, str]) -> Column:
    for end, kept in ends.items():
        text = F.replace(text, F.lit(end), F.lit(kept + _CUT))
    return F.split(text, _CUT)


def units(text: Column) -> Column:
    """The text's units; joined they give the text again."""
    # a text that holds the mark itself is cut at the same places without it
    return F.when(F.contains(text, F.lit(_CUT)), F.split(text, _PLACES)).otherwise(
        _cut(text, {e: e for e in _ENDS}))


def bare_units(text: Column) -> Column:
    """The units without what ends them (the line feed, the space) and outer spaces."""
    slow = F.transform(F.split(text, _PLACES), lambda u: F.regexp_replace(u, r"\n$", ""))
    parts = F.when(F.contains(text, F.lit(_CUT)), slow).otherwise(
        _cut(text, {e: e.rstrip() for e in _ENDS}))
    return F.transform(parts, lambda u: F.trim(u))


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-2 ** 63).cast("long"))


def _held(array: Column) -> Column:
    """``array`` as a column of its own.  The optimiser copies a named expression into each
    place that uses it, also into lambdas, where it would run once for every element; the
    output of a generator is left alone."""
    return F.explode(F.array(array))


def hashed_units(docs: DataFrame) -> DataFrame:
    """``(key, uid, hs, ls, chars)``: each row's unit hashes, their lengths in characters
    and the sum of these."""
    rows = docs.select(_key().alias("key"), F.xxhash64("text").alias("uid"), bare_units(text_of(docs)).alias("us"))
    rows = rows.select("key", "uid", _held(F.col("us")).alias("us"))
    rows = rows.select("key", "uid", F.transform("us", lambda u: F.xxhash64(u)).alias("hs"),
                       _held(F.transform("us", lambda u: F.length(u))).alias("ls"))
    return materialise(rows.withColumn("chars", F.aggregate("ls", F.lit(0), lambda t, x: t + x)), "units")


def first_texts(rows: DataFrame, min_chars: int) -> tuple[DataFrame, DataFrame]:
    """The rows whose text no earlier document has, and ``(key, uid)`` of the others that
    are long enough to delete."""
    light = rows.select("key", "uid", "chars")
    first = light.groupBy("uid").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    copies = (light.join(first.where("first < last").drop("last"), "uid")
              .where((F.col("key") > F.col("first")) & (F.col("chars") >= min_chars)).select("key", "uid"))
    kept = rows.join(first.select("uid", F.col("first").alias("key")), ["key", "uid"], "left_semi")
    kept = materialise(kept, "units")
    if not kept.groupBy("key", "uid").count().where("count > 1").isEmpty():
        kept = materialise(kept.dropDuplicates(["key", "uid"]), "units")
    return kept, copies


def marks(rows: DataFrame, k: int, window: int, min_chars: int, every_long: bool = False) -> DataFrame:
    """The kept grams ``(key, uid, g, p, around, enough, back)``: hash, position, hashes of
    the units before and after (15 bits each), whether its own length is ``min_chars``, and
    the position before in the document that holds the same gram.  With ``every_long`` the
    grams that by themselves have ``min_chars`` characters are kept whatever their hash."""
    n = F.greatest(F.size("hs") - (k - 1), F.lit(0))  # number of grams
    grams = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        F.xxhash64(*[F.get("hs", i + j) for j in range(k)]).alias("g"), (-i).alias("p"))))
    rows = rows.select("key", "uid", "hs", "ls", _held(grams).alias("grams"))
    # the least of each window by (hash, -position): of equal hashes the rightmost
    wide = F.greatest(F.size("grams") - (window - 1), F.lit(0))
    least = F.slice("grams", 1, wide)
    for t in range(1, window):
        least = F.zip_with(least, F.slice("grams", t + 1, wide), lambda a, b: F.least(a, b))
    places = F.when(wide > 0, F.array_distinct(F.transform(least, lambda m: -m["p"]))).when(
        F.size("grams") > 0, F.array(-F.array_min("grams")["p"]))
    if every_long:
        long_grams = F.filter(F.sequence(F.lit(0), F.size("hs") - k), lambda i: sum(
            (F.get("ls", i + j) for j in range(1, k)), F.get("ls", i)) >= min_chars)
        places = F.when(F.size("grams") > 0, F.array_union(places, long_grams))
    big = F.filter(F.sequence(F.lit(0), F.size("hs") - 1), lambda i: F.get("ls", i) >= min_chars)
    # by gram and place, each with the place before it that holds the same gram
    kinds = [F.transform(places, lambda i: F.struct(F.get("grams", i)["g"].alias("g"), F.lit(k).alias("width"),
                                                    i.alias("p"))),
             F.transform(big, lambda i: F.struct(F.xxhash64(F.get("hs", i), F.lit("unit")).alias("g"),
                                                 F.lit(1).alias("width"), i.alias("p")))]
    rows = rows.select("key", "uid", "hs", "ls", _held(F.array_sort(F.concat(
        F.coalesce(kinds[0], F.slice(kinds[1], 1, 0)), kinds[1]))).alias("all"))
    none = F.lit(None).cast("struct<g: bigint, width: int, p: int>")
    pairs = F.zip_with("all", F.concat(F.array(none), F.slice("all", 1, F.greatest(F.size("all") - 1, F.lit(0)))),
                       lambda m, b: F.struct(m.alias("m"), F.when(b["g"] == m["g"], b["p"]).alias("back")))
    pairs = F.slice(pairs, 1, F.size("all"))
    rows = rows.select("key", "uid", "hs", "ls", F.explode(pairs).alias("x")).select(
        "key", "uid", "hs", "ls", F.col("x.m.g").alias("g"), F.col("x.m.p").alias("p"),
        F.col("x.m.width").alias("width"), F.col("x.back").alias("back"))
    p, width, back = F.col("p"), F.col("width"), F.col("back")
    long_ = F.when(width == 1, F.lit(True)).otherwise(
        sum((F.get("ls", p + j) for j in range(1, k)), F.get("ls", p)) >= min_chars)
    low = F.lit(2 ** 15 - 1).cast("long")
    before = F.coalesce(F.get("hs", p - 1), F.lit(1).cast("long")).bitwiseAND(low)
    after = F.coalesce(F.get("hs", p + width), F.lit(2).cast("long")).bitwiseAND(low)
    around = F.shiftleft(before, 15).bitwiseOR(after).cast("int")
    # in one document: the two places must go on alike at a side, as across documents
    alike = (F.get("hs", p - 1) == F.get("hs", back - 1)) | (F.get("hs", p + width) == F.get("hs", back + width))
    return rows.select("key", "uid", "g", "p", around.alias("around"), long_.alias("enough"), "back").where(
        back.isNull() | F.col("enough") | alike)


def diagonals(rows: DataFrame, k: int, window: int, min_chars: int) -> DataFrame:
    """``(key, uid, key0, diag, p1, p2)``: document, earlier document, difference of their
    positions, first and last position in the document of the pairs that gave it."""
    every = materialise(marks(rows, k, window, min_chars, every_long=True), "marks")
    kept = every.where("back is null")
    # (key, position) and what is around as one number, so that the first is a plain minimum
    rest = F.shiftleft(F.col("p").cast("long"), 30).bitwiseOR(F.col("around").cast("long"))
    place = F.col("key").cast("decimal(20,0)") * F.lit(_PLACE).cast("decimal(19,0)") + rest.cast("decimal(19,0)")
    first = (kept.groupBy("g").agg(F.min(place).alias("at"), F.count("*").alias("n")).where("n > 1")
             .select("g", "at", F.pmod("at", F.lit(_PLACE).cast("decimal(19,0)")).cast("long").alias("rest")))
    first = first.select("g", F.expr(f"(at - rest) div {_PLACE}").cast("long").alias("key0"),
                         F.shiftright("rest", 30).cast("int").alias("p0"),
                         F.col("rest").bitwiseAND(F.lit(2 ** 30 - 1).cast("long")).cast("int").alias("around0"))
    # a gram that is too short for a run must go on at one side
    both = F.col("around").bitwiseXOR(F.col("around0"))
    goes_on = (F.shiftright(both, 15) == 0) | (both.bitwiseAND(F.lit(2 ** 15 - 1)) == 0)
    pairs = kept.join(first, "g").where((F.col("key") > F.col("key0")) & (F.col("enough") | goes_on))
    pairs = pairs.select("key", "uid", "key0", (F.col("p") - F.col("p0")).alias("diag"), "p").unionByName(
        every.where("back is not null").select("key", "uid", F.col("key").alias("key0"),
                                               (F.col("p") - F.col("back")).alias("diag"), "p"))
    return materialise(pairs.groupBy("key", "uid", "key0", "diag").agg(
        F.min("p").alias("p1"), F.max("p").alias("p2")), "diagonals")


def _extended(rows: DataFrame, found: DataFrame, reach: int, min_chars: int) -> DataFrame:
    """``(key, uid, key0, diag, p1, p2, open, spans)``: runs (first and last unit) that meet
    p1 .. p2 within ``reach`` units; ``open``: still equal at an end of the slice."""
    low = F.greatest(F.lit(0), F.col("diag"), F.col("p1") - reach)
    found = found.withColumn("low", low)
    width = F.col("p2") + reach + 1 - F.col("low")
    earlier = rows.select(F.col("key").alias("key0"), F.col("uid").alias("uid0"), F.col("hs").alias("h0"))
    across = (found.where("key <> key0").join(earlier, "key0")
              .select(*found.columns, F.slice("h0", F.col("low") - F.col("diag") + 1, width).alias("b"),
                      F.size("h0").alias("nb")).join(rows, ["key", "uid"]))
    inside = (found.where("key = key0").join(rows, ["key", "uid"])
              .withColumn("b", F.slice("hs", F.col("low") - F.col("diag") + 1, width))
              .withColumn("nb", F.size("hs")))
    both = across.unionByName(inside.select(across.columns))
    n = F.least(F.size("b"), F.size("hs") - F.col("low"))
    a = F.slice("hs", F.col("low") + 1, n)
    keep = ["key", "uid", "key0", "diag", "p1", "p2", "low"]
    both = both.select(*keep, "ls", "nb", F.size("hs").alias("na"), _held(a).alias("a"), "b")
    both = both.where(F.size("a") > 0)
    differ = F.filter(F.sequence(F.lit(0), F.size("a") - 1), lambda j: F.get("a", j) != F.get("b", j))
    both = both.select(*keep, "ls", "nb", "na", F.size("a").alias("n"), _held(differ).alias("differ"))
    p1, p2 = F.col("p1") - F.col("low"), F.col("p2") - F.col("low")
    before = (F.col("low") > F.greatest(F.lit(0), F.col("diag"))) & ~F.coalesce(F.get("differ", F.lit(0)) < p1, F.lit(False))
    after = ((F.col("low") + F.col("n") < F.least(F.col("na"), F.col("nb") + F.col("diag")))
             & ~F.coalesce(F.get("differ", F.size("differ") - 1) > p2, F.lit(False)))
    # the units between two neighbouring differences, as places in the document
    edge = F.concat(F.array(F.lit(-1)), F.col("differ"), F.array(F.col("n")))
    spans = F.zip_with(F.slice(edge, 1, F.size(edge) - 1), F.slice(edge, 2, F.size(edge) - 1),
                       lambda x, y: F.struct((x + 1 + F.col("low")).alias("s"), (y - 1 + F.col("low")).alias("e")))
    both = both.select(*keep, "ls", (before | after).alias("open"), _held(spans).alias("spans"))
    good = F.filter("spans", lambda r: (r["e"] >= r["s"]) & (r["e"] >= F.col("p1")) & (r["s"] <= F.col("p2"))
                    & (F.aggregate(F.slice("ls", r["s"] + 1, F.greatest(r["e"] - r["s"] + 1, F.lit(0))),
                                   F.lit(0), lambda t, x: t + x) >= min_chars))
    return both.select(*keep[:-1], "open", good.alias("spans"))


def runs(rows: DataFrame, found: DataFrame, min_chars: int, reach: int = 8) -> DataFrame:
    """``(key, uid, runs)``: the runs (first and last unit) to delete from each document."""
    done = None
    for reach in (reach, _FAR):
        step = materialise(_extended(rows, found, reach, min_chars), "extended")
        release(rows.sparkSession)
        closed = step.where(~F.col("open") & (F.size("spans") > 0)).select("key", "uid", "spans")
        done = closed if done is None else done.unionByName(closed)
        found = step.where("open").select("key", "uid", "key0", "diag", "p1", "p2")
        if found.isEmpty():
            break
    return materialise(
        done.groupBy("key", "uid").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("runs")), "runs")


def dedup_lines(docs: DataFrame, k: int = 2, window: int = 2, min_chars: int = 120,
                counts: bool = False) -> DataFrame:
    """``docs`` with the later repeated runs deleted from ``text``; with ``counts`` also
    ``removed`` (number of units deleted)."""
    spark = docs.sparkSession
    rows, copies = first_texts(hashed_units(docs), min_chars)
    release(spark)
    found = diagonals(rows, k, window, min_chars)
    release(spark)
    whole = F.array(F.struct(F.lit(0).alias("s"), F.lit(2 ** 31 - 1).alias("e")))
    deleted = runs(rows, found, min_chars).unionByName(copies.select("key", "uid", whole.alias("runs")).distinct())
    release(spark)
    # the documents ride in a struct, so no name of theirs can clash
    own = docs.select(_key().alias("key"), F.xxhash64("text").alias("uid"),
                      F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    both = own.join(deleted, ["key", "uid"], "left")
    text = F.col("row")["text"]
    us = units(F.coalesce(text, F.lit("")))
    kept = F.filter(us, lambda u, i: ~F.exists("runs", lambda r: (i >= r["s"]) & (i <= r["e"])))
    new = F.when(F.col("runs").isNull(), text).otherwise(F.array_join(kept, ""))
    n = F.when(text.isNull(), 0).otherwise(F.size(us))
    gone = F.when(F.col("runs").isNull(), 0).otherwise(n - F.size(kept))
    # the documents' own names come last: one of them might be that of a column used above
    both = both.select("row", new.alias("text"), *[gone.alias("removed")] * counts)
    return both.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns],
                       *["removed"] * counts)
