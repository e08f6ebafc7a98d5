"""Mixing sources to target weights by entropy balancing.

Each source is to give a target number of words.  Among all document rates between 0 and
``cap`` that meet the targets, the balanced ones stay as close as they can, in relative
entropy, to taking every document once.  Their form is an exponential tilt of the odds,

    rate / (cap - rate) = exp(lambda_s * size / mean size of s) / (cap - 1),

with one multiplier a constraint, the minimum of a convex dual.  Newton's method finds
all multipliers together: an iteration is one aggregation, over the counts of documents by
(source, size), of the targets' residuals and their derivatives; a step that leaves the
bracket known so far is halved into it.

Rates become copies by a hash of doc_id: the whole part, and one more where the hash
minus the rate's fraction is below a source's cut.  The cut takes as many documents as the
target allows; it is found from two histograms of that difference, the second within the
bin in which the first one passes the target.  Rows of one doc_id and size have the same
difference, however many they are: those at which the target is passed are cut by a hash of
their place in the table, found in the same way, so as many of them are taken as there is
room for.  A large document just beyond the cut can leave a gap, so further cuts follow for
the documents that are small enough for it.  Each source's words end near its target, and
reruns agree: over one table row by row, and whatever the order of its rows in what each
(source, doc_id, size) takes in all.

Rows: a null text has size 0; a null source is a source of its own, the last; of repeated
rows of one doc_id some may have one copy more than others; a null doc_id is hashed like any
value; an empty table gives an empty plan and no rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, materialise, release, text_of

BINS = 4096
_STEPS = 3  # of Newton's method between two releases of what the driver holds of broadcasts


def word_count(docs: DataFrame) -> Column:
    """Number of words of the text (null: 0)."""
    parts = F.split(text_of(docs), SPACE)
    # the first and last part are empty where the text begins or ends with white space
    blank = (parts[0] == "").cast("long") + F.when(
        F.size(parts) > 1, (F.element_at(parts, -1) == "").cast("long")).otherwise(0)
    return F.size(parts).cast("long") - blank


def targets(totals: DataFrame, weights: tuple, cap: float) -> DataFrame:
    """``totals (source, source_size)`` with ``sid`` (place in code-point order, null last)
    and ``target``: shares by the repeating weights, no more than ``cap`` times the size.

    The targets are min(theta * weight, cap * size) for the level theta at which they add
    up to all sizes.  One row a source: the windows order the sources themselves.
    """
    every = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("sid") - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("sid", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())))
    t = t.withColumn("w", w).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    t = t.withColumn("ratio", F.col("most") / F.col("w"))
    by = every.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    rest = (F.sum("source_size").over(every).cast("double")
            - F.coalesce(F.sum("most").over(by), F.lit(0.0)))
    weight = F.sum("w").over(every) - F.coalesce(F.sum("w").over(by), F.lit(0.0))
    t = t.withColumn("level", rest / weight)
    # the first source, by ratio, that the level does not fill
    t = t.withColumn("theta", F.min(F.when(F.col("ratio") >= F.col("level"),
                                           F.struct("ratio", "sid", "level"))).over(every)["level"])
    return t.select("source", "sid", "source_size",
                    F.least("most", F.coalesce(F.col("theta") * F.col("w"), F.col("most"))).alias("target"))


def _rate(cap: float) -> Column:
    """The document rate from ``lam``, ``mean`` and ``size`` (``full``: the cap)."""
    x = F.col("lam") * F.col("size") / F.col("mean")
    return F.when(F.col("full"), F.lit(float(cap))).otherwise(cap / (1 + (cap - 1) * F.exp(-x)))


def _cut(cap: float) -> tuple[Column, Column]:
    """Whole copies, and the difference that a cut decides on (null: no more copy)."""
    rate = _rate(cap)
    whole = F.least(F.floor(rate), F.lit(int(cap)))
    u = F.shiftrightunsigned(F.xxhash64(F.col("doc_id")), 11) / F.lit(float(2 ** 53))
    return whole, F.when(whole < int(cap), u - (rate - whole))


def balance(sized: DataFrame, weights: tuple = (1, 2, 3), cap: float = 3.0, tolerance: float = 1e-9,
            most_steps: int = 60) -> DataFrame:
    """The plan for ``sized (doc_id, source, size, key)``: one row a source with its size,
    target, multiplier ``lam`` and ``cuts``."""
    hist = materialise(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "sizes")
    totals = hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"),
                                        F.sum("n").alias("docs"))
    aim = targets(totals.drop("docs"), weights, cap)
    plan = (aim.join(totals.select(F.col("source").alias("s"), "docs"), F.col("source").eqNullSafe(F.col("s")))
            .select("source", "sid", "source_size", "target",
                    F.greatest(F.col("source_size") / F.col("docs"), F.lit(1e-9)).alias("mean"),
                    (F.col("target") >= F.col("source_size") * F.lit(float(cap)) * (1 - 1e-12)).alias("full"),
                    F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("low"),
                    F.lit(None).cast("double").alias("high"), F.lit(False).alias("done")))
    plan = materialise(plan, "plan")
    counts = hist.select(F.col("source").alias("s"), "size", "n")
    for k in range(most_steps):
        if k % _STEPS == _STEPS - 1:
            release(sized.sparkSession)
        if plan.where(~F.col("done") & ~F.col("full")).isEmpty():
            break
        rate = _rate(cap)
        mass = F.col("n") * F.col("size")
        sums = (counts.join(plan, F.col("source").eqNullSafe(F.col("s")))
                .groupBy("sid")
                .agg(F.sum(mass * rate).alias("got"),
                     F.sum(mass * F.col("size") / F.col("mean") * rate * (1 - rate / cap)).alias("slope")))
        gap = F.col("got") - F.col("target")
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - F.greatest(F.lit(-2.0), F.least(F.lit(2.0), gap / F.greatest("slope", F.lit(1e-300))))
        inside = F.coalesce(newton > F.col("low2"), F.lit(True)) & F.coalesce(newton < F.col("high2"), F.lit(True))
        step = F.when(inside, newton).otherwise((F.col("low2") + F.col("high2")) / 2)
        met = F.col("full") | (F.abs(gap) <= F.lit(tolerance) * F.greatest("target", F.lit(1.0)))
        plan = materialise(
            plan.join(sums, "sid").withColumn("low2", low).withColumn("high2", high)
            .select("source", "sid", "source_size", "target", "mean", "full",
                    F.when(met, F.col("lam")).otherwise(step).alias("lam"),
                    F.col("low2").alias("low"), F.col("high2").alias("high"), met.alias("done")), "plan")
    return _cuts(sized, plan.drop("low", "high", "done"), cap)


def _more(t: Column) -> Column:
    """Whether one of the plan's ``cuts`` gives the document a further copy."""
    def takes(c: Column) -> Column:
        return (F.col("size") <= c["most"]) & ((t < c["delta"]) | ((t == c["delta"]) & (F.col("key") < c["key"])))

    return F.coalesce(F.exists("cuts", takes), F.lit(False))


def _passing(rows: DataFrame, value: Column) -> DataFrame:
    """By ``sid``, the least ``value`` up to which the rows' words, with those ``below``,
    exceed the gap (null: they do not), and the words below it."""
    words = rows.groupBy("sid", value.alias("value")).agg(
        F.sum("size").alias("words"), F.first("gap").alias("gap"), F.first("below").alias("below"))
    up = F.sum("words").over(Window.partitionBy("sid").orderBy("value")) + F.col("below")
    words = words.withColumn("sum", up).withColumn("over", F.col("sum") > F.col("gap"))
    return words.groupBy("sid").agg(
        F.min(F.when(F.col("over"), F.col("value"))).alias("passing"),
        F.coalesce(F.max(F.when(~F.col("over"), F.col("sum"))), F.first("below")).alias("below"))


def _inside(rows: DataFrame, value: Column, passed: DataFrame) -> DataFrame:
    """The rows at their source's passing value."""
    kept = rows.drop("below").join(passed, "sid").where(value == F.col("passing"))
    return kept.drop("passing")


def row_key(docs: DataFrame) -> Column:
    """A number from 0 to 1 of each row's own: from its place in its file; from its place in
    the frame if it comes from none."""
    try:
        place = [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
        docs.select(*place)
    except AnalysisException:
        place = [F.monotonically_increasing_id()]
    return F.shiftrightunsigned(F.xxhash64(*place), 11) / F.lit(float(2 ** 53))


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select("doc_id", "source", word_count(docs).alias("size"), row_key(docs).alias("key"), *more)


def _cuts(sized: DataFrame, plan: DataFrame, cap: float, rounds: int = 4) -> DataFrame:
    """Add ``cuts``: an array of (delta, key, most), see the module's text."""
    whole, t = _cut(cap)
    width = 2.0 / BINS  # -1 <= t < 1
    at = (F.col("t") + 1) / width
    docs = (sized.select(F.col("source").alias("s"), "doc_id", "size", "key")
            .join(plan, F.col("source").eqNullSafe(F.col("s")))
            .select("sid", "size", "key", whole.alias("whole"), t.alias("t")))
    docs = materialise(docs, "rounding")
    base = docs.groupBy("sid").agg(F.sum(F.col("whole") * F.col("size")).alias("base"))
    plan = materialise(plan.join(base, "sid").select(
        *plan.columns, (F.col("target") - F.col("base")).alias("gap"),
        F.expr("cast(array() as array<struct<delta: double, key: double, most: double>>)").alias("cuts")), "plan")
    for _ in range(rounds):
        release(docs.sparkSession)  # the driver would hold each round's broadcasts and plans on
        # documents that no cut takes yet and that the gap has room for
        free = (docs.join(plan.select("sid", "gap", "cuts"), "sid")
                .where(F.col("t").isNotNull() & (F.col("size") <= F.col("gap")) & (F.col("size") > 0)
                       & ~_more(F.col("t")))
                .select("sid", "size", "gap", "t", "key", at.alias("at"), F.lit(0).cast("long").alias("below")))
        passed = materialise(_passing(free, F.floor("at")), "bin")
        near = materialise(_inside(free, F.floor("at"), passed), "near")
        # the bin's part, the value of t in it, and the rows of that value by their own keys
        steps = (F.floor((F.col("at") - F.floor("at")) * BINS), F.col("t"), F.floor(F.col("key") * BINS),
                 F.floor(F.col("key") * BINS * BINS))
        rows, found = near, passed.select("sid", "below", F.col("passing").isNull().alias("all"))
        for step in steps:
            passed = materialise(_passing(rows, step), "bin")
            rows = _inside(rows, step, passed)
            last = passed.select("sid", F.col("below").alias("in"), F.col("passing").cast("double").alias(f"p{len(found.columns)}"))
            found = found.join(last, "sid", "left").withColumn("below", F.coalesce("in", "below")).drop("in")
        _, _, _, _, value, _, key = found.columns
        found = materialise(found.select(
            "sid", F.col("below").alias("taken"), F.when(F.col("all"), F.lit(1.0)).otherwise(F.col(value)).alias("delta"),
            F.coalesce(F.col(key) / (BINS * BINS), F.lit(0.0)).alias("key")), "cut")
        new = F.concat("cuts", F.array(F.struct("delta", "key", F.col("gap").cast("double").alias("most"))))
        plan = materialise(plan.join(found, "sid", "left").select(
            *[c for c in plan.columns if c not in ("gap", "cuts")],
            (F.col("gap") - F.coalesce("taken", F.lit(0))).alias("gap"),
            F.when(F.col("taken").isNull(), F.col("cuts")).otherwise(new).alias("cuts")), "plan")
    release(docs.sparkSession)
    return plan.drop("gap")


def copies(sized: DataFrame, plan: DataFrame, cap: float = 3.0) -> DataFrame:
    """Rows of ``sized`` (doc_id, source, size, key and any more) with ``copies``, ``rate``,
    ``source_size`` and ``target``.  The plan has one row a source."""
    whole, t = _cut(cap)
    more = _more(t).cast("long")
    p = plan.withColumnRenamed("source", "s").drop("sid")
    return (sized.join(p, F.col("source").eqNullSafe(F.col("s")))
            .withColumn("copies", whole + more).withColumn("rate", _rate(cap))
            .drop("s", "mean", "full", "lam", "cuts", "key"))


def mix(docs: DataFrame, weights: tuple = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, taken`` of every row."""
    sized = materialise(_sized(docs), "sized")
    plan = balance(sized, weights, cap)
    return copies(sized, plan, cap).withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, weights: tuple = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """The rows of ``docs`` repeated as often as the mix takes them."""
    sized = materialise(_sized(docs), "sized")
    plan = balance(sized, weights, cap)
    # names that no column of docs has; the texts are not shuffled
    own = _sized(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    taken = copies(own, plan, cap)
    return (taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("k"))
            .select("row.*"))
