"""Mixing sources to target weights by entropy balancing.

Document rates stay as close to 1 as the entropy measures, under one token constraint per
source and rates in 0..2. The solution tilts rates exponentially, ``min(2, exp(l * f))``
with f the size over the source's mean size; the multipliers l solve a convex dual. Newton
steps run on the histogram of sizes per source, as one aggregation a step, and are kept
inside a shrinking bracket. Rates are rounded to copies by a hash of the document, and the
rounding error of a source is taken up by documents in hash order. DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillroll.operators.ranking import range_position
from tillroll.sources.workspace import stage

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
TOLERANCE = 1e-9
STEPS = 80
_WORD = r"[^\x20\x09-\x0D]+"
_SLICE_BITS = 12


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _order_key(source: str = "source") -> dict[str, Column]:
    return {"_no_source": F.col(source).isNull().cast("int"), "_source": F.coalesce(source, F.lit(""))}


def targets(sources: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Add ``weight`` and ``target`` to (_no_source, _source, source_size).

    Weights repeat in code point order, null last. A target stops at ``most`` times its
    source's size; the excess goes to the others by weight until none is above.
    """
    placed = range_position(sources, ["_no_source", "_source"], "position")
    by_place = F.array(*[F.lit(float(w)) for w in weights])
    weighed = placed.withColumn(
        "weight", F.get(by_place, (F.col("position") % len(weights)).cast("int"))
    ).withColumn("ceiling", F.col("source_size") * F.lit(most))
    weighed = stage(weighed, "weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) > F.col("ceiling")
        n, taken, free = weighed.agg(
            F.count(F.when(full, 1)),
            F.coalesce(F.sum(F.when(full, F.col("ceiling"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == capped or not free:
            break
        capped, level = n, (share * total - taken) / free
    return weighed.withColumn("target", F.least("ceiling", F.col("weight") * F.lit(level)))


def _rate(lam: Column, size: Column, mean: Column, most: float) -> Column:
    tilt = F.least(lam * size / F.greatest(mean, F.lit(1e-300)), F.lit(math.log(most)))
    return F.least(F.exp(tilt), F.lit(most))


def _solve(sources: DataFrame, histogram: DataFrame, most: float) -> DataFrame:
    """Add the multiplier ``lam`` of each source."""
    mean = F.col("mean")
    ratio = F.try_divide(F.col("target"), F.col("source_size"))
    # words weigh at least 1 / mean, so rates of all documents reach the limit here
    top = mean * F.lit(math.log(most) * (1 + TOLERANCE))
    state = sources.withColumns(
        {
            "lam": F.when(F.col("target") >= F.col("ceiling"), top).otherwise(F.lit(0.0)),
            "lo": F.when(ratio < 1, mean * F.log(ratio)).otherwise(F.lit(0.0)),
            "hi": F.when(ratio > 1, top).otherwise(F.lit(0.0)),
        }
    )
    state = stage(state, "duals")
    keys = ["_no_source", "_source"]
    rate = _rate(F.col("lam"), F.col("size"), mean, most)
    inside = F.when(rate < most, rate * F.col("size") / F.greatest(mean, F.lit(1e-300)))
    for _ in range(STEPS):
        sums = (
            histogram.join(state.select(*keys, "lam", "mean"), keys)
            .groupBy(*keys)
            .agg(
                F.sum(F.col("n") * F.col("size") * rate).alias("got"),
                F.sum(F.col("n") * F.col("size") * inside).alias("slope"),
            )
        )
        gap = F.col("got") - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - F.try_divide(gap, F.col("slope"))
        good = newton.isNotNull() & (newton > F.col("_lo")) & (newton < F.col("_hi"))
        close = F.abs(gap) <= F.greatest(F.lit(TOLERANCE) * F.col("target"), F.lit(0.25))
        stepped = (
            state.join(sums, keys)
            .withColumns({"_lo": lo, "_hi": hi, "_close": close, "_gap": gap})
            .withColumn(
                "lam",
                F.when(F.col("_close"), F.col("lam"))
                .when(good, newton)
                .otherwise((F.col("_lo") + F.col("_hi")) / 2),
            )
            .select(*sources.columns, "lam", F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), "_close")
        )
        state = stage(stepped, "duals")
        if state.where(~F.col("_close")).isEmpty():
            break
        state = state.drop("_close")
    return state.select(*sources.columns, "lam")


def _hash(name: str) -> Column:
    """A hash of 0 .. 2**63 - 1 that depends on the document alone."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(name), F.col("doc_id"), F.col("size")), 1)


def _copies(most: float) -> Column:
    u = _hash("round").cast("double") / F.lit(float(1 << 63))
    top = F.lit(int(most))
    whole = F.floor(_rate(F.col("lam"), F.col("size"), F.col("mean"), most) + u)
    return F.least(whole.cast("long"), top.cast("long"))


def _room(most: float) -> Column:
    """Words that a document can still give to (short > 0) or take back from the mix."""
    missing = (F.lit(int(most)) - F.col("copies")) * F.col("size")
    return F.when(F.col("short") > 0, missing).otherwise(F.col("copies") * F.col("size"))


def _fill(rows: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """Where in hash order the rounding error of each source ends.

    Rows before ``cut`` give all their room, those at ``cut`` give ``rest`` words each.
    """
    keys = ["_no_source", "_source"]
    copied = rows.join(sources, keys).withColumn("copies", _copies(most))
    taken = copied.groupBy(*keys).agg(F.sum(F.col("copies") * F.col("size")).alias("got"))
    short = (F.round("target").cast("long") - F.col("got")).alias("short")
    lacking = stage(sources.join(taken, keys).select(*sources.columns, short), "short")
    roomy = (
        rows.join(lacking, keys)
        .withColumn("copies", _copies(most))
        .withColumns({"room": _room(most), "h": _hash("fill")})
        .where("short <> 0 and room > 0")
        .withColumn("slice", F.shiftright("h", 63 - _SLICE_BITS))
    )
    by_slice = roomy.groupBy(*keys, "slice").agg(
        F.sum("room").alias("room"), F.max(F.abs("short")).alias("need")
    )
    order = W.partitionBy(*keys).orderBy("slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    last = (
        by_slice.withColumn("before", F.sum("room").over(order) - F.col("room"))
        .where("before < need and before + room >= need")
        .select(*keys, "slice", "before", "need")
    )
    same_hash = (
        roomy.select(*keys, "slice", "h", "room")
        .join(last, [*keys, "slice"])
        .groupBy(*keys, "before", "need", "h")
        .agg(F.sum("room").alias("room"), F.count(F.lit(1)).alias("rows"))
    )
    order = W.partitionBy(*keys).orderBy("h").rowsBetween(W.unboundedPreceding, W.currentRow)
    cut = (
        same_hash.withColumn("b", F.col("before") + F.sum("room").over(order) - F.col("room"))
        .where("b < need and b + room >= need")
        .select(*keys, F.col("h").alias("cut"), F.floor((F.col("need") - F.col("b")) / F.col("rows")).alias("rest"))
    )
    return lacking.join(cut, keys, "left")


def fit(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """One row per source with its target, multiplier and rounding: all that a document's
    share in the mix depends on, besides the document itself."""
    rows = stage(
        docs.select("doc_id", word_count().alias("size"), "source")
        .withColumns(_order_key())
        .drop("source"),
        "sizes",
    )
    keys = ["_no_source", "_source"]
    histogram = stage(rows.groupBy(*keys, "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    sources = histogram.groupBy(*keys).agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"),
    )
    aimed = targets(sources, weights, share, most).select(*keys, "source_size", "mean", "weight", "ceiling", "target")
    solved = _solve(aimed, histogram, most)
    return stage(_fill(rows, solved, most), "mix")


def apply(docs: DataFrame, fitted: DataFrame, most: float = MOST) -> DataFrame:
    """``docs`` with size, source_size, target, rate, copies and taken."""
    rows = docs.withColumns({"size": word_count(), **_order_key()})
    joined = rows.join(fitted, ["_no_source", "_source"]).withColumn("copies", _copies(most))
    h = _hash("fill")
    moved = (
        F.when(F.col("cut").isNull(), F.lit(0))
        .when(h < F.col("cut"), _room(most))
        .when(h == F.col("cut"), F.least(F.col("rest"), _room(most)))
        .otherwise(F.lit(0))
    )
    sign = F.when(F.col("short") > 0, F.lit(1)).otherwise(F.lit(-1))
    return joined.withColumns(
        {
            "rate": _rate(F.col("lam"), F.col("size"), F.col("mean"), most),
            "taken": (F.col("copies") * F.col("size") + sign * moved).cast("long"),
        }
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, rate) of each row.

    size counts words (null text: 0). taken is a whole number of copies of the document,
    but for at most one document of a source (and its repeats), which evens out the last
    words. Documents without words have taken 0. Null is a source of its own, after all
    others. Repeated rows are treated alike. Extra columns are ignored; an empty table gives
    no rows.
    """
    slim = docs.select("doc_id", "text", "source")
    return apply(slim, fit(docs, weights, share, most), most).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "rate"
    )


def copies(docs: DataFrame) -> DataFrame:
    """The mixed documents: each as often as its rate was rounded to, columns as in ``docs``.

    A document that evens out the last words of its source is taken as often as fits best.
    One without words stays once.
    """
    own = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text", "source")
    mixed = apply(own, fit(docs))
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(F.lit(1))
    again = F.explode(F.array_repeat(F.lit(0), times.cast("int")))
    return mixed.select("_row", again.alias("_copy")).select("_row.*")
