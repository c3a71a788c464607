"""Exact quantiles by selection: histograms of ever narrower ranges, in bounded memory."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.sources.workspace import stage

BINS = 256
LISTED = 1_000  # a range with so few values is listed instead of split further
_LARGEST = 1.7976931348623157e308

Range = tuple[str, float, float]  # column, lowest and highest value


def _inside(r: Range) -> Column:
    return F.col(r[0]).between(F.lit(r[1]), F.lit(r[2]))


def _bin(r: Range) -> Column:
    """Which of BINS equal steps of a range a value lies in; its ends lie in different ones."""
    c, lo, hi = r
    if math.isfinite(hi - lo):
        share = (F.col(c) - F.lit(lo)) / F.lit(hi - lo)
    else:  # halves keep the width finite
        share = (F.col(c) / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2)
    return F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")


def _histograms(data: DataFrame, ranges: Sequence[Range]) -> dict[int, list[tuple[float, float, int]]]:
    """(lowest, highest, count) of the filled bins of each range, in order, from one scan. At most
    BINS rows a range come back."""
    cells = [
        F.when(_inside(r), F.struct(F.lit(i).alias("r"), _bin(r).alias("bin"), F.col(r[0]).alias("x")))
        for i, r in enumerate(ranges)
    ]
    counts = (
        data.select(F.explode(F.array(*cells)).alias("e"))
        .where("e is not null")
        .groupBy("e.r", "e.bin")
        .agg(F.min("e.x").alias("lo"), F.max("e.x").alias("hi"), F.count(F.lit(1)).alias("n"))
    )
    found: dict[int, list] = {i: [] for i in range(len(ranges))}
    for row in sorted(counts.collect(), key=lambda row: row["bin"]):
        found[row["r"]].append((row["lo"], row["hi"], row["n"]))
    return found


def _select(data: DataFrame, wanted: dict[tuple[str, int], tuple[Range, int, int]]) -> dict[tuple[str, int], float]:
    """The value of each (column, rank), given a range that holds it, its rank inside the range
    and the number of values there."""
    values: dict[tuple[str, int], float] = {}
    while wanted:
        for key, (r, _, _) in list(wanted.items()):
            if r[1] == r[2]:
                values[key] = r[1]
                del wanted[key]
        wide = sorted({r for r, _, n in wanted.values() if n > LISTED})
        if wide:
            found = _histograms(data, wide)
            for key, (r, rank, n) in wanted.items():
                if n > LISTED:
                    for lo, hi, held in found[wide.index(r)]:
                        if rank < held:
                            wanted[key] = ((r[0], lo, hi), rank, held)
                            break
                        rank -= held
        elif wanted:
            few = sorted({r for r, _, _ in wanted.values()})
            lists = data.agg(
                *[F.sort_array(F.collect_list(F.when(_inside(r), F.col(r[0])))).alias(f"l{i}") for i, r in enumerate(few)]
            ).first()
            return values | {key: lists[few.index(r)][rank] for key, (r, rank, _) in wanted.items()}
    return values


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """The quantiles of each column, interpolated linearly between neighbouring ranks.

    Null and NaN do not count; an infinite value counts as the largest double. A column
    without values has None. The columns are written once; a scan counts BINS steps of the
    range around each rank, so a task holds a histogram a rank, however many values differ.
    """

    def number(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.when(x.isNotNull() & ~F.isnan(x), F.greatest(F.lit(-_LARGEST), F.least(x, F.lit(_LARGEST)))).alias(c)

    data = stage(df.select(*[number(c) for c in columns]), "quantiles")
    ends = data.agg(*[F.struct(F.count(c), F.min(c), F.max(c)).alias(c) for c in columns]).first()
    wanted: dict[tuple[str, int], tuple[Range, int, int]] = {}
    for c in columns:
        n, lo, hi = ends[c]
        for p in probs if n else ():
            for rank in {math.floor((n - 1) * p), math.ceil((n - 1) * p)}:
                wanted[c, rank] = ((c, lo, hi), rank, n)
    values = _select(data, wanted)

    def at(c: str, p: float) -> float | None:
        n = ends[c][0]
        if not n:
            return None
        place = (n - 1) * p
        low, high = values[c, math.floor(place)], values[c, math.ceil(place)]
        share = place - math.floor(place)
        return low if low == high else low * (1 - share) + high * share

    return {c: [at(c, p) for p in probs] for c in columns}
