"""Nominal columns as numbers: the mean of a label per level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PRIOR = 1.0  # rows that the overall mean counts for
SLICE_DIGITS = 3  # hexadecimal digits of the draw: 4,096 slices


def _shrunk(total: Column, n: Column, mean: Column, prior: float) -> Column:
    return (F.coalesce(total, F.lit(0)) + prior * mean) / (F.coalesce(n, F.lit(0)) + prior)


def ordered_target_statistic(
    df: DataFrame, column: str, label: str, key: Sequence[str], prior: float = PRIOR, seed: int = 1
) -> DataFrame:
    """``column``_mean: mean label of the rows of the same level that come before in a random
    order, shrunk to the overall mean. A row never sees its own label.

    The order is that of md5(seed and key), then key. It is cut into slices by the first
    digits of the md5: a row adds up its own slice, and slices add up per level, so that
    no level, however frequent, is sorted in one task. Null is a level.
    """
    draw = F.md5(F.concat_ws("-", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    y = F.col(label).cast("double")
    rows = df.withColumns({"_draw": draw, "_slice": F.substring(draw, 1, SLICE_DIGITS), "_level": F.col(column)})
    sums = rows.groupBy("_level", "_slice").agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
    earlier = W.partitionBy("_level").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("_level").alias("_l"), F.col("_slice").alias("_c"),
        F.sum("_s").over(earlier).alias("_s0"), F.sum("_n").over(earlier).alias("_n0"),
    )
    inside = W.partitionBy("_level", "_slice").orderBy("_draw", *key).rowsBetween(W.unboundedPreceding, -1)
    own = rows.withColumns({"_s1": F.sum(y).over(inside), "_n1": F.count(y).over(inside)})
    same = F.col("_level").eqNullSafe(F.col("_l")) & (F.col("_slice") == F.col("_c"))
    mean = df.agg(F.avg(y).alias("m")).scalar()
    both = lambda a, b: F.coalesce(F.col(a), F.lit(0)) + F.coalesce(F.col(b), F.lit(0))
    return own.join(offsets, same, "left").select(
        *df.columns, _shrunk(both("_s0", "_s1"), both("_n0", "_n1"), mean, prior).alias(f"{column}_mean")
    )


def level_means(df: DataFrame, column: str, label: str, prior: float = PRIOR) -> DataFrame:
    """(level, mean): mean label of every level over all rows, shrunk to the overall mean; and one
    row ``any`` true with the mean for levels that do not occur."""
    y = F.col(label).cast("double")
    mean = df.agg(F.avg(y).alias("m")).scalar()
    levels = df.groupBy(F.col(column).alias("level")).agg(F.sum(y).alias("s"), F.count(y).alias("n"))
    each = levels.select("level", _shrunk(F.col("s"), F.col("n"), mean, prior).alias("mean"), F.lit(False).alias("any"))
    return each.unionByName(df.agg(F.avg(y).alias("mean")).select(F.lit(None).cast(df.schema[column].dataType).alias("level"), "mean", F.lit(True).alias("any")))


def apply_level_means(df: DataFrame, column: str, means: DataFrame) -> DataFrame:
    """``column``_mean of other rows than those the means come from."""
    known = means.where("not any").select(F.col("level").alias("_l"), F.col("mean").alias("_m"))
    rest = means.where("any").select("mean").scalar()
    joined = df.join(known, F.col(column).eqNullSafe(F.col("_l")), "left")
    return joined.select(*df.columns, F.coalesce("_m", rest).alias(f"{column}_mean"))
