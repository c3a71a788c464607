"""Numbering and top-k that stay balanced when one key holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.sources.workspace import stage


def split_row_number(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Sequence[str],
    order: Sequence[str],
    name: str,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """1-based row number per ``keys`` ordered by ``bucket`` then ``order``.

    Equal to ``row_number() over (partition by keys order by bucket, order)``, but
    the rows are only sorted inside (keys, bucket); the offset of each bucket comes
    from per-bucket counts. ``carry`` adds aggregates of the previous bucket.
    """
    carry = carry or {}
    group = [*keys, *bucket]
    counts = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"), *[agg.alias(c) for c, agg in carry.items()]
    )
    running = W.partitionBy(*keys).orderBy(*bucket)
    before = running.rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *group,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        *[F.lag(c).over(running).alias(c) for c in carry],
    )
    inside = W.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, group)
        .withColumn(name, (F.col("_before") + F.col("_rank")).cast("int"))
        .drop("_before", "_rank")
    )


def split_large(
    df: DataFrame, large: DataFrame, key: str, bucket: Sequence[str], order: Sequence[str], name: str
) -> DataFrame:
    """``split_row_number`` that only splits the keys in ``large`` (a key and ``large``, true).

    All other keys are numbered in one shuffle. ``large`` is sent to every task: each of its
    keys stands for many rows, so it has few. Rows with an open bucket are left out, as there.
    """
    marked = df.join(F.broadcast(large), key, "left")
    parts = {f"_{c}": F.when(F.col("large"), F.col(c)) for c in bucket}
    inside = W.partitionBy(key, *parts).orderBy(*bucket, *order)
    rows = marked.withColumns(parts).withColumn("_rank", F.row_number().over(inside))
    counts = (
        df.join(F.broadcast(large), key, "left_semi").groupBy(key, *bucket).agg(F.count(F.lit(1)).alias("_n"))
    )
    before = W.partitionBy(key).orderBy(*bucket).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(key, *[F.col(c).alias(p) for p, c in zip(parts, bucket)], F.sum("_n").over(before).alias("_before"))
    return (
        rows.dropna(subset=list(bucket))
        .join(offsets, [key, *parts], "left")
        .withColumn(name, (F.coalesce("_before", F.lit(0)) + F.col("_rank")).cast("int"))
        .drop("_before", "_rank", "large", *parts)
    )


def top_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None
) -> DataFrame:
    """First ``k`` rows per ``keys``; ``rank`` keeps the 0-based place in the group.

    ``row_number() <= k`` lets Spark drop rows beyond k in each task before the
    shuffle, so a large group never reaches its reducer whole.
    """
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    kept = df.withColumn("_place", place).where(F.col("_place") <= k)
    if rank:
        kept = kept.withColumn(rank, (F.col("_place") - 1).cast("int"))
    return kept.drop("_place")


def range_position(
    df: DataFrame, order: Sequence[str], name: str = "position", total: str | None = None
) -> DataFrame:
    """0-based position of each row in the total order of ``order`` (unique columns).

    Rows are range-partitioned (balanced by sampling, whatever the key distribution) and
    written once, so that the partition numbers stay fixed. The offset of a partition is
    the number of rows before it; the place inside is a row number per partition. No
    task sorts more than its own range. ``total`` names a column for the row count.
    """
    ranges = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    parts = stage(ranges, "ranges")
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        *([F.sum("_n").over(W.partitionBy()).alias(total)] if total else []),
    )
    inside = W.partitionBy("_part").orderBy(*order)
    return (
        parts.withColumn("_place", F.row_number().over(inside) - 1)
        .join(offsets, "_part")
        .withColumn(name, F.col("_before") + F.col("_place"))
        .drop("_part", "_place", "_before")
    )
