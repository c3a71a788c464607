"""Basket lists, matrices, co-occurrence and association rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import binarise
from tillroll.operators.ranking import range_position


def basket_id(df: DataFrame) -> DataFrame:
    return df.withColumn("basket_id", F.concat_ws("-", "week", "shopper"))


def baskets_list(baskets: DataFrame) -> DataFrame:
    """Products, value and size per (shopper, week). Lists hold distinct products."""
    return (
        baskets.groupBy("shopper", "week")
        .agg(
            F.array_sort(F.collect_list("product")).alias("products"),
            F.sum("price").alias("price"),
        )
        .withColumn("basket_size", F.size("products"))
    )


def top_products(baskets: DataFrame, n: int = 101) -> DataFrame:
    return (
        baskets.groupBy("product")
        .agg(F.count(F.lit(1)).alias("occurence"))
        .orderBy(F.desc("occurence"), "product")
        .limit(n)
    )


def keep_top_products(baskets: DataFrame, n: int = 101) -> DataFrame:
    return baskets.join(top_products(baskets, n), "product", "left_semi")


def basket_lists(baskets: DataFrame) -> DataFrame:
    return basket_id(baskets).groupBy("basket_id").agg(
        F.array_sort(F.collect_list("product")).alias("products")
    )


def basket_sets(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set("product")).alias("products"))


def other_basket_products(baskets: DataFrame) -> DataFrame:
    """Each purchase row with the rest of its basket."""
    sets = basket_sets(baskets, ["week", "shopper"])
    rest = F.array_except("products", F.array("product"))
    return baskets.join(sets, ["week", "shopper"]).select(
        "week", "shopper", "product", rest.alias("other_products")
    )


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[int]) -> DataFrame:
    """Counts of ``row`` by the named values of ``column`` (0 where none).

    A value that is not named is an error, so that no row is lost unseen.
    """
    known = F.col(column).isNull() | F.col(column).isin(list(values))
    lost = F.raise_error(F.concat(F.lit(f"no column for {column} "), F.col(column).cast("string")))
    named = F.when(known, F.col(column)).otherwise(lost.cast(df.schema[column].dataType))
    counts = df.withColumn(column, named).groupBy(row).pivot(column, list(values)).count().fillna(0)
    return counts.select(row, *[F.col(str(v)).alias(f"{column}_{v}") for v in values])


def basket_matrix(baskets: DataFrame, values: Sequence[int]) -> DataFrame:
    """0/1 matrix basket x product for the named products."""
    wide = crosstab(basket_id(baskets), "basket_id", "product", values)
    return wide.select("basket_id", *[binarise(c).alias(c) for c in wide.columns[1:]])


def label_encode(df: DataFrame, column: str) -> DataFrame:
    """(label, code): sorted distinct labels numbered from 0."""
    labels = df.select(F.col(column).alias("label")).distinct()
    return range_position(labels, ["label"], "code").withColumn("code", F.col("code").cast("int"))


# ---- co-occurrence ----------------------------------------------------------

TILE = 64  # items of a basket that meet in one cell, about


PAIRS_A_PART = 1 << 20  # pairs that one task counts, about


def pair_parts(lines: DataFrame, basket: str, item: str) -> tuple[int, bool]:
    """(number of tasks for the pairs of some lines, whether so many pairs differ that counts
    combined before the shuffle would not save any), from one scan."""
    n, baskets, items = lines.agg(
        F.count(F.lit(1)), F.approx_count_distinct(basket), F.approx_count_distinct(item)
    ).first()
    pairs = n * max(n / max(baskets, 1) - 1, 1) / 2
    return int(pairs // PAIRS_A_PART) + 1, items * items / 2 > pairs


def pair_counts(
    lines: DataFrame, basket: str, item: str, min_count: int = 1, tile: int = TILE, parts: int = 0, apart: bool = False
) -> DataFrame:
    """(item_a, item_b, n) for item_a < item_b: number of baskets holding both.

    A basket is dealt into tiles by a hash of the item, and every two tiles meet in a cell,
    so that a cell stays small and a very large basket is spread over many of them. A cell
    expands in place; counts are combined before the shuffle. ``parts`` above the session's
    shuffle partitions deals lines, cells and, with ``apart``, the pairs over so many tasks, so
    that what a task holds does not grow with the table.
    """
    many = parts > int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    deal = lambda df, *keys: df.repartition(parts, *keys) if many else df
    held = deal(lines.select(F.col(basket).alias("basket"), F.col(item).alias("item")), "basket", "item").distinct()
    sizes = held.groupBy("basket").agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles"))
    own = F.pmod(F.xxhash64("item"), F.col("tiles"))
    met = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1))
    dealt = held.join(sizes, "basket").select("basket", "item", own.alias("own"), met.alias("met"))
    placed = dealt.withColumns({"low": F.least("own", "met"), "high": F.greatest("own", "met")})
    cells = deal(placed, "basket", "low", "high").groupBy("basket", "low", "high").agg(
        F.collect_list(F.when(F.col("own") <= F.col("met"), F.col("item"))).alias("left"),
        F.collect_list(F.when(F.col("own") >= F.col("met"), F.col("item"))).alias("right"),
    )
    pairs = cells.select("low", "high", "right", F.explode("left").alias("a")).select(
        "low", "high", "a", F.explode("right").alias("b")
    )
    met_pairs = pairs.where((F.col("low") < F.col("high")) | (F.col("a") < F.col("b"))).select(
        F.least("a", "b").alias("item_a"), F.greatest("a", "b").alias("item_b")
    )
    return (
        (deal(met_pairs, "item_a", "item_b") if apart else met_pairs)
        .groupBy("item_a", "item_b")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_count)
    )


def _both_ways(pairs: DataFrame) -> DataFrame:
    ways = F.array(
        F.struct(F.col("item_a"), F.col("item_b"), "n"),
        F.struct(F.col("item_b").alias("item_a"), F.col("item_a").alias("item_b"), "n"),
    )
    return pairs.select(F.inline(ways))


def cooccurrence(
    lines: DataFrame, basket: str, item: str, min_count: int = 1, tile: int = TILE
) -> DataFrame:
    """``pair_counts`` as a symmetric table: each pair in both orders."""
    parts, apart = pair_parts(lines, basket, item)
    return _both_ways(pair_counts(lines, basket, item, min_count, tile, parts, apart))


# ---- frequent item sets -----------------------------------------------------


def _frequent(lines: DataFrame, basket: str, item: str, min_support: float):
    """(number of baskets, least count, frequent items, frequent pairs).

    Only frequent items can form frequent pairs, so the others leave before counting.
    """
    n = lines.agg(F.countDistinct(basket).alias("n")).scalar()
    least = F.ceil(n * F.lit(min_support))
    held = lines.select(basket, item).distinct()
    items = held.groupBy(item).agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least)
    kept = held.join(items, item, "left_semi")
    pairs = pair_counts(kept, basket, item).where(F.col("n") >= least)
    return n, items, pairs


def frequent_itemsets(
    lines: DataFrame, basket: str, item: str, min_support: float
) -> DataFrame:
    """(items, size, freq, support) of all frequent sets of one or two items.

    Counted exactly, whatever the length of a basket.
    """
    n, items, pairs = _frequent(lines, basket, item, min_support)
    one = items.select(F.array(item).alias("items"), "freq")
    two = pairs.select(
        F.array("item_a", "item_b").alias("items"), F.col("n").alias("freq")
    )
    sets = one.unionByName(two)
    return sets.select("items", F.size("items").alias("size"), "freq").withColumn(
        "support", F.col("freq") / n
    )


def association_rules(
    lines: DataFrame, basket: str, item: str, min_support: float
) -> DataFrame:
    """Rules item -> item with support, confidence and lift."""
    n, items, pairs = _frequent(lines, basket, item, min_support)
    left = items.select(F.col(item).alias("item_a"), F.col("freq").alias("freq_a"))
    right = items.select(F.col(item).alias("item_b"), F.col("freq").alias("freq_b"))
    confidence = F.col("n") / F.col("freq_a")
    return (
        _both_ways(pairs)
        .join(left, "item_a")
        .join(right, "item_b")
        .select(
            F.col("item_a").alias("antecedent"),
            F.col("item_b").alias("consequent"),
            (F.col("n") / n).alias("support"),
            confidence.alias("confidence"),
            (confidence / (F.col("freq_b") / n)).alias("lift"),
        )
    )


def mine_itemsets(lists: DataFrame, min_support: float):
    """Item sets and rules of any size from ``products`` lists, by parallel FP-growth.

    The number of sets can grow with two to the power of the basket length, so choose a
    support that fits long baskets; sets of two need no such care above.
    """
    return FPGrowth(itemsCol="products", minSupport=min_support, minConfidence=0.0).fit(lists)
