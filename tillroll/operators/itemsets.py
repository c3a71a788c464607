"""Frequent item sets of every size, level by level, and rules between sets.

Sets are sorted arrays. Occurrences (basket, set) of one level come from those of the level
below and one more held item, so a long basket is spread over many rows, and the last join
has unique keys on one side. Baskets with the same frequent items are expanded once and counted
as often as they occur. Only sets that pass the support at one level take part in the
next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.sources.workspace import stage


def _frequent(occurrences: DataFrame, least: Column) -> DataFrame:
    counts = occurrences.groupBy("items").agg(F.sum("n").alias("freq"))
    return stage(counts.where(F.col("freq") >= least), "itemsets")


def candidates(sets: DataFrame, size: int) -> DataFrame:
    """(prefix, last): sets of ``size`` items all of whose parts one item smaller are in ``sets``.

    Two sets with the same items but the last make a candidate; its other parts are looked up.
    """
    head = lambda c: F.slice(c, 1, size - 2)
    last = F.element_at("items", -1)
    left = sets.select(head("items").alias("head"), last.alias("a"))
    right = sets.select(head("items").alias("head"), last.alias("b"))
    joined = left.join(right, "head").where("a < b").select(F.concat("head", F.array("a", "b")).alias("items"))
    if size > 2:
        # the two sets of the join are parts already; the other size - 2 leave out an early item
        out = F.transform(F.sequence(F.lit(1), F.lit(size - 2)), lambda i: F.concat(F.slice("items", F.lit(1), i - 1), F.slice("items", i + 1, F.lit(size))))
        parts = joined.select("items", F.explode(out).alias("part"))
        known = sets.select(F.col("items").alias("part"))
        whole = parts.join(known, "part", "left_semi").groupBy("items").agg(F.count(F.lit(1)).alias("n"))
        joined = whole.where(F.col("n") == size - 2).select("items")
    return joined.select(F.slice("items", 1, size - 1).alias("prefix"), F.element_at("items", -1).alias("item"))


def equal_baskets(held: DataFrame) -> DataFrame:
    """(basket, item, n) of baskets that hold the same items: one stands for all ``n`` of them.

    ``held`` has distinct (basket, item) of frequent items only, so that no list is longer than
    the mean basket divided by the least support.
    """
    lists = held.groupBy("basket").agg(F.array_sort(F.collect_list("item")).alias("held"))
    # lines without a basket count as items, but share no basket
    classes = lists.groupBy("held", F.isnotnull("basket").alias("known")).agg(F.count(F.lit(1)).alias("n"))
    number = F.when(F.col("known"), F.monotonically_increasing_id())
    classes = stage(classes.select("held", "n", number.alias("basket")), "baskets")
    return classes.select("basket", F.explode("held").alias("item"), "n")


def frequent_sets(lines: DataFrame, basket: str, item: str, min_support: float, max_size: int = 4) -> DataFrame:
    """(items, size, freq, support, baskets) of all sets of up to ``max_size`` items that are in at least
    ``min_support`` of the baskets. Repeated lines count once; null items are left out."""
    held = lines.select(F.col(basket).alias("basket"), F.col(item).alias("item")).distinct()
    n = held.agg(F.countDistinct("basket")).first()[0]
    least = F.ceil(n * F.lit(min_support))
    held = held.where("item is not null")
    single = held.groupBy("item").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= least)
    held = equal_baskets(held.join(single.select("item"), "item", "left_semi"))
    occurrences = held.select("basket", F.array("item").alias("items"), "n")
    held = held.select("basket", "item")
    found = _frequent(occurrences, least)
    levels = [found]
    for size in range(2, max_size + 1):
        if levels[-1].isEmpty():
            break
        grown = candidates(levels[-1], size)
        longer = occurrences.join(grown, occurrences["items"] == grown["prefix"]).select("basket", "items", "item", "n")
        longer = longer.join(held, ["basket", "item"], "left_semi")
        occurrences = stage(longer.select("basket", F.concat("items", F.array("item")).alias("items"), "n"), "occurrences")
        levels.append(_frequent(occurrences, least))
        # a set that is not frequent is in none that is
        occurrences = occurrences.join(levels[-1].select("items"), "items", "left_semi")
    sets = levels[0]
    for level in levels[1:]:
        sets = sets.unionByName(level)
    total = F.lit(n).cast("long").alias("baskets")
    return sets.select("items", F.size("items").alias("size"), "freq", (F.col("freq") / n).alias("support"), total)


def set_rules(sets: DataFrame, max_items: int) -> DataFrame:
    """Rules between all parts of frequent sets: (antecedent, consequent, support, confidence, lift).

    ``sets`` is what ``frequent_sets`` returns; ``max_items`` bounds the items of both sides
    together (at most 20). Every part of a frequent set is frequent, so both sides are found.
    """
    if not 2 <= max_items <= 20:
        raise ValueError("a rule has 2 to 20 items")
    whole = sets.where(F.col("size").between(2, max_items))
    masks = F.sequence(F.lit(1), F.pow(F.lit(2), F.col("size")).cast("int") - 2)
    split = whole.select("items", "freq", "support", "baskets", F.explode(masks).alias("mask"))
    side = lambda want: F.filter("items", lambda _, i: F.getbit("mask", i) == want)
    rules = split.select("freq", "support", "baskets", side(1).alias("antecedent"), side(0).alias("consequent"))
    left = sets.select(F.col("items").alias("antecedent"), F.col("freq").alias("of_antecedent"))
    right = sets.select(F.col("items").alias("consequent"), F.col("freq").alias("of_consequent"))
    expected = F.col("of_antecedent").cast("double") * F.col("of_consequent")
    return (
        rules.join(left, "antecedent")
        .join(right, "consequent")
        .select(
            "antecedent",
            "consequent",
            "support",
            (F.col("freq") / F.col("of_antecedent")).alias("confidence"),
            (F.col("freq").cast("double") * F.col("baskets") / expected).alias("lift"),
        )
    )
