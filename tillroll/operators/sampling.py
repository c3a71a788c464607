"""Purchase frequencies, preferences, negative samples and target-week candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.functions.columns import draw_key, draw_number
from tillroll.operators.ranking import split_row_number
from tillroll.sources.workspace import stage


def pair_frequency(baskets: DataFrame, holdout_week: int) -> DataFrame:
    """Purchases per pair: in all weeks, without the holdout week, only in it."""
    in_holdout = F.col("week") == holdout_week
    return baskets.groupBy("shopper", "product").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(~in_holdout).alias("n_history"),
        F.count_if(in_holdout).alias("n_holdout"),
    )


def preferences(baskets: DataFrame, holdout_week: int, min_frequency: int = 3) -> DataFrame:
    """Pairs bought at least ``min_frequency`` times before the holdout week."""
    return (
        baskets.where(F.col("week") != holdout_week)
        .groupBy("shopper", "product")
        .agg(F.count(F.lit(1)).alias("frequency"))
        .where(F.col("frequency") >= min_frequency)
    )


def target_candidates(prefs: DataFrame, target_week: int) -> DataFrame:
    return prefs.select(
        F.lit(target_week).alias("week"),
        "shopper",
        "product",
        F.lit(None).cast("int").alias("product_bought"),
    )


def _draws(seed: int) -> Column:
    """As many of ``_wanted`` without ``_held`` as ``_held`` has, lowest hash key first."""
    draws = F.array_sort(
        F.transform(
            F.array_except("_wanted", "_held"),
            lambda p: F.struct(draw_key(seed, "week", "shopper", p).alias("k"), p.alias("p")),
        )
    )
    return F.slice(draws, F.lit(1), F.size("_held"))


def negative_samples(baskets: DataFrame, prefs: DataFrame, seed: int = 42) -> DataFrame:
    """Per basket, as many preferred but not bought products as it has items.

    Preference lists and baskets hold distinct products, so their length is bounded by
    the product range. The draw is row-local after one join on shopper: set difference,
    order by a hash key, keep the first items.
    """
    wanted = prefs.groupBy("shopper").agg(F.collect_list("product").alias("_wanted"))
    held = baskets.groupBy("week", "shopper").agg(F.collect_set("product").alias("_held"))
    return (
        held.join(wanted, "shopper")
        .select("week", "shopper", F.explode(_draws(seed)).alias("_draw"))
        .select(
            "week",
            "shopper",
            F.col("_draw.p").alias("product"),
            F.lit(0).alias("product_bought"),
        )
    )


def with_negatives(offers: DataFrame, prefs: DataFrame, seed: int = 42) -> DataFrame:
    """``offers`` and the ``negative_samples`` of its purchases (the rows with a price).

    Equal to ``merge_samples(offers, negative_samples(baskets, prefs))``, in one shuffle of the
    offers: those of a basket's week are at hand where its negatives are drawn, so drawn
    products that were offered are left out there. An open week meets no offer.
    """
    kind = {c: offers.schema[c].dataType for c in ("price", "discount")}
    never = lambda p: F.struct(p.alias("product"), *[F.lit(None).cast(t).alias(c) for c, t in kind.items()])
    bought = F.filter("_offers", lambda o: o["price"].isNotNull() & o["product"].isNotNull())
    wanted = prefs.groupBy("shopper").agg(F.collect_list("product").alias("_wanted"))
    weeks = (
        offers.repartition("shopper")
        .groupBy("week", "shopper")
        .agg(F.collect_list(F.struct("product", "price", "discount")).alias("_offers"))
        .withColumn("_held", F.array_distinct(bought["product"]))
        .join(wanted, "shopper", "left")
        .withColumn("_drawn", _draws(seed)["p"])
    )
    fresh = F.when(F.col("week").isNull(), F.col("_drawn")).otherwise(F.array_except("_drawn", F.col("_offers")["product"]))
    none = F.filter("_offers", lambda _: F.lit(False))
    rows = F.concat("_offers", F.coalesce(F.transform(fresh, never), none))
    return weeks.select("week", "shopper", F.inline(rows))


def negatives_same_category(baskets: DataFrame, categories: DataFrame, seed: int = 42) -> DataFrame:
    """One not-bought product per bought row, sold that week in the same category.

    The candidate list of a (week, category) holds distinct products only. Rows whose
    category offers nothing else get no sample.
    """
    rows = baskets.join(categories, "product")
    sold = rows.groupBy("week", "category_label").agg(F.collect_set("product").alias("_sold"))
    held = baskets.groupBy("week", "shopper").agg(F.collect_set("product").alias("_held"))
    pick = F.array_min(
        F.transform(
            F.array_except("_sold", "_held"),
            lambda p: F.struct(
                draw_key(seed, "week", "shopper", "product", p).alias("k"), p.alias("p")
            ),
        )
    )
    return (
        rows.join(held, ["week", "shopper"])
        .join(sold, ["week", "category_label"])
        .select("week", "shopper", "category_label", "product", pick.alias("_pick"))
        .where(F.col("_pick").isNotNull())
        .select(
            "week",
            "shopper",
            "category_label",
            F.col("product").alias("bought_product"),
            F.col("_pick.p").alias("product"),
            F.lit(0).alias("product_bought"),
        )
    )


def category_index(baskets: DataFrame, categories: DataFrame) -> DataFrame:
    """(week, category_label, product, rank, n_sold): products sold in a week, numbered from 0
    by product inside their category, in slices of 4,096 product numbers."""
    sold = baskets.join(categories, "product").select("week", "category_label", "product").distinct()
    sliced = sold.withColumn("_slice", F.floor(F.col("product") / 4096))
    numbered = split_row_number(sliced, ["week", "category_label"], ["_slice"], ["product"], "rank")
    sizes = sold.groupBy("week", "category_label").agg(F.count(F.lit(1)).alias("n_sold"))
    return (
        numbered.withColumn("rank", F.col("rank") - 1)
        .drop("_slice")
        .join(sizes, ["week", "category_label"])
    )


def negatives_by_rank(baskets: DataFrame, categories: DataFrame, seed: int = 42) -> DataFrame:
    """One not-bought product per bought row, drawn evenly from those sold that week in its category.

    No row carries a list of products. Of the S products sold in the (week, category) a
    shopper holds H, so the draw is a number r below S - H: the place among the products that
    are not held. Held products with ranks h0 < h1 < ... push it up: its rank is r plus the
    number of i with h(i) - i <= r. That number comes from one running count over the held
    ranks and the draws of a (week, shopper, category), so nothing has to be drawn twice.

    Rows that repeat (week, shopper, product) get draws of their own. Rows without category,
    with a null key, or whose category offers nothing else get no sample. The index, a row
    per week and product, is written once to the shared folder.
    """
    index = stage(category_index(baskets, categories), "category-index")
    held = (
        baskets.join(categories, "product")
        .groupBy("week", "shopper", "category_label", "product")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .join(index, ["week", "category_label", "product"])
    )
    group = W.partitionBy("week", "shopper", "category_label")
    place = F.row_number().over(group.orderBy("rank")) - 1
    free = F.col("n_sold") - F.count(F.lit(1)).over(group)
    draw = draw_number(seed, "week", "shopper", "product", "_copy") % F.col("_free")
    # Copy 0 stands for the held product itself, the others for one draw each.
    marks = (
        held.withColumns({"_gap": F.col("rank") - place, "_free": free})
        .where(F.col("_free") > 0)
        .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies").cast("int"))))
        .withColumn("_at", F.when(F.col("_copy") == 0, F.col("_gap")).otherwise(draw))
    )
    before = group.orderBy("_at", F.col("_copy") > 0).rowsBetween(W.unboundedPreceding, 0)
    pushed = F.count_if(F.col("_copy") == 0).over(before)
    draws = marks.withColumn("rank", (F.col("_at") + pushed).cast("int")).where("_copy > 0")
    return draws.select(
        "week", "category_label", "rank", "shopper", F.col("product").alias("bought_product")
    ).join(index.drop("n_sold"), ["week", "category_label", "rank"]).select(
        "week",
        "shopper",
        "category_label",
        "bought_product",
        "product",
        F.lit(0).alias("product_bought"),
    )
