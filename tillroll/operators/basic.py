"""Merging purchases with offers, flags and null policy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["week", "shopper", "product"]


def purchase_coupon_outer(baskets: DataFrame, coupons: DataFrame) -> DataFrame:
    """Full outer merge on the unique key (week, shopper, product)."""
    return baskets.join(coupons, KEY, "full")


def merge_samples(offers: DataFrame, samples: DataFrame) -> DataFrame:
    """Add sampled not-bought keys that are not offers or purchases already."""
    return offers.join(samples.select(*KEY), KEY, "full")


def purchase_flags(df: DataFrame) -> DataFrame:
    """Five 0/1 flags. A row is bought when it has a price, offered when discount > 0."""
    offered = F.coalesce(F.col("discount"), F.lit(0)) != 0
    bought = F.col("price").isNotNull()
    flag = lambda cond: F.when(cond, 1).otherwise(0)
    return df.withColumns(
        {
            "discount_offered": flag(offered),
            "product_bought": flag(bought),
            "purchase_wo_dis": flag(bought & ~offered),
            "no_purchase_w_dis": flag(~bought & offered),
            "discount_effect": flag(bought & offered),
        }
    )


def enrich_category(df: DataFrame, categories: DataFrame) -> DataFrame:
    """``categories`` has one row per product and goes to the rows: by product, they would meet in
    as many tasks as there are products."""
    return df.join(F.broadcast(categories), "product", "left")


def impute_nulls(df: DataFrame) -> DataFrame:
    """0 for a missing price or discount, -1 ("never") for missing history features."""
    zero = [c for c in ("price", "discount") if c in df.columns]
    never = [
        c
        for c in (
            "avg_no_weeks_between_two_purchases",
            "purchase_temporal_distribution",
            "lag_weeks_of_product_per_customer",
        )
        if c in df.columns
    ]
    return df.fillna(0, zero).fillna(-1, never)


def impute_price(df: DataFrame, max_price: DataFrame) -> DataFrame:
    """Missing price := max_price * (1 - discount / 100).

    ``max_price`` is keyed by product; its further columns come along.
    """
    offered_price = F.col("max_price") * (
        1 - F.coalesce(F.col("discount"), F.lit(0)) / F.lit(100.0)
    )
    return df.join(max_price, "product", "left").withColumn(
        "price", F.coalesce(F.col("price"), offered_price)
    )


def between_weeks(df: DataFrame, start: int, end: int) -> DataFrame:
    return df.where(F.col("week").between(start, end))


def drop_empty_weeks(df: DataFrame, week_shopper: DataFrame) -> DataFrame:
    """Attach week_basket_size / week_basket_value; drop shopper-weeks without purchase."""
    return df.join(week_shopper, ["week", "shopper"], "left").where(
        F.col("week_basket_size").isNotNull()
    )


def overlay(master: DataFrame, update: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Overlay the non-null values of ``update`` on the rows of ``master``."""
    new = update.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    return (
        master.join(new, keys, "left")
        .withColumns({c: F.coalesce(F.col(f"_new_{c}"), F.col(c)) for c in columns})
        .drop(*[f"_new_{c}" for c in columns])
    )


def calendar(df: DataFrame, keys: list[str], start: int, end: int) -> DataFrame:
    """One row per distinct key and week of [start, end]: a row-local expansion."""
    weeks = F.explode(F.sequence(F.lit(start), F.lit(end))).alias("week")
    return df.select(*keys).distinct().select(*keys, weeks)


def pair_grid_counts(purchases: DataFrame, start: int, end: int) -> DataFrame:
    """(week, product, pairs, bought): purchases laid over all weeks of every (shopper, product) pair,
    counted per week and product.

    A pair has one row a week, or as many as it has purchases in it. So the rows of a product in a week
    are its pairs and the purchases beyond the first of each pair, and the grid need not be laid out:
    one row per product is expanded. Purchases without shopper or product fall on no row of the grid.
    """
    pairs = purchases.select("shopper", "product").distinct().groupBy("product").agg(F.count(F.lit(1)).alias("n"))
    on_grid = purchases.where(F.col("week").between(start, end)).dropna(subset=["shopper", "product"])
    met = on_grid.groupBy(*KEY).agg((F.count(F.lit(1)) - 1).alias("more"), F.count("price").alias("bought"))
    met = met.groupBy("week", "product").agg(F.sum("more").alias("more"), F.sum("bought").alias("bought"))
    weeks = F.explode(F.sequence(F.lit(start), F.lit(end))).alias("week")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return pairs.select("product", "n", weeks).join(met, ["week", "product"], "left").select(
        "week", "product", (F.col("n") + zero("more")).alias("pairs"), zero("bought").alias("bought")
    )
