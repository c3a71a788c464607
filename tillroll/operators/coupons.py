"""Coupon selection: heuristic shares, discount scenarios, expected revenue, uplift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.operators.ranking import top_k

# Discounts tried per candidate, and discount by coupon rank.
DISCOUNTS = (15, 20, 25, 30)
RANK_DISCOUNT = {0: 30, 1: 25, 2: 20, 3: 15, 4: 15}

RECOMMENDATION_COLUMNS = ["shopper", "week", "coupon", "product", "discount"]


def heuristic_features(baskets: DataFrame, coupons: DataFrame) -> DataFrame:
    """Coupon use per (shopper, product), with the shopper totals next to it."""
    return coupon_use(baskets.join(coupons, ["week", "shopper", "product"], "left"))


def coupon_use(purchases: DataFrame) -> DataFrame:
    """``heuristic_features`` of purchases that carry the discount of their offer, if any."""
    discount = F.coalesce(F.col("discount"), F.lit(0))
    rows = purchases.withColumn("discount", discount).withColumn(
        "discounted", F.when(discount > 0, 1).otherwise(0)
    )
    pair = rows.groupBy("shopper", "product").agg(
        F.avg("week").alias("week"),
        F.avg("price").alias("price"),
        F.avg("discount").alias("discount"),
        F.avg("discounted").alias("dis_prod_share"),
        F.sum("discounted").alias("product_discount_buys"),
        F.count(F.lit(1)).alias("product_buys"),
    )
    # A shopper has at most one row per product here, so totals come from a window.
    shopper = W.partitionBy("shopper")
    buys = F.sum("product_buys").over(shopper)
    return pair.withColumns(
        {
            "buys": buys,
            "unique_products": F.count(F.lit(1)).over(shopper),
            "discount_buys": F.sum("product_discount_buys").over(shopper) / buys,
        }
    )


def heuristic_filter(features: DataFrame) -> DataFrame:
    """Pairs with repeated coupon buys that are bought more often than the average item."""
    return features.where(
        (F.col("product_discount_buys") > 1)
        & (F.col("product_buys") > F.col("buys") / F.col("unique_products"))
    )


def rank_discount(rank: Column) -> Column:
    pairs = [F.lit(x) for kv in RANK_DISCOUNT.items() for x in kv]
    return F.element_at(F.create_map(*pairs), rank)


def coupon_slots(shoppers: DataFrame, week: int, n: int = 5) -> DataFrame:
    """The coupon index: n numbered coupons per shopper."""
    slots = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("coupon")
    return shoppers.select("shopper").distinct().select("shopper", F.lit(week).alias("week"), slots)


def heuristic_coupons(features: DataFrame, index: DataFrame) -> DataFrame:
    """Fill the index: top products by coupon share, discount by coupon rank.

    Filled on (shopper, coupon); a shopper with fewer products keeps open slots.
    """
    best = top_k(
        features, ["shopper"], [F.desc("dis_prod_share"), F.asc("product")], 5, rank="coupon"
    )
    return (
        index.join(best.select("shopper", "coupon", "product"), ["shopper", "coupon"], "left")
        .withColumn("discount", rank_discount(F.col("coupon")))
        .select(*RECOMMENDATION_COLUMNS)
    )


def discount_scenarios(candidates: DataFrame, discounts: tuple[int, ...] = DISCOUNTS) -> DataFrame:
    """Each candidate under each discount, with the price it would then have."""
    tried = F.explode(F.array(*[F.lit(d) for d in discounts])).alias("discount")
    kept = [c for c in candidates.columns if c not in ("discount", "price")]
    return candidates.select(*kept, tried).withColumn(
        "price", F.col("max_price") * (1 - F.col("discount") / F.lit(100.0))
    )


def history_score(candidates: DataFrame) -> DataFrame:
    """Closed-form purchase probability from the pair's own history.

    base rate = (purchases + 1) / (shopping weeks + 2); the answer to a discount grows
    with the share of the pair's purchases that were made on a coupon.
    """
    base = (F.col("n_bought") + 1) / (F.col("n_weeks") + F.lit(2.0))
    lift = 1 + (1 + 3 * F.col("coupon_share")) * F.col("discount") / F.lit(100.0)
    return candidates.withColumn("proba", F.least(F.lit(1.0), base * lift))


def candidate_history(rows: DataFrame, prefs: DataFrame, target_week: int) -> DataFrame:
    """Preferred pairs with the history columns ``history_score`` needs."""
    bought = rows.where(F.col("product_bought") == 1)
    pair = bought.groupBy("shopper", "product").agg(
        F.count(F.lit(1)).alias("n_bought"), F.avg("discount_offered").alias("coupon_share")
    )
    weeks = bought.groupBy("shopper").agg(F.countDistinct("week").alias("n_weeks"))
    price = rows.groupBy("product").agg(F.max("price").alias("max_price"))
    return (
        prefs.select("shopper", "product")
        .join(pair, ["shopper", "product"])
        .join(weeks, "shopper")
        .join(price, "product")
        .withColumn("week", F.lit(target_week))
    )


def expected_revenue(scored: DataFrame) -> DataFrame:
    return scored.withColumn("e_revenue", F.round(F.col("price") * F.col("proba"), 6))


def assign_coupons(scored: DataFrame, value: str = "e_revenue", k: int = 5) -> DataFrame:
    """Best discount per pair, then the k best pairs per shopper.

    The best discount is an aggregate (combined before the shuffle); ties go to the
    smaller product, then to the smaller discount.
    """
    best = (
        scored.groupBy("shopper", "product")
        .agg(
            F.max_by(
                F.struct("week", "discount", value), F.struct(F.col(value), -F.col("discount"))
            ).alias("b")
        )
        .select("shopper", "product", "b.*")
    )
    ranked = top_k(best, ["shopper"], [F.desc(value), F.asc("product")], k, rank="coupon")
    return ranked.select(*RECOMMENDATION_COLUMNS, value)


def uplift(candidates: DataFrame) -> DataFrame:
    """price * [(1 - d) * p(d) - p(0)] per pair and discount."""
    plain = history_score(candidates.withColumn("discount", F.lit(0)))
    base = plain.select(*candidates.columns, F.col("proba").alias("proba_0"))
    scored = history_score(discount_scenarios(base))
    gain = (1 - F.col("discount") / F.lit(100.0)) * F.col("proba") - F.col("proba_0")
    return scored.withColumn("uplift", F.round(F.col("max_price") * gain, 6))


def coupon_hit_rate(recommended: dict[str, DataFrame], offered: DataFrame) -> DataFrame:
    """Share of the offered coupons of a week that each recommender also chose."""
    named = None
    for name, recs in recommended.items():
        part = recs.select(F.lit(name).alias("model"), "shopper", "product")
        named = part if named is None else named.unionByName(part)
    total = offered.agg(F.count(F.lit(1)).alias("n")).scalar()
    hits = named.join(offered.select("shopper", "product"), ["shopper", "product"])
    counted = hits.groupBy("model").agg(F.count(F.lit(1)).alias("n_hits"))
    return counted.select(
        "model",
        "n_hits",
        total.alias("n_offered"),
        F.try_divide("n_hits", total).alias("hit_rate"),
    )
