"""Feature aggregates: one grouping per grain, joined once.

Input rows carry (week, shopper, product, price, discount) and the purchase flags;
price is null where nothing was bought.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.operators import basic


def _bought(value: Column | str) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.when(F.col("product_bought") == 1, value)


def max_price(rows: DataFrame) -> DataFrame:
    """Highest price per product; ``product_features`` carries it as well."""
    return rows.groupBy("product").agg(
        F.coalesce(F.max("price"), F.lit(0.0)).alias("max_price")
    )


def min_price(baskets: DataFrame) -> DataFrame:
    """Lowest price over all purchases handed in (the whole history by default)."""
    return baskets.groupBy("product").agg(F.min("price").alias("min_price"))


def product_features(rows: DataFrame) -> DataFrame:
    agg = rows.groupBy("product").agg(
        F.coalesce(F.max("price"), F.lit(0.0)).alias("max_price"),
        F.sum("product_bought").alias("product_sells"),
        F.sum(_bought("discount_offered")).alias("product_dis_sells"),
    )
    return agg.withColumn(
        "product_dis_sells_share", F.try_divide("product_dis_sells", "product_sells")
    )


def week_shopper_features(rows: DataFrame) -> DataFrame:
    return (
        rows.where(F.col("product_bought") == 1)
        .groupBy("week", "shopper")
        .agg(
            F.count(F.lit(1)).alias("week_basket_size"),
            F.sum("price").alias("week_basket_value"),
        )
    )


def shopper_features(rows: DataFrame) -> DataFrame:
    """Shopper grain, built from the (shopper, week) grain so no shopper is one group.

    mean_basket_size / mean_basket_value average over purchase rows, so a basket
    counts once per item in it: sum(n*n)/sum(n) and sum(n*v)/sum(n).
    """
    bought = rows.where(F.col("product_bought") == 1)
    weekly = bought.groupBy("shopper", "week").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("price").alias("v"),
        F.sum("discount_offered").alias("d"),
    )
    totals = weekly.groupBy("shopper").agg(
        F.sum("n").alias("no_products_bought"),
        F.sum("v").alias("spend_per_customer"),
        F.sum("d").alias("discount_purchase"),
        (F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("mean_basket_size"),
        (F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("mean_basket_value"),
    )
    unique = bought.groupBy("shopper").agg(
        F.countDistinct("product").alias("no_unique_products")
    )
    return (
        totals.join(unique, "shopper")
        .withColumn(
            "customer_mean_product_price",
            F.try_divide("spend_per_customer", "no_products_bought"),
        )
        .withColumn(
            "customer_discount_buy_share",
            F.try_divide("discount_purchase", "no_products_bought"),
        )
    )


def _pair_columns() -> dict[str, Column]:
    offered = F.col("discount_offered") == 1
    return {
        "no_products_bought_per_product": F.sum(_bought(F.lit(1))),
        "customer_prod_dis_purchases": F.sum(_bought("discount_effect")),
        "customer_prod_bought_dis_share": F.avg(_bought("discount_effect")),
        "customer_prod_dis_offers": F.count(F.lit(1)),
        "customer_prod_dis_offers_sum": F.sum("discount_offered"),
        "customer_prod_dis_offered_share": F.avg(F.when(offered, F.col("product_bought"))),
    }


def shopper_product_features(rows: DataFrame) -> DataFrame:
    """customer_prod_dis_offers counts rows; the number of offers is *_sum."""
    return rows.groupBy("shopper", "product").agg(*[c.alias(n) for n, c in _pair_columns().items()])


PAIR_NEVER = [
    "customer_product_share",
    "no_products_bought_per_product",
    "customer_prod_dis_purchases",
    "customer_prod_bought_dis_share",
    "customer_prod_dis_offered_share",
]

# Column order of the finished feature table.
FEATURE_COLUMNS = [
    "week",
    "shopper",
    "product",
    "price",
    "discount",
    "product_bought",
    "category_label",
    "avg_no_weeks_between_two_purchases",
    "lag_weeks_of_product_per_customer",
    "purchase_temporal_distribution",
    "discount_offered",
    "purchase_wo_dis",
    "no_purchase_w_dis",
    "discount_effect",
    "max_price",
    "min_price",
    "no_products_bought",
    "spend_per_customer",
    "no_unique_products",
    "discount_purchase",
    "product_sells",
    "product_dis_sells",
    "product_dis_sells_share",
    "no_products_bought_per_product",
    "customer_prod_dis_purchases",
    "customer_prod_bought_dis_share",
    "customer_prod_dis_offers",
    "customer_prod_dis_offered_share",
    "customer_product_share",
    "customer_mean_product_price",
    "customer_discount_buy_share",
    "week_basket_size",
    "week_basket_value",
    "mean_basket_size",
    "mean_basket_value",
]

# Known only after the purchase, or not available for a coming week.
LEAKAGE_COLUMNS = [
    "product_bought",
    "shopper",
    "product",
    "purchase_wo_dis",
    "no_purchase_w_dis",
    "discount_effect",
    "week_basket_size",
    "week_basket_value",
    "discount_offered",
]

MODEL_FEATURES = [c for c in FEATURE_COLUMNS if c not in LEAKAGE_COLUMNS]


def _pair_and_shopper_features(rows: DataFrame) -> DataFrame:
    """Pair features with the shopper totals that follow from them.

    Distinct products and coupon purchases of a shopper are sums over the shopper's
    pairs, so they are taken from the pair table (at most one row per product and
    shopper) instead of from the rows again.
    """
    shopper = W.partitionBy("shopper")
    return (
        shopper_product_features(rows)
        .drop("customer_prod_dis_offers_sum")
        .withColumns(
            {
                "no_unique_products": F.count("no_products_bought_per_product").over(shopper),
                "discount_purchase": F.sum("customer_prod_dis_purchases").over(shopper),
            }
        )
    )


def _basket_features(weekly: DataFrame) -> DataFrame:
    n, v = F.col("week_basket_size"), F.col("week_basket_value")
    return weekly.groupBy("shopper").agg(
        F.sum(n).alias("no_products_bought"),
        F.sum(v).alias("spend_per_customer"),
        (F.sum(n * n) / F.sum(n)).alias("mean_basket_size"),
        (F.sum(n * v) / F.sum(n)).alias("mean_basket_value"),
    )


def _attach_grains(df: DataFrame, rows: DataFrame, weekly: DataFrame, baskets: DataFrame):
    """Join the pair, shopper and price features onto ``df``."""
    n = "no_products_bought"
    return (
        df.join(_pair_and_shopper_features(rows), ["shopper", "product"], "left")
        .join(_basket_features(weekly), "shopper", "left")
        .join(min_price(baskets), "product", "left")
        .withColumns(
            {
                "customer_product_share": F.try_divide("no_products_bought_per_product", n),
                "customer_mean_product_price": F.try_divide("spend_per_customer", n),
                "customer_discount_buy_share": F.try_divide("discount_purchase", n),
            }
        )
        .fillna(-1, PAIR_NEVER)
    )


def _by_shopper(rows: DataFrame) -> DataFrame:
    """Rows of known shoppers, all rows of a shopper in one task: one per week and product at most."""
    return rows.where(F.col("shopper").isNotNull()).repartition("shopper")


def _with_pairs(rows: DataFrame) -> DataFrame:
    """Pair features on rows that lie together by shopper; ``_first`` is the week of a pair's first
    purchase. Rows without product belong to no pair."""
    pair = W.partitionBy("shopper", "product")
    known = F.col("product").isNotNull()
    columns = {n: F.when(known, c.over(pair)) for n, c in _pair_columns().items()}
    del columns["customer_prod_dis_offers_sum"]
    return rows.withColumns({**columns, "_first": F.min(_bought("week")).over(pair)})


def _with_weeks(rows: DataFrame) -> DataFrame:
    week = W.partitionBy("shopper", "week")
    return rows.withColumns(
        {
            "week_basket_size": F.count(_bought(F.lit(1))).over(week),
            "week_basket_value": F.sum(_bought("price")).over(week),
        }
    )


def _with_shoppers(rows: DataFrame) -> DataFrame:
    """Shopper features on rows with pair and week features.

    A basket counts once per item in the means. Every product has one first purchase, so
    these count the distinct products.
    """
    shopper = W.partitionBy("shopper")
    known = F.col("product").isNotNull()
    first = F.when(F.col("week") == F.col("_first"), F.lit(1))
    n = F.col("no_products_bought")
    totals = {
        "no_products_bought": F.count(_bought(F.lit(1))).over(shopper),
        "spend_per_customer": F.sum(_bought("price")).over(shopper),
        "mean_basket_size": F.avg(_bought("week_basket_size")).over(shopper),
        "mean_basket_value": F.avg(_bought("week_basket_value")).over(shopper),
        "no_unique_products": F.when(known, F.count(_bought(first)).over(shopper)),
        "discount_purchase": F.when(known, F.sum(_bought("discount_effect")).over(shopper)),
    }
    return rows.withColumns(totals).withColumns(
        {
            "customer_product_share": F.try_divide("no_products_bought_per_product", n),
            "customer_mean_product_price": F.try_divide("spend_per_customer", n),
            "customer_discount_buy_share": F.try_divide("discount_purchase", n),
        }
    )


def _finished(described: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of the shopper-weeks with a purchase; open prices and history filled in.

    Product features have one line per product, so they go to the rows instead of the
    rows to them: by product, all rows would meet in as many tasks as there are products.
    """
    kept = described.where(F.col("week_basket_size") > 0)
    return basic.impute_nulls(basic.impute_price(kept, F.broadcast(product_features(rows))))


def priced_rows(base: DataFrame, start: int, end: int) -> DataFrame:
    """The rows of ``build_features`` with price, discount, flags and week and product features."""
    rows = basic.between_weeks(base, start, end)
    return _finished(_with_weeks(_by_shopper(rows)), rows)


def build_features(base: DataFrame, baskets: DataFrame, start: int, end: int) -> DataFrame:
    """The 35-column feature table of the weeks [start, end].

    ``base`` holds one row per key with flags, category and history features.
    ``baskets`` supplies min_price and may reach beyond the split. The base is read twice
    (rows, products) and shuffled once, by shopper: pair, week and shopper features are
    windows inside it.
    """
    rows = basic.between_weeks(base, start, end)
    described = _with_shoppers(_with_weeks(_with_pairs(_by_shopper(rows))))
    return (
        _finished(described, rows)
        .join(F.broadcast(min_price(baskets)), "product", "left")
        .fillna(-1, PAIR_NEVER)
        .select(*FEATURE_COLUMNS)
    )


# Columns of the coming week's table: price, discount and everything that follows from
# them are set per coupon scenario.
OPEN_COLUMNS = [
    "price",
    "discount",
    "discount_offered",
    "purchase_wo_dis",
    "no_purchase_w_dis",
    "discount_effect",
    "week_basket_size",
    "week_basket_value",
]
TARGET_COLUMNS = [c for c in FEATURE_COLUMNS if c not in OPEN_COLUMNS]


def target_features(targets: DataFrame, base: DataFrame, baskets: DataFrame) -> DataFrame:
    """The 27-column table of candidate rows in a coming week, from the history in ``base``.

    ``targets`` are (week, shopper, product, product_bought = null, lag, category and
    history columns).
    """
    priced = targets.join(product_features(base), "product", "left")
    weekly = week_shopper_features(base)
    return _attach_grains(basic.impute_nulls(priced), base, weekly, baskets).select(
        *TARGET_COLUMNS
    )


def feature_variants(rows: DataFrame) -> DataFrame:
    """Alternative definitions used by the exploratory feature sets, per purchase row."""
    bought = rows.where(F.col("product_bought") == 1)
    weekly = bought.groupBy("shopper", "week").agg(F.count(F.lit(1)).alias("n"))
    events = weekly.groupBy("shopper").agg(
        F.count(F.lit(1)).alias("no_shopping_events"), F.sum("n").alias("no_products_bought")
    )
    offers = bought.groupBy("shopper").agg(
        F.count("discount_offered").alias("discount_buys"),
        F.sum("discount_offered").alias("discount_buys_sum"),
        F.avg(F.when(F.col("discount_offered") == 1, F.col("discount"))).alias(
            "ave_discount_offered"
        ),
    )
    pair = rows.groupBy("shopper", "product").agg(
        F.avg(_bought("discount_offered")).alias("customer_product_discounted_share"),
        F.coalesce(F.sum(_bought(F.lit(1))), F.lit(0)).alias("customer_product_sales"),
        F.count("discount_effect").alias("customer_prod_dis_buys"),
        F.sum("discount_effect").alias("customer_prod_dis_buys_sum"),
        F.avg("discount_offered").alias("customer_prod_dis_offer_share"),
    )
    cell = bought.groupBy("week", "shopper", "product").agg(
        F.count("price").alias("week_customer_product_sales")
    )
    return (
        cell.join(pair, ["shopper", "product"])
        .join(events, "shopper")
        .join(offers, "shopper")
        .withColumn(
            "mean_customer_product_sales",
            F.col("customer_product_sales") / (F.col("no_products_bought") + 1),
        )
    )


def smoothed_ratios(rows: DataFrame) -> DataFrame:
    """Shopper x product ratios with ``+ 1`` denominators."""
    pair = rows.groupBy("shopper", "product").agg(
        F.coalesce(F.sum(_bought(F.lit(1))), F.lit(0)).alias("customer_product_sales")
    )
    shopper = shopper_features(rows).select(
        "shopper", "no_products_bought", "spend_per_customer", "discount_purchase"
    )
    base = F.col("no_products_bought") + 1
    return pair.join(shopper, "shopper").select(
        "shopper",
        "product",
        (F.col("customer_product_sales") / base).alias("mean_customer_product_sales"),
        (F.col("spend_per_customer") / base).alias("customer_mean_product_price"),
        (F.col("discount_purchase") / base).alias("customer_discount_buy_share"),
    )


def discount_by(rows: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """Mean discount over all rows and over bought rows, per ``keys``."""
    discount = F.coalesce(F.col("discount"), F.lit(0))
    return rows.groupBy(*keys).agg(
        F.avg(discount).alias(f"{prefix}_offered_dis_week"),
        F.avg(_bought(discount)).alias(f"{prefix}_used_dis_week"),
    )
