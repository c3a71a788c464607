"""Recency features per (shopper, product)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def history_plus_target(offers: DataFrame, targets: DataFrame) -> DataFrame:
    """Purchases and offers of the past plus the candidate rows of the coming week."""
    past = offers.select(
        "week",
        "shopper",
        "product",
        F.when(F.col("price").isNotNull(), 1).otherwise(0).alias("product_bought"),
    )
    return past.unionByName(
        targets.select("week", "shopper", "product", F.lit(0).alias("product_bought"))
    )


def _lag() -> Column:
    """Weeks since the last earlier purchase, -1 before the first one."""
    earlier = (
        W.partitionBy("shopper", "product")
        .orderBy("week")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    last = F.max(F.when(F.col("product_bought") == 1, F.col("week"))).over(earlier)
    return F.coalesce(F.col("week") - last, F.lit(-1))


def lag_weeks(history: DataFrame, target_week: int) -> DataFrame:
    """The lag table. product_bought is open (null) in the target week.

    A window holds at most one row per week, as the input key is unique.
    """
    return history.select(
        "shopper",
        "product",
        "week",
        F.when(F.col("week") == target_week, F.lit(None))
        .otherwise(F.col("product_bought"))
        .alias("product_bought"),
        _lag().alias("lag_weeks_of_product_per_customer"),
    )


def _recency(past: Column) -> dict[str, Column]:
    """Recency means of a pair over the purchases for which ``past`` holds.

    Gaps between consecutive purchases add up to last - first week, so their mean needs
    no ordered pass: (last - first - 1) / n counts the -1 of the first purchase,
    (last - first) / (n - 1) leaves it out.
    """
    week = F.when(past, F.col("week"))
    span = F.max(week) - F.min(week)
    n = F.count(week)
    return {
        "purchase_temporal_distribution": F.avg(week),
        "avg_no_weeks_between_two_purchases": F.try_divide(span - 1, n),
        "avg_no_weeks_between_two_purchases_clean": F.try_divide(span, n - 1),
    }


def _purchases_before(holdout_week: int) -> Column:
    return (F.col("week") < holdout_week) & (F.col("product_bought") == 1)


def pair_recency(history: DataFrame, holdout_week: int) -> DataFrame:
    """Mean purchase week and mean gap per pair, before the holdout week."""
    past = _purchases_before(holdout_week)
    columns = _recency(F.lit(True))
    return (
        history.where(past)
        .groupBy("shopper", "product")
        .agg(*[c.alias(name) for name, c in columns.items()])
    )


def purchase_temporal_distribution(history: DataFrame, holdout_week: int) -> DataFrame:
    return pair_recency(history, holdout_week).select(
        "shopper", "product", "purchase_temporal_distribution"
    )


def avg_weeks_between(history: DataFrame, holdout_week: int) -> DataFrame:
    return pair_recency(history, holdout_week).drop("purchase_temporal_distribution")


def attach_history(rows: DataFrame, lags: DataFrame, recency: DataFrame) -> DataFrame:
    """Join finished recency and lag tables onto rows (pair key, then the full key)."""
    return rows.join(recency, ["shopper", "product"], "left").join(
        lags.drop("product_bought"), ["shopper", "product", "week"], "left"
    )


def with_history(rows: DataFrame, holdout_week: int) -> DataFrame:
    """``attach_history`` computed in place: one shuffle by pair for lag and recency.

    Sampled rows (neither price nor discount) have no lag, as the lag table knows
    purchases and offers only.
    """
    pair = W.partitionBy("shopper", "product")
    past = _purchases_before(holdout_week)
    week = F.when(past, F.col("week"))
    span = F.max(week).over(pair) - F.min(week).over(pair)
    sampled = F.col("price").isNull() & F.col("discount").isNull()
    return rows.withColumns(
        {
            "purchase_temporal_distribution": F.avg(week).over(pair),
            "avg_no_weeks_between_two_purchases": F.try_divide(
                span - 1, F.count(week).over(pair)
            ),
            "lag_weeks_of_product_per_customer": F.when(~sampled, _lag()),
        }
    )


def target_history(
    baskets: DataFrame, holdout_week: int, target_week: int, min_frequency: int = 3
) -> DataFrame:
    """Candidate rows of the target week with lag and recency, from one grouping.

    Candidates are the pairs bought at least ``min_frequency`` times outside the holdout
    week; the lag counts from the latest purchase of all.
    """
    bought = baskets.withColumn("product_bought", F.lit(1))
    columns = _recency(_purchases_before(holdout_week))
    pairs = bought.groupBy("shopper", "product").agg(
        F.count_if(F.col("week") != holdout_week).alias("frequency"),
        (target_week - F.max("week")).alias("lag_weeks_of_product_per_customer"),
        *[c.alias(name) for name, c in columns.items() if not name.endswith("_clean")],
    )
    return pairs.where(F.col("frequency") >= min_frequency).select(
        F.lit(target_week).alias("week"),
        "shopper",
        "product",
        F.lit(None).cast("int").alias("product_bought"),
        "lag_weeks_of_product_per_customer",
        "purchase_temporal_distribution",
        "avg_no_weeks_between_two_purchases",
    )
