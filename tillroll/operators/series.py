"""Weekly series: lags, rolling and expanding means, gap filling, most frequent price.

Every window runs over a series with at most one row per key and week.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.operators.basic import calendar


def lag(df: DataFrame, keys: list[str], order: str, column: str, name: str, k: int = 1) -> DataFrame:
    return df.withColumn(name, F.lag(column, k).over(W.partitionBy(*keys).orderBy(order)))


def multi_lag(df: DataFrame, keys: list[str], order: str, column: str, n: int) -> DataFrame:
    """Lags 1..n of a column; rows without all n of them are dropped."""
    w = W.partitionBy(*keys).orderBy(order)
    names = {f"{column}_lag{k}": F.lag(column, k).over(w) for k in range(1, n + 1)}
    return df.withColumns(names).dropna(subset=list(names))


def hier_lag(
    df: DataFrame, filters: list[str], date: str, columns: list[str], periods: int
) -> DataFrame:
    """Per filter combination: means per date, and the means of the dates before."""
    means = df.groupBy(*filters, date).agg(*[F.avg(c).alias(c) for c in columns])
    w = W.partitionBy(*filters).orderBy(date)
    return means.withColumns(
        {f"{c}_lag{k}": F.lag(c, k).over(w) for c in columns for k in range(1, periods + 1)}
    )


def rolling_mean(df: DataFrame, keys: list[str], order: str, column: str, size: int) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(1 - size, 0)
    return df.withColumn(
        "rolling_mean", F.when(F.count(column).over(w) >= size, F.avg(column).over(w))
    )


def expanding_mean(
    df: DataFrame, keys: list[str], order: str, column: str, minimum: int
) -> DataFrame:
    w = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(
        "expanding_mean", F.when(F.count(column).over(w) >= minimum, F.avg(column).over(w))
    )


def modal_price(sales: DataFrame) -> DataFrame:
    """Most frequent price per (week, product); the lowest of equally frequent ones."""
    counts = sales.groupBy("week", "product", "price").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("week", "product").agg(
        F.min_by("price", F.struct(-F.col("n"), F.col("price"))).alias("modal_price"),
        F.max("n").alias("n_at_price"),
    )


def fill_prices(prices: DataFrame, start: int, end: int) -> DataFrame:
    """Modal price on a full week calendar per product, forward then backward filled."""
    w = W.partitionBy("product").orderBy("week")
    back = w.rowsBetween(W.unboundedPreceding, 0)
    ahead = w.rowsBetween(0, W.unboundedFollowing)
    grid = calendar(prices, ["product"], start, end)
    return grid.join(prices, ["product", "week"], "left").select(
        "product",
        "week",
        "modal_price",
        F.coalesce(
            F.last("modal_price", ignorenulls=True).over(back),
            F.first("modal_price", ignorenulls=True).over(ahead),
        ).alias("filled_price"),
    )


def cumulative_counts(df: DataFrame, week: str = "week") -> DataFrame:
    """Rows per week and running total; the window sees one row per week."""
    counts = df.groupBy(week).agg(F.count(F.lit(1)).alias("n"))
    running = W.orderBy(week).rowsBetween(W.unboundedPreceding, 0)
    return counts.withColumn("cumulative", F.sum("n").over(running))
