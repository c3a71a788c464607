"""Order model: star joins, order history, customer features, returns within 14 days.

``lines`` is the joined base: one row per order line with user_id, order_number,
order_dow, order_hour_of_day, days_since_prior_order, product, aisle and department.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import from_end
from tillroll.functions.quantiles import exact_quantiles
from tillroll.operators.ranking import top_k


def star_inner(lines: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    return lines.join(products, "product_id").join(orders, "order_id")


def star_left(
    lines: DataFrame,
    products: DataFrame,
    aisles: DataFrame,
    departments: DataFrame,
    orders: DataFrame,
) -> DataFrame:
    """lines -> product -> aisle -> department -> order, keeping unmatched lines."""
    return (
        lines.join(products, "product_id", "left")
        .join(aisles, "aisle_id", "left")
        .join(departments, "department_id", "left")
        .join(orders, "order_id", "left")
    )


def last_orders(placed: DataFrame, k: int = 1) -> DataFrame:
    """The k latest orders per user, with ``lag`` 0 for the latest."""
    return top_k(placed, ["user_id"], [F.desc("order_number")], k, rank="lag")


def exclude_last_order(lines: DataFrame, placed: DataFrame) -> DataFrame:
    return lines.join(last_orders(placed).select("order_id"), "order_id", "left_anti")


def only_last_order(lines: DataFrame, placed: DataFrame) -> DataFrame:
    return lines.join(last_orders(placed).select("order_id"), "order_id", "left_semi")


def order_history(placed: DataFrame, chunk_size: int) -> DataFrame:
    """Order ids per user in time order. ``placed`` has each order once.

    A list holds at most ``chunk_size`` orders; longer histories continue in further
    chunks, so no user is gathered into one row.
    """
    chunk = F.floor((F.col("order_number") - 1) / chunk_size).cast("int")
    ordered = F.array_sort(F.collect_list(F.struct("order_number", "order_id")))
    return (
        placed.withColumn("chunk", chunk)
        .groupBy("user_id", "chunk")
        .agg(F.transform(ordered, lambda s: s.order_id).alias("list_of_orders"))
        .withColumn("list_of_orders", F.array_distinct("list_of_orders"))
    )


def last4_orders(placed: DataFrame) -> DataFrame:
    """The four latest order ids; null where missing, -1 for a missing fourth one."""
    ordered = F.array_sort(F.collect_list(F.struct("order_number", "order_id")))
    lists = (
        last_orders(placed, 4)
        .groupBy("user_id")
        .agg(F.transform(ordered, lambda s: s.order_id).alias("latest"))
    )
    return lists.select(
        "user_id",
        from_end("latest", 1).alias("order_lag_0"),
        from_end("latest", 2).alias("order_lag_1"),
        from_end("latest", 3).alias("order_lag_2"),
        F.coalesce(from_end("latest", 4), F.lit(-1)).alias("order_lag_3"),
    )


def last4_order_gaps(placed: DataFrame) -> DataFrame:
    """Days before each of the four latest orders, in one grouping."""
    gap = lambda k: F.max(F.when(F.col("lag") == k, F.col("days_since_prior_order")))
    recent = last_orders(placed, 4).groupBy("user_id")
    return recent.agg(*[gap(k).alias(f"days_lag_{k}") for k in range(4)])


def order_means(lines: DataFrame) -> DataFrame:
    """Per-order means; order columns are constant within an order."""
    aggs = [
        F.avg("reordered").alias("reordered"),
        F.count(F.lit(1)).alias("nb_products_order"),
        F.sum("reordered").alias("n_reordered"),
    ]
    if "add_to_cart_order" in lines.columns:
        aggs.append(F.avg("add_to_cart_order").alias("add_to_cart_order"))
    return lines.groupBy(
        "order_id",
        "user_id",
        "order_number",
        "order_dow",
        "order_hour_of_day",
        "days_since_prior_order",
    ).agg(*aggs)


def user_two_level_mean(lines: DataFrame) -> DataFrame:
    """Mean over a user's orders of the per-order means.

    item_count uses the identity 2 * mean(1..n) - 1 = n, which holds for cart positions.
    no_orders counts the orders: their numbers have gaps where an order has no lines.
    """
    return (
        order_means(lines)
        .groupBy("user_id")
        .agg(
            F.avg("reordered").alias("reordered_ratio"),
            F.avg("order_dow").alias("order_dow"),
            F.avg("order_hour_of_day").alias("order_hour_of_day"),
            F.avg(F.col("add_to_cart_order") * 2 - 1).alias("item_count"),
            F.count(F.lit(1)).cast("double").alias("no_orders"),
            F.avg("days_since_prior_order").alias("order_frequency_in_days"),
        )
    )


def segment_features(lines: DataFrame) -> DataFrame:
    """Customer segmentation features; the median hour is exact, rounded half to even."""
    return (
        order_means(lines)
        .groupBy("user_id")
        .agg(
            F.avg("nb_products_order").alias("average_item_size_of_orders"),
            F.count(F.lit(1)).cast("double").alias("total_number_of_orders"),
            F.avg("days_since_prior_order").alias("average_lag_in_days"),
            F.bround(F.median("order_hour_of_day"), 0).alias("median_hour"),
            F.avg("order_dow").alias("average_order_dow"),
            F.avg("reordered").alias("reordered_ratio"),
        )
    )


def user_order_features(lines: DataFrame) -> DataFrame:
    """Line-weighted customer features of the orders handed in.

    Aggregated per order first, then weighted by the lines of each order. A gap of
    more than 14 days counts 0, an unknown gap counts 1 (within 14 days).
    """
    n, days = F.col("nb_products_order"), F.col("days_since_prior_order")
    within = F.when(days > 14, 0).otherwise(1)
    known = F.when(days.isNotNull(), n)
    agg = (
        order_means(lines)
        .groupBy("user_id")
        .agg(
            (F.sum(n * within) / F.sum(n)).alias("reordered_w14d_ratio"),
            (F.sum("n_reordered") / F.sum(n)).alias("reordered_ratio"),
            F.max("order_number").alias("no_orders"),
            F.sum(n).alias("no_item_orders"),
            F.coalesce(F.sum(n * days), F.lit(0.0)).alias("inter_order_time"),
            F.try_divide(F.sum(n * days), F.sum(known)).alias("avg_days_between_orders"),
        )
    )
    return agg.withColumns(
        {
            "avg_no_items": F.col("no_item_orders") / F.col("no_orders"),
            "orders_per_day": F.col("no_orders") / (F.col("inter_order_time") + 1),
        }
    )


def department_share(lines: DataFrame, departments: list[str], names: DataFrame) -> DataFrame:
    """Share of a user's items per named department, from (user, department) counts."""
    counts = lines.groupBy("user_id", "department_id").agg(F.count(F.lit(1)).alias("n"))
    named = counts.join(names, "department_id", "left")
    in_dep = lambda d: F.when(F.col("department") == d, F.col("n")).otherwise(0)
    return named.groupBy("user_id").agg(
        *[(F.sum(in_dep(d)) / F.sum("n")).alias(f"share_{d.lower()}") for d in departments]
    )


def returns_14d(lines: DataFrame, placed: DataFrame, shifted: bool = False) -> DataFrame:
    """Customer table for "orders again within 14 days".

    order_frequency_without_lag_0 leaves the latest gap out of the mean and fills open
    second and third gaps. The label is 1 for a latest gap below 14 days, else 0.
    """
    gaps = last4_order_gaps(placed)
    joined = user_two_level_mean(lines).join(gaps, "user_id", "left")
    n = F.col("no_orders")
    without = F.try_divide(
        F.col("order_frequency_in_days") * (n - 1) - F.col("days_lag_0"), n - 2
    )
    table = (
        joined.withColumn("order_frequency_without_lag_0", without)
        .withColumn(
            "days_lag_2", F.coalesce("days_lag_2", "order_frequency_without_lag_0")
        )
        .withColumn(
            "days_lag_3", F.coalesce("days_lag_3", "order_frequency_without_lag_0")
        )
        .withColumn("comes_within_14_days", F.when(F.col("days_lag_0") < 14, 1).otherwise(0))
    )
    return roll_forward(table) if shifted else table


def roll_forward(table: DataFrame) -> DataFrame:
    """Scoring input: each lag moves one order ahead (lag 0 becomes lag 1)."""
    return table.select(
        "user_id",
        "reordered_ratio",
        "order_dow",
        "order_hour_of_day",
        "item_count",
        "no_orders",
        F.col("order_frequency_in_days").alias("order_frequency_without_lag_0"),
        F.col("days_lag_0").alias("days_lag_1"),
        F.col("days_lag_1").alias("days_lag_2"),
        F.col("days_lag_2").alias("days_lag_3"),
    )


RETURN_FEATURES = [
    "reordered_ratio",
    "order_dow",
    "order_hour_of_day",
    "item_count",
    "no_orders",
    "order_frequency_without_lag_0",
    "days_lag_1",
    "days_lag_2",
    "days_lag_3",
]


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def class_share(df: DataFrame, column: str) -> DataFrame:
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return value_counts(df, column).withColumn("share", F.col("n") / total)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows per class and the weight total / (classes * rows) that evens them out."""
    counts = value_counts(df, label)
    stats = counts.agg(
        F.struct(F.sum("n").alias("total"), F.count(F.lit(1)).alias("classes")).alias("s")
    ).scalar()
    weight = stats.getField("total") / (stats.getField("classes") * F.col("n"))
    return counts.withColumn("weight", weight)


def bestsellers(df: DataFrame, column: str, weight: str, n: int = 20) -> DataFrame:
    """The n names with the largest sum of ``weight`` (line counts per product)."""
    return (
        df.groupBy(column)
        .agg(F.sum(weight).alias("frequency_count"))
        .orderBy(F.desc("frequency_count"), column)
        .limit(n)
    )


def mean_by(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(name), F.count(F.lit(1)).alias("n"))


def order_stats(orders: DataFrame) -> DataFrame:
    """One row: distinct counts, and mean and median of orders per user and of gaps. The
    medians are selected while the plan is built."""
    per_user = orders.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("days_since_prior_order").alias("days"),
        F.count("days_since_prior_order").alias("gaps"),
    )
    users = per_user.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.sum("n").alias("n_orders"),
        F.avg("n").alias("mean_orders_per_user"),
        F.lit(exact_quantiles(per_user, ["n"], [0.5])["n"][0]).cast("double").alias("median_orders_per_user"),
        F.try_divide(F.sum("days"), F.sum("gaps")).alias("mean_lag"),
    )
    gap = "days_since_prior_order"
    return users.withColumn("median_lag", F.lit(exact_quantiles(orders, [gap], [0.5])[gap][0]).cast("double"))
