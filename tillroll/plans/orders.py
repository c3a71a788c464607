"""Named queries of the order model: joins, counts, customer features, transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import columns as fx
from tillroll.functions import quantiles, stats
from tillroll.operators import orders, splits
from tillroll.plans.flow import Flow
from tillroll.plans.registry import plan, rounded
from tillroll.sources.dataset import DEPARTMENTS

SEGMENT_COLUMNS = [
    "average_lag_in_days",
    "average_item_size_of_orders",
    "total_number_of_orders",
]
USER_COLUMNS = [
    "no_orders",
    "no_item_orders",
    "avg_no_items",
    "inter_order_time",
    "orders_per_day",
    "reordered_w14d_ratio",
]
BOXCOX_GRID = [round(-2 + 0.1 * i, 1) for i in range(41)]

# ---- joins ------------------------------------------------------------------


@plan("star_inner", """
    SELECT order_id, product_id, add_to_cart_order, reordered, product_name, aisle_id,
           department_id, user_id, order_number, order_dow, order_hour_of_day,
           days_since_prior_order
    FROM v_lines""")
def star_inner(d: Flow) -> DataFrame:
    return orders.star_inner(d.order_lines, d.products, d.orders)


@plan("star_left", """
    SELECT order_id, product_id, add_to_cart_order, reordered, product_name, aisle_id, aisle,
           department_id, department, user_id, order_number, order_dow, order_hour_of_day,
           days_since_prior_order
    FROM v_lines""")
def star_left(d: Flow) -> DataFrame:
    return orders.star_left(d.loose_lines, d.products, d.aisles, d.departments, d.orders)


@plan("exclude_last_order", """
    SELECT order_id, user_id, order_number, product_id, add_to_cart_order, reordered
    FROM v_lines2""")
def exclude_last_order(d: Flow) -> DataFrame:
    return d.lines_of(orders.exclude_last_order).select(
        "order_id", "user_id", "order_number", "product_id", "add_to_cart_order", "reordered"
    )


@plan("only_last_order", """
    SELECT order_id, user_id, order_number, product_id, add_to_cart_order, reordered
    FROM v_lines SEMI JOIN (SELECT order_id FROM v_placed WHERE lag = 0) USING (order_id)""")
def only_last_order(d: Flow) -> DataFrame:
    return d.lines_of(orders.only_last_order).select(
        "order_id", "user_id", "order_number", "product_id", "add_to_cart_order", "reordered"
    )


@plan("distinct_orders", "SELECT DISTINCT order_id, user_id, order_number FROM v_lines")
def distinct_orders(d: Flow) -> DataFrame:
    return d.items.select("order_id", "user_id", "order_number").distinct()


# ---- order history ----------------------------------------------------------


@plan("order_history", """
    SELECT user_id, CAST((order_number - 1) // 1024 AS INTEGER) AS chunk,
           string_agg(order_id, ',' ORDER BY order_number) AS list_of_orders,
           CAST(count(*) AS INTEGER) AS n_orders
    FROM v_placed GROUP BY ALL""")
def order_history(d: Flow) -> DataFrame:
    history = orders.order_history(d.placed, chunk_size=1024)
    return history.select(
        "user_id",
        "chunk",
        fx.joined("list_of_orders").alias("list_of_orders"),
        F.size("list_of_orders").alias("n_orders"),
    )


@plan("last4_orders", """
    SELECT user_id, max(order_id) FILTER (WHERE lag = 0) AS order_lag_0,
           max(order_id) FILTER (WHERE lag = 1) AS order_lag_1,
           max(order_id) FILTER (WHERE lag = 2) AS order_lag_2,
           coalesce(max(order_id) FILTER (WHERE lag = 3), -1) AS order_lag_3
    FROM v_placed GROUP BY user_id""")
def last4_orders(d: Flow) -> DataFrame:
    return orders.last4_orders(d.placed)


@plan("last4_order_gaps", "SELECT * FROM v_gaps")
def last4_order_gaps(d: Flow) -> DataFrame:
    return orders.last4_order_gaps(d.placed)


@plan("order_freq_without_last", """
    SELECT user_id, round(order_frequency_in_days, 6) AS order_frequency_in_days,
           round(no_orders, 6) AS no_orders, days_lag_0,
           round(order_frequency_without_lag_0, 6) AS order_frequency_without_lag_0
    FROM v_returns""")
def order_freq_without_last(d: Flow) -> DataFrame:
    return rounded(
        orders.returns_14d(d.lines, d.placed).select(
            "user_id",
            "order_frequency_in_days",
            "no_orders",
            "days_lag_0",
            "order_frequency_without_lag_0",
        )
    )


@plan("user_two_level_mean", """
    SELECT user_id, round(reordered_ratio, 6) AS reordered_ratio, round(order_dow, 6) AS order_dow,
           round(order_hour_of_day, 6) AS order_hour_of_day, round(item_count, 6) AS item_count,
           round(no_orders, 6) AS no_orders,
           round(order_frequency_in_days, 6) AS order_frequency_in_days
    FROM v_two_level""")
def user_two_level_mean(d: Flow) -> DataFrame:
    return rounded(orders.user_two_level_mean(d.lines))


@plan("returns_14d_dataset", """
    SELECT user_id, round(reordered_ratio, 6) AS reordered_ratio, round(order_dow, 6) AS order_dow,
           round(order_hour_of_day, 6) AS order_hour_of_day, round(item_count, 6) AS item_count,
           round(no_orders, 6) AS no_orders,
           round(order_frequency_in_days, 6) AS order_frequency_in_days, days_lag_0, days_lag_1,
           round(coalesce(days_lag_2, order_frequency_without_lag_0), 6) AS days_lag_2,
           round(coalesce(days_lag_3, order_frequency_without_lag_0), 6) AS days_lag_3,
           round(order_frequency_without_lag_0, 6) AS order_frequency_without_lag_0,
           CASE WHEN days_lag_0 < 14 THEN 1 ELSE 0 END AS comes_within_14_days
    FROM v_returns""")
def returns_14d_dataset(d: Flow) -> DataFrame:
    return rounded(orders.returns_14d(d.lines, d.placed))


@plan("returns_14d_score_input", """
    SELECT user_id, round(reordered_ratio, 6) AS reordered_ratio, round(order_dow, 6) AS order_dow,
           round(order_hour_of_day, 6) AS order_hour_of_day, round(item_count, 6) AS item_count,
           round(no_orders, 6) AS no_orders,
           round(order_frequency_in_days, 6) AS order_frequency_without_lag_0,
           days_lag_0 AS days_lag_1, days_lag_1 AS days_lag_2,
           round(coalesce(days_lag_2, order_frequency_without_lag_0), 6) AS days_lag_3
    FROM v_returns""")
def returns_14d_score_input(d: Flow) -> DataFrame:
    return rounded(orders.returns_14d(d.lines, d.placed, shifted=True))


# ---- customer features ------------------------------------------------------


@plan("segment_features", """
    SELECT user_id, round(average_item_size_of_orders, 6) AS average_item_size_of_orders,
           total_number_of_orders, round(average_lag_in_days, 6) AS average_lag_in_days,
           median_hour, round(average_order_dow, 6) AS average_order_dow,
           round(reordered_ratio, 6) AS reordered_ratio
    FROM v_segment""")
def segment_features(d: Flow) -> DataFrame:
    return rounded(orders.segment_features(d.items))


@plan("user_order_features", """
    SELECT user_id, round(reordered_w14d_ratio, 6) AS reordered_w14d_ratio,
           round(reordered_ratio, 6) AS reordered_ratio, no_orders, no_item_orders,
           round(avg_no_items, 6) AS avg_no_items, inter_order_time,
           round(orders_per_day, 6) AS orders_per_day,
           round(avg_days_between_orders, 6) AS avg_days_between_orders
    FROM v_user_features""")
def user_order_features(d: Flow) -> DataFrame:
    return rounded(orders.user_order_features(orders.exclude_last_order(d.items, d.placed)))


_SHARES = ", ".join(
    f"round(avg(CASE WHEN department = '{x}' THEN 1 ELSE 0 END), 6) AS share_{x.lower()}"
    for x in DEPARTMENTS
)


@plan("department_share", f"SELECT user_id, {_SHARES} FROM v_lines2 GROUP BY user_id")
def department_share(d: Flow) -> DataFrame:
    kept = orders.exclude_last_order(d.items, d.placed)
    return rounded(orders.department_share(kept, list(DEPARTMENTS), d.departments))


# ---- counts and summaries ---------------------------------------------------


@plan("value_counts", "SELECT order_dow, count(*) AS n FROM v_orders GROUP BY order_dow")
def value_counts(d: Flow) -> DataFrame:
    return orders.value_counts(d.orders, "order_dow").orderBy(F.desc("n"), "order_dow")


@plan("class_share", """
    SELECT discount_offered, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
    FROM v_rows GROUP BY discount_offered""")
def class_share(d: Flow) -> DataFrame:
    return rounded(orders.class_share(d.rows, "discount_offered"))


@plan("class_weights", """
    SELECT product_bought, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight
    FROM (SELECT product_bought, count(*) AS n FROM v_rows GROUP BY product_bought)""")
def class_weights(d: Flow) -> DataFrame:
    return rounded(orders.class_weights(d.rows, "product_bought"))


@plan("orders_per_user_hist", """
    SELECT max_order_number, count(*) AS n FROM (
        SELECT user_id, max(order_number) AS max_order_number FROM v_orders GROUP BY user_id)
    GROUP BY 1""")
def orders_per_user_hist(d: Flow) -> DataFrame:
    per_user = d.orders.groupBy("user_id").agg(F.max("order_number").alias("max_order_number"))
    return orders.value_counts(per_user, "max_order_number")


@plan("items_per_order_hist", """
    SELECT items, count(*) AS n FROM (
        SELECT order_id, max(add_to_cart_order) AS items FROM v_raw_lines GROUP BY order_id)
    GROUP BY 1""")
def items_per_order_hist(d: Flow) -> DataFrame:
    per_order = d.raw_lines.groupBy("order_id").agg(F.max("add_to_cart_order").alias("items"))
    return orders.value_counts(per_order, "items")


_HOURS = ", ".join(
    f"count(*) FILTER (WHERE order_hour_of_day = {h}) AS hour_{h}" for h in range(24)
)


@plan("dow_hour_pivot", f"SELECT order_dow, {_HOURS} FROM v_orders GROUP BY order_dow")
def dow_hour_pivot(d: Flow) -> DataFrame:
    counts = d.orders.groupBy("order_dow").pivot("order_hour_of_day", list(range(24))).count()
    return counts.fillna(0).select(
        "order_dow", *[F.col(str(h)).alias(f"hour_{h}") for h in range(24)]
    )


@plan("bestsellers_top20", """
    SELECT product_name, count(*) AS frequency_count FROM v_lines GROUP BY product_name
    ORDER BY frequency_count DESC, product_name LIMIT 20""")
def bestsellers_top20(d: Flow) -> DataFrame:
    return orders.bestsellers(d.product_counts, "product_name", "n")


@plan("top_aisles", """
    SELECT aisle, count(*) AS frequency_count FROM v_lines GROUP BY aisle
    ORDER BY frequency_count DESC, aisle LIMIT 20""")
def top_aisles(d: Flow) -> DataFrame:
    return orders.bestsellers(d.product_counts.join(d.aisles, "aisle_id"), "aisle", "n")


@plan("top_departments", """
    SELECT department, count(*) AS frequency_count FROM v_lines GROUP BY department
    ORDER BY frequency_count DESC, department LIMIT 20""")
def top_departments(d: Flow) -> DataFrame:
    named = d.product_counts.join(d.departments, "department_id")
    return orders.bestsellers(named, "department", "n")


@plan("reorder_ratio_by_dim", """
    SELECT 'department' AS dimension, department AS name, round(avg(reordered), 6) AS reorder_ratio,
           count(*) AS n FROM v_lines GROUP BY department
    UNION ALL SELECT 'aisle', aisle, round(avg(reordered), 6), count(*) FROM v_lines
    GROUP BY aisle""")
def reorder_ratio_by_dim(d: Flow) -> DataFrame:
    """Reorder ratios of departments and aisles, both rolled up from one grouping."""
    cells = d.items.groupBy("department_id", "aisle_id").agg(
        F.sum("reordered").alias("s"), F.count(F.lit(1)).alias("n")
    )
    named = cells.join(d.departments, "department_id").join(d.aisles, "aisle_id")
    dims = F.inline(
        F.array(
            *[
                F.struct(F.lit(k).alias("dimension"), F.col(k).alias("name"))
                for k in ("department", "aisle")
            ]
        )
    )
    totals = named.select("s", "n", dims).groupBy("dimension", "name")
    ratio = (F.sum("s") / F.sum("n")).alias("reorder_ratio")
    return rounded(totals.agg(ratio, F.sum("n").alias("n"))).orderBy(
        "dimension", F.desc("reorder_ratio"), "name"
    )


@plan("reorder_by_cart_pos", """
    SELECT least(add_to_cart_order, 70) AS cart_position,
           round(avg(reordered), 6) AS reorder_ratio, count(*) AS n
    FROM v_lines GROUP BY 1""")
def reorder_by_cart_pos(d: Flow) -> DataFrame:
    capped = d.lines.withColumn("cart_position", fx.cap("add_to_cart_order", 70))
    return rounded(orders.mean_by(capped, "cart_position", "reordered", "reorder_ratio"))


@plan("aisle_by_department", """
    SELECT department, aisle, count(*) AS n FROM v_lines GROUP BY department, aisle""")
def aisle_by_department(d: Flow) -> DataFrame:
    named = d.product_counts.groupBy("department_id", "aisle_id").agg(F.sum("n").alias("n"))
    return (
        named.join(d.departments, "department_id")
        .join(d.aisles, "aisle_id")
        .select("department", "aisle", "n")
        .orderBy("department", F.desc("n"), "aisle")
    )


@plan("order_stats", """
    SELECT count(*) AS n_users, CAST(sum(n) AS BIGINT) AS n_orders,
           round(avg(n), 6) AS mean_orders_per_user, median(n) AS median_orders_per_user,
           (SELECT round(avg(days_since_prior_order), 6) FROM v_orders) AS mean_lag,
           (SELECT median(days_since_prior_order) FROM v_orders) AS median_lag
    FROM (SELECT user_id, count(*) AS n FROM v_orders GROUP BY user_id)""")
def order_stats(d: Flow) -> DataFrame:
    return rounded(orders.order_stats(d.orders))


_ORDER_NUMBERS = ["order_number", "order_dow", "order_hour_of_day", "days_since_prior_order"]
_DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST(count({c}) AS DOUBLE) AS n, round(avg({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS lo,
        round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
        round(quantile_cont({c}, 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS hi FROM v_orders"""
    for c in _ORDER_NUMBERS
)


@plan("describe", _DESCRIBE)
def describe(d: Flow) -> DataFrame:
    return rounded(stats.describe(d.orders, _ORDER_NUMBERS))


_PROBS = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


@plan("exact_quantiles", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS prob,
        round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS value FROM v_offers"""
    for c in ("price", "discount") for p in _PROBS))
def exact_quantiles(d: Flow) -> DataFrame:
    """Quantiles of prices and discounts, selected without a counter per distinct value."""
    found = quantiles.exact_quantiles(d.offers, ["price", "discount"], _PROBS)
    rows = [(c, p, v) for c, values in found.items() for p, v in zip(_PROBS, values)]
    return rounded(d.spark.createDataFrame(rows, "column_name string, prob double, value double"))


_ROW_COLUMNS = ["week", "shopper", "product", "price", "discount"]


@plan("null_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM v_offers"
    for c in _ROW_COLUMNS))
def null_profile(d: Flow) -> DataFrame:
    return stats.null_counts(d.offers)


_CORR = " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
    + (
        "CAST(1 AS DOUBLE) AS corr"
        if a == b
        else f"round(corr({a}, {b}), 6) AS corr FROM v_user_features"
    )
    for a in USER_COLUMNS
    for b in USER_COLUMNS
)


@plan("corr_matrix", _CORR)
def corr_matrix(d: Flow) -> DataFrame:
    users = orders.user_order_features(orders.exclude_last_order(d.items, d.placed))
    return rounded(stats.correlation_pairs(users, USER_COLUMNS))


# ---- transforms -------------------------------------------------------------


@plan("cyclical_hour", """
    SELECT order_id, order_hour_of_day,
           round(sin(order_hour_of_day * (2 * pi()) / CAST(23 AS DOUBLE)), 6) AS hour_sin,
           round(cos(order_hour_of_day * (2 * pi()) / CAST(23 AS DOUBLE)), 6) AS hour_cos
    FROM v_orders""")
def cyclical_hour(d: Flow) -> DataFrame:
    """Period 23 as in the reference; the function takes 24 as well."""
    hours = d.table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        (F.col("o_orderkey") % 24).cast("int").alias("order_hour_of_day"),
    )
    sin, cos = fx.cyclical("order_hour_of_day", 23)
    return rounded(hours.withColumns({"hour_sin": sin, "hour_cos": cos}))


_SKEWS = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, '{t}' AS transform, round(skewness({e.format(c)}), 5) AS skew
        FROM v_segment"""
    for c in SEGMENT_COLUMNS
    for t, e in {"none": "{}", "log1p": "ln({} + 1)", "sqrt": "sqrt({})"}.items()
)


@plan("skew_transforms", _SKEWS)
def skew_transforms(d: Flow) -> DataFrame:
    users = orders.segment_features(d.items)
    shapes = {"none": lambda c: c, "log1p": F.log1p, "sqrt": F.sqrt}
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit(t).alias("transform"),
            stats.skewness_unbiased(shape(F.col(c))).alias("skew"),
        )
        for c in SEGMENT_COLUMNS
        for t, shape in shapes.items()
    ]
    return rounded(users.agg(F.array(*cells).alias("s")).select(F.inline("s")), 5)


_BOXCOX = ", ".join(
    f"""round(CASE WHEN abs((SELECT skewness({c}) * (count({c}) - 2)
            / sqrt(count({c}) * (count({c}) - 1)) FROM v_user_features)) > 1
        THEN (pow({c} + 2, 0.15) - 1) / 0.15 ELSE {c} END, 6) AS {c}"""
    for c in USER_COLUMNS
)


@plan("boxcox1p", f"SELECT user_id, {_BOXCOX} FROM v_user_features")
def boxcox1p(d: Flow) -> DataFrame:
    """Box-Cox of 1 + x (lambda 0.15, x moved up by 1) for columns with |skew| > 1."""
    users = orders.user_order_features(orders.exclude_last_order(d.items, d.placed))
    skew = stats.one_row(users, **{c: F.skewness(c) for c in USER_COLUMNS})
    return rounded(
        users.select(
            "user_id",
            *[
                F.when(F.abs(skew.getField(c)) > 1, fx.boxcox1p(F.col(c) + 1, 0.15))
                .otherwise(F.col(c))
                .alias(c)
                for c in USER_COLUMNS
            ],
        )
    )


_GRID = "[" + ", ".join(f"{g}::DOUBLE" for g in BOXCOX_GRID) + "]"
_LIK = " UNION ALL ".join(
    f"""SELECT '{c}' AS name, lam, (lam - 1) * sum(ln({c})) - count(*) / 2.0::DOUBLE
            * ln(var_pop(CASE WHEN lam = 0 THEN ln({c}) ELSE (pow({c}, lam) - 1) / lam END)) AS ll
        FROM v_segment, (SELECT unnest({_GRID}) AS lam) WHERE {c} > 0 GROUP BY lam"""
    for c in SEGMENT_COLUMNS[1:]
)


@plan("boxcox_mle", f"""
    SELECT name, lam, round(ll, 3) AS loglik FROM (SELECT *, row_number() OVER (
        PARTITION BY name ORDER BY round(ll, 3) DESC, lam) AS rn FROM ({_LIK})) WHERE rn = 1""")
def boxcox_mle(d: Flow) -> DataFrame:
    users = orders.segment_features(d.items)
    return stats.boxcox_mle(users, SEGMENT_COLUMNS[1:], BOXCOX_GRID)


def _optimum_sql(column: str) -> str:
    """Direct search over grids that narrow from steps of 1/4 to 1/62500."""
    width, steps = 8.0, 64
    source = f"(SELECT ln({column}) AS t FROM v_segment WHERE {column} > 0)"
    base = f"(SELECT avg(t) AS g, count(*) AS n FROM {source})"
    level = "(SELECT 0.0::DOUBLE AS b)"
    for i in range(4):
        grid = f"(SELECT b + (unnest(range({-steps // 2}, {steps // 2 + 1})) * {2 * width / steps!r}::DOUBLE) AS l FROM {level})"
        spread = f"""(SELECT l, any_value(g) AS g, any_value(n) AS n, var_pop(CASE WHEN abs(l) < 1e-12 THEN t - g
            ELSE (exp(l * (t - g)) - 1) / l END) AS v FROM {source}, {base}, {grid} GROUP BY l)"""
        level = f"(SELECT l AS b, v, g, n FROM {spread} ORDER BY v, l LIMIT 1)"
        width = 2 * width / steps
    return f"SELECT '{column}' AS name, b AS lam, -n * g - n / 2.0::DOUBLE * ln(v) AS ll FROM {level}"


@plan("boxcox_optimum", "SELECT name, round(lam, 3) AS lam, round(ll, 3) AS loglik FROM ("
      + " UNION ALL ".join(_optimum_sql(c) for c in SEGMENT_COLUMNS[1:]) + ")")
def boxcox_optimum(d: Flow) -> DataFrame:
    """The most likely lambda, by brackets instead of a fixed grid."""
    found = stats.boxcox_optimum(orders.segment_features(d.items), SEGMENT_COLUMNS[1:])
    return rounded(d.spark.createDataFrame(found, "name string, lam double, loglik double"), 3)


_Z = ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}"
    for c in SEGMENT_COLUMNS
)


@plan("zscore", f"SELECT user_id, {_Z} FROM v_segment")
def zscore(d: Flow) -> DataFrame:
    users = orders.segment_features(d.items).select("user_id", *SEGMENT_COLUMNS)
    return rounded(stats.zscore(users, SEGMENT_COLUMNS))


@plan("segment_melt", " UNION ALL ".join(
    f"SELECT user_id, '{c}' AS metric, round({c}, 6) AS value FROM v_segment"
    for c in SEGMENT_COLUMNS))
def segment_melt(d: Flow) -> DataFrame:
    users = orders.segment_features(d.items).select("user_id", *SEGMENT_COLUMNS)
    return rounded(users.unpivot("user_id", SEGMENT_COLUMNS, "metric", "value"))


# ---- random splits ----------------------------------------------------------


@plan("split_random", """
    SELECT user_id, CASE WHEN substr(md5(concat_ws('-', '42', user_id)), 1, 8) < '40000000'
        THEN 'test' ELSE 'train' END AS split FROM v_returns""")
def split_random(d: Flow) -> DataFrame:
    users = d.placed.select("user_id").distinct()
    return splits.split_random(users, "user_id", 0.25, seed=42)


@plan("split_stratified", """
    SELECT user_id, label, CASE WHEN substr(md5(concat_ws('-', '1', label, user_id)), 1, 8)
        < '33333333' THEN 'test' ELSE 'train' END AS split
    FROM (SELECT user_id, CASE WHEN days_lag_0 < 14 THEN 1 ELSE 0 END AS label FROM v_returns)""")
def split_stratified(d: Flow) -> DataFrame:
    labels = orders.last4_order_gaps(d.placed).select(
        "user_id", F.when(F.col("days_lag_0") < 14, 1).otherwise(0).alias("label")
    )
    return splits.split_stratified(labels, "user_id", "label", 0.20, seed=1)
