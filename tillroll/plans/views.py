"""DuckDB definitions of the shared views, used to compose the reference SQL of a plan."""

from __future__ import annotations

import re

VIEWS = {
    "v_part": """
        SELECT p_partkey, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) - 1 AS product,
               CAST(round(p_retailprice * 100) AS BIGINT) AS cents, p_name, p_brand, p_type
        FROM part""",
    "v_tx": """
        SELECT CAST(least((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1, 78) AS INTEGER)
                   AS week,
               o_custkey AS shopper, product, cents,
               CAST(round(l_discount * 100) AS INTEGER) * 4 AS pct,
               l_returnflag = 'R' AS returned
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN v_part ON l_partkey = p_partkey""",
    "v_sales": """
        SELECT week, shopper, product, cents * (100 - pct) / CAST(100 AS DOUBLE) AS price
        FROM v_tx WHERE NOT returned""",
    "v_baskets": """
        SELECT week, shopper, product, min(price) AS price FROM v_sales GROUP BY ALL""",
    "v_coupons": """
        SELECT week, shopper, product, max(pct) AS discount FROM v_tx WHERE pct > 0 GROUP BY ALL""",
    "v_categories": """
        SELECT product, CAST(list_position(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL',
                   'STANDARD'], p_type) - 1 AS INTEGER) AS category_label
        FROM (SELECT product, p_type,
                     row_number() OVER (PARTITION BY product ORDER BY count(*) DESC, p_type) AS rn
              FROM v_part GROUP BY product, p_type) WHERE rn = 1""",
    "v_offers": """
        SELECT week, shopper, product, price, discount
        FROM v_baskets FULL JOIN v_coupons USING (week, shopper, product)""",
    "v_rows": """
        SELECT week, shopper, product, price, discount,
               CASE WHEN coalesce(discount, 0) <> 0 THEN 1 ELSE 0 END AS discount_offered,
               CASE WHEN price IS NOT NULL THEN 1 ELSE 0 END AS product_bought,
               CASE WHEN price IS NOT NULL AND coalesce(discount, 0) = 0 THEN 1 ELSE 0 END
                   AS purchase_wo_dis,
               CASE WHEN price IS NULL AND coalesce(discount, 0) <> 0 THEN 1 ELSE 0 END
                   AS no_purchase_w_dis,
               CASE WHEN price IS NOT NULL AND coalesce(discount, 0) <> 0 THEN 1 ELSE 0 END
                   AS discount_effect
        FROM v_offers""",
    "v_prefs": """
        SELECT shopper, product, count(*) AS frequency FROM v_baskets WHERE week <> 78
        GROUP BY ALL HAVING count(*) >= 3""",
    "v_targets": """
        SELECT 79 AS week, shopper, product, CAST(NULL AS INTEGER) AS product_bought
        FROM v_prefs""",
    "v_negatives": """
        SELECT week, shopper, product, 0 AS product_bought
        FROM (SELECT c.week, c.shopper, c.product, c.n,
                     row_number() OVER (PARTITION BY c.week, c.shopper ORDER BY
                         md5(concat_ws('-', '42', c.week, c.shopper, c.product)), c.product) AS rn
              FROM (SELECT h.week, h.shopper, p.product, h.n
                    FROM (SELECT week, shopper, count(*) AS n FROM v_baskets GROUP BY ALL) h
                    JOIN v_prefs p USING (shopper)) c
              ANTI JOIN v_baskets b USING (week, shopper, product))
        WHERE rn <= n""",
    "v_history": """
        SELECT week, shopper, product, CASE WHEN price IS NULL THEN 0 ELSE 1 END AS product_bought
        FROM v_offers
        UNION ALL SELECT week, shopper, product, 0 FROM v_targets""",
    "v_lags": """
        SELECT shopper, product, week,
               CASE WHEN week = 79 THEN NULL ELSE product_bought END AS product_bought,
               coalesce(week - max(CASE WHEN product_bought = 1 THEN week END) OVER (
                   PARTITION BY shopper, product ORDER BY week
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1)
                   AS lag_weeks_of_product_per_customer
        FROM v_history""",
    "v_recency": """
        SELECT shopper, product, avg(week) AS purchase_temporal_distribution,
               avg(lag_weeks_of_product_per_customer) AS avg_no_weeks_between_two_purchases,
               avg(lag_weeks_of_product_per_customer)
                   FILTER (WHERE lag_weeks_of_product_per_customer >= 0)
                   AS avg_no_weeks_between_two_purchases_clean
        FROM v_lags WHERE week < 78 AND product_bought = 1 GROUP BY ALL""",
    # Purchases, offers and sampled negatives with category and recency columns.
    "v_base": """
        SELECT k.week, k.shopper, k.product, k.price, k.discount, c.category_label,
               r.avg_no_weeks_between_two_purchases, r.purchase_temporal_distribution,
               l.lag_weeks_of_product_per_customer,
               CASE WHEN coalesce(discount, 0) <> 0 THEN 1 ELSE 0 END AS discount_offered,
               CASE WHEN price IS NOT NULL THEN 1 ELSE 0 END AS product_bought,
               CASE WHEN price IS NOT NULL AND coalesce(discount, 0) = 0 THEN 1 ELSE 0 END
                   AS purchase_wo_dis,
               CASE WHEN price IS NULL AND coalesce(discount, 0) <> 0 THEN 1 ELSE 0 END
                   AS no_purchase_w_dis,
               CASE WHEN price IS NOT NULL AND coalesce(discount, 0) <> 0 THEN 1 ELSE 0 END
                   AS discount_effect
        FROM (SELECT week, shopper, product, price, discount
              FROM v_offers FULL JOIN v_negatives USING (week, shopper, product)) k
        LEFT JOIN v_categories c ON c.product = k.product
        LEFT JOIN v_recency r ON r.shopper = k.shopper AND r.product = k.product
        LEFT JOIN v_lags l ON l.shopper = k.shopper AND l.product = k.product
            AND l.week = k.week AND l.week <= 78""",
    "v_train": "SELECT * FROM v_base WHERE week BETWEEN 0 AND 77",
    "v_f_product": """
        SELECT product, coalesce(max(price), 0) AS max_price,
               CAST(sum(product_bought) AS BIGINT) AS product_sells,
               CAST(sum(CASE WHEN product_bought = 1 THEN discount_offered END) AS BIGINT)
                   AS product_dis_sells
        FROM v_train GROUP BY product""",
    "v_f_week": """
        SELECT week, shopper, count(*) AS n, sum(price) AS v, sum(discount_offered) AS d
        FROM v_train WHERE product_bought = 1 GROUP BY ALL""",
    "v_f_shopper": """
        SELECT shopper, CAST(sum(n) AS BIGINT) AS no_products_bought,
               sum(v) AS spend_per_customer, CAST(sum(d) AS BIGINT) AS discount_purchase,
               sum(n * n) / sum(n) AS mean_basket_size, sum(n * v) / sum(n) AS mean_basket_value,
               any_value(u) AS no_unique_products
        FROM v_f_week JOIN (SELECT shopper, count(DISTINCT product) AS u FROM v_train
                            WHERE product_bought = 1 GROUP BY shopper) USING (shopper)
        GROUP BY shopper""",
    "v_f_pair": """
        SELECT shopper, product,
               CAST(sum(CASE WHEN product_bought = 1 THEN 1 END) AS BIGINT)
                   AS no_products_bought_per_product,
               CAST(sum(CASE WHEN product_bought = 1 THEN discount_effect END) AS BIGINT)
                   AS customer_prod_dis_purchases,
               avg(CASE WHEN product_bought = 1 THEN discount_effect END)
                   AS customer_prod_bought_dis_share,
               count(*) AS customer_prod_dis_offers,
               CAST(sum(discount_offered) AS BIGINT) AS customer_prod_dis_offers_sum,
               avg(CASE WHEN discount_offered = 1 THEN product_bought END)
                   AS customer_prod_dis_offered_share
        FROM v_train GROUP BY ALL""",
    "v_min_price": "SELECT product, min(price) AS min_price FROM v_baskets GROUP BY product",
    "v_features": """
        SELECT t.week, t.shopper, t.product,
               round(coalesce(t.price, p.max_price * (1 - coalesce(t.discount, 0)
                   / CAST(100 AS DOUBLE))), 6) AS price,
               coalesce(t.discount, 0) AS discount, t.product_bought, t.category_label,
               round(coalesce(t.avg_no_weeks_between_two_purchases, -1), 6)
                   AS avg_no_weeks_between_two_purchases,
               coalesce(t.lag_weeks_of_product_per_customer, -1)
                   AS lag_weeks_of_product_per_customer,
               round(coalesce(t.purchase_temporal_distribution, -1), 6)
                   AS purchase_temporal_distribution,
               t.discount_offered, t.purchase_wo_dis, t.no_purchase_w_dis, t.discount_effect,
               p.max_price, m.min_price, s.no_products_bought,
               round(s.spend_per_customer, 2) AS spend_per_customer, s.no_unique_products,
               s.discount_purchase, p.product_sells, p.product_dis_sells,
               round(p.product_dis_sells / p.product_sells, 6) AS product_dis_sells_share,
               coalesce(x.no_products_bought_per_product, -1) AS no_products_bought_per_product,
               coalesce(x.customer_prod_dis_purchases, -1) AS customer_prod_dis_purchases,
               round(coalesce(x.customer_prod_bought_dis_share, -1), 6)
                   AS customer_prod_bought_dis_share,
               x.customer_prod_dis_offers,
               round(coalesce(x.customer_prod_dis_offered_share, -1), 6)
                   AS customer_prod_dis_offered_share,
               round(coalesce(x.no_products_bought_per_product / s.no_products_bought, -1), 6)
                   AS customer_product_share,
               round(s.spend_per_customer / s.no_products_bought, 6)
                   AS customer_mean_product_price,
               round(s.discount_purchase / s.no_products_bought, 6)
                   AS customer_discount_buy_share,
               w.n AS week_basket_size, round(w.v, 2) AS week_basket_value,
               round(s.mean_basket_size, 6) AS mean_basket_size,
               round(s.mean_basket_value, 6) AS mean_basket_value
        FROM v_train t
        JOIN v_f_week w ON w.week = t.week AND w.shopper = t.shopper
        LEFT JOIN v_f_product p ON p.product = t.product
        LEFT JOIN v_min_price m ON m.product = t.product
        LEFT JOIN v_f_shopper s ON s.shopper = t.shopper
        LEFT JOIN v_f_pair x ON x.shopper = t.shopper AND x.product = t.product""",
    # Heuristic and scored coupons.
    "v_heuristic": """
        SELECT *, CAST(sum(product_buys) OVER (PARTITION BY shopper) AS BIGINT) AS buys,
               count(*) OVER (PARTITION BY shopper) AS unique_products,
               sum(product_discount_buys) OVER (PARTITION BY shopper)
                   / sum(product_buys) OVER (PARTITION BY shopper) AS discount_buys
        FROM (SELECT b.shopper, b.product, avg(b.week) AS week, avg(b.price) AS price,
                     avg(coalesce(discount, 0)) AS discount,
                     avg(CASE WHEN discount > 0 THEN 1 ELSE 0 END) AS dis_prod_share,
                     CAST(sum(CASE WHEN discount > 0 THEN 1 ELSE 0 END) AS BIGINT)
                         AS product_discount_buys,
                     count(*) AS product_buys
              FROM v_baskets b LEFT JOIN v_coupons c USING (week, shopper, product)
              GROUP BY b.shopper, b.product)""",
    "v_heuristic_top": """
        SELECT shopper, product, CAST(rn - 1 AS INTEGER) AS coupon
        FROM (SELECT shopper, product, row_number() OVER (PARTITION BY shopper
                  ORDER BY dis_prod_share DESC, product) AS rn FROM v_heuristic)
        WHERE rn <= 5""",
    "v_candidates": """
        SELECT 79 AS week, p.shopper, p.product, b.n_bought, b.coupon_share, w.n_weeks,
               m.max_price
        FROM v_prefs p
        JOIN (SELECT shopper, product, count(*) AS n_bought, avg(discount_offered) AS coupon_share
              FROM v_rows WHERE product_bought = 1 GROUP BY ALL) b
            ON b.shopper = p.shopper AND b.product = p.product
        JOIN (SELECT shopper, count(DISTINCT week) AS n_weeks FROM v_rows
              WHERE product_bought = 1 GROUP BY shopper) w ON w.shopper = p.shopper
        JOIN (SELECT product, max(price) AS max_price FROM v_rows GROUP BY product) m
            ON m.product = p.product""",
    "v_scored": """
        SELECT *, max_price * (1 - discount / CAST(100 AS DOUBLE)) AS price,
               least(1.0, CAST((n_bought + 1) AS DOUBLE) / (n_weeks + 2)
                   * (1 + (1 + 3 * coupon_share) * discount / CAST(100 AS DOUBLE))) AS proba
        FROM v_candidates, (SELECT unnest([15, 20, 25, 30]) AS discount)""",
    "v_best": """
        SELECT week, shopper, product, discount, round(price * proba, 6) AS e_revenue,
               row_number() OVER (PARTITION BY shopper, product
                   ORDER BY round(price * proba, 6) DESC, discount) AS rn
        FROM v_scored""",
    "v_recs": """
        SELECT shopper, week, CAST(rk - 1 AS INTEGER) AS coupon, product, discount, e_revenue
        FROM (SELECT *, row_number() OVER (PARTITION BY shopper
                  ORDER BY e_revenue DESC, product) AS rk FROM v_best WHERE rn = 1)
        WHERE rk <= 5""",
    # Order model.
    "v_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
               CAST(row_number() OVER w AS INTEGER) AS order_number,
               CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
               CAST(o_orderkey % 24 AS INTEGER) AS order_hour_of_day,
               CAST(date_diff('day', lag(o_orderdate) OVER w, o_orderdate) AS DOUBLE)
                   AS days_since_prior_order
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
    "v_products": """
        SELECT p_partkey AS product_id, p_name AS product_name, product AS aisle_id,
               CAST(list_position(['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'],
                   p_type) - 1 AS INTEGER) AS department_id, p_type AS department, p_brand AS aisle
        FROM v_part""",
    "v_raw_lines": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id,
               CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
                   l_suppkey, l_extendedprice) AS INTEGER) AS add_to_cart_order
        FROM lineitem""",
    "v_lines": """
        SELECT l.order_id, l.product_id, l.add_to_cart_order, p.aisle_id, p.department_id,
               p.aisle, p.department, p.product_name, o.user_id, o.order_number, o.order_dow,
               o.order_hour_of_day, o.days_since_prior_order,
               CASE WHEN o.order_number > min(o.order_number) OVER (
                   PARTITION BY o.user_id, p.aisle_id) THEN 1 ELSE 0 END AS reordered
        FROM v_raw_lines l JOIN v_products p USING (product_id) JOIN v_orders o USING (order_id)""",
    "v_placed": """
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY order_number DESC) - 1 AS lag
        FROM (SELECT DISTINCT user_id, order_id, order_number, days_since_prior_order
              FROM v_lines)""",
    "v_lines2": """
        SELECT l.* FROM v_lines l
        ANTI JOIN (SELECT order_id FROM v_placed WHERE lag = 0) x USING (order_id)""",
    "v_order_means": """
        SELECT order_id, user_id, order_number, order_dow, order_hour_of_day,
               days_since_prior_order, avg(reordered) AS reordered,
               avg(add_to_cart_order) AS add_to_cart_order, count(*) AS nb_products_order
        FROM v_lines GROUP BY ALL""",
    "v_two_level": """
        SELECT user_id, avg(reordered) AS reordered_ratio, avg(order_dow) AS order_dow,
               avg(order_hour_of_day) AS order_hour_of_day,
               avg(add_to_cart_order * 2 - 1) AS item_count,
               CAST(count(*) AS DOUBLE) AS no_orders,
               avg(days_since_prior_order) AS order_frequency_in_days
        FROM v_order_means GROUP BY user_id""",
    "v_gaps": """
        SELECT user_id, max(CASE WHEN lag = 0 THEN days_since_prior_order END) AS days_lag_0,
               max(CASE WHEN lag = 1 THEN days_since_prior_order END) AS days_lag_1,
               max(CASE WHEN lag = 2 THEN days_since_prior_order END) AS days_lag_2,
               max(CASE WHEN lag = 3 THEN days_since_prior_order END) AS days_lag_3
        FROM v_placed WHERE lag < 4 GROUP BY user_id""",
    "v_returns": """
        SELECT *, CASE WHEN no_orders <> 2 THEN (order_frequency_in_days * (no_orders - 1)
                   - days_lag_0) / (no_orders - 2) END AS order_frequency_without_lag_0
        FROM v_two_level LEFT JOIN v_gaps USING (user_id)""",
    "v_segment": """
        SELECT user_id, avg(nb_products_order) AS average_item_size_of_orders,
               CAST(count(*) AS DOUBLE) AS total_number_of_orders,
               avg(days_since_prior_order) AS average_lag_in_days,
               round_even(median(order_hour_of_day), 0) AS median_hour,
               avg(order_dow) AS average_order_dow, avg(reordered) AS reordered_ratio
        FROM v_order_means GROUP BY user_id""",
    "v_user_features": """
        SELECT *, no_item_orders / no_orders AS avg_no_items,
               no_orders / (inter_order_time + 1) AS orders_per_day
        FROM (SELECT user_id,
                     avg(CASE WHEN days_since_prior_order > 14 THEN 0 ELSE 1 END)
                         AS reordered_w14d_ratio,
                     avg(reordered) AS reordered_ratio, max(order_number) AS no_orders,
                     count(*) AS no_item_orders,
                     coalesce(sum(days_since_prior_order), 0) AS inter_order_time,
                     avg(days_since_prior_order) AS avg_days_between_orders
              FROM v_lines2 GROUP BY user_id)""",
    "v_scores": """
        SELECT l.doc_id, l.quality AS y,
               round(1 / (1 + exp(-((n_chars - 2000) / CAST(2000 AS DOUBLE)))), 6) AS p
        FROM labels l JOIN documents d ON d.doc_id = l.doc_id""",
    "v_weekly": """
        SELECT shopper, week, count(*) AS n, sum(price) AS v FROM v_baskets GROUP BY ALL""",
    "v_modal": """
        SELECT week, product, price AS modal_price, n AS n_at_price
        FROM (SELECT week, product, price, count(*) AS n, row_number() OVER (
                  PARTITION BY week, product ORDER BY count(*) DESC, price) AS rn
              FROM v_sales GROUP BY week, product, price) WHERE rn = 1""",
    "v_filled": """
        SELECT product, week, modal_price,
               coalesce(last_value(modal_price IGNORE NULLS) OVER (PARTITION BY product
                            ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                        first_value(modal_price IGNORE NULLS) OVER (PARTITION BY product
                            ORDER BY week ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
                   AS filled_price
        FROM (SELECT g.product, g.week, m.modal_price
              FROM (SELECT product, CAST(unnest(range(0, 79)) AS INTEGER) AS week
                    FROM (SELECT DISTINCT product FROM v_modal)) g
              LEFT JOIN v_modal m USING (product, week))""",
    "v_same_category": """
        SELECT week, shopper, category_label, bought_product, product, 0 AS product_bought
        FROM (SELECT b.week, b.shopper, c.category_label, b.product AS bought_product, s.product,
                     row_number() OVER (PARTITION BY b.week, b.shopper, b.product ORDER BY
                         md5(concat_ws('-', '42', b.week, b.shopper, b.product, s.product)),
                         s.product) AS rn
              FROM v_baskets b JOIN v_categories c ON c.product = b.product
              JOIN (SELECT DISTINCT week, category_label, v_baskets.product FROM v_baskets
                    JOIN v_categories USING (product)) s
                  ON s.week = b.week AND s.category_label = c.category_label
              WHERE NOT EXISTS (SELECT 1 FROM v_baskets h WHERE h.week = b.week
                                AND h.shopper = b.shopper AND h.product = s.product))
        WHERE rn = 1""",
    # The same draw by brute force: the free products of each row in order, place r of them.
    "v_by_rank": """
        SELECT week, shopper, category_label, bought_product, product, 0 AS product_bought
        FROM (SELECT b.week, b.shopper, c.category_label, b.product AS bought_product, s.product,
                     row_number() OVER w - 1 AS place,
                     ('0x' || substr(md5(concat_ws('-', '42', b.week, b.shopper, b.product, 1)),
                                     1, 12))::BIGINT % count(*) OVER (
                         PARTITION BY b.week, b.shopper, b.product) AS draw
              FROM v_baskets b JOIN v_categories c ON c.product = b.product
              JOIN (SELECT DISTINCT week, category_label, v_baskets.product FROM v_baskets
                    JOIN v_categories USING (product)) s
                  ON s.week = b.week AND s.category_label = c.category_label
              WHERE NOT EXISTS (SELECT 1 FROM v_baskets h WHERE h.week = b.week
                                AND h.shopper = b.shopper AND h.product = s.product)
              WINDOW w AS (PARTITION BY b.week, b.shopper, b.product ORDER BY s.product))
        WHERE place = draw""",
    "v_positions": """
        SELECT week, shopper, product, product_bought,
               row_number() OVER (ORDER BY week, shopper, product) - 1 AS position,
               count(*) OVER () AS total
        FROM v_rows""",
}

# The recommendations again, from the weeks before the holdout week only.
_PAST = ("heuristic", "heuristic_top", "candidates", "scored", "best", "recs")
for _name in ("baskets", "coupons", "rows"):
    VIEWS[f"v_past_{_name}"] = f"SELECT * FROM v_{_name} WHERE week < 78"
for _name in _PAST:
    VIEWS[f"v_past_{_name}"] = re.sub(
        rf"\bv_({'|'.join(_PAST)}|baskets|coupons|rows)\b", r"v_past_\1", VIEWS[f"v_{_name}"]
    )

_NAME = re.compile(r"\bv_[a-z0-9_]+\b")


def compose(body: str) -> str:
    """Prefix ``body`` with the WITH clause of every view it uses, in order."""
    ordered: list[str] = []

    def visit(sql: str) -> None:
        for name in _NAME.findall(sql):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                if name not in ordered:
                    ordered.append(name)

    visit(body)
    if not ordered:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in ordered)
    body = body.strip()
    if body.startswith("WITH "):
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"
