"""Named queries on baskets, scores and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import columns as fx
from tillroll.operators import baskets, itemsets, metrics, vectors
from tillroll.plans.flow import Flow
from tillroll.plans.registry import half_up, plan, rounded
from tillroll.sources.dataset import N_PRODUCTS

MIN_SUPPORT = 0.001
PRODUCTS = list(range(N_PRODUCTS))

# ---- baskets ----------------------------------------------------------------


@plan("basket_id", "SELECT week, shopper, product, price, concat_ws('-', week, shopper) "
      "AS basket_id FROM v_baskets")
def basket_id(d: Flow) -> DataFrame:
    return baskets.basket_id(d.baskets)


@plan("baskets", """
    SELECT shopper, week, string_agg(product, ',' ORDER BY product) AS products,
           round(sum(price), 2) AS price, CAST(count(*) AS INTEGER) AS basket_size
    FROM v_baskets GROUP BY shopper, week""")
def basket_table(d: Flow) -> DataFrame:
    lists = baskets.baskets_list(d.baskets)
    return rounded(lists.withColumn("products", fx.joined("products")), price=2)


@plan("top_products_semi", """
    SELECT week, shopper, product, price FROM v_baskets
    SEMI JOIN (SELECT product FROM v_baskets GROUP BY product ORDER BY count(*) DESC, product
               LIMIT 101) USING (product)""")
def top_products_semi(d: Flow) -> DataFrame:
    return baskets.keep_top_products(d.baskets).select("week", "shopper", "product", "price")


@plan("basket_lists", """
    SELECT concat_ws('-', week, shopper) AS basket_id,
           string_agg(product, ',' ORDER BY product) AS products
    FROM v_baskets GROUP BY week, shopper""")
def basket_lists(d: Flow) -> DataFrame:
    lists = baskets.basket_lists(d.baskets)
    return lists.withColumn("products", fx.joined("products"))


@plan("basket_sets", """
    SELECT shopper, week, string_agg(product, ',' ORDER BY product) AS products
    FROM (SELECT DISTINCT shopper, week, product FROM v_sales) GROUP BY shopper, week""")
def basket_sets(d: Flow) -> DataFrame:
    sets = baskets.basket_sets(d.sales, ["shopper", "week"])
    return sets.withColumn("products", fx.joined("products"))


@plan("other_basket_products", """
    SELECT a.week, a.shopper, a.product,
           coalesce(string_agg(b.product, ',' ORDER BY b.product), '') AS other_products
    FROM v_baskets a LEFT JOIN v_baskets b ON a.week = b.week AND a.shopper = b.shopper
        AND a.product <> b.product
    GROUP BY ALL""")
def other_basket_products(d: Flow) -> DataFrame:
    rest = baskets.other_basket_products(d.baskets)
    return rest.withColumn("other_products", fx.joined("other_products"))


@plan("pad_baskets", """
    SELECT week, shopper, basket_size, m AS padded_size,
           products || repeat(',0', CAST(m - basket_size AS INTEGER)) AS products
    FROM (SELECT week, shopper, CAST(count(*) AS INTEGER) AS basket_size,
                 max(CAST(count(*) AS INTEGER)) OVER () + 1 AS m,
                 string_agg(product + 1, ',' ORDER BY product) AS products
          FROM v_baskets GROUP BY week, shopper)""")
def pad_baskets(d: Flow) -> DataFrame:
    """Product codes from 1 in lists of one common length (longest basket + 1), 0 after."""
    sets = baskets.basket_sets(
        d.baskets.withColumn("product", F.col("product") + 1), ["week", "shopper"]
    ).withColumn("basket_size", F.size("products"))
    length = d.baskets.groupBy("week", "shopper").count().agg(
        (F.max("count") + 1).cast("int").alias("m")
    ).scalar()
    padded = fx.joined(fx.pad("products", F.col("padded_size")))
    return sets.withColumn("padded_size", length).withColumn("products", padded)


@plan("crosstab", "SELECT shopper, " + ", ".join(
    f"count(*) FILTER (WHERE product = {p}) AS product_{p}" for p in PRODUCTS)
    + " FROM v_baskets GROUP BY shopper")
def crosstab(d: Flow) -> DataFrame:
    return baskets.crosstab(d.baskets, "shopper", "product", PRODUCTS)


@plan("basket_matrix", "SELECT concat_ws('-', week, shopper) AS basket_id, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE product = {p}) > 0 AS INTEGER) AS product_{p}" for p in PRODUCTS)
    + " FROM v_baskets GROUP BY week, shopper")
def basket_matrix(d: Flow) -> DataFrame:
    return baskets.basket_matrix(d.baskets, PRODUCTS)


@plan("label_encode", """
    SELECT label, CAST(row_number() OVER (ORDER BY label) - 1 AS INTEGER) AS code
    FROM (SELECT DISTINCT p_name AS label FROM part)""")
def label_encode(d: Flow) -> DataFrame:
    return baskets.label_encode(d.table("part"), "p_name")


@plan("cooccurrence", """
    SELECT a.product_id AS item_a, b.product_id AS item_b, count(*) AS n
    FROM (SELECT DISTINCT l_orderkey, l_partkey AS product_id FROM lineitem) a
    JOIN (SELECT DISTINCT l_orderkey, l_partkey AS product_id FROM lineitem) b
        ON a.l_orderkey = b.l_orderkey AND a.product_id <> b.product_id
    GROUP BY 1, 2""")
def cooccurrence(d: Flow) -> DataFrame:
    return baskets.cooccurrence(d.table("lineitem"), "l_orderkey", "l_partkey")


_ITEMSETS = """
    WITH k AS (SELECT count(*) AS n FROM (SELECT DISTINCT week, shopper FROM v_baskets)),
         one AS (SELECT product, count(*) AS freq FROM v_baskets GROUP BY product
                 HAVING count(*) >= ceil(0.001 * (SELECT n FROM k))),
         two AS (SELECT a.product AS p, b.product AS q, count(*) AS freq
                 FROM v_baskets a JOIN v_baskets b ON a.week = b.week AND a.shopper = b.shopper
                     AND a.product < b.product
                 GROUP BY 1, 2 HAVING count(*) >= ceil(0.001 * (SELECT n FROM k)))"""


@plan("frequent_itemsets", _ITEMSETS + """
    SELECT CAST(product AS VARCHAR) AS items, 1 AS size, freq,
           round(freq / (SELECT n FROM k), 6) AS support FROM one
    UNION ALL SELECT p || ',' || q, 2, freq, round(freq / (SELECT n FROM k), 6) FROM two""")
def frequent_itemsets(d: Flow) -> DataFrame:
    """Item sets of one and two products per basket."""
    lines = baskets.basket_id(d.baskets)
    sets = baskets.frequent_itemsets(lines, "basket_id", "product", MIN_SUPPORT)
    return rounded(sets.withColumn("items", fx.joined("items")))


@plan("association_rules", _ITEMSETS + """
    SELECT * FROM (
        SELECT CAST(a.product AS VARCHAR) AS antecedent, c.product AS consequent,
               round(t.freq / n, 6) AS support, round(t.freq / a.freq, 6) AS confidence,
               round((t.freq / a.freq) / (c.freq / n), 6) AS lift
        FROM (SELECT p, q, freq FROM two UNION ALL SELECT q, p, freq FROM two) t
        JOIN one a ON a.product = t.p JOIN one c ON c.product = t.q CROSS JOIN k)
    WHERE lift >= 1""")
def association_rules(d: Flow) -> DataFrame:
    """Rules with one antecedent and a lift of 1 or more."""
    lines = baskets.basket_id(d.baskets)
    rules = baskets.association_rules(lines, "basket_id", "product", MIN_SUPPORT)
    return rounded(rules).where(F.col("lift") >= 1).withColumn(
        "antecedent", F.col("antecedent").cast("string")
    )


_SETS = """
    WITH n AS (SELECT count(*) AS n FROM (SELECT DISTINCT week, shopper FROM v_baskets)),
         two AS (SELECT a.week, a.shopper, a.product AS p, b.product AS q
                 FROM v_baskets a JOIN v_baskets b USING (week, shopper) WHERE a.product < b.product),
         three AS (SELECT t.*, c.product AS r FROM two t JOIN v_baskets c USING (week, shopper)
                   WHERE q < c.product),
         four AS (SELECT t.*, d.product AS s FROM three t JOIN v_baskets d USING (week, shopper)
                  WHERE r < d.product),
         found AS (SELECT [product] AS items, count(*) AS freq FROM v_baskets GROUP BY 1
                   UNION ALL SELECT [p, q], count(*) FROM two GROUP BY 1
                   UNION ALL SELECT [p, q, r], count(*) FROM three GROUP BY 1
                   UNION ALL SELECT [p, q, r, s], count(*) FROM four GROUP BY 1),
         sets AS (SELECT items, CAST(len(items) AS INTEGER) AS size, freq, freq / (SELECT n FROM n) AS support
                  FROM found WHERE freq >= ceil(0.001 * (SELECT n FROM n)))"""


@plan("itemsets_all_sizes", _SETS + """
    SELECT array_to_string(items, ',') AS items, size, freq, round(support, 6) AS support FROM sets""")
def itemsets_all_sizes(d: Flow) -> DataFrame:
    """Item sets of one to four products, level by level."""
    sets = itemsets.frequent_sets(baskets.basket_id(d.baskets), "basket_id", "product", MIN_SUPPORT)
    return rounded(sets.drop("baskets").withColumn("items", fx.joined("items")))


@plan("rules_between_sets", _SETS + """
    , cut AS (SELECT items, freq, support, unnest(range(1, (1 << size) - 1)) AS mask FROM sets WHERE size > 1),
    parts AS (SELECT freq, support, [x FOR x, i IN items IF (mask >> (i - 1)) & 1 = 1] AS antecedent,
                     [x FOR x, i IN items IF (mask >> (i - 1)) & 1 = 0] AS consequent FROM cut)
    SELECT array_to_string(antecedent, ',') AS antecedent, array_to_string(consequent, ',') AS consequent,
           round(p.support, 6) AS support, round(p.freq / a.freq, 6) AS confidence,
           round(CAST(p.freq AS DOUBLE) * n / (CAST(a.freq AS DOUBLE) * c.freq), 6) AS lift,
           CASE WHEN CAST(p.freq AS DOUBLE) * n / (CAST(a.freq AS DOUBLE) * c.freq) < 1
                THEN 'below 1' ELSE '1 or more' END AS slice
    FROM n, parts p JOIN sets a ON a.items = p.antecedent JOIN sets c ON c.items = p.consequent""")
def rules_between_sets(d: Flow) -> DataFrame:
    """Rules with one or more products on both sides, and on which side of 1 their lift is."""
    sets = itemsets.frequent_sets(baskets.basket_id(d.baskets), "basket_id", "product", MIN_SUPPORT)
    rules = itemsets.set_rules(sets, max_items=4)
    below = F.when(F.col("lift") < 1, "below 1").otherwise("1 or more")
    named = rules.withColumns({c: fx.joined(c) for c in ("antecedent", "consequent")})
    return half_up(named.withColumn("slice", below))


# ---- scores -----------------------------------------------------------------


@plan("log_loss", """
    SELECT round(-avg(y * ln(p) + (1 - y) * ln(1 - p)), 6) AS log_loss, count(*) AS n
    FROM (SELECT y, greatest(least(p, 1 - 1e-15::DOUBLE), 1e-15::DOUBLE) AS p FROM v_scores)""")
def log_loss(d: Flow) -> DataFrame:
    return rounded(metrics.log_loss(d.scores))


@plan("r2_score", """
    SELECT round(pow(corr(y, p), 2), 6) AS r2_correlation,
           round(1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)), 6) AS r2_residual
    FROM v_scores""")
def r2_score(d: Flow) -> DataFrame:
    return rounded(metrics.r2_score(d.scores, "y", "p"))


_CONFUSION = """
    WITH c AS (SELECT count(*) FILTER (WHERE p >= 0.5 AND y = 1) AS tp,
                      count(*) FILTER (WHERE p >= 0.5 AND y = 0) AS fp,
                      count(*) FILTER (WHERE p < 0.5 AND y = 0) AS tn,
                      count(*) FILTER (WHERE p < 0.5 AND y = 1) AS fn FROM v_scores)"""


@plan("confusion_matrix", _CONFUSION + """
    SELECT *, round(tp / (tp + fn), 6) AS tpr, round(fp / (fp + tn), 6) AS fpr,
           round(tp / (tp + fn), 6) AS sensitivity, round(1 - fp / (fp + tn), 6) AS specificity
    FROM c""")
def confusion_matrix(d: Flow) -> DataFrame:
    return rounded(metrics.confusion(d.scores))


@plan("classification_report", _CONFUSION + """
    SELECT round((tp + tn) / (tp + fp + tn + fn), 6) AS accuracy,
           round(1 - (tp + tn) / (tp + fp + tn + fn), 6) AS error,
           round(tp / (tp + fn), 6) AS recall, round(tp / (tp + fp), 6) AS precision,
           round(2 * tp / (2 * tp + fp + fn), 6) AS f1
    FROM c""")
def classification_report(d: Flow) -> DataFrame:
    return rounded(metrics.classification_report(d.scores))


_ROC = """
    SELECT t.threshold, count(*) FILTER (WHERE p >= t.threshold AND y = 0)
               / count(*) FILTER (WHERE y = 0) AS fpr,
           count(*) FILTER (WHERE p >= t.threshold AND y = 1)
               / count(*) FILTER (WHERE y = 1) AS tpr
    FROM v_scores, (SELECT round(unnest(range(0, 21)) * 0.05::DOUBLE, 2) AS threshold) t
    GROUP BY t.threshold"""


@plan("roc_points", "SELECT threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr "
      f"FROM ({_ROC})")
def roc_points(d: Flow) -> DataFrame:
    return rounded(metrics.roc_points(d.scores))


@plan("auc_trapezoid", f"""
    SELECT round(sum((l_fpr - fpr) * (l_tpr + tpr) / 2), 6) AS auc
    FROM (SELECT fpr, tpr, lag(fpr) OVER (ORDER BY threshold) AS l_fpr,
                 lag(tpr) OVER (ORDER BY threshold) AS l_tpr FROM ({_ROC}))""")
def auc_trapezoid(d: Flow) -> DataFrame:
    return rounded(metrics.auc_trapezoid(d.scores))


@plan("auc_exact", """
    SELECT round(sum(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0.0 END)::DOUBLE
               / count(*), 6) AS auc
    FROM (SELECT p FROM v_scores WHERE y = 1) a, (SELECT p FROM v_scores WHERE y = 0) b""")
def auc_exact(d: Flow) -> DataFrame:
    return rounded(metrics.auc_exact(d.scores))


@plan("score_slices", """
    SELECT doc_id, y, p, CASE WHEN p > 0.8 THEN 'high' ELSE 'low' END AS slice
    FROM v_scores WHERE p > 0.8 OR p < 0.4""")
def score_slices(d: Flow) -> DataFrame:
    return metrics.score_slices(d.scores)


# ---- vectors ----------------------------------------------------------------


@plan("most_similar", """
    SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding
               FROM embeddings WHERE vec_id = 71)::DOUBLE[]), 6) AS similarity
    FROM embeddings WHERE vec_id <> 71 ORDER BY similarity DESC, vec_id LIMIT 10""")
def most_similar(d: Flow) -> DataFrame:
    """The ten vectors closest to item 71."""
    return vectors.most_similar(d.points, "vec_id", "embedding", 71)


_PAIRS = """
    WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
         dist AS (SELECT a.vec_id, a.label, b.label AS other,
                         sum(list_distance(a.x, b.x) ** 2) AS s, count(*) AS n
                  FROM e a, e b GROUP BY ALL),
         own AS (SELECT vec_id, label, s / (n - 1) AS a FROM dist WHERE label = other)"""


@plan("silhouette_exact", _PAIRS + """
    , near AS (SELECT vec_id, min(s / n) AS b FROM dist WHERE label <> other GROUP BY vec_id)
    SELECT label, count(*) AS n, round(avg((b - a) / greatest(a, b)), 6) AS silhouette
    FROM own JOIN near USING (vec_id) GROUP BY label""")
def silhouette_exact(d: Flow) -> DataFrame:
    scored = vectors.silhouette(d.points, "vec_id", "embedding", "label")
    return rounded(vectors.silhouette_by_cluster(scored))


@plan("silhouette_centroid", _PAIRS + """
    , c AS (SELECT label, list(m ORDER BY i) AS m
            FROM (SELECT label, i, avg(x[i]) AS m
                  FROM e, (SELECT unnest(range(1, 65)) AS i) GROUP BY label, i) GROUP BY label),
    near AS (SELECT vec_id, min(list_distance(x, m) ** 2) AS b
             FROM e JOIN c ON c.label <> e.label GROUP BY vec_id)
    SELECT label, count(*) AS n, round(avg((b - a) / greatest(a, b)), 6) AS silhouette
    FROM own JOIN near USING (vec_id) GROUP BY label""")
def silhouette_centroid(d: Flow) -> DataFrame:
    scored = vectors.silhouette(
        d.points, "vec_id", "embedding", "label", centroid_variant=True
    )
    return rounded(vectors.silhouette_by_cluster(scored))
