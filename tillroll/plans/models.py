"""Named queries that fit models. Fitted numbers are checked by invariants."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.ml import booster, cbow, elbow, products, returns, segments
from tillroll.ml.histboost import Boosted
from tillroll.operators import baskets, basic, coupons, encoding, features, metrics, orders, splits
from tillroll.operators.vectors import most_similar
from tillroll.plans.flow import TRAIN, Flow
from tillroll.plans.orders import BOXCOX_GRID
from tillroll.plans.registry import plan, rounded
from tillroll.sources import models, workspace
from tillroll.sources.dataset import HOLDOUT_WEEK

CATEGORIES = 6


def _data(d: Flow) -> str:
    """All that models learn from."""
    return models.fingerprint([d.table(t) for t in ("lineitem", "orders", "part")])


# ---- products ---------------------------------------------------------------


def _p2v(d: Flow) -> DataFrame:
    """The embedding of a folder, trained once."""

    def lists() -> tuple[DataFrame]:
        return (workspace.stage(baskets.baskets_list(d.baskets).select("products"), "baskets"),)

    save = lambda m, _, path: m.write.mode("overwrite").parquet(path)
    load = lambda spark, path: spark.read.parquet(path)
    return models.fit_once(d.spark, "p2v", _data(d), products.train_p2v, lists, save, load)


@plan("train_p2v")
def train_p2v(d: Flow) -> DataFrame:
    """The learned vectors in long form: (product, dimension, value)."""
    vectors = products.product_vectors(_p2v(d))
    return vectors.select("product", F.posexplode(vector_to_array("vector"))).withColumnsRenamed(
        {"pos": "dimension", "col": "value"}
    )


@plan("similar_products")
def similar_products(d: Flow) -> DataFrame:
    return products.similar_products(_p2v(d), product=7)


def _cbow(d: Flow) -> DataFrame:
    """The bag-of-words vectors of a folder, trained once."""

    def lists() -> tuple[DataFrame]:
        return (baskets.baskets_list(d.baskets).select("shopper", "week", "products"),)

    save = lambda m, _, path: m.write.mode("overwrite").parquet(path)
    load = lambda spark, path: spark.read.parquet(path)
    return models.fit_once(d.spark, "cbow", _data(d), cbow.train_cbow, lists, save, load)


@plan("train_cbow")
def train_cbow(d: Flow) -> DataFrame:
    """The learned vectors in long form: (product, dimension, value)."""
    return _cbow(d).select("product", F.posexplode("vector").alias("dimension", "value"))


@plan("similar_products_cbow")
def similar_products_cbow(d: Flow) -> DataFrame:
    """The ten products closest to the most bought one."""
    vectors = _cbow(d)
    sold = d.baskets.join(vectors, "product", "left_semi").groupBy("product").count()
    first = sold.orderBy(F.desc("count"), "product").first()
    return most_similar(vectors, "product", "vector", first["product"] if first else None)


@plan("embed_pca2")
def embed_pca2(d: Flow) -> DataFrame:
    return products.project_2d(products.product_vectors(_p2v(d))).drop("components")


@plan("product_categories")
def product_categories(d: Flow) -> DataFrame:
    points = products.project_2d(products.product_vectors(_p2v(d)))
    return products.product_categories(points, CATEGORIES)


# ---- segments ---------------------------------------------------------------


def _segment_points(d: Flow) -> DataFrame:
    users = workspace.stage(orders.segment_features(d.items), "segments")
    return workspace.stage(segments.assemble(segments.transform(users, BOXCOX_GRID)), "points")


@plan("kmeans_elbow")
def kmeans_elbow(d: Flow) -> DataFrame:
    found = segments.elbow(_segment_points(d), range(1, 11))
    return d.spark.createDataFrame(found, "k int, sse double")


@plan("kmeans_elbow_40")
def kmeans_elbow_40(d: Flow) -> DataFrame:
    """Cost of 2 to 40 product categories on the projected embedding, and what each k saves."""
    plane = products.project_2d(products.product_vectors(_p2v(d))).select("x", "y")
    found = elbow.fit_many(workspace.stage(plane, "plane"), range(2, 41))
    costs = [found[k][1] for k in found]
    saved = [None, *(a - b for a, b in zip(costs, costs[1:]))]
    return d.spark.createDataFrame(list(zip(found, costs, saved)), "k int, sse double, saved double")


@plan("cluster_profile")
def cluster_profile(d: Flow) -> DataFrame:
    points = _segment_points(d)
    return segments.profile(segments.fit_segments(points).transform(points))


@plan("segment_profile")
def segment_profile(d: Flow) -> DataFrame:
    """The clustered customers in long form, as used for the profile plot."""
    points = _segment_points(d)
    return segments.melt(segments.fit_segments(points).transform(points))


# ---- booster ----------------------------------------------------------------


def _metric_table(scored: DataFrame) -> DataFrame:
    """(metric, value) of (y, p) rows."""
    report = metrics.classification_report(scored)
    one = {
        "log_loss": metrics.log_loss(scored).select("log_loss").scalar(),
        "auc": metrics.auc_exact(scored).select("auc").scalar(),
    }
    wide = report.withColumns(one)
    return wide.unpivot([], wide.columns, "metric", "value")


@plan("train_gbt")
def train_gbt(d: Flow) -> DataFrame:
    """Metrics of the booster on the holdout week; trained up to week 70, then validated."""
    flow = d.materialised()
    # the features of the training rows know nothing of the holdout week
    train, test = flow.generate_dataset(TRAIN, (1, HOLDOUT_WEEK))

    def halves() -> tuple[DataFrame, DataFrame]:
        table = workspace.stage(train, "features")
        return table.where("week <= 70"), table.where("week > 70")

    model = models.fit_once(d.spark, "validated", _data(d), booster.train_gbt, halves, booster.save, booster.load)
    keep = [F.col(booster.LABEL).alias("y")]
    holdout = test.where(F.col("week") == HOLDOUT_WEEK)
    scored = booster.predict(model, holdout, keep).withColumnRenamed("proba", "p")
    return rounded(_metric_table(workspace.stage(scored, "scored")))


def _final_model(d: Flow) -> tuple[Flow, Boosted]:
    """The booster of all training weeks, fitted once per folder."""
    flow = d.materialised()
    table = lambda: (flow.feature_table(*TRAIN),)
    return flow, models.fit_once(d.spark, "booster", _data(d), booster.train_gbt, table, booster.save, booster.load)


@plan("score_scenarios")
def score_scenarios(d: Flow) -> DataFrame:
    flow, model = _final_model(d)
    return booster.score_scenarios(model, flow.target_table)


@plan("assign_coupons_gbt")
def assign_coupons_gbt(d: Flow) -> DataFrame:
    flow, model = _final_model(d)
    return flow.recommend(model)


@plan("feature_importance")
def feature_importance(d: Flow) -> DataFrame:
    _, model = _final_model(d)
    return d.spark.createDataFrame(booster.importance(model), "feature string, importance double")


@plan("model_roundtrip")
def model_roundtrip(d: Flow) -> DataFrame:
    """Scores of the saved and reloaded model against those of the fitted one."""
    flow, model = _final_model(d)
    again = booster.load(d.spark, booster.save(model, d.spark, workspace.new_path(d.spark, "booster")))
    key = ["week", "shopper", "product", "discount"]
    before = booster.score_scenarios(model, flow.target_table).select(*key, "proba")
    after = booster.score_scenarios(again, flow.target_table).select(
        *key, F.col("proba").alias("proba_again")
    )
    return before.join(after, key).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.abs(F.col("proba") - F.col("proba_again"))).alias("max_difference"),
    )


@plan("coupon_hit_rate_gbt")
def coupon_hit_rate_gbt(d: Flow) -> DataFrame:
    """Offers of the holdout week that the booster and the heuristic recommend from the weeks before."""
    flow, model = _final_model(d)
    week = basic.between_weeks(flow.rows, HOLDOUT_WEEK, HOLDOUT_WEEK)
    offered = basic.drop_empty_weeks(week, features.week_shopper_features(week)).where(F.col("discount") > 0)
    past = flow.before(HOLDOUT_WEEK)
    found = {"booster": past.recommend(model), "heuristic": past.heuristic(HOLDOUT_WEEK)}
    return rounded(coupons.coupon_hit_rate(found, offered))


# ---- returns within 14 days -------------------------------------------------


def _returns_split(d: Flow) -> tuple[DataFrame, DataFrame]:
    table = workspace.stage(orders.returns_14d(d.lines, d.placed), "returns")
    halves = splits.split_random(table, "user_id", 0.25, seed=42)
    return (
        halves.where(F.col("split") == "train").drop("split"),
        halves.where(F.col("split") == "test").drop("split"),
    )


def _returns_metrics(model, test: DataFrame) -> DataFrame:
    scored = returns.probabilities(model, test, [F.col(returns.LABEL).alias("y")])
    return rounded(_metric_table(scored))


@plan("lr_returns_14d")
def lr_returns_14d(d: Flow) -> DataFrame:
    train, test = _returns_split(d)
    return _returns_metrics(returns.fit_logistic(train), test)


def _stratified_returns(d: Flow) -> tuple[DataFrame, DataFrame]:
    table = workspace.stage(orders.returns_14d(d.lines, d.placed), "returns")
    halves = splits.split_stratified(table, "user_id", returns.LABEL, 0.20, seed=1)
    return halves.where(F.col("split") == "train"), halves.where(F.col("split") == "test")


@plan("gbt_returns_14d")
def gbt_returns_14d(d: Flow) -> DataFrame:
    """Boosted trees on the same customers, on a split stratified by the label."""
    train, test = _stratified_returns(d)
    return _returns_metrics(returns.fit_boosted(train), test)


@plan("cat_returns_14d")
def cat_returns_14d(d: Flow) -> DataFrame:
    """Symmetric trees on the same split, stopped by the test rows as the reference does."""
    train, test = _stratified_returns(d)
    return _returns_metrics(returns.fit_symmetric(train, test), test)


@plan("target_statistics", """
    SELECT week, shopper, product, product_bought,
           round((coalesce(sum(product_bought) OVER w, 0) + m) / (count(*) OVER w + 1), 6) AS product_mean
    FROM (SELECT week, shopper, product, product_bought, avg(product_bought) OVER () AS m FROM v_rows)
    WINDOW w AS (PARTITION BY product ORDER BY md5(concat_ws('-', '1', week, shopper, product)),
                 week, shopper, product ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def target_statistics(d: Flow) -> DataFrame:
    """Products by the share of purchases among the offers drawn before."""
    rows = d.rows.select(*basic.KEY, booster.LABEL)
    return rounded(encoding.ordered_target_statistic(rows, "product", booster.LABEL, basic.KEY))


@plan("rf_search")
def rf_search(d: Flow) -> DataFrame:
    """Cross-validated AUC of each drawn setting, best first."""
    train, _ = _returns_split(d)
    found = returns.search_forest(train)
    rows = [
        (
            ", ".join(f"{p.name}={v}" for p, v in sorted(s.items(), key=lambda kv: kv[0].name)),
            float(auc),
        )
        for s, auc in zip(found.getEstimatorParamMaps(), found.avgMetrics)
    ]
    return d.spark.createDataFrame(rows, "parameters string, auc double").orderBy(F.desc("auc"))


@plan("ols_returns_14d")
def ols_returns_14d(d: Flow) -> DataFrame:
    """Coefficients with standard errors, t and p values, with and without intercept."""
    train, _ = _returns_split(d)
    rows = [
        ("with_intercept" if with_intercept else "no_intercept", *row)
        for with_intercept in (True, False)
        for row in returns.fit_ols(train, with_intercept)
    ]
    schema = "model string, term string, coef double, std_error double, t double, p double"
    return d.spark.createDataFrame(rows, schema)
