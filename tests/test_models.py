"""Invariants of the fitted models on the smallest data set."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.ml import booster, products, returns, segments
from tillroll.operators import baskets, orders
from tillroll.operators.orders import RETURN_FEATURES
from tillroll.plans import PLANS
from tillroll.plans.flow import Flow

SF_DIR = "/root/testdata/sf0.001"


def test_vectors_are_reproducible(spark):
    lists = baskets.baskets_list(Flow(spark, SF_DIR).baskets).select("products").coalesce(1)
    fit = lambda: products.train_p2v(lists, vec_dim=5, epochs=2, partitions=1)
    a, b = (products.product_vectors(fit()).collect() for _ in range(2))
    assert a == b and len(a) > 0
    assert [r["product"] for r in a] == sorted(r["product"] for r in a)


def test_product_categories(spark):
    got = PLANS["product_categories"](spark, SF_DIR).collect()
    assert len({r["product"] for r in got}) == len(got)
    assert {r["category_label"] for r in got} <= set(range(6))


def test_elbow_falls(spark):
    users = orders.segment_features(Flow(spark, SF_DIR).items)
    points = segments.assemble(segments.transform(users, [0.0, 0.5, 1.0])).cache()
    n = points.count()
    sse = segments.elbow(points, [1, 2, 5])
    assert sse[0][1] == pytest.approx(3 * n, rel=0.2)  # three z-scores, open gaps at 0
    assert sse[0][1] > sse[1][1] > sse[2][1]
    clustered = segments.fit_segments(points).transform(points)
    assert segments.profile(clustered).agg(F.sum("n")).first()[0] == n
    assert segments.melt(clustered).count() == 3 * n


def test_booster_scores_every_scenario(spark):
    got = PLANS["score_scenarios"](spark, SF_DIR).toPandas()
    assert got["proba"].between(0, 1).all()
    assert set(got["discount"]) == {15, 20, 25, 30}
    assert len(got) == 4 * Flow(spark, SF_DIR).targets.count()


def test_booster_coupons(spark):
    got = PLANS["assign_coupons_gbt"](spark, SF_DIR).toPandas()
    sizes = got.groupby("shopper")["coupon"].agg(["min", "max", "count", "nunique"])
    assert (sizes["min"] == 0).all() and (sizes["max"] == sizes["count"] - 1).all()
    assert (sizes["count"] <= 5).all() and (sizes["count"] == sizes["nunique"]).all()
    assert not got.isna().any().any()


def test_saved_model_scores_the_same(spark):
    got = PLANS["model_roundtrip"](spark, SF_DIR).first()
    assert got["n"] > 0 and got["max_difference"] == 0.0


def test_ols_matches_normal_equations(spark):
    flow = Flow(spark, SF_DIR)
    table = orders.returns_14d(flow.lines, flow.placed)
    pdf = table.toPandas()
    x = pdf[RETURN_FEATURES].astype(float)
    x = x.fillna(x.mean())
    y = pdf[returns.LABEL].to_numpy(float)
    want, *_ = np.linalg.lstsq(np.column_stack([x, np.ones(len(x))]), y, rcond=None)
    got = returns.fit_ols(table, intercept=True)
    assert [r[1] for r in got] == pytest.approx(want.tolist(), rel=1e-4, abs=1e-6)
    assert all(0 <= r[4] <= 1 for r in got)


def test_search_draws_are_distinct():
    from pyspark.ml.classification import RandomForestClassifier

    drawn = returns.draw_parameters(RandomForestClassifier(), 30, seed=1)
    assert len({tuple(d.values()) for d in drawn}) == 30


@pytest.mark.parametrize(
    "query, module, fit",
    [
        ("train_gbt", booster, "train_gbt"),
        ("score_scenarios", booster, "train_gbt"),
        ("assign_coupons_gbt", booster, "train_gbt"),
        ("feature_importance", booster, "train_gbt"),
        ("model_roundtrip", booster, "train_gbt"),
        ("gbt_returns_14d", returns, "fit_boosted"),
        ("rf_search", returns, "search_forest"),
    ],
)
def test_queries_fit_at_the_full_settings(spark, monkeypatch, query, module, fit):
    class Fitted(Exception):
        pass

    def seen(train, evaluation=None, **settings):
        raise Fitted(settings)

    monkeypatch.setattr(module, fit, seen)
    with pytest.raises(Fitted) as told:
        PLANS[query](spark, SF_DIR)
    assert told.value.args == ({},)


def test_many_k_share_their_scans(spark, monkeypatch):
    import numpy as np

    from tillroll.ml import elbow

    rng = np.random.default_rng(2)
    centres = rng.uniform(-50, 50, (6, 2))
    x = np.concatenate([rng.normal(c, 0.5, (150, 2)) for c in centres])
    rows = [(float(a), float(b)) for a, b in x] + [(None, 1.0)]
    points = spark.createDataFrame(rows, "x double, y double").repartition(5)
    scans = []
    scan = elbow._scan
    monkeypatch.setattr(elbow, "_scan", lambda p, c: scans.append(sorted(c)) or scan(p, c))
    found = elbow.fit_many(points, range(1, 21))
    assert len(scans) < 60 and scans[0] == list(range(1, 21))
    costs = [found[k][1] for k in range(1, 21)]
    assert all(a >= b for a, b in zip(costs, costs[1:]))
    assert costs[0] == pytest.approx(((x - x.mean(0)) ** 2).sum())
    for k, (c, cost) in found.items():
        assert c.shape == (k, 2)
        assert cost == pytest.approx(((x[:, None] - c) ** 2).sum(2).min(1).sum())
    assert costs[5] < 1.2 * sum(((x[i * 150 :][:150] - x[i * 150 :][:150].mean(0)) ** 2).sum() for i in range(6))
    assert elbow.fit_many(points.where("false"), [2]) == {}
    same = elbow.fit_many(spark.createDataFrame([(1.0, 1.0)] * 3, "x double, y double"), [1, 4])
    assert [cost for _, cost in same.values()] == [0.0, 0.0]
