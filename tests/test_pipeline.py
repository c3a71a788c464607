"""The folder pipeline gives the same tables as the named queries on the same data."""

import pytest
from pyspark.sql import functions as F

from tillroll.ml import booster
from tillroll.operators import coupons, features, quality
from tillroll.pipeline import RetailFolder
from tillroll.plans import PLANS
from tillroll.plans.flow import Flow
from tillroll.sources import tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shop"))
    flow = Flow(spark, SF_DIR)
    doubled = flow.baskets.unionByName(flow.baskets.withColumn("price", F.col("price") + 1))
    unknown = flow.baskets.limit(3).withColumn("shopper", F.lit(None).cast("bigint"))
    tables.write_parquet(doubled.unionByName(unknown), f"{path}/baskets.parquet")
    tables.write_parquet(flow.coupons, f"{path}/coupons.parquet")
    tables.write_csv(flow.categories, f"{path}/product_categories.csv")
    return RetailFolder(spark, path, flow.holdout_week, flow.target_week), flow, path


def same(a, b):
    a = a.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in a.dtypes])
    b = b.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in b.dtypes])
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_repeated_and_unknown_keys_are_merged_away(shop):
    folder, flow, _ = shop
    assert same(folder.baskets, flow.baskets)


def test_datasets_and_recommendations(shop):
    folder, flow, path = shop
    folder.share_offers()
    train, test = folder.generate_dataset((0, 77), (1, 78), path)
    assert quality.contract_violations(train, features.FEATURE_COLUMNS) == []
    assert same(train, flow.feature_table(0, 77))
    bounds = test.agg(F.min("week"), F.max("week")).first()
    assert (bounds[0] >= 1, bounds[1]) == (True, 78)
    model = booster.train_gbt(train, n_estimators=2, max_depth=3, learning_rate=0.1, weighted=True)
    recs = folder.recommend(model)
    assert recs.columns[:5] == ["shopper", "week", "coupon", "product", "discount"]
    assert recs.select("shopper").distinct().count() == folder.preferences.select(
        "shopper"
    ).distinct().count()


def test_shopper_limit_reaches_the_scan(spark, shop):
    folder = RetailFolder(spark, shop[2], max_shopper=20)
    plan = folder.baskets._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(shopper,20)" in plan
    assert folder.baskets.agg(F.max("shopper")).first()[0] < 20


def test_recommendations_know_nothing_of_the_holdout_week(spark):
    def found(flow):
        past = flow.before(78)
        best = coupons.assign_coupons(past.scored).collect()
        return sorted(map(tuple, best)), sorted(past.heuristic(78).collect(), key=str)

    whole, cut = Flow(spark, SF_DIR), Flow(spark, SF_DIR)
    for name in ("baskets", "coupons", "offers"):
        setattr(cut, name, getattr(whole, name).where("week < 78"))
    assert found(whole) == found(cut)


def test_star_left_keeps_lines_without_product_or_order(spark):
    class Loose(Flow):
        def table(self, name):
            rows = super().table(name)
            if name != "lineitem":
                return rows
            lost = {c: F.lit(-1).cast("bigint") for c in ("l_orderkey", "l_partkey")}
            return rows.unionByName(rows.limit(1).withColumns(lost))

    d = Loose(spark, SF_DIR)
    joined = PLANS["star_left"].build(d)
    assert joined.count() == d.table("lineitem").count()
    lost = joined.where("order_id = -1").collect()
    assert [(r.product_name, r.user_id, r.reordered) for r in lost] == [(None, None, None)]
