"""Hand fixtures for the purchase, feature, lag and coupon operators."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import basic, coupons, features, lags, quality, sampling, series
from tillroll.plans import PLANS
from tillroll.plans.flow import Flow

BASKETS = "week int, shopper bigint, product int, price double"
COUPONS = "week int, shopper bigint, product int, discount int"


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def flagged(spark):
    """Bought with offer, bought without, offered only, and a sampled row."""
    baskets = spark.createDataFrame([(1, 1, 10, 100.0), (1, 1, 11, 50.0)], BASKETS)
    offers = spark.createDataFrame([(1, 1, 10, 20), (1, 1, 12, 30)], COUPONS)
    samples = spark.createDataFrame([(1, 1, 13, 0.0)], BASKETS)
    merged = basic.merge_samples(basic.purchase_coupon_outer(baskets, offers), samples)
    return basic.purchase_flags(merged)


def test_flags(flagged):
    got = rows_of(
        flagged, "product", "discount_offered", "product_bought", "purchase_wo_dis",
        "no_purchase_w_dis", "discount_effect",
    )
    assert got == [
        (10, 1, 1, 0, 0, 1),
        (11, 0, 1, 1, 0, 0),
        (12, 1, 0, 0, 1, 0),
        (13, 0, 0, 0, 0, 0),
    ]


def test_samples_do_not_repeat_offers(spark, flagged):
    again = basic.merge_samples(
        flagged.select("week", "shopper", "product", "price", "discount"),
        spark.createDataFrame([(1, 1, 12, 0.0)], BASKETS),
    )
    assert again.count() == 4


def test_price_imputation(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 100.0, None), (2, 1, 1, None, 25), (3, 1, 1, None, None)],
        BASKETS + ", discount int",
    )
    got = rows_of(basic.impute_price(df, features.max_price(df)), "week", "price")
    assert got == [(1, 100.0), (2, 75.0), (3, 100.0)]


def test_mean_basket_is_item_weighted(spark):
    """Baskets of one and three items: (1 + 9) / 4."""
    df = basic.purchase_flags(
        spark.createDataFrame(
            [(1, 1, 1, 10.0), (2, 1, 1, 10.0), (2, 1, 2, 20.0), (2, 1, 3, 30.0)], BASKETS
        ).withColumn("discount", F.lit(None).cast("int"))
    )
    got = features.shopper_features(df).first()
    assert got["mean_basket_size"] == 2.5
    assert got["mean_basket_value"] == (10 + 3 * 60) / 4
    assert got["no_unique_products"] == 3


def test_weeks_with_offers_only_are_dropped(spark):
    df = basic.purchase_flags(
        spark.createDataFrame(
            [(1, 1, 1, 10.0, None), (1, 1, 2, None, 10), (2, 1, 2, None, 10)],
            BASKETS + ", discount int",
        )
    )
    kept = basic.drop_empty_weeks(df, features.week_shopper_features(df))
    assert rows_of(kept, "week", "product") == [(1, 1), (1, 2)]


def test_pair_counts_rows_and_offers(flagged):
    got = {
        r["product"]: r for r in features.shopper_product_features(flagged).collect()
    }
    assert got[13]["customer_prod_dis_offers"] == 1  # counts rows, also without an offer
    assert got[13]["customer_prod_dis_offers_sum"] == 0
    assert got[12]["no_products_bought_per_product"] is None
    assert got[12]["customer_prod_dis_offered_share"] == 0.0


def test_build_features_contract(spark, flagged):
    base = flagged.withColumns(
        {
            "category_label": F.lit(1),
            "avg_no_weeks_between_two_purchases": F.lit(None).cast("double"),
            "purchase_temporal_distribution": F.lit(None).cast("double"),
            "lag_weeks_of_product_per_customer": F.lit(None).cast("int"),
        }
    )
    # Every product needs one sale: product_sells of a never sold product stays open.
    sold = base.where(F.col("product") < 12)
    table = features.build_features(sold, sold.select("product", "price"), 0, 5)
    assert len(table.columns) == 35
    assert quality.contract_violations(table, features.FEATURE_COLUMNS) == []
    assert len(features.MODEL_FEATURES) == 26
    assert len(features.TARGET_COLUMNS) == 27
    assert all(v is not None for r in table.collect() for v in r)


def test_lags_and_recency(spark):
    """Bought in weeks 3, 7 and 12, offered in 9; another pair never bought."""
    history = spark.createDataFrame(
        [(3, 1, 1, 1), (7, 1, 1, 1), (9, 1, 1, 0), (12, 1, 1, 1), (20, 1, 1, 0),
         (2, 1, 2, 0), (5, 1, 2, 0)],
        "week int, shopper int, product int, product_bought int",
    )
    got = lags.lag_weeks(history, target_week=20)
    assert rows_of(got, "product", "week", "lag_weeks_of_product_per_customer") == [
        (1, 3, -1), (1, 7, 4), (1, 9, 2), (1, 12, 5), (1, 20, 8), (2, 2, -1), (2, 5, -1),
    ]
    assert got.where("week = 20").first()["product_bought"] is None
    recency = lags.pair_recency(got, holdout_week=13).collect()
    assert len(recency) == 1
    assert recency[0]["avg_no_weeks_between_two_purchases"] == pytest.approx((-1 + 4 + 5) / 3)
    assert recency[0]["avg_no_weeks_between_two_purchases_clean"] == 4.5
    assert recency[0]["purchase_temporal_distribution"] == pytest.approx(22 / 3)


def test_lag_matches_a_row_loop(spark):
    import random

    rng = random.Random(5)
    data = sorted(
        {(s, p, w): rng.random() < 0.4 for s in range(4) for p in range(3)
         for w in rng.sample(range(40), 15)}.items()
    )
    history = spark.createDataFrame(
        [(w, s, p, int(b)) for (s, p, w), b in data],
        "week int, shopper int, product int, product_bought int",
    )
    want, last = {}, {}
    for (s, p, w), bought in data:
        want[s, p, w] = w - last[s, p] if (s, p) in last else -1
        if bought:
            last[s, p] = w
    got = lags.lag_weeks(history, 99).collect()
    assert {
        (r["shopper"], r["product"], r["week"]): r["lag_weeks_of_product_per_customer"]
        for r in got
    } == want


def test_negative_samples_fill_up_to_the_basket_size(spark):
    prefs = spark.createDataFrame(
        [(1, 1), (1, 2), (1, 3), (2, 1)], "shopper bigint, product int"
    )
    baskets = spark.createDataFrame(
        [(1, 1, 1, 1.0), (1, 1, 4, 1.0),  # prefers 1 2 3, holds 1 4: two of {2, 3}
         (2, 1, 1, 1.0), (2, 1, 2, 1.0), (2, 1, 3, 1.0),  # holds all: none
         (3, 1, 9, 1.0),  # one item: one of {1, 2, 3}
         (1, 2, 7, 1.0), (1, 2, 8, 1.0), (1, 2, 9, 1.0)],  # larger than its preferences
        BASKETS,
    )
    got = sampling.negative_samples(baskets, prefs)
    by = {}
    for r in got.collect():
        by.setdefault((r["week"], r["shopper"]), set()).add(r["product"])
    assert by[1, 1] == {2, 3}
    assert (2, 1) not in by
    assert len(by[3, 1]) == 1 and by[3, 1] <= {1, 2, 3}
    assert by[1, 2] == {1}
    assert rows_of(got, "week", "shopper", "product") == rows_of(
        sampling.negative_samples(baskets.orderBy(F.rand(3)), prefs), "week", "shopper", "product"
    )


def test_negatives_by_rank_against_a_row_loop(spark):
    rng = np.random.default_rng(4)
    rows = [(int(w), int(s), int(p), 1.0) for w, s, p in rng.integers([0, 0, 0], [3, 6, 60], (400, 3))]
    rows += [(0, 9, p, 1.0) for p in range(0, 60, 2)] + [(5, 1, 7, 1.0), (5, 2, 9000, 1.0), (5, 2, 10, 1.0)]
    rows += [(None, 1, 4, 1.0), (1, 1, None, 1.0), (1, 1, 777, 1.0)]
    label = {p: p % 3 for p in range(60)} | {9000: 1}
    df = spark.createDataFrame(rows, BASKETS)
    cats = spark.createDataFrame(list(label.items()), "product int, category_label int")
    sold, held, seen, want = {}, {}, {}, []
    for w, s, p, _ in rows:
        if w is not None and p in label:
            sold.setdefault((w, label[p]), set()).add(p)
            held.setdefault((w, s), set()).add(p)
    for w, s, p, _ in rows:
        if w is None or p not in label:
            continue
        copy = seen[w, s, p] = seen.get((w, s, p), 0) + 1
        free = sorted(sold[w, label[p]] - held[w, s])
        if free:
            digest = hashlib.md5(f"42-{w}-{s}-{p}-{copy}".encode()).hexdigest()
            want.append((w, s, label[p], p, free[int(digest[:12], 16) % len(free)]))
    got = sampling.negatives_by_rank(df, cats)
    keys = ("week", "shopper", "category_label", "bought_product", "product")
    assert rows_of(got, *keys) == sorted(want) and len(set(want)) > 200
    assert sampling.negatives_by_rank(df.where("false"), cats).count() == 0


def test_negatives_by_rank_are_even(spark):
    """One shopper holds half of a category of 8: each of the other four is drawn as often."""
    rows = [(w, s, p, 1.0) for w in range(40) for s, p in [(1, q) for q in (0, 2, 3, 7)] * 5 + [(2, q) for q in range(8)]]
    cats = spark.createDataFrame([(p, 1) for p in range(8)], "product int, category_label int")
    got = sampling.negatives_by_rank(spark.createDataFrame(rows, BASKETS), cats).groupBy("shopper", "product").count()
    n = {(r.shopper, r["product"]): r["count"] for r in got.collect()}
    assert set(n) == {(1, p) for p in (1, 4, 5, 6)} and sum(n.values()) == 800
    assert all(150 < c < 250 for c in n.values())


def test_top_coupons_break_ties_by_product(spark):
    scored = spark.createDataFrame(
        [(90, 1, p, d, v) for p in range(7) for d, v in ((15, 5.0), (20, 5.0), (25, 4.0))],
        "week int, shopper int, product int, discount int, e_revenue double",
    )
    got = coupons.assign_coupons(scored)
    assert rows_of(got, "coupon", "product", "discount") == [(i, i, 15) for i in range(5)]


def test_heuristic_slots_and_ties(spark):
    shares = spark.createDataFrame(
        [(1, 4, 0.5), (1, 2, 0.5), (1, 9, 1.0), (2, 1, 0.0)],
        "shopper int, product int, dis_prod_share double",
    )
    got = coupons.heuristic_coupons(shares, coupons.coupon_slots(shares, 90))
    assert rows_of(got.where("product is not null"), "shopper", "coupon", "product", "discount") == [
        (1, 0, 9, 30), (1, 1, 2, 25), (1, 2, 4, 20), (2, 0, 1, 30),
    ]
    assert got.count() == 10


def test_uplift_prefers_discounts_that_pay(spark):
    found = spark.createDataFrame(
        [(90, 1, 1, 1, 1.0, 10, 100.0), (90, 1, 2, 1, 0.0, 10, 100.0)],
        "week int, shopper int, product int, n_bought bigint, coupon_share double, "
        "n_weeks bigint, max_price double",
    )
    best = {r["product"]: r for r in coupons.assign_coupons(coupons.uplift(found), "uplift").collect()}
    assert best[1]["discount"] == 30 and best[1]["uplift"] > 0
    assert best[2]["discount"] == 15 and best[2]["uplift"] < 0


def test_fill_prices(spark):
    prices = spark.createDataFrame(
        [(2, 1, 5.0), (4, 1, 7.0)], "week int, product int, modal_price double"
    )
    got = rows_of(series.fill_prices(prices, 0, 5), "week", "filled_price")
    assert got == [(0, 5.0), (1, 5.0), (2, 5.0), (3, 5.0), (4, 7.0), (5, 7.0)]


def test_modal_price_tie_takes_the_lower(spark):
    sales = spark.createDataFrame(
        [(1, 1, 1, 9.0), (1, 2, 1, 8.0), (2, 1, 1, 9.0), (2, 2, 1, 9.0), (2, 3, 1, 1.0)], BASKETS
    )
    assert rows_of(series.modal_price(sales), "week", "modal_price") == [(1, 8.0), (2, 9.0)]


def test_rolling_and_expanding(spark):
    df = spark.createDataFrame([(1, w, float(w)) for w in range(1, 9)], "k int, w int, v double")
    roll = [r["rolling_mean"] for r in series.rolling_mean(df, ["k"], "w", "v", 7).orderBy("w").collect()]
    assert roll == [None] * 6 + [4.0, 5.0]
    grow = [r["expanding_mean"] for r in series.expanding_mean(df, ["k"], "w", "v", 2).orderBy("w").collect()]
    assert grow[:3] == [None, 1.5, 2.0]


def test_overlay_keeps_master_values(spark):
    master = spark.createDataFrame([(1, 1.0, 5), (2, 2.0, 6)], "k int, a double, b int")
    update = spark.createDataFrame([(1, None, 9), (3, 3.0, 3)], "k int, a double, b int")
    assert rows_of(basic.overlay(master, update, ["k"], ["a", "b"]), "k", "a", "b") == [
        (1, 1.0, 9), (2, 2.0, 6),
    ]


def test_pair_grid_counts_without_the_grid(spark):
    rows = [
        (0, 1, 10, 1.0), (0, 1, 10, None), (0, 1, 10, 2.0), (0, 2, 10, 3.0), (2, 1, 10, None), (1, 1, 11, 4.0),
        (9, 3, 12, 5.0), (None, 3, 10, 6.0), (1, None, 10, 7.0), (1, 4, None, 8.0), (1, 4, None, 8.0), (2, None, None, 9.0),
    ]
    baskets = spark.createDataFrame(rows, BASKETS)
    grid = basic.calendar(baskets, ["shopper", "product"], 0, 2).join(baskets, basic.KEY, "left")
    want = grid.groupBy("week", "product").agg(F.count(F.lit(1)).alias("pairs"), F.count("price").alias("bought"))
    got = basic.pair_grid_counts(baskets, 0, 2)
    assert got.dtypes == want.dtypes
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    # one row per product is expanded, not one per pair
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate explode" in line)
    assert "shopper" not in generate and "Join" in plan


def folder(spark, path, lines, orders, parts):
    """Hand-made input tables: (order, part, discount, flag), (order, customer, date), (part, brand, price)."""
    line = "l_orderkey bigint, l_partkey bigint, l_discount double, l_returnflag string"
    spark.createDataFrame(lines, line).write.parquet(f"{path}/lineitem.parquet")
    placed = spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, d string")
    placed.withColumn("o_orderdate", F.col("d").cast("timestamp_ntz")).drop("d").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame(parts, "p_partkey bigint, p_brand string, p_retailprice double").write.parquet(f"{path}/part.parquet")


def test_purchases_meet_their_offers_in_one_pass(spark, tmp_path):
    lines = [
        (o, p, x, f)
        for o in (1, 2, 3, 4, None)
        for p in (1, 2, 3, 4, 5, None)
        for x, f in [((o or 0) % 3 * 0.04, "RNA"[(p or 0) % 3]), (0.0, "N" if p == 2 else "R"), (None, None)]
    ] * 2
    dated = [(1, 7, "1995-01-03"), (2, 7, "1995-01-20"), (3, 8, "1995-02-03"), (4, None, "1996-01-01"), (4, 9, None)]
    parts = [(1, "Brand#1", 9.0), (2, "Brand#1", 8.0), (3, None, 7.0), (4, "Brand#4", None), (5, "Brand#5", 6.0)]
    folder(spark, str(tmp_path), lines, dated, parts)
    flow = Flow(spark, str(tmp_path))
    columns = ["week", "shopper", "product", "price", "discount"]
    want = flow.baskets.join(flow.coupons, basic.KEY, "left").select(*columns).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(flow.bought.select(*columns).collect(), key=key) == sorted(want, key=key) and len(want) > 6
    for name in ("heuristic_features", "heuristic_filtered"):
        plan = PLANS[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("l_returnflag") and plan.count("Relation [l_orderkey") == 1, name


def _shuffles_of_rows(df) -> int:
    """Shuffles in the plan of a table, without adaptive changes."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[0].count("Exchange hashpartitioning")


def _odd_offers(spark):
    """Offers with open keys; 30 shoppers, 9 products, some bought three times and more."""
    rows = []
    for s in [*range(30), None]:
        for w in [*range(8), None]:
            for p in [*range(9), None]:
                h = hash((s or 91, w or 37, p or 53)) % 11
                if h < 8:
                    rows.append((w, s, p, 1.5 + h if h < 5 else None, 4 * h if h in (1, 3, 6, 7) else None))
    kept = [r for r in rows if r[3] is not None or r[4] is not None]
    return spark.createDataFrame(kept, "week int, shopper bigint, product int, price double, discount int").repartition(5)


def test_negatives_join_the_offers_in_one_shuffle(spark):
    from collections import Counter

    offers = _odd_offers(spark)
    bought = offers.where("price is not null").drop("discount")
    prefs = sampling.preferences(bought, 7)
    apart = basic.merge_samples(offers, sampling.negative_samples(bought, prefs))
    together = sampling.with_negatives(offers, prefs)
    columns = ["week", "shopper", "product", "price", "discount"]
    want, got = (Counter(map(tuple, df.select(columns).collect())) for df in (apart, together))
    assert want == got and sum(want.values()) > offers.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _shuffles_of_rows(together) < _shuffles_of_rows(apart)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_features_from_windows_equal_those_from_joins(spark):
    offers = _odd_offers(spark)
    base = basic.purchase_flags(offers).withColumns(
        {"category_label": F.col("product") % 3}
        | {c: F.col("price") for c in ("avg_no_weeks_between_two_purchases", "purchase_temporal_distribution")}
        | {"lag_weeks_of_product_per_customer": F.lit(1)}
    )
    baskets = offers.where("price is not null").drop("discount")
    got = features.build_features(base, baskets, 1, 6)

    rows = basic.between_weeks(base, 1, 6)
    weekly = features.week_shopper_features(rows)
    priced = basic.impute_price(rows, features.product_features(rows))
    kept = basic.impute_nulls(basic.drop_empty_weeks(priced, weekly))
    want = features._attach_grains(kept, rows, weekly, baskets).select(*features.FEATURE_COLUMNS)
    tell = lambda r: tuple(round(v, 6) if isinstance(v, float) else v for v in r)
    a, b = (sorted(map(tell, df.collect()), key=repr) for df in (want, got))
    assert a == b and a
    assert [f.dataType for f in want.schema] == [f.dataType for f in got.schema]
    # the rows are shuffled once, by shopper; products are grouped beside them
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _shuffles_of_rows(features.build_features(base, baskets, 1, 6)) <= 3
        few = features.priced_rows(base, 1, 6)
        assert _shuffles_of_rows(few) <= 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    names = ["week", "shopper", "product", "price", "discount", "product_bought"]
    assert sorted(map(tell, few.select(names).collect()), key=repr) == sorted(map(tell, want.select(names).collect()), key=repr)


def test_distinct_flags_are_counted_on_grouped_rows(spark):
    rows = [(1, 1, 0, 0, 1, None, 3.0), (1, 0, 0, 1, 1, None, None), (2, 1, 0, None, 1, None, 1.0), (None, 1, 0, 1, 0, None, 1.0)]
    df = spark.createDataFrame(rows, "shopper int, " + ", ".join(f"{c} int" for c in quality.FLAGS) + ", x double")
    checks = quality.feature_checks(df, F.lit(2))
    got = {r.check_name: (r.observed, r.passed) for r in checks.collect()}
    assert got["shoppers"] == (2.0, 1) and got["nulls"] == (4.0, 0)
    assert [got[f"{c}_values"][0] for c in quality.FLAGS] == [2.0, 1.0, 2.0, 2.0, 0.0]
    empty = {r.check_name: r.observed for r in quality.feature_checks(df.where("false"), F.lit(0)).collect()}
    assert set(empty.values()) == {0.0}
    plan = quality.feature_checks(df, F.lit(2))._jdf.queryExecution().executedPlan().toString()
    assert "Expand" in plan and "_nulls" in plan.split("Expand")[1]
