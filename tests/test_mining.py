"""Co-occurrence, rules, metrics, silhouette and splits against brute force."""

import itertools
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.operators import baskets, metrics, splits, vectors


@pytest.fixture(scope="module")
def lines(spark):
    """Repeated lines, many small orders and one order with 1,500 items."""
    rng = random.Random(1)
    rows = [(o, rng.randrange(40)) for o in range(60) for _ in range(rng.randrange(1, 6))]
    rows += [(999, i) for i in range(1500)]
    return spark.createDataFrame(rows, "o bigint, i bigint")


def brute(rows):
    held = {}
    for o, i in rows:
        held.setdefault(o, set()).add(i)
    counts = {}
    for items in held.values():
        for pair in itertools.permutations(items, 2):
            counts[pair] = counts.get(pair, 0) + 1
    return counts


def test_cooccurrence_both_ways(lines):
    want = brute([tuple(r) for r in lines.collect()])
    mixed = baskets.cooccurrence(lines, "o", "i")  # the large order has many tiles
    assert {(r[0], r[1]): r[2] for r in mixed.collect()} == want
    few = lines.where("i < 60")
    tiles_only = baskets.cooccurrence(few, "o", "i", tile=3)
    assert {(r[0], r[1]): r[2] for r in tiles_only.collect()} == brute(
        [tuple(r) for r in few.collect()]
    )


def test_pair_counts_of_long_baskets(spark):
    """Baskets of 13 and of 2,000 items go the same way; support cuts pairs."""
    rows = [(1, f"i{k:04d}") for k in range(13)] + [(2, f"i{k:04d}") for k in range(2000)]
    found = baskets.pair_counts(spark.createDataFrame(rows, "b int, i string"), "b", "i")
    assert found.count() == 2000 * 1999 // 2
    both = found.where("n = 2").collect()
    assert {(r.item_a, r.item_b) for r in both} == set(
        itertools.combinations([f"i{k:04d}" for k in range(13)], 2)
    )
    none = spark.createDataFrame([], "b int, i string")
    assert baskets.pair_counts(none, "b", "i").count() == 0


def test_crosstab_loses_no_value(spark):
    df = spark.createDataFrame([(1, 0), (1, 7)], "s int, product int")
    assert [tuple(r) for r in baskets.crosstab(df, "s", "product", [0, 7]).collect()] == [(1, 1, 1)]
    with pytest.raises(Exception, match="no column for product 7"):
        baskets.crosstab(df, "s", "product", [0, 1]).collect()


def test_itemsets_and_rules(spark):
    data = [[1, 2], [1, 2, 3], [1], [2, 3]]
    rows = [(b, i) for b, items in enumerate(data) for i in items] + [(0, 1)]
    lines = spark.createDataFrame(rows, "b int, i int")
    found = baskets.frequent_itemsets(lines, "b", "i", 0.5).collect()
    sets = {tuple(r["items"]): r["freq"] for r in found}
    assert sets == {(1,): 3, (2,): 3, (3,): 2, (1, 2): 2, (2, 3): 2}
    rules = {
        (r["antecedent"], r["consequent"]): (r["support"], r["confidence"], r["lift"])
        for r in baskets.association_rules(lines, "b", "i", 0.5).collect()
    }
    assert rules[3, 2] == pytest.approx((0.5, 1.0, 4 / 3))
    assert rules[1, 2][2] == pytest.approx(8 / 9)
    lists = spark.createDataFrame([(d,) for d in data], "products array<int>")
    mined = baskets.mine_itemsets(lists, 0.5).freqItemsets.collect()
    assert {tuple(sorted(r["items"])): r["freq"] for r in mined} == sets


def test_auc_with_ties(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(2), round(rng.random(), 1)) for _ in range(300)]
    scores = spark.createDataFrame(rows, "y int, p double")
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    assert metrics.auc_exact(scores).first()[0] == pytest.approx(wins / len(pos) / len(neg))
    assert metrics.auc_exact(scores, blocks=1).first()[0] == pytest.approx(
        wins / len(pos) / len(neg)
    )


def test_auc_of_crowded_scores(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(2), rng.random() / 5000) for _ in range(400)]
    wins = [a > b for y, a in rows if y for z, b in rows if not z]
    scores = spark.createDataFrame(rows, "y int, p double")
    assert metrics.auc_exact(scores, blocks=5).first()[0] == pytest.approx(np.mean(wins))


def test_threshold_is_inclusive(spark):
    scores = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.4), (0, 0.1)], "y int, p double")
    c = metrics.confusion(scores).first()
    assert (c["tp"], c["fp"], c["tn"], c["fn"]) == (1, 1, 1, 1)


def test_log_loss_clamps(spark):
    scores = spark.createDataFrame([(1, 1.0), (0, 0.0)], "y int, p double")
    assert metrics.log_loss(scores).first()["log_loss"] == pytest.approx(0.0, abs=1e-12)


def test_r2_of_a_perfect_fit(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (4.0, 4.0)], "y double, f double")
    r = metrics.r2_score(df, "y", "f").first()
    assert (r[0], r[1]) == pytest.approx((1.0, 1.0))


@pytest.mark.parametrize("centroid", [False, True])
def test_silhouette_against_all_pairs(spark, centroid):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 4)) + np.repeat(np.arange(5), 12)[:, None]
    label = np.repeat(np.arange(5), 12)
    label[0] = 7  # a cluster of one point scores 0
    d2 = ((x[:, None] - x[None]) ** 2).sum(-1)
    want = []
    for i in range(60):
        own = label == label[i]
        if own.sum() == 1:
            want.append(0.0)
            continue
        a = d2[i][own].sum() / (own.sum() - 1)
        others = [k for k in set(label.tolist()) if k != label[i]]
        if centroid:
            b = min(((x[i] - x[label == k].mean(0)) ** 2).sum() for k in others)
        else:
            b = min(d2[i][label == k].mean() for k in others)
        want.append((b - a) / max(a, b))
    df = spark.createDataFrame(
        [(i, x[i].tolist(), int(label[i])) for i in range(60)], "id int, v array<double>, label int"
    )
    got = vectors.silhouette(df, "id", "v", "label", centroid).orderBy("id").collect()
    assert [r["silhouette"] for r in got] == pytest.approx(want)


def test_most_similar(spark):
    df = spark.createDataFrame(
        [(0, [1.0, 0.0]), (1, [2.0, 0.1]), (2, [0.0, 1.0]), (3, [-1.0, 0.0])],
        "id int, v array<double>",
    )
    got = [r["id"] for r in vectors.most_similar(df, "id", "v", 0, 2).collect()]
    assert got == [1, 2]


@pytest.fixture(scope="module")
def panel(spark):
    return spark.range(103).select(
        (F.col("id") % 10).cast("int").alias("week"), (F.col("id") % 7).alias("shopper"),
        F.col("id").cast("int").alias("product"),
    )


def test_timeseries_folds(panel):
    got = splits.split_timeseries(panel).orderBy("week", "shopper", "product").collect()
    folds = [r["test_fold"] for r in got]
    size = 103 // 6
    assert folds == [0] * (103 - 5 * size) + [k for k in range(1, 6) for _ in range(size)]


def test_ratio_split(panel):
    got = splits.split_ratio(panel).where("split = 'train'")
    assert got.count() == int(103 * 0.66)


def test_walk_forward(panel):
    got = splits.walk_forward(panel).orderBy("fold").collect()
    assert len(got) == 7
    assert (got[0]["n_train"], got[0]["test_week"]) == (33, 3)
    assert got[-1]["n_train"] + got[-1]["n_test"] == 103


def test_hash_splits_are_stable(spark):
    df = spark.range(4000).withColumn("label", (F.col("id") % 2).cast("int"))
    got = splits.split_stratified(df, "id", "label", 0.2, seed=1)
    shares = got.groupBy("label").agg(F.avg((F.col("split") == "test").cast("int")).alias("s"))
    assert all(abs(r["s"] - 0.2) < 0.03 for r in shares.collect())
    again = splits.split_stratified(df.repartition(7), "id", "label", 0.2, seed=1)
    assert got.exceptAll(again).isEmpty()


def test_rounding_goes_by_the_binary_value(spark):
    from tillroll.plans.registry import half_up

    # the double nearest to 2.0578125 lies below it, and so does a million times it
    values = [2.0578125, 0.5, 0.0000005, 37 / 640, 1.25, 0.0]
    got = half_up(spark.createDataFrame([(v,) for v in values], "x double")).collect()
    con = duckdb.connect()
    want = con.execute("SELECT round(x, 6) FROM (SELECT unnest(?::DOUBLE[]) AS x)", [values]).fetchall()
    assert [r["x"] for r in got] == [w[0] for w in want]


def test_cooccurrence_deals_its_pairs_by_the_size_of_the_table(spark, monkeypatch):
    """Tasks grow in number with the pairs, not in size, and the pairs stay the same."""
    rows = [(o, (o * 7 + k * k) % 97) for o in range(120) for k in range(o % 9)] + [(None, 3), (None, 4), (5, 400), (5, 400)]
    lines = spark.createDataFrame(rows, "o int, i int").repartition(3)
    sets = {}
    for o, i in rows:
        if o is not None:
            sets.setdefault(o, set()).add(i)
    want = {}
    for held in sets.values():
        for a in held:
            for b in held - {a}:
                want[a, b] = want.get((a, b), 0) + 1
    for a_part, few_items in ((1 << 20, False), (30, False), (30, True)):
        monkeypatch.setattr(baskets, "PAIRS_A_PART", a_part)
        parts, apart = baskets.pair_parts(lines, "o", "i")
        assert apart and (parts == 1) == (a_part > 30)
        pairs = baskets.pair_counts(lines, "o", "i", parts=parts, apart=not few_items)
        got = {(r.item_a, r.item_b): r.n for r in pairs.collect()}
        assert got == {p: n for p, n in want.items() if p[0] < p[1]}
        both = baskets.cooccurrence(lines, "o", "i")
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f", {parts}), REPARTITION_BY_NUM") == (0 if parts == 1 else 4)
        assert {(r.item_a, r.item_b): r.n for r in both.collect()} == want
    one = spark.createDataFrame([(1, 1), (1, 2)] * 500, "o int, i int")
    assert not baskets.pair_parts(one, "o", "i")[1]
