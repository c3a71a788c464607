"""The histogram booster against brute force, its encodings, and the model registry."""

import itertools
import os
import threading
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.ml import booster, histboost, products, returns
from tillroll.ml.histboost import Settings
from tillroll.operators import encoding, itemsets
from tillroll.plans import PLANS
from tillroll.plans import models as plans
from tillroll.plans.flow import Flow
from tillroll.sources import models, workspace

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["a", "b", "c", "k"]


def rows(n, seed=1):
    rng = np.random.default_rng(seed)
    x, k = rng.normal(size=(n, 3)).round(2), rng.integers(0, 9, n)
    z = 2 * x[:, 0] + np.sin(3 * x[:, 1]) + np.where(k % 2, 1.5, -1.5)
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    return [(i, *(None if i % 11 == 3 and j == 1 else float(v) for j, v in enumerate(r)), f"l{c}", int(t)) for i, (r, c, t) in enumerate(zip(x, k, y))]


SCHEMA = "id long, a double, b double, c double, k string, y int"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(1000), SCHEMA).repartition(3)


def brute_tree(x, g, h, s):
    """Best leaf first; every split of every feature is tried on the rows themselves. Numbers
    split between neighbours (None lowest), nominal columns along the order of mean gradients."""

    def score(at):
        return g[at].sum() ** 2 / (h[at].sum() + s.l2 + 1e-12)

    def best(at):
        found = (1e-12, None)
        for f in range(len(x)):
            if x[f].dtype == object:
                levels = {v: at[x[f][at] == v] for v in set(x[f][at])}
                order = sorted(levels, key=lambda v: g[levels[v]].sum() / (h[levels[v]].sum() + 1.0))
                cuts = [np.isin(x[f][at], order[:i]) for i in range(1, len(order))]
            else:
                cuts = [~(x[f][at] > v) for v in np.unique(x[f][at][~np.isnan(x[f][at])])]
                cuts.append(np.isnan(x[f][at]))
            for left in cuts:
                a, b = at[left], at[~left]
                if min(len(a), len(b)) < s.min_rows:
                    continue
                gain = score(a) + score(b) - score(at)
                if gain > found[0] * (1 + 1e-9):
                    found = (gain, (a, b))
        return found

    leaves = [(*best(np.arange(len(g))), np.arange(len(g)))]
    while len(leaves) < s.leaves:
        i = max(range(len(leaves)), key=lambda i: leaves[i][0])
        if leaves[i][1] is None:
            break
        _, (a, b), _ = leaves.pop(i)
        leaves += [(*best(a), a), (*best(b), b)]
    out = np.zeros(len(g))
    for _, _, at in leaves:
        out[at] = -s.learning_rate * g[at].sum() / (h[at].sum() + s.l2 + 1e-12)
    return out


@pytest.mark.parametrize("local_rows", [histboost.LOCAL_ROWS, 150])
def test_trees_are_those_of_brute_force(spark, table, local_rows):
    s = Settings(trees=3, leaves=12, learning_rate=0.3, subsample=1.0, min_rows=15, local_rows=local_rows, max_bins=255)
    m = histboost.fit(table, NAMES, "y", nominal=["k"], key=["id"], settings=s)
    got = histboost.predict(m, table, ["id"]).toPandas().sort_values("id").proba.to_numpy()
    data = sorted(table.collect())
    # a column with more values than bins is cut at the edges of its bins only
    x = [np.array([np.nan if r[c] is None else float(np.searchsorted(m.binning.edges[c], r[c])) for r in data]) for c in NAMES[:3]]
    x.append(np.array([r.k for r in data], object))
    y = np.array([r.y for r in data], float)
    z = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(3):
        p = 1 / (1 + np.exp(-z))
        z += brute_tree(x, p - y, p * (1 - p), s)
    assert [len(t.feature) for t in m.trees] == [23] * 3
    assert got == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)


@pytest.mark.parametrize("s", [
    Settings(trees=4, leaves=25, learning_rate=0.3, min_rows=5),
    Settings(trees=4, leaves=64, depth=4, learning_rate=0.3, min_rows=1, column_share=0.5, l1=0.1),
    Settings(trees=4, depth=4, symmetric=True, learning_rate=0.3, column_share=0.7),
])
def test_one_task_or_many_give_the_same_trees(table, monkeypatch, s):
    monkeypatch.setattr(histboost, "ROUNDS", 3)
    nominal = [] if s.symmetric else ["k"]
    names = NAMES[:3] if s.symmetric else NAMES
    near, far = (
        histboost.fit(table, names, "y", nominal=nominal, key=["id"], settings=replace(s, local_rows=n)) for n in (10_000, 120)
    )
    a, b = (histboost.predict(m, table, ["id"]).toPandas().sort_values("id").proba.to_numpy() for m in (near, far))
    assert a == pytest.approx(b, abs=1e-9)
    if s.symmetric:
        for t in near.trees:
            assert len(t.feature) == 31 and len({f for f in t.feature if f >= 0}) <= 4


def test_large_tables_take_few_passes(spark, table, monkeypatch):
    monkeypatch.setattr(histboost, "RESCORED", 2)
    subtrees, routed, grown, behind = histboost._subtrees, histboost._routed, [], []
    monkeypatch.setattr(histboost, "_subtrees", lambda state, m, *a: grown.append(len(m.trees)) or subtrees(state, m, *a))
    monkeypatch.setattr(histboost, "_routed", lambda state, m, since, *a: behind.append(len(m.trees) - since) or routed(state, m, since, *a))
    s = Settings(trees=6, leaves=64, learning_rate=0.3, min_rows=1, local_rows=120)
    m = histboost.fit(table, NAMES, "y", nominal=["k"], key=["id"], settings=s)
    near = histboost.fit(table, NAMES, "y", nominal=["k"], key=["id"], settings=replace(s, local_rows=10_000))
    assert [t.feature.tolist() for t in m.trees] == [t.feature.tolist() for t in near.trees]
    assert sorted(grown) == list(range(6)) and max(behind) < 2


def test_histograms_and_leaves_of_many_rows(table):
    rng = np.random.default_rng(4)
    binning = histboost.Binning(["a", "b"], {"a": [float(i) for i in range(200)], "b": [0.0]}, {})
    bins = np.column_stack([rng.integers(0, 202, 5000), rng.integers(0, 3, 5000)]).astype(np.uint8)
    g, h = rng.normal(size=5000), rng.random(5000)
    search = histboost.Search(binning, Settings(min_rows=5))
    parts = sum(search.histogram(bins[i : i + 500], g[i : i + 500], h[i : i + 500]) for i in range(0, 5000, 500))
    assert np.allclose(search.histogram(bins, g, h), parts)
    grown = histboost.grow(search, search.s, bins, g, h, None)
    tree = grown.tree(grown.walk(search.s)[0], search.s)
    want = []
    for row in bins[:300]:
        node = 0
        while (f := tree.feature[node]) >= 0:
            left = np.unpackbits(tree.left[node])[row[f]]
            node = tree.children[node, 0 if left else 1]
        want.append(node)
    assert tree.leaf(bins)[:300].tolist() == want and len(set(want)) > 50


def test_the_tree_before_saves_passes(table, monkeypatch):
    """Where a tree is cut like the one before, its top needs one pass and its subtrees another."""
    passes, histograms = [], histboost._histograms
    monkeypatch.setattr(histboost, "_histograms", lambda state, m, *a: passes.append(len(m.trees)) or histograms(state, m, *a))
    s = Settings(trees=4, leaves=64, learning_rate=1e-6, subsample=1.0, min_rows=5, local_rows=120)
    histboost.fit(table, NAMES, "y", nominal=["k"], key=["id"], settings=s)
    assert passes.count(0) > 2 and [passes.count(t) for t in (1, 2, 3)] == [1, 1, 1]


def test_splits_below_the_least_gain_wait(spark, table, monkeypatch):
    """A subtree that was cut short grows on where the tree needs it."""
    s = Settings(trees=3, leaves=20, learning_rate=0.3, min_rows=2, local_rows=120)
    want = histboost.fit(table, NAMES, "y", nominal=["k"], key=["id"], settings=replace(s, local_rows=10_000))
    for least in (0.0, 0.25, 50.0):
        found, subtrees = [], histboost._subtrees
        monkeypatch.setattr(histboost, "LEAST", least)
        monkeypatch.setattr(histboost, "_subtrees", lambda *a: found.append(subtrees(*a)) or found[-1])
        m = histboost.fit(table, NAMES, "y", nominal=["k"], key=["id"], settings=s)
        monkeypatch.setattr(histboost, "_subtrees", subtrees)
        assert [t.feature.tolist() for t in m.trees] == [t.feature.tolist() for t in want.trees]
        assert (len(found) == 3) == (least < 1)


def test_a_level_is_cut_like_leaf_by_leaf(monkeypatch):
    rng = np.random.default_rng(6)
    binning = histboost.Binning(["a", "b", "c"], {c: [float(i) for i in range(40)] for c in "abc"}, {})
    bins = rng.integers(0, 42, (4000, 3)).astype(np.uint8)
    g, h = rng.normal(size=4000) + (bins[:, 0] > 20), 0.1 + rng.random(4000)
    free, capped = Settings(leaves=64, depth=6, min_rows=7, min_hessian=4.0), Settings(leaves=63, depth=6, min_rows=7, min_hessian=4.0)
    for columns, many in itertools.product((None, np.array([0, 2])), (1 << 22, 300)):
        monkeypatch.setattr(histboost, "MANY_CELLS", many)
        grown = histboost.grow(histboost.Search(binning, free), free, bins, g, h, columns)
        level = grown.tree(grown.walk(free)[0], free)
        leaves = histboost.grow(histboost.Search(binning, capped), capped, bins, g, h, columns)
        leaf = leaves.tree(leaves.walk(capped)[0], capped)
        assert len(level.feature) > 40 and level.feature.tolist() == leaf.feature.tolist()
        assert (level.left == leaf.left).all() and level.value == pytest.approx(leaf.value)
        assert columns is None or 1 not in level.feature


def test_symmetric_trees_are_scored_by_level():
    rng = np.random.default_rng(8)
    binning = histboost.Binning(["a", "b"], {c: [float(i) for i in range(40)] for c in "ab"}, {})
    bins = rng.integers(0, 42, (3000, 2)).astype(np.uint8)
    g, h, s = rng.normal(size=3000), rng.random(3000), Settings(depth=5, symmetric=True)
    search = histboost.Search(binning, s)
    grown = histboost.grow_symmetric(search, s, bins, g, h, None)
    tree = grown.tree(grown.walk(s)[0], s)
    assert len(tree.feature) == 63 and (tree.score_even(bins) == tree.score(bins)).all()
    for node in np.flatnonzero(tree.feature < 0):
        at = tree.leaf(bins) == node
        assert tree.value[node] == pytest.approx(-s.learning_rate * g[at].sum() / (h[at].sum() + s.l2), abs=1e-9)


def test_columns_counted_together():
    rng = np.random.default_rng(7)
    binning = histboost.Binning(["a", "b", "c", "d"], {"a": [1.0] * 3, "b": [1.0] * 7, "c": [1.0] * 250, "d": [1.0]}, {})
    bins = np.column_stack([rng.integers(0, n, 6000) for n in binning.sizes]).astype(np.uint8)
    g, h, place = rng.normal(size=6000), rng.random(6000), rng.integers(0, 3, 6000)
    for columns in (None, np.array([1, 3])):
        search = histboost.Search(binning, Settings(), columns)
        got = search.histograms(bins, g, h, place, 3)
        for node in range(3):
            for start, f in zip(search.start, search.columns):
                for value in range(binning.sizes[f]):
                    at = (place == node) & (bins[:, f] == value)
                    assert got[node, :, start + value] == pytest.approx([g[at].sum(), h[at].sum(), at.sum()])


def test_customers_are_grown_in_one_task(table, monkeypatch):
    """Two million customers fit a task, so no tree over fewer takes a job for each level."""
    asked = []
    monkeypatch.setattr(histboost, "fit", lambda *a, settings, **k: asked.append(settings))
    returns.fit_boosted(table), returns.fit_symmetric(table)
    assert [(s.local_rows, s.trees, s.depth) for s in asked] == [(1 << 21, 500, 13), (1 << 21, 2000, 9)]


def test_stops_on_the_evaluation_rows(spark, table):
    noise = spark.createDataFrame(rows(400, seed=9), SCHEMA).withColumn("y", F.col("id").cast("int") % 2)
    s = Settings(trees=60, leaves=8, learning_rate=0.5, stopping=5, min_rows=5)
    for n in (10_000, 300):
        m = histboost.fit(table, NAMES, "y", nominal=["k"], evaluation=noise, key=["id"], settings=replace(s, local_rows=n))
        assert len(m.trees) == int(np.argmin(m.losses)) + 1 < 10 and len(m.losses) == len(m.trees) + 5


def test_saved_model_and_odd_rows(spark, table, tmp_path):
    s = Settings(trees=3, leaves=6, min_rows=5)
    m = histboost.fit(table.withColumn("w", F.lit(2.0)), NAMES, "y", nominal=["k"], weight="w", settings=s)
    again = histboost.load(spark, histboost.save(m, spark, f"{tmp_path}/m"))
    odd = spark.createDataFrame([(1, None, None, float("nan"), None, None), (1, 1e300, -1e300, 0.0, "new", 1)], SCHEMA)
    for df in (table, odd):
        a, b = (histboost.predict(x, df, ["id", "y"]).collect() for x in (m, again))
        assert a == b and all(0 < r.proba < 1 for r in a)
    assert sum(v for _, v in m.importance()) == pytest.approx(1.0)
    none = histboost.fit(table.where("false"), NAMES, "y", settings=s, nominal=["k"])
    assert none.trees == [] and histboost.predict(none, odd, ["id"]).count() == 2
    with pytest.raises(ValueError, match="255 levels"):
        histboost.fit(table.withColumn("k", F.col("id").cast("string")), NAMES, "y", nominal=["k"])


def test_booster_learns_more_than_the_prior(spark):
    got = {r.metric: r.value for r in PLANS["train_gbt"](spark, SF_DIR).collect()}
    assert got["auc"] > 0.9 and got["log_loss"] < 0.6


def test_hit_rates_are_on_the_same_offers(spark):
    both = {r.model: r for r in PLANS["coupon_hit_rate_gbt"](spark, SF_DIR).collect()}
    plain = {r.model: r for r in PLANS["coupon_hit_rate"](spark, SF_DIR).collect()}
    assert both["heuristic"] == plain["heuristic"] and both["booster"].n_hits > 0


def test_symmetric_returns_model(spark):
    got = {r.metric: r.value for r in PLANS["cat_returns_14d"](spark, SF_DIR).collect()}
    assert 0 < got["log_loss"] < 1


# ---- registry ---------------------------------------------------------------------------


def counted(fits):
    def fit(data, evaluation=None, size=3):
        fits.append((data, size))
        return {"data": data, "size": size}

    return fit


def keep(m, spark, path):
    spark.createDataFrame([(m["data"], m["size"])], "data string, size int").write.parquet(path)


def read(spark, path):
    return spark.read.parquet(path).first().asDict()


def test_one_fit_per_data_and_settings(spark):
    fits = []
    fit = counted(fits)
    ask = lambda data, **s: models.fit_once(spark, "m", data, fit, lambda: (data,), keep, read, **s)
    assert ask("one") == ask("one") == ask("one", size=3) == {"data": "one", "size": 3}
    assert ask("two")["data"] == "two" and ask("one", size=4)["size"] == 4
    assert fits == [("one", 3), ("two", 3), ("one", 4)]


def test_two_writers_agree(spark):
    fits, start, out = [], threading.Barrier(2), []
    slow = counted(fits)

    def fit(data):
        start.wait(20)  # both have found nothing
        return slow(data)

    def ask():
        out.append(models.fit_once(spark, "race", "d", fit, lambda: ("d",), keep, read))

    writers = [threading.Thread(target=ask) for _ in range(2)]
    [w.start() for w in writers], [w.join() for w in writers]
    ask()
    assert len(fits) == 2 and out == [{"data": "d", "size": 3}] * 3


def test_an_unfinished_model_is_not_read(spark):
    def broken(m, spark, path):
        keep(m, spark, path)
        raise OSError("disk")

    fits = []
    fit = counted(fits)
    with pytest.raises(OSError):
        models.fit_once(spark, "b", "d", fit, lambda: ("d",), broken, read)
    assert models.fit_once(spark, "b", "d", fit, lambda: ("d",), keep, read)["data"] == "d" and len(fits) == 2


@pytest.mark.parametrize("module, name, asked", [
    (booster, "train_gbt", ["score_scenarios", "assign_coupons_gbt", "feature_importance", "model_roundtrip", "coupon_hit_rate_gbt"]),
    (products, "train_p2v", ["train_p2v", "similar_products", "embed_pca2", "product_categories"]),
])
def test_queries_of_a_folder_share_a_fit(spark, monkeypatch, module, name, asked):
    fits, fit = [], getattr(module, name)

    def quick(data, evaluation=None):
        fits.append(name)
        return fit(data, n_estimators=2, num_leaves=5) if name == "train_gbt" else fit(data, vec_dim=5, epochs=1, min_count=1)

    monkeypatch.setattr(module, name, quick)
    for q in asked:
        PLANS[q](spark, SF_DIR)
    assert fits == [name]
    other = f"{SF_DIR[:-5]}0.01"
    assert plans._data(Flow(spark, SF_DIR)) == plans._data(Flow(spark, SF_DIR)) != plans._data(Flow(spark, other))


# ---- encodings ----------------------------------------------------------------------------


def test_ordered_statistics_equal_a_row_loop(spark, monkeypatch):
    import hashlib

    rng = np.random.default_rng(2)
    data = [(i, None if i % 13 == 0 else "hot" if i % 3 else f"l{i % 5}", None if i % 17 == 0 else int(rng.random() < 0.3)) for i in range(600)]
    df = spark.createDataFrame(data, "id long, level string, y int")
    for digits in (1, 3):
        monkeypatch.setattr(encoding, "SLICE_DIGITS", digits)
        got = {r.id: r.level_mean for r in encoding.ordered_target_statistic(df, "level", "y", ["id"], prior=2.0, seed=5).collect()}
        known = [y for _, _, y in data if y is not None]
        mean, seen = sum(known) / len(known), {}
        for i, level, y in sorted(data, key=lambda r: (hashlib.md5(f"5-{r[0]}".encode()).hexdigest(), r[0])):
            total, n = seen.get(level, (0, 0))
            assert got[i] == pytest.approx((total + 2 * mean) / (n + 2), abs=1e-12)
            if y is not None:
                seen[level] = (total + y, n + 1)
    means = encoding.level_means(df, "level", "y")
    asked = spark.createDataFrame([(1, "hot"), (2, "unknown"), (3, None)], "id int, level string")
    found = {r.id: r.level_mean for r in encoding.apply_level_means(asked, "level", means).collect()}
    assert found[2] == pytest.approx(mean)
    total, n = seen["hot"]
    assert found[1] == pytest.approx((total + mean) / (n + 1)) and found[3] != found[2]


# ---- item sets --------------------------------------------------------------------------------


def test_item_sets_and_rules_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    held = {b: sorted(set(rng.integers(0, 9, rng.integers(1, 7)).tolist()) | ({0, 1, 2} if b % 3 == 0 else set())) for b in range(80)}
    held[80] = list(range(40))  # one long basket
    lines = [(b, i) for b, items in held.items() for i in items] * 2 + [(81, None)]
    df = spark.createDataFrame(lines, "b int, i int")
    sets = itemsets.frequent_sets(df, "b", "i", 0.06, max_size=5)
    least, freq = int(np.ceil(82 * 0.06)), {}
    for items in held.values():
        for k in range(1, 6):
            for s in itertools.combinations(items[:12], k):
                freq[s] = freq.get(s, 0) + 1
    want = {s: n for s, n in freq.items() if n >= least}
    assert {tuple(r["items"]): r.freq for r in sets.collect()} == want and max(map(len, want)) >= 3
    rules = {(tuple(r.antecedent), tuple(r.consequent)): (r.confidence, r.lift) for r in itemsets.set_rules(sets, 4).collect()}
    expected = {}
    for s, n in want.items():
        if 2 <= len(s) <= 4:
            for k in range(1, len(s)):
                for a in itertools.combinations(s, k):
                    c = tuple(x for x in s if x not in a)
                    expected[a, c] = (n / want[a], n * 82 / (want[a] * want[c]))
    assert rules.keys() == expected.keys()
    assert all(rules[k] == pytest.approx(expected[k]) for k in rules)
    assert itemsets.frequent_sets(df.where("false"), "b", "i", 0.1).count() == 0


def test_equal_baskets_are_expanded_once(spark):
    held = [(b, i) for b in range(60) for i in ((1, 2, 3) if b % 2 else (2, 4))] + [(None, 1)]
    df = spark.createDataFrame(held, "basket int, item int")
    rows = [(r.basket is None, r["item"], r.n) for r in itemsets.equal_baskets(df).collect()]
    assert sorted(rows) == [(False, 1, 30), (False, 2, 30), (False, 2, 30), (False, 3, 30), (False, 4, 30), (True, 1, 1)]
    sets = {tuple(r["items"]): r.freq for r in itemsets.frequent_sets(df, "basket", "item", 0.1).collect()}
    assert sets == {(1,): 31, (2,): 60, (3,): 30, (4,): 30, (1, 2): 30, (1, 3): 30, (2, 3): 30, (2, 4): 30, (1, 2, 3): 30}


def test_candidates_need_all_their_parts(spark):
    sets = spark.createDataFrame([([1, 2],), ([1, 3],), ([2, 3],), ([1, 4],), ([2, 4],), ([2, 5],)], "items array<int>")
    assert sorted((*r.prefix, r["item"]) for r in itemsets.candidates(sets, 3).collect()) == [(1, 2, 3), (1, 2, 4)]


def test_replaced_scores_are_deleted(spark):
    kept, gone = (workspace.stage(spark.range(5), name) for name in ("kept", "gone"))
    files = gone.inputFiles()
    workspace.discard(gone)
    assert kept.count() == 5 and not any(os.path.exists(f.removeprefix("file://")) for f in files)
    assert not any("/gone-" in p for p in workspace._staged) and any("/kept-" in p for p in workspace._staged)
