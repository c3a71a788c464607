"""Counted skip-gram against loops, differences and a planted corpus."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.functions.columns import cosine
from tillroll.ml import products, skipgram


def test_tree_paths_tell_words_apart():
    counts = [40, 9, 9, 5, 1]
    paths = {}
    for word, node, branch in skipgram.tree_paths(counts):
        paths.setdefault(word, {})[node] = branch
    assert sorted(paths) == list(range(5)) and {n for p in paths.values() for n in p} == set(range(4))
    assert len(paths[0]) == 1 and sum(c * len(paths[w]) for w, c in enumerate(counts)) == 40 + 2 * 9 + 3 * 9 + 4 * 6
    for a in range(5):
        for b in range(a):
            assert any(paths[a][n] != paths[b][n] for n in paths[a].keys() & paths[b].keys())
    assert skipgram.tree_paths([3]) == []


def test_pair_counts_equal_a_loop(spark):
    rng = np.random.default_rng(3)
    lists = [rng.integers(0, 8, rng.integers(0, 9)).tolist() for _ in range(60)] + [None, [], [4, None, 5]]
    df = spark.createDataFrame([(x and [None if i is None else str(i) for i in x],) for x in lists], "products array<string>")
    words, window, want = ["5", "4", "1", "0", "7"], 3, {}
    for x in lists:
        known = [words.index(str(i)) for i in x or [] if str(i) in words]
        for i, a in enumerate(known):
            for j, b in enumerate(known):
                if 0 < abs(i - j) <= window:
                    want[a, b] = want.get((a, b), 0) + sum(abs(i - j) <= window - drawn for drawn in range(window))
    got = skipgram.pair_counts(df.repartition(4), words, window).collect()
    assert {(r.word, r.context): r.n for r in got} == want and len(got) == len(want)


def test_gradients_against_differences():
    rng = np.random.default_rng(2)
    into, out = rng.normal(size=(4, 3)), rng.normal(size=(3, 3))
    context, node = np.array([0, 1, 1, 3]), np.array([0, 0, 2, 1])
    ones, zeros = rng.random(4), rng.random(4)

    def likelihood(into, out):
        s = np.einsum("nd,nd->n", into[context], out[node])
        return -(ones * np.logaddexp(0, -s) + zeros * np.logaddexp(0, s)).sum()

    a, b = skipgram.gradients(into, out, context, node, ones, zeros)
    total = [np.zeros_like(into), np.zeros_like(out)]
    np.add.at(total[0], context, a), np.add.at(total[1], node, b)
    for side in (0, 1):
        for cell in np.ndindex(total[side].shape):
            up = [into.copy(), out.copy()]
            up[side][cell] += 1e-6
            assert (likelihood(*up) - likelihood(into, out)) / 1e-6 == pytest.approx(total[side][cell], abs=1e-5)


def planted(spark, copies=1):
    rng = np.random.default_rng(4)
    rows = [(sorted((rng.choice(5, 3, replace=False) + 5 * rng.integers(0, 4)).tolist()),) for _ in range(400)]
    return spark.createDataFrame(rows * copies, "products array<int>")


def test_an_epoch_costs_the_same_on_more_baskets(spark, monkeypatch):
    scanned, epoch = [], skipgram._epoch
    monkeypatch.setattr(skipgram, "_epoch", lambda d, *m: scanned.append(d.count()) or epoch(d, *m))
    once, more = (
        products.product_vectors(products.train_p2v(planted(spark, n), vec_dim=6, epochs=3, min_count=1)).collect() for n in (1, 20)
    )
    assert len(set(scanned)) == 1 and once == more  # it is the shares of the pairs that count


def test_groups_bought_together_are_close_on_any_partitioning(spark):
    fit = lambda n, df: products.train_p2v(df, vec_dim=8, epochs=40, min_count=1, partitions=n)
    model = fit(1, planted(spark).coalesce(1))
    assert model.collect() == fit(5, planted(spark).repartition(7)).collect()
    a, b = (model.select(F.col("word").cast("int").alias(x), F.col("vector").alias(f"v{x}")) for x in "ab")
    near = a.crossJoin(b).where("a <> b").withColumn("c", cosine(F.col("va"), F.col("vb"))).toPandas()
    best = near.loc[near.groupby("a")["c"].idxmax()]
    assert len(best) == 20 and (best["a"] // 5 == best["b"] // 5).all()
    same = near["a"] // 5 == near["b"] // 5
    assert near["c"][same].mean() > near["c"][~same].mean() + 0.5
