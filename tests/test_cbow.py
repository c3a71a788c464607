"""Bag-of-words embedding against row loops and a planted corpus."""

import numpy as np
import pyarrow as pa
import pytest

from tillroll.functions.columns import cosine
from tillroll.ml import cbow
from tillroll.plans import PLANS
from pyspark.sql import functions as F


def test_alias_table_keeps_the_weights():
    rng = np.random.default_rng(1)
    for w in (np.ones(7), rng.random(50) ** 4, np.array([3.0]), np.array([1e-9, 1.0, 5.0])):
        keep, other = cbow.alias_table(w)
        p = keep.copy()
        np.add.at(p, other, 1 - keep)
        assert p / len(w) == pytest.approx(w / w.sum(), abs=1e-12)


def test_gradients_against_differences():
    rng = np.random.default_rng(2)
    into, out = rng.normal(size=(9, 4)), rng.normal(size=(9, 4))
    items = rng.integers(0, 9, 12)  # baskets 0-4, 5-11; window 2
    first, end = np.array([0] * 5 + [5] * 7), np.array([5] * 5 + [12] * 7)
    at = np.arange(1, 11)
    lo, hi = np.maximum(first[at], at - 2), np.minimum(end[at], at + 3)
    drawn = rng.integers(0, 9, (len(at), 3))

    def likelihood(vectors, out):
        total = 0.0
        for t, a, b, negatives in zip(at, lo, hi, drawn):
            h = np.mean([vectors[j] for j in range(a, b) if j != t], axis=0)
            total += np.log(1 / (1 + np.exp(-h @ out[items[t]])))
            total += sum(np.log(1 / (1 + np.exp(h @ out[n]))) for n in negatives if n != items[t])
        return total

    inner, outer, asked = cbow.gradients(into, out, items, at, lo, hi, drawn)
    step, vectors = 1e-6, into[items]
    for p in range(9):
        for d in range(4):
            moved = out.copy()
            moved[p, d] += step
            got = outer[asked == p][:, d].sum()
            assert got == pytest.approx((likelihood(vectors, moved) - likelihood(vectors, out)) / step, abs=1e-4)
    # The input side hands the gradient of the mean to each context item undivided.
    t = 4
    one = cbow.gradients(into, out, items, at[t : t + 1], lo[t : t + 1], hi[t : t + 1], drawn[t : t + 1])[0]
    members = [j for j in range(lo[t], hi[t]) if j != at[t]]
    assert all((one[j] == one[members[0]]).all() for j in members)
    assert not one[[j for j in range(12) if j not in members]].any()
    every = [cbow.gradients(into, out, items, at[i : i + 1], lo[i : i + 1], hi[i : i + 1], drawn[i : i + 1])[0] for i in range(10)]
    assert inner == pytest.approx(np.sum(every, axis=0))


def test_small_vocabularies_are_counted_out(monkeypatch):
    rng = np.random.default_rng(5)
    into, out = rng.normal(size=(9, 4)), rng.normal(size=(9, 4))
    lengths = rng.integers(2, 9, 40)
    items, first = rng.integers(0, 9, lengths.sum()), np.repeat(lengths.cumsum() - lengths, lengths)
    at = np.arange(len(items))[3:-2]
    lo, hi = np.maximum(first[at], at - 3), np.minimum((first + np.repeat(lengths, lengths))[at], at + 4)
    drawn = rng.integers(0, 9, (len(at), 5))
    inner, outer, asked = cbow.gradients(into, out, items, at, lo, hi, drawn)
    a, b = np.zeros((9, 4)), np.zeros((9, 4))
    np.add.at(a, items, inner)
    np.add.at(b, asked, outer)
    got = cbow.summed_gradients(into, out, items, at, lo, hi, drawn)
    assert got[0] == pytest.approx(a) and got[1] == pytest.approx(b)
    lists = pa.array([rng.integers(0, 9, n).tolist() for n in lengths])
    ways = []
    for few in (9, 8):
        monkeypatch.setattr(cbow, "_FEW", few)
        vocabulary = cbow.Vocabulary(np.arange(9), *cbow.alias_table(np.arange(1.0, 10)))
        walk = cbow.Walk(vocabulary, np.stack([into, out]), np.random.default_rng(1), 0.1, 3)
        walk.add(lists)
        walk.end()
        ways.append((walk.into, walk.out, walk.met.tolist()))
    assert ways[0][0] == pytest.approx(ways[1][0]) and ways[0][1] == pytest.approx(ways[1][1]) and ways[0][2] == ways[1][2]


@pytest.fixture(scope="module")
def planted(spark):
    """48 products in 6 groups; a basket holds products of one group."""
    rng = np.random.default_rng(3)
    rows = [(i, [int(g * 8 + p) for p in rng.choice(8, 5, replace=False)]) for i, g in enumerate(rng.integers(0, 6, 1500))]
    rows += [(9000, None), (9001, []), (9002, [3]), (9003, [999, 1000]), (9004, [None, 1, 2])]
    return spark.createDataFrame(rows, "basket long, products array<int>")


def fit(df, **more):
    return cbow.train_cbow(df, vec_dim=12, epochs=12, **more)


def test_planted_groups_rank_first(planted):
    vectors = fit(planted, part_items=2000)  # four parts
    a, b = vectors.alias("a"), vectors.alias("b")
    near = a.join(b, F.col("a.product") != F.col("b.product")).select(
        F.col("a.product").alias("p"), F.col("b.product").alias("q"), cosine(F.col("a.vector"), F.col("b.vector")).alias("s")
    ).toPandas()
    assert vectors.count() == 48
    top = near.sort_values("s", ascending=False).groupby("p").head(7)
    assert (top.p // 8 == top.q // 8).mean() == 1.0


def test_sums_by_place():
    rng = np.random.default_rng(4)
    places, change = rng.integers(0, 9, 40), rng.normal(size=(40, 3))
    want = np.zeros((9, 3))
    np.add.at(want, places, change)
    used, total = cbow._summed(places, change)
    assert used.tolist() == sorted(set(places.tolist()))
    assert total == pytest.approx(want[used])


def test_a_part_has_a_file_of_its_own(planted):
    whole = planted.withColumn("products", F.transform("products", lambda p: p.cast("long")))
    rows = cbow._parts(whole, 500)  # 16 parts
    per_file = rows.groupBy(F.input_file_name()).agg(F.countDistinct("part").alias("n")).collect()
    assert [r["n"] for r in per_file] == [1] * rows.select("part").distinct().count()


def test_batches_of_the_reader_do_not_show(planted, spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        a = fit(planted, part_items=2000).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert a == fit(planted, part_items=2000).collect()


def test_reruns_agree(planted):
    a = fit(planted, part_items=2000).collect()
    assert a == fit(planted.repartition(7), part_items=2000).collect()
    assert a != fit(planted, part_items=2000, seed=1).collect()


def test_no_frequent_product(planted):
    assert fit(planted, min_count=10**6).count() == 0
    assert fit(planted.where("false")).count() == 0
    assert [r["product"] for r in fit(planted.where("basket in (9003, 9004)"), min_count=1).collect()] == [1, 2, 999, 1000]


def test_queries(spark):
    sf = "/root/testdata/sf0.001"
    long = PLANS["train_cbow"](spark, sf).toPandas()
    assert (long.groupby("product").size() == cbow.VECTOR_SIZE).all() and long.value.abs().max() > 0
    near = PLANS["similar_products_cbow"](spark, sf).collect()
    assert len(near) == min(10, long["product"].nunique() - 1)
    assert [r["similarity"] for r in near] == sorted((r["similarity"] for r in near), reverse=True)
