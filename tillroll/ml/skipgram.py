"""Product embedding by skip-gram with a binary tree over the vocabulary.

What skip-gram learns from baskets is how often a product stands near another one: its
objective is a sum over (product, context) pairs. One scan counts the pairs; every epoch
then scans the counts, whose number the product range bounds, and not the baskets again.
Counts and gradients are added as whole numbers, so a rerun gives the same vectors on any
number of executors.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.sources.shipping import ship
from tillroll.sources.workspace import discard, stage

RATE = 0.1
PART_ROWS = 500_000
_UNIT = float(1 << 48)  # weights add up to 1, so sums of gradients stay far below 2**63


def tree_paths(counts: list[int]) -> list[tuple[int, int, int]]:
    """(word, inner node, branch) of the Huffman tree; nodes are numbered from 0."""
    heap = [(n, i) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    above: dict[int, tuple[int, int]] = {}
    for node in range(len(counts), 2 * len(counts) - 1):
        (n, a), (m, b) = heapq.heappop(heap), heapq.heappop(heap)
        above[a], above[b] = (node, 0), (node, 1)
        heapq.heappush(heap, (n + m, node))
    out = []
    for word in range(len(counts)):
        at = word
        while at in above:
            at, branch = above[at]
            out.append((word, at - len(counts), branch))
    return out


def near_pairs(owner: np.ndarray, places: np.ndarray, window: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes ``word * n + context`` of the places near each other in one basket, and their weights.

    Skip-gram draws a reach of 1 to ``window`` for every word, so a context ``d`` places
    away is met ``window - d + 1`` times in ``window`` epochs: that is its weight.
    """
    codes, weights = [], []
    for d in range(1, min(window, len(places) - 1) + 1):
        same = owner[d:] == owner[:-d]
        if not same.any():
            break
        a, b = places[:-d][same], places[d:][same]
        codes += [a * n + b, b * n + a]
        weights.append(np.full(2 * len(a), window - d + 1))
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    used, at = np.unique(np.concatenate(codes), return_inverse=True)
    return used, np.bincount(at, np.concatenate(weights)).astype(np.int64)


def pair_counts(lists: DataFrame, words: list[str], window: int) -> DataFrame:
    """(word, context, n): weights of the pairs, words by place. Unknown words leave no gap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(words, pa.string())
        for b in batches:
            of = pc.list_parent_indices(b.column(0)).to_numpy()
            places = pc.fill_null(pc.index_in(pc.list_flatten(b.column(0)), known), -1).to_numpy()
            keep = places >= 0
            codes, n = near_pairs(of[keep], places[keep].astype(np.int64), window, len(words))
            columns = [codes // len(words), codes % len(words), n]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["word", "context", "n"])

    pairs = lists.mapInArrow(run, "word long, context long, n long")
    return pairs.groupBy("word", "context").agg(F.sum("n").alias("n"))


def gradients(into: np.ndarray, out: np.ndarray, context: np.ndarray, node: np.ndarray, ones: np.ndarray, zeros: np.ndarray):
    """Ascent directions of counted decisions, a row each for the context's and the node's vector.

    At ``node`` the words near ``context`` went ``ones`` times down branch 0 and ``zeros``
    times down branch 1.
    """
    v, u = into[context], out[node]
    p = 1 / (1 + np.exp(-np.einsum("nd,nd->n", v, u).clip(-30, 30)))
    g = ones * (1 - p) - zeros * p
    return g[:, None] * u, g[:, None] * v


def _added(places: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(places, kind="stable")
    used, first = np.unique(places[order], return_index=True)
    whole = np.rint(change[order] * _UNIT).astype(np.int64)
    return used, np.add.reduceat(whole, first, axis=0) if len(first) else whole


def _epoch(decisions: DataFrame, into: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The gradients of both sides over all decisions."""
    names = ["side", "place", *[f"d{i}" for i in range(into.shape[1])]]
    held = decisions.sparkSession.sparkContext.broadcast((into, out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            context, node, ones, zeros = (c.to_numpy() for c in b.columns)
            for side, (at, g) in enumerate(zip((context, node), gradients(*held.value, context, node, ones, zeros))):
                used, total = _added(at, g)
                columns = [np.full(len(used), side), used, *total.T]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    changes = decisions.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    total = changes.groupBy("side", "place").agg(*[F.sum(n).alias(n) for n in names[2:]]).toArrow()
    held.destroy()
    found = np.zeros((2, *into.shape))
    at = total.column("side").to_numpy(), total.column("place").to_numpy()
    for i, n in enumerate(names[2:]):
        found[(*at, i)] = total.column(n).to_numpy() / _UNIT
    return found


def train(
    baskets: DataFrame, vec_dim: int, epochs: int, min_count: int, window: int, seed: int, partitions: int
) -> DataFrame:
    """(word, vector), one row per word found ``min_count`` times or more.

    ``baskets`` has a list ``products`` of words per row. Each epoch is one step up the
    gradient of both sides, coordinates scaled by what they moved before. Driver and tasks
    hold two vectors per word.
    """
    spark = baskets.sparkSession
    ship(spark)
    lists = baskets.select(F.transform("products", lambda p: p.cast("string")).alias("products"))
    found = (
        lists.select(F.explode("products").alias("word"))
        .dropna()
        .groupBy("word")
        .count()
        .where(F.col("count") >= min_count)
        .collect()
    )
    if not found:
        raise ValueError(f"no product is found {min_count} times")
    found = sorted(found, key=lambda r: (-r["count"], r["word"]))
    words, n = [r["word"] for r in found], len(found)
    paths = spark.createDataFrame(tree_paths([r["count"] for r in found]), "word long, node long, branch int")
    pairs = pair_counts(lists, words, window).join(paths, "word")
    went = lambda b: F.sum(F.when(F.col("branch") == b, F.col("n")).otherwise(0))
    met = stage(pairs.groupBy("context", "node").agg(went(0).alias("ones"), went(1).alias("zeros")), "pairs")
    rows, total = met.agg(F.count(F.lit(1)), F.sum(F.col("ones") + F.col("zeros"))).first()
    share = lambda c: (F.col(c) / F.lit(float(total or 1))).alias(c)
    parts = min(max(partitions, -(-rows // PART_ROWS)), max(1, rows // 1000))
    decisions = stage(met.repartition(parts, "context").select("context", "node", share("ones"), share("zeros")), "decisions")
    rng = np.random.default_rng(seed)
    model = np.stack([(rng.random((n, vec_dim)) - 0.5) / vec_dim, np.zeros((n, vec_dim))])
    moved = np.zeros_like(model)
    for _ in range(epochs):
        g = _epoch(decisions, *model)
        moved += g**2
        model = model + RATE * g / np.sqrt(np.maximum(moved, 1e-300))
    discard(met), discard(decisions)
    table = pa.table({"word": words, "vector": pa.array(model[0].tolist(), pa.list_(pa.float64()))})
    return spark.createDataFrame(table)
