"""Product embedding by continuous bag of words with negative sampling.

The vector of a product is predicted from the mean vector of the products around it in its
basket, against a few products drawn by frequency. Each round is one scan: every part of the
baskets starts from the same model and walks through its own baskets in small batches; the
parts' changes are averaged by product. Parts are set by the data alone and changes are
added as whole numbers, so a rerun gives the same vectors on any number of executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.shipping import ship
from tillroll.sources.workspace import stage

# The training settings of the main pipeline, and the usual rates and powers.
VECTOR_SIZE, EPOCHS, MIN_COUNT, WINDOW = 30, 100, 30, 15
NEGATIVES, FIRST_RATE, LAST_RATE, POWER = 5, 0.025, 0.0001, 0.75
PART_ITEMS = 200_000
_BATCH = 512
_CHUNK = 10_000  # baskets of a part that are walked through at a time, counted from its first
_LONGEST = 0.5  # change of one vector in one batch
_UNIT = float(1 << 32)
_FEW = 128  # products; up to so many a batch is counted out in a table of targets by products


def alias_table(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keep-probability and substitute of each place: a draw is a place and one comparison."""
    n = len(weights)
    keep, other = weights * (n / weights.sum()), np.arange(n)
    low, high = [i for i in range(n) if keep[i] < 1], [i for i in range(n) if keep[i] >= 1]
    while low and high:
        i, j = low.pop(), high[-1]
        other[i] = j
        keep[j] -= 1 - keep[i]
        if keep[j] < 1:
            low.append(high.pop())
    return np.minimum(keep, 1.0), other


@dataclass
class Vocabulary:
    products: np.ndarray  # ascending
    keep: np.ndarray
    other: np.ndarray

    def places(self, items: np.ndarray) -> np.ndarray:
        """Place of each item, -1 for one that is not known."""
        at = np.minimum(np.searchsorted(self.products, items), len(self.products) - 1)
        return np.where(self.products[at] == items, at, -1)

    def draw(self, rng: np.random.Generator, shape: tuple[int, int]) -> np.ndarray:
        at = rng.integers(0, len(self.products), shape)
        return np.where(rng.random(shape) < self.keep[at], at, self.other[at])


def _summed(places: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places met, ascending, and the sum of the changes of each, added up in their order."""
    used, at = np.unique(places, return_inverse=True)
    width = change.shape[1]
    cells = (at[:, None] * width + np.arange(width)).ravel()
    return used, np.bincount(cells, change.ravel(), len(used) * width).reshape(-1, width)


def gradients(
    into: np.ndarray, out: np.ndarray, items: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, drawn: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascent directions of one batch: per place of ``items`` (input side), and per target and
    drawn product (output side), with the products of the latter.

    Target ``at[i]`` has the context ``lo[i]`` to ``hi[i]`` without itself. A window costs the
    same at any width: its sum is a difference of running sums, and what it hands back to its
    members is one step up at its start and one down at its end.
    """
    vectors = into[items]
    running = np.vstack([np.zeros(vectors.shape[1]), vectors.cumsum(0)])
    h = (running[hi] - running[lo] - vectors[at]) / (hi - lo - 1)[:, None]
    asked = np.column_stack([items[at], drawn])
    met = out[asked]
    score = 1 / (1 + np.exp(-np.einsum("nd,nkd->nk", h, met).clip(-30, 30)))
    label = np.zeros(asked.shape)
    label[:, 0] = 1
    # A drawn product that is the target itself says nothing.
    g = np.where((asked == asked[:, :1]) & (label == 0), 0.0, label - score)
    back = np.einsum("nk,nkd->nd", g, met)
    steps = np.zeros((len(items) + 1, vectors.shape[1]))
    met_at, step = _summed(np.concatenate([lo, hi]), np.concatenate([back, -back]))
    steps[met_at] = step
    inner = steps.cumsum(0)[:-1]
    inner[at] -= back  # a place is a target once
    return inner, g[:, :, None] * h[:, None, :], asked


def summed_gradients(
    into: np.ndarray, out: np.ndarray, items: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, drawn: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """``gradients`` added up by product, a row per product of either side, for a small vocabulary:
    windows and asked products are counted per target and product, the rest is products of tables."""
    n, products, each = len(at), len(into), np.arange(len(at))
    running = np.zeros((len(items) + 1, products))
    running[np.arange(1, len(items) + 1), items] = 1
    running = running.cumsum(0)
    window = running[hi] - running[lo]
    window[each, items[at]] -= 1
    h = window @ into / (hi - lo - 1)[:, None]
    asked = np.column_stack([items[at], drawn])
    cells = asked + products * each[:, None]
    score = 1 / (1 + np.exp(-(h @ out.T).ravel()[cells].clip(-30, 30)))
    # A drawn product that is the target itself says nothing.
    g = np.where(asked == asked[:, :1], 0.0, -score)
    g[:, 0] = 1 - score[:, 0]
    table = np.bincount(cells.ravel(), g.ravel(), n * products).reshape(n, products)
    return window.T @ (table @ out), table.T @ h


def _add(vectors: np.ndarray, places: np.ndarray, change: np.ndarray) -> None:
    used, total = _summed(places, change)
    vectors[used] += _shortened(total)


def _shortened(total: np.ndarray) -> np.ndarray:
    length = np.sqrt((total**2).sum(1))
    return total * np.minimum(1, _LONGEST / np.maximum(length, 1e-300))[:, None]


class Walk:
    """One part's way through its baskets in one round."""

    def __init__(self, vocabulary: Vocabulary, start: np.ndarray, rng: np.random.Generator, rate: float, window: int):
        self.vocabulary, self.start, self.rng, self.rate, self.window = vocabulary, start, rng, rate, window
        self.into, self.out = start.copy()
        self.met = np.zeros(start.shape[:2], bool)
        self.waiting: list[pa.Array] = []

    def add(self, lists: pa.Array) -> None:
        """The next lists. Where the reader cuts its batches does not show in the result."""
        self.waiting.append(lists)
        if sum(map(len, self.waiting)) < _CHUNK:
            return
        whole = pa.concat_arrays(self.waiting)
        full = len(whole) - len(whole) % _CHUNK
        for at in range(0, full, _CHUNK):
            self._lists(whole.slice(at, _CHUNK))
        self.waiting = [whole.slice(full)]

    def end(self) -> None:
        for rest in [pa.concat_arrays(self.waiting)] if self.waiting else []:
            self._lists(rest)
        self.waiting = []

    def _lists(self, lists: pa.Array) -> None:
        self.baskets(lists.flatten().to_numpy(), lists.value_lengths().to_numpy())

    def baskets(self, items: np.ndarray, lengths: np.ndarray) -> None:
        """Baskets laid end to end. Products outside the vocabulary leave no gap."""
        owner = np.repeat(np.arange(len(lengths)), lengths)
        places = self.vocabulary.places(items)
        owner, places = owner[places >= 0], places[places >= 0]
        first, end = np.searchsorted(owner, owner), np.searchsorted(owner, owner, "right")
        i = np.arange(len(places))
        lo, hi = np.maximum(first, i - self.window), np.minimum(end, i + self.window + 1)
        targets = i[hi - lo > 1]
        for b in range(0, len(targets), _BATCH):
            at = targets[b : b + _BATCH]
            base, top = lo[at].min(), hi[at].max()
            near = places[base:top]
            drawn = self.vocabulary.draw(self.rng, (len(at), NEGATIVES))
            batch = self.into, self.out, near, at - base, lo[at] - base, hi[at] - base, drawn
            if len(self.into) <= _FEW:
                inner, outer = summed_gradients(*batch)
                self.into += _shortened(self.rate * inner)
                self.out += _shortened(self.rate * outer)
                self.met[1, drawn] = self.met[1, places[at]] = True
            else:
                inner, outer, asked = gradients(*batch)
                _add(self.into, near, self.rate * inner)
                _add(self.out, asked.ravel(), self.rate * outer.reshape(-1, outer.shape[2]))
                self.met[1, asked] = True
            self.met[0, near] = True

    def change(self, names: list[str]) -> pa.RecordBatch:
        """A row per product met: whether on each side, and the changes in units of 2**-32."""
        self.end()
        used = np.flatnonzero(self.met.any(0))
        delta = np.stack([self.into, self.out])[:, used] - self.start[:, used]
        whole = np.rint(np.hstack(delta) * _UNIT).astype(np.int64)
        columns = [used, *self.met[:, used].astype(np.int64), *whole.T]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _parts(baskets: DataFrame, part_items: int) -> DataFrame:
    """(part, products) in a fixed order, a part's baskets next to each other in one file."""
    key = F.xxhash64(*[c for c in baskets.columns])
    rows = baskets.where(F.size("products") > 1).withColumn("_key", key)
    items = rows.agg(F.sum(F.size("products"))).first()[0] or 0
    parts = max(1, -(-items // part_items))
    slim = rows.select(F.pmod("_key", F.lit(parts)).alias("part"), "_key", "products")
    # by number: hashed numbers of parts would put several parts into one file and none into others
    return stage(slim.repartitionById(parts, F.col("part").cast("int")).sortWithinPartitions("part", "_key", "products"), "cbow").select(
        "part", "products"
    )


def train_cbow(
    baskets: DataFrame,
    vec_dim: int = VECTOR_SIZE,
    epochs: int = EPOCHS,
    min_count: int = MIN_COUNT,
    window: int = WINDOW,
    seed: int = 42,
    part_items: int = PART_ITEMS,
) -> DataFrame:
    """(product, vector), one row per product found ``min_count`` times or more, by product.

    ``baskets`` has a list ``products`` of whole numbers per row; its other columns are keys
    that tell equal baskets apart, so that they spread over parts. Null lists, lists of one and
    null items teach nothing. The model, two vectors per product, is what driver and tasks
    hold; the baskets are only ever scanned. No product found often enough: no rows.
    """
    spark = baskets.sparkSession
    ship(spark)
    longs = F.array_compact(F.transform("products", lambda p: p.cast("long")))
    whole = baskets.withColumn("products", longs)
    counts = (
        whole.select(F.explode("products").alias("product"))
        .groupBy("product")
        .count()
        .where(F.col("count") >= min_count)
        .toPandas()
        .sort_values("product")
    )
    known = counts["product"].to_numpy(np.int64)
    if not len(known):
        return spark.createDataFrame([], "product long, vector array<double>")
    vocabulary = Vocabulary(known, *alias_table(counts["count"].to_numpy(float) ** POWER))
    rng = np.random.default_rng(seed)
    model = np.stack([(rng.random((len(known), vec_dim)) - 0.5) / vec_dim, np.zeros((len(known), vec_dim))])
    rows = _parts(whole, part_items)
    for epoch in range(epochs):
        rate = FIRST_RATE + (LAST_RATE - FIRST_RATE) * epoch / epochs
        model = model + _round(rows, vocabulary, model, (seed, epoch), rate, window)
    return _table(spark, known, model[0])


def _round(
    rows: DataFrame, vocabulary: Vocabulary, model: np.ndarray, seed: tuple[int, int], rate: float, window: int
) -> np.ndarray:
    """The mean change of each vector over the parts that met its product."""
    dims = range(2 * model.shape[2])
    names = ["place", "n_in", "n_out", *[f"d{i}" for i in dims]]
    held = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, walk = None, None
        for b in batches:
            of, lists = b.column(0).to_numpy(), b.column(1)
            cuts = [0, *(np.flatnonzero(np.diff(of)) + 1), len(of)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if of[lo] != part:
                    if walk:
                        yield walk.change(names)
                    part = of[lo]
                    walk = Walk(vocabulary, held.value, np.random.default_rng([*seed, int(part)]), rate, window)
                walk.add(lists.slice(lo, hi - lo))
        if walk:
            yield walk.change(names)

    changes = rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    total = changes.groupBy("place").agg(*[F.sum(n).alias(n) for n in names[1:]]).toArrow()
    held.destroy()
    out = np.zeros_like(model)
    at = total.column("place").to_numpy()
    for side, n in enumerate(("n_in", "n_out")):
        mean = np.maximum(total.column(n).to_numpy(), 1)
        for i in range(model.shape[2]):
            whole = total.column(f"d{side * model.shape[2] + i}").to_numpy()
            out[side, at, i] = whole / _UNIT / mean
    return out


def _table(spark: SparkSession, products: np.ndarray, vectors: np.ndarray) -> DataFrame:
    table = pa.table({"product": products, "vector": pa.array(vectors.tolist(), pa.list_(pa.float64()))})
    return spark.createDataFrame(table)
