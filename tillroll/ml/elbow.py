"""k-means for many k at once: one scan an iteration serves every k."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.sources.shipping import ship

SAMPLE = 4_096  # points that the first centres are chosen from
ITERATIONS = 40
TOLERANCE = 1e-4  # an iteration that saves a smaller share is a model's last

Centres = dict[int, np.ndarray]


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.stack([((x - c) ** 2).sum(1) for c in centres], axis=1)


def first_centres(sample: np.ndarray, ks: Sequence[int], seed: int) -> Centres:
    """Centres of each k on the sample: those of k - 1 and one more point, drawn by squared
    distance, moved until they save little. So the cost on the sample falls with k."""
    rng = np.random.default_rng(seed)
    centres, kept = sample.mean(0, keepdims=True), {}
    for k in range(1, max(ks) + 1):
        if k > 1:
            near = _squared(sample, centres).min(1)
            p = near / near.sum() if near.sum() > 0 else None
            centres = np.concatenate([centres, sample[[rng.choice(len(sample), p=p)]]])
        last = np.inf
        for _ in range(ITERATIONS):
            square = _squared(sample, centres)
            own = square.argmin(1)
            cost = square[np.arange(len(sample)), own].sum()
            if last - cost <= TOLERANCE * cost:
                break
            last, n = cost, np.bincount(own, minlength=k)
            sums = np.stack([np.bincount(own, column, k) for column in sample.T], axis=1)
            centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        kept[k] = centres
    return {k: kept[k] for k in ks}


def _assigned(frames: Iterator[pd.DataFrame], centres: Centres) -> Iterator[pd.DataFrame]:
    """Size, coordinate sums, cost and farthest point of each centre over a task's points."""
    kept = {k: [np.zeros(k), np.zeros(c.shape), np.zeros(k), np.full(k, -1.0), np.zeros(c.shape)] for k, c in centres.items()}
    for frame in frames:
        x = frame.to_numpy(float)
        for k, c in centres.items():
            n, sums, cost, far, far_at = kept[k]
            square = _squared(x, c)
            own = square.argmin(1)
            least = square[np.arange(len(x)), own]
            n += np.bincount(own, minlength=k)
            cost += np.bincount(own, least, k)
            for d in range(x.shape[1]):
                sums[:, d] += np.bincount(own, x[:, d], k)
            for j in np.unique(own).tolist():
                inside = np.flatnonzero(own == j)
                at = inside[least[inside].argmax()]
                if least[at] > far[j]:
                    far[j], far_at[j] = least[at], x[at]
    for k, (n, sums, cost, far, far_at) in kept.items():
        yield pd.DataFrame(
            {"k": k, "c": np.arange(k), "n": n, "cost": cost, "far": far, "far_at": list(far_at)}
            | {f"s{d}": sums[:, d] for d in range(sums.shape[1])}
        )[n > 0]


def _scan(points: DataFrame, centres: Centres) -> dict[int, tuple[np.ndarray, float, np.ndarray]]:
    """(means, cost, farthest point) of each k under its centres. A task hands on one row per
    centre, and one row per centre comes back; a centre without points stays where it is."""
    dims = range(len(points.columns))
    fields = ", ".join(f"s{d} double" for d in dims)
    schema = f"k int, c int, n double, cost double, far double, far_at array<double>, {fields}"
    parts = points.mapInPandas(lambda frames: _assigned(frames, centres), schema)
    rows = parts.groupBy("k", "c").agg(
        F.sum("n").alias("n"),
        F.sum("cost").alias("cost"),
        F.max(F.struct("far", "far_at")).alias("far"),
        *[F.sum(f"s{d}").alias(f"s{d}") for d in dims],
    )
    means = {k: c.copy() for k, c in centres.items()}
    cost = dict.fromkeys(centres, 0.0)
    far: dict[int, tuple] = dict.fromkeys(centres, (-1.0, []))
    for r in sorted(rows.collect(), key=lambda r: (r["k"], r["c"])):
        means[r["k"]][r["c"]] = [r[f"s{d}"] / r["n"] for d in dims]
        cost[r["k"]] += r["cost"]
        far[r["k"]] = max(far[r["k"]], tuple(r["far"]))
    return {k: (means[k], cost[k], np.array(far[k][1])) for k in centres}


def fit_many(points: DataFrame, ks: Sequence[int], seed: int = 42) -> dict[int, tuple[np.ndarray, float]]:
    """(centres, sum of squared distances) of each k over all rows of ``points``, whose columns
    are the coordinates.

    Rows with a null are left out; no rows give no models. The number of scans is that of the
    slowest k, not their sum. The cost falls, or stays, as k grows: a k that ends above a
    smaller one starts again from the smaller one's centres and its farthest points.
    ``points`` is read once a scan: hand in a written table.
    """
    ship(points.sparkSession)
    points = points.select(*[F.col(c).cast("double").alias(c) for c in points.columns]).dropna()
    ks = sorted(set(ks))
    order = F.xxhash64(F.lit(seed), *points.columns)
    sample = np.array(points.orderBy(order, *points.columns).limit(SAMPLE).collect(), float)
    if not len(sample) or not ks:
        return {}
    seeds = first_centres(sample, ks, seed)
    moving = dict(seeds)
    best: dict[int, tuple[np.ndarray, float, np.ndarray]] = {}
    while moving:
        last: dict[int, float] = {}
        for _ in range(ITERATIONS):
            for k, (means, cost, far) in _scan(points, moving).items():
                if k not in best or cost < best[k][1]:
                    best[k] = (moving[k], cost, far)
                if last.get(k, np.inf) - cost <= TOLERANCE * cost:
                    del moving[k]
                else:
                    moving[k], last[k] = means, cost
            if not moving:
                break
        moving = {}
        low = ks[0]
        for k in ks[1:]:
            if best[k][1] > best[low][1] * (1 + 1e-9):
                centres, _, far = best[low]
                moving[k] = np.concatenate([centres, [far], seeds[k][: k - low - 1]])
            else:
                low = k
    return {k: best[k][:2] for k in ks}
