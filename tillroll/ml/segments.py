"""Customer segmentation: transform, scale, k-means, profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import columns as fx
from tillroll.functions import stats
from tillroll.ml.elbow import fit_many

BOXCOX_COLUMNS = ["total_number_of_orders", "average_item_size_of_orders"]
SQRT_COLUMNS = ["average_lag_in_days"]
SEGMENT_COLUMNS = [*SQRT_COLUMNS, *reversed(BOXCOX_COLUMNS)]


def transform(users: DataFrame, grid: Sequence[float]) -> DataFrame:
    """Box-Cox with the most likely lambda, square root, then z-scores.

    A user without a measured gap gets the mean, which is 0 after scaling.
    """
    best = stats.boxcox_mle(users, BOXCOX_COLUMNS, grid)
    lam = {c: best.where(F.col("name") == c).select("lam").scalar() for c in BOXCOX_COLUMNS}
    shaped = users.select(
        "user_id",
        *[F.sqrt(c).alias(c) for c in SQRT_COLUMNS],
        *[fx.boxcox(c, lam[c]).alias(c) for c in BOXCOX_COLUMNS],
    )
    return stats.zscore(shaped, SEGMENT_COLUMNS).fillna(0.0, SEGMENT_COLUMNS)


def assemble(scaled: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=SEGMENT_COLUMNS, outputCol="features").transform(scaled)


def fit_segments(points: DataFrame, k: int = 3, seed: int = 1):
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(points)


def elbow(points: DataFrame, ks: Sequence[int], seed: int = 42) -> list[tuple[int, float]]:
    """(k, sum of squared distances) for every k. All k share one scan an iteration."""
    found = fit_many(points.select(*SEGMENT_COLUMNS), ks, seed)
    return [(k, cost) for k, (_, cost) in found.items()]


def profile(clustered: DataFrame) -> DataFrame:
    """Mean of each feature and size per cluster, one digit."""
    return clustered.groupBy("cluster").agg(
        *[F.round(F.avg(c), 1).alias(c) for c in SEGMENT_COLUMNS],
        F.count(F.lit(1)).alias("n"),
    )


def melt(clustered: DataFrame, value_columns: Sequence[str] = tuple(SEGMENT_COLUMNS)) -> DataFrame:
    return clustered.unpivot(["user_id", "cluster"], list(value_columns), "metric", "value")
