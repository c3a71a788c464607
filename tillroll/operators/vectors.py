"""Similarity search and silhouette scores over vector columns."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import cosine


def most_similar(
    vectors: DataFrame, id_col: str, vec_col: str, query_id: object, n: int = 10
) -> DataFrame:
    """The n items closest to one item by cosine; one scan, top n kept per task."""
    query = vectors.where(F.col(id_col) == query_id).select(vec_col).scalar()
    similarity = F.round(cosine(F.col(vec_col), F.col("_query")), 6)
    return (
        vectors.where(F.col(id_col) != query_id)
        .withColumn("_query", query)
        .select(id_col, similarity.alias("similarity"))
        .orderBy(F.desc("similarity"), id_col)
        .limit(n)
    )


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _cluster_summaries(pts: DataFrame) -> DataFrame:
    """Size, mean vector and mean squared norm per cluster."""
    sums = pts.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        Summarizer.mean(array_to_vector("x")).alias("m"),
        F.avg("xx").alias("yy"),
    )
    arrays = sums.select("label", "n", vector_to_array("m").alias("m"), "yy")
    return arrays.withColumn("mm", _dot(F.col("m"), F.col("m")))


def _distances(clusters: Column, centroid_variant: bool) -> tuple[Column, Column]:
    """(a, b) of one point against all clusters."""

    def to_members(c: Column) -> Column:
        return F.col("xx") - 2 * _dot(F.col("x"), c.m) + c.yy

    def to_other(c: Column) -> Column:
        return F.col("xx") - 2 * _dot(F.col("x"), c.m) + c.mm if centroid_variant else to_members(c)

    own = F.filter(clusters, lambda c: c.label == F.col("label"))
    others = F.filter(clusters, lambda c: c.label != F.col("label"))
    # The point itself is at distance 0: divide by n - 1 instead of n.
    a = F.transform(own, lambda c: F.try_divide(to_members(c) * c.n, c.n - 1))
    return F.array_max(a), F.array_min(F.transform(others, to_other))


def silhouette(
    points: DataFrame,
    id_col: str,
    vec_col: str,
    label_col: str,
    centroid_variant: bool = False,
) -> DataFrame:
    """Silhouette per point, on squared Euclidean distance.

    The mean squared distance from x to all members of a cluster follows from the
    cluster's size, mean vector and mean squared norm, |x|^2 - 2 x.mean + mean|y|^2, so
    no pair of points is ever formed. The nearest other cluster is taken by that mean
    distance, or by the distance to its centroid (``centroid_variant``).

    The summaries of all clusters travel as one value. It has a vector per cluster, as
    large as the model that made the clusters.
    """
    pts = points.select(
        F.col(id_col).alias("id"),
        F.col(label_col).alias("label"),
        F.transform(vec_col, lambda v: v.cast("double")).alias("x"),
    ).withColumn("xx", _dot(F.col("x"), F.col("x")))
    summaries = _cluster_summaries(pts)
    record = F.struct("label", "n", "m", "yy", "mm")
    every = summaries.agg(F.collect_list(record)).scalar()
    a, b = _distances(F.col("every"), centroid_variant)
    near = pts.withColumn("every", every).select("id", "label", a.alias("a"), b.alias("b"))
    score = F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))
    return near.withColumn("silhouette", F.coalesce(score, F.lit(0.0)))


def silhouette_by_cluster(scored: DataFrame) -> DataFrame:
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.avg("silhouette").alias("silhouette")
    )
