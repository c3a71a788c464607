"""Product embedding from baskets, its 2-d projection and product categories."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.ml import skipgram
from tillroll.operators.vectors import most_similar

# The training settings of the main pipeline.
VECTOR_SIZE, EPOCHS, MIN_COUNT, WINDOW = 30, 100, 30, 15


def train_p2v(
    baskets: DataFrame,
    vec_dim: int = VECTOR_SIZE,
    epochs: int = EPOCHS,
    min_count: int = MIN_COUNT,
    window: int = WINDOW,
    seed: int = 42,
    partitions: int = 8,
) -> DataFrame:
    """(word, vector): products embedded from the baskets they share (skip-gram).

    ``baskets`` has a ``products`` list per row. The vocabulary is the product range. Pairs
    are counted in one scan and trained on as counted, so an epoch costs the same however
    many baskets there are; ``partitions`` is the least number of tasks an epoch asks for.
    """
    return skipgram.train(baskets, vec_dim, epochs, min_count, window, seed, partitions)


def product_vectors(model: DataFrame) -> DataFrame:
    """(product, vector), products sorted as numbers."""
    return (
        model.select(F.col("word").cast("int").alias("product"), array_to_vector("vector").alias("vector"))
        .orderBy(F.col("product").cast("double"))
    )


def similar_products(model: DataFrame, product: int, n: int = 10) -> DataFrame:
    vectors = product_vectors(model).select("product", vector_to_array("vector").alias("v"))
    return most_similar(vectors, "product", "v", product, n)


def rows_of_similar(baskets: DataFrame, model: DataFrame, product: int, n: int = 5) -> DataFrame:
    """Purchase rows of the products most similar to one product."""
    return baskets.join(similar_products(model, product, n), "product", "left_semi")


def project_2d(vectors: DataFrame) -> DataFrame:
    """(product, x, y): principal components of the product vectors."""
    model = PCA(k=2, inputCol="vector", outputCol="components").fit(vectors)
    pos = vector_to_array("components")
    return model.transform(vectors).select(
        "product", pos[0].alias("x"), pos[1].alias("y"), "components"
    )


def product_categories(points: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """(product, category_label) by k-means on the projected vectors."""
    model = KMeans(k=k, seed=seed, featuresCol="components", predictionCol="category_label").fit(
        points
    )
    return (
        model.transform(points)
        .select("product", "category_label")
        .orderBy(F.col("product").cast("double"))
    )
