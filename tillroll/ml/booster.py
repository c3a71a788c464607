"""Purchase-probability model: leaf-wise boosted trees over the named feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.ml import histboost
from tillroll.ml.histboost import Boosted, Settings
from tillroll.operators import coupons, orders
from tillroll.operators.basic import KEY
from tillroll.operators.features import MODEL_FEATURES

#: Weeks or categories that training has not seen get their own level.
NOMINAL = ["week", "category_label"]
LABEL = "product_bought"


def with_class_weights(df: DataFrame) -> DataFrame:
    """Weight column that evens out the two classes."""
    weights = orders.class_weights(df, LABEL).select(LABEL, F.col("weight").alias("class_weight"))
    return df.join(weights, LABEL)


def train_gbt(
    train: DataFrame,
    evaluation: DataFrame | None = None,
    n_estimators: int = 300,
    num_leaves: int = 1000,
    max_depth: int | None = None,
    learning_rate: float = 0.01,
    subsample: float = 0.5,
    reg_alpha: float = 0.0,
    reg_lambda: float = 0.5,
    early_stopping_rounds: int = 50,
    weighted: bool = False,
    seed: int = 42,
) -> Boosted:
    """Fit the booster; with an evaluation set, trees stop once it no longer improves."""
    if weighted:
        train = with_class_weights(train)
        evaluation = evaluation and evaluation.withColumn("class_weight", F.lit(1.0))
    return histboost.fit(
        train,
        MODEL_FEATURES,
        LABEL,
        nominal=NOMINAL,
        weight="class_weight" if weighted else None,
        evaluation=evaluation,
        key=[c for c in KEY if c in train.columns],
        settings=Settings(
            trees=n_estimators,
            leaves=num_leaves,
            depth=max_depth,
            learning_rate=learning_rate,
            subsample=subsample,
            l1=reg_alpha,
            l2=reg_lambda,
            stopping=early_stopping_rounds,
            seed=seed,
        ),
    )


def predict(model: Boosted, df: DataFrame, keep: list) -> DataFrame:
    """``keep`` columns plus the purchase probability."""
    return histboost.predict(model, df, keep)


def score_scenarios(model: Boosted, targets: DataFrame) -> DataFrame:
    """All candidates under all discounts, scored in one pass."""
    scenarios = coupons.discount_scenarios(targets)
    return predict(model, scenarios, ["week", "shopper", "product", "discount", "price"])


def assign_coupons(model: Boosted, targets: DataFrame) -> DataFrame:
    scored = coupons.expected_revenue(score_scenarios(model, targets))
    return coupons.assign_coupons(scored)


def importance(model: Boosted) -> list[tuple[str, float]]:
    """(feature, share of the gain), highest first; one value per named feature."""
    return model.importance()


def save(model: Boosted, spark: SparkSession, path: str) -> str:
    return histboost.save(model, spark, path)


def load(spark: SparkSession, path: str) -> Boosted:
    return histboost.load(spark, path)
