"""The retail pipeline: from purchases and coupons to features and recommendations.

``RetailPipeline`` derives everything from three tables (``baskets``, ``coupons``,
``categories``). ``RetailFolder`` reads them from a folder:

    shop = RetailFolder(spark, "/data/shop", holdout_week=89, target_week=90)
    train, test = shop.generate_dataset((0, 88), (1, 89))
    recommendations = shop.recommend(booster.train_gbt(train))
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.ml import booster
from tillroll.ml.histboost import Boosted
from tillroll.operators import basic, coupons, features, lags, sampling
from tillroll.sources import tables
from tillroll.sources.workspace import stage


class RetailPipeline:
    """Lazy intermediates of the pipeline; subclasses provide the three input tables."""

    spark: SparkSession
    holdout_week: int
    target_week: int

    baskets: DataFrame
    coupons: DataFrame
    categories: DataFrame

    @cached_property
    def offers(self) -> DataFrame:
        """Purchases merged with coupons; price or discount is null where absent."""
        return basic.purchase_coupon_outer(self.baskets, self.coupons)

    def share_offers(self) -> None:
        """Write the purchase/offer merge once and derive all other steps from it.

        For plans with many branches: purchases and coupons are then read back from the
        merged table instead of being prepared from the raw input each time.
        """
        merged = stage(self.offers, "offers")
        self.offers = merged
        self.baskets = merged.where(F.col("price").isNotNull()).drop("discount")
        self.coupons = merged.where(F.col("discount").isNotNull()).drop("price")
        self.sampled_rows = basic.purchase_flags(sampling.with_negatives(merged, self.preferences))

    @cached_property
    def rows(self) -> DataFrame:
        """``offers`` with the five purchase flags."""
        return basic.purchase_flags(self.offers)

    @cached_property
    def preferences(self) -> DataFrame:
        return sampling.preferences(self.baskets, self.holdout_week)

    @cached_property
    def negatives(self) -> DataFrame:
        return sampling.negative_samples(self.baskets, self.preferences)

    @cached_property
    def targets(self) -> DataFrame:
        return sampling.target_candidates(self.preferences, self.target_week)

    @cached_property
    def history(self) -> DataFrame:
        return lags.history_plus_target(self.offers, self.targets)

    @cached_property
    def lags(self) -> DataFrame:
        return lags.lag_weeks(self.history, self.target_week)

    @cached_property
    def recency(self) -> DataFrame:
        return lags.pair_recency(self.rows, self.holdout_week)

    @cached_property
    def sampled_rows(self) -> DataFrame:
        """Purchases, offers and sampled negatives with flags."""
        return basic.purchase_flags(basic.merge_samples(self.offers, self.negatives))

    @cached_property
    def wide(self) -> DataFrame:
        """``sampled_rows`` with category and history columns, nulls kept."""
        rows = basic.enrich_category(self.sampled_rows, self.categories)
        return lags.with_history(rows, self.holdout_week)

    @cached_property
    def base(self) -> DataFrame:
        """``wide``, written once: the feature builders read it per grain."""
        return stage(self.wide, "base")

    def feature_table(self, start: int, end: int) -> DataFrame:
        """The 35-column feature table of the weeks [start, end]."""
        return features.build_features(self.base, self.baskets, start, end)

    def generate_dataset(
        self, train: tuple[int, int], test: tuple[int, int], path: str | None = None
    ) -> tuple[DataFrame, DataFrame]:
        """Training and test feature tables; with ``path`` also written by week."""
        both = self.feature_table(*train), self.feature_table(*test)
        if path is None:
            return both
        written = []
        for name, table in zip(("train", "test"), both):
            out = tables.write_parquet(table, f"{path}/{name}.parquet", partition_by="week")
            back = self.spark.read.schema(table.schema).parquet(out)
            written.append(back.select(*table.columns))  # the partition column moves last
        return written[0], written[1]

    @cached_property
    def target_table(self) -> DataFrame:
        """The 27-column table of the candidates in the target week."""
        candidates = lags.target_history(self.baskets, self.holdout_week, self.target_week)
        named = basic.enrich_category(candidates, self.categories)
        return features.target_features(named, self.base, self.baskets)

    def recommend(self, model: Boosted) -> DataFrame:
        """Best coupons per shopper by the expected revenue of a fitted booster."""
        return booster.assign_coupons(model, self.target_table)

    @cached_property
    def scored(self) -> DataFrame:
        """Candidates of the target week under every discount, with the history score."""
        candidates = coupons.candidate_history(self.rows, self.preferences, self.target_week)
        scored = coupons.history_score(coupons.discount_scenarios(candidates))
        return coupons.expected_revenue(scored)

    def heuristic(self, week: int) -> DataFrame:
        """Rule-based coupons of every shopper for a week."""
        found = coupons.heuristic_features(self.baskets, self.coupons)
        return coupons.heuristic_coupons(found, coupons.coupon_slots(self.baskets, week))


class RetailFolder(RetailPipeline):
    """baskets.parquet, coupons.parquet and product_categories.csv of one folder.

    Rows without a key are left out and repeated keys are merged (lowest price, highest
    discount), so that every join downstream meets unique keys. ``max_shopper`` is
    pushed into the scans.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        holdout_week: int = 89,
        target_week: int = 90,
        max_shopper: int | None = None,
    ):
        self.spark = spark
        self.holdout_week = holdout_week
        self.target_week = target_week
        self.baskets = self._keyed(
            tables.read_parquet(spark, f"{path}/baskets.parquet", tables.PURCHASE_SCHEMA),
            F.min("price").alias("price"),
            max_shopper,
        )
        self.coupons = self._keyed(
            tables.read_parquet(spark, f"{path}/coupons.parquet", tables.COUPON_SCHEMA),
            F.max("discount").alias("discount"),
            max_shopper,
        )
        self.categories = tables.read_csv(
            spark, f"{path}/product_categories.csv", tables.CATEGORY_SCHEMA
        )

    @staticmethod
    def _keyed(df: DataFrame, agg, max_shopper: int | None) -> DataFrame:
        known = df.dropna(subset=basic.KEY)
        if max_shopper is not None:
            known = known.where(F.col("shopper") < max_shopper)
        return known.groupBy(*basic.KEY).agg(agg)
