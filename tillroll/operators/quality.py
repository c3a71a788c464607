"""Data-quality checks as tables of (check_name, observed, passed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_table(df: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One aggregation; each check is (observed value, passed condition on it)."""
    observed = df.agg(*[o.cast("double").alias(n) for n, (o, _) in checks.items()])
    rows = F.array(
        *[
            F.struct(
                F.lit(n).alias("check_name"),
                F.col(n).alias("observed"),
                ok.cast("int").alias("passed"),
            )
            for n, (_, ok) in checks.items()
        ]
    )
    return observed.select(F.inline(rows))


FLAGS = [
    "discount_offered",
    "product_bought",
    "purchase_wo_dis",
    "no_purchase_w_dis",
    "discount_effect",
]


def feature_checks(df: DataFrame, n_shoppers: Column) -> DataFrame:
    """Every expected shopper present, two values per flag, no nulls anywhere.

    Rows are counted by shopper and flags first, so that the distinct counts, which copy
    their input once for each, see few rows.
    """
    is_null = F.greatest(*[F.col(c).isNull().cast("int") for c in df.columns]) > 0
    counted = df.groupBy("shopper", *FLAGS).agg(F.count_if(is_null).alias("_nulls"))
    checks = {
        "shoppers": (F.countDistinct("shopper"), F.col("shoppers") == n_shoppers),
        "nulls": (F.coalesce(F.sum("_nulls"), F.lit(0)), F.col("nulls") == 0),
    }
    for flag in FLAGS:
        checks[f"{flag}_values"] = (
            F.countDistinct(flag).cast("int"),
            F.col(f"{flag}_values") == 2,
        )
    return check_table(counted, checks)


def split_checks(
    df: DataFrame, train: tuple[int, int], test: tuple[int, int], split: str = "split"
) -> DataFrame:
    """First and last week of both splits equal the requested bounds."""
    checks = {}
    for name, (start, end) in {"train": train, "test": test}.items():
        week = F.when(F.col(split) == name, F.col("week"))
        checks[f"{name}_first_week"] = (F.min(week), F.col(f"{name}_first_week") == start)
        checks[f"{name}_last_week"] = (F.max(week), F.col(f"{name}_last_week") == end)
    return check_table(df, checks)


def coupon_checks(recs: DataFrame, n_shoppers: Column, k: int = 5) -> DataFrame:
    """Ranks 0..k-1, at most k coupons per shopper, expected shoppers, no nulls."""
    per_shopper = recs.groupBy("shopper").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("coupon").alias("lo"),
        F.max("coupon").alias("hi"),
        F.sum(
            F.greatest(*[F.col(c).isNull().cast("int") for c in recs.columns if c != "shopper"])
        ).alias("nulls"),
    )
    return check_table(
        per_shopper,
        {
            "shoppers": (F.count(F.lit(1)), F.col("shoppers") == n_shoppers),
            "max_coupons": (F.max("n"), F.col("max_coupons") <= k),
            "ranks_dense": (
                F.count_if(F.col("hi") != F.col("n") - 1),
                F.col("ranks_dense") == 0,
            ),
            "first_rank": (F.min("lo"), F.col("first_rank") == 0),
            "last_rank": (F.max("hi"), F.col("last_rank") == k - 1),
            "nulls": (F.sum("nulls"), F.col("nulls") == 0),
        },
    )


def contract_violations(df: DataFrame, columns: list[str]) -> list[str]:
    """Column names out of place against an output contract (schema only, no job)."""
    got = df.columns
    wrong = [f"{a} is not {b}" for a, b in zip(got, columns) if a != b]
    if len(got) != len(columns):
        wrong.append(f"{len(got)} columns instead of {len(columns)}")
    return wrong
