"""Registry of named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.plans.views import compose
from tillroll.plans.flow import Flow


@dataclass(frozen=True)
class Plan:
    name: str
    build: Callable[[Flow], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Flow(spark, sf_dir))


PLANS: dict[str, Plan] = {}


def plan(name: str, sql: str | None = None):
    def register(build: Callable[[Flow], DataFrame]) -> Callable[[Flow], DataFrame]:
        if name in PLANS:
            raise ValueError(f"plan {name} is registered twice")
        PLANS[name] = Plan(name, build, compose(sql) if sql else None)
        return build

    return register


def rounded(df: DataFrame, digits: int = 6, **exact: int) -> DataFrame:
    """Round every double column, so that summation order cannot show in results."""
    return df.withColumns(
        {
            name: F.round(name, exact.get(name, digits))
            for name, kind in df.dtypes
            if kind == "double"
        }
    )


def half_up(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, finite and not negative, by its binary value as the SQL does:
    ``F.round`` goes by the shortest decimal, which can lie on a tie where the value does not."""
    unit = F.lit(10.0**digits)
    return df.withColumns({name: F.floor(F.col(name) * unit + 0.5) / unit for name, kind in df.dtypes if kind == "double"})
