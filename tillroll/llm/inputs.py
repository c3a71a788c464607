"""Reading the given tables, with the package at hand on every executor."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.sources.shipping import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
