"""Readers and writers: every scan states its schema, so nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}

PURCHASE_SCHEMA = "week int, shopper bigint, product int, price double"
COUPON_SCHEMA = "week int, shopper bigint, product int, discount int"
CATEGORY_SCHEMA = "product int, category_label int"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def read_parquet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> str:
    """Write a table; week-sliced tables pass ``partition_by='week'``.

    The rebalance hint gathers each week into few files and lets adaptive execution
    split a busy week over several tasks.
    """
    writer = df.write
    if partition_by:
        writer = df.hint("rebalance", partition_by).write.partitionBy(partition_by)
    writer.mode("overwrite").parquet(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path
