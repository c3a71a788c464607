"""Views that turn the given order tables into the retail and order models.

Retail model: ``baskets`` (what was bought), ``coupons`` (what was offered) and
``categories``, at the grain (week, shopper, product). Order model: ``orders``,
``order_lines`` and ``products``. Score model: ``scores`` and ``points``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillroll.operators.ranking import split_large, split_row_number
from tillroll.sources.tables import read_table

# Fixed values of the given tables.
FIRST_YEAR = 1995
LAST_WEEK = 78
HOLDOUT_WEEK = 78
TARGET_WEEK = 79
N_PRODUCTS = 25
LARGE_ORDER = 100_000
DEPARTMENTS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")



def paid_price() -> F.Column:
    """Price in cents: whole numbers up to the one division, the same on every engine."""
    return F.col("cents") * (100 - F.col("pct")) / F.lit(100.0)


def department_index(col: str) -> F.Column:
    """Place of a department in the fixed list; a department outside it is an error."""
    place = F.array_position(F.array(*[F.lit(d) for d in DEPARTMENTS]), F.col(col))
    unknown = F.raise_error(F.concat(F.lit("unknown department "), F.col(col))).cast("bigint")
    return F.when(place == 0, unknown).otherwise(place - 1).cast("int")


class Dataset:
    """One folder of input tables, seen through the retail and order models."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # ---- retail model -------------------------------------------------------

    @cached_property
    def parts(self) -> DataFrame:
        return self.table("part").select(
            "p_partkey",
            (F.regexp_extract("p_brand", r"(\d+)", 1).cast("int") - 1).alias("product"),
            F.round(F.col("p_retailprice") * 100).cast("bigint").alias("cents"),
            "p_name",
            "p_brand",
            "p_type",
        )

    @cached_property
    def transactions(self) -> DataFrame:
        orders = self.table("orders")
        lines = self.table("lineitem")
        month = (F.year("o_orderdate") - FIRST_YEAR) * 12 + F.month("o_orderdate") - 1
        return (
            lines.join(orders, lines.l_orderkey == orders.o_orderkey)
            .join(self.parts, lines.l_partkey == self.parts.p_partkey)
            .select(
                F.least(month, F.lit(LAST_WEEK)).cast("int").alias("week"),
                F.col("o_custkey").alias("shopper"),
                "product",
                "cents",
                (F.round(F.col("l_discount") * 100).cast("int") * 4).alias("pct"),
                (F.col("l_returnflag") == "R").alias("returned"),
            )
        )

    @cached_property
    def sales(self) -> DataFrame:
        """Every kept purchase line with its price in cents (duplicates included)."""
        return self.transactions.where(~F.col("returned")).select(
            "week",
            "shopper",
            "product",
            paid_price().alias("price"),
        )

    @cached_property
    def baskets(self) -> DataFrame:
        return self.sales.groupBy("week", "shopper", "product").agg(F.min("price").alias("price"))

    @cached_property
    def coupons(self) -> DataFrame:
        return (
            self.transactions.where(F.col("pct") > 0)
            .groupBy("week", "shopper", "product")
            .agg(F.max("pct").alias("discount"))
        )

    @cached_property
    def categories(self) -> DataFrame:
        """product -> category_label: the product's most frequent part type."""
        counts = self.parts.groupBy("product", "p_type").agg(F.count(F.lit(1)).alias("n"))
        top = counts.groupBy("product").agg(
            F.min_by("p_type", F.struct(-F.col("n"), F.col("p_type"))).alias("p_type")
        )
        return top.select("product", department_index("p_type").alias("category_label"))

    # ---- order model --------------------------------------------------------

    @cached_property
    def products(self) -> DataFrame:
        return self.parts.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("product").alias("aisle_id"),
            department_index("p_type").alias("department_id"),
        )

    @cached_property
    def aisles(self) -> DataFrame:
        return self.parts.select(
            F.col("product").alias("aisle_id"), F.col("p_brand").alias("aisle")
        ).distinct()

    @cached_property
    def departments(self) -> DataFrame:
        return self.parts.select(
            department_index("p_type").alias("department_id"), F.col("p_type").alias("department")
        ).distinct()

    @cached_property
    def _order_dates(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            "o_orderdate",
        )

    @cached_property
    def _dated_orders(self) -> DataFrame:
        """Orders numbered per user by date, with the days since the one before.

        Numbering runs per (user, week) and adds the orders of earlier weeks, so a user
        with a very large share of all orders is spread over many tasks.
        """
        week_no = F.floor(F.datediff("o_orderdate", F.lit(f"{FIRST_YEAR}-01-01")) / 7)
        numbered = split_row_number(
            self._order_dates.withColumn("week_no", week_no),
            keys=["user_id"],
            bucket=["week_no"],
            order=["o_orderdate", "order_id"],
            name="order_number",
            carry={"last_date": F.max("o_orderdate")},
        )
        inside = W.partitionBy("user_id", "week_no").orderBy("o_orderdate", "order_id")
        prior = F.coalesce(F.lag("o_orderdate").over(inside), F.col("last_date"))
        return numbered.select(
            "order_id",
            "user_id",
            "order_number",
            (F.dayofweek("o_orderdate") - 1).alias("order_dow"),
            (F.col("order_id") % 24).cast("int").alias("order_hour_of_day"),
            F.datediff("o_orderdate", prior).cast("double").alias("days_since_prior_order"),
            "o_orderdate",
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self._dated_orders.drop("o_orderdate")

    @cached_property
    def raw_lines(self) -> DataFrame:
        """Order lines with their position in the cart.

        An order is numbered in one sort; only one of more than ``LARGE_ORDER`` lines is sorted in
        parts, with the counts of the parts before added, so that no task holds it whole.
        """
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            "l_linenumber",
            "l_suppkey",
            "l_extendedprice",
            F.floor(F.col("l_partkey") / 1024).alias("part_block"),
        )
        counts = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
        large = counts.where(F.col("n") > LARGE_ORDER).select("order_id", F.lit(True).alias("large"))
        numbered = split_large(
            lines.dropna(subset=["order_id"]),
            large,
            key="order_id",
            bucket=["l_linenumber", "part_block"],
            order=["product_id", "l_suppkey", "l_extendedprice"],
            name="add_to_cart_order",
        )
        return numbered.select("order_id", "product_id", "add_to_cart_order")

    @cached_property
    def placed(self) -> DataFrame:
        """Orders that have lines."""
        return self.orders.join(self.keys.select("order_id"), "order_id", "left_semi")

    def _with_reordered(self, lines: DataFrame, how: str = "inner") -> DataFrame:
        """Add product, order and user columns and the reordered flag to order lines.

        A line is reordered when the user took the same aisle in an earlier order. The
        first order per (user, aisle) comes from the bare keys, combined before the
        shuffle, so a frequent pair is never gathered in one task.
        """
        dims = self.products.select("product_id", "aisle_id", "department_id")
        later = F.struct("o_orderdate", "order_id") > F.col("first")
        return (
            lines.join(self._dated_orders, "order_id", how)
            .join(dims, "product_id", how)
            .join(self._first_taken, ["user_id", "aisle_id"], how)
            .withColumn("reordered", later.cast("int"))
            .drop("first", "o_orderdate")
        )

    @cached_property
    def _first_taken(self) -> DataFrame:
        """The first order per (user, aisle)."""
        aisles = self.products.select("product_id", "aisle_id")
        return (
            self.keys.join(aisles, "product_id")
            .join(self._order_dates, "order_id")
            .groupBy("user_id", "aisle_id")
            .agg(F.min(F.struct("o_orderdate", "order_id")).alias("first"))
        )

    @cached_property
    def keys(self) -> DataFrame:
        """(order_id, product_id) of every line."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")
        )

    @cached_property
    def product_counts(self) -> DataFrame:
        """Products with their number of lines; lines are counted before any join."""
        counts = self.keys.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
        return counts.join(self.products, "product_id")

    @cached_property
    def items(self) -> DataFrame:
        """``lines`` without the cart position, which needs a numbering pass."""
        return self._with_reordered(self.keys)

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with user, order and product columns: the order-model base."""
        return self._with_reordered(self.raw_lines)

    def lines_of(self, keep: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """``keep(lines, placed)`` for a choice by order, made before the lines get their columns."""
        return self._with_reordered(keep(self.raw_lines, self.placed))

    @cached_property
    def order_lines(self) -> DataFrame:
        return self.lines.select("order_id", "product_id", "add_to_cart_order", "reordered")

    @cached_property
    def loose_lines(self) -> DataFrame:
        """``order_lines`` with the lines that have no product or no order (reordered is null)."""
        return self._with_reordered(self.raw_lines, "left").select(
            "order_id", "product_id", "add_to_cart_order", "reordered"
        )

    # ---- score model --------------------------------------------------------

    @cached_property
    def scores(self) -> DataFrame:
        docs = self.table("documents").select("doc_id", "n_chars")
        z = (F.col("n_chars") - 2000) / F.lit(2000.0)
        return (
            self.table("labels")
            .select("doc_id", F.col("quality").alias("y"))
            .join(docs, "doc_id")
            .select("doc_id", "y", F.round(1 / (1 + F.exp(-z)), 6).alias("p"))
        )

    @cached_property
    def points(self) -> DataFrame:
        return self.table("embeddings")
