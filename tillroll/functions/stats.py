"""Whole-column statistics attached to rows through one-row scalar subqueries."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import boxcox
from tillroll.functions.quantiles import exact_quantiles
from tillroll.sources.workspace import stage


def one_row(df: DataFrame, **aggs: Column) -> Column:
    """A struct column holding global aggregates of ``df`` (no join needed)."""
    return df.agg(F.struct(*[a.alias(n) for n, a in aggs.items()]).alias("s")).scalar()


def skewness_unbiased(value: Column) -> Column:
    """Bias-corrected sample skewness; null for fewer than three values."""
    n = F.count(value)
    return F.when(
        n > 2, F.skewness(value) * F.sqrt(n * (n - 1).cast("double")) / (n - 2)
    )


def zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each column by (x - mean) / population standard deviation."""
    stats = one_row(
        df,
        **{f"{c}_m": F.avg(c) for c in columns},
        **{f"{c}_s": F.stddev_pop(c) for c in columns},
    )
    return df.withColumns(
        {
            c: F.try_divide(F.col(c) - stats.getField(f"{c}_m"), stats.getField(f"{c}_s"))
            for c in columns
        }
    )


def minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace each column by (x - min) / (max - min)."""
    stats = one_row(
        df,
        **{f"{c}_lo": F.min(c) for c in columns},
        **{f"{c}_hi": F.max(c) for c in columns},
    )
    return df.withColumns(
        {
            c: F.try_divide(
                F.col(c) - stats.getField(f"{c}_lo"),
                stats.getField(f"{c}_hi") - stats.getField(f"{c}_lo"),
            )
            for c in columns
        }
    )


def long_table(df: DataFrame, id_cols: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """One row per (ids, name, value) for named expressions over a small table."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("name"), expr.cast("double").alias("value"))
            for name, expr in values.items()
        ]
    )
    return df.select(*id_cols, F.inline(pairs))


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col_a, col_b, corr) for all ordered pairs, from one aggregation."""
    upper = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    agg = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in upper])
    cells = [(a, b, F.col(f"`{a}|{b}`")) for a, b in upper]
    cells += [(b, a, c) for a, b, c in cells] + [(a, a, F.lit(1.0)) for a in columns]
    return agg.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), c.alias("corr"))
                    for a, b, c in cells
                ]
            )
        )
    )


def null_counts(df: DataFrame) -> DataFrame:
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return agg.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"))
                    for c in df.columns
                ]
            )
        )
    )


def describe(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per column.

    Exact quartiles are selected from the columns written once, in a few scans of bounded
    memory, while the plan is built; ``exact=False`` has approximate ones in one pass.
    """
    aggs, fields = [], ("n", "mean", "std", "lo", "q25", "q50", "q75", "hi")
    quarters = (0.25, 0.5, 0.75)
    found = exact_quantiles(df, columns, quarters) if exact else {}
    for c in columns:
        x = F.col(c).cast("double")
        exprs = (
            F.count(x).cast("double"),
            F.avg(x),
            F.stddev_samp(x),
            F.min(x),
            *(
                F.lit(found[c][i]).cast("double") if exact else F.percentile_approx(x, F.lit(p))
                for i, p in enumerate(quarters)
            ),
            F.max(x),
        )
        aggs.append(F.struct(*[e.alias(f) for f, e in zip(fields, exprs)]).alias(c))
    return df.agg(*aggs).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        *[F.col(c).getField(f).alias(f) for f in fields],
                    )
                    for c in columns
                ]
            )
        )
    )


def boxcox_loglik(df: DataFrame, columns: Sequence[str], grid: Sequence[float]) -> DataFrame:
    """Box-Cox log-likelihood of every (column, lambda) of a grid, in one aggregation."""
    long = long_table(df, [], {c: F.col(c) for c in columns}).where(F.col("value") > 0)
    lams = F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias("lam")
    return (
        long.select("name", "value", lams)
        .groupBy("name", "lam")
        .agg(
            (
                (F.col("lam") - 1) * F.sum(F.ln("value"))
                - F.count("value") / F.lit(2.0) * F.ln(F.var_pop(boxcox("value", F.col("lam"))))
            ).alias("loglik")
        )
    )


def boxcox_mle(df: DataFrame, columns: Sequence[str], grid: Sequence[float]) -> DataFrame:
    """(name, lam, loglik) with the most likely lambda per column (ties: the smallest)."""
    lik = boxcox_loglik(df, columns, grid).withColumn("loglik", F.round("loglik", 3))
    best = F.max_by(F.struct("lam", "loglik"), F.struct(F.col("loglik"), -F.col("lam")))
    return lik.groupBy("name").agg(best.alias("b")).select("name", "b.lam", "b.loglik")


def _boxcox_spread(column: str, mean_log: float, lam: float) -> Column:
    """Population variance of the Box-Cox transform of a column scaled to geometric mean 1."""
    t = F.ln(F.when(F.col(column) > 0, F.col(column).cast("double"))) - F.lit(mean_log)
    return F.var_pop(F.expm1(F.lit(lam) * t) / F.lit(lam) if lam else t)


def boxcox_optimum(
    df: DataFrame, columns: Sequence[str], lo: float = -2.0, hi: float = 2.0, steps: int = 16, within: float = 1e-6
) -> list[tuple[str, float | None, float | None]]:
    """(column, lambda, log-likelihood) of the most likely Box-Cox lambda, to ``within``.

    The columns are written once. A scan evaluates ``steps + 1`` lambdas per column; the
    next bracket lies around the best one, or, where that is an edge, beyond the edge and
    three times as wide, so the optimum need not lie between ``lo`` and ``hi``. Only positive
    values count; a column with fewer than two different ones has no lambda (None).
    """
    data = stage(df.select(*columns), "boxcox")
    logs = {c: F.ln(F.when(F.col(c) > 0, F.col(c).cast("double"))) for c in columns}
    ends = data.agg(
        *[F.struct(F.count(x), F.avg(x), F.min(x), F.max(x)).alias(c) for c, x in logs.items()]
    ).first()
    bracket = {c: (lo, hi) for c in columns if ends[c][0] and ends[c][2] < ends[c][3]}
    best: dict[str, tuple[float, float]] = {}
    while bracket:
        grids = {c: [a + (b - a) * i / steps for i in range(steps + 1)] for c, (a, b) in bracket.items()}
        row = data.agg(
            *[
                F.array(*[_boxcox_spread(c, ends[c][1], g) for g in grid]).alias(c)
                for c, grid in grids.items()
            ]
        ).first()
        for c, grid in grids.items():
            n, mean_log = ends[c][:2]
            # an overflow is a lambda far from the optimum
            spread = [v if v is not None and 0 < v < math.inf else math.inf for v in row[c]]
            i = min(range(steps + 1), key=spread.__getitem__)
            best[c] = (grid[i], -n * mean_log - n / 2 * math.log(spread[i]))
            a, b = bracket[c]
            if i == 0:
                bracket[c] = (a - 3 * (b - a), grid[1])
            elif i == steps:
                bracket[c] = (grid[-2], b + 3 * (b - a))
            elif grid[i + 1] - grid[i - 1] > within:
                bracket[c] = (grid[i - 1], grid[i + 1])
            else:
                del bracket[c]
    return [(c, *best.get(c, (None, None))) for c in columns]
