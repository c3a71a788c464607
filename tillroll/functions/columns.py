"""Scalar and array column expressions. All of them are built-in Spark functions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cyclical(value: Column | str, period: float) -> tuple[Column, Column]:
    angle = _col(value) * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def cap(value: Column | str, limit: int) -> Column:
    return F.least(_col(value), F.lit(limit))


def boxcox(value: Column | str, lam: Column | float) -> Column:
    """(x**lam - 1) / lam, and ln x where lam is 0."""
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    x = _col(value)
    return F.when(lam == 0, F.ln(x)).otherwise(F.try_divide(F.pow(x, lam) - 1, lam))


def boxcox1p(value: Column | str, lam: Column | float) -> Column:
    return boxcox(_col(value) + 1, lam)


def binarise(count: Column | str) -> Column:
    return F.when(_col(count) >= 1, 1).otherwise(0)


def draw_key(seed: int, *parts: Column | str) -> Column:
    """Reproducible random order: md5 of the seed and the row key."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[_col(p).cast("string") for p in parts]))


def draw_number(seed: int, *parts: Column | str) -> Column:
    """Reproducible random number from 0 up to 2**48, from the same digest."""
    return F.conv(F.substring(draw_key(seed, *parts), 1, 12), 16, 10).cast("long")


def hash_below(fraction: float, seed: int, *parts: Column | str) -> Column:
    """True for about ``fraction`` of the keys, always the same ones."""
    limit = f"{int(fraction * 16**8):08x}"
    return F.substring(draw_key(seed, *parts), 1, 8) < limit


def pad(array: Column | str, length: Column | int, fill: int = 0) -> Column:
    """Array of exactly ``length`` items, filled up at the end."""
    n = F.lit(length) if isinstance(length, int) else length
    return F.slice(F.concat(_col(array), F.array_repeat(F.lit(fill), n)), F.lit(1), n)


def from_end(array: Column | str, k: int) -> Column:
    """k-th item from the end, null where the array is shorter."""
    return F.try_element_at(_col(array), F.lit(-k))


def joined(array: Column | str) -> Column:
    """Array as comma-separated text."""
    return F.array_join(F.transform(_col(array), lambda x: x.cast("string")), ",")


def cosine(a: Column, b: Column) -> Column:
    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)

    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
