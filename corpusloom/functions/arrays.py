"""Numeric array columns: vector arithmetic and fixed-length padding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once.

    A column used inside a lambda is evaluated again for every element; bound to the element of
    a one-element array it is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x))


def scale(vec: Column, factor: Column) -> Column:
    return let(factor, lambda f: F.transform(vec, lambda x: x * f))


def unit(vec: Column) -> Column:
    """Vector of length one; a zero vector is returned unchanged."""
    def scaled(length: Column) -> Column:
        return F.when(length > 0, F.transform(vec, lambda x: x / length)).otherwise(vec)

    return let(norm(vec), scaled)


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def fill(value: int | float, count: Column) -> Column:
    """``count`` copies of a value; none where the count is not positive."""
    return F.array_repeat(F.lit(value), F.greatest(count, F.lit(0)).cast("int"))


def pad_right(values: Column, length: Column | int, value: int | float) -> Column:
    size = F.lit(length) if isinstance(length, int) else length
    return F.concat(values, fill(value, size - F.size(values)))


def pad_left(values: Column, length: Column | int, value: int | float) -> Column:
    size = F.lit(length) if isinstance(length, int) else length
    return F.concat(fill(value, size - F.size(values)), values)


def softmax(logits: Column) -> Column:
    """Probabilities, shifted by the greatest logit for stability."""
    powers = let(F.array_max(logits), lambda top: F.transform(logits, lambda x: F.exp(x - top)))

    def share(values: Column) -> Column:
        return scale(values, 1.0 / F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x))

    return let(powers, share)
