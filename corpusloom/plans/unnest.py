"""Rows out of arrays, without the array being computed twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unnest(df: DataFrame, array: Column | str, *keep: Column | str, value: str = "value", pos: str | None = None) -> DataFrame:
    """``keep``, the place ``pos`` if named, and ``value`` for every element; empty arrays go.

    A plain explode makes the optimizer add a filter on the array's size and push it below the
    projection, where the array - a whole tokenized text - is built a second time. The outer form
    has no such filter; the row it gives for an empty array is dropped afterwards.
    """
    if pos is None:
        rows = df.select(*keep, F.explode_outer(array).alias(value))
        return rows.filter(F.col(value).isNotNull())
    rows = df.select(*keep, F.posexplode_outer(array).alias(pos, value)).filter(F.col(pos).isNotNull())
    return rows.withColumn(pos, F.col(pos).cast("bigint"))
