"""Unions, differences and distinct values of tables and of list columns."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_tagged(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """All parts' rows, each with its part's name in the column ``tag``. The parts have the same columns."""
    return functools.reduce(DataFrame.unionByName, [df.withColumn(tag, F.lit(name)) for name, df in parts.items()])


def difference(a: Column, b: Column) -> Column:
    """The distinct values of ``a`` that ``b`` has not, sorted."""
    return F.array_sort(F.array_except(a, b))


def merged(a: Column, b: Column) -> Column:
    """The distinct values of both, sorted."""
    return F.array_sort(F.array_union(a, b))


def shared(a: Column, b: Column) -> Column:
    """The distinct values that both have, sorted."""
    return F.array_sort(F.array_intersect(a, b))


def distinct_targets(df: DataFrame, target: str) -> DataFrame:
    return df.select(F.col(target).alias("target")).distinct()
