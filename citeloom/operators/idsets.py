"""Sets of ids: unions, differences, intersections, and the concatenation that keeps repeats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union(*sets: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, sets).distinct()


def concatenated(*sets: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, sets)


def difference(left: DataFrame, *others: DataFrame, key: str = "id") -> DataFrame:
    return reduce(lambda kept, other: kept.join(other, key, "left_anti"), others, left.distinct())


def intersection(left: DataFrame, *others: DataFrame, key: str = "id") -> DataFrame:
    return reduce(lambda kept, other: kept.join(other, key, "left_semi"), others, left.distinct())


def sizes(named: dict[str, DataFrame]) -> DataFrame:
    """(op, n): a row a set with its size."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("op"), "n") for name, df in named.items()])
