"""Unions, key differences and set equality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_sources(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def key_difference(present: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys that are present but not expected."""
    return present.select(*keys).distinct().join(expected.select(*keys).distinct(), keys, "left_anti")


def key_status(present: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Every key with where it occurs: both, stale (present only) or missing."""
    return (
        present.select(*keys, F.lit(1).alias("p"), F.lit(0).alias("e"))
        .unionByName(expected.select(*keys, F.lit(0).alias("p"), F.lit(1).alias("e")))
        .groupBy(*keys)
        .agg(F.max("p").alias("p"), F.max("e").alias("e"))
        .select(
            *keys,
            F.when((F.col("p") == 1) & (F.col("e") == 1), "both").when(F.col("p") == 1, "stale")
            .otherwise("missing").alias("status"),
        )
    )


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> bool:
    return key_status(left, right, keys).filter("status <> 'both'").isEmpty()
