"""Orders in which records are published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def natural_sort(df: DataFrame, keys: list[str]) -> DataFrame:
    """Ascending by key; a range-partitioned sort, so no single task sees all rows."""
    return df.orderBy(*keys)


def sorted_shards(df: DataFrame, shard: str, keys: list[str]) -> DataFrame:
    """Rows ordered inside their shard; a large shard is cut into key ranges."""
    return df.repartitionByRange(shard, *keys).sortWithinPartitions(shard, *keys)


def descending_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in columns])


def sheet_number(name: Column) -> Column:
    """Number at the end of a sheet's name, so that sheet10 follows sheet9."""
    digits = F.regexp_extract(name, r"([0-9]+)(?:\.[A-Za-z]+)?$", 1)
    return F.coalesce(digits.try_cast("int"), F.lit(0))


def sheet_order(df: DataFrame, name: str) -> DataFrame:
    return df.orderBy(sheet_number(F.col(name)), F.col(name))
