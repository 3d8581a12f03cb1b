"""Shared pieces of the registered queries.

Every query reads the given tables whole. Where an operator wants text cells, feeds or
grids, Spark derives them from the tables row by row. Absent values are shown as
``ABSENT`` or ``''`` so that both engines print results alike.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ABSENT = -999999


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    covers: tuple[str, ...]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shown(df: DataFrame) -> DataFrame:
    """Plain output types: bigint, double and text, no nulls."""
    out = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            column = F.coalesce(column.cast("bigint"), F.lit(ABSENT).cast("bigint"))
        elif isinstance(field.dataType, T.DecimalType):
            column = F.coalesce(column.cast("bigint"), F.lit(ABSENT).cast("bigint"))
        elif isinstance(field.dataType, (T.StringType, T.DateType)):
            column = F.coalesce(column.cast("string"), F.lit(""))
        out.append(column.alias(field.name))
    return df.select(*out)


def num(expression: str) -> str:
    return f"COALESCE(CAST({expression} AS BIGINT), {ABSENT})"


def txt(expression: str) -> str:
    return f"COALESCE(CAST({expression} AS VARCHAR), '')"


ORDER_DAY = "CAST(o_orderdate AS DATE)"
SHIP_DAY = "CAST(l_shipdate AS DATE)"
