"""Ordered calculations that never need a whole group in one task.

A group may hold a large share of all rows. Each calculation therefore works on
chunks of a group: a first aggregate reduces every (group, chunk) to one summary
row, a window over the summaries carries the state into each chunk, and the window
over the rows runs inside one chunk only. The chunk is any expression that does not
decrease along the order, such as the hour of a timestamp or ``key div 1000000``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def _join_carry(df: DataFrame, carry: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe join of the carried state; both sides end up clustered by the chunk."""
    renamed = carry.select(*[F.col(k).alias(f"carry_{k}") for k in keys], *[c for c in carry.columns if c not in keys])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"carry_{k}")) for k in keys])
    return df.join(renamed, condition, "left").drop(*[f"carry_{k}" for k in keys])


def _summary_window(group: list[str], ascending: bool = True) -> WindowSpec:
    order = F.col("chunk").asc_nulls_first() if ascending else F.col("chunk").desc_nulls_last()
    return Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def forward_fill(
    df: DataFrame, group: list[str], order: list[str], chunk: Column, marker: Column, name: str
) -> DataFrame:
    """Last non-null marker at or before each row, in ``order``, per group."""
    rows = df.withColumns({"chunk": chunk, "marker": marker})
    tail = F.max(F.when(F.col("marker").isNotNull(), F.struct(*order, "marker")))
    summary = rows.groupBy(*group, "chunk").agg(tail["marker"].alias("chunk_last"))
    carry = summary.select(
        *group, "chunk", F.last("chunk_last", ignorenulls=True).over(_summary_window(group)).alias("carried")
    )
    inside = Window.partitionBy(*group, "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return _join_carry(rows, carry, [*group, "chunk"]).select(
        *df.columns,
        F.coalesce(F.last("marker", ignorenulls=True).over(inside), F.col("carried")).alias(name),
    )


def suffix_sum(
    df: DataFrame, group: list[str], order: list[str], chunk: Column, value: Column, name: str
) -> DataFrame:
    """Sum of ``value`` over all later rows of the group; 0 for the last row."""
    rows = df.withColumns({"chunk": chunk, "value_": value})
    carry = (
        rows.groupBy(*group, "chunk")
        .agg(F.sum("value_").alias("total"))
        .select(*group, "chunk", F.sum("total").over(_summary_window(group, ascending=False)).alias("later"))
    )
    inside = Window.partitionBy(*group, "chunk").orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    zero = F.lit(0)
    return _join_carry(rows, carry, [*group, "chunk"]).select(
        *df.columns,
        (F.coalesce(F.sum("value_").over(inside), zero) + F.coalesce("later", zero)).alias(name),
    )


def sequence_number(
    df: DataFrame, group: list[str], order: list[str], chunk: Column, name: str
) -> DataFrame:
    """1, 2, 3 … along ``order`` in each group."""
    rows = df.withColumn("chunk", chunk)
    carry = (
        rows.groupBy(*group, "chunk")
        .agg(F.count(F.lit(1)).alias("total"))
        .select(*group, "chunk", F.sum("total").over(_summary_window(group)).alias("earlier"))
    )
    inside = Window.partitionBy(*group, "chunk").orderBy(*order)
    return _join_carry(rows, carry, [*group, "chunk"]).select(
        *df.columns,
        (F.row_number().over(inside) + F.coalesce("earlier", F.lit(0))).cast("bigint").alias(name),
    )


def unsorted_rows(df: DataFrame, group: list[str], position: str, chunk: Column, key: str) -> DataFrame:
    """Rows whose key does not rise above the key of the row before it."""
    rows = df.withColumn("chunk", chunk)
    carry = (
        rows.groupBy(*group, "chunk")
        .agg(F.max_by(key, position).alias("chunk_last"))
        .select(
            *group, "chunk",
            F.last("chunk_last").over(_summary_window(group)).alias("before_chunk"),
        )
    )
    inside = Window.partitionBy(*group, "chunk").orderBy(position)
    marked = _join_carry(rows, carry, [*group, "chunk"]).withColumn(
        "previous", F.coalesce(F.lag(key).over(inside), F.col("before_chunk"))
    )
    return marked.filter(F.col("previous") >= F.col(key)).select(*df.columns, "previous")


def first_seen(df: DataFrame, value: list[str], order: list[str], keep: list[str] = ()) -> DataFrame:
    """First row of every value. An aggregate, so copies collapse before the shuffle."""
    keep = [k for k in keep if k not in value]
    body = F.min(F.struct(*[F.col(o).alias(f"order_{i}") for i, o in enumerate(order)], *keep)).alias("first_row")
    return df.groupBy(*value).agg(body).select(*value, *[F.col(f"first_row.{k}").alias(k) for k in keep])


def latest(df: DataFrame, group: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """Row with the greatest order key per group, also by aggregate."""
    body = F.max(F.struct(*[F.col(o).alias(f"order_{i}") for i, o in enumerate(order)], *keep)).alias("last_row")
    return df.groupBy(*group).agg(body).select(*group, *[F.col(f"last_row.{k}").alias(k) for k in keep])


def life_expectancy(survivors: DataFrame, table: list[str], age: str = "age",
                    lives: str = "survivors_per_100000_scaled_1e6") -> DataFrame:
    """Curtate and complete expectation of life, in millionths of a year.

    A table has one row per age, so one window per table is small by nature. The sum
    and the quotient are over integers, rounded once.
    """
    later = Window.partitionBy(*table).orderBy(age).rowsBetween(1, Window.unboundedFollowing)
    summed = survivors.select(
        *table, age,
        F.col(lives).cast("decimal(16,0)").alias("alive"),
        F.coalesce(F.sum(lives).over(later), F.lit(0)).cast("decimal(20,0)").alias("future"),
    )
    # Half-up quotient of integers: (2 × future × 10^6 + alive) div (2 × alive).
    curtate = "CASE WHEN alive > 0 THEN (future * 2000000 + alive) div (alive * 2) ELSE 0L END"
    return summed.selectExpr(
        *table, age,
        f"{curtate} AS curtate_life_expectancy_years_scaled_1e6",
        f"CASE WHEN alive > 0 THEN {curtate} + 500000 ELSE 0L END AS complete_life_expectancy_years_scaled_1e6",
    )
