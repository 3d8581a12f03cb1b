"""Generated tables and expanded ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def term_unitrust_factor(rate: Column, years: Column) -> Column:
    """(1 - rate/10000)^years in millionths, half up.

    The power is a double, so it goes through a decimal before it is rounded: a
    direct cast to an integer would truncate.
    """
    power = F.power(F.lit(1.0) - rate / F.lit(10_000.0), years)
    return (F.round(power.cast("decimal(38,18)"), 6) * F.lit(1_000_000)).cast("bigint")


def term_unitrust_table(spark: SparkSession) -> DataFrame:
    """Payout percentages 0.2% to 20% by terms of 1 to 20 years: 2000 rows, always."""
    return (
        spark.range(1)
        .select(F.explode(F.sequence(F.lit(20), F.lit(2000), F.lit(20))).alias("adjusted_payout_rate_basis_points"))
        .withColumn("term_years", F.explode(F.sequence(F.lit(1), F.lit(20))))
        .withColumn(
            "unitrust_remainder_factor_scaled_1e6",
            term_unitrust_factor(F.col("adjusted_payout_rate_basis_points"), F.col("term_years")),
        )
    )


def expand_years(df: DataFrame, first: str, last: str, keep: list[str]) -> DataFrame:
    """(first year, last year) to one calendar-year period per year."""
    return df.select(*keep, F.explode(F.sequence(first, last)).alias("year")).select(
        *keep,
        F.make_date("year", F.lit(1), F.lit(1)).alias("period_start_date"),
        F.make_date("year", F.lit(12), F.lit(31)).alias("period_end_date"),
    )
