"""Record shapes: keys, nested rate tables, tenor arrays and canonical text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import millionths

# Tenors of the yield curve in stored order, with the feed's headers.
TENORS = (
    ("1_month", "1 Mo"),
    ("6_week", "1.5 Month"),
    ("2_month", "2 Mo"),
    ("3_month", "3 Mo"),
    ("4_month", "4 Mo"),
    ("6_month", "6 Mo"),
    ("1_year", "1 Yr"),
    ("2_year", "2 Yr"),
    ("3_year", "3 Yr"),
    ("5_year", "5 Yr"),
    ("7_year", "7 Yr"),
    ("10_year", "10 Yr"),
    ("20_year", "20 Yr"),
    ("30_year", "30 Yr"),
)
TENOR_KEYS = tuple(key for key, _ in TENORS)
# Rate families per term, and the compounding columns.
FAMILIES = {
    "short_term": ("afr", "afr_110", "afr_120", "afr_130"),
    "mid_term": ("afr", "afr_110", "afr_120", "afr_130", "afr_150", "afr_175"),
    "long_term": ("afr", "afr_110", "afr_120", "afr_130"),
}
COMPOUNDING = ("annual", "semiannual", "quarterly", "monthly")
# Factor fields that are stored as millionths.
FACTOR_FIELDS = (
    "annuity_factor", "complete_life_expectancy_years", "curtate_life_expectancy_years", "dx",
    "income_interest_factor", "life_estate_factor", "mx", "nx", "remainder_factor",
    "survivors_per_100000", "udx", "umx", "unitrust_remainder_factor", "unx",
)


def record_key(df: DataFrame) -> Column:
    """Date, else month, else period start, whichever the dataset has."""
    names = [n for n in ("date", "effective_month", "period_start_date") if n in df.columns]
    return F.coalesce(*[F.col(n).cast("string") for n in names])


def route_key(key: Column, by_year: bool) -> Column:
    """The key under which a record is looked up; year routes keep the start year."""
    if not by_year:
        return key
    return F.when(key.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.substring(key, 1, 4))


def canonical_text(columns: list[str], detail: list[str] = ()) -> Column:
    """JSON text of the value fields; the detail group appears when any of it is set."""
    plain = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    if not detail:
        return plain
    full = F.to_json(F.struct(*columns, *detail), {"ignoreNullFields": "false"})
    return F.when(F.coalesce(*[F.col(c).cast("string") for c in detail]).isNotNull(), full).otherwise(plain)


def tenor_array(columns: list[Column]) -> Column:
    return F.array(*columns)


def tenor_map(values: Column, keys: tuple[str, ...] = TENOR_KEYS) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), values)


def tenor_rows(
    df: DataFrame, keep: list[str], values: str, keys: tuple[str, ...] = TENOR_KEYS
) -> DataFrame:
    """One row per tenor: position, name and rate."""
    names = F.array(*[F.lit(k) for k in keys])
    return df.select(*keep, F.posexplode(values).alias("tenor_index", "rate")).withColumn(
        "tenor", F.element_at(names, F.col("tenor_index") + 1)
    )


def nested_rows(
    df: DataFrame,
    keep: list[str],
    column: str,
    families: dict[str, tuple[str, ...]] = FAMILIES,
    compounding: tuple[str, ...] = COMPOUNDING,
) -> DataFrame:
    """Three-level struct to rows (term, family, compounding, value)."""
    cells = [
        F.struct(
            F.lit(term).alias("term"),
            F.lit(family).alias("family"),
            F.lit(name).alias("compounding"),
            F.col(f"{column}.{term}.{family}.{name}").cast("bigint").alias("value"),
        )
        for term, names in families.items()
        for family in names
        for name in compounding
    ]
    return df.select(*keep, F.inline(F.array(*cells)))


def nested_struct(
    value,
    families: dict[str, tuple[str, ...]] = FAMILIES,
    compounding: tuple[str, ...] = COMPOUNDING,
) -> Column:
    """Build the struct from ``value(term, family, compounding) -> Column``."""
    return F.struct(
        *[
            F.struct(
                *[
                    F.struct(*[value(term, family, c).alias(c) for c in compounding]).alias(family)
                    for family in names
                ]
            ).alias(term)
            for term, names in families.items()
        ]
    )


def scale_factors(df: DataFrame, fields: tuple[str, ...] = FACTOR_FIELDS) -> DataFrame:
    """Rename factor fields to ``*_scaled_1e6`` and store them as millionths."""
    out = []
    for field in df.schema.fields:
        if field.name in fields:
            unit = field.metadata.get("unit", "decimal")
            out.append(
                millionths(F.col(field.name)).alias(
                    f"{field.name}_scaled_1e6",
                    metadata={"unit": f"{unit}_scaled_1e6", "scale": "stored value / 1000000"},
                )
            )
        else:
            out.append(F.col(field.name))
    return df.select(*out)


def numeric_key_entries(values: Column) -> Column:
    """Map entries as an array ordered by key as a number."""
    return F.array_sort(
        F.transform(
            F.map_entries(values),
            lambda e: F.struct(e["key"].try_cast("bigint").alias("key"), e["value"].alias("value")),
        )
    )


def classify_table(table_id: Column, source: Column) -> Column:
    """Structure, sex, smoker, age basis and relative risk from a mortality table id.

    Null for an id that fits no family.
    """
    # The three table families and the shape of their ids.
    distinct = r"^2015_vbt_smoker_distinct_tables__2015_([fm])(ns|sm)_(alb|anb)$"
    unismoke = r"^2015_vbt_unismoke_tables__2015_(female|male)_composite_(alb|anb)$"
    relative = r"^2015_vbt_relative_risk_tables__2015_(female|male)_(non_smoker|smoker)_rr([0-9]+)_(alb|anb)$"

    def described(structure, sex, smoker, basis, risk) -> Column:
        return F.struct(
            F.lit(structure).alias("structure"),
            sex.alias("sex"),
            smoker.alias("smoker"),
            basis.alias("age_basis"),
            risk.cast("int").alias("relative_risk_percent"),
        )

    def part(shape: str, group: int) -> Column:
        return F.regexp_extract(table_id, shape, group)

    none = F.lit(0)
    return (
        F.when(
            (source == "2015 VBT Smoker-Distinct Tables") & table_id.rlike(distinct),
            described(
                "smoker_distinct",
                F.when(part(distinct, 1) == "f", F.lit("female")).otherwise(F.lit("male")),
                F.when(part(distinct, 2) == "ns", F.lit("non_smoker")).otherwise(F.lit("smoker")),
                part(distinct, 3),
                none,
            ),
        )
        .when(
            (source == "2015 VBT Unismoke Tables") & table_id.rlike(unismoke),
            described("unismoke", part(unismoke, 1), F.lit("composite"), part(unismoke, 2), none),
        )
        .when(
            (source == "2015 VBT Relative Risk Tables") & table_id.rlike(relative),
            described(
                "relative_risk", part(relative, 1), part(relative, 2), part(relative, 4),
                part(relative, 3).try_cast("int"),
            ),
        )
    )
