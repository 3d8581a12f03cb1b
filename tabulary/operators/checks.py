"""Fail-closed checks. Every check is a set of violation rows: rule, key, code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ContractError
from ..functions.decoded import strip

VIOLATION_COLUMNS = ["rule", "key", "code"]


def key_text(keys: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])


def violations(df: DataFrame, keys: list[str], rules: dict[str, tuple[Column, str]]) -> DataFrame:
    """One row per row and broken rule, in a single pass over ``df``.

    ``rules`` maps a rule name to (condition that is true when broken, code).
    """
    broken = F.array(
        *[
            F.when(
                F.coalesce(condition, F.lit(False)),
                F.struct(F.lit(name).alias("rule"), F.lit(code).alias("code")),
            )
            for name, (condition, code) in rules.items()
        ]
    )
    return (
        df.select(key_text(keys).alias("key"), F.explode(F.filter(broken, lambda b: b.isNotNull())).alias("b"))
        .select("b.rule", "key", "b.code")
    )


def bad_field_violations(df: DataFrame, keys: list[str], code: str, column: str = "bad_fields") -> DataFrame:
    return df.select(F.explode(column).alias("rule"), key_text(keys).alias("key"), F.lit(code).alias("code"))


def all_violations(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def assert_clean(found: DataFrame) -> None:
    """Raise with the first codes met; runs before any write starts."""
    sample = found.limit(5).collect()
    if sample:
        detail = "; ".join(f"{row['rule']} at {row['key']}" for row in sample)
        raise ContractError(sample[0]["code"], detail)


def drop_blank_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows in which every given cell is null or white space."""
    filled = [F.when(strip(F.col(f"`{c}`")) != "", F.lit(1)) for c in columns]
    return df.filter(F.coalesce(*filled).isNotNull())


def schema_rules(schema: T.StructType) -> dict[str, tuple[Column, str]]:
    """Required fields and non-negative numbers, taken from a dataset schema."""
    rules: dict[str, tuple[Column, str]] = {}
    for field in schema.fields:
        if not field.nullable:
            rules[f"{field.name} required"] = (F.col(field.name).isNull(), "invalid_record")
        if isinstance(field.dataType, (T.IntegerType, T.LongType)) and not field.name.startswith("percentile_"):
            rules[f"{field.name} minimum"] = (F.col(field.name) < 0, "invalid_record")
        if isinstance(field.dataType, T.MapType):
            rules[f"{field.name} range"] = (~_map_in_range(F.col(field.name), field.dataType), "invalid_record")
    return rules


def _map_in_range(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.MapType):
        return F.forall(F.map_values(column), lambda v: _map_in_range(v, kind.valueType))
    return F.coalesce(column.between(0, 100_000), F.lit(False))


def range_rules(bounds: dict[str, tuple[int, int]]) -> dict[str, tuple[Column, str]]:
    return {
        f"{name} range": (F.col(name).isNotNull() & ~F.col(name).between(low, high), "out_of_range")
        for name, (low, high) in bounds.items()
    }


def key_set_differs(raw: Column, allowed: list[list[str]]) -> Column:
    """True when a JSON object's keys equal none of the allowed sets."""
    keys = F.array_sort(F.json_object_keys(raw))
    options = F.array(*[F.array(*[F.lit(k) for k in sorted(option)]) for option in allowed])
    return ~F.coalesce(F.array_contains(options, keys), F.lit(False))


def has_repeated_json_key(raw: Column) -> Column:
    """True for text that is no JSON or repeats a key inside one object."""
    return F.try_parse_json(raw).isNull() & raw.isNotNull()


def whole_period(start: Column, end: Column) -> Column:
    """Calendar year from 1 January to 31 December."""
    return (
        (F.month(start) == 1) & (F.dayofmonth(start) == 1)
        & (F.month(end) == 12) & (F.dayofmonth(end) == 31)
        & (F.year(start) == F.year(end))
    )


def period_rules(start: str, end: str, whole_years: bool = False) -> dict[str, tuple[Column, str]]:
    rules = {"period order": (F.col(start) > F.col(end), "invalid_period")}
    if whole_years:
        rules["period whole year"] = (~whole_period(F.col(start), F.col(end)), "invalid_period")
    return rules


def in_target_year(start: Column, end: Column, year: int) -> Column:
    return (start == F.make_date(F.lit(year), F.lit(1), F.lit(1))) & (
        end == F.make_date(F.lit(year), F.lit(12), F.lit(31))
    )


def has_magic(content: Column, marker: str, window: int = 1024) -> Column:
    """Marker bytes inside the first bytes of a file."""
    head = F.decode(F.substring(content, 1, window), "ISO-8859-1")
    return F.locate(marker, head) > 0


def is_pdf(content: Column) -> Column:
    return has_magic(content, "%PDF-")


def is_rate_ruling(text: Column) -> Column:
    # Fixed value: the phrase that marks a ruling with rate tables.
    return F.contains(text, F.lit("Applicable Federal Rates (AFR)"))


def count_violation(df: DataFrame, expected: int | None, code: str = "invalid_source") -> DataFrame:
    """One violation when the number of rows is not as expected, or zero."""
    total = df.agg(F.count(F.lit(1)).alias("n"))
    wrong = F.col("n") == 0 if expected is None else F.col("n") != expected
    return total.filter(wrong).select(
        F.lit("cardinality").alias("rule"), F.col("n").cast("string").alias("key"), F.lit(code).alias("code")
    )


def registry_argument_rules(year: str, periods: str, subjects: str) -> dict[str, tuple[Column, str]]:
    allowed = F.array(F.lit("afr"), F.lit("section-7520-rates"))
    return {
        "year shape": (~F.col(year).rlike("^[0-9]{4}$"), "bad_arguments"),
        "periods given": (F.size(periods) <= 0, "bad_arguments"),
        "periods shape": (~F.forall(periods, lambda p: p.rlike("^[0-9]{4}-[0-9]{2}$")), "bad_arguments"),
        "subjects given": (F.size(subjects) <= 0, "bad_arguments"),
        "subjects allowed": (F.size(F.array_except(F.col(subjects), allowed)) > 0, "bad_arguments"),
    }


def nested_complete(
    df: DataFrame, keys: list[str], expected: int, rows: DataFrame, code: str = "missing_field"
) -> DataFrame:
    """Keys whose long form lacks a cell. ``rows`` has one row per cell, null if missing."""
    return (
        rows.groupBy(*keys)
        .agg(F.count("value").alias("cells"))
        .filter(F.col("cells") != expected)
        .select(F.lit("nested completeness").alias("rule"), key_text(keys).alias("key"), F.lit(code).alias("code"))
    )
