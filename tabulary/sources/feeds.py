"""CSV feeds: the daily yield curve and the overnight percentages."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ContractError
from ..functions import dates, numbers, text
from ..functions.decoded import Decoded, required, with_decoded
from ..functions.records import TENORS
from ..operators import checks
from ..operators.aggregates import duplicate_keys
from ..operators.merge import MergeResult, combine_partial
from ..operators.sets import union_sources

# The 19 headers of the overnight feed, in order.
OVERNIGHT_HEADERS = (
    "Effective Date",
    "Rate Type",
    "Rate (%)",
    "1st Percentile (%)",
    "25th Percentile (%)",
    "75th Percentile (%)",
    "99th Percentile (%)",
    "Volume ($Billions)",
    "Target Rate From (%)",
    "Target Rate To (%)",
    "Intra Day - Low (%)",
    "Intra Day - High (%)",
    "Standard Deviation (%)",
    "30-Day Average SOFR",
    "90-Day Average SOFR",
    "180-Day Average SOFR",
    "SOFR Index",
    "Revision Indicator (Y/N)",
    "Footnote ID",
)
CORRUPT = "_extra_cells"
OBSERVED = (
    "rate_basis_points", "percentile_1_basis_points", "percentile_25_basis_points",
    "percentile_75_basis_points", "percentile_99_basis_points", "volume_billions",
)
AVERAGED = (
    "average_30_day_basis_points_scaled_1000", "average_90_day_basis_points_scaled_1000",
    "average_180_day_basis_points_scaled_1000", "sofr_index_scaled_100000000",
)
NOTES = ("revision_indicator", "footnote_id")
WIDE_VALUES = [*OBSERVED, *AVERAGED]


def _text_schema(headers: list[str], within: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType([*[T.StructField(h, T.StringType()) for h in [*headers, CORRUPT]], *[T.StructField(w, T.LongType()) for w in within]])


def clean_headers(headers: list[str]) -> list[str]:
    return [h.strip().removeprefix("\ufeff") for h in headers]


def header_groups(spark: SparkSession, path: str, first: str) -> dict[tuple[str, ...], list[str]]:
    """Files of a feed grouped by header line, since published columns change over time.

    The header of a file is its one line whose first cell is ``first``; files are few
    and one short line each comes back.
    """
    cell = rf"^\ufeff?\s*\"?\ufeff?{first}\"?\s*(,|$)"
    lines = (
        spark.read.text(path)
        .select(F.col("_metadata.file_path").alias("file"), "value")
        .filter(F.col("value").rlike(cell))
        .distinct()
    )
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in lines.collect():
        headers = tuple(clean_headers(next(csv.reader([row["value"]]))))
        groups.setdefault(headers, []).append(row["file"])
    if not groups:
        raise ContractError("invalid_csv", "no header line")
    return groups


def check_curve_headers(headers: list[str]) -> None:
    allowed = {"Date", *[header for _, header in TENORS]}
    if "Date" not in headers or len(set(headers)) != len(headers) or not set(headers) <= allowed:
        raise ContractError("invalid_csv", "yield curve headers")


def check_overnight_headers(headers: list[str]) -> None:
    if tuple(headers) != OVERNIGHT_HEADERS:
        raise ContractError("invalid_csv", "overnight headers")


def read_cells(
    spark: SparkSession, path: str, headers: list[str], files: list[str] | None = None, within: tuple[str, ...] = (),
) -> DataFrame:
    """All cells as text, rows with surplus cells marked, blank rows dropped.

    ``files`` are those below ``path`` to read, if not all. ``within`` names the partition folders, as numbers, that tell
    several feeds below one path apart.
    """
    rows = (
        spark.read.schema(_text_schema(headers, within))
        .options(**({"basePath": path} if within else {}))
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .csv(files or path)
    )
    return checks.drop_blank_rows(rows, headers)


def _surplus() -> Column:
    """A row with more cells than headers; a row with fewer is not surplus."""
    return F.col(CORRUPT).isNotNull()


def decode_curve(rows: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """date, 14 tenor columns, and ``bad_fields``."""
    columns: dict[str, Decoded] = {"date": dates.slash_date(F.col("Date"))}
    for key, header in TENORS:
        cell = F.col(f"`{header}`") if header in rows.columns else F.lit(None).cast("string")
        columns[key] = numbers.percent_basis_points(cell)
    out = with_decoded(rows, columns)
    return out.select(
        *within, "date", *[F.col(key).cast("int").alias(key) for key, _ in TENORS], "bad_fields",
        *([CORRUPT] if CORRUPT in rows.columns else []),
    )


def curve_records(decoded: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    return decoded.select(*within, "date", F.array(*[F.col(key) for key, _ in TENORS]).alias("par_yields_basis_points"))


def feed_violations(decoded: DataFrame, keys: list[str]) -> DataFrame:
    """Bad cells and surplus cells (no shuffle), and repeated keys (one shuffle)."""
    parts = [checks.bad_field_violations(decoded, keys, "invalid_csv")]
    if CORRUPT in decoded.columns:
        parts.append(checks.violations(decoded, keys, {"surplus cells": (_surplus(), "invalid_csv")}))
    parts.append(
        duplicate_keys(decoded, keys).select(
            F.lit("repeated key").alias("rule"), checks.key_text(keys).alias("key"),
            F.lit("duplicate_source_record").alias("code"),
        )
    )
    parts.append(checks.count_violation(decoded, None, "invalid_csv"))
    return checks.all_violations(*parts)


def read_curve(spark: SparkSession, path: str, within: tuple[str, ...] = ()) -> DataFrame:
    """Yield-curve feed to (date, par_yields_basis_points), checked. With ``within``, a date is one of its own feed."""
    parts = []
    for headers, files in header_groups(spark, path, "Date").items():
        check_curve_headers(list(headers))
        parts.append(decode_curve(read_cells(spark, path, list(headers), files, within), within))
    decoded = union_sources(*parts)
    checks.assert_clean(feed_violations(decoded, [*within, "date"]))
    return curve_records(decoded, within)


def decode_overnight(rows: DataFrame, rate_type: str, within: tuple[str, ...] = ()) -> DataFrame:
    """date, rate_basis_points and ``bad_fields``; a foreign rate type is bad."""
    out = with_decoded(
        rows,
        {
            "date": dates.padded_slash_date(F.col("Effective Date")),
            "rate_type": required(F.when(F.col("Rate Type") == rate_type, F.col("Rate Type"))),
            "rate_basis_points": numbers.percent_basis_points(F.col("Rate (%)")),
        },
    )
    return out.select(
        *within, "date", F.col("rate_basis_points").cast("int").alias("rate_basis_points"), "bad_fields",
        *([CORRUPT] if CORRUPT in rows.columns else []),
    )


def read_overnight(spark: SparkSession, path: str, rate_type: str = "EFFR", within: tuple[str, ...] = ()) -> DataFrame:
    for headers in header_groups(spark, path, "Effective Date"):
        check_overnight_headers(list(headers))
    decoded = decode_overnight(read_cells(spark, path, list(OVERNIGHT_HEADERS), within=within), rate_type, within)
    checks.assert_clean(feed_violations(decoded, [*within, "date"]))
    return decoded.select(*within, "date", "rate_basis_points")


def decode_mixed(rows: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Partial rows of the secured rate: observations and averages, other types skipped."""
    observed = F.col("Rate Type") == "SOFR"
    wanted = rows.filter(F.col("Rate Type").isin("SOFR", "SOFRAI"))

    def only(condition: Column, header: str) -> Column:
        return F.when(condition, F.col(f"`{header}`"))

    columns: dict[str, Decoded] = {
        "date": dates.padded_slash_date(F.col("Effective Date")),
        "rate_basis_points": numbers.percent_basis_points(only(observed, "Rate (%)")),
    }
    for nth in ("1st", "25th", "75th", "99th"):
        name = f"percentile_{nth[:-2]}_basis_points"
        columns[name] = numbers.signed_percent_basis_points(only(observed, f"{nth} Percentile (%)"))
    columns["volume_billions"] = numbers.count_value(only(observed, "Volume ($Billions)"))
    for days in (30, 90, 180):
        columns[f"average_{days}_day_basis_points_scaled_1000"] = numbers.percent_basis_points_thousandths(
            only(~observed, f"{days}-Day Average SOFR")
        )
    columns["sofr_index_scaled_100000000"] = numbers.index_hundred_millionths(only(~observed, "SOFR Index"))
    columns["revision_indicator"] = text.revision_flag(F.col("Revision Indicator (Y/N)"))
    columns["footnote_id"] = text.identifier(F.col("Footnote ID"))
    out = with_decoded(wanted, columns)
    return out.select(
        *within, *columns, F.col("Rate Type").alias("rate_type"), "bad_fields",
        *([CORRUPT] if CORRUPT in rows.columns else []),
    )


def combine_mixed(decoded: DataFrame, within: tuple[str, ...] = ()) -> MergeResult:
    """One wide row per date; unequal values of one field conflict."""
    return combine_partial(decoded, [*within, "date"], [*WIDE_VALUES, *NOTES])


def read_mixed(spark: SparkSession, path: str, within: tuple[str, ...] = ()) -> DataFrame:
    for headers in header_groups(spark, path, "Effective Date"):
        check_overnight_headers(list(headers))
    decoded = decode_mixed(read_cells(spark, path, list(OVERNIGHT_HEADERS), within=within), within)
    checks.assert_clean(feed_violations(decoded, [*within, "date", "rate_type"]))
    return combine_mixed(decoded, within).checked()


def observations(wide: DataFrame) -> DataFrame:
    """Published secured-rate rows: those with a rate."""
    return wide.filter(F.col("rate_basis_points").isNotNull()).select("date", *OBSERVED)


def metric_rows(wide: DataFrame, metrics: list[str] = list(AVERAGED), keys: list[str] = ["date"]) -> DataFrame:
    """One row per date and metric, nulls dropped, in one pass."""
    return (
        wide.select(*keys, *[F.col(m).cast("bigint").alias(m) for m in metrics])
        .unpivot(keys, metrics, "metric", "value")
        .filter(F.col("value").isNotNull())
    )
