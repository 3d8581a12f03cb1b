"""Queries over old shapes of monthly, daily and nested records; wrong shapes are counted by the rule they break."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import COMPOUNDING, FAMILIES, TENOR_KEYS
from ..sources import migrate
from .common import ABSENT, ORDER_DAY, Query, shown, table

ORDER_MONTH = "substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7)"
ORDER_MONTH_SQL = "strftime(CAST(o_orderdate AS DATE), '%Y-%m')"


def _counted(records: DataFrame, problems: DataFrame) -> DataFrame:
    """Equal records and, below them, broken rules, with how many there are."""
    found = records.groupBy(*records.columns).agg(F.count(F.lit(1)).alias("n")).withColumn("rule", F.lit(""))
    broken = problems.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    return shown(found.unionByName(broken, allowMissingColumns=True))


def migrate_months(spark, folder):
    """Monthly percentages under their present and former names; one stored mistake is put right."""
    now = f"named_struct('effective_month', {ORDER_MONTH}, 'midterm_afr_120_basis_points', o_custkey % 900, 'section_7520_rate_basis_points', o_custkey % 800"
    raw = table(spark, folder, "orders").selectExpr(
        f"CASE o_orderkey % 6 WHEN 0 THEN to_json({now})) "
        f"WHEN 1 THEN to_json(named_struct('valuation_month', {ORDER_MONTH}, 'applicable_federal_midterm_120_percent_basis_points', o_custkey % 900, "
        "'section_7520_rate_basis_points', o_custkey % 800, 'revenue_ruling', 'Rev. Rul. 2019-8')) "
        f"WHEN 2 THEN to_json({now}, 'seq', o_orderkey)) "
        f"WHEN 3 THEN to_json({now}, 'source_url', 'https://example.com/rates')) "
        "WHEN 4 THEN to_json(named_struct('effective_month', '2014-10', 'midterm_afr_120_basis_points', 222, 'section_7520_rate_basis_points', 222 + o_custkey % 2)) "
        f"ELSE to_json(named_struct('effective_month', {ORDER_DAY}, 'midterm_afr_120_basis_points', o_custkey % 900)) END AS json"
    )
    return _counted(*migrate.migrate_monthly(raw))


MONTHS_SQL = f"""
WITH r AS (SELECT o_orderkey % 6 AS s, CASE o_orderkey % 6 WHEN 4 THEN '2014-10' WHEN 5 THEN CAST({ORDER_DAY} AS VARCHAR) ELSE {ORDER_MONTH_SQL} END AS m,
             CASE WHEN o_orderkey % 6 = 4 THEN 222 ELSE o_custkey % 900 END AS a,
             CASE o_orderkey % 6 WHEN 4 THEN CASE WHEN o_custkey % 2 = 0 THEN 220 ELSE 223 END WHEN 5 THEN {ABSENT} ELSE o_custkey % 800 END AS b FROM orders)
SELECT m AS effective_month, a AS midterm_afr_120_basis_points, b AS section_7520_rate_basis_points, count(*) AS n, '' AS rule FROM r GROUP BY 1, 2, 3
UNION ALL SELECT '', {ABSENT}, {ABSENT}, count(*), rule
FROM r, (VALUES (2, 'keys'), (3, 'source url'), (5, 'keys'), (5, 'month'), (5, 'section rate')) v(k, rule) WHERE s = k GROUP BY rule"""


def migrate_curves(spark, folder):
    """Yields by tenor name, as a list, a list that is too short, and a yield that is no integer."""
    names = ", ".join(f"'{k}'" for k in TENOR_KEYS)
    listed = f"transform(sequence(1, {len(TENOR_KEYS)}), i -> (o_custkey + i) % 900)"
    raw = table(spark, folder, "orders").selectExpr(
        f"CASE o_orderkey % 4 WHEN 0 THEN to_json(named_struct('date', {ORDER_DAY}, 'par_yields_basis_points', map_from_arrays(array({names}), {listed}))) "
        f"WHEN 1 THEN to_json(named_struct('date', {ORDER_DAY}, 'par_yields_basis_points', {listed}, 'source_url', 'u')) "
        f"WHEN 2 THEN to_json(named_struct('date', {ORDER_DAY}, 'par_yields_basis_points', slice({listed}, 1, 13))) "
        f"ELSE to_json(named_struct('date', {ORDER_MONTH}, 'par_yields_basis_points', {listed}, 'seq', 1)) END AS json"
    )
    records, problems = migrate.migrate_curve(raw)
    ends = {"first_yield": F.try_element_at("par_yields_basis_points", F.lit(1)), "last_yield": F.try_element_at("par_yields_basis_points", F.lit(len(TENOR_KEYS)))}
    return _counted(records.select("date", *[v.alias(k) for k, v in ends.items()]), problems)


CURVES_SQL = f"""
WITH r AS (SELECT o_orderkey % 4 AS s, CASE WHEN o_orderkey % 4 = 3 THEN '' ELSE CAST({ORDER_DAY} AS VARCHAR) END AS d, (o_custkey + 1) % 900 AS a,
             CASE WHEN o_orderkey % 4 = 2 THEN {ABSENT} ELSE (o_custkey + {len(TENOR_KEYS)}) % 900 END AS b FROM orders)
SELECT d AS date, a AS first_yield, b AS last_yield, count(*) AS n, '' AS rule FROM r GROUP BY 1, 2, 3
UNION ALL SELECT '', {ABSENT}, {ABSENT}, count(*), rule FROM r, (VALUES (2, 'tenors'), (3, 'keys'), (3, 'date')) v(k, rule) WHERE s = k GROUP BY rule"""


def migrate_nested_months(spark, folder):
    """Nested monthly tables with and without ruling and address; one lacks a family, one has a cell out of range."""

    def cells(first: int):
        return F.struct(*[(F.col("rate") + first + i).alias(c) for i, c in enumerate(COMPOUNDING)])

    def terms(families: dict[str, tuple[str, ...]]) -> Column:
        return F.struct(*[F.struct(*[cells(i).alias(f) for i, f in enumerate(fs)]).alias(t) for t, fs in families.items()])

    adjusted = F.struct(*[cells(0).alias(t) for t in FAMILIES]).alias("adjusted_applicable_federal_rates")
    month, ruling, url = F.col("month").alias("effective_month"), F.lit("Rev. Rul. 2019-8").alias("revenue_ruling"), F.lit("u").alias("source_url")
    whole = terms(FAMILIES).alias("applicable_federal_rates")
    part = terms({**FAMILIES, "long_term": FAMILIES["long_term"][:-1]}).alias("applicable_federal_rates")
    rows = table(spark, folder, "orders").selectExpr(
        "CAST(o_orderkey % 5 AS INT) AS shape", f"{ORDER_MONTH} AS month", "o_custkey % 800 + CASE WHEN o_orderkey % 5 = 4 THEN 1000000 ELSE 0 END AS rate")
    json = F.when(F.col("shape") == 1, F.to_json(F.struct(month, whole, adjusted, ruling))).when(
        F.col("shape") == 2, F.to_json(F.struct(month, whole, adjusted, ruling, url))).when(
        F.col("shape") == 3, F.to_json(F.struct(month, part, adjusted))).otherwise(F.to_json(F.struct(month, whole, adjusted)))
    records, problems = migrate.migrate_nested(rows.select(json.alias("json")))
    picked = records.select(
        "effective_month", F.col("applicable_federal_rates.short_term.afr.annual").cast("bigint").alias("short_annual"),
        F.col("applicable_federal_rates.long_term.afr_130.monthly").cast("bigint").alias("long_130_monthly"),
        F.col("adjusted_applicable_federal_rates.mid_term.quarterly").cast("bigint").alias("adjusted_mid_quarterly"))
    return _counted(picked, problems)


NESTED_MONTHS_SQL = f"""
WITH r AS (SELECT o_orderkey % 5 AS s, {ORDER_MONTH_SQL} AS m, o_custkey % 800 + CASE WHEN o_orderkey % 5 = 4 THEN 1000000 ELSE 0 END AS v FROM orders)
SELECT m AS effective_month, v AS short_annual, CASE WHEN s = 3 THEN {ABSENT} ELSE v + 6 END AS long_130_monthly, v + 2 AS adjusted_mid_quarterly, count(*) AS n, '' AS rule
FROM r GROUP BY 1, 2, 3, 4
UNION ALL SELECT '', {ABSENT}, {ABSENT}, {ABSENT}, count(*), rule
FROM r, (VALUES (3, 'long_term families'), (3, 'cells'), (4, 'cells')) w(k, rule) WHERE s = k GROUP BY rule"""


QUERIES = {
    "migrate_months": Query(migrate_months, MONTHS_SQL, ("PRJ-32",)),
    "migrate_curves": Query(migrate_curves, CURVES_SQL, ("PRJ-32", "PRJ-26")),
    "migrate_nested_months": Query(migrate_nested_months, NESTED_MONTHS_SQL, ("PRJ-32", "FLT-8")),
}
