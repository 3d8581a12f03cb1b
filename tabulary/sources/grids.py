"""Workbook cells in long form to factor tables.

Input columns: workbook, sheet, row, col, value (text) and optionally is_number.
A sheet is bounded by its file format, so cells are placed by (workbook, sheet) once
and the per-row grouping and the section windows reuse that placement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.decoded import strip
from ..functions.numbers import cell_factor, cell_integer, cell_is_number, cell_rate, millionths
from ..operators import checks
from ..operators.aggregates import duplicate_keys

SHEET = ["workbook", "sheet"]
ROW = [*SHEET, "row"]


def _cells(cells: DataFrame) -> DataFrame:
    """Cells with their number reading, clustered by sheet."""
    if "is_number" not in cells.columns:
        cells = cells.withColumn("is_number", cell_is_number(F.col("value")))
    return cells.repartition(*SHEET).withColumns(
        {
            "as_int": cell_integer(F.col("value"), F.col("is_number")),
            "as_factor": cell_factor(F.col("value")),
            "as_rate": cell_rate(F.col("value"), F.col("is_number")),
        }
    )


def _at(col: int, field: str) -> Column:
    return F.max(F.when(F.col("col") == col, F.col(field)))


def _blocks(layout: dict[int, tuple[str, dict[str, int]]]) -> list[Column]:
    """Aggregates that read side-by-side blocks of one row.

    ``layout`` maps an offset to (integer field, {factor field: distance}).
    """
    out = []
    for offset, (key, factors) in layout.items():
        out.append(
            F.struct(
                F.lit(offset).alias("offset"),
                _at(offset, "as_int").alias(key),
                *[_at(offset + distance, "as_factor").alias(name) for name, distance in factors.items()],
            ).alias(f"block_{offset}")
        )
    return out


def _block_rows(rows: DataFrame, keep: list[str], offsets: tuple[int, ...], key: str, factors: list[str]) -> DataFrame:
    """One output row per block in which the key and all factors parse."""
    exploded = rows.select(*keep, F.inline(F.array(*[F.col(f"block_{o}") for o in offsets])))
    complete = F.col(key).isNotNull()
    for name in factors:
        complete = complete & F.col(name).isNotNull()
    return exploded.filter(complete)


def _scaled(names: list[str]) -> list[Column]:
    return [millionths(F.col(n)).alias(f"{n}_scaled_1e6") for n in names]


def check_factor_rows(rows: DataFrame, keys: list[str], factors: list[str]) -> DataFrame:
    """Repeated keys and negative factors, as violations."""
    repeated = duplicate_keys(rows, keys).select(
        F.lit("repeated key").alias("rule"), checks.key_text(keys).alias("key"), F.lit("duplicate_record").alias("code")
    )
    negative = checks.violations(
        rows, keys, {f"{n} sign": (F.col(f"{n}_scaled_1e6").isNull(), "invalid_source") for n in factors}
    )
    return checks.all_violations(repeated, negative)


def mortality_rows(cells: DataFrame) -> DataFrame:
    """Three side-by-side (age, lives) blocks."""
    offsets, name = (1, 5, 9), "survivors_per_100000"
    rows = _cells(cells.filter(F.col("col").isin(1, 2, 5, 6, 9, 10))).groupBy(*ROW).agg(
        *_blocks({o: ("age", {name: 1}) for o in offsets})
    )
    return _block_rows(rows, ["workbook"], offsets, "age", [name]).select(
        "workbook", F.col("age").cast("int").alias("age"), *_scaled([name])
    )


def _marked_rows(cells: DataFrame, marker: Column, blocks: list[Column]) -> DataFrame:
    """Rows with blocks, and the last marker at or before each row of the sheet."""
    rows = _cells(cells).groupBy(*ROW).agg(
        F.max(F.when(marker.isNotNull(), F.struct(F.col("col"), marker.alias("rate"))))["rate"].alias("marker"), *blocks
    )
    above = Window.partitionBy(*SHEET).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("rate", F.last("marker", ignorenulls=True).over(above)).filter(F.col("rate").isNotNull())


def single_life_rows(cells: DataFrame) -> DataFrame:
    """Annuity, life estate and remainder by rate and age."""
    names, offsets = ["annuity_factor", "life_estate_factor", "remainder_factor"], (0, 4)
    marker = F.when(~F.col("is_number") & F.contains("value", F.lit("Interest at")), F.col("as_rate"))
    layout = {o: ("age", {n: i + 1 for i, n in enumerate(names)}) for o in offsets}
    rows = _marked_rows(cells, marker, _blocks(layout))
    return _block_rows(rows, ["rate"], offsets, "age", names).select(
        F.col("rate").alias("interest_rate_basis_points"), F.col("age").cast("int").alias("age"), *_scaled(names)
    )


def commutation_rows(cells: DataFrame, phrase: str, rate_column: str, prefix: str) -> DataFrame:
    """Dx, Nx and Mx columns by rate and age; ``prefix`` is ``u`` for unitrust tables."""
    names, offsets = [f"{prefix}dx", f"{prefix}nx", f"{prefix}mx"], (0, 8)
    title = F.regexp_extract("value", r"Table [A-Z]\(([0-9]+(?:[.][0-9]+)?)\)", 1)
    titled = F.when(
        ~F.col("is_number") & (title != ""),
        F.bround(title.try_cast("decimal(12,6)") * F.lit(100).cast("decimal(6,0)"), 0).try_cast("int"),
    )
    phrased = F.when(~F.col("is_number") & F.contains("value", F.lit(phrase)), F.col("as_rate"))
    layout = {o: ("age", {n: 2 * (i + 1) for i, n in enumerate(names)}) for o in offsets}
    rows = _marked_rows(cells, F.coalesce(titled, phrased), _blocks(layout))
    return _block_rows(rows, ["rate"], offsets, "age", names).select(
        F.col("rate").alias(rate_column), F.col("age").cast("int").alias("age"), *_scaled(names)
    )


def term_certain_rows(cells: DataFrame) -> DataFrame:
    """Sections that start with a title row; their percentages sit two rows below it."""
    names, offsets = ["annuity_factor", "income_interest_factor", "remainder_factor"], (0, 8)
    layout = {o: ("term_years", {n: 2 * (i + 1) for i, n in enumerate(names)}) for o in offsets}
    rows = _cells(cells).groupBy(*ROW).agg(
        F.max(F.when((F.col("col") == 0) & (F.col("value") == "Table B"), F.col("row"))).alias("title"),
        _at(4, "as_rate").alias("rate_0"), _at(12, "as_rate").alias("rate_8"), *_blocks(layout),
    )
    above = Window.partitionBy(*SHEET).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    section = Window.partitionBy(*SHEET, "section")
    at_rates = F.col("row") == F.col("section") + 2
    rows = (
        rows.withColumn("section", F.last("title", ignorenulls=True).over(above))
        .filter(F.col("section").isNotNull())
        .withColumns({f"in_force_{o}": F.max(F.when(at_rates, F.col(f"rate_{o}"))).over(section) for o in offsets})
        .filter(F.col("row") >= F.col("section") + 4)
    )
    blocks = _block_rows(rows, ["in_force_0", "in_force_8"], offsets, "term_years", names)
    rate = F.when(F.col("offset") == 0, F.col("in_force_0")).otherwise(F.col("in_force_8"))
    return blocks.withColumn("rate", rate).filter(F.col("rate").isNotNull()).select(
        F.col("rate").alias("interest_rate_basis_points"), F.col("term_years").cast("int").alias("term_years"),
        *_scaled(names),
    )


def _headed_rows(cells: DataFrame, is_header: Column, first: int, keys: list[str]) -> DataFrame:
    """Factor cells with the rate that the nearest header row above gives their column.

    ``is_header`` is an aggregate over the cells of a row. A row has at most as many
    cells as a sheet has columns, so its cells fit one map.
    """
    def by_column(field: str) -> Column:
        kept = (F.col("col") >= first) & F.col(field).isNotNull()
        return F.map_from_entries(F.collect_list(F.when(kept, F.struct("col", field))))

    rows = _cells(cells).groupBy(*ROW).agg(
        F.coalesce(is_header, F.lit(False)).alias("is_header"),
        by_column("as_factor").alias("body"), by_column("as_rate").alias("heads"),
        *[_at(col, "as_int").alias(name) for col, name in enumerate(keys)],
    )
    above = Window.partitionBy(*SHEET).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    in_force = F.last(F.when(F.col("is_header"), F.col("heads")), ignorenulls=True).over(above)
    data = ~F.col("is_header") & F.col("in_force").isNotNull()
    for name in keys:
        data = data & F.col(name).isNotNull()
    return (
        rows.withColumn("in_force", in_force)
        .filter(data)
        .select(
            *[F.col(name).cast("int").alias(name) for name in keys], "in_force",
            F.explode("body").alias("col", "factor"),
        )
        .withColumn("rate", F.try_element_at("in_force", F.col("col")))
        .filter(F.col("rate").isNotNull())
    )


def one_life_unitrust_rows(cells: DataFrame) -> DataFrame:
    """Percentages in the row that starts with Age; ages below."""
    header = F.max((F.col("col") == 0) & (F.col("value") == "Age"))
    return _headed_rows(cells, header, 1, ["age"]).select(
        F.col("rate").alias("adjusted_payout_rate_basis_points"), "age",
        millionths(F.col("factor")).alias("unitrust_remainder_factor_scaled_1e6"),
    )


def two_life_rows(cells: DataFrame, rate_column: str, factor: str) -> DataFrame:
    """Percentages in the row that starts with O, Y; the header starts afresh on every sheet."""
    def says(col: int, word: str) -> Column:
        return F.max((F.col("col") == col) & (strip(F.col("value")) == word))

    return _headed_rows(cells, says(0, "O") & says(1, "Y"), 2, ["older_age", "younger_age"]).select(
        F.col("rate").alias(rate_column), "older_age", "younger_age",
        millionths(F.col("factor")).alias(f"{factor}_scaled_1e6"),
    )
