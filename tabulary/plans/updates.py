"""Update jobs: scan, check, merge, publish. Each returns its run metrics.

A feed touches few shards of a long history. The touched shards are found first and
only they are read, merged and compared; the rest of the history is neither scanned
nor rewritten.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import checks
from ..operators.generate import term_unitrust_table
from ..operators.joins import apply_corrections, drop_overlapped
from ..operators.merge import MergeResult, enriching_merge, strict_merge, tolerant_merge
from ..operators.windows import life_expectancy
from ..registry import DATASETS, TABLE_SCHEMA, Dataset, dataset
from ..sources import feeds, grids, pages, prose, rulings, seeds, shards
from .store import Published, ShardStore, commit_together

# Fixed value: how many mortality tables the published set has.
TABLE_COUNT = 68
WIDE_SCHEMA = T.StructType(
    [T.StructField("date", T.DateType(), False)]
    + [T.StructField(name, T.LongType(), True) for name in feeds.WIDE_VALUES]
)


@dataclass(frozen=True)
class RunMetrics:
    source: int
    existing: int
    final: int
    changed: bool


def merge_and_publish(
    store: ShardStore, source: DataFrame, merge, touched: list[str] | None = None, adjust=None,
    batch: tuple[str, int] | None = None,
) -> RunMetrics:
    """Merge a feed into the touched shards; nothing is written unless it is clean.

    A run that another one overtakes on the same shards is refused, because its merge is out of date.
    """
    source = source.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        base = store.version()
        lines = store.lines(base)
        total = sum(line["record_count"] for line in lines.values())
        touched = store.shards_of(source) if touched is None else touched
        history = store.read(touched, lines)
        if adjust is not None:
            history = adjust(history, source)
        result: MergeResult = merge(history, source)
        outcomes = result.outcomes.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            result = MergeResult(outcomes, result.columns)
            records = result.checked()
            counts = result.metrics().first()
            before = sum(line["record_count"] for name, line in lines.items() if name in touched)
            published: Published = store.publish(records, touched, base, batch)
            return RunMetrics(
                counts["source"], total, total - before + counts["final"], published.changed
            )
        finally:
            outcomes.unpersist()
    finally:
        source.unpersist()


def update_curve(spark: SparkSession, root: str, feed: str) -> RunMetrics:
    data = dataset("treasury-yield-curve")
    source = feeds.read_curve(spark, feed)
    return merge_and_publish(
        ShardStore.of(spark, root, data), source, lambda h, s: strict_merge(h, s, list(data.keys), data.values)
    )


def wide_store(spark: SparkSession, root: str) -> ShardStore:
    """The secured rate with observations and averages in one wide record.

    Keeping both in one history makes a repeated feed a true no-op.
    """
    return ShardStore(spark, f"{root}/sofr/wide", WIDE_SCHEMA, ["date"], F.year("date").cast("string"))


def update_overnight(spark: SparkSession, root: str, feed: str) -> RunMetrics:
    data = dataset("federal-funds")
    source = feeds.read_overnight(spark, feed)
    return merge_and_publish(
        ShardStore.of(spark, root, data), source, lambda h, s: enriching_merge(h, s, ["date"], data.values)
    )


def update_secured(spark: SparkSession, root: str, feed: str) -> RunMetrics:
    """Merge the mixed feed, then refresh the observations and the four metric sets."""
    source = feeds.read_mixed(spark, feed).select(
        "date", *[F.col(c).cast("bigint").alias(c) for c in feeds.WIDE_VALUES]
    )
    store = wide_store(spark, root)
    touched = store.shards_of(source)
    metrics = merge_and_publish(
        store, source, lambda h, s: enriching_merge(h, s, ["date"], feeds.WIDE_VALUES), touched
    )
    if metrics.changed:
        publish_secured(spark, root, store.read(touched), touched)
    return metrics


def publish_secured(spark: SparkSession, root: str, wide: DataFrame, touched: list[str]) -> dict[str, Published]:
    data = dataset("sofr")
    typed = feeds.observations(wide).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in data.schema.fields])
    done = {"sofr": ShardStore.of(spark, root, data).publish(typed, touched)}
    names = ("sofr-30d-average", "sofr-90d-average", "sofr-180d-average", "sofr-index")
    for name, metric in zip(names, feeds.AVERAGED):
        rows = wide.select("date", F.col(metric)).filter(F.col(metric).isNotNull())
        done[name] = ShardStore.of(spark, root, dataset(name)).publish(rows, touched)
    return done


def update_monthly(spark: SparkSession, root: str, page_rows: DataFrame, url: str, html: str,
                   with_history: bool = False) -> RunMetrics:
    """Monthly percentages from pages, known transcription errors put right."""
    data = dataset("section-7520-rates")
    months = pages.rate_table_rows(page_rows, url, html)
    missing = pages.pages_without_months(page_rows, months, url).select(
        F.lit("rate table").alias("rule"), F.col("url").alias("key"), F.lit("html_table_not_found").alias("code")
    )
    decoded = pages.decode_rate_table(months)
    checks.assert_clean(
        checks.all_violations(missing, feeds.feed_violations(decoded, ["source_url", "effective_month"]))
    )
    figures = ["effective_month", "midterm_afr_120_basis_points", "section_7520_rate_basis_points"]
    match = [*figures, "revenue_ruling", "source_url"]
    rows = decoded.drop("bad_fields")
    if with_history:
        rows = rows.unionByName(seeds.monthly_1996(spark))
    fixed = apply_corrections(
        rows, seeds.known_rate_corrections(spark), match, "section_7520_rate_basis_points", "corrected"
    )
    stored, store = seeds.stored_rate_corrections(spark), ShardStore.of(spark, root, data)
    rows = fixed.select(*data.columns)
    touched = set(store.shards_of(rows)) | (set(store.shards_of(stored)) & set(store.lines()))
    return merge_and_publish(
        store, rows, lambda h, s: tolerant_merge(h, s, list(data.keys), data.values), sorted(touched),
        adjust=lambda h, _: apply_corrections(h, stored, figures, "section_7520_rate_basis_points", "corrected"),
    )


def update_rulings(spark: SparkSession, root: str, documents: DataFrame, url: str, text: str) -> RunMetrics:
    """Nested monthly tables from ruling texts."""
    data = dataset("applicable-federal-rates")
    parsed = rulings.parse_rulings(documents.filter(checks.is_rate_ruling(F.col(text))), url, text)
    checks.assert_clean(
        parsed.filter(F.col("problem").isNotNull()).select(
            F.lit("ruling").alias("rule"), F.col("source_url").alias("key"), F.col("problem").alias("code")
        )
    )
    return merge_and_publish(
        ShardStore.of(spark, root, data), parsed.select(*data.columns),
        lambda h, s: strict_merge(h, s, list(data.keys), data.values),
    )


_HISTORY = {
    "annual-gift-exclusion": seeds.gift_history,
    "estate-gift-tax-exemption": seeds.estate_history,
    "gst-exemption": seeds.gst_history,
    "noncitizen-spouse-gift-exclusion": seeds.spouse_history,
}


def update_statutory(
    spark: SparkSession, root: str, name: str, documents: DataFrame, url: str, text: str,
    with_history: bool = False, target_year: int | None = None,
) -> RunMetrics:
    """A statutory amount from procedure texts, with or without static history."""
    data: Dataset = DATASETS[name]
    found = prose.extract_amounts(documents, url, text, prose.RULES[name])
    checks.assert_clean(
        found.filter(F.col("problem").isNotNull()).select(
            F.lit("amount").alias("rule"), F.col("source_url").alias("key"), F.col("problem").alias("code")
        )
    )
    if target_year is not None:
        found = found.filter(checks.in_target_year(F.col("period_start_date"), F.col("period_end_date"), target_year))
    source = found.select(*data.columns)
    if with_history:
        source = source.unionByName(_HISTORY[name](spark).select(*data.columns))
    adjust = None
    if with_history and name == "estate-gift-tax-exemption":
        def adjust(history: DataFrame, feed: DataFrame) -> DataFrame:
            return drop_overlapped(history, feed, "period_start_date", "period_end_date")
    strict_source = name == "gst-exemption"
    store = ShardStore.of(spark, root, data)
    if source.isEmpty():
        total = sum(line["record_count"] for line in store.lines().values())
        return RunMetrics(0, total, total, False)
    return merge_and_publish(
        store, source,
        lambda h, s: tolerant_merge(h, s, list(data.keys), data.values, repeated_source_fails=strict_source),
        ["all"], adjust,
    )


def update_actuarial(spark: SparkSession, root: str, cells: dict[str, DataFrame]) -> dict[str, Published]:
    """All actuarial sets from landed grids, keyed by table; Table D is generated."""
    rate, payout = "interest_rate_basis_points", "adjusted_payout_rate_basis_points"
    build = {
        "mortality-table-2000cm": lambda c: grids.mortality_rows(c).drop("workbook"),
        "mortality-table-2010cm": lambda c: grids.mortality_rows(c).drop("workbook"),
        "actuarial-table-b": grids.term_certain_rows,
        "actuarial-table-h": lambda c: grids.commutation_rows(c, "Interest Rate of", rate, ""),
        "actuarial-table-r2": lambda c: grids.two_life_rows(c, rate, "remainder_factor"),
        "actuarial-table-s": grids.single_life_rows,
        "actuarial-table-u1": grids.one_life_unitrust_rows,
        "actuarial-table-u2": lambda c: grids.two_life_rows(c, payout, "unitrust_remainder_factor"),
        "actuarial-table-z": lambda c: grids.commutation_rows(c, "Adjusted Payout Rate", payout, "u"),
    }
    tables = {name: build[name](grid) for name, grid in cells.items()}
    tables["actuarial-table-d"] = term_unitrust_table(spark)
    if "mortality-table-2010cm" in tables:
        tables["life-expectancy-by-age"] = life_expectancy(tables["mortality-table-2010cm"], [])
    for name, rows in tables.items():
        data = DATASETS[name]
        factors = [v.removesuffix("_scaled_1e6") for v in data.values]
        checks.assert_clean(grids.check_factor_rows(rows, list(data.keys), factors))
    done = {}
    for name, rows in tables.items():
        data = DATASETS[name]
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in data.schema.fields])
        done[name] = ShardStore.of(spark, root, data).publish(typed)
    return done


def _rate_rows(*ages: str) -> T.StructType:
    return T.StructType(
        [T.StructField("table_id", T.StringType()), *[T.StructField(a, T.IntegerType()) for a in ages],
         T.StructField("rate", T.LongType())]
    )


SELECT_SCHEMA = _rate_rows("issue_age", "duration")
ULTIMATE_SCHEMA = _rate_rows("attained_age")
HEADER_SCHEMA = T.StructType([f for f in TABLE_SCHEMA.fields if not f.name.endswith("_rates")])


def table_stores(spark: SparkSession, root: str) -> dict[str, ShardStore]:
    """Mortality tables as headers and two long tables, sharded by table; the three change together."""
    folder, shard = f"{root}/{dataset('valuation-basic-table-2015').folder}", F.col("table_id")
    kinds = {
        "tables": (HEADER_SCHEMA, ["table_id"]), "select": (SELECT_SCHEMA, ["table_id", "issue_age", "duration"]),
        "ultimate": (ULTIMATE_SCHEMA, ["table_id", "attained_age"]),
    }
    return {
        name: ShardStore(spark, f"{folder}/{name}", schema, keys, shard, f"{folder}/commits", name)
        for name, (schema, keys) in kinds.items()
    }


def import_tables(spark: SparkSession, root: str, raw: DataFrame, expected: int = TABLE_COUNT) -> dict[str, Published]:
    """Import mortality tables: all are checked before anything is written, and one commit switches all three stores."""
    tables = shards.normalise_tables(raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        checks.assert_clean(
            checks.all_violations(
                checks.violations(
                    tables, ["table_id"],
                    {"classified": (F.col("structure").isNull(), "invalid_source"), **shards.table_rules()},
                ),
                checks.count_violation(tables, expected),
                checks.count_violation(tables.select("table_id").distinct(), expected, "duplicate_table"),
            )
        )
        stores = table_stores(spark, root)
        rows = {
            "tables": tables.select(*HEADER_SCHEMA.fieldNames()), "select": shards.select_rate_rows(tables),
            "ultimate": shards.ultimate_rate_rows(tables),
        }
        base = stores["tables"].version()
        prepared = [(store, store.prepare(rows[name], None, base)) for name, store in stores.items()]
        return dict(zip(stores, commit_together(prepared, base), strict=True))
    finally:
        tables.unpersist()

