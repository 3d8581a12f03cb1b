"""Queries that publish derived records to a store and read them back.

The store lies in a fresh folder below the shared folder.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import strict_merge
from ..plans import lookup, verify
from ..plans.store import ShardStore
from ..registry import Dataset, dataset
from ..session import scratch_path
from ..streaming.feed import stream_feed
from .common import ABSENT, ORDER_DAY, Query, shown, table

ORDER_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType(), False), T.StructField("date", T.DateType(), False),
        T.StructField("rate", T.LongType(), True), T.StructField("status", T.StringType(), True),
    ]
)


def _orders(spark, folder):
    return table(spark, folder, "orders").selectExpr("o_orderkey", f"{ORDER_DAY} AS date", "o_custkey AS rate", "o_orderstatus AS status")


def _order_store(spark, label: str) -> ShardStore:
    return ShardStore(spark, scratch_path(spark, label), ORDER_SCHEMA, ["date", "o_orderkey"], F.year("date").cast("string"))


def publish_cycle(spark, folder):
    """First run, an identical run, a run that changes one year, and one that drops a year."""
    store, rows = _order_store(spark, "cycle"), _orders(spark, folder)
    changed = rows.withColumn("rate", F.when(F.col("date") == "1998-05-06", F.col("rate") + 1).otherwise(F.col("rate")))
    lines = []
    for run, df in enumerate((rows, rows.repartition(5, "status"), changed, changed.filter("date < DATE'2001-01-01'"))):
        done = store.publish(df)
        totals = store.totals().first()
        lines.append((run, int(done.changed), len(done.written), len(done.removed), totals["record_count"], totals["shard_count"]))
    return shown(spark.createDataFrame(lines, "run int, changed int, written int, removed int, record_count bigint, shard_count bigint"))


CYCLE_SQL = f"""
WITH c AS (SELECT count(*) AS n, count(DISTINCT year(o_orderdate)) AS y, count(*) FILTER (year(o_orderdate) < 2001) AS n0,
                  count(DISTINCT year(o_orderdate)) FILTER (year(o_orderdate) < 2001) AS y0, CAST(bool_or({ORDER_DAY} = DATE '1998-05-06') AS BIGINT) AS hit FROM orders)
SELECT 0 AS run, 1 AS changed, y AS written, 0 AS removed, n AS record_count, y AS shard_count FROM c
UNION ALL SELECT 1, 0, 0, 0, n, y FROM c UNION ALL SELECT 2, hit, hit, 0, n, y FROM c
UNION ALL SELECT 3, CAST(y > y0 AS BIGINT), 0, y - y0, n0, y0 FROM c"""


def incremental_merge(spark, folder):
    """History of early orders, a late feed merged into the years it touches, read back whole."""
    store, rows = _order_store(spark, "merge"), _orders(spark, folder)
    store.publish(rows.filter("o_orderkey % 5 <> 0"))
    feed = rows.filter("o_orderkey % 3 = 0 AND date >= DATE'1999-01-01'")
    touched = store.shards_of(feed)
    merged = strict_merge(store.read(touched), feed, ["date", "o_orderkey"], ["rate", "status"])
    store.publish(merged.checked(), touched)
    return shown(store.read())


INCREMENTAL_SQL = f"""
SELECT o_orderkey, CAST({ORDER_DAY} AS VARCHAR) AS date, o_custkey AS rate, o_orderstatus AS status FROM orders
WHERE o_orderkey % 5 <> 0 OR (o_orderkey % 3 = 0 AND o_orderdate >= DATE '1999-01-01')"""


def _daily(spark, folder):
    """One record per order date."""
    return table(spark, folder, "orders").selectExpr(f"{ORDER_DAY} AS date", "o_custkey").groupBy("date").agg(
        F.count(F.lit(1)).cast("int").alias("rate_basis_points")
    )


def _daily_store(spark, folder) -> ShardStore:
    store = ShardStore.of(spark, scratch_path(spark, "daily"), dataset("federal-funds"))
    store.publish(_daily(spark, folder))
    return store


def by_date_lookup(spark, folder):
    store = _daily_store(spark, folder)
    days = ("1998-05-06", "1999-12-31", "2030-01-01")
    found = [lookup.by_date(store, day).select(F.lit(day).alias("asked"), "date", "rate_basis_points") for day in days]
    return shown(found[0].unionByName(found[1]).unionByName(found[2]))


BY_DATE_SQL = f"""
SELECT CAST(d AS VARCHAR) AS asked, CAST(d AS VARCHAR) AS date, count(*) AS rate_basis_points FROM (SELECT {ORDER_DAY} AS d FROM orders)
WHERE d IN (DATE '1998-05-06', DATE '1999-12-31', DATE '2030-01-01') GROUP BY d"""


def latest_lookup(spark, folder):
    store = _daily_store(spark, folder)
    return shown(lookup.latest_envelope(store, dataset("federal-funds")).select(
        "schema_id", "dataset_id", "record_key", "canonical_record_path", "canonical_manifest_path", "record.rate_basis_points"
    ))


LATEST_SQL = f"""
SELECT 'tabulary.api_latest.v1' AS schema_id, 'federal-funds' AS dataset_id, CAST(d AS VARCHAR) AS record_key, 'fed-funds/by-year/' || year(d) || '-fed-funds.json' AS canonical_record_path,
       'fed-funds/manifest.json' AS canonical_manifest_path, count(*) AS rate_basis_points
FROM (SELECT {ORDER_DAY} AS d FROM orders) GROUP BY d ORDER BY d DESC LIMIT 1"""

MONTHLY = T.StructType([T.StructField("effective_month", T.StringType(), False), T.StructField("orders_n", T.LongType(), False), T.StructField("last_key", T.LongType(), False)])


def by_month_lookup(spark, folder):
    data = Dataset("monthly-orders", "monthly", "by_year", ("effective_month",), MONTHLY, "by-month")
    store = ShardStore.of(spark, scratch_path(spark, "monthly"), data)
    store.publish(
        table(spark, folder, "orders").groupBy(F.date_format(F.to_date("o_orderdate"), "yyyy-MM").alias("effective_month")).agg(
            F.count(F.lit(1)).alias("orders_n"), F.max("o_orderkey").alias("last_key")
        )
    )
    return shown(lookup.by_month(store, "1997-11").unionByName(lookup.latest(store)))


BY_MONTH_SQL = """
WITH g AS (SELECT strftime(o_orderdate, '%Y-%m') AS effective_month, count(*) AS orders_n, max(o_orderkey) AS last_key FROM orders GROUP BY 1)
SELECT * FROM g WHERE effective_month = '1997-11' UNION ALL SELECT * FROM g WHERE effective_month = (SELECT max(effective_month) FROM g)"""


def by_year_lookup(spark, folder):
    """Periods that start in a year, as a lookup and as grouped envelopes."""
    data = dataset("gst-exemption")
    days = _daily(spark, folder).select(
        F.col("date").alias("period_start_date"), F.date_add("date", F.col("rate_basis_points") * 100).alias("period_end_date"),
        F.col("rate_basis_points").cast("bigint").alias("exemption_amount_usd"),
    )
    store = ShardStore.of(spark, scratch_path(spark, "periods"), data)
    store.publish(days)
    asked = lookup.by_year(store, 1998).agg(
        F.lit("1998").alias("record_key"), F.lit("lookup").alias("form"), F.count(F.lit(1)).alias("n"), F.sum("exemption_amount_usd").alias("amount")
    )
    grouped = lookup.grouped_envelopes(store.read(), data).select(
        "record_key", F.lit("envelope").alias("form"), F.size("records").cast("bigint").alias("n"),
        F.aggregate("records", F.lit(0).cast("bigint"), lambda t, r: t + r["exemption_amount_usd"]).alias("amount"),
    )
    return shown(asked.unionByName(grouped))


BY_YEAR_SQL = f"""
SELECT CAST(year(d) AS VARCHAR) AS record_key, 'envelope' AS form, count(DISTINCT d) AS n, count(*) AS amount FROM (SELECT {ORDER_DAY} AS d FROM orders) GROUP BY 1
UNION ALL SELECT '1998', 'lookup', count(DISTINCT d), count(*) FROM (SELECT {ORDER_DAY} AS d FROM orders) WHERE year(d) = 1998"""


def factor_lookup(spark, folder):
    """Factors by rate and age from rate shards made of parts; one shard is read."""
    data = dataset("actuarial-table-u1")
    rows = table(spark, folder, "part").selectExpr("CAST(p_size * 20 AS INT) AS adjusted_payout_rate_basis_points", "CAST(p_partkey % 10 AS INT) AS age", "p_partkey").groupBy(
        "adjusted_payout_rate_basis_points", "age"
    ).agg(F.max("p_partkey").alias("unitrust_remainder_factor_scaled_1e6"))
    store = ShardStore.of(spark, scratch_path(spark, "factors"), data)
    store.publish(rows)
    found = [lookup.factor(store, rate, age=age) for rate, age in ((200, 6), (400, 7), (20, 3))]
    return shown(found[0].unionByName(found[1]).unionByName(found[2]))


FACTOR_SQL = """
SELECT CAST(p_size * 20 AS BIGINT) AS adjusted_payout_rate_basis_points, p_partkey % 10 AS age, max(p_partkey) AS unitrust_remainder_factor_scaled_1e6 FROM part
WHERE (p_size * 20, p_partkey % 10) IN ((200, 6), (400, 7), (20, 3)) GROUP BY 1, 2"""


def mortality_lookup(spark, folder):
    """Values by table, issue age and duration from table shards made of brands."""
    from ..plans.updates import table_stores

    stores = table_stores(spark, scratch_path(spark, "tables"))
    part = table(spark, folder, "part").withColumnRenamed("p_brand", "table_id")
    stores["select"].publish(part.groupBy("table_id", (F.col("p_size") % 5).alias("issue_age"), (F.col("p_partkey") % 3).cast("int").alias("duration")).agg(F.max("p_partkey").alias("rate")))
    stores["ultimate"].publish(part.groupBy("table_id", (F.col("p_size") % 5).alias("attained_age")).agg(F.min("p_partkey").alias("rate")))
    select = lookup.select_rate(stores["select"], "Brand#7", 4, 2).select("table_id", "issue_age", "duration", "rate")
    ultimate = lookup.ultimate_rate(stores["ultimate"], "Brand#9", 1).select("table_id", F.col("attained_age").alias("issue_age"), F.lit(None).cast("int").alias("duration"), "rate")
    return shown(select.unionByName(ultimate))


MORTALITY_SQL = f"""
SELECT p_brand AS table_id, 4 AS issue_age, 2 AS duration, max(p_partkey) AS rate FROM part WHERE p_brand = 'Brand#7' AND p_size % 5 = 4 AND p_partkey % 3 = 2 GROUP BY 1
UNION ALL SELECT p_brand, 1, {ABSENT}, min(p_partkey) FROM part WHERE p_brand = 'Brand#9' AND p_size % 5 = 1 GROUP BY 1"""


def catalog_lookup(spark, folder):
    """Catalogue lines of two published sets, from their manifests."""
    root = scratch_path(spark, "catalog")
    daily = ShardStore.of(spark, root, dataset("federal-funds"))
    daily.publish(_daily(spark, folder))
    factors = ShardStore.of(spark, root, dataset("actuarial-table-d"))
    factors.publish(
        table(spark, folder, "part").selectExpr("CAST(p_size * 20 AS INT) AS adjusted_payout_rate_basis_points", "CAST(p_partkey % 20 AS INT) AS term_years").distinct()
        .withColumn("unitrust_remainder_factor_scaled_1e6", F.lit(1).cast("bigint"))
    )
    lines = lookup.catalog(spark, {"federal-funds": daily, "actuarial-table-d": factors})
    return shown(lines.select("dataset_id", "dataset_path", "schema_id", "record_storage", "route", "record_count", "shard_count"))


CATALOG_SQL = f"""
SELECT 'federal-funds' AS dataset_id, 'fed-funds' AS dataset_path, 'tabulary.federal_funds.v1' AS schema_id, 'by_year' AS record_storage, 'by-date' AS route,
       count(DISTINCT {ORDER_DAY}) AS record_count, count(DISTINCT year(o_orderdate)) AS shard_count FROM orders
UNION ALL SELECT 'actuarial-table-d', 'actuarial/table-d', 'tabulary.actuarial_table_d.v1', 'by_rate', '', count(DISTINCT (p_size, p_partkey % 20)), count(DISTINCT p_size) FROM part"""


def lookup_envelopes(spark, folder):
    """Published envelopes read back: record keys, years and records agree with the source."""
    data, path = dataset("federal-funds"), scratch_path(spark, "envelopes")
    lookup.publish_envelopes(lookup.single_envelopes(_daily(spark, folder), data), path)
    back = spark.read.schema("schema_id string, schema_version int, record_key string, envelope string, dataset_id string, year string").parquet(path)
    parsed = back.withColumn("r", F.from_json("envelope", "canonical_record_path string, record struct<date:date,rate_basis_points:int>"))
    return shown(parsed.select("dataset_id", "schema_id", "year", "record_key", "r.canonical_record_path", "r.record.date", "r.record.rate_basis_points"))


ENVELOPES_SQL = f"""
SELECT 'federal-funds' AS dataset_id, 'tabulary.api_record.v1' AS schema_id, CAST(year(d) AS VARCHAR) AS year, CAST(d AS VARCHAR) AS record_key,
       'fed-funds/by-year/' || year(d) || '-fed-funds.json' AS canonical_record_path, CAST(d AS VARCHAR) AS date, count(*) AS rate_basis_points
FROM (SELECT {ORDER_DAY} AS d FROM orders) GROUP BY d"""


def verified_read(spark, folder):
    """JSON shards are read only when their digests match; the checks are counted too."""
    path = scratch_path(spark, "verified")
    rows = _orders(spark, folder).withColumn("year", F.year("date"))
    verify.write_json_shards(rows, "year", ["date", "o_orderkey"], path)
    listed = f"{path}-manifest"
    verify.file_manifest(spark, path).select("file", "bytes", "sha256").write.parquet(listed)
    expected = spark.read.parquet(listed)
    back = verify.read_verified(spark, path, expected, "o_orderkey bigint, date date, rate bigint, status string, year int")
    tampered = expected.withColumn("bytes", F.col("bytes") + 1)
    wrong = verify.file_differences(tampered, verify.file_manifest(spark, path)).count() == expected.count()
    return shown(back.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("rate").alias("rate")).withColumn("tampering_found", F.lit(wrong)))


VERIFIED_SQL = "SELECT year(o_orderdate) AS year, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS rate, 1 AS tampering_found FROM orders GROUP BY 1"


def published_is_canonical(spark, folder):
    """Lookup rows of a published set against the canonical rows: no difference."""
    store = _daily_store(spark, folder)
    rows = lookup.lookup_rows(store.read(), dataset("federal-funds")).select("record.*")
    differences = verify.published_differences(rows, _daily(spark, folder))
    stats = lookup.route_statistics(store.read(), dataset("federal-funds"))
    counted = differences.agg(F.count(F.lit(1)).alias("differences")).unionByName(
        stats.withColumn("differences", F.lit(0).cast("bigint")), allowMissingColumns=True)
    return shown(counted.agg(F.sum("differences").alias("differences"), *[F.max(c).alias(c) for c in stats.columns]))


CANONICAL_SQL = f"""
SELECT 0 AS differences, 'federal-funds' AS dataset_id, count(DISTINCT d) AS record_count, count(DISTINCT d) AS file_count, CAST(min(d) AS VARCHAR) AS first_key, CAST(max(d) AS VARCHAR) AS last_key
FROM (SELECT {ORDER_DAY} AS d FROM orders)"""


def streamed_feed(spark, folder):
    """Feed files streamed into a store: a partial delivery, a full one, and the same again."""
    root = scratch_path(spark, "stream")
    landing, rows = f"{root}/landing", _orders(spark, folder)
    schema = "o_orderkey string, date string, rate string, status string"
    text = rows.selectExpr("o_orderkey", "date", "CASE WHEN o_orderkey % 4 <> 0 THEN rate END AS rate", "CASE WHEN o_orderkey % 4 <> 0 THEN status END AS status")
    store = ShardStore(spark, f"{root}/store", ORDER_SCHEMA, ["date", "o_orderkey"], F.year("date").cast("string"))

    def decode(cells):
        return cells.selectExpr("CAST(o_orderkey AS BIGINT) AS o_orderkey", "CAST(date AS DATE) AS date", "CAST(rate AS BIGINT) AS rate", "status")

    deliveries = (text.filter("o_orderkey % 3 <> 0"), rows, rows.filter("o_orderkey % 2 = 0"))
    for number, delivery in enumerate(deliveries):
        delivery.write.option("header", True).mode("append").csv(f"{landing}/d={number}")
        stream_feed(spark, f"{landing}/*", schema, decode, store, ["date", "o_orderkey"], ["rate", "status"], f"{root}/checkpoint").awaitTermination()
    return shown(store.read().withColumn("version", F.lit(max(line["version"] for line in store.lines().values()))))


STREAM_SQL = f"""
SELECT o_orderkey, CAST({ORDER_DAY} AS VARCHAR) AS date, o_custkey AS rate, o_orderstatus AS status, 2 AS version FROM orders"""


QUERIES = {
    "publish_cycle": Query(publish_cycle, CYCLE_SQL, ("SNK-1", "SNK-2", "SNK-5", "SNK-6", "AGG-8", "SET-2")),
    "incremental_merge": Query(incremental_merge, INCREMENTAL_SQL, ("JN-1", "SNK-1", "SNK-5")),
    "by_date_lookup": Query(by_date_lookup, BY_DATE_SQL, ("QRY-1",)),
    "by_month_lookup": Query(by_month_lookup, BY_MONTH_SQL, ("QRY-2", "QRY-4", "WIN-4")),
    "by_year_lookup": Query(by_year_lookup, BY_YEAR_SQL, ("QRY-3", "SNK-8", "AGG-9")),
    "latest_lookup": Query(latest_lookup, LATEST_SQL, ("QRY-4", "SNK-9", "WIN-4")),
    "catalog_lookup": Query(catalog_lookup, CATALOG_SQL, ("QRY-5", "AGG-6")),
    "factor_lookup": Query(factor_lookup, FACTOR_SQL, ("QRY-6", "SNK-3", "SRC-6")),
    "mortality_lookup": Query(mortality_lookup, MORTALITY_SQL, ("QRY-7", "SNK-4")),
    "lookup_envelopes": Query(lookup_envelopes, ENVELOPES_SQL, ("SNK-7", "SRC-8")),
    "verified_read": Query(verified_read, VERIFIED_SQL, ("JN-6", "AGG-8")),
    "published_is_canonical": Query(published_is_canonical, CANONICAL_SQL, ("JN-13", "AGG-7")),
    "streamed_feed": Query(streamed_feed, STREAM_SQL, ("STR-1", "JN-2", "SNK-5")),
}
