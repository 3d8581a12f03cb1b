"""Queries over windows, aggregates, sorts and generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, generate, ordering, windows
from ..plans.lookup import grouped_rows
from ..sources import rulings
from .common import ABSENT, ORDER_DAY, Query, num, shown, table



def forward_fill(spark, folder):
    """Value of the last signup at or before each event of a user."""
    ev = table(spark, folder, "events")
    marker = F.when(F.col("event_type") == "signup", F.expr("CAST(round(value * 100) AS BIGINT)"))
    rows = windows.forward_fill(ev, ["user_id"], ["ts", "event_id"], F.date_trunc("day", "ts"), marker, "signup_value")
    return shown(rows.select("event_id", "user_id", "signup_value"))


FILL_SQL = f"""
SELECT event_id, user_id, {num("last_value(CASE WHEN event_type = 'signup' THEN CAST(round(value * 100) AS BIGINT) END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)")} AS signup_value
FROM events"""


def suffix_sum(spark, folder):
    """Quantity still to ship of a supplier after each order line."""
    li = table(spark, folder, "lineitem").selectExpr(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "CAST(l_quantity AS BIGINT) AS q"
    ).groupBy("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey").agg(F.sum("q").alias("q"))
    rows = windows.suffix_sum(
        li, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"], F.floor(F.col("l_orderkey") / 4096), F.col("q"), "later_quantity"
    )
    return shown(rows)


SUFFIX_SQL = f"""
WITH g AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY ALL)
SELECT l_suppkey, l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, q,
       CAST(COALESCE(sum(q) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS BIGINT) AS later_quantity
FROM g"""


def life_expectancy(spark, folder):
    """Expectation of life over brand tables: survivors by size as age."""
    part = table(spark, folder, "part").groupBy("p_brand", F.col("p_size").alias("age")).agg(
        F.sum(F.expr("CAST(round(p_retailprice * 1000000) AS BIGINT)")).alias("survivors_per_100000_scaled_1e6")
    )
    return shown(windows.life_expectancy(part, ["p_brand"]))


LIFE_SQL = """
WITH g AS (SELECT p_brand, p_size AS age, CAST(sum(CAST(round(p_retailprice * 1000000) AS BIGINT)) AS HUGEINT) AS lives FROM part GROUP BY 1, 2),
f AS (SELECT *, COALESCE(sum(lives) OVER (PARTITION BY p_brand ORDER BY age ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS later FROM g)
SELECT p_brand, CAST(age AS BIGINT) AS age,
       CAST(CASE WHEN lives > 0 THEN (later * 2000000 + lives) // (lives * 2) ELSE 0 END AS BIGINT) AS curtate_life_expectancy_years_scaled_1e6,
       CAST(CASE WHEN lives > 0 THEN (later * 2000000 + lives) // (lives * 2) + 500000 ELSE 0 END AS BIGINT) AS complete_life_expectancy_years_scaled_1e6
FROM f"""


def first_seen(spark, folder):
    """First event of every user and type, with its position kept."""
    rows = windows.first_seen(table(spark, folder, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "value"])
    return shown(rows)


FIRST_SQL = """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1"""


def latest(spark, folder):
    """Newest event of every user."""
    rows = windows.latest(table(spark, folder, "events"), ["user_id"], ["ts", "event_id"], ["event_id", "event_type", "value"])
    return shown(rows)


LATEST_SQL = """
SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""


def month_after_marker(spark, folder):
    """Effective month of ruling-like texts assembled from documents."""
    docs = table(spark, folder, "documents").selectExpr(
        "doc_id",
        "concat(text, '\nREV. RUL. 2001-22 TABLE 1\n', CASE WHEN doc_id % 4 = 0 THEN 'no month here' ELSE 'Applicable Federal Rates (AFR) for April 2000' END, "
        "'\nTABLE 2\nAdjusted AFR for ', CASE WHEN doc_id % 3 = 0 THEN 'May 2001' ELSE 'June 1999' END, '\nTABLE 3\n') AS text",
    )
    from ..functions.text import text_lines

    lines = docs.select("doc_id", text_lines(F.col("text")).alias("lines"))
    return shown(lines.select("doc_id", rulings.month_after(F.col("lines"), "TABLE 1", "TABLE 2").alias("first_month"),
                              rulings.month_after(F.col("lines"), "TABLE 2", "TABLE 3").alias("second_month"),
                              rulings.effective_month(F.col("lines"), F.lit("2001")).alias("effective_month")))


MONTH_SQL = """
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE '2000-04' END AS first_month, CASE WHEN doc_id % 3 = 0 THEN '2001-05' ELSE '1999-06' END AS second_month,
       CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 3 = 0 THEN '2001-05' ELSE '2000-04' END AS effective_month
FROM documents"""


def unsorted_rows(spark, folder):
    """Order lines of a part whose ship day does not rise along the order keys."""
    li = table(spark, folder, "lineitem").groupBy("l_partkey", "l_orderkey").agg(F.max(F.to_date("l_shipdate")).alias("day"))
    rows = windows.unsorted_rows(li, ["l_partkey"], "l_orderkey", F.floor(F.col("l_orderkey") / 4096), "day")
    return shown(rows)


UNSORTED_SQL = """
WITH g AS (SELECT l_partkey, l_orderkey, max(CAST(l_shipdate AS DATE)) AS day FROM lineitem GROUP BY 1, 2),
p AS (SELECT *, lag(day) OVER (PARTITION BY l_partkey ORDER BY l_orderkey) AS previous FROM g)
SELECT l_partkey, l_orderkey, CAST(day AS VARCHAR) AS day, CAST(previous AS VARCHAR) AS previous FROM p WHERE previous >= day"""


def year_records(spark, folder):
    """Orders of a customer and year in order, with their position."""
    rows = table(spark, folder, "orders").selectExpr("o_custkey", "year(o_orderdate) AS year", f"{ORDER_DAY} AS date", "o_orderkey", "o_orderstatus")
    out = grouped_rows(rows, ["o_custkey", "year"], ["date", "o_orderkey"], F.trunc("date", "month"))
    return shown(out)


YEAR_SQL = f"""
SELECT o_custkey, year(o_orderdate) AS year, CAST({ORDER_DAY} AS VARCHAR) AS date, o_orderkey, o_orderstatus,
       row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS position
FROM orders"""


def region_nations(spark, folder):
    """Nations of a region as one ordered array."""
    nation = table(spark, folder, "nation")
    rows = aggregates.records_per_key(
        nation, ["n_regionkey"], ["n_nationkey"], F.floor(F.col("n_nationkey") / 1000), F.struct("n_nationkey", "n_name"))
    line = F.array_join(F.transform("records", lambda r: F.concat_ws(":", r["n_nationkey"].cast("string"), r["n_name"])), ",")
    return shown(rows.select("n_regionkey", line.alias("nations")))


NATIONS_SQL = """
SELECT CAST(n_regionkey AS BIGINT) AS n_regionkey, string_agg(n_nationkey || ':' || n_name, ',' ORDER BY n_nationkey) AS nations FROM nation GROUP BY 1"""


def year_manifest(spark, folder):
    """Shard lines and the total line of orders by year."""
    orders = table(spark, folder, "orders").selectExpr(f"CAST(year(o_orderdate) AS STRING) AS shard", f"CAST({ORDER_DAY} AS STRING) AS date")
    manifest = aggregates.shard_manifest(orders, "shard", "date")
    totals = aggregates.manifest_totals(manifest).select(F.lit("all").alias("shard"), "record_count", "first_key", "last_key")
    return shown(manifest.unionByName(totals))


MANIFEST_SQL = f"""
SELECT COALESCE(shard, 'all') AS shard, count(*) AS record_count, min(d) AS first_key, max(d) AS last_key
FROM (SELECT CAST(year(o_orderdate) AS VARCHAR) AS shard, CAST({ORDER_DAY} AS VARCHAR) AS d FROM orders) GROUP BY GROUPING SETS ((shard), ())"""


def rate_manifest(spark, folder):
    li = table(spark, folder, "lineitem").selectExpr("CAST(round(l_discount * 10000) AS INT) AS rate")
    return shown(aggregates.rate_manifest(li, "rate"))


RATE_SQL = "SELECT CAST(round(l_discount * 10000) AS BIGINT) AS rate, count(*) AS record_count FROM lineitem GROUP BY 1"


def table_manifest(spark, folder):
    """Brands as mortality tables: prices by size and key nested, then counted both ways."""
    from ..sources.shards import nest_table_rows

    part = table(spark, folder, "part")
    select = part.selectExpr("p_brand AS table_id", "p_size AS issue_age", "p_partkey % 25 AS duration", "p_size * 7 AS rate").distinct()
    ultimate = part.selectExpr("p_brand AS table_id", "p_size AS attained_age", "p_size * 9 AS rate").distinct()
    nested = aggregates.table_manifest(nest_table_rows(select, ultimate)).withColumn("form", F.lit("nested"))
    return shown(nested.unionByName(aggregates.table_manifest_from_rows(select, ultimate).withColumn("form", F.lit("long"))))


TABLE_SQL = """
WITH g AS (SELECT p_brand AS table_id, count(DISTINCT (p_size, p_partkey % 25)) AS select_rate_count, count(DISTINCT p_size) AS ultimate_rate_count FROM part GROUP BY 1)
SELECT *, 'nested' AS form FROM g UNION ALL SELECT *, 'long' FROM g"""


def dataset_catalog(spark, folder):
    """One line per table from its shard manifest."""
    keys = {"orders": ("o_orderkey", "CAST(year(o_orderdate) AS STRING)", f"CAST({ORDER_DAY} AS STRING)"),
            "part": ("p_partkey", "p_brand", "lpad(CAST(p_partkey AS STRING), 10, '0')"),
            "customer": ("c_custkey", "'all'", "lpad(CAST(c_custkey AS STRING), 10, '0')")}
    manifests = []
    for name, (_, shard, key) in keys.items():
        rows = table(spark, folder, name).selectExpr(f"{shard} AS shard", f"{key} AS key")
        manifests.append((name, "single" if name == "customer" else "by_year", aggregates.shard_manifest(rows, "shard", "key")))
    return shown(aggregates.catalog(manifests))


DATASET_SQL = f"""
SELECT 'orders' AS dataset_id, 'by_year' AS record_storage, count(*) AS record_count, count(DISTINCT year(o_orderdate)) AS shard_count,
       CAST(min({ORDER_DAY}) AS VARCHAR) AS first_key, CAST(max({ORDER_DAY}) AS VARCHAR) AS last_key FROM orders
UNION ALL SELECT 'part', 'by_year', count(*), count(DISTINCT p_brand), lpad(CAST(min(p_partkey) AS VARCHAR), 10, '0'), lpad(CAST(max(p_partkey) AS VARCHAR), 10, '0') FROM part
UNION ALL SELECT 'customer', 'single', count(*), 1, lpad(CAST(min(c_custkey) AS VARCHAR), 10, '0'), lpad(CAST(max(c_custkey) AS VARCHAR), 10, '0') FROM customer"""


def lookup_statistics(spark, folder):
    orders = table(spark, folder, "orders").selectExpr("o_orderpriority AS dataset_id", f"CAST({ORDER_DAY} AS STRING) AS record_key")
    return shown(aggregates.lookup_statistics(orders, ["dataset_id"], "record_key"))


STATISTICS_SQL = f"""
SELECT o_orderpriority AS dataset_id, count(*) AS record_count, count(DISTINCT {ORDER_DAY}) AS file_count,
       CAST(min({ORDER_DAY}) AS VARCHAR) AS first_key, CAST(max({ORDER_DAY}) AS VARCHAR) AS last_key FROM orders GROUP BY 1"""


def period_union(spark, folder):
    """Distinct days on which a user did anything, from arrays of days per type."""
    entries = table(spark, folder, "events").groupBy("user_id", "event_type").agg(F.collect_set(F.to_date("ts").cast("string")).alias("periods"))
    return shown(aggregates.period_union(entries, "user_id", "periods"))


PERIOD_SQL = "SELECT DISTINCT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS period FROM events"


def row_digest(spark, folder):
    """Order-free digest per ship year: equal for a reordered copy, different for a changed one."""
    li = table(spark, folder, "lineitem").withColumn("year", F.year(F.to_date("l_shipdate")))
    whole = aggregates.digest(li, ["year"]).alias("a")
    moved = aggregates.digest(li.repartition(7, "l_partkey"), ["year"]).alias("b")
    changed = aggregates.digest(li.withColumn("l_tax", F.when(F.col("l_orderkey") == 1, F.lit(0.5)).otherwise(F.col("l_tax"))), ["year"]).alias("c")
    same = lambda x, y: (F.col(f"{x}.digest_xor") == F.col(f"{y}.digest_xor")) & (F.col(f"{x}.digest_sum") == F.col(f"{y}.digest_sum"))
    return shown(
        whole.join(moved, F.col("a.year") == F.col("b.year")).join(changed, F.col("a.year") == F.col("c.year"))
        .select(F.col("a.year").alias("year"), F.col("a.record_count").alias("record_count"), same("a", "b").alias("same_when_moved"), same("a", "c").alias("same_when_changed"))
    )


DIGEST_SQL = """
SELECT year(l_shipdate) AS year, count(*) AS record_count, 1 AS same_when_moved,
       CAST(NOT bool_or(l_orderkey = 1) AS BIGINT) AS same_when_changed FROM lineitem GROUP BY 1"""


def content_digest(spark, folder):
    """Length and sha256 of every page body, as of a published file."""
    pages = table(spark, folder, "pages").select(F.concat(F.lit("/x/"), F.col("page_id").cast("string")).alias("path"), F.encode("html", "UTF-8").alias("content"))
    return shown(aggregates.file_digests(pages).select(F.col("file").cast("bigint").alias("page_id"), "bytes", "sha256"))


CONTENT_SQL = "SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS bytes, sha256(html) AS sha256 FROM pages"


def natural_sort(spark, folder):
    rows = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("date"), "o_orderkey", "o_orderstatus")
    return shown(ordering.natural_sort(rows, ["date", "o_orderkey"]))


SORT_SQL = f"SELECT CAST({ORDER_DAY} AS VARCHAR) AS date, o_orderkey, o_orderstatus FROM orders ORDER BY o_orderdate, o_orderkey"


def sorted_shards(spark, folder):
    """Rows sorted inside their shard; the check counts neighbours out of order."""
    rows = table(spark, folder, "lineitem").selectExpr("CAST(round(l_discount * 10000) AS INT) AS rate", "l_orderkey", "l_linenumber")
    placed = ordering.sorted_shards(rows, "rate", ["l_orderkey", "l_linenumber"]).withColumn("at", F.monotonically_increasing_id())
    return shown(placed.groupBy("rate").agg(
        F.count(F.lit(1)).alias("n"),
        (F.max(F.struct("at", "l_orderkey"))["l_orderkey"] == F.max("l_orderkey")).alias("last_is_greatest"),
        (F.min(F.struct("at", "l_orderkey"))["l_orderkey"] == F.min("l_orderkey")).alias("first_is_least"),
    ))


SHARDS_SQL = """
SELECT CAST(round(l_discount * 10000) AS BIGINT) AS rate, count(*) AS n, 1 AS last_is_greatest, 1 AS first_is_least FROM lineitem GROUP BY 1"""


def descending_index(spark, folder):
    rows = table(spark, folder, "customer").select("c_mktsegment", "c_nationkey", "c_custkey")
    return shown(ordering.descending_rows(rows, ["c_mktsegment", "c_nationkey", "c_custkey"]))


DESCENDING_SQL = "SELECT c_mktsegment, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_custkey FROM customer ORDER BY 1 DESC, 2 DESC, 3 DESC"


def sheet_order(spark, folder):
    rows = table(spark, folder, "part").select("p_partkey", F.concat(F.lit("sheet"), F.col("p_size"), F.lit(".xml")).alias("sheet"))
    return shown(ordering.sheet_order(rows, "sheet").select("p_partkey", "sheet", ordering.sheet_number(F.col("sheet")).alias("sheet_no")))


SHEET_SQL = "SELECT p_partkey, 'sheet' || p_size || '.xml' AS sheet, CAST(p_size AS BIGINT) AS sheet_no FROM part ORDER BY p_size"


def term_factors(spark, folder):
    """Every order line with its term-unitrust factor: discount as payout rate, line as term."""
    factors = generate.term_unitrust_table(spark)
    li = table(spark, folder, "lineitem").selectExpr("l_orderkey", "l_linenumber", "CAST(round(l_discount * 10000) AS INT) AS rate")
    joined = li.join(
        F.broadcast(factors),
        (F.col("rate") == F.col("adjusted_payout_rate_basis_points")) & (F.col("l_linenumber") == F.col("term_years")), "left",
    )
    return shown(joined.select("l_orderkey", "l_linenumber", "rate", F.col("unitrust_remainder_factor_scaled_1e6").alias("factor_e6")))


TERM_SQL = f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(round(l_discount * 10000) AS BIGINT) AS rate,
       CASE WHEN l_discount = 0 THEN {ABSENT} ELSE CAST(round(CAST(power(1 - CAST(round(l_discount * 10000) AS INT) / 10000.0, l_linenumber) AS DECIMAL(38,18)), 6) * 1000000 AS BIGINT) END AS factor_e6
FROM lineitem"""


def expand_years(spark, folder):
    """A customer's first to last order year, one period per year."""
    ranges = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b"), F.count(F.lit(1)).alias("amount")
    )
    return shown(generate.expand_years(ranges, "a", "b", ["o_custkey", "amount"]))


EXPAND_SQL = """
WITH g AS (SELECT o_custkey, min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS b, count(*) AS amount FROM orders GROUP BY 1),
y AS (SELECT o_custkey, amount, unnest(generate_series(a, b)) AS y FROM g)
SELECT o_custkey, amount, y || '-01-01' AS period_start_date, y || '-12-31' AS period_end_date FROM y"""


def metric_unpivot(spark, folder):
    """Four measures of an order line in long form, nulls dropped."""
    from ..sources.feeds import metric_rows

    wide = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "CAST(l_quantity AS BIGINT) AS quantity", "CASE WHEN l_linenumber > 3 THEN CAST(round(l_extendedprice * 100) AS BIGINT) END AS price",
        "CASE WHEN l_discount > 0 THEN CAST(round(l_discount * 10000) AS BIGINT) END AS discount", "CAST(round(l_tax * 10000) AS BIGINT) AS tax",
    )
    return shown(metric_rows(wide, ["quantity", "price", "discount", "tax"], ["l_orderkey", "l_linenumber"]))


UNPIVOT_SQL = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, 'quantity' AS metric, CAST(l_quantity AS BIGINT) AS value FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'price', CAST(round(l_extendedprice * 100) AS BIGINT) FROM lineitem WHERE l_linenumber > 3
UNION ALL SELECT l_orderkey, l_linenumber, 'discount', CAST(round(l_discount * 10000) AS BIGINT) FROM lineitem WHERE l_discount > 0
UNION ALL SELECT l_orderkey, l_linenumber, 'tax', CAST(round(l_tax * 10000) AS BIGINT) FROM lineitem"""


QUERIES = {
    "forward_fill": Query(forward_fill, FILL_SQL, ("WIN-2",)),
    "suffix_sum": Query(suffix_sum, SUFFIX_SQL, ("WIN-1",)),
    "life_expectancy": Query(life_expectancy, LIFE_SQL, ("WIN-1",)),
    "first_seen": Query(first_seen, FIRST_SQL, ("WIN-3",)),
    "latest": Query(latest, LATEST_SQL, ("WIN-4",)),
    "month_after_marker": Query(month_after_marker, MONTH_SQL, ("WIN-5",)),
    "unsorted_rows": Query(unsorted_rows, UNSORTED_SQL, ("WIN-6",)),
    "year_records": Query(year_records, YEAR_SQL, ("AGG-9", "SNK-8")),
    "region_nations": Query(region_nations, NATIONS_SQL, ("AGG-9",)),
    "year_manifest": Query(year_manifest, MANIFEST_SQL, ("AGG-2",)),
    "rate_manifest": Query(rate_manifest, RATE_SQL, ("AGG-3",)),
    "table_manifest": Query(table_manifest, TABLE_SQL, ("AGG-4",)),
    "dataset_catalog": Query(dataset_catalog, DATASET_SQL, ("AGG-5", "AGG-6")),
    "lookup_statistics": Query(lookup_statistics, STATISTICS_SQL, ("AGG-7",)),
    "period_union": Query(period_union, PERIOD_SQL, ("AGG-10",)),
    "row_digest": Query(row_digest, DIGEST_SQL, ("AGG-8",)),
    "content_digest": Query(content_digest, CONTENT_SQL, ("AGG-8",)),
    "natural_sort": Query(natural_sort, SORT_SQL, ("SRT-1",)),
    "sorted_shards": Query(sorted_shards, SHARDS_SQL, ("SRT-2",)),
    "descending_index": Query(descending_index, DESCENDING_SQL, ("SRT-3",)),
    "sheet_order": Query(sheet_order, SHEET_SQL, ("SRT-4",)),
    "term_factors": Query(term_factors, TERM_SQL, ("GEN-1", "QRY-6")),
    "expand_years": Query(expand_years, EXPAND_SQL, ("GEN-2",)),
    "metric_unpivot": Query(metric_unpivot, UNPIVOT_SQL, ("PRJ-33",)),
}
