"""Queries over joins, set operations and integrity checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates, joins, sets
from .common import ORDER_DAY, Query, shown, table


def _period_rows(spark, folder, where: str, days: str):
    return table(spark, folder, "orders").where(where).selectExpr(
        "o_orderkey", f"{ORDER_DAY} AS s", f"date_add({ORDER_DAY}, CAST({days} AS INT)) AS e"
    )


def overlap_replace(spark, folder):
    """Order periods survive unless a feed period overlaps them without being equal."""
    history = _period_rows(spark, folder, "o_orderkey % 4 <> 0", "o_orderkey % 3")
    feed = _period_rows(spark, folder, "o_custkey % 20 = 0 AND month(o_orderdate) % 2 = 0", "o_orderkey % 2")
    return shown(joins.drop_overlapped(history, feed, "s", "e"))


OVERLAP_SQL = f"""
WITH h AS (SELECT o_orderkey, {ORDER_DAY} AS s, {ORDER_DAY} + CAST(o_orderkey % 3 AS INT) AS e FROM orders WHERE o_orderkey % 4 <> 0),
f AS (SELECT DISTINCT {ORDER_DAY} AS s, {ORDER_DAY} + CAST(o_orderkey % 2 AS INT) AS e FROM orders WHERE o_custkey % 20 = 0 AND month(o_orderdate) % 2 = 0),
k AS (SELECT DISTINCT s, e FROM h),
kept AS (SELECT s, e FROM k WHERE EXISTS (SELECT 1 FROM f WHERE f.s = k.s AND f.e = k.e)
                               OR NOT EXISTS (SELECT 1 FROM f WHERE k.s <= f.e AND f.s <= k.e))
SELECT h.o_orderkey, CAST(h.s AS VARCHAR) AS s, CAST(h.e AS VARCHAR) AS e FROM h JOIN kept ON h.s = kept.s AND h.e = kept.e"""


def overlap_replace_by_customer(spark, folder):
    """The same rule inside each customer."""
    history = table(spark, folder, "orders").where("o_orderkey % 3 <> 0").selectExpr("o_custkey", "o_orderkey", f"{ORDER_DAY} AS s", f"date_add({ORDER_DAY}, 120) AS e")
    feed = table(spark, folder, "orders").where("o_orderkey % 3 = 0").selectExpr("o_custkey", f"{ORDER_DAY} AS s", f"date_add({ORDER_DAY}, 30) AS e")
    return shown(joins.drop_overlapped(history, feed, "s", "e", ["o_custkey"]))


OVERLAP_CUSTOMER_SQL = f"""
WITH h AS (SELECT o_custkey, o_orderkey, {ORDER_DAY} AS s, {ORDER_DAY} + 120 AS e FROM orders WHERE o_orderkey % 3 <> 0),
f AS (SELECT o_custkey, {ORDER_DAY} AS s, {ORDER_DAY} + 30 AS e FROM orders WHERE o_orderkey % 3 = 0)
SELECT o_custkey, o_orderkey, CAST(s AS VARCHAR) AS s, CAST(e AS VARCHAR) AS e FROM h
WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.o_custkey = h.o_custkey AND h.s <= f.e AND f.s <= h.e)"""


def containment(spark, folder):
    """Wanted (day, kinds) of a user for which some session day of the register holds them all."""
    ev = table(spark, folder, "events").withColumn("day", F.dayofmonth("ts").cast("string"))
    register = ev.groupBy("user_id", F.weekofyear("ts").alias("week")).agg(
        F.collect_set("event_type").alias("kinds"), F.collect_set("day").alias("days")
    )
    wanted = ev.filter(F.col("event_id") % 3 == 0).select(
        "event_id", "user_id",
        F.array(F.lit("purchase"), F.col("event_type")).alias("want_kinds"), F.array("day").alias("want_days"),
    )
    found = joins.contains_all(wanted, register, "user_id", {"kinds": ("want_kinds", "kinds"), "days": ("want_days", "days")})
    return shown(found.select("event_id", "user_id"))


CONTAINMENT_SQL = """
SELECT event_id, user_id FROM events e WHERE event_id % 3 = 0 AND EXISTS (
  SELECT 1 FROM events r WHERE r.user_id = e.user_id AND r.event_type = 'purchase' AND weekofyear(r.ts) = weekofyear(e.ts))"""


def archived_skip(spark, folder):
    """Users that still need work: some archived day of theirs is missing from the months known."""
    ev = table(spark, folder, "events")
    register = ev.filter(F.col("event_type") == "purchase").groupBy("user_id", F.weekofyear("ts").alias("week")).agg(
        F.collect_set(F.dayofmonth("ts").cast("string")).alias("periods"), F.collect_set("event_type").alias("subjects")
    )
    periods = joins.archived_periods(register, "user_id", "periods", "subjects", ["purchase"])
    known = ev.filter(F.dayofmonth("ts") <= 27).select(F.dayofmonth("ts").cast("string").alias("day"))
    users = ev.select("user_id").distinct()
    return shown(joins.not_yet_archived(users, "user_id", periods, known, "day"))


ARCHIVED_SQL = """
SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (
  SELECT user_id FROM events WHERE event_type = 'purchase' GROUP BY user_id HAVING bool_and(dayofmonth(ts) <= 27))"""


def reference_gaps(spark, folder):
    """Order keys that the lines name and orders lack, or the reverse."""
    li = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("k"))
    orders = table(spark, folder, "orders").filter(F.col("o_orderkey") % 13 != 0).select(F.col("o_orderkey").alias("k"))
    return shown(joins.reference_gaps(li, orders, "k"))


GAPS_SQL = """
WITH l AS (SELECT DISTINCT l_orderkey AS k FROM lineitem), o AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 13 <> 0)
SELECT k, 'missing_file' AS gap FROM l ANTI JOIN o USING (k) UNION ALL SELECT k, 'unreferenced_file' FROM o ANTI JOIN l USING (k)"""


def preserved_rows(spark, folder):
    """Register rows win; index rows stay for periods that no entry covers."""
    orders = table(spark, folder, "orders").withColumn("period", F.date_format(F.to_date("o_orderdate"), "yyyy-MM"))
    rows = orders.filter(F.col("o_orderstatus") == "P").select("period", F.col("o_orderkey").cast("string").alias("title"))
    entries = orders.filter(F.col("o_orderkey") % 500 == 0).select(F.array("period").alias("periods"), F.concat(F.lit("entry "), "o_orderkey").alias("title"))
    entry_rows = entries.select(F.array_join("periods", ", ").alias("period"), "title")
    return shown(joins.keep_unarchived_rows(rows, "period", entries, entry_rows, "periods"))


PRESERVED_SQL = """
WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS period FROM orders)
SELECT period, 'entry ' || o_orderkey AS title FROM o WHERE o_orderkey % 500 = 0
UNION ALL SELECT period, CAST(o_orderkey AS VARCHAR) FROM o WHERE o_orderstatus = 'P' AND period NOT IN (SELECT period FROM o WHERE o_orderkey % 500 = 0)"""


def catalog_consistency(spark, folder):
    """Customers as datasets: index, manifest and metadata lines that disagree."""
    c = table(spark, folder, "customer").select(F.concat(F.lit("d"), "c_custkey").alias("dataset_path"), "c_custkey", F.col("c_name").alias("schema_id"), F.lit(1).alias("schema_version"))
    k = F.col("c_custkey")
    index = c.filter(k % 10 != 0)
    manifests = c.filter(k % 15 != 0).withColumn("schema_id", F.when(k % 7 == 0, F.lit("other")).otherwise(F.col("schema_id")))
    metadata = c.filter(k % 25 != 0).withColumn("schema_version", F.when(k % 11 == 0, F.lit(2)).otherwise(F.lit(1)))
    return shown(joins.catalog_mismatches(index, manifests, metadata, "dataset_path", ["schema_id", "schema_version"]))


CATALOG_SQL = """
WITH c AS (SELECT c_custkey AS k, c_custkey % 10 <> 0 AS i, c_custkey % 15 <> 0 AS m, c_custkey % 25 <> 0 AS d FROM customer),
x AS (SELECT * FROM c WHERE i OR m OR d)
SELECT 'd' || k AS dataset_path, 'index missing' AS reason FROM x WHERE NOT i
UNION ALL SELECT 'd' || k, 'manifest missing' FROM x WHERE NOT m UNION ALL SELECT 'd' || k, 'metadata missing' FROM x WHERE NOT d
UNION ALL SELECT 'd' || k, 'schema_id mismatch' FROM x WHERE i AND m AND d AND k % 7 = 0
UNION ALL SELECT 'd' || k, 'schema_version mismatch' FROM x WHERE i AND m AND d AND k % 11 = 0"""


def published_differences(spark, folder):
    """Rows that differ between canonical orders and a copy with late and changed rows."""
    rows = table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").cast("string").alias("date"), "o_orderstatus")
    k = F.col("o_orderkey")
    copy = rows.filter(k % 40 != 0).withColumn("o_orderstatus", F.when(k % 33 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")))
    return shown(joins.row_differences(copy, rows))


DIFFERENCES_SQL = """
WITH r AS (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, o_orderstatus FROM orders),
c AS (SELECT o_orderkey, date, CASE WHEN o_orderkey % 33 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM r WHERE o_orderkey % 40 <> 0)
SELECT *, 1 AS left_rows, 0 AS right_rows FROM (SELECT * FROM c EXCEPT SELECT * FROM r)
UNION ALL SELECT *, 0, 1 FROM (SELECT * FROM r EXCEPT SELECT * FROM c)"""


def union_sources(spark, folder):
    """Existing, fetched and static rows in one set, with where each came from."""
    orders = table(spark, folder, "orders")
    def part(origin, condition):
        return orders.filter(condition).select(F.lit(origin).alias("origin"), F.year(F.to_date("o_orderdate")).alias("year"), "o_orderkey")
    rows = sets.union_sources(part("existing", "o_orderkey % 3 = 0"), part("fetched", "o_orderkey % 2 = 0"), part("static", "o_orderkey % 100 = 7"))
    return shown(rows.groupBy("origin", "year").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key")))


UNION_SQL = """
SELECT origin, year(o_orderdate) AS year, count(*) AS n, min(o_orderkey) AS first_key
FROM orders, (VALUES ('existing', 3, 0), ('fetched', 2, 0), ('static', 100, 7)) v(origin, m, r) WHERE o_orderkey % m = r GROUP BY 1, 2"""


def key_status(spark, folder):
    """Months present in history against months expected from the feed."""
    orders = table(spark, folder, "orders").withColumn("month", F.date_format(F.to_date("o_orderdate"), "yyyy-MM"))
    return shown(sets.key_status(orders.filter("o_custkey % 100 < 60 AND o_orderstatus = 'P' AND month(o_orderdate) <> 5"),
                                 orders.filter("month(o_orderdate) <> 7"), ["month"]))


STATUS_SQL = """
WITH o AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders),
p AS (SELECT DISTINCT month FROM o WHERE o_custkey % 100 < 60 AND o_orderstatus = 'P' AND month(o_orderdate) <> 5),
e AS (SELECT DISTINCT month FROM o WHERE month(o_orderdate) <> 7)
SELECT month, CASE WHEN month IN (SELECT month FROM p) AND month IN (SELECT month FROM e) THEN 'both' WHEN month IN (SELECT month FROM p) THEN 'stale' ELSE 'missing' END AS status
FROM (SELECT month FROM p UNION SELECT month FROM e)"""


def stale_keys(spark, folder):
    """Customers with history but no expected order."""
    orders = table(spark, folder, "orders")
    return shown(sets.key_difference(orders, orders.filter("o_orderpriority <> '1-URGENT' AND o_orderkey % 5 = 0"), ["o_custkey"]))


STALE_SQL = """
SELECT DISTINCT o_custkey FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_orderkey % 5 = 0"""


def set_equality(spark, folder):
    """Pairs of key sets that are, or are not, the same."""
    li, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    k = orders.select(F.col("o_orderkey").alias("k"))
    pairs = {
        "orders and orders": (k, k.unionByName(k)),
        "orders and lines": (k, li.select(F.col("l_orderkey").alias("k"))),
    }
    lines = None
    for name, (left, right) in pairs.items():
        line = sets.key_status(left, right, ["k"]).agg(
            F.lit(name).alias("pair"), F.count(F.when(F.col("status") != "both", 1)).alias("differing"), F.count(F.lit(1)).alias("total_keys")
        )
        lines = line if lines is None else lines.unionByName(line)
    return shown(lines)


EQUALITY_SQL = """
SELECT 'orders and orders' AS pair, 0 AS differing, count(*) AS total_keys FROM orders
UNION ALL SELECT 'orders and lines', (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem))
   + (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)),
   (SELECT count(*) FROM (SELECT o_orderkey FROM orders UNION SELECT l_orderkey FROM lineitem))"""


def duplicate_keys(spark, folder):
    return shown(aggregates.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]))


DUPLICATE_SQL = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""


QUERIES = {
    "overlap_replace": Query(overlap_replace, OVERLAP_SQL, ("JN-7",)),
    "overlap_replace_by_customer": Query(overlap_replace_by_customer, OVERLAP_CUSTOMER_SQL, ("JN-7",)),
    "containment": Query(containment, CONTAINMENT_SQL, ("JN-8",)),
    "archived_skip": Query(archived_skip, ARCHIVED_SQL, ("JN-9", "AGG-10")),
    "reference_gaps": Query(reference_gaps, GAPS_SQL, ("JN-10",)),
    "preserved_rows": Query(preserved_rows, PRESERVED_SQL, ("JN-11",)),
    "catalog_consistency": Query(catalog_consistency, CATALOG_SQL, ("JN-12",)),
    "published_differences": Query(published_differences, DIFFERENCES_SQL, ("JN-13", "SET-3")),
    "union_sources": Query(union_sources, UNION_SQL, ("SET-1",)),
    "key_status": Query(key_status, STATUS_SQL, ("SET-2",)),
    "stale_keys": Query(stale_keys, STALE_SQL, ("SET-2",)),
    "set_equality": Query(set_equality, EQUALITY_SQL, ("SET-3",)),
    "duplicate_keys": Query(duplicate_keys, DUPLICATE_SQL, ("AGG-0",)),
}
