"""Queries over the three merge dialects and their relatives."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, merge
from .common import ORDER_DAY, Query, num, shown, table, txt

CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


def _orders(spark, folder):
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey", f"{ORDER_DAY} AS date", f"{CENTS} AS rate", "o_orderstatus AS status", "o_orderpriority AS source_url"
    )


def strict_merge(spark, folder):
    """History lacks every third order; the feed brings the even ones, some changed or repeated."""
    rows = _orders(spark, folder)
    k = F.col("o_orderkey")
    history = rows.filter(k % 3 != 0)
    fresh = rows.filter(k % 2 == 0).withColumn("rate", F.when(k % 50 == 0, F.col("rate") + 1).otherwise(F.col("rate")))
    feed = fresh.unionByName(rows.filter(k % 77 == 0))
    result = merge.strict_merge(history, feed, ["o_orderkey"], ["date", "rate", "status"], ["source_url"])
    return shown(result.outcomes.select(*result.columns, "outcome"))


def _old_or_new(column: str) -> str:
    return f"CASE WHEN g.n > 1 THEN h.{column} ELSE COALESCE(h.{column}, g.{column}) END"


# A key that the feed repeats shows its history row, or nothing when it has none.
STRICT_SQL = f"""
WITH h AS (SELECT o_orderkey AS k, {ORDER_DAY} AS d, {CENTS} AS rate, o_orderstatus AS st, o_orderpriority AS p FROM orders WHERE o_orderkey % 3 <> 0),
f AS (SELECT *, {CENTS} + CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS rate FROM orders WHERE o_orderkey % 2 = 0
      UNION ALL SELECT *, {CENTS} AS rate FROM orders WHERE o_orderkey % 77 = 0),
g AS (SELECT o_orderkey AS k, any_value({ORDER_DAY}) AS d, max(rate) AS rate, any_value(o_orderstatus) AS st, any_value(o_orderpriority) AS p, count(*) AS n
      FROM f GROUP BY o_orderkey)
SELECT COALESCE(h.k, g.k) AS o_orderkey, {txt(_old_or_new("d"))} AS date, {num(_old_or_new("rate"))} AS rate,
       {txt(_old_or_new("st"))} AS status, {txt(_old_or_new("p"))} AS source_url,
       CASE WHEN g.n > 1 THEN 'duplicate_source_record' WHEN g.n IS NULL THEN 'kept' WHEN h.k IS NULL THEN 'inserted'
            WHEN h.rate = g.rate THEN 'same' ELSE 'conflicting_record' END AS outcome
FROM h FULL OUTER JOIN g ON h.k = g.k"""


def enrich_merge(spark, folder):
    """History with priorities and totals missing here and there; the feed is complete or conflicting."""
    rows = _orders(spark, folder).withColumnRenamed("source_url", "priority")
    k = F.col("o_orderkey")
    history = rows.filter(k % 5 != 0).select(
        "o_orderkey", "date", F.when(k % 2 == 0, F.col("rate")).alias("rate"),
        F.when(k % 3 == 0, F.col("priority")).alias("priority"),
    )
    feed = rows.filter(k % 7 != 0).select(
        "o_orderkey", "date", F.when(k % 11 != 0, F.col("rate")).alias("rate"),
        F.when(k % 13 == 0, F.lit("changed")).otherwise(F.col("priority")).alias("priority"),
    )
    result = merge.enriching_merge(history, feed, ["o_orderkey"], ["date", "rate", "priority"])
    return shown(result.outcomes.select(*result.columns, "outcome"))


ENRICH_SQL = f"""
WITH h AS (SELECT o_orderkey AS k, {ORDER_DAY} AS d, CASE WHEN o_orderkey % 2 = 0 THEN {CENTS} END AS r,
                  CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS p FROM orders WHERE o_orderkey % 5 <> 0),
f AS (SELECT o_orderkey AS k, {ORDER_DAY} AS d, CASE WHEN o_orderkey % 11 <> 0 THEN {CENTS} END AS r,
             CASE WHEN o_orderkey % 13 = 0 THEN 'changed' ELSE o_orderpriority END AS p FROM orders WHERE o_orderkey % 7 <> 0),
j AS (SELECT h.k AS hk, f.k AS fk, COALESCE(h.k, f.k) AS k, h.d AS hd, f.d AS fd, h.r AS hr, f.r AS fr, h.p AS hp, f.p AS fp,
             (h.r IS NULL OR h.r IS NOT DISTINCT FROM f.r) AND (h.p IS NULL OR h.p IS NOT DISTINCT FROM f.p) AS fits,
             (h.r IS NULL AND f.r IS NOT NULL) OR (h.p IS NULL AND f.p IS NOT NULL) AS fills,
             h.r IS NOT DISTINCT FROM f.r AND h.p IS NOT DISTINCT FROM f.p AS same FROM h FULL OUTER JOIN f ON h.k = f.k),
o AS (SELECT *, CASE WHEN fk IS NULL THEN 'kept' WHEN hk IS NULL THEN 'inserted' WHEN same THEN 'same'
                     WHEN fits AND fills THEN 'enriched' ELSE 'conflicting_record' END AS outcome FROM j)
SELECT k AS o_orderkey, CAST(COALESCE(hd, fd) AS VARCHAR) AS date,
       {num("CASE WHEN outcome IN ('inserted', 'enriched') THEN fr ELSE hr END")} AS rate,
       {txt("CASE WHEN outcome IN ('inserted', 'enriched') THEN fp ELSE hp END")} AS priority, outcome FROM o"""


def tolerant_merge(spark, folder):
    """Periods per customer and day; equal copies are fine, unequal ones are not."""
    rows = table(spark, folder, "orders").selectExpr(
        "o_custkey", f"{ORDER_DAY} AS date", "o_custkey % 97 * 10 + month(o_orderdate) AS amount", "o_orderkey AS source_no"
    )
    s = F.col("source_no")
    history = rows.filter(s % 4 != 0).unionByName(rows.filter(s % 8 == 1))
    feed = rows.filter(s % 2 == 0).withColumn("amount", F.when(s % 90 == 0, F.col("amount") + 1).otherwise(F.col("amount")))
    result = merge.tolerant_merge(history, feed, ["o_custkey", "date"], ["amount"], ["source_no"], ["source_no"])
    return shown(result.outcomes.select(*result.columns, "outcome"))


TOLERANT_SQL = f"""
WITH r AS (SELECT o_custkey AS c, {ORDER_DAY} AS d, o_custkey % 97 * 10 + month(o_orderdate) AS a, o_orderkey AS s FROM orders),
h AS (SELECT c, d, count(DISTINCT a) AS n, max_by(a, s) AS a, max(s) AS s FROM r WHERE s % 4 <> 0 GROUP BY 1, 2),
f AS (SELECT c, d, count(DISTINCT b) AS n, min_by(b, s) AS a, min(s) AS s
      FROM (SELECT *, a + CASE WHEN s % 90 = 0 THEN 1 ELSE 0 END AS b FROM r WHERE s % 2 = 0) GROUP BY 1, 2)
SELECT COALESCE(h.c, f.c) AS o_custkey, CAST(COALESCE(h.d, f.d) AS VARCHAR) AS date, COALESCE(h.a, f.a) AS amount, COALESCE(h.s, f.s) AS source_no,
       CASE WHEN h.n > 1 THEN 'conflicting_record' WHEN f.n > 1 THEN 'duplicate_source_record' WHEN f.n IS NULL THEN 'kept'
            WHEN h.n IS NULL THEN 'inserted' WHEN h.a = f.a THEN 'same' ELSE 'conflicting_record' END AS outcome
FROM h FULL OUTER JOIN f ON h.c = f.c AND h.d = f.d"""


def registry_upsert(spark, folder):
    """Pages as register entries: same bytes may be described anew, other bytes conflict."""
    pages = table(spark, folder, "pages").select(
        F.concat(F.lit("by-year/"), "page_id").alias("path"), "page_id", "url", F.octet_length("html").cast("bigint").alias("bytes"), F.sha2("html", 256).alias("sha256")
    )
    p = F.col("page_id")
    old = pages.filter(p % 3 != 0).select("path", "url", "bytes", "sha256", F.lit("old").alias("title"))
    new = pages.filter(p % 2 == 0).select(
        "path", "url", F.when(p % 10 == 0, F.col("bytes") + 1).otherwise(F.col("bytes")).alias("bytes"), "sha256",
        F.when(p % 4 == 0, F.lit("new")).otherwise(F.lit("old")).alias("title"),
    )
    result = merge.upsert(old, new, "path", ["url", "bytes", "sha256"], ["path", "url", "bytes", "sha256", "title"])
    return shown(result.outcomes.select("path", "url", "bytes", "title", "outcome"))


UPSERT_SQL = """
WITH p AS (SELECT page_id, url, octet_length(encode(html)) AS bytes FROM pages),
j AS (SELECT page_id, url, page_id % 3 <> 0 AS h, page_id % 2 = 0 AS f, bytes FROM p)
SELECT 'by-year/' || page_id AS path, url, CAST(bytes + CASE WHEN f AND page_id % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS bytes,
       CASE WHEN f AND page_id % 4 = 0 THEN 'new' ELSE 'old' END AS title,
       CASE WHEN NOT f THEN 'kept' WHEN NOT h THEN 'inserted' WHEN page_id % 10 = 0 THEN 'conflicting_record'
            WHEN page_id % 4 = 0 THEN 'enriched' ELSE 'same' END AS outcome
FROM j WHERE h OR f"""


def partial_combine(spark, folder):
    """Open and filled halves of an order line united column by column."""
    li = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) END AS open_quantity",
        "CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) END AS filled_quantity",
        "CASE WHEN l_linenumber > 3 THEN l_returnflag END AS flag",
    )
    result = merge.combine_partial(li, ["l_orderkey", "l_linenumber"], ["open_quantity", "filled_quantity", "flag"])
    return shown(result.outcomes.select(*result.columns, "outcome"))


PARTIAL_SQL = f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, {num("min(l_quantity) FILTER (l_linestatus = 'O')")} AS open_quantity,
       {num("min(l_quantity) FILTER (l_linestatus = 'F')")} AS filled_quantity, {txt("min(CASE WHEN l_linenumber > 3 THEN l_returnflag END)")} AS flag,
       CASE WHEN count(DISTINCT l_quantity) FILTER (l_linestatus = 'O') > 1 OR count(DISTINCT l_quantity) FILTER (l_linestatus = 'F') > 1
                 OR count(DISTINCT CASE WHEN l_linenumber > 3 THEN l_returnflag END) > 1 THEN 'conflicting_record' ELSE 'inserted' END AS outcome
FROM lineitem GROUP BY l_orderkey, l_linenumber"""


def run_metrics(spark, folder):
    """Counts of one merge run: source, existing, final and whether it changed anything."""
    rows = _orders(spark, folder)
    k = F.col("o_orderkey")
    result = merge.strict_merge(rows.filter(k % 3 != 0), rows.filter(k % 2 == 0), ["o_orderkey"], ["date", "rate", "status"])
    again = merge.strict_merge(result.records, rows.filter(k % 2 == 0).select(*result.columns), ["o_orderkey"], ["date", "rate", "status"])
    return shown(
        result.metrics().select(F.lit("first").alias("run"), "*").unionByName(again.metrics().select(F.lit("second").alias("run"), "*"))
    )


METRICS_SQL = """
WITH c AS (SELECT count(*) FILTER (o_orderkey % 2 = 0) AS s, count(*) FILTER (o_orderkey % 3 <> 0) AS e,
                  count(*) FILTER (o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0) AS f FROM orders)
SELECT 'first' AS run, s AS source, e AS existing, f AS final, CAST(f > e AS BIGINT) AS changed FROM c
UNION ALL SELECT 'second', s, f, f, 0 FROM c"""


def corrections(spark, folder):
    """Known-wrong (nation, region) tuples put right, customers carry the fixed region."""
    nation = table(spark, folder, "nation")
    fixes = nation.filter(F.col("n_nationkey") % 4 == 0).selectExpr(
        "n_nationkey", "CASE WHEN n_nationkey % 8 = 0 THEN n_regionkey ELSE n_regionkey + 1 END AS n_regionkey", "n_regionkey + 100 AS corrected"
    )
    rows = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "n_nationkey", "n_regionkey"
    )
    return shown(joins.apply_corrections(rows, fixes, ["n_nationkey", "n_regionkey"], "n_regionkey", "corrected"))


CORRECTIONS_SQL = """
SELECT c_custkey, CAST(n_nationkey AS BIGINT) AS n_nationkey, CAST(CASE WHEN n_nationkey % 8 = 0 THEN n_regionkey + 100 ELSE n_regionkey END AS BIGINT) AS n_regionkey
FROM customer JOIN nation ON c_nationkey = n_nationkey"""


QUERIES = {
    "strict_merge": Query(strict_merge, STRICT_SQL, ("JN-1", "AGG-0")),
    "enrich_merge": Query(enrich_merge, ENRICH_SQL, ("JN-2",)),
    "tolerant_merge": Query(tolerant_merge, TOLERANT_SQL, ("JN-3",)),
    "registry_upsert": Query(registry_upsert, UPSERT_SQL, ("JN-4",)),
    "partial_combine": Query(partial_combine, PARTIAL_SQL, ("AGG-1",)),
    "run_metrics": Query(run_metrics, METRICS_SQL, ("AGG-11",)),
    "corrections": Query(corrections, CORRECTIONS_SQL, ("JN-5",)),
}
