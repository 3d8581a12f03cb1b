"""Queries over filters and contract checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.decoded import with_decoded
from ..functions.numbers import percent_basis_points
from ..operators import checks
from ..registry import dataset
from ..sources import feeds
from .common import ABSENT, Query, shown, table


def blank_rows(spark, folder):
    cells = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "CASE WHEN l_linenumber > 2 THEN l_returnflag ELSE ' ' END AS a",
        "CASE WHEN l_linenumber > 1 AND l_linestatus = 'O' THEN 'x' WHEN l_linenumber = 2 THEN '\t' END AS b",
    )
    return shown(checks.drop_blank_rows(cells, ["a", "b"]))


BLANK_SQL = """
SELECT * FROM (
  SELECT l_orderkey, CASE WHEN l_linenumber > 2 THEN l_returnflag ELSE ' ' END AS a,
         CASE WHEN l_linenumber > 1 AND l_linestatus = 'O' THEN 'x' WHEN l_linenumber = 2 THEN chr(9) ELSE '' END AS b FROM lineitem)
WHERE trim(a) <> '' OR trim(b, chr(9) || ' ') <> ''"""


def observed_rows(spark, folder):
    """Purchases and clicks as secured-rate rows of their day and number; those with a rate are observations."""
    ev = table(spark, folder, "events").filter(F.col("event_type").isin("purchase", "click"))
    figures = {c: F.lit(None).cast("bigint") for c in feeds.WIDE_VALUES}
    figures["rate_basis_points"] = F.expr("CASE WHEN event_id % 4 <> 0 THEN CAST(round(value * 100) AS BIGINT) END")
    figures["volume_billions"] = F.col("event_id")
    figures[feeds.AVERAGED[0]] = F.col("event_id")
    wide = ev.select(F.to_date("ts").alias("date"), *[v.alias(c) for c, v in figures.items()])
    return shown(feeds.observations(wide))


OBSERVED_SQL = f"""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CAST(round(value * 100) AS BIGINT) AS rate_basis_points, {", ".join(f"{ABSENT} AS percentile_{p}_basis_points" for p in (1, 25, 75, 99))},
       event_id AS volume_billions FROM events
WHERE event_type IN ('purchase', 'click') AND event_id % 4 <> 0"""


def foreign_types(spark, folder):
    ev = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    found = checks.violations(ev, ["event_id"], {"rate type": (F.col("event_type") == "error", "invalid_csv")})
    return shown(found.groupBy("rule", "code").agg(F.count(F.lit(1)).alias("n"), F.min(F.col("key").cast("bigint")).alias("first_id")))


FOREIGN_SQL = """
SELECT 'rate type' AS rule, 'invalid_csv' AS code, count(*) AS n, min(event_id) AS first_id FROM events WHERE event_type = 'error' HAVING count(*) > 0"""


def contract_violations(spark, folder):
    """Schema rules of the daily rate set plus bounds, over orders read as records."""
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 101 <> 0 THEN CAST(o_orderdate AS DATE) END AS date",
        "CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_custkey * 1000 - 50000 END AS INT) AS rate_basis_points",
    )
    rules = checks.schema_rules(dataset("federal-funds").schema) | checks.range_rules({"rate_basis_points": (0, 100_000)})
    return shown(checks.violations(rows, ["o_orderkey"], rules))


CONTRACT_SQL = """
WITH r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey * 1000 - 50000 END AS rate FROM orders)
SELECT 'date required' AS rule, CAST(o_orderkey AS VARCHAR) AS key, 'invalid_record' AS code FROM r WHERE o_orderkey % 101 = 0
UNION ALL SELECT 'rate_basis_points minimum', CAST(o_orderkey AS VARCHAR), 'invalid_record' FROM r WHERE rate < 0
UNION ALL SELECT 'rate_basis_points range', CAST(o_orderkey AS VARCHAR), 'out_of_range' FROM r WHERE rate < 0 OR rate > 100000"""


def json_contract(spark, folder):
    """Exact keys and no repeated key, on event properties with extra shapes added."""
    raw = table(spark, folder, "events").select(
        "event_id",
        F.expr(
            "CASE event_id % 5 WHEN 0 THEN concat(substr(props, 1, length(props) - 1), ', \"k\": 1}') "
            "WHEN 1 THEN concat(substr(props, 1, length(props) - 1), ', \"z\": 1}') WHEN 2 THEN '{broken' ELSE props END"
        ).alias("raw"),
    )
    out = raw.select(
        "event_id", checks.has_repeated_json_key(F.col("raw")).alias("unreadable"),
        checks.key_set_differs(F.col("raw"), [["k"], ["k", "v"]]).alias("wrong_keys"),
        F.get_json_object("raw", "$.k").try_cast("bigint").alias("k"),
    )
    return shown(out.select("event_id", "unreadable", F.when(F.col("unreadable"), F.lit(True)).otherwise(F.col("wrong_keys")).alias("rejected"),
                            F.when(F.col("unreadable"), None).otherwise(F.col("k")).alias("k")))


JSON_SQL = """
SELECT event_id, CAST(event_id % 5 IN (0, 2) AS BIGINT) AS unreadable, CAST(event_id % 5 <= 2 AS BIGINT) AS rejected,
       CASE WHEN event_id % 5 IN (0, 2) THEN -999999 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
FROM events"""


def target_year(spark, folder):
    """Periods made of order dates; kept when they are the polled calendar year, else why not."""
    d = F.to_date("o_orderdate")
    whole = F.col("o_orderkey") % 2 == 0
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(whole, F.make_date(F.year(d), F.lit(1), F.lit(1))).otherwise(d).alias("period_start_date"),
        F.when(whole, F.make_date(F.year(d), F.lit(12), F.lit(31))).otherwise(F.date_sub(d, (F.col("o_orderkey") % 5 - 2).cast("int"))).alias("period_end_date"),
    )
    s, e = F.col("period_start_date"), F.col("period_end_date")
    return shown(rows.select("o_orderkey", checks.in_target_year(s, e, 1998).alias("wanted"),
                             (s > e).alias("reversed"), checks.whole_period(s, e).alias("whole_year")))


TARGET_SQL = """
WITH r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN make_date(year(d), 1, 1) ELSE d END AS s,
             CASE WHEN o_orderkey % 2 = 0 THEN make_date(year(d), 12, 31) ELSE d - CAST(o_orderkey % 5 - 2 AS INT) END AS e FROM r)
SELECT o_orderkey, CAST(s = DATE '1998-01-01' AND e = DATE '1998-12-31' AS BIGINT) AS wanted, CAST(s > e AS BIGINT) AS reversed,
       CAST(strftime(s, '%m-%d') = '01-01' AND strftime(e, '%m-%d') = '12-31' AND year(s) = year(e) AS BIGINT) AS whole_year
FROM p"""


def ruling_documents(spark, folder):
    docs = table(spark, folder, "documents").select(
        "doc_id", "lang", F.when(F.col("doc_id") % 6 == 0, F.concat("text", F.lit(" Applicable Federal Rates (AFR) for May 2001"))).otherwise(F.col("text")).alias("text")
    )
    return shown(docs.filter(checks.is_rate_ruling(F.col("text"))).select("doc_id", "lang", F.length("text").alias("n_chars")))


RULING_SQL = """
SELECT doc_id, lang, CAST(length(text) + 44 AS BIGINT) AS n_chars FROM documents WHERE doc_id % 6 = 0"""


def magic_bytes(spark, folder):
    body = table(spark, folder, "pages").select(
        "page_id", F.encode(F.expr("CASE page_id % 3 WHEN 0 THEN concat('%PDF-', html) WHEN 1 THEN concat(repeat(' ', 1019), '%PDF-', html) ELSE concat(repeat(' ', 1020), '%PDF-', html) END"), "UTF-8").alias("content")
    )
    return shown(body.select("page_id", checks.is_pdf(F.col("content")).alias("is_pdf"), checks.has_magic(F.col("content"), "<html", 4096).alias("is_html")))


MAGIC_SQL = """
SELECT page_id, CAST(page_id % 3 < 2 AS BIGINT) AS is_pdf, CAST(contains(html[:2500], '<html') AS BIGINT) AS is_html FROM pages"""


def cardinality(spark, folder):
    """Tables that miss an expected number of rows."""
    expected = {"region": 5, "nation": 25, "supplier": None, "part": 1}
    parts = [
        checks.count_violation(table(spark, folder, name), n).select(F.lit(name).alias("table_name"), "rule", F.col("key").cast("bigint").alias("n"), "code")
        for name, n in expected.items()
    ]
    return shown(checks.all_violations(*parts))


CARDINALITY_SQL = """
SELECT 'part' AS table_name, 'cardinality' AS rule, count(*) AS n, 'invalid_source' AS code FROM part HAVING count(*) <> 1"""


def registry_arguments(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 9 == 0, F.lit("98")).otherwise(F.date_format(F.to_date("o_orderdate"), "yyyy")).alias("year"),
        F.expr("CASE o_orderkey % 8 WHEN 0 THEN array() WHEN 1 THEN array('1998-1', '1998-02') ELSE array(date_format(o_orderdate, 'yyyy-MM')) END").alias("periods"),
        F.expr("CASE o_orderkey % 7 WHEN 0 THEN array() WHEN 1 THEN array('afr', 'other') ELSE array('afr', 'section-7520-rates') END").alias("subjects"),
    )
    return shown(checks.violations(rows, ["o_orderkey"], checks.registry_argument_rules("year", "periods", "subjects")))


REGISTRY_SQL = """
SELECT rule, CAST(o_orderkey AS VARCHAR) AS key, 'bad_arguments' AS code FROM orders,
  (VALUES ('year shape', 9, 0), ('periods given', 8, 0), ('periods shape', 8, 1), ('subjects given', 7, 0), ('subjects allowed', 7, 1)) v(rule, m, r)
WHERE o_orderkey % m = r"""


def nested_completeness(spark, folder):
    """Order lines as cells of a nested table: months whose grid of flags by status by line has a gap."""
    li = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.expr("CASE WHEN l_linenumber <> 4 THEN CAST(round(l_tax * 10000) AS BIGINT) END").alias("value")
    )
    return shown(checks.nested_complete(li, ["k"], 4, li))


COMPLETE_SQL = """
SELECT 'nested completeness' AS rule, CAST(l_orderkey AS VARCHAR) AS key, 'missing_field' AS code
FROM lineitem GROUP BY l_orderkey HAVING count(*) FILTER (l_linenumber <> 4) <> 4"""


def percent_violations(spark, folder):
    """Violations that strict decoding finds in order prices read as percents."""
    cells = table(spark, folder, "orders").selectExpr("o_orderkey", "CAST(CAST(o_totalprice / 1000 AS DECIMAL(12,3)) AS STRING) AS cell")
    out = with_decoded(cells, {"rate": percent_basis_points(F.col("cell"))})
    return shown(checks.bad_field_violations(out, ["o_orderkey"], "invalid_percent"))


PERCENT_SQL = """
SELECT 'rate' AS rule, CAST(o_orderkey AS VARCHAR) AS key, 'invalid_percent' AS code FROM orders
WHERE CAST(CAST(o_totalprice / 1000 AS DECIMAL(12,3)) * 1000 AS BIGINT) % 10 <> 0 OR o_totalprice / 1000 > 1000"""


QUERIES = {
    "blank_rows": Query(blank_rows, BLANK_SQL, ("FLT-1",)),
    "observed_rows": Query(observed_rows, OBSERVED_SQL, ("FLT-2", "FLT-3")),
    "foreign_types": Query(foreign_types, FOREIGN_SQL, ("FLT-4",)),
    "contract_violations": Query(contract_violations, CONTRACT_SQL, ("FLT-5", "FLT-7")),
    "json_contract": Query(json_contract, JSON_SQL, ("FLT-6", "FLT-12")),
    "target_year": Query(target_year, TARGET_SQL, ("FLT-9", "FLT-13")),
    "ruling_documents": Query(ruling_documents, RULING_SQL, ("FLT-10",)),
    "magic_bytes": Query(magic_bytes, MAGIC_SQL, ("FLT-11",)),
    "cardinality": Query(cardinality, CARDINALITY_SQL, ("FLT-14",)),
    "registry_arguments": Query(registry_arguments, REGISTRY_SQL, ("FLT-15",)),
    "nested_completeness": Query(nested_completeness, COMPLETE_SQL, ("FLT-8",)),
    "percent_violations": Query(percent_violations, PERCENT_SQL, ("PRJ-1", "FLT-7")),
}
