"""Queries over the column decoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, numbers, records, text, urls
from ..functions.decoded import with_decoded
from ..functions.records import classify_table
from .common import Query, num, shown, table, txt


def percent_decode(spark, folder):
    cells = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_tax", "l_quantity",
        "CAST(CAST(l_discount * 100 AS DECIMAL(12,2)) AS STRING) AS d",
    ).selectExpr(
        "l_orderkey", "l_linenumber",
        "CASE l_linenumber WHEN 7 THEN 'N/A' WHEN 6 THEN ' . ' WHEN 5 THEN concat(d, '5') ELSE d END AS rate",
        "CAST(CAST(l_tax * 100 AS DECIMAL(12,5)) AS STRING) AS average",
        "CAST(CAST(l_quantity AS DECIMAL(18,8)) AS STRING) AS level",
    )
    out = with_decoded(
        cells,
        {
            "rate_bp": numbers.percent_basis_points(F.col("rate")),
            "average_bp_e3": numbers.percent_basis_points_thousandths(F.col("average")),
            "level_e8": numbers.index_hundred_millionths(F.col("level")),
        },
    )
    return shown(out.select("l_orderkey", "l_linenumber", "rate_bp", "average_bp_e3", "level_e8",
                            F.array_join("bad_fields", ",").alias("bad")))


PERCENT_SQL = f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       {num("CASE WHEN l_linenumber < 5 THEN round(l_discount * 10000) END")} AS rate_bp,
       CAST(round(l_tax * 10000) AS BIGINT) * 1000 AS average_bp_e3,
       CAST(l_quantity AS BIGINT) * 100000000 AS level_e8,
       CASE WHEN l_linenumber = 5 THEN 'rate_bp' ELSE '' END AS bad
FROM lineitem"""


def signed_decode(spark, folder):
    cells = table(spark, folder, "customer").selectExpr(
        "c_custkey", "CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) AS cell"
    )
    out = with_decoded(cells, {"balance_bp": numbers.signed_percent_basis_points(F.col("cell"))})
    return shown(out.select("c_custkey", "balance_bp", (F.size("bad_fields") > 0).alias("bad")))


SIGNED_SQL = f"""
SELECT c_custkey,
       {num("CASE WHEN abs(CAST(c_acctbal AS DECIMAL(12,2))) <= 1000 THEN round(c_acctbal * 100) END")} AS balance_bp,
       CAST(abs(CAST(c_acctbal AS DECIMAL(12,2))) > 1000 AS BIGINT) AS bad
FROM customer"""


def count_decode(spark, folder):
    cells = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        "CASE l_linenumber WHEN 7 THEN 'NA' WHEN 6 THEN concat('-', l_partkey) WHEN 5 THEN concat(l_partkey, '0000000') "
        "ELSE CAST(l_partkey AS STRING) END AS volume",
        "CASE l_linenumber WHEN 1 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), '.0') "
        "WHEN 2 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), '.5') ELSE concat(' ', CAST(l_quantity AS INT)) END AS cell",
        "l_linenumber <= 2 AS is_number",
    )
    out = with_decoded(cells, {"volume_n": numbers.count_value(F.col("volume"))})
    return shown(out.select("l_orderkey", "l_linenumber", "volume_n", (F.size("bad_fields") > 0).alias("bad"),
                            numbers.cell_integer(F.col("cell"), F.col("is_number")).alias("cell_n")))


COUNT_SQL = f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       {num("CASE WHEN l_linenumber < 5 THEN l_partkey WHEN l_linenumber = 5 AND l_partkey <= 1 THEN l_partkey * 10000000 END")} AS volume_n,
       CAST(l_linenumber = 6 OR (l_linenumber = 5 AND l_partkey > 1) AS BIGINT) AS bad,
       {num("CASE WHEN l_linenumber <> 2 THEN CAST(l_quantity AS INT) END")} AS cell_n
FROM lineitem"""


def factor_half_up(spark, folder):
    cells = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "l_linenumber",
        "concat(CAST(l_suppkey AS STRING), '.', lpad(CAST((l_orderkey * 7919 + l_partkey * 104729) % 10000000 AS STRING), 7, '0')) AS cell",
    )
    return shown(cells.select("l_orderkey", "l_partkey", "l_linenumber", numbers.millionths(F.col("cell")).alias("factor_e6")))


FACTOR_SQL = """
SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       l_suppkey * 1000000 + ((l_orderkey * 7919 + l_partkey * 104729) % 10000000 + 5) // 10 AS factor_e6
FROM lineitem"""


def cell_rates(spark, folder):
    cells = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        "CASE l_linenumber % 4 WHEN 0 THEN concat(CAST(CAST(l_tax * 100 AS DECIMAL(9,1)) AS STRING), '%') "
        "WHEN 1 THEN concat('Interest Rate of ', CAST(CAST(l_tax * 100 AS DECIMAL(9,1)) AS STRING), ' Percent') "
        "WHEN 2 THEN CAST(CAST(l_tax AS DECIMAL(9,4)) AS STRING) ELSE 'not a rate' END AS cell",
        "l_linenumber % 4 = 2 AS is_number",
    )
    return shown(cells.select("l_orderkey", "l_linenumber", numbers.cell_rate(F.col("cell"), F.col("is_number")).alias("rate_bp")))


CELL_RATE_SQL = f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       {num("CASE WHEN l_linenumber % 4 <> 3 THEN round(l_tax * 10000) END")} AS rate_bp
FROM lineitem"""


def dates_decode(spark, folder):
    cells = table(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate")).select(
        "o_orderkey",
        F.date_format("day", "M/d/yyyy").alias("loose"),
        F.when(F.col("o_orderkey") % 5 == 0, F.date_format("day", "MM/32/yyyy")).otherwise(F.date_format("day", "MM/dd/yyyy")).alias("padded"),
        F.when(F.col("o_orderkey") % 7 == 0, F.date_format("day", "yyyyMMdd")).otherwise(F.date_format("day", "yyyy-MM-dd")).alias("iso"),
        F.date_format("day", "MMMM yyyy").alias("month"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("0987")).otherwise(F.date_format("day", "yyyy")).alias("year"),
    )
    out = with_decoded(
        cells,
        {
            "loose_date": dates.slash_date(F.col("loose")),
            "padded_date": dates.padded_slash_date(F.col("padded")),
            "iso_date": dates.iso_date(F.col("iso")),
            "month_key": dates.month_name_year(F.col("month")),
            "year_n": numbers.year_number(F.col("year")),
        },
    )
    return shown(out.select("o_orderkey", "loose_date", "padded_date", "iso_date", "month_key", "year_n",
                            F.array_join("bad_fields", ",").alias("bad")))


DATES_SQL = f"""
SELECT o_orderkey, CAST(d AS VARCHAR) AS loose_date,
       CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(d AS VARCHAR) END AS padded_date,
       CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(d AS VARCHAR) END AS iso_date,
       strftime(d, '%Y-%m') AS month_key,
       {num("CASE WHEN o_orderkey % 3 <> 0 THEN year(d) END")} AS year_n,
       concat_ws(',', CASE WHEN o_orderkey % 5 = 0 THEN 'padded_date' END, CASE WHEN o_orderkey % 7 = 0 THEN 'iso_date' END,
                 CASE WHEN o_orderkey % 3 = 0 THEN 'year_n' END) AS bad
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"""


def codes_decode(spark, folder):
    out = with_decoded(
        table(spark, folder, "part"),
        {
            "flag": text.revision_flag(F.expr("CASE p_size % 4 WHEN 0 THEN ' Y ' WHEN 1 THEN 'N' WHEN 2 THEN '' ELSE 'y' END")),
            "type_id": text.identifier(F.col("p_type")),
            "name_id": text.identifier(F.col("p_name")),
        },
    )
    return shown(out.select("p_partkey", "flag", "type_id", "name_id", F.array_join("bad_fields", ",").alias("bad")))


CODES_SQL = """
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE '' END AS flag,
       CASE WHEN regexp_full_match(p_type, '[A-Za-z0-9_.-]{1,32}') THEN p_type ELSE '' END AS type_id,
       CASE WHEN regexp_full_match(p_name, '[A-Za-z0-9_.-]{1,32}') THEN p_name ELSE '' END AS name_id,
       concat_ws(',', CASE WHEN p_size % 4 = 3 THEN 'flag' END,
                 CASE WHEN NOT regexp_full_match(p_type, '[A-Za-z0-9_.-]{1,32}') THEN 'type_id' END,
                 CASE WHEN NOT regexp_full_match(p_name, '[A-Za-z0-9_.-]{1,32}') THEN 'name_id' END) AS bad
FROM part"""


def amounts_decode(spark, folder):
    cells = table(spark, folder, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 4 = 0 THEN '0' WHEN o_orderkey % 4 = 1 THEN concat(format_number(o_orderkey * 37 + 1, 0), '.5') "
        "ELSE format_number(o_orderkey * 37 + 1, 0) END AS cell"
    )
    out = with_decoded(cells, {"amount": numbers.currency_amount(F.col("cell"))})
    return shown(out.select("o_orderkey", "amount", (F.size("bad_fields") > 0).alias("bad")))


AMOUNTS_SQL = f"""
SELECT o_orderkey, {num("CASE WHEN o_orderkey % 4 > 1 THEN o_orderkey * 37 + 1 END")} AS amount,
       CAST(o_orderkey % 4 < 2 AS BIGINT) AS bad
FROM orders"""


def text_normalise(spark, folder):
    out = table(spark, folder, "documents").select("doc_id", text.collapse(F.col("text")).alias("t"))
    return shown(out.select("doc_id", F.md5(F.encode("t", "UTF-8")).alias("text_md5"), F.length("t").alias("n_chars")))


TEXT_SQL = r"""
SELECT doc_id, md5(t) AS text_md5, CAST(length(t) AS BIGINT) AS n_chars
FROM (SELECT doc_id, trim(regexp_replace(text, '[\s\x{1c}-\x{1f}\x{85}\x{a0}]+', ' ', 'g')) AS t FROM documents)"""


def document_lines(spark, folder):
    lines = table(spark, folder, "documents").select("doc_id", F.posexplode(text.text_lines(F.col("text"))).alias("line_no", "line"))
    return shown(lines)


LINES_SQL = r"""
SELECT doc_id, CAST(unnest(generate_series(0, len(l) - 1)) AS BIGINT) AS line_no, unnest(l) AS line
FROM (SELECT doc_id, list_filter(list_transform(
        string_split_regex(replace(replace(text, chr(2), '-'), chr(160), ' '), '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]'),
        lambda x: trim(regexp_replace(trim(x, ' │┌└┐┘─'), '[\s\x1c-\x1f]+', ' ', 'g'))), lambda x: x <> '') AS l
      FROM documents)"""


def citations(spark, folder):
    cited = table(spark, folder, "documents").select(
        "doc_id",
        F.concat(
            F.col("text"), F.lit(" See REV. RUL. "), (F.lit(1990) + F.col("doc_id") % 30).cast("string"),
            F.when(F.col("doc_id") % 2 == 0, F.lit("–")).otherwise(F.lit("-")),
            F.lpad((F.col("doc_id") % 99 + 1).cast("string"), 3, "0"), F.lit(" and Rev. Proc. 2"),
            F.lpad((F.col("doc_id") % 50).cast("string"), 3, "0"), F.lit("-7."),
        ).alias("t"),
    )
    return shown(cited.select("doc_id", text.ruling_citation(F.col("t")).alias("ruling"),
                              text.procedure_citation(F.col("t")).alias("procedure")))


CITATIONS_SQL = """
SELECT doc_id, 'Rev. Rul. ' || (1990 + doc_id % 30) || '-' || (doc_id % 99 + 1) AS ruling,
       'Rev. Proc. 2' || lpad(CAST(doc_id % 50 AS VARCHAR), 3, '0') || '-7' AS procedure
FROM documents"""


def labels_normalise(spark, folder):
    cells = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber",
        "CASE l_linenumber WHEN 1 THEN 'AFR' WHEN 2 THEN 'adjusted  AFR' WHEN 3 THEN 'none' "
        "ELSE concat(100 + CAST(l_discount * 100 AS INT), CASE WHEN l_suppkey % 2 = 0 THEN '%' ELSE '$' END, ' AFR') END AS label",
        "CASE l_returnflag WHEN 'A' THEN 'Short‑term' WHEN 'N' THEN 'Mid‐term' ELSE 'Long-term' END AS heading",
    )
    return shown(cells.select("l_orderkey", "l_linenumber", text.rate_label(F.col("label")).alias("family"),
                              text.term_label(F.col("heading")).alias("term")))


LABELS_SQL = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CASE l_linenumber WHEN 1 THEN 'afr' WHEN 2 THEN 'adjusted_afr' WHEN 3 THEN ''
            ELSE 'afr_' || (100 + CAST(floor(l_discount * 100) AS INT)) END AS family,
       CASE l_returnflag WHEN 'A' THEN 'short_term' WHEN 'N' THEN 'mid_term' ELSE 'long_term' END AS term
FROM lineitem"""


def url_allow_list(spark, folder):
    page = F.col("url")
    host = urls.url_part(page, "AUTHORITY")
    rows = table(spark, folder, "pages").select(
        "page_id", urls.url_part(page, "SCHEME").alias("scheme"), host.alias("host"),
        urls.url_part(page, "PATH").alias("path"),
        F.array_join(urls.query_values(page, "page"), ",").alias("page_values"),
        ((urls.url_part(page, "SCHEME") == "https") & host.endswith(".example.net") & urls.url_part(page, "PATH").startswith("/en/")).alias("english"),
        urls.url_allowed(page, "m.ththth.example.net", prefixes=("/en/", "/fr/")).alias("allowed"),
    )
    return shown(rows)


URL_SQL = r"""
SELECT page_id, regexp_extract(url, '^([^:/?#]+):', 1) AS scheme, regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1) AS host,
       regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1) AS path,
       array_to_string(regexp_extract_all(regexp_extract(url, '\?([^#]*)', 1), '(?:^|&)page=([^&]*)', 1), ',') AS page_values,
       CAST(url LIKE 'https://%' AND regexp_extract(url, '^[^:/?#]+://([^/?#]*)', 1) LIKE '%.example.net'
            AND regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1) LIKE '/en/%' AS BIGINT) AS english,
       CAST(url LIKE 'https://m.ththth.example.net/en/%' OR url LIKE 'https://m.ththth.example.net/fr/%' AS BIGINT) AS allowed
FROM pages"""


def canonical_records(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").cast("string").alias("date"), F.col("o_custkey").alias("rate"),
        F.expr("CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END").alias("low"),
        F.expr("CASE WHEN o_orderkey % 6 = 0 THEN o_orderpriority END").alias("high"),
    )
    return shown(rows.select("o_orderkey", records.canonical_text(["date", "rate"], ["low", "high"]).alias("record")))


CANONICAL_SQL = """
SELECT o_orderkey, '{"date":"' || CAST(o_orderdate AS DATE) || '","rate":' || o_custkey ||
       CASE WHEN o_orderkey % 3 = 0 THEN ',"low":"' || o_orderstatus || '","high":' ||
            CASE WHEN o_orderkey % 6 = 0 THEN '"' || o_orderpriority || '"' ELSE 'null' END ELSE '' END || '}' AS record
FROM orders"""


def lookup_keys(spark, folder):
    day = F.to_date("o_orderdate")
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, day).alias("date"),
        F.when(F.col("o_orderkey") % 3 == 1, F.date_format(day, "yyyy-MM")).alias("effective_month"),
        day.alias("period_start_date"),
    )
    key = records.record_key(rows)
    return shown(rows.select("o_orderkey", key.alias("record_key"), records.route_key(key, True).alias("year_key")))


KEYS_SQL = f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 1 THEN strftime(d, '%Y-%m') ELSE CAST(d AS VARCHAR) END AS record_key,
       CASE WHEN o_orderkey % 3 = 1 THEN '' ELSE {txt("year(d)")} END AS year_key
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)"""

MEASURES = ("quantity", "price", "discount", "tax")


def tenor_long(spark, folder):
    wide = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.array(
            F.col("l_quantity").cast("bigint"), F.expr("CASE WHEN l_linenumber > 2 THEN CAST(round(l_extendedprice * 100) AS BIGINT) END"),
            F.expr("CAST(round(l_discount * 10000) AS BIGINT)"), F.expr("CAST(round(l_tax * 10000) AS BIGINT)"),
        ).alias("yields"),
    )
    return shown(records.tenor_rows(wide, ["l_orderkey", "l_linenumber"], "yields", MEASURES))


TENOR_SQL = f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(i - 1 AS BIGINT) AS tenor_index,
       {num("CASE i WHEN 1 THEN l_quantity WHEN 2 THEN CASE WHEN l_linenumber > 2 THEN round(l_extendedprice * 100) END WHEN 3 THEN round(l_discount * 10000) ELSE round(l_tax * 10000) END")} AS rate,
       ['quantity', 'price', 'discount', 'tax'][i] AS tenor
FROM lineitem, (SELECT unnest([1, 2, 3, 4]) AS i)"""

TERM_OF = {"A": "short_term", "N": "mid_term", "R": "long_term"}
SHAPE = {term: ("open", "filled") for term in TERM_OF.values()}
PARTS = ("rows_n", "quantity", "lowest", "highest")


def nested_long(spark, folder):
    li = table(spark, folder, "lineitem").select(
        F.date_format(F.to_date("l_shipdate"), "yyyy-MM").alias("effective_month"),
        "l_returnflag", "l_linestatus", F.col("l_quantity").cast("bigint").alias("q"),
    )
    flag_of = {t: f for f, t in TERM_OF.items()}
    status_of = {"open": "O", "filled": "F"}
    make = {"rows_n": lambda q: F.count(q), "quantity": lambda q: F.sum(q), "lowest": lambda q: F.min(q), "highest": lambda q: F.max(q)}
    built = records.nested_struct(
        lambda t, f, c: make[c](F.when((F.col("l_returnflag") == flag_of[t]) & (F.col("l_linestatus") == status_of[f]), F.col("q"))),
        SHAPE, PARTS,
    )
    nested = li.groupBy("effective_month").agg(built.alias("yields"))
    return shown(records.nested_rows(nested, ["effective_month"], "yields", SHAPE, PARTS))


NESTED_SQL = """
WITH g AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS effective_month, l_returnflag, l_linestatus, count(*) AS rows_n,
         CAST(sum(l_quantity) AS BIGINT) AS quantity, CAST(min(l_quantity) AS BIGINT) AS lowest, CAST(max(l_quantity) AS BIGINT) AS highest
  FROM lineitem GROUP BY ALL),
m AS (SELECT DISTINCT effective_month FROM g),
k AS (SELECT * FROM m, (VALUES ('A', 'short_term'), ('N', 'mid_term'), ('R', 'long_term')) t(flag, term),
                       (VALUES ('O', 'open'), ('F', 'filled')) f(status, family),
                       (VALUES ('rows_n'), ('quantity'), ('lowest'), ('highest')) c(compounding))
SELECT k.effective_month, term, family, compounding,
       CASE compounding WHEN 'rows_n' THEN COALESCE(rows_n, 0) WHEN 'quantity' THEN COALESCE(quantity, -999999)
            WHEN 'lowest' THEN COALESCE(lowest, -999999) ELSE COALESCE(highest, -999999) END AS value
FROM k LEFT JOIN g ON g.effective_month = k.effective_month AND l_returnflag = flag AND l_linestatus = status"""


def scaled_rename(spark, folder):
    rows = table(spark, folder, "part").selectExpr(
        "p_partkey", "CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) AS annuity_factor",
        "concat('.', lpad(CAST(p_partkey * 7919 % 10000000 AS STRING), 7, '0')) AS dx", "p_size",
    )
    return shown(records.scale_factors(rows))


SCALED_SQL = """
SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) * 10000 AS annuity_factor_scaled_1e6,
       (p_partkey * 7919 % 10000000 + 5) // 10 AS dx_scaled_1e6, CAST(p_size AS BIGINT) AS p_size
FROM part"""


def classify_ids(spark, folder):
    ids = table(spark, folder, "part").selectExpr(
        "p_partkey",
        "CASE p_size % 4 WHEN 0 THEN concat('2015_vbt_smoker_distinct_tables__2015_', IF(p_partkey % 2 = 0, 'f', 'm'), IF(p_partkey % 3 = 0, 'ns', 'sm'), '_alb') "
        "WHEN 1 THEN concat('2015_vbt_unismoke_tables__2015_', IF(p_partkey % 2 = 0, 'female', 'male'), '_composite_anb') "
        "WHEN 2 THEN concat('2015_vbt_relative_risk_tables__2015_', IF(p_partkey % 2 = 0, 'female', 'male'), '_smoker_rr', p_size * 5, '_anb') "
        "ELSE concat('2015_', p_type) END AS table_id",
        "CASE p_size % 4 WHEN 0 THEN '2015 VBT Smoker-Distinct Tables' WHEN 1 THEN '2015 VBT Unismoke Tables' ELSE '2015 VBT Relative Risk Tables' END AS source",
    )
    return shown(ids.withColumn("k", classify_table(F.col("table_id"), F.col("source"))).select("p_partkey", "k.*"))


CLASSIFY_SQL = f"""
SELECT p_partkey,
       CASE p_size % 4 WHEN 0 THEN 'smoker_distinct' WHEN 1 THEN 'unismoke' WHEN 2 THEN 'relative_risk' ELSE '' END AS structure,
       CASE WHEN p_size % 4 = 3 THEN '' WHEN p_partkey % 2 = 0 THEN 'female' ELSE 'male' END AS sex,
       CASE p_size % 4 WHEN 0 THEN CASE WHEN p_partkey % 3 = 0 THEN 'non_smoker' ELSE 'smoker' END WHEN 1 THEN 'composite' WHEN 2 THEN 'smoker' ELSE '' END AS smoker,
       CASE p_size % 4 WHEN 0 THEN 'alb' WHEN 3 THEN '' ELSE 'anb' END AS age_basis,
       {num("CASE p_size % 4 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN p_size * 5 END")} AS relative_risk_percent
FROM part"""


def numeric_key_order(spark, folder):
    """Sizes per brand as a text-keyed map, shown in numeric key order."""
    sizes = table(spark, folder, "part").groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("n"))
    maps = sizes.groupBy("p_brand").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("p_size").cast("string").alias("key"), F.col("n").alias("value")))).alias("m")
    )
    entries = records.numeric_key_entries(F.col("m"))
    line = F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"].cast("string"), e["value"].cast("string"))), ",")
    return shown(maps.select("p_brand", line.alias("sizes")))


NUMERIC_SQL = """
SELECT p_brand, string_agg(p_size || '=' || n, ',' ORDER BY p_size) AS sizes
FROM (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2) GROUP BY p_brand"""


def archive_names(spark, folder):
    rows = table(spark, folder, "pages").select(
        "page_id",
        F.when(F.col("page_id") % 2 == 0, F.array(F.lit("2001-05"), F.lit("2001-04"))).otherwise(F.array(F.lit("1999-12"))).alias("periods"),
        F.when(F.col("page_id") % 3 == 0, F.array(F.lit("section-7520-rates"), F.lit("afr")))
        .when(F.col("page_id") % 3 == 1, F.array(F.lit("section-7520-rates"))).otherwise(F.array(F.lit("afr"))).alias("subjects"),
        F.concat(F.lit("Rev. Rul. "), F.col("page_id")).alias("title"),
        F.concat(F.regexp_replace("url", r"[?#].*$", ""), F.lit("%20x.pdf")).alias("doc_url"),
    )
    return shown(rows.select("page_id", text.archive_name(F.col("periods"), F.col("subjects"), F.col("title"), F.col("doc_url")).alias("name")))


ARCHIVE_SQL = r"""
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN '2001-04_to_2001-05' ELSE '1999-12' END || '_' ||
       CASE page_id % 3 WHEN 0 THEN 'afr-7520' WHEN 1 THEN '7520' ELSE 'afr' END || '_rev-rul-' || page_id || '_' ||
       trim(regexp_replace(lower(regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]+)$', 1) || ' x'), '[^a-z0-9]+', '-', 'g'), '-') || '.pdf' AS name
FROM pages"""


QUERIES = {
    "percent_decode": Query(percent_decode, PERCENT_SQL, ("PRJ-1", "PRJ-3", "PRJ-4", "PRJ-6", "FLT-7")),
    "signed_percent_decode": Query(signed_decode, SIGNED_SQL, ("PRJ-2", "FLT-7")),
    "count_decode": Query(count_decode, COUNT_SQL, ("PRJ-7", "PRJ-15")),
    "factor_half_up": Query(factor_half_up, FACTOR_SQL, ("PRJ-5", "PRJ-15")),
    "cell_rates": Query(cell_rates, CELL_RATE_SQL, ("PRJ-14",)),
    "dates_decode": Query(dates_decode, DATES_SQL, ("PRJ-10", "PRJ-11", "PRJ-12", "PRJ-13", "PRJ-17")),
    "codes_decode": Query(codes_decode, CODES_SQL, ("PRJ-8", "PRJ-9")),
    "amounts_decode": Query(amounts_decode, AMOUNTS_SQL, ("PRJ-16",)),
    "text_normalise": Query(text_normalise, TEXT_SQL, ("PRJ-18",)),
    "document_lines": Query(document_lines, LINES_SQL, ("PRJ-19",)),
    "citations": Query(citations, CITATIONS_SQL, ("PRJ-20",)),
    "labels_normalise": Query(labels_normalise, LABELS_SQL, ("PRJ-21", "PRJ-22")),
    "url_allow_list": Query(url_allow_list, URL_SQL, ("PRJ-23",)),
    "canonical_records": Query(canonical_records, CANONICAL_SQL, ("PRJ-24",)),
    "lookup_keys": Query(lookup_keys, KEYS_SQL, ("PRJ-25",)),
    "tenor_long": Query(tenor_long, TENOR_SQL, ("PRJ-26",)),
    "nested_long": Query(nested_long, NESTED_SQL, ("PRJ-27",)),
    "scaled_rename": Query(scaled_rename, SCALED_SQL, ("PRJ-28",)),
    "classify_ids": Query(classify_ids, CLASSIFY_SQL, ("PRJ-29",)),
    "numeric_key_order": Query(numeric_key_order, NUMERIC_SQL, ("PRJ-30",)),
    "archive_names": Query(archive_names, ARCHIVE_SQL, ("PRJ-31",)),
}
