"""Queries over the readers: pages, rulings, prose, grids, feeds, shards and registers.

Feeds, grids and texts are derived from the tables. Readers of files first have Spark
write such derived rows below the shared folder and then read them back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.records import COMPOUNDING, FAMILIES, TENORS
from ..operators.generate import expand_years
from ..registry import dataset
from ..session import scratch_path
from ..sources import documents, feeds, grids, migrate, pages, prose, rulings, seeds, shards
from .common import ABSENT, ORDER_DAY, Query, shown, table


def page_tokens(spark, folder):
    rows = table(spark, folder, "pages").select("page_id", F.posexplode(pages.visible_tokens(F.col("html"))).alias("position", "token"))
    return shown(rows)


ENTITIES = (
    "replace(replace(replace(replace(replace(replace(replace({}, '&copy;', chr(169)), '&middot;', chr(183)), '&nbsp;', ' '), "
    "'&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"
)
SHOWN_HTML = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '<>', 'g'),
  '(?is)<script\b[^>]*>.*?</script\s*>', '<>', 'g'), '(?is)<style\b[^>]*>.*?</style\s*>', '<>', 'g'), '(?is)<noscript\b[^>]*>.*?</noscript\s*>', '<>', 'g')"""
TOKENS_SQL = f"""
WITH t AS (SELECT page_id, list_filter(list_transform(string_split_regex({SHOWN_HTML}, '<[^>]*>'),
    lambda x: trim(regexp_replace({ENTITIES.format('x')}, '\\s+', ' ', 'g'))), lambda x: x <> '') AS l FROM pages)
SELECT page_id, CAST(unnest(generate_series(0, len(l) - 1)) AS BIGINT) AS position, unnest(l) AS token FROM t"""


def page_links(spark, folder):
    return shown(pages.page_links(table(spark, folder, "pages"), "url", "html"))


LINKS_SQL = rf"""
WITH h AS (SELECT url, regexp_replace(html, '(?s)<!--.*?-->', '', 'g') AS html FROM pages),
a AS (SELECT url, regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a\s*>', 1) AS hrefs,
             regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a\s*>', 2) AS texts,
             regexp_extract(url, '^([^:]+)://', 1) AS scheme, regexp_extract(url, '^([^:]+://[^/?#]*)', 1) AS site FROM h),
u AS (SELECT url, scheme, site, CAST(unnest(generate_series(0, len(hrefs) - 1)) AS BIGINT) AS position, unnest(hrefs) AS href, unnest(texts) AS text FROM a)
SELECT url AS page_url, position, {ENTITIES.format('href')} AS href,
       trim(regexp_replace({ENTITIES.format("regexp_replace(text, '<[^>]*>', ' ', 'g')")}, '\s+', ' ', 'g')) AS text,
       CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {ENTITIES.format('href')}
            WHEN starts_with(href, '//') THEN scheme || ':' || {ENTITIES.format('href')} ELSE site || {ENTITIES.format('href')} END AS target
FROM u"""


def link_discovery(spark, folder):
    """Procedure documents named in pages, one of three pages naming some; first page wins."""
    named = table(spark, folder, "pages").withColumn(
        "html",
        F.when(F.col("page_id") % 3 == 0, F.concat("html", F.lit('<a href="/pub/irs-drop/rp-'), F.lpad((F.col("page_id") % 40).cast("string"), 2, "0"),
                                                    F.lit('-7.pdf">x</a> https://www.irs.gov/pub/irs-drop/rp-25-32.pdf'))).otherwise(F.col("html")),
    ).withColumn("page", F.lpad(F.col("page_id").cast("string"), 12, "0"))
    return shown(pages.procedure_links(named, "page", "html"))


DISCOVERY_SQL = """
WITH f AS (SELECT 'https://www.irs.gov/pub/irs-drop/rp-' || lpad(CAST(page_id % 40 AS VARCHAR), 2, '0') || '-7.pdf' AS url, lpad(CAST(page_id AS VARCHAR), 12, '0') AS page_url, 0 AS position FROM pages WHERE page_id % 3 = 0
           UNION ALL SELECT 'https://www.irs.gov/pub/irs-drop/rp-25-32.pdf', lpad(CAST(page_id AS VARCHAR), 12, '0'), 1 FROM pages WHERE page_id % 3 = 0)
SELECT url, page_url, CAST(position AS BIGINT) AS position FROM f QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_url, position) = 1"""


def ruling_links(spark, folder):
    """Ruling documents linked by anchor text, with the known omissions added."""
    index = table(spark, folder, "pages").select(
        F.concat(F.lit("https://www.irs.gov/applicable-federal-rates?page="), F.lpad("page_id", 9, "0")).alias("url"),
        F.concat("html", F.lit('<a class=x HREF="/pub/irs-drop/rr-'), (F.col("page_id") % 60).cast("string"),
                 F.lit('.pdf"><b>Applicable</b> Federal\nRates</a><a href="/other.pdf">Applicable Federal Rates</a>')).alias("html"),
    )
    return shown(pages.ruling_links(index, "url", "html", backfill=True).select("url", "list", "allowed"))


RULING_LINKS_SQL = """
SELECT DISTINCT 'https://www.irs.gov/pub/irs-drop/rr-' || (page_id % 60) || '.pdf' AS url, 0 AS list, 1 AS allowed FROM pages
UNION ALL SELECT 'https://www.irs.gov/other.pdf', 0, 0
UNION ALL SELECT unnest(['https://www.irs.gov/pub/irs-drop/rr-26-09.pdf', 'https://www.irs.gov/pub/irs-drop/rr-01-22.pdf',
  'https://www.irs.gov/pub/irs-drop/rr-13-09.pdf', 'https://www.irs.gov/pub/irs-drop/rr-13-11.pdf']), 1, 1"""

RATE_PAGE = (
    "concat(html, '<table><tr><th>Valuation month<th>120% of applicable federal midterm rate<th>Section 7520 interest rate<th>Revenue ruling</tr>"
    "<tr><td>May ', 1900 + page_id % 200, '</td><td>', CAST(CAST(page_id % 900 / 100 AS DECIMAL(9,2)) AS STRING), '%</td><td>', "
    "CAST(CAST(page_id % 70 / 10 AS DECIMAL(9,1)) AS STRING), '`</td><td>', IF(page_id % 5 = 0, 'Rev. Rul 2001-', 'Rev. Rul. 2001-'), page_id % 90 + 1, "
    "'</td></tr><tr><td>June ', 1900 + page_id % 200, '<td>1.005<td>2<td>none</table><p>For prior years see<p>July 2001<p>1<p>1<p>x')"
)


def rate_table(spark, folder):
    """The monthly rate table of a page, good and bad rows alike."""
    with_table = table(spark, folder, "pages").select("page_id", F.expr(RATE_PAGE).alias("html"), F.concat(F.lit("p"), "page_id").alias("url"))
    rows = pages.decode_rate_table(pages.rate_table_rows(with_table, "url", "html"))
    return shown(rows.withColumn("bad_fields", F.array_join("bad_fields", ",")))


RATE_TABLE_SQL = f"""
SELECT (1900 + page_id % 200) || '-05' AS effective_month, page_id % 900 AS midterm_afr_120_basis_points, page_id % 70 * 10 AS section_7520_rate_basis_points,
       'Rev. Rul. 2001-' || (page_id % 90 + 1) AS revenue_ruling, 'p' || page_id AS source_url, '' AS bad_fields FROM pages
UNION ALL SELECT (1900 + page_id % 200) || '-06', {ABSENT}, 200, '', 'p' || page_id, 'midterm_afr_120_basis_points,revenue_ruling' FROM pages"""


def _ruling_text(key: str) -> str:
    """SQL for a ruling text whose cells depend on ``key``; one family row per label."""
    def row(label: str, shift: int) -> str:
        cells = ", ".join(f"' ', CAST(CAST(({key} % 300 + {shift + i}) / 100 AS DECIMAL(9,2)) AS STRING), '%'" for i in range(4))
        return f"concat('{label}', {cells})"

    labels = {"afr": "AFR", "afr_110": "110% AFR", "afr_120": "120$ AFR", "afr_130": "130% AFR", "afr_150": "150% AFR", "afr_175": "175% AFR"}
    headings = {"short_term": "Short-term", "mid_term": "Mid-term", "long_term": "Long-term"}
    parts = ["'Rev. Rul. 2001-022\\n'", "'TABLE 1\\n'", "'Applicable Federal Rates (AFR) for May 2001\\n'"]
    shift = 0
    for term, families in FAMILIES.items():
        parts.append(f"'  │ {headings[term]} │\\n'")
        for family in families:
            parts += [row(labels[family], shift), "'\\n'"]
            shift += 4
    parts += ["'TABLE 2\\n'", "'Adjusted AFR for May 2001\\n'"]
    for i, term in enumerate(FAMILIES):
        if i == 0:
            parts += [row(headings[term], shift), "'\\n'"]
        else:
            parts += [f"'{headings[term]}\\n'", row("adjusted AFR", shift), "'\\n'"]
        shift += 4
    parts.append("'TABLE 3\\nend'")
    return "concat(" + ", ".join(parts) + ")"


def ruling_tables(spark, folder):
    """Nested rate tables from texts appended to documents; some texts lack a row."""
    text = _ruling_text("doc_id")
    docs = table(spark, folder, "documents").selectExpr(
        "doc_id", f"concat(text, '\\n', CASE WHEN doc_id % 10 = 0 THEN replace({text}, '175% AFR', '999% AFR') ELSE {text} END) AS text",
        "concat('d', doc_id) AS url",
    )
    parsed = rulings.parse_rulings(docs, "url", "text")
    cells = [F.col(f"applicable_federal_rates.{t}.{f}.{c}") for t, fs in FAMILIES.items() for f in fs for c in COMPOUNDING]
    cells += [F.col(f"adjusted_applicable_federal_rates.{t}.{c}") for t in FAMILIES for c in COMPOUNDING]
    return shown(parsed.select("source_url", "revenue_ruling", "effective_month", "problem",
                               F.array_join(F.array(*[F.coalesce(c.cast("string"), F.lit("-")) for c in cells]), ",").alias("cells")))


RULING_TABLES_SQL = """
SELECT 'd' || doc_id AS source_url, 'Rev. Rul. 2001-22' AS revenue_ruling, '2001-05' AS effective_month,
       CASE WHEN doc_id % 10 = 0 THEN 'missing_field' ELSE '' END AS problem,
       array_to_string(list_transform(range(0, 68), lambda i: CASE WHEN doc_id % 10 = 0 AND i BETWEEN 36 AND 39 THEN '-' ELSE CAST(doc_id % 300 + i AS VARCHAR) END), ',') AS cells
FROM documents"""


def prose_amounts(spark, folder):
    """Amounts stated in sentences that are appended to documents."""
    sentence = (
        "concat(text, ' Rev. Proc. 2025-', doc_id % 90 + 1, '. ', CASE doc_id % 4 "
        "WHEN 0 THEN concat('In the estate of any decedent dying\\nin calendar year ', 1990 + doc_id % 60, ', the basic exclusion amount is $', format_number(1000000 + doc_id * 1000, 0), ' for') "
        "WHEN 1 THEN concat('Estates of decedents who die during ', 1990 + doc_id % 60, ' have a basic exclusion amount of $', format_number(1000000 + doc_id, 0)) "
        "WHEN 2 THEN concat('raises the basic exclusion amount to $', 1000000 + doc_id, ' for calendar year ', 1990 + doc_id % 60) ELSE 'nothing' END) AS text"
    )
    docs = table(spark, folder, "documents").selectExpr("concat('d', doc_id) AS url", sentence)
    return shown(prose.extract_amounts(docs, "url", "text", prose.RULES["estate-gift-tax-exemption"]))


PROSE_SQL = f"""
SELECT CASE WHEN doc_id % 4 = 3 THEN '' ELSE (1990 + doc_id % 60) || '-01-01' END AS period_start_date,
       CASE WHEN doc_id % 4 = 3 THEN '' ELSE (1990 + doc_id % 60) || '-12-31' END AS period_end_date,
       CASE doc_id % 4 WHEN 0 THEN 1000000 + doc_id * 1000 WHEN 3 THEN {ABSENT} ELSE 1000000 + doc_id END AS basic_exclusion_amount_usd,
       'Rev. Proc. 2025-' || (doc_id % 90 + 1) AS revenue_procedure, 'd' || doc_id AS source_url,
       CASE WHEN doc_id % 4 = 3 THEN 'invalid_amount' ELSE '' END AS problem
FROM documents"""


def prose_skipping(spark, folder):
    """The rule that skips documents without its sentence, and the two others."""
    docs = table(spark, folder, "documents").selectExpr(
        "concat('d', doc_id) AS url",
        "concat(text, ' Rev. Proc. 2025-9 ', CASE doc_id % 4 "
        "WHEN 0 THEN concat('For calendar year ', 2000 + doc_id % 30, ', the generation-skipping transfer exemption amount under § 2631(c) is equal to $', format_number(doc_id + 1, 0)) "
        "WHEN 1 THEN concat('For calendar year ', 2000 + doc_id % 30, ', the first $', format_number(doc_id + 1, 0), ' of gifts to any person') "
        "WHEN 2 THEN concat('For calendar year ', 2000 + doc_id % 30, ', the first $', format_number(doc_id + 1, 0), ' (instead of the amount provided in paragraph (1) of this section 2503) of gifts to a spouse who is not a citizen of the United States') "
        "ELSE concat('The annual exclusion for gifts is $', format_number(doc_id + 1, 0), ' for calendar year ', 2000 + doc_id % 30) END) AS text",
    )
    out = None
    for name in ("gst-exemption", "annual-gift-exclusion", "noncitizen-spouse-gift-exclusion"):
        rule = prose.RULES[name]
        part = prose.extract_amounts(docs, "url", "text", rule).filter(F.col("problem").isNull()).select(
            F.lit(name).alias("dataset_id"), "period_start_date", F.col(rule.amount_column).alias("amount"), "source_url"
        )
        out = part if out is None else out.unionByName(part)
    return shown(out)


SKIPPING_SQL = """
SELECT ['gst-exemption', 'annual-gift-exclusion', 'noncitizen-spouse-gift-exclusion', 'annual-gift-exclusion'][doc_id % 4 + 1] AS dataset_id,
       (2000 + doc_id % 30) || '-01-01' AS period_start_date, doc_id + 1 AS amount, 'd' || doc_id AS source_url FROM documents"""


# Grids: an order is a sheet, its parts make rows and columns.

def _parts(spark, folder):
    return table(spark, folder, "part").selectExpr("p_partkey AS k", "p_brand AS workbook", "CAST(p_size AS INT) AS size")


def grid_mortality(spark, folder):
    """Each part is a sheet of one workbook with three side-by-side blocks."""
    cells = _parts(spark, folder).selectExpr(
        "workbook", "CAST(k AS INT) AS sheet", "5 AS row",
        "inline(array(named_struct('col', 1, 'value', CAST(k * 3 AS STRING)), named_struct('col', 2, 'value', concat(k + 1, '.5')), "
        "named_struct('col', 5, 'value', CAST(k * 3 + 1 AS STRING)), named_struct('col', 6, 'value', IF(k % 4 = 0, 'x', concat('.', k + 10))), "
        "named_struct('col', 9, 'value', concat(k * 3 + 2, '.0')), named_struct('col', 10, 'value', CAST(k AS STRING)), named_struct('col', 11, 'value', '7')))",
    )
    return shown(grids.mortality_rows(cells))


MORTALITY_SQL = """
WITH p AS (SELECT p_partkey AS k, p_brand AS workbook FROM part)
SELECT workbook, k * 3 AS age, (k + 1) * 1000000 + 500000 AS survivors_per_100000_scaled_1e6 FROM p
UNION ALL SELECT workbook, k * 3 + 1, CAST(rpad(CAST(k + 10 AS VARCHAR), 12, '0') AS BIGINT) // 1000000 + CASE WHEN CAST(rpad(CAST(k + 10 AS VARCHAR), 12, '0') AS BIGINT) % 1000000 >= 500000 THEN 1 ELSE 0 END FROM p WHERE k % 4 <> 0
UNION ALL SELECT workbook, k * 3 + 2, k * 1000000 FROM p"""


def grid_single_life(spark, folder):
    """Percentages marked above the rows of a sheet; two blocks per row."""
    cells = _parts(spark, folder).selectExpr(
        "workbook", "CAST(k AS INT) AS sheet",
        "inline(array("
        "named_struct('row', 0, 'col', 3, 'value', '1'), named_struct('row', 1, 'col', 2, 'value', concat('Interest at ', size, '.5 Percent')), "
        "named_struct('row', 2, 'col', 0, 'value', CAST(size AS STRING)), named_struct('row', 2, 'col', 1, 'value', '1.25'), named_struct('row', 2, 'col', 2, 'value', '.5'), named_struct('row', 2, 'col', 3, 'value', concat('0.', k + 1)), "
        "named_struct('row', 2, 'col', 4, 'value', CAST(size + 60 AS STRING)), named_struct('row', 2, 'col', 5, 'value', '2'), named_struct('row', 2, 'col', 6, 'value', '3'), named_struct('row', 2, 'col', 7, 'value', '4'), "
        "named_struct('row', 3, 'col', 1, 'value', 'Interest at 7 Percent'), named_struct('row', 3, 'col', 0, 'value', '9'), named_struct('row', 3, 'col', 2, 'value', '1'), "
        "named_struct('row', 4, 'col', 0, 'value', '10'), named_struct('row', 4, 'col', 1, 'value', '1'), named_struct('row', 4, 'col', 2, 'value', '1'), named_struct('row', 4, 'col', 3, 'value', CAST(k AS STRING))))",
    )
    return shown(grids.single_life_rows(cells))


SINGLE_SQL = """
WITH p AS (SELECT p_partkey AS k, p_size AS size, CAST(rpad(CAST(p_partkey + 1 AS VARCHAR), 12, '0') AS BIGINT) AS x FROM part)
SELECT size * 100 + 50 AS interest_rate_basis_points, CAST(size AS BIGINT) AS age, 1250000 AS annuity_factor_scaled_1e6, 500000 AS life_estate_factor_scaled_1e6,
       x // 1000000 + CASE WHEN x % 1000000 >= 500000 THEN 1 ELSE 0 END AS remainder_factor_scaled_1e6 FROM p
UNION ALL SELECT size * 100 + 50, size + 60, 2000000, 3000000, 4000000 FROM p UNION ALL SELECT 700, 10, 1000000, 1000000, k * 1000000 FROM p"""


def grid_commutation(spark, folder):
    """Commutation columns at every second place; the rate comes from a title or a phrase."""
    def block(row: int, at: int, age: str) -> str:
        return ", ".join(f"named_struct('row', {row}, 'col', {at + 2 * i}, 'value', {v})" for i, v in enumerate((age, "'1.5'", "CAST(k AS STRING)", "'0.0000005'")))

    cells = _parts(spark, folder).selectExpr(
        "workbook", "CAST(k AS INT) AS sheet",
        f"inline(array(named_struct('row', 0, 'col', 1, 'value', IF(k % 2 = 0, concat('Table Z(', size, '.2)'), concat('Adjusted Payout Rate ', size, '.4 Percent'))), "
        f"{block(1, 0, 'CAST(size AS STRING)')}, {block(1, 8, 'CAST(size + 50 AS STRING)')}))",
    )
    return shown(grids.commutation_rows(cells, "Adjusted Payout Rate", "adjusted_payout_rate_basis_points", "u"))


COMMUTATION_SQL = """
SELECT size * 100 + CASE WHEN k % 2 = 0 THEN 20 ELSE 40 END AS adjusted_payout_rate_basis_points, CAST(size + d AS BIGINT) AS age,
       1500000 AS udx_scaled_1e6, k * 1000000 AS unx_scaled_1e6, 1 AS umx_scaled_1e6
FROM (SELECT p_partkey AS k, p_size AS size FROM part), (VALUES (0), (50)) v(d)"""


def grid_term_certain(spark, folder):
    """Two sections per sheet; percentages two rows below the title, data from the fourth."""
    def section(top: int, rate: str) -> str:
        cells = [(top, 0, "'Table B'"), (top + 2, 4, rate), (top + 2, 12, f"IF(k % 3 = 0, 'none', {rate})")]
        for at in (0, 8):
            cells += [(top + 4, at, "CAST(size AS STRING)"), (top + 4, at + 2, f"CAST(k + {at} AS STRING)"), (top + 4, at + 4, "'0.25'"), (top + 4, at + 6, "'.75'")]
        return ", ".join(f"named_struct('row', {r}, 'col', {c}, 'value', {v})" for r, c, v in cells)

    cells = _parts(spark, folder).selectExpr(
        "workbook", "CAST(k AS INT) AS sheet", f"inline(array({section(1, chr(39) + '4.2%' + chr(39))}, {section(9, 'concat(size, chr(37))')}))"
    )
    return shown(grids.term_certain_rows(cells))


TERM_CERTAIN_SQL = """
SELECT CASE s WHEN 1 THEN 420 ELSE size * 100 END AS interest_rate_basis_points, CAST(size AS BIGINT) AS term_years, (k + d) * 1000000 AS annuity_factor_scaled_1e6,
       250000 AS income_interest_factor_scaled_1e6, 750000 AS remainder_factor_scaled_1e6
FROM (SELECT p_partkey AS k, p_size AS size FROM part), (VALUES (0), (8)) v(d), (VALUES (1), (2)) w(s) WHERE d = 0 OR k % 3 <> 0"""


def grid_one_life(spark, folder):
    cells = _parts(spark, folder).selectExpr(
        "workbook", "CAST(k AS INT) AS sheet",
        "inline(array(named_struct('row', 0, 'col', 0, 'value', 'Age'), named_struct('row', 0, 'col', 1, 'value', concat(size, '.2%')), named_struct('row', 0, 'col', 2, 'value', 'note'), named_struct('row', 0, 'col', 3, 'value', '9%'), "
        "named_struct('row', 1, 'col', 0, 'value', CAST(size AS STRING)), named_struct('row', 1, 'col', 1, 'value', concat('.', k + 1)), named_struct('row', 1, 'col', 2, 'value', '5'), named_struct('row', 1, 'col', 3, 'value', IF(k % 2 = 0, '', '0.125')), "
        "named_struct('row', 2, 'col', 0, 'value', 'Age'), named_struct('row', 2, 'col', 3, 'value', '0.05'), named_struct('row', 3, 'col', 0, 'value', '7'), named_struct('row', 3, 'col', 1, 'value', '1'), named_struct('row', 3, 'col', 3, 'value', '0.5')))",
    )
    return shown(grids.one_life_unitrust_rows(cells))


ONE_LIFE_SQL = """
WITH p AS (SELECT p_partkey AS k, p_size AS size, CAST(rpad(CAST(p_partkey + 1 AS VARCHAR), 12, '0') AS BIGINT) AS x FROM part)
SELECT size * 100 + 20 AS adjusted_payout_rate_basis_points, CAST(size AS BIGINT) AS age, x // 1000000 + CASE WHEN x % 1000000 >= 500000 THEN 1 ELSE 0 END AS unitrust_remainder_factor_scaled_1e6 FROM p
UNION ALL SELECT 900, size, 125000 FROM p WHERE k % 2 = 1 UNION ALL SELECT 500, 7, 500000 FROM p"""


def grid_two_life(spark, folder):
    cells = _parts(spark, folder).selectExpr(
        "workbook", "CAST(k AS INT) AS sheet",
        "inline(array(named_struct('row', 0, 'col', 0, 'value', ' O '), named_struct('row', 0, 'col', 1, 'value', 'Y'), named_struct('row', 0, 'col', 2, 'value', '4%'), named_struct('row', 0, 'col', 3, 'value', concat(size, '%')), "
        "named_struct('row', 1, 'col', 0, 'value', '90'), named_struct('row', 1, 'col', 1, 'value', CAST(size AS STRING)), named_struct('row', 1, 'col', 2, 'value', '0.5'), named_struct('row', 1, 'col', 3, 'value', CAST(k AS STRING)), "
        "named_struct('row', 2, 'col', 0, 'value', '91'), named_struct('row', 2, 'col', 1, 'value', 'x'), named_struct('row', 2, 'col', 2, 'value', '0.5')))",
    )
    return shown(grids.two_life_rows(cells, "interest_rate_basis_points", "remainder_factor"))


TWO_LIFE_SQL = """
WITH p AS (SELECT p_partkey AS k, p_size AS size FROM part)
SELECT 400 AS interest_rate_basis_points, 90 AS older_age, CAST(size AS BIGINT) AS younger_age, 500000 AS remainder_factor_scaled_1e6 FROM p
UNION ALL SELECT size * 100, 90, size, k * 1000000 FROM p"""


# Feeds: one row per order, dated by its key so that every date is its own. Published dates have years of four digits, so the
# keys beyond the days from 1700-01-01 to 9999-12-31 begin a further feed, and reading adds its days again.

FEED_DAYS = 3_031_512
WITHIN = ("feed",)
FEED_OF_KEY = f"(o_orderkey - pmod(o_orderkey, {FEED_DAYS})) DIV {FEED_DAYS}"
DAY_OF_KEY = f"date_add(DATE'1700-01-01', CAST(pmod(o_orderkey, {FEED_DAYS}) AS INT))"
DAY_OF_KEY_SQL = "DATE '1700-01-01' + CAST(o_orderkey AS INT)"


def _write_feeds(rows, path: str) -> None:
    rows.write.option("header", True).partitionBy(*WITHIN).csv(path)


def _day_of_feed():
    """The date as text, a year beyond 9999 without a sign."""
    day = F.date_add("date", (F.col("feed") * FEED_DAYS).cast("int"))
    return F.ltrim(day.cast("string"), F.lit("+")).alias("date")


def curve_feed(spark, folder):
    """Curve feed written as CSV with a subset of tenors, read and checked."""
    path = scratch_path(spark, "curve")
    cell = "CASE WHEN o_orderkey % {} = 0 THEN 'N/A' ELSE CAST(CAST(o_custkey % 900 / 100 AS DECIMAL(6,2)) AS STRING) END AS `{}`"
    headers = ("1 Mo", "3 Mo", "10 Yr", "30 Yr")
    _write_feeds(table(spark, folder, "orders").selectExpr(
        f"date_format({DAY_OF_KEY}, 'M/d/yyyy') AS Date", *[cell.format(i + 2, h) for i, h in enumerate(headers)], f"{FEED_OF_KEY} AS feed"
    ), path)
    rows = feeds.read_curve(spark, path, WITHIN)
    keys = [key for key, _ in TENORS]
    return shown(rows.select(_day_of_feed(), *[F.element_at("par_yields_basis_points", keys.index(k) + 1).alias(f"y_{k}") for k in ("1_month", "2_month", "3_month", "10_year", "30_year")]))


CURVE_SQL = f"""
SELECT CAST({DAY_OF_KEY_SQL} AS VARCHAR) AS date, CASE WHEN o_orderkey % 2 = 0 THEN {ABSENT} ELSE o_custkey % 900 END AS y_1_month, {ABSENT} AS y_2_month,
       CASE WHEN o_orderkey % 3 = 0 THEN {ABSENT} ELSE o_custkey % 900 END AS y_3_month, CASE WHEN o_orderkey % 4 = 0 THEN {ABSENT} ELSE o_custkey % 900 END AS y_10_year,
       CASE WHEN o_orderkey % 5 = 0 THEN {ABSENT} ELSE o_custkey % 900 END AS y_30_year FROM orders"""


def _overnight_csv(spark, folder, path: str, kind: str, cells: dict[str, str], also=None):
    def columns(kind: str, cells: dict[str, str]) -> list[str]:
        out = []
        for header in feeds.OVERNIGHT_HEADERS:
            source = {"Effective Date": f"date_format({DAY_OF_KEY}, 'MM/dd/yyyy')", "Rate Type": f"'{kind}'"} | cells
            out.append(f"{source.get(header, 'CAST(NULL AS STRING)')} AS `{header}`")
        return [*out, f"{FEED_OF_KEY} AS feed"]

    orders = table(spark, folder, "orders")
    rows = orders.selectExpr(*columns(kind, cells))
    for other_kind, other_cells in (also or {}).items():
        rows = rows.unionByName(orders.selectExpr(*columns(other_kind, other_cells)))
    _write_feeds(rows, path)


PERCENT_OF_CUSTOMER = "CAST(CAST(o_custkey % 900 / 100 AS DECIMAL(6,2)) AS STRING)"


def overnight_feed(spark, folder):
    path = scratch_path(spark, "overnight")
    _overnight_csv(spark, folder, path, "EFFR", {"Rate (%)": f"CASE WHEN o_orderkey % 9 <> 0 THEN {PERCENT_OF_CUSTOMER} END"})
    return shown(feeds.read_overnight(spark, path, within=WITHIN).select(_day_of_feed(), "rate_basis_points"))


OVERNIGHT_SQL = f"""
SELECT CAST({DAY_OF_KEY_SQL} AS VARCHAR) AS date, CASE WHEN o_orderkey % 9 = 0 THEN {ABSENT} ELSE o_custkey % 900 END AS rate_basis_points FROM orders"""


def mixed_feed(spark, folder):
    """Observations and averages of a date arrive as separate rows and are united."""
    path = scratch_path(spark, "mixed")
    _overnight_csv(
        spark, folder, path, "SOFR",
        {"Rate (%)": PERCENT_OF_CUSTOMER, "1st Percentile (%)": "CAST(CAST(-(o_custkey % 50) / 100 AS DECIMAL(6,2)) AS STRING)", "Volume ($Billions)": "CAST(o_orderkey % 5000 AS STRING)"},
        {
            "SOFRAI": {"30-Day Average SOFR": "CAST(CAST(o_custkey % 90000 / 100000 AS DECIMAL(9,5)) AS STRING)", "SOFR Index": "concat(1 + o_orderkey DIV 100000000, '.', lpad(CAST(o_orderkey % 100000000 AS STRING), 8, '0'))"},
            "TGCR": {"Rate (%)": "'not read'"},
        },
    )
    wide = feeds.read_mixed(spark, path, WITHIN)
    return shown(wide.select(_day_of_feed(), "rate_basis_points", "percentile_1_basis_points", "percentile_25_basis_points", "volume_billions",
                             "average_30_day_basis_points_scaled_1000", "average_90_day_basis_points_scaled_1000", "sofr_index_scaled_100000000"))


MIXED_SQL = f"""
SELECT CAST({DAY_OF_KEY_SQL} AS VARCHAR) AS date, o_custkey % 900 AS rate_basis_points, -(o_custkey % 50) AS percentile_1_basis_points, {ABSENT} AS percentile_25_basis_points,
       o_orderkey % 5000 AS volume_billions, o_custkey % 90000 AS average_30_day_basis_points_scaled_1000, {ABSENT} AS average_90_day_basis_points_scaled_1000,
       100000000 + o_orderkey AS sofr_index_scaled_100000000 FROM orders"""


def migrate_period(spark, folder):
    """Statutory records in three shapes, made canonical; wrong shapes are named."""
    raw = table(spark, folder, "orders").selectExpr(
        "o_orderkey",
        f"CASE o_orderkey % 5 WHEN 0 THEN to_json(named_struct('year', year(o_orderdate), 'exemption_amount_usd', o_custkey + 1)) "
        f"WHEN 1 THEN to_json(named_struct('period_start_date', {ORDER_DAY}, 'period_end_date', date_add({ORDER_DAY}, 9), 'exemption_amount_usd', o_custkey + 1)) "
        f"WHEN 2 THEN to_json(named_struct('period_start_date', {ORDER_DAY}, 'period_end_date', date_sub({ORDER_DAY}, 1), 'exemption_amount_usd', o_custkey + 1)) "
        f"WHEN 3 THEN to_json(named_struct('year', year(o_orderdate), 'exemption_amount_usd', true, 'seq', o_orderkey)) "
        f"ELSE to_json(named_struct('year', year(o_orderdate), 'exemption_amount_usd', o_custkey + 1, 'applies_to', 'generation_skipping_transfers_during_calendar_year', 'revenue_procedure', 'Rev. Proc. 2001-13')) END AS json",
    )
    records, problems = migrate.migrate_statutory(raw, "gst-exemption")
    found = records.groupBy("period_start_date", "period_end_date", "exemption_amount_usd").agg(F.count(F.lit(1)).alias("n")).withColumn("rule", F.lit(""))
    broken = problems.groupBy("rule").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(None).cast("date").alias("period_start_date"), F.lit(None).cast("date").alias("period_end_date"), F.lit(None).cast("bigint").alias("exemption_amount_usd"), "n", "rule"
    )
    return shown(found.unionByName(broken))


MIGRATE_SQL = f"""
WITH r AS (SELECT o_orderkey % 5 AS s, {ORDER_DAY} AS d, year(o_orderdate) AS y, o_custkey + 1 AS a FROM orders),
p AS (SELECT CASE WHEN s IN (1, 2) THEN CAST(d AS VARCHAR) ELSE y || '-01-01' END AS b, CASE s WHEN 1 THEN CAST(d + 9 AS VARCHAR) WHEN 2 THEN CAST(d - 1 AS VARCHAR) ELSE y || '-12-31' END AS e,
             CASE WHEN s = 3 THEN {ABSENT} ELSE a END AS a FROM r)
SELECT b AS period_start_date, e AS period_end_date, a AS exemption_amount_usd, count(*) AS n, '' AS rule FROM p GROUP BY 1, 2, 3
UNION ALL SELECT '', '', {ABSENT}, count(*), rule FROM r, (VALUES (2, 'period order'), (3, 'keys'), (3, 'amount')) v(m, rule) WHERE s = m GROUP BY rule"""


def register_scan(spark, folder):
    """Registers of 500 entries written as files: clean ones read back, and the rules that entries of the others break."""
    p = F.col("page_id")
    entries = table(spark, folder, "pages").select(
        F.when(p % 17 == 0, F.lit("98")).otherwise(F.lit("1998")).alias("year"),
        F.array(F.concat(F.lit("1998-"), F.lpad((p % 12 + 1).cast("string"), 2, "0"))).alias("periods"),
        F.array(F.when(p % 11 == 0, F.lit("other")).otherwise(F.lit("afr"))).alias("subjects"),
        F.concat(F.lit("by-year/"), p).alias("path"),
        F.concat(F.when(p % 13 == 0, F.lit("http")).otherwise(F.lit("https")), F.lit("://www.irs.gov/pub/irs-drop/rr-"), p, F.lit(".pdf")).alias("source_url"),
        F.concat(F.lit("Rev. Rul. 98-"), p).alias("title"), F.lit("2026-01-05").alias("retrieved_date"),
        F.octet_length("html").cast("bigint").alias("bytes"), F.sha2("html", 256).alias("sha256"),
    )
    number = F.regexp_extract("path", "[0-9]+$", 0).cast("bigint")
    broken = (number % 17 == 0) | (number % 11 == 0) | (number % 13 == 0)
    registers = entries.groupBy(F.when(broken, F.lit("broken")).otherwise(F.lit("clean")).alias("kind"), F.floor(number / 500).alias("part")).agg(
        F.collect_list(F.struct(*entries.columns)).alias("entries"))
    body = F.to_json(F.struct(F.lit(documents.REGISTER_ID).alias("archive_id"), "entries"))
    root = scratch_path(spark, "registers")
    registers.select("kind", "part", body.alias("value")).write.partitionBy("kind", "part").text(root)
    _, found = documents.register_rows(spark, f"{root}/kind=broken")
    read = documents.read_register(spark, f"{root}/kind=clean")
    return shown(found.select("rule", "key", "code").unionByName(read.select(F.lit("").alias("rule"), F.col("path").alias("key"), F.lit("").alias("code"))))


REGISTER_SQL = """
SELECT rule, 'by-year/' || page_id AS key, code FROM pages, (VALUES ('year shape', 17, 'bad_arguments'), ('subjects allowed', 11, 'bad_arguments'), ('source url', 13, 'bad_manifest')) v(rule, m, code)
WHERE page_id % m = 0
UNION ALL SELECT '', 'by-year/' || page_id, '' FROM pages WHERE page_id % 17 <> 0 AND page_id % 11 <> 0 AND page_id % 13 <> 0"""


def index_scan(spark, folder):
    """Markdown table lines made of orders, read into four columns; other lines are skipped."""
    lines = table(spark, folder, "orders").selectExpr(
        "CASE o_orderkey % 4 WHEN 0 THEN '| --- | --- | --- | --- |' WHEN 1 THEN concat('| ', o_orderkey, ' | a | b |') "
        "ELSE concat(' | ', date_format(o_orderdate, 'yyyy-MM'), ' | AFR | Rev. Rul. ', o_orderkey, ' | [', IF(o_orderkey % 4 = 2, 'PDF](by-year/', 'Link](https://x/'), o_orderkey, ') |') END AS value"
    )
    return shown(documents.preserved_rows(documents.index_lines(lines, "value")))


INDEX_SQL = """
SELECT strftime(o_orderdate, '%Y-%m') AS period, 'AFR' AS rates_covered, 'Rev. Rul. ' || o_orderkey AS revenue_ruling, '[Link](https://x/' || o_orderkey || ')' AS link
FROM orders WHERE o_orderkey % 4 = 3"""


def seed_history(spark, folder):
    """Orders with the gift exclusion in force in their year, from expanded static ranges."""
    history = seeds.gift_history(spark)
    orders = table(spark, folder, "orders").selectExpr("o_orderkey", f"{ORDER_DAY} AS day")
    joined = orders.join(history, F.make_date(F.year("day"), F.lit(1), F.lit(1)) == F.col("period_start_date"), "left")
    return shown(joined.select("o_orderkey", "annual_exclusion_amount_usd"))


SEED_SQL = f"""
SELECT o_orderkey, CASE WHEN year(o_orderdate) <= 2001 THEN 10000 WHEN year(o_orderdate) <= 2005 THEN 11000 ELSE {ABSENT} END AS annual_exclusion_amount_usd FROM orders"""


def year_ranges(spark, folder):
    """Segments' customer ranges expanded to one period per year."""
    ranges = table(spark, folder, "customer").selectExpr("c_custkey", "1950 + CAST(c_custkey % 40 AS INT) AS a", "1950 + CAST(c_custkey % 40 + c_custkey % 7 AS INT) AS b")
    return shown(expand_years(ranges, "a", "b", ["c_custkey"]))


RANGES_SQL = """
SELECT c_custkey, y || '-01-01' AS period_start_date, y || '-12-31' AS period_end_date
FROM (SELECT c_custkey, unnest(generate_series(1950 + c_custkey % 40, 1950 + c_custkey % 40 + c_custkey % 7)) AS y FROM customer)"""


def year_shards(spark, folder):
    """One JSON array per year, at most a record per day, read back by the shard reader."""
    path = scratch_path(spark, "shards")
    rows = table(spark, folder, "orders").selectExpr(f"{ORDER_DAY} AS date").groupBy("date").agg(
        F.count(F.lit(1)).cast("int").alias("rate_basis_points")
    )
    text = F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(F.to_json(F.struct("date", "rate_basis_points")))), ","), F.lit("]"))
    rows.groupBy(F.year("date").alias("year")).agg(text.alias("value")).write.partitionBy("year").text(path)
    back = shards.read_json_records(spark, f"{path}/*/*.txt", dataset("federal-funds").schema)
    raw = shards.read_raw_records(spark, f"{path}/*/*.txt")
    migrated = migrate.migrate_overnight(raw, "federal-funds")[0].select("date", F.col("rate_basis_points").alias("migrated"))
    return shown(back.join(migrated, "date").select("date", "rate_basis_points", "migrated"))


YEAR_SHARDS_SQL = f"SELECT CAST({ORDER_DAY} AS VARCHAR) AS date, count(*) AS rate_basis_points, count(*) AS migrated FROM orders GROUP BY 1"


def nested_tables(spark, folder):
    """Brands as nested mortality tables through JSON and back to long rows."""
    part = table(spark, folder, "part")
    select = part.selectExpr("p_brand AS table_id", "p_size AS issue_age", "CAST(p_partkey % 25 AS INT) AS duration", "CAST(p_size * 7 + p_partkey % 25 AS BIGINT) AS rate").distinct()
    ultimate = part.selectExpr("p_brand AS table_id", "p_size AS attained_age", "CAST(p_size * 9 AS BIGINT) AS rate").distinct()
    nested = shards.nest_table_rows(select, ultimate)
    schema = "table_id string, select_rates map<string,map<string,bigint>>, ultimate_rates map<string,bigint>"
    parsed = nested.select(F.from_json(F.to_json(F.struct("*")), schema).alias("t")).select("t.*")
    rows = shards.select_rate_rows(parsed).withColumn("kind", F.lit("select"))
    more = shards.ultimate_rate_rows(parsed).select("table_id", F.col("attained_age").alias("issue_age"), F.lit(None).cast("int").alias("duration"), "rate").withColumn("kind", F.lit("ultimate"))
    return shown(rows.unionByName(more))


NESTED_SQL = f"""
SELECT DISTINCT p_brand AS table_id, CAST(p_size AS BIGINT) AS issue_age, p_partkey % 25 AS duration, CAST(p_size * 7 + p_partkey % 25 AS BIGINT) AS rate, 'select' AS kind FROM part
UNION ALL SELECT DISTINCT p_brand, p_size, {ABSENT}, p_size * 9, 'ultimate' FROM part"""


QUERIES = {
    "page_tokens": Query(page_tokens, TOKENS_SQL, ("SRC-10",)),
    "page_links": Query(page_links, LINKS_SQL, ("SRC-11",)),
    "link_discovery": Query(link_discovery, DISCOVERY_SQL, ("SRC-11", "WIN-3")),
    "ruling_links": Query(ruling_links, RULING_LINKS_SQL, ("SRC-11", "WIN-3", "PRJ-23")),
    "rate_table": Query(rate_table, RATE_TABLE_SQL, ("SRC-10", "PRJ-13", "PRJ-20")),
    "ruling_tables": Query(ruling_tables, RULING_TABLES_SQL, ("SRC-12", "WIN-2", "FLT-8")),
    "prose_amounts": Query(prose_amounts, PROSE_SQL, ("SRC-13", "PRJ-16", "PRJ-18")),
    "prose_skipping": Query(prose_skipping, SKIPPING_SQL, ("SRC-13",)),
    "grid_mortality": Query(grid_mortality, MORTALITY_SQL, ("SRC-14a",)),
    "grid_single_life": Query(grid_single_life, SINGLE_SQL, ("SRC-14b", "WIN-2")),
    "grid_commutation": Query(grid_commutation, COMMUTATION_SQL, ("SRC-14c",)),
    "grid_term_certain": Query(grid_term_certain, TERM_CERTAIN_SQL, ("SRC-14d",)),
    "grid_one_life": Query(grid_one_life, ONE_LIFE_SQL, ("SRC-14e",)),
    "grid_two_life": Query(grid_two_life, TWO_LIFE_SQL, ("SRC-14f",)),
    "curve_feed": Query(curve_feed, CURVE_SQL, ("SRC-1", "FLT-1", "FLT-14", "PRJ-26")),
    "overnight_feed": Query(overnight_feed, OVERNIGHT_SQL, ("SRC-2", "FLT-4", "PRJ-11")),
    "mixed_feed": Query(mixed_feed, MIXED_SQL, ("SRC-3", "AGG-1", "FLT-2")),
    "migrate_period": Query(migrate_period, MIGRATE_SQL, ("PRJ-32", "FLT-6", "FLT-13")),
    "register_scan": Query(register_scan, REGISTER_SQL, ("SRC-15", "FLT-15")),
    "index_scan": Query(index_scan, INDEX_SQL, ("SRC-16",)),
    "seed_history": Query(seed_history, SEED_SQL, ("SRC-17", "GEN-2")),
    "year_ranges": Query(year_ranges, RANGES_SQL, ("GEN-2",)),
    "year_shards": Query(year_shards, YEAR_SHARDS_SQL, ("SRC-4", "SRC-5", "PRJ-32")),
    "nested_tables": Query(nested_tables, NESTED_SQL, ("SRC-7", "PRJ-30")),
}
