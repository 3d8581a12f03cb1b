"""Web pages: visible tokens, the monthly rate table, and document links.

A page is one row, so everything happens inside the row on arrays and no page is
ever exploded and gathered again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import MONTH_WORD, month_name_year
from ..functions.decoded import with_decoded
from ..functions.numbers import required_percent
from ..functions.text import collapse, ruling_label, unescape
from ..functions.urls import join_url, ruling_document_allowed
from ..operators.windows import first_seen

# The header cells of the monthly rate table and its end marker.
TABLE_HEADERS = (
    "Valuation month",
    "120% of applicable federal midterm rate",
    "Section 7520 interest rate",
    "Revenue ruling",
)
TABLE_END = "For prior years"
# Documents the link index is known to omit.
OMITTED_CURRENT = ("https://www.irs.gov/pub/irs-drop/rr-26-09.pdf",)
OMITTED_BACKFILL = (
    "https://www.irs.gov/pub/irs-drop/rr-01-22.pdf",
    "https://www.irs.gov/pub/irs-drop/rr-13-09.pdf",
    "https://www.irs.gov/pub/irs-drop/rr-13-11.pdf",
)
PROCEDURE_LINK = r"(?:https://www\.irs\.gov)?/pub/irs-drop/rp-[0-9]{2}-[0-9]{1,3}\.pdf"


def visible_tokens(html: Column) -> Column:
    """Texts between tags, without comments, scripts and styles."""
    shown = F.regexp_replace(html, r"(?s)<!--.*?-->", "<>")
    shown = F.regexp_replace(shown, r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1\s*>", "<>")
    return F.filter(
        F.transform(F.split(shown, "<[^>]*>"), lambda t: collapse(unescape(t))), lambda t: t != ""
    )


def rate_table_rows(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(url, position, four raw cells) for each month cell after the header cells.

    A month with fewer than three following tokens keeps null cells and so fails.
    """
    starts = [F.array_position("tokens", header) for header in TABLE_HEADERS]
    found = F.least(*starts) > 0
    start = F.greatest(*starts)
    body = F.slice("tokens", start + 1, F.greatest(F.size("tokens"), F.lit(0)))
    stop = F.array_position(F.transform("body", lambda t: t.startswith(TABLE_END)), True)
    spots = F.filter(
        F.sequence(F.lit(1), F.size("body")),
        lambda i: F.element_at("body", i.cast("int")).rlike(f"^{MONTH_WORD} ([0-9]{{4}})$")
        & ((F.col("stop") == 0) | (i < F.col("stop"))),
    )
    cell = lambda k: F.try_element_at("body", (F.col("spot") + k).cast("int"))
    return (
        pages.select(F.col(url).alias("url"), visible_tokens(F.col(html)).alias("tokens"))
        .withColumn("body", F.when(found, body))
        .filter(F.size("body") > 0)
        .withColumn("stop", stop)
        .select("url", "body", F.explode(spots).alias("spot"))
        .select(
            "url", F.col("spot").alias("position"), cell(0).alias("month_cell"), cell(1).alias("midterm_cell"),
            cell(2).alias("section_cell"), cell(3).alias("ruling_cell"),
        )
    )


def pages_without_table(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Pages on which one of the header cells is missing."""
    starts = [F.array_position("tokens", header) for header in TABLE_HEADERS]
    return (
        pages.select(F.col(url).alias("url"), visible_tokens(F.col(html)).alias("tokens"))
        .filter(F.coalesce(F.least(*starts), F.lit(0)) == 0)
        .select("url")
    )


def pages_without_months(pages: DataFrame, rows: DataFrame, url: str) -> DataFrame:
    """Pages that give no month row, with or without header cells, one row per url."""
    return pages.select(F.col(url).alias("url")).distinct().join(rows.select("url").distinct(), "url", "left_anti")


def decode_rate_table(rows: DataFrame) -> DataFrame:
    def cell(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(""))

    return with_decoded(
        rows,
        {
            "effective_month": month_name_year(cell("month_cell")),
            "midterm_afr_120_basis_points": required_percent(cell("midterm_cell"), trailing_ticks=True),
            "section_7520_rate_basis_points": required_percent(cell("section_cell"), trailing_ticks=True),
            "revenue_ruling": ruling_label(cell("ruling_cell")),
        },
    ).select(
        "effective_month", F.col("midterm_afr_120_basis_points").cast("int").alias("midterm_afr_120_basis_points"),
        F.col("section_7520_rate_basis_points").cast("int").alias("section_7520_rate_basis_points"),
        "revenue_ruling", F.col("url").alias("source_url"), "bad_fields",
    )


def anchors(html: Column) -> Column:
    """Array of (href, text) in page order; an anchor ends where the next begins."""
    shown = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    parts = F.split(shown, r"(?i)<a(?=[\s>])")
    tails = F.slice(parts, F.lit(2), F.size(parts))

    def one(tail: Column) -> Column:
        tag = F.regexp_extract(tail, r"(?s)^([^>]*)>", 1)
        quoted = r"(?is)(?:^|\s)href\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
        href = F.concat(*[F.regexp_extract(tag, quoted, g) for g in (1, 2, 3)])
        body = F.regexp_extract(tail, r"(?is)^[^>]*>(.*?)</a\s*>", 1)
        return F.struct(
            F.when(tag.rlike(quoted), unescape(href)).alias("href"),
            collapse(unescape(F.regexp_replace(body, "<[^>]*>", " "))).alias("text"),
        )

    return F.filter(F.transform(tails, one), lambda a: a["href"].isNotNull())


def page_links(pages: DataFrame, url: str, html: str, wanted=None) -> DataFrame:
    """(page_url, position, href, text, target) for anchors that satisfy ``wanted``."""
    links = anchors(F.col(html))
    if wanted is not None:
        links = F.filter(links, wanted)
    return (
        pages.select(F.col(url).alias("page_url"), F.posexplode(links).alias("position", "a"))
        .select("page_url", "position", "a.href", "a.text")
        .withColumn("target", join_url(F.col("page_url"), F.col("href")))
    )


def ruling_links(pages: DataFrame, url: str, html: str, backfill: bool = False) -> DataFrame:
    """Ruling documents linked from index pages plus known omissions, first seen first.

    Columns url and allowed; a link that is not allowed is a violation upstream.
    """
    found = page_links(
        pages, url, html,
        lambda a: F.contains(F.upper(a["text"]), F.lit("APPLICABLE FEDERAL RATES")) & a["href"].endswith(".pdf"),
    ).select(
        F.replace("target", F.lit("%2520"), F.lit("%20")).alias("url"),
        F.lit(0).alias("list"), "page_url", "position",
    )
    omitted = OMITTED_CURRENT + (OMITTED_BACKFILL if backfill else ())
    extra = pages.sparkSession.createDataFrame(
        [(u, 1, "", i) for i, u in enumerate(omitted)], "url string, list int, page_url string, position int"
    )
    everything = found.unionByName(extra)
    return first_seen(everything, ["url"], ["list", "page_url", "position"], ["list", "page_url", "position"]).withColumn(
        "allowed", ruling_document_allowed(F.col("url"))
    )


def procedure_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """Procedure documents named anywhere in news pages, made absolute, first seen."""
    named = F.regexp_extract_all(F.col(html), F.lit(PROCEDURE_LINK), F.lit(0))
    found = pages.select(F.col(url).alias("page_url"), F.posexplode(named).alias("position", "link")).select(
        F.when(F.col("link").startswith("https://"), F.col("link"))
        .otherwise(F.concat(F.lit("https://www.irs.gov"), "link")).alias("url"),
        "page_url", "position",
    )
    return first_seen(found, ["url"], ["page_url", "position"], ["page_url", "position"])
