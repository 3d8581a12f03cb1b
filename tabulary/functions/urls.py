"""Address checks and joins, as column predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import iso_date


def url_part(url: Column, part: str) -> Column:
    """SCHEME, AUTHORITY, PATH or QUERY by the generic syntax; '' when absent."""
    group = {"SCHEME": 2, "AUTHORITY": 4, "PATH": 5, "QUERY": 7, "FRAGMENT": 9}[part]
    return F.regexp_extract(url, r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?", group)


def query_values(url: Column, key: str) -> Column:
    """All values of one query key, in order, percent-decoded."""
    pairs = F.split(url_part(url, "QUERY"), "&")
    wanted = F.filter(pairs, lambda pair: F.substring_index(pair, "=", 1) == key)
    return F.transform(
        wanted,
        lambda pair: F.try_url_decode(
            F.when(F.contains(pair, F.lit("=")), F.substr(pair, F.lit(len(key) + 2))).otherwise(F.lit(""))
        ),
    )


def url_allowed(
    url: Column,
    host: str,
    prefixes: tuple[str, ...] = (),
    suffix: str = "",
    path: str | None = None,
    query: dict[str, str] | None = None,
) -> Column:
    """https, exact host, and the given path and query rules."""
    where = url_part(url, "PATH")
    rule = (F.lower(url_part(url, "SCHEME")) == "https") & (url_part(url, "AUTHORITY") == host)
    if path is not None:
        rule = rule & (where == path)
    if prefixes:
        starts = F.lit(False)
        for prefix in prefixes:
            starts = starts | where.startswith(prefix)
        rule = rule & starts
    if suffix:
        rule = rule & where.endswith(suffix)
    for key, value in (query or {}).items():
        rule = rule & (query_values(url, key) == F.array(F.lit(value)))
    return F.coalesce(rule, F.lit(False))


# Where each kind of source may come from.
def curve_feed_allowed(url: Column) -> Column:
    return url_allowed(
        url,
        "home.treasury.gov",
        prefixes=("/resource-center/data-chart-center/interest-rates/daily-treasury-rates.csv/",),
        query={"type": "daily_treasury_yield_curve", "_format": "csv"},
    )


def overnight_feed_allowed(url: Column, path: str, first_day: str) -> Column:
    start, end = query_values(url, "startDate"), query_values(url, "endDate")
    first, last = iso_date(F.try_element_at(start, F.lit(1))).value, iso_date(F.try_element_at(end, F.lit(1))).value
    single = (F.size(start) == 1) & (F.size(end) == 1)
    ordered = (first >= F.lit(first_day).cast("date")) & (first <= last)
    return F.coalesce(
        url_allowed(url, "markets.newyorkfed.org", path=path) & single & ordered, F.lit(False)
    )


def ruling_document_allowed(url: Column) -> Column:
    return url_allowed(url, "www.irs.gov", prefixes=("/pub/irs-drop/", "/pub/irs-irbs/"), suffix=".pdf")


def procedure_document_allowed(url: Column) -> Column:
    return url_allowed(url, "www.irs.gov", prefixes=("/pub/irs-drop/",), suffix=".pdf")


def news_page_allowed(url: Column) -> Column:
    return url_allowed(url, "www.irs.gov", prefixes=("/newsroom/",))


def rate_page_allowed(url: Column) -> Column:
    return url_allowed(url, "www.irs.gov", prefixes=("/businesses/",))


def ruling_index_allowed(url: Column) -> Column:
    return url_allowed(url, "www.irs.gov", path="/applicable-federal-rates")


def workbook_allowed(url: Column) -> Column:
    return url_allowed(url, "www.irs.gov", prefixes=("/pub/irs-tege/",))


def join_url(base: Column, reference: Column) -> Column:
    """Resolve a reference against its page address, dot segments included."""
    scheme, authority = url_part(base, "SCHEME"), url_part(base, "AUTHORITY")
    base_path = url_part(base, "PATH")
    ref_path = url_part(reference, "PATH")
    tail = F.concat(
        F.regexp_extract(reference, r"(\?[^#]*)", 1), F.regexp_extract(reference, "(#.*)$", 1)
    )
    merged = F.when(ref_path.startswith("/"), ref_path).otherwise(
        F.concat(F.when(base_path == "", F.lit("/")).otherwise(F.regexp_replace(base_path, "[^/]*$", "")), ref_path)
    )
    parts = F.split(merged, "/")
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(part))),
    )
    slash = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    path = F.concat(F.array_join(folded, "/"), slash)
    site = F.concat(scheme, F.lit("://"), authority)
    return (
        F.when(reference.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), reference)
        .when(reference.startswith("//"), F.concat(scheme, F.lit(":"), reference))
        .when(reference == "", base)
        .when(
            ref_path == "",
            F.concat(
                site, base_path,
                F.when(reference.startswith("#"), F.regexp_extract(F.regexp_replace(base, "#.*$", ""), r"(\?.*)$", 1)).otherwise(F.lit("")),
                tail,
            ),
        )
        .otherwise(F.concat(site, path, tail))
    )
