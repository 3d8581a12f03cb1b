"""Older record shapes to the canonical one.

Input is one row per record with its JSON text (``shards.read_raw_records``). Every
dataset lists the key sets it ever used; a record with any other set is a violation.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_date
from ..functions.numbers import MAX_BASIS_POINTS, MAX_COUNT
from ..functions.records import FAMILIES, TENOR_KEYS
from ..functions.urls import procedure_document_allowed, rate_page_allowed
from ..operators import checks
from ..operators.joins import apply_corrections
from ..registry import dataset
from .feeds import AVERAGED, OBSERVED, WIDE_VALUES
from .seeds import stored_rate_corrections

PROCEDURE = r"^Rev\. Proc\. [0-9]{4}-[0-9]{1,3}$"
RULING = r"^Rev\. Rul\.? ([0-9]{4}|[0-9]{2})-[0-9]{1,3}$"
CODE = "invalid_json"


def _sets(base: list[str], *optional: list[str]) -> list[list[str]]:
    """The base keys with every combination of the optional groups."""
    return [base + [k for group, used in zip(optional, flags) if used for k in group]
            for flags in product((False, True), repeat=len(optional))]


# Accepted key sets.
PERIOD = ["period_start_date", "period_end_date"]


def _statutory_sets(name: str, amount: str) -> list[list[str]]:
    """Key sets with dates, and key sets with a year, of a statutory amount."""
    notes = [[], ["revenue_procedure"], ["source_url"], ["revenue_procedure", "source_url"]]

    def shapes(base: list[str], endings: list[list[str]]) -> list[list[str]]:
        return [base] + [[*base, "applies_to", *ending] for ending in endings]

    dated, yearly = [*PERIOD, amount], ["year", amount]
    if name == "annual-gift-exclusion":
        return shapes(dated, notes[:1]) + shapes(yearly, notes)
    if name == "gst-exemption":
        return shapes(dated, notes) + shapes(yearly, [notes[1], notes[3]])
    return shapes(dated, notes) + shapes(yearly, notes)


# What each statutory amount applies to, current and former wording.
APPLIES_TO = {
    "annual-gift-exclusion": ("gifts_of_present_interests_made_during_calendar_year",),
    "estate-gift-tax-exemption": (
        "estates_of_decedents_dying_during_period",
        "estates_of_decedents_dying_during_calendar_year",
    ),
    "gst-exemption": ("generation_skipping_transfers_during_calendar_year",),
    "noncitizen-spouse-gift-exclusion": (
        "gifts_to_spouse_who_is_not_united_states_citizen_made_during_period",
        "gifts_to_spouse_who_is_not_united_states_citizen_made_during_calendar_year",
    ),
}


def _parsed(raw: DataFrame, schema: str) -> DataFrame:
    """Parsed fields next to the text and its sorted keys."""
    return raw.select("*", F.from_json("json", schema).alias("r"), F.json_object_keys("json").alias("names"))


def _has(name: str) -> Column:
    return F.coalesce(F.array_contains("names", name), F.lit(False))


def _whole(name: str) -> Column:
    """The field's JSON text is an integer; booleans and fractions are not."""
    text = F.get_json_object("json", f"$.{name}")
    return F.coalesce(text.rlike("^-?[0-9]+$"), F.lit(False))


def _bounded(name: str, low: int, high: int) -> Column:
    """True when broken: present, not null, and no integer inside the bounds."""
    text = F.get_json_object("json", f"$.{name}")
    return text.isNotNull() & ~(_whole(name) & F.coalesce(text.try_cast("bigint").between(low, high), F.lit(False)))


def migrate_statutory(raw: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """(records, violations) for one of the four statutory amounts."""
    data = dataset(name)
    amount = data.values[0]
    rows = _parsed(
        raw,
        f"year int, period_start_date string, period_end_date string, {amount} bigint, "
        "applies_to string, revenue_procedure string, source_url string",
    )
    year = F.col("r.year")
    start = F.when(_has("year"), F.make_date(year, F.lit(1), F.lit(1))).otherwise(iso_date(F.col("r.period_start_date")).value)
    end = F.when(_has("year"), F.make_date(year, F.lit(12), F.lit(31))).otherwise(iso_date(F.col("r.period_end_date")).value)
    records = rows.select("json", "names", "r", start.alias("period_start_date"), end.alias("period_end_date"),
                          F.col(f"r.{amount}").alias(amount))
    url = F.col("r.source_url")
    rules = {
        "keys": (checks.key_set_differs(F.col("json"), _statutory_sets(name, amount)), CODE),
        "year": (_has("year") & ~F.coalesce(year.between(1900, 2500), F.lit(False)), CODE),
        "period": (F.col("period_start_date").isNull() | F.col("period_end_date").isNull(), CODE),
        "amount": (~(_whole(amount) & (F.col(amount) > 0)), CODE),
        "applies to": (_has("applies_to") & ~F.coalesce(F.col("r.applies_to").isin(*APPLIES_TO[name]), F.lit(False)), CODE),
        "procedure": (F.col("r.revenue_procedure").isNotNull() & ~F.col("r.revenue_procedure").rlike(PROCEDURE), CODE),
        **checks.period_rules("period_start_date", "period_end_date", name == "annual-gift-exclusion"),
    }
    if name != "gst-exemption":
        rules["source url"] = ((url != "") & ~procedure_document_allowed(url), CODE)
    return records.select(*data.columns), checks.violations(records, ["json"], rules)


def migrate_monthly(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Monthly section 7520 percentages, with the former long names."""
    data = dataset("section-7520-rates")
    long_names = ["valuation_month", "applicable_federal_midterm_120_percent_basis_points",
                  "section_7520_rate_basis_points", "revenue_ruling"]
    allowed = _sets(list(data.columns), ["source_url"], ["revenue_ruling"]) + _sets(long_names, ["source_url"])
    rows = _parsed(
        raw,
        "effective_month string, valuation_month string, midterm_afr_120_basis_points int, "
        "applicable_federal_midterm_120_percent_basis_points int, section_7520_rate_basis_points int, "
        "revenue_ruling string, source_url string",
    )
    records = rows.select(
        "json", "names", "r",
        F.coalesce("r.valuation_month", "r.effective_month").alias("effective_month"),
        F.coalesce("r.applicable_federal_midterm_120_percent_basis_points", "r.midterm_afr_120_basis_points").alias("midterm_afr_120_basis_points"),
        F.col("r.section_7520_rate_basis_points").alias("section_7520_rate_basis_points"),
    )
    ruling, url = F.col("r.revenue_ruling"), F.col("r.source_url")
    rules = {
        "keys": (checks.key_set_differs(F.col("json"), allowed), CODE),
        "month": (~F.coalesce(F.col("effective_month").rlike("^[0-9]{4}-[0-9]{2}$"), F.lit(False)), CODE),
        "midterm rate": (F.col("midterm_afr_120_basis_points").isNull(), CODE),
        "section rate": (F.col("section_7520_rate_basis_points").isNull(), CODE),
        "ruling": ((ruling != "") & ~ruling.rlike(RULING), CODE),
        "source url": (url.isNotNull() & ~rate_page_allowed(url), CODE),
    }
    figures = ["effective_month", "midterm_afr_120_basis_points", "section_7520_rate_basis_points"]
    right = apply_corrections(
        records.select(*data.columns), stored_rate_corrections(raw.sparkSession), figures, "section_7520_rate_basis_points", "corrected")
    return right, checks.violations(records, ["json"], rules)


# The feed's code for each overnight rate.
RATE_TYPES = {"federal-funds": "EFFR", "sofr": "SOFR"}


def migrate_overnight(raw: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Overnight percentages; percentiles may be an object and the rate may have its old name."""
    percentiles = {p: f"percentile_{p}_basis_points" for p in (1, 25, 75, 99)}
    base, observed = ["date", "rate_basis_points"], ["date", *OBSERVED]
    detail = [*observed, *AVERAGED]
    nested = [*base, "rate_type", "percentiles_basis_points", "volume_billions", *AVERAGED, "revision_indicator", "footnote_id"]
    allowed = [*_sets(base, ["source_url"]), [*base, "rate_type"], [*base, "rate_type", "source_url"]]
    if name == "sofr":
        for keys in (observed, detail, nested):
            allowed += _sets(keys, ["source_url"])
    old = ["date", "effective_federal_funds_rate_basis_points"]
    if name == "federal-funds":
        allowed += _sets(old, ["source_url"])
    fields = ", ".join(f"{c} bigint" for c in WIDE_VALUES)
    nested_fields = ", ".join(f"`{p}`: bigint" for p in percentiles)
    rows = _parsed(
        raw,
        f"date string, {fields}, effective_federal_funds_rate_basis_points bigint, "
        f"percentiles_basis_points struct<{nested_fields}>, rate_type string, source_url string",
    )
    picked = {
        "rate_basis_points": F.coalesce("r.rate_basis_points", "r.effective_federal_funds_rate_basis_points"),
        "volume_billions": F.col("r.volume_billions"),
        **{c: F.coalesce(f"r.{c}", f"r.percentiles_basis_points.`{p}`") for p, c in percentiles.items()},
        **{c: F.col(f"r.{c}") for c in AVERAGED},
    }
    records = rows.select("json", "names", "r", iso_date(F.col("r.date")).value.alias("date"),
                          *[picked[c].alias(c) for c in WIDE_VALUES])
    rules = {
        "keys": (checks.key_set_differs(F.col("json"), allowed), CODE),
        "date": (F.col("date").isNull(), CODE),
        "rate type": (_has("rate_type") & ~F.col("r.rate_type").eqNullSafe(F.lit(RATE_TYPES[name])), CODE),
        "rate": (_bounded("rate_basis_points", 0, MAX_BASIS_POINTS), CODE),
        "old rate": (_bounded(old[1], 0, MAX_BASIS_POINTS), CODE),
        "volume": (_bounded("volume_billions", 0, MAX_COUNT), CODE),
        "index": (_bounded(AVERAGED[3], 0, 100_000_000_000_000), CODE),
        **{c: (_bounded(c, -MAX_BASIS_POINTS, MAX_BASIS_POINTS), CODE) for c in percentiles.values()},
        **{c: (_bounded(c, 0, MAX_BASIS_POINTS * 1000), CODE) for c in AVERAGED[:3]},
    }
    return records.select("date", *WIDE_VALUES), checks.violations(records, ["json"], rules)


def migrate_curve(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Yield curve; yields as a map of tenors in older files, as an array since."""
    rows = raw.select(
        "*",
        F.get_json_object("json", "$.date").alias("day"),
        F.get_json_object("json", "$.par_yields_basis_points").alias("yields"),
    ).withColumns(
        {
            "listed": F.from_json("yields", "array<int>"),
            "mapped": F.from_json("yields", "map<string,int>"),
        }
    )
    from_map = F.array(*[F.try_element_at("mapped", F.lit(k)) for k in TENOR_KEYS])
    is_list = F.col("yields").startswith("[")
    records = rows.select(
        "json", "yields", iso_date(F.col("day")).value.alias("date"), is_list.alias("is_list"), "listed", "mapped",
        F.when(is_list, F.col("listed")).otherwise(from_map).alias("par_yields_basis_points"),
    )
    keys = F.array_sort(F.json_object_keys("yields"))
    rules = {
        "keys": (checks.key_set_differs(F.col("json"), _sets(["date", "par_yields_basis_points"], ["source_url"])), CODE),
        "date": (F.col("date").isNull(), CODE),
        "tenors": (
            ~F.coalesce(
                F.when(F.col("is_list"), F.size("listed") == len(TENOR_KEYS))
                .otherwise(keys == F.array_sort(F.array(*[F.lit(k) for k in TENOR_KEYS]))),
                F.lit(False),
            ), CODE,
        ),
        "yields": (
            F.exists("par_yields_basis_points", lambda v: v.isNotNull() & ~v.between(0, MAX_BASIS_POINTS))
            | F.col("yields").rlike(r"true|false|\.|[eE]\d"), CODE,
        ),
    }
    return records.select("date", "par_yields_basis_points"), checks.violations(records, ["json"], rules)


def migrate_nested(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nested monthly tables; older files also carry their ruling and address."""
    data = dataset("applicable-federal-rates")
    base = list(data.columns)
    allowed = [base, [*base, "revenue_ruling"], [*base, "revenue_ruling", "source_url"]]
    rows = raw.select("*", F.from_json("json", data.schema).alias("r")).select("json", "r.*")
    terms = F.get_json_object("json", "$.applicable_federal_rates")

    def keys_at(path: str, wanted) -> Column:
        found = F.array_sort(F.json_object_keys(F.get_json_object("json", path)))
        return ~F.coalesce(found == F.array_sort(F.array(*[F.lit(w) for w in wanted])), F.lit(False))

    rules = {
        "keys": (checks.key_set_differs(F.col("json"), allowed), CODE),
        "month": (~F.coalesce(F.col("effective_month").rlike("^[0-9]{4}-[0-9]{2}$"), F.lit(False)), CODE),
        "terms": (terms.isNull() | keys_at("$.applicable_federal_rates", FAMILIES), CODE),
        "adjusted terms": (keys_at("$.adjusted_applicable_federal_rates", FAMILIES), CODE),
        **{f"{t} families": (keys_at(f"$.applicable_federal_rates.{t}", FAMILIES[t]), CODE) for t in FAMILIES},
    }
    cells = [F.col(f"applicable_federal_rates.{t}.{f}.{c}") for t, fs in FAMILIES.items() for f in fs
             for c in ("annual", "semiannual", "quarterly", "monthly")]
    cells += [F.col(f"adjusted_applicable_federal_rates.{t}.{c}") for t in FAMILIES
              for c in ("annual", "semiannual", "quarterly", "monthly")]
    rules["cells"] = (
        F.exists(F.array(*cells), lambda v: ~F.coalesce(v.between(0, MAX_BASIS_POINTS), F.lit(False))), CODE,
    )
    return rows.select(*data.columns), checks.violations(rows, ["json"], rules)
