"""Amounts stated in prose: the first pattern of an ordered list that matches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decoded import let
from ..functions.numbers import currency_amount, year_number
from ..functions.text import collapse, procedure_citation


@dataclass(frozen=True)
class AmountRule:
    """Patterns in order of preference, each as (pattern, year group, amount group)."""

    amount_column: str
    patterns: tuple[tuple[str, int, int], ...]
    skip_unmatched: bool = False


# The sentences in which each amount is published.
RULES = {
    "annual-gift-exclusion": AmountRule(
        "annual_exclusion_amount_usd",
        (
            (r"For calendar year ([0-9]{4}), the first \$([0-9,]+) of gifts to any person", 1, 2),
            (r"annual exclusion for gifts is \$([0-9,]+) for calendar year ([0-9]{4})", 2, 1),
        ),
    ),
    "estate-gift-tax-exemption": AmountRule(
        "basic_exclusion_amount_usd",
        (
            (
                r"estate of any decedent dying in calendar year ([0-9]{4}), "
                r"the basic exclusion amount is \$([0-9,]+)", 1, 2,
            ),
            (
                r"estates of decedents who die during ([0-9]{4}) have a "
                r"basic exclusion amount of \$([0-9,]+)", 1, 2,
            ),
            (r"basic exclusion amount to \$([0-9,]+) for calendar year ([0-9]{4})", 2, 1),
        ),
    ),
    "gst-exemption": AmountRule(
        "exemption_amount_usd",
        (
            (
                r"For calendar year ([0-9]{4}), the generation-skipping transfer exemption "
                r"amount under § 2631\(c\) is equal to \$([0-9,]+)", 1, 2,
            ),
        ),
        skip_unmatched=True,
    ),
    "noncitizen-spouse-gift-exclusion": AmountRule(
        "annual_exclusion_amount_usd",
        (
            (
                r"For calendar year ([0-9]{4}), the first \$([0-9,]+)"
                r"(?: \(instead of the amount provided in paragraph \(1\) of this section [0-9.]+\))?"
                r" of gifts to a spouse who is not a citizen of the United States", 1, 2,
            ),
        ),
    ),
}


def _sentence(text: Column, rule: AmountRule) -> Column:
    """The matched sentence with its year and amount; null when no pattern matches.

    Each pattern scans the text once; groups are then read from the short match.
    """
    result = F.lit(None).cast("struct<year:string,amount:string>")
    for pattern, year, amount in reversed(rule.patterns):
        shape = f"(?i){pattern}"
        later = result
        result = let(
            F.regexp_substr(text, F.lit(shape)),
            lambda found: F.when(
                found.isNotNull(),
                F.struct(
                    F.regexp_extract(found, shape, year).alias("year"),
                    F.regexp_extract(found, shape, amount).alias("amount"),
                ),
            ).otherwise(later),
        )
    return F.when(F.contains(text, F.lit("$")), result)


def extract_amounts(documents: DataFrame, url: str, text: str, rule: AmountRule) -> DataFrame:
    """(period, amount, citation, source_url, problem), one row per document.

    Documents without a matching sentence, or with one whose amount or year is no figure,
    are dropped where the rule says so and are problems otherwise.
    """
    def read(sentence: Column, procedure: Column) -> Column:
        return F.struct(
            year_number(sentence["year"]).value.alias("year"),
            currency_amount(sentence["amount"]).value.alias("amount"),
            procedure.alias("procedure"),
            sentence.isNotNull().alias("matched"),
        )

    found = documents.select(
        F.col(url).alias("source_url"),
        let(
            collapse(F.col(text)),
            lambda t: let(_sentence(t, rule), lambda s: let(procedure_citation(t), lambda p: read(s, p))),
        ).alias("r"),
    )
    if rule.skip_unmatched:
        usable = F.col("r.matched") & F.col("r.amount").isNotNull() & F.col("r.year").isNotNull()
        found = found.filter(F.col("r.procedure").isNull() | usable)
    return found.select(
        F.make_date("r.year", F.lit(1), F.lit(1)).alias("period_start_date"),
        F.make_date("r.year", F.lit(12), F.lit(31)).alias("period_end_date"),
        F.col("r.amount").alias(rule.amount_column),
        F.col("r.procedure").alias("revenue_procedure"),
        "source_url",
        F.when(F.col("r.procedure").isNull(), "invalid_revenue_procedure")
        .when(F.col("r.amount").isNull() | F.col("r.year").isNull(), "invalid_amount").alias("problem"),
    )
