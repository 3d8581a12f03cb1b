"""Date and month text. Results are DATE columns, or ``yyyy-MM`` text for months."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .decoded import Decoded, required, strip

# English month names as published, in calendar order.
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
MONTH_WORD = "(" + "|".join(MONTH_NAMES) + ")"


def _parsed(text: Column, shape: str, layout: str) -> Decoded:
    trimmed = strip(text)
    return required(F.when(trimmed.rlike(shape), F.try_to_date(trimmed, layout)))


def slash_date(text: Column) -> Decoded:
    """``6/1/2026`` and ``06/01/2026`` alike."""
    return _parsed(text, r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "M/d/yyyy")


def padded_slash_date(text: Column) -> Decoded:
    """Two-digit month and day required."""
    return _parsed(text, r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$", "MM/dd/yyyy")


def iso_date(text: Column) -> Decoded:
    return _parsed(text, r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", "yyyy-MM-dd")


def month_number(name: Column) -> Column:
    """1 to 12 for a month name in any case, else null."""
    position = F.array_position(F.array(*[F.lit(m.lower()) for m in MONTH_NAMES]), F.lower(name))
    return F.when(position > 0, position)


def month_key(name: Column, year: Column) -> Column:
    """``yyyy-MM`` from a month name and a four-digit year."""
    return F.when(
        year.rlike("^[0-9]{4}$"),
        F.concat(year, F.lit("-"), F.lpad(month_number(name).cast("string"), 2, "0")),
    )


def month_name_year(text: Column) -> Decoded:
    """``October 2014`` to ``2014-10``."""
    shape = f"^{MONTH_WORD} ([0-9]{{4}})$"
    key = month_key(F.substring_index(text, " ", 1), F.substring_index(text, " ", -1))
    return required(F.when(text.rlike(shape), key))
