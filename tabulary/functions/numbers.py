"""Exact decimal text to scaled integers. Nothing here goes through a double."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from .decoded import Decoded, let, required, strip

# Cells that mean "no figure".
NULL_TOKENS = ("", ".", "N/A", "NA")
# Published bounds, in basis points, before any further scaling.
MAX_BASIS_POINTS = 100_000
MAX_COUNT = 10_000_000

# decimal(38,18) loses scale in arithmetic and would round away a nineteenth digit.
WIDE = "decimal(30,18)"
# Plain numbers that WIDE holds without rounding; all others go by their digits.
_SHORT = r"^[+-]?(?:[0-9]{1,12}(?:\.[0-9]{0,18})?|\.[0-9]{1,18})$"
# Of these, numbers whose ties show within the 14 fraction digits that rounding half even keeps.
_FINE = r"^[+-]?(?:[0-9]{1,12}(?:\.[0-9]{0,14})?|\.[0-9]{1,14})$"
_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
# Shifts beyond this leave no digit that matters; it bounds exponents of any length.
_FAR = 1_000_000


def has_figure(trimmed: Column) -> Column:
    return ~trimmed.isin(*NULL_TOKENS)


def null_token(text: Column) -> Column:
    trimmed = strip(text)
    return F.when(has_figure(trimmed), trimmed)


def is_number(trimmed: Column) -> Column:
    """Whether the text is a number, with or without an exponent, of any length."""
    return trimmed.rlike(_NUMBER)


def short_decimal(trimmed: Column) -> Column:
    """A decimal equal to the text, or null when the text is no short plain number."""
    return F.when(trimmed.rlike(_SHORT), trimmed.try_cast(WIDE))


def _by_digits(
    trimmed: Column, digits: int, body: Callable[[Column, Column, Column], Column], short: str = _SHORT,
) -> Column:
    """``body`` of the digits of any number that ``short`` does not match, moved ``digits`` places to the left of the point.

    Its arguments are the whole part (a bigint, null beyond 18 digits), the digits after the point without
    closing zeros, and whether the number is below zero.
    """

    def moved(text: Column) -> Column:
        mantissa = F.ltrim(F.substring_index(text, "e", 1), F.lit("+-"))
        power = F.when(F.contains(text, F.lit("e")), F.substring_index(text, "e", -1)).otherwise(F.lit("0"))
        bounded = F.coalesce(power.try_cast("bigint"), F.when(power.startswith("-"), F.lit(-_FAR)).otherwise(F.lit(_FAR)))
        shift = F.greatest(F.lit(-_FAR), F.least(F.lit(_FAR), bounded))
        head = F.substring_index(mantissa, ".", 1)
        all_digits = F.replace(mantissa, F.lit("."), F.lit(""))
        return let(F.ltrim(all_digits, F.lit("0")), lambda lead: let(
            F.length(head) + shift + digits - F.length(all_digits) + F.length(lead), lambda point: parts(text, lead, point)))

    def parts(text: Column, lead: Column, point: Column) -> Column:
        whole = F.when(F.length(lead) == 0, F.lit(0)).when(point <= 0, F.lit(0)).when(
            point <= 18, F.rpad(lead, point.cast("int"), "0").try_cast("bigint"))
        rest = F.when(point < 0, F.concat(F.lit("0"), lead)).when(point == 0, lead).otherwise(
            F.substring(lead, (point + 1).cast("int"), F.length(lead)))
        return body(whole, F.rtrim(rest, F.lit("0")), text.startswith("-") & (F.length(lead) > 0))

    return F.when(~trimmed.rlike(short) & is_number(trimmed), let(F.lower(trimmed), moved))


def power_of_ten(digits: int) -> Column:
    return F.lit(10**digits).cast(f"decimal({digits + 1},0)")


def scale_exactly(trimmed: Column, digits: int, low: int, high: int) -> Column:
    """The number in the text × 10^digits; null unless integral and inside [low, high]."""
    number = short_decimal(trimmed)
    bottom, top = (F.lit(Decimal(b).scaleb(-digits)).cast(WIDE) for b in (low, high))
    exact = (number == F.round(number, digits)) & (number >= bottom) & (number <= top)

    def long_number(whole: Column, rest: Column, negative: Column) -> Column:
        value = F.when(negative, -whole).otherwise(whole)
        return F.when((F.length(rest) == 0) & value.between(low, high), value)

    return F.coalesce(
        F.when(exact, (F.round(number, digits) * power_of_ten(digits)).try_cast("bigint")), _by_digits(trimmed, digits, long_number))


def scaled_integer(text: Column, digits: int, low: int, high: int) -> Decoded:
    trimmed = strip(text)
    return Decoded(scale_exactly(trimmed, digits, low, high), has_figure(trimmed))


def percent_basis_points(text: Column) -> Decoded:
    return scaled_integer(text, 2, 0, MAX_BASIS_POINTS)


def signed_percent_basis_points(text: Column) -> Decoded:
    return scaled_integer(text, 2, -MAX_BASIS_POINTS, MAX_BASIS_POINTS)


def percent_basis_points_thousandths(text: Column) -> Decoded:
    return scaled_integer(text, 5, 0, MAX_BASIS_POINTS * 1000)


def index_hundred_millionths(text: Column) -> Decoded:
    return scaled_integer(text, 8, 0, MAX_BASIS_POINTS * 100_000_000)


def bare_percent(text: Column, trailing_ticks: bool = False) -> Column:
    """Text of a percent cell without its sign.

    ``trailing_ticks`` also drops stray back-ticks that one published page carries.
    """
    trimmed = strip(text)
    if trailing_ticks:
        trimmed = F.rtrim(trimmed, F.lit("`"))
    return F.regexp_replace(trimmed, "%$", "")


def required_percent(text: Column, trailing_ticks: bool = False) -> Decoded:
    """A percent cell that may not be empty; one trailing ``%`` is dropped."""
    return required(scale_exactly(bare_percent(text, trailing_ticks), 2, 0, MAX_BASIS_POINTS))


def count_value(text: Column) -> Decoded:
    trimmed = strip(text)
    number = F.when(trimmed.rlike("^[0-9]+$"), trimmed.try_cast("bigint"))
    return Decoded(F.when(number <= MAX_COUNT, number), has_figure(trimmed))


def currency_amount(text: Column) -> Decoded:
    bare = F.replace(text, F.lit(","), F.lit(""))
    number = F.when(bare.rlike("^[0-9]+$"), bare.try_cast("bigint"))
    return Decoded(F.when(number > 0, number), text.isNotNull())


def year_number(text: Column) -> Decoded:
    number = F.when(text.rlike("^[0-9]{4}$"), text.try_cast("int"))
    return Decoded(F.when(number.between(1900, 2500), number), text.isNotNull())


def millionths(number: Column) -> Column:
    """number × 10^6 rounded half up; null when negative, not a number, or beyond a bigint."""
    trimmed = strip(number.cast("string"))
    value = short_decimal(trimmed)

    def long_number(whole: Column, rest: Column, negative: Column) -> Column:
        return F.when(~negative, whole + (rest >= "5").cast("int"))

    short = F.when(value >= 0, (F.round(value, 6) * power_of_ten(6)).try_cast("bigint"))
    return F.coalesce(short, _by_digits(trimmed, 6, long_number))


def cell_is_number(text: Column) -> Column:
    return is_number(strip(text))


def cell_integer(text: Column, numeric: Column) -> Column:
    """Whole number in a cell: digits as text, or a numeric cell without fraction."""
    trimmed = strip(text)
    value = short_decimal(trimmed)

    def long_number(whole: Column, rest: Column, negative: Column) -> Column:
        return F.when(F.length(rest) == 0, F.when(negative, -whole).otherwise(whole))

    whole = F.coalesce(F.when(value == F.floor(value), value.try_cast("bigint")), _by_digits(trimmed, 0, long_number))
    return F.when(numeric, whole).when(trimmed.rlike("^[0-9]+$"), trimmed.try_cast("bigint"))


def cell_factor(text: Column) -> Column:
    """Finite number in a cell, kept as text so that no digit is lost."""
    trimmed = strip(text)
    return F.when(is_number(trimmed), trimmed)


def cell_rate(text: Column, numeric: Column) -> Column:
    """Basis points from ``0.2%``, ``… 20.0 Percent`` or a numeric fraction; half even."""
    trimmed = strip(text)

    def basis_points(number: Column, digits: int) -> Column:
        short = F.bround(short_decimal(number).cast("decimal(30,14)") * power_of_ten(digits), 0)

        def half_even(whole: Column, rest: Column, negative: Column) -> Column:
            up = (rest > "5") | ((rest == "5") & (whole % 2 == 1))
            rounded = whole + up.cast("int")
            return F.when(negative, -rounded).otherwise(rounded)

        return F.coalesce(
            F.when(number.rlike(_FINE), short.try_cast("int")), _by_digits(number, digits, half_even, _FINE).try_cast("int"))

    phrase = F.regexp_extract(trimmed, "([0-9]+(?:[.][0-9]+)?) Percent", 1)
    return (
        F.when(numeric, basis_points(trimmed, 4))
        .when(trimmed.endswith("%"), basis_points(F.regexp_replace(trimmed, "%$", ""), 2))
        .when(F.contains(trimmed, F.lit(" Percent")), basis_points(phrase, 2))
    )
